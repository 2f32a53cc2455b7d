"""The registered queries of this subpackage: thin digests over the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, decontam, jaccard_join, knn_quality, line_dedup, merkle_manifest, mixing, pii, quality_rules, simhash_ring, substring_cover, suffix_dedup, token_store
from .base import table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The vocabulary file is a parameter; it stays where it is installed.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_substring_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_cover.dedup(table(spark, sf_dir, "documents")).drop("kept")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.report(decontam.scan(docs, table(spark, sf_dir, "benchmark")))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.assess(docs, weights).select("doc_id", *quality_rules.RESULT)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
    model = knn_quality.train(docs, labels.where(~held_out))
    return knn_quality.classify(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "pages"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op9_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.curriculum(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixing.by_position(mixed.select("doc_id", "size", "source_size", "target", "taken", "position"))


OP9_ORACLE = """
with sized as (
  select doc_id, coalesce(source, '') as s, source is null as no_source, md5(coalesce(cast(doc_id as varchar), '')) as h,
    cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size
  from documents
), by_source as (
  select no_source, s, cast(sum(size) as bigint) as source_size from sized group by no_source, s
), ranked as (
  select *, (row_number() over (order by no_source, s) - 1) % 3 + 1 as w from by_source
), ahead as (
  select *, 3.0::double * source_size as lim,
    coalesce(sum(3 * source_size) over p, 0)::double as lim_before, coalesce(sum(w) over p, 0)::double as w_before,
    (sum(source_size) over ())::double as everything, (sum(w) over ())::double as weights
  from ranked window p as (order by (3 * source_size)::double / w, no_source, s rows between unbounded preceding and 1 preceding)
), judged as (
  select *, (everything - lim_before) * w > lim * (weights - w_before) as is_full from ahead
), targets as (
  select no_source, s, w, source_size,
    case when is_full then lim else (everything - coalesce(sum(case when is_full then lim end) over (), 0)) * w / sum(case when not is_full then w::double end) over () end as target
  from judged
), streams as (
  select sized.*, w, source_size, target, cast(floor(target + 0.5) as bigint) as goal,
    coalesce(sum(size) over (partition by sized.no_source, sized.s order by h, doc_id nulls first, size rows between unbounded preceding and 1 preceding), 0) as before
  from sized join targets on sized.no_source = targets.no_source and sized.s = targets.s
), counted as (
  select *, case when target > 0 then before / target else 0 end as share,
    cast(case when source_size = 0 then 0 else (goal // source_size) * size + greatest(0, least(size, goal % source_size - before)) end as bigint) as taken
  from streams
)
-- Weights over time t are 1.5 - t, 2 and 1 + 4t: the integral from 0 to t is the share times the whole, solved for t.
select doc_id, size, source_size, target, taken,
  case when taken > 0 then least(1.0::double, case
    when w = 1 then 2 * share / (1.5 + sqrt(greatest(2.25 - 2 * share, 0)))
    when w = 2 then share
    when 3 * share <= 1 then 2 * (3 * share) / (1 + sqrt(1 + 8 * (3 * share)))
    else 0.5 + 2 * (3 * share - 1) / (3 + sqrt(9 + 8 * (3 * share - 1)))
  end) end as position
from counted
"""


def op10_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")).drop("kept")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = {c: F.col(c) for c in merkle_manifest.FIELDS}
    changed = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0, F.lit(False))
    lowered = F.when(changed, F.translate("text", UPPER, UPPER.lower())).otherwise(F.col("text"))
    rows = merkle_manifest.manifest(docs, list(fields.values()), list((fields | {"text": lowered}).values()))
    return merkle_manifest.verify(rows)


def op12_simhash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_ring.near_duplicates(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = table(spark, sf_dir, "conversations")
    return conversation_repair.report(every, *conversation_repair.repair(conversation_repair.damage(every)))


WORDS = "coalesce(regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+'), cast([] as varchar[]))"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_ORACLE = f"""
with recursive w as (select doc_id, {WORDS.format(LOWER)} as w from documents),
s as (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as x
  from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) as i from w where len(w) > 0)
), n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as common from s a join s b on a.x = b.x and a.doc_id < b.doc_id group by all),
links as (select a, b from pairs join n x on a = x.doc_id join n y on b = y.doc_id where 100 * common >= 75 * (x.n + y.n - common)),
ways as (select a, b from links union all select b, a from links),
reach as (select doc_id as id, doc_id as root from w union select ways.b, reach.root from reach join ways on reach.id = ways.a)
select id as doc_id, coalesce(any_value(n), 0) as n_shingles, min(root) as component_id from reach left join n on n.doc_id = id group by id
"""

OP3_ORACLE = f"""
with w as (select doc_id, {WORDS.format('text')} as w from documents),
windows as (select doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) as k from (select doc_id, w, unnest(generate_series(1, len(w) - 49)) as i from w where len(w) >= 50)),
low as (select k, min(doc_id) as first from windows group by k),
gone as (select distinct doc_id, unnest(generate_series(i, i + 49)) as p from windows join low using (k) where doc_id > first),
each as (select doc_id, unnest(w) as word, unnest(generate_series(1, len(w))) as p from w),
kept as (select doc_id, count(*) as n_kept, string_agg(word, ' ' order by p) as text from each where not exists (select 1 from gone where gone.doc_id = each.doc_id and gone.p = each.p) group by doc_id)
select w.doc_id, len(w) as n_words, len(w) - coalesce(n_kept, 0) as n_removed, sha256(coalesce(text, '')) as kept_sha256 from w left join kept on w.doc_id = kept.doc_id
"""

_BENCH_WORDS = f"coalesce(regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), cast([] as varchar[]))"
OP4_ORACLE = f"""
with d as (select doc_id, {_BENCH_WORDS} as w from documents),
b as (select coalesce(cast(item_id as varchar), '') as item, {_BENCH_WORDS} as w from benchmark),
known as (select distinct item, n, array_to_string(w[i : i + n - 1], ' ') as k from (select item, w, least(10, len(w)) as n, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct n from known),
windows as (select doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') as k from (select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as i from d cross join sizes where len(w) >= n)),
hits as (select distinct doc_id, i, n, item from windows join known using (k, n)),
covered as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(generate_series(i, i + n - 1)) as p from hits) group by doc_id),
items as (select doc_id, count(distinct item) as n_items, sha256(array_to_string(list_sort(list(distinct item)), ',')) as digest from hits group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, coalesce(digest, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered on d.doc_id = covered.doc_id left join items on d.doc_id = items.doc_id
"""

OP10_ORACLE = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
windows as (select doc_id, i, md5(substr(h, 2 * i + 1, 400)) as k from (select doc_id, h, unnest(generate_series(0, len(h) // 2 - 200)) as i from d where len(h) >= 400)),
twice as (select k from windows group by k having count(*) > 1),
hits as (select doc_id, i, coalesce(i > lag(i) over (partition by doc_id order by i) + 200, true) as opens from windows join twice using (k)),
spans as (select doc_id, min(i) as a, max(i) + 200 as b from (select doc_id, i, sum(opens::int) over (partition by doc_id order by i) as s from hits) group by doc_id, s),
gaps as (
  select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as u, a as v from spans
  union all select doc_id, max(b), 1000000000 from spans group by doc_id
), kept as (select d.doc_id, string_agg(substr(h, 2 * u + 1, 2 * (v - u)), '' order by u) as left_hex from gaps join d on d.doc_id = gaps.doc_id group by d.doc_id),
sums as (select doc_id, sum(b - a)::bigint as n_removed, count(*) as n_spans from spans group by doc_id)
select d.doc_id, len(h) // 2 as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(left_hex, h))) as kept_sha256
from d left join sums on d.doc_id = sums.doc_id left join kept on d.doc_id = kept.doc_id
"""


OP11_ORACLE = f"""
with recursive crc as (
  -- A byte is xored in, then eight shifts, each written as a -1.
  select doc_id, xor(list_reduce(flatten([[4294967295::bigint], flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))]),
    lambda a, x: case when x < 0 then xor(a >> 1, 3988292384 * (a & 1)) else xor(a, x) end), 4294967295::bigint) as crc
  from (select distinct doc_id from documents)
), fields as (
  select *, case when crc % 3 = 0 then {LOWER} else text end as now from documents left join crc using (doc_id)
), leaves as (
  select doc_id, coalesce(':' || lang, '-') as tree,
    sha256(coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    sha256(coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || coalesce(strlen(now) || ':' || now, '-')) as claimed
  from fields
), placed as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as place, count(*) over (partition by tree) as many from leaves
), nodes as (
  select tree, 0 as level, place, leaf as h, many from placed
  union all
  select tree, level + 1, place // 8, sha256(string_agg(h, '' order by place)), (many + 7) // 8 from nodes where many > 1 group by tree, level, place // 8, many
), tops as (
  select tree, h, level, row_number() over (order by encode(tree)) - 1 as place, count(*) over () as many from nodes where many = 1
), above as (
  select 0 as level, place, h, many from tops
  union all
  select level + 1, place // 8, sha256(string_agg(h, '' order by place)), (many + 7) // 8 from above where many > 1 group by level, place // 8, many
), every as (
  select tree, level, place, h from nodes where many > 1
  union all
  select t.tree, t.level + a.level, a.place, a.h from tops t join above a on a.many > 1
), runs as (
  select tree, level, place // 8 as run, list(h order by place) as hs from every group by all
), ways as (
  select p.tree, p.place as leaf_place, p.claimed, 0 as level, '' as proof, p.place, t.place as top_place, t.level as height, p.claimed as h from placed p join tops t using (tree)
  union all
  select w.tree, leaf_place, claimed, w.level + 1, proof || array_to_string(hs[1 : spot] || hs[spot + 2 : 8], ''), w.place, top_place, height, sha256(array_to_string(hs[1 : spot], '') || h || array_to_string(hs[spot + 2 : 8], ''))
  from (select *, node % 8 as spot from (select *, case when level < height then place >> (3 * level) else top_place >> (3 * (level - height)) end as node from ways)) w
    join runs r on w.tree = r.tree and w.level = r.level and node // 8 = r.run
), last as (
  select tree, leaf_place, arg_max(proof, level) as proof, arg_max(h, level) as folded from ways group by all
)
select p.doc_id, p.leaf, t.h as subroot, (select h from above where many = 1) as root, sha256(proof) as proof_sha256, folded as folded_root, folded = (select h from above where many = 1) as verified
from placed p join tops t using (tree) join last l on l.tree = p.tree and l.leaf_place = p.place
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_jaccard_join": op1_jaccard_join,
        "op2_token_store": op2_token_store,
        "op3_substring_cover": op3_substring_cover,
        "op4_decontaminate": op4_decontaminate,
        "op5_quality_rules": op5_quality_rules,
        "op6_quality_classifier": op6_quality_classifier,
        "op7_line_dedup": op7_line_dedup,
        "op8_personal_data": op8_personal_data,
        "op9_curriculum_mix": op9_curriculum_mix,
        "op10_suffix_repeats": op10_suffix_repeats,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_simhash_ring": op12_simhash_ring,
        "op13_conversation_repair": op13_conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_jaccard_join": OP1_ORACLE, "op3_substring_cover": OP3_ORACLE, "op4_decontaminate": OP4_ORACLE, "op7_line_dedup": line_dedup.ORACLE,
        "op9_curriculum_mix": OP9_ORACLE, "op10_suffix_repeats": OP10_ORACLE, "op11_merkle_manifest": OP11_ORACLE,
    }
