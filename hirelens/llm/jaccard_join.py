"""Operator 1, n-gram Jaccard join: a grouped prefix join on sets of word shingles.

Shingles have one order for the whole corpus, rare before frequent, then by hash.
Of two sets with a Jaccard similarity of 3/4 or more, the first n - ceil(3n/4) + k(n)
shingles in that order (the prefix) have k of the smaller set in common, where k is a
SHARE-th of the size, 1 at least; and the smaller has at least 3/4 of the larger's size.

1. Equal sets become one class.
2. Classes with identical prefixes and size become one group, for which the first of them stands. Prefix
   shingles of one group only are out, and so are groups that share fewer than k of them with all others together.
3. Pairs of groups are formed and filtered by size: each group is paired with the one in its band of sizes that
   leads most of its shingles.
4. Pairs that are left are expanded to members and verified on whole sets: the first members of two groups,
   and each other member of a group with the first. Links make components.
5. What then stands apart is paired again, as the members of a group in one component: those of a group, or of
   groups with one leader, with each other, and the rest with a component elsewhere in which there are
   sets of about their size that share k shingles of their prefix. These pairs are filtered by that
   number, expanded to members and verified on whole sets.

So no pairs inside a component are formed beyond those that made it: the components are exact, while
thousands of near copies cost about as many comparisons as there are of them. Comparisons of step 5 stand
in blocks of at most BLOCK shingles of one side and ASK sets of the other, so no task takes an unbounded group.

The order of shingles only steers cost, never results. The frequent ones are found in a
hash sample of one document in SAMPLE; at most ORDER_LIMIT of them, 16 bytes
each, are broadcast.

Edge cases: texts with 1 to 4 words have one shingle, the whole sequence; null,
empty and wordless texts have none and are linked with nothing; very long texts are read whole, in memory
in proportion to the longest; rows with one doc_id belong to one component; rows without doc_id have their
number of shingles, are linked with nothing and have no component. An empty table gives an empty result.
Columns other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import LOWER, Scratch, binary_longs, doc_key, mix, prefix_sums, shuffled, small, spans, text_bytes, windows, word_codes

WORDS = 5
#: Two sets link when PER * intersection >= NUM * union.
NUM, PER = 75, 100
SAMPLE, SAMPLE_DF, ORDER_LIMIT = 16, 3, 400_000
#: Shingles of sets of one component that are compared with others at once, and how many others at most.
BLOCK, ASK = 40_000, 256
#: A prefix is longer by a SHARE-th of the set, and so many of its shingles must be shared.
SHARE = 10


def shingles(text: bytes | None, n: int = WORDS) -> np.ndarray:
    """Hashes of the distinct shingles, sorted."""
    own = word_codes(text, LOWER)
    if not len(own):
        return own
    sums = prefix_sums(own)
    if len(own) < n:
        return spans(sums, np.array([0]), np.array([len(own)]))
    return np.unique(windows(sums, n))


def shared_size(n: int) -> int:
    """k: how many shingles of their prefixes two linked sets share, if n is the size of the smaller one."""
    return max(1, n // SHARE)


def prefix_size(n: int) -> int:
    return n - -(-NUM * n // PER) + shared_size(n)


def prefix(own: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of a sorted set in the order of the corpus: not frequent by hash, then frequent by rank."""
    size = prefix_size(len(own))
    if not len(frequent):
        return own[:size]
    at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
    known = frequent[at] == own
    rare = own[~known]
    if len(rare) >= size:
        return rare[:size]
    late = own[known][np.argsort(rank[at[known]], kind="stable")]
    return np.r_[rare, late][:size]


def frequent_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, rank of each by frequency) of shingles that the sampled documents share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = [shingles(t) for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64))], names=["shingle"])

    counted = texts.where(F.pmod(doc_key(), F.lit(SAMPLE)) == 0).select("text").mapInArrow(run, "shingle bigint").groupBy("shingle").agg(F.count("*").alias("n"))
    top = counted.where(F.col("n") >= SAMPLE_DF).orderBy(F.desc("n"), "shingle").limit(ORDER_LIMIT).toArrow()
    hashes = top["shingle"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], (len(hashes) - order).astype(np.int64)


def sets(texts: DataFrame) -> DataFrame:
    """doc_id, n_shingles, two hashes of the set, and the prefix with its hash."""
    order = texts.sparkSession.sparkContext.broadcast(frequent_shingles(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank = order.value
        for batch in small(batches):
            rows = []
            for text in text_bytes(batch.column("text")):
                own = shingles(text)
                first = prefix(own, frequent, rank) if len(own) else own
                rows.append((len(own), _sum(own), _sum(mix(own)), _sum(mix(first * np.uint64(3))), first.view(np.int64)))
            kinds = (pa.int64(),) * 4
            counts = np.array([len(r[4]) for r in rows])
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(np.concatenate([np.empty(0, np.int64), *(r[4] for r in rows)])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)), lists], names=["doc_id", "n_shingles", "set_a", "set_b", "prefix_hash", "prefix"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, prefix_hash bigint, prefix array<bigint>")


def _sum(x: np.ndarray) -> int:
    return int(x.sum(dtype=np.uint64).astype(np.int64)) if len(x) else 0


def verify(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(binary_longs(batch.column("left")), binary_longs(batch.column("right")), strict=True):
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(PER * both >= NUM * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(bodies.select(F.col("id").alias("a"), F.col("body").alias("left")), "a")
    two = one.join(bodies.select(F.col("id").alias("b"), F.col("body").alias("right")), "b")
    return two.select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint")


def verify_blocks(asked: DataFrame, members: DataFrame, bodies: DataFrame) -> DataFrame:
    """Links (a, b) between classes and members of components they are asked to be compared with.

    asked is (id, part), members (id, part, n). Members are numbered into blocks by a hash; a class
    goes to each block of its component, and there meets all members at once. The classes asked for
    one component are dealt over copies of its blocks, a copy for each ASK of them.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK).cast("int"))
    copies = F.greatest(F.lit(1), F.ceil(F.col("many") / ASK).cast("int"))
    counted = asked.groupBy("part").agg(F.count("*").alias("many"))
    sizes = members.groupBy("part").agg(F.sum("n").alias("size")).join(counted, "part").select("part", blocks.alias("blocks"), copies.alias("copies"))
    each = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    hashed = lambda name, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(name)).cast("int")
    inside = members.join(sizes, "part").select("id", "part", hashed("blocks", 0).alias("block"), each("copies").alias("copy"), F.lit(0).alias("kind"))
    outside = asked.join(sizes, "part").select("id", "part", each("blocks").alias("block"), hashed("copies", 1).alias("copy"), F.lit(1).alias("kind"))
    cell = ("part", "block", "copy")
    placed = inside.unionByName(outside).join(bodies, "id").repartition(*cell).sortWithinPartitions(*cell, "kind", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, held, index = None, [], [], None
        for batch in batches:
            links = []
            keys = zip(*(batch.column(c).to_pylist() for c in (*cell, "kind", "id")), strict=True)
            for row, own in zip(keys, binary_longs(batch.column("body")), strict=True):
                if row[:3] != at:
                    at, ids, held, index = row[:3], [], [], None
                if row[3] == 0:
                    ids.append(row[4])
                    held.append(own.copy())
                    continue
                if not ids:
                    continue  # no member has come to this block
                if index is None:
                    sizes = np.array([len(x) for x in held])
                    shingle, owner = np.concatenate(held), np.repeat(np.arange(len(held)), sizes)
                    order = np.argsort(shingle, kind="stable")
                    index, held = (shingle[order], owner[order], sizes), []
                shingle, owner, sizes = index
                low, high = np.searchsorted(shingle, own, "left"), np.searchsorted(shingle, own, "right")
                counts = high - low
                place = np.repeat(low - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
                both = np.bincount(owner[place], minlength=len(sizes))
                good = np.flatnonzero(PER * both >= NUM * (len(own) + sizes - both))
                links += [(row[4], ids[k]) for k in good.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return placed.select(*cell, "kind", "id", "body").mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, component) of every id on an edge: the smallest id that its edges reach.

    Each round links all neighbours of a node to the smallest of them, first the
    larger, then the smaller ones; it ends when every node is linked to one that is linked to none.
    """
    k = 0
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(shuffled(low), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(shuffled(low), "u")
        small = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        now = scratch.write(small, f"{name}{k}")
        if k:
            scratch.drop(f"{name}{k - 1}")
        edges_now, nodes = now.agg(F.count("*"), F.countDistinct("u")).first()
        if edges_now == nodes and now.join(shuffled(now.select(F.col("u").alias("v"))), "v", "left_semi").isEmpty():
            roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
        k += 1


def link(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of docs."""
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    every = scratch.write(sets(texts), "sets")
    some = every.where("n_shingles > 0")

    same_set = ["n_shingles", "set_a", "set_b"]
    classes = some.groupBy(*same_set).agg(F.min("doc_id").alias("id"), F.any_value("prefix_hash").alias("prefix_hash"), F.any_value("prefix").alias("prefix"))
    groups = classes.groupBy("n_shingles", "prefix_hash").agg(F.min("id").alias("group"), F.count("*").alias("members"), F.any_value("prefix").alias("prefix"))
    groups = scratch.write(groups, "groups")
    every = scratch.write(every.drop("prefix"), "every")
    scratch.drop("sets")
    members = scratch.write(every.where("n_shingles > 0").groupBy(*same_set).agg(F.min("doc_id").alias("id"), F.min("prefix_hash").alias("prefix_hash")), "members")
    by_group = members.join(groups.select("n_shingles", "prefix_hash", "group", "members"), ["n_shingles", "prefix_hash"]).select("group", "members", "id", F.col("n_shingles").alias("n"))
    tokens = groups.select("group", F.col("n_shingles").alias("n"), F.explode("prefix").alias("token"))
    several = scratch.write(tokens.groupBy("token").agg(F.count("*").alias("length")).where("length > 1"), "several")
    shared = scratch.write(tokens.join(several, "token"), "shared")
    # The smaller of two linked sets has 3/4 of n at least.
    enough = shared.groupBy("group").agg(F.count("*").alias("tokens"), F.sum("length").alias("score"), F.first("n").alias("n")).where(F.col("tokens") >= least_shared("n"))
    runs = scratch.write(shared.join(scratch.write(enough.select("group", "score"), "enough"), "group").select("token", "group", "n", "score", band("n").alias("band")), "runs")
    scratch.drop("several", "shared")

    ids = by_group.join(runs.select("group").distinct().withColumn("paired", F.lit(True)), "group", "left").where("paired or members > 1").select("id", "group", "n")
    ids = scratch.write(ids, "ids")
    bodies = _bodies(texts, ids.select("id"), scratch)
    parts = _components(runs, ids, bodies, scratch)
    reps = members.join(parts, "id", "left").select(*same_set, F.coalesce("component", "id").alias("component_id"))
    rows = every.groupBy("doc_id", *same_set).agg(F.count("*").alias("rows"))
    found = rows.join(reps, same_set, "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("row")).drop("row")
    return found.unionByName(_nameless(docs))


def _nameless(docs: DataFrame) -> DataFrame:
    """Rows without doc_id: the size of their set, and no component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            yield pa.RecordBatch.from_arrays([pa.array([len(shingles(t)) for t in text_bytes(batch.column("text"))], pa.int64())], names=["n_shingles"])

    counted = docs.where("doc_id is null").select("text").mapInArrow(run, "n_shingles bigint")
    none = F.lit(None).cast("bigint")
    return counted.select(none.alias("doc_id"), "n_shingles", none.alias("component_id"))


def band(n: str) -> Column:
    """Sizes by powers of 4/3: linked sets are in one band or in two beside each other."""
    return F.floor(F.log(n) / math.log(4 / 3)).cast("int")


def least_shared(n: str) -> Column:
    """The least number of prefix shingles that a set of this size shares with a linked one."""
    return F.greatest(F.lit(1), F.expr(f"(3 * {n} div 4) div {SHARE}"))


def _bodies(texts: DataFrame, ids: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, sorted shingles as bytes) of the classes that are in a run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([shingles(t).tobytes() for t in text_bytes(batch.column("text"))], pa.binary())], names=["id", "body"])

    asked = texts.join(ids.select(F.col("id").alias("doc_id")), "doc_id")
    return scratch.write(asked.mapInArrow(run, "id bigint, body binary"), "bodies")


def _components(runs: DataFrame, ids: DataFrame, bodies: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) of every class that has a link. runs is (token, group, n, score, band), ids (id, group, n)."""
    ends = runs.groupBy("token", "band").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.max(F.struct("score", "group", "n")).alias("lead")).where("low < high")
    ends = scratch.write(ends.select("token", "band", F.col("lead.group").alias("leader"), F.col("lead.n").alias("leader_n"), F.col("lead.score").alias("leader_score")), "ends")
    # Pairs of groups: one for each group, which leads most of its shingles.
    pairs = (
        runs.join(ends, ["token", "band"]).where("group <> leader").groupBy("group", "n", "leader", "leader_n", "leader_score").agg(F.count("*").alias("led"))
        .groupBy("group", "n").agg(F.max(F.struct("led", "leader_score", "leader", "leader_n")).alias("best")).select("group", "n", "best.*")
    )
    pairs = scratch.write(pairs.where(4 * F.least("n", "leader_n") >= 3 * F.greatest("n", "leader_n")), "pairs")
    scratch.drop("ends")
    # Expanded: the first of each group with that of its leader, the others of a group with its first.
    asked = pairs.select(F.least("group", "leader").alias("a"), F.greatest("group", "leader").alias("b")).unionByName(ids.where("id <> group").select(F.col("group").alias("a"), F.col("id").alias("b"))).distinct()
    edges = scratch.write(verify(asked, bodies), "links")
    parts = components(edges, scratch, "parts0_")
    if ids.isEmpty():
        return parts
    placed = ids.join(parts, "id", "left").join(pairs.select("group", "leader"), "group", "left")
    placed = scratch.write(placed.select("id", "group", "n", F.coalesce("component", "id").alias("part"), F.coalesce("leader", "group").alias("bucket")), "placed")
    rest = scratch.write(_rest(runs, placed, bodies, scratch), "rest")
    return components(edges.unionByName(rest), scratch, "parts_")


def _inside(placed: DataFrame, key: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(id, part) to compare with (id, part, n): in each bucket of this key that is in several components, all but the largest with all."""
    sizes = placed.groupBy(key, "part").agg(F.count("*").alias("many")).groupBy(key).agg(F.max(F.struct("many", "part")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    sizes = scratch.write(sizes.select(key, F.col("top.part").alias("top")), f"several_{key}")  # written, so that a hot bucket is split in the join
    mixed = scratch.write(placed.join(sizes, key), f"mixed_{key}")
    name = F.xxhash64(F.lit(key), F.col(key)).alias("part")
    return mixed.where("part <> top").select("id", name), mixed.select("id", name, "n")


def _rest(runs: DataFrame, placed: DataFrame, bodies: DataFrame, scratch: Scratch) -> DataFrame:
    """Links between components that are still apart. placed is (id, group, n, part, bucket).

    Groups with one leader share most with it, and so with each other: they form a bucket,
    in which all but its largest component are compared with everything; so do the members of a group.
    Pairs from different buckets are looked for by the shingles they share.
    """
    buckets = [_inside(placed, key, scratch) for key in ("bucket", "group")]
    asked_inside, members_inside = (x.unionByName(y) for x, y in zip(*buckets, strict=True))

    many = placed.groupBy("part").agg(F.count("*").alias("many"))
    # The members of a group in one component are one unit.
    units = placed.select("group", "part", "bucket").distinct().join(many, "part").select("group", "bucket", F.struct("many", "part").alias("rank"))
    spread = runs.select("token", "group", "n", "band").join(units, "group")
    ends = spread.groupBy("token").agg(F.min("rank").alias("low"), F.max("rank").alias("high"), F.min("bucket").alias("from"), F.max("bucket").alias("to")).where("low < high and from < to").select("token")
    open_ = scratch.write(spread.join(scratch.write(ends, "apart"), "token"), "open")
    others = open_.select("token", F.col("rank").alias("other"), F.col("bucket").alias("far"), F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1)).alias("band")).distinct()
    pairs = open_.join(others, ["token", "band"]).where("rank < other and bucket <> far").groupBy("group", "n", "rank", "other").agg(F.countDistinct("token").alias("shared")).where(F.col("shared") >= least_shared("n"))
    pairs = scratch.write(pairs.select("group", F.col("rank.part").alias("part"), F.col("other.part").alias("far")), "far")
    asked = scratch.write(pairs.join(placed.select("group", "part", "id"), ["group", "part"]).select("id", F.col("far").alias("part")).distinct(), "asked")
    return verify_blocks(asked_inside, members_inside, bodies).unionByName(verify_blocks(asked, placed.select("id", "part", "n"), bodies))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id by document."""
    return link(docs).select("doc_id", "n_shingles", "component_id")


def representatives(docs: DataFrame) -> DataFrame:
    """docs without the near duplicates: of each component the rows with the smallest doc_id stay.

    Rows without doc_id and texts without words stay.
    """
    gone = join(docs).where("component_id < doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("gone_id"), "left_anti")
