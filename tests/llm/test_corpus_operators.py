"""Near duplicates, repeats, mixing, line dedup and token files."""

import random
from collections import defaultdict

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelens.llm import base, jaccard_join, line_dedup, mixing, queries, substring_cover, suffix_dedup, token_store

CLASH = {k: "clash" for k in ("n_shingles", "component_id", "place", "name", "digest", "size", "target", "mix_key", "start", "n_tokens")}


def some_texts(seed=3, n=60):
    """Texts with copies, near copies, shared passages and repeats inside."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(55, 90))) for _ in range(4)]
    texts = [None, "", "  \n", "one two", "one two", "ONE Two", "a b c d e", "w " * 300, "aaaa" * 200]
    for _ in range(n):
        kind = rng.random()
        if kind < 0.3 and len(texts) > 12:
            own = (rng.choice(texts[9:]) or "x").split(" ")
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own))
        else:
            own = [word() for _ in range(rng.randint(1, 150))]
            for _ in range(rng.randint(0, 2)):
                own.insert(rng.randint(0, len(own)), rng.choice(passages))
            texts.append(rng.choice([" ", "\n", "  "]).join(own))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join(make, seed):
    texts = some_texts(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(make(texts, CLASH)).collect()}
    assert got == brute.jaccard(list(enumerate(texts)))


def test_jaccard_join_of_documents(documents, pairs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(documents).collect()}
    assert got == brute.jaccard(pairs)


def test_jaccard_join_of_chains(make):
    """Neighbours are linked, ends are not."""
    own = [f"w{k}" for k in range(100)]
    texts = [" ".join(own[:k] + [f"x{j}" for j in range(k)] + own[k:]) for k in range(0, 40, 4)]
    texts += [" ".join(f"{c}{k}" for k in range(30)) for c in "pq"]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(make(texts)).collect()}
    assert got == brute.jaccard(list(enumerate(texts)))


def near_copies(seed, n):
    """Families of texts with edits at their start, end and inside, and strangers that share passages with them."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    stems = [[word() for _ in range(rng.choice([8, 30, 60, 120]))] for _ in range(5)]
    for _ in range(n):
        own = list(rng.choice(stems))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
            at = rng.randrange(len(own))
            own[at : at + rng.randint(0, 2)] = [word() for _ in range(rng.randint(0, 2))]
        if rng.random() < 0.2:
            own = own[: len(own) // 2] + [word() for _ in range(20)]
        yield " ".join(own)


@pytest.mark.parametrize(("seed", "block", "ask"), [(1, 200_000, 256), (2, 100, 2), (3, 1, 1)])
def test_jaccard_join_of_near_copies(make, seed, block, ask, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "ASK", ask)
    texts = list(near_copies(seed, 400))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(make(texts)).collect()}
    assert got == brute.jaccard(list(enumerate(texts)))


def test_jaccard_join_of_long_texts(make):
    rng = random.Random(2)
    own = [str(rng.randint(0, 50_000)) for _ in range(120_000)]
    texts = [" ".join(own), " ".join(own[5000:]), " ".join(own[60_000:]), "short"]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(make(texts)).collect()}
    assert got == brute.jaccard(list(enumerate(texts)))
    assert [got[k][1] for k in range(4)] == [0, 0, 2, 3]


def test_jaccard_join_edges(make):
    assert jaccard_join.join(make([])).count() == 0
    rows = jaccard_join.join(make([(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f g"), (5, "a b c d e f"), (None, None)])).collect()
    assert sorted((tuple(r) for r in rows), key=str) == [(3, 2, 3), (3, 2, 3), (5, 2, 3), (None, 0, None), (None, 3, None)]
    left = jaccard_join.representatives(make([(3, "a b c d e f"), (None, "a b c d e f"), (5, "A b c d e f"), (6, None), (7, "")]))
    assert {r.doc_id for r in left.collect()} == {3, None, 6, 7}


def test_prefixes_share_enough():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 60)
        a = set(rng.sample(range(1000), n))
        b = {x for x in a if rng.random() < 0.9} | set(rng.sample(range(1000, 2000), rng.randint(0, n // 5)))
        if b and 100 * len(a & b) >= 75 * len(a | b):
            common = set(sorted(a)[: jaccard_join.prefix_size(len(a))]) & set(sorted(b)[: jaccard_join.prefix_size(len(b))])
            assert len(common) >= jaccard_join.shared_size(min(len(a), len(b)))


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = jaccard_join.components(spark.createDataFrame(edges, "a bigint, b bigint"), base.Scratch(spark, "test"), "c")
    assert {r.id: r.component for r in got.collect()} == {x: root(x) for a, b in edges if a != b for x in (a, b)}


def test_cover_is_a_difference_cover():
    found = {(a - b) % substring_cover.PERIOD for a in substring_cover.COVER for b in substring_cover.COVER}
    assert found == set(range(substring_cover.PERIOD))


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_cover(make, seed):
    texts = some_texts(seed)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_cover.dedup(make(texts, CLASH)).collect()}
    assert got == brute.repeated_windows(list(enumerate(texts)))
    assert any(n for _, n, _ in got.values())


def test_substring_cover_of_documents(documents, pairs):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_cover.dedup(documents).collect()}
    assert got == brute.repeated_windows(pairs)


def test_substring_cover_edges(make):
    text = " ".join(f"w{k}" for k in range(60))
    rows = substring_cover.dedup(make([(1, text), (1, text), (1, "x " + text), (None, text), (2, text + " end")])).collect()
    assert sorted(((r.doc_id, r.n_removed) for r in rows), key=str) == [(1, 0), (1, 0), (1, 0), (2, 60), (None, 0)]
    assert substring_cover.dedup(make([])).count() == 0


def test_maximal_repeats():
    rng = random.Random(1)
    for _ in range(150):
        size = rng.choice([3, 10, 16, 20])
        stem = [bytes(rng.choices(b"ab", k=60)) for _ in range(3)]
        texts = []
        for _ in range(rng.randint(1, 6)):
            own = bytearray(rng.choice(stem))
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(60)] = rng.choice(b"abc")
            texts.append(bytes(own)[rng.randint(0, 10) : rng.randint(40, 60)])
        places = defaultdict(list)
        for t, own in enumerate(texts):
            for k in range(len(own)):
                for end in range(k + size, len(own) + 1):
                    places[own[k:end]].append((t, k))
        want = {}
        for s, at in places.items():
            ends = {texts[t][k + len(s) : k + len(s) + 1] or (t, k) for t, k in at}
            fronts = {texts[t][k - 1 : k] if k else (t, k) for t, k in at}
            if len(at) > 1 and len(ends) > 1 and len(fronts) > 1:
                want[s] = sorted(at)
        got = {texts[which[0]][at[0] : at[0] + n]: sorted(zip(which.tolist(), at.tolist(), strict=True)) for n, which, at in suffix_dedup.maximal_repeats(texts, size)}
        assert got == want


@pytest.mark.parametrize("most", [suffix_dedup.PART, 1])
def test_suffix_dedup(spark, make, most, monkeypatch):
    monkeypatch.setattr(suffix_dedup.removed, "__defaults__", (suffix_dedup.MIN_BYTES, suffix_dedup.GRAM, most))
    texts = [*some_texts(), "é" * 150, "xé" * 150, "ab" * 99 + "c", "ab" * 99 + "c"]
    rows = suffix_dedup.dedup(make(texts, CLASH)).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == brute.repeated_bytes(texts)


def test_cut_contexts_keep_equal_windows_together():
    """Each window stands in one part, which its bytes alone decide."""
    rng = random.Random(4)
    name = bytes(rng.choices(b"xyz", k=20))
    level = [(b"", bytes(rng.choices(b"ab", k=rng.randint(0, 30))) + name + bytes(rng.choices(b"ab", k=rng.randint(0, 30)))) for _ in range(80)]
    level = [(part, t, t.index(name), len(name)) for part, t in level if len(t) >= 50 and 30 >= t.index(name) and len(t) - t.index(name) <= 50]
    windows = lambda rows: sorted(t[k : k + 50] for _, t, *_ in rows for k in range(len(t) - 49))
    want = windows(level)
    for _ in range(8):
        cut = lambda own, start, known: suffix_dedup.halves(own, start, known, 50) if known < 50 else [(0, 0, own, start, known)]
        level = [(part + bytes([65 + side]) + t[at : at + more], t, at, more) for part, own, start, known in level for side, _, t, at, more in cut(own, start, known)]
        assert windows(level) == want
        where = defaultdict(set)
        for part, t, at, known in level:
            assert 0 <= at and at + known <= len(t)
            for k in range(len(t) - 49):
                assert k <= at and at + known <= k + 50
                where[t[k : k + 50]].add(part)
        assert all(len(x) == 1 for x in where.values())
    assert all(len(t) == 50 for _, t, *_ in level)


def test_suffix_dedup_of_a_very_frequent_name(make):
    """10,000 different contexts around one string of 64 bytes, some of which share a window."""
    rng = random.Random(8)
    middle = "".join(rng.choices("abcdefghij", k=100))
    side = lambda n: "".join(rng.choices("klmnopqr", k=n))
    lefts, rights = [side(140) for _ in range(60)], [side(140) for _ in range(60)]
    texts = [(rng.choice(lefts) if rng.random() < 0.05 else side(140)) + middle + (rng.choice(rights) if rng.random() < 0.05 else side(140)) for _ in range(10_000)]
    texts += [texts[5]] * 3 + ["", None]
    rows = suffix_dedup.dedup(make(texts)).orderBy("doc_id").collect()
    want = brute.repeated_bytes(texts)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == want
    assert 100 < sum(n > 0 for _, n, *_ in want) < 9000


@pytest.mark.parametrize("most", [suffix_dedup.PART, 3])
def test_repeat_groups(make, most):
    """Groups list all occurrences of their string, and cover what is removed."""
    texts = [t for t in some_texts(5) if t] + ["é" * 150]
    groups, places = suffix_dedup.repeat_groups(make(texts), most=most)
    at = defaultdict(list)
    for r in places.collect():
        at[r.set, r.rank].append((r.doc_id, r.start))
    raw = [t.encode() for t in texts]
    gone = [np.zeros(len(b), bool) for b in raw]
    for g in groups.collect():
        found = [x for k in range(g.low, g.high) for x in at[g.set, k]]
        strings = {raw[d][s : s + g.length] for d, s in found}
        assert len(found) > 1 and len(strings) == 1 and len(strings.pop()) == g.length >= suffix_dedup.MIN_BYTES
        for d, s in found:
            gone[d][s : s + g.length] = True
    assert [int(x.sum()) for x in gone] == [n for _, n, *_ in brute.repeated_bytes(texts)]


def test_suffix_dedup_of_documents(documents, pairs):
    rows = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.dedup(documents).collect()}
    assert rows == dict(zip([i for i, _ in pairs], brute.repeated_bytes([t for _, t in pairs]), strict=True))


def test_suffix_dedup_edges(make, monkeypatch):
    text = "".join(random.Random(1).choices("abcdefgh", k=260))
    rows = suffix_dedup.dedup(make([(1, text), (1, text), (None, "x" + text), (2, text[:199]), (3, None)])).collect()
    assert sorted(((r.doc_id, r.n_removed) for r in rows), key=str) == [(1, 260), (1, 260), (2, 0), (3, 0), (None, 260)]
    assert suffix_dedup.dedup(make([])).count() == 0
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    rng = random.Random(2)
    part = "".join(rng.choices("abcdefgh", k=400))
    long = "".join(rng.choices("abcdefgh", k=1000)) + part + "".join(rng.choices("abcdefgh", k=333)) + part
    name, _, first, end = suffix_dedup.contexts(long.encode())
    assert first[0] == 0 and end[-1] == len(long) and (first[1:] == end[:-1] - 199).all()


def test_line_dedup(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{sf_dir}/pages.parquet'")
    want = {r[0]: r[1:] for r in con.sql(line_dedup.ORACLE).fetchall()}
    got = {r.page_id: r[1:] for r in line_dedup.dedup(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()}
    assert got == want


def test_line_dedup_edges(spark):
    page = lambda *x: "<html><p>" + "</p><p>".join(x) + "</p></html>"
    rows = [(k, "http://a.org/x", page("Menu", f"text {k}", "Menu")) for k in range(4)] + [(9, None, page("Menu")), (10, "http://b.org", page("Menu")), (11, "http://a.org", None), (12, "", ""), (13, "http://A.org/y", page("Menu"))]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"host": F.lit(1), "lines": F.lit(2), "salt": F.lit(3)})
    got = {r.page_id: (r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup(df).collect()}
    assert got[0] == (3, 2, "text 0") and got[9] == (1, 0, "Menu") and got[10] == (1, 1, "") and got[11] == (0, 0, "") and got[12] == (0, 0, "") and got[13] == (1, 1, "")
    assert line_dedup.dedup(df.where("false")).count() == 0


def test_line_dedup_of_long_pages(spark):
    """A page of 100,000 lines, and a host with most of the pages."""
    rows = [(k, "http://big.org/x", f"<p>Menu</p><p>text {k}</p>") for k in range(3000)] + [(9000 + k, f"http://h{k}.org", f"<p>Menu</p><p>{k}</p>") for k in range(50)]
    rows.append((9999, "http://big.org/y", "".join(f"<p>line {k}</p>" for k in range(100_000)) + "<p>Menu</p>"))
    got = {r.page_id: r for r in line_dedup.dedup(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert len(got) == len(rows)
    assert got[9999].n_lines == 100_001 and got[9999].n_dropped == 1 and got[9999].kept.count("\n") == 99_999
    assert all(got[k].kept == f"text {k}" for k in range(3000)) and got[9003].n_dropped == 2


def test_line_dedup_goes_by_the_ratio_alone(spark):
    """2 of 2 pages and 2 of 6 (33 %) are above 30 %; 3 of 10 is exactly the ratio, 1 of 4 below it."""
    page = lambda *x: "".join(f"<p>{t}</p>" for t in x)
    rows = [(host, k, page("Menu" if k < some else f"own {k}", f"text {k}")) for host, some, all_ in (("two", 2, 2), ("six", 2, 6), ("ten", 3, 10), ("four", 1, 4)) for k in range(all_)]
    df = spark.createDataFrame([(k, f"http://{host}.org/{i}", html) for k, (host, i, html) in enumerate(rows)], "page_id bigint, url string, html string")
    got, con = {r.page_id: r[1:] for r in line_dedup.dedup(df).collect()}, duckdb.connect()
    con.register("pages", df.toArrow())
    assert got == {r[0]: r[1:] for r in con.sql(line_dedup.ORACLE).fetchall()}
    dropped = {h: [got[k][2] for k, (host, _, _) in enumerate(rows) if host == h] for h in ("two", "six", "ten", "four")}
    assert dropped == {"two": [2, 2], "six": [1, 1, 0, 0, 0, 0], "ten": [0] * 10, "four": [0] * 4}


def mixed(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumns({c: F.lit("clash") for c in ("size", "target", "taken", "mix_key")})


def test_mixing_against_sql(spark, sf_dir, documents):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    want = con.sql(queries.OP9_ORACLE)
    got = queries.op9_curriculum_mix(spark, sf_dir)
    assert got.columns == want.columns
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want.fetchall(), key=key)


def test_mixing(spark):
    rng = random.Random(3)
    rows = [(k, "w " * rng.randint(0, 30), rng.choice(["a", "b", "c", "d", None])) for k in range(300)] + [(300, None, "e"), (None, "x y", "a"), (7, "again", "a"), (7, "again", "a")]
    got = mixing.curriculum(mixed(spark, rows)).collect()
    assert len(got) == len(rows)
    sums = defaultdict(lambda: [0, 0, 0.0])
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        assert r.position is None or 0 <= r.position <= 1
        sums[r.source][0] += r.size
        sums[r.source][1] += r.taken
        sums[r.source][2] = r.target
    assert sum(t for *_, t in sums.values()) == pytest.approx(sum(s for s, *_ in sums.values()))
    for size, taken, target in sums.values():
        assert abs(taken - target) <= 1 and target <= 3 * size
    again = mixing.curriculum(mixed(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.curriculum(mixed(spark, [])).count() == 0


def test_mixing_carries_all_columns(spark):
    """Input columns named like the helpers are in the result as they were; those named like results are replaced."""
    df = spark.createDataFrame([(k, "a b c", "s", f"k{k}", k, "old") for k in range(4)], "doc_id bigint, text string, source string, mix_key string, mix_total bigint, taken string")
    rows = mixing.curriculum(df).orderBy("doc_id").collect()
    assert [(r.mix_key, r.mix_total, r.taken, r.target) for r in rows] == [(f"k{k}", k, 3, 12.0) for k in range(4)]


def test_mixing_of_long_texts_and_ties(spark):
    """A text of 200,000 words beside short ones, and rows equal in doc_id and size but not in text."""
    rows = [(1, "w " * 200_000, "a"), (2, "x y", "a"), (3, "z", "b")] + [(5, f"t{k} u", "c") for k in range(40)]
    got = mixing.curriculum(mixed(spark, rows), whole=True).collect()
    assert {r.size for r in got if r.doc_id == 1} == {200_000}
    again = mixing.curriculum(mixed(spark, rows[::-1]).repartition(7), whole=True).collect()
    key = lambda r: (r.doc_id, r.text)
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert {key(r): r.taken for r in got} == {key(r): r.taken for r in again}


def test_positions_follow_the_schedule(spark):
    rows = [(k, "w " * 20, s) for k, s in enumerate("abc" * 200)]
    order = mixing.training_order(mixing.curriculum(mixed(spark, rows))).select("source", "position", "words").collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    early = defaultdict(float)
    total = defaultdict(float)
    for r in order:
        total[r.source] += r.words
        early[r.source] += r.words * (r.position < 0.5)
    share = {s: early[s] / total[s] for s in total}
    assert share["a"] == pytest.approx(0.625, abs=0.03) and share["b"] == pytest.approx(0.5, abs=0.03) and share["c"] == pytest.approx(1 / 3, abs=0.03)


PATH = queries.tokenizer_path()
ODD = [None, "", " ", "a　b  c\n\n d\t e\x1c\x1df \x85g\xa0h    i  ", " '  's it's 'S", "don't stop\r\n\r\n12 345  ?! ", "é \xdf t", "a<|endoftext|> x", "᠎ ᠎a", "x" * 3000 + " y" * 3000, "word,word;word*#%w"]


def test_token_store(make, documents, pairs):
    rng = random.Random(9)
    mixed_ = ["".join(rng.choices([*"abé1 \n\t'!.,　\xa0 ", "'s", "  ", "\U0001f600", "²", "½", "ª", "ÿ", "×"], k=rng.randint(0, 30))) for _ in range(500)]
    texts = [*ODD, *mixed_]
    got = {r.doc_id: tuple(r[1:]) for r in token_store.store(make(texts, CLASH), PATH).collect()}
    assert got == brute.token_rows(list(enumerate(texts)), PATH)
    assert {r.doc_id: tuple(r[1:]) for r in token_store.store(documents, PATH).collect()} == brute.token_rows(pairs, PATH)
    assert token_store.store(make([]), PATH).count() == 0


def test_another_tokenizer(make):
    """One that lowers and drops white space: the library does it all."""
    path = queries.tokenizer_path("word_bpe_49k.json")
    texts = [*ODD, "Some Words here, don't they?"]
    assert not token_store.shared_encoder(path).byte_level and token_store.shared_encoder(PATH).byte_level
    assert {r.doc_id: tuple(r[1:]) for r in token_store.store(make(texts), path).collect()} == brute.token_rows(list(enumerate(texts)), path)


def test_long_texts(make):
    """Far longer than any of the tables, in the operators on words and tokens."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefg", k=5))
    own = [word() for _ in range(150_000)]
    texts = [" ".join(own), "x " + " ".join(own[70_000:70_080]), " ".join(own[:30]) + " y"]
    docs = make(texts)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_cover.dedup(docs).collect()} == brute.repeated_windows(list(enumerate(texts)))
    assert {r.doc_id: tuple(r[1:]) for r in token_store.store(docs, PATH).collect()} == brute.token_rows(list(enumerate(texts)), PATH)


def test_token_files_in_small_segments(spark, make, tmp_path):
    texts = ODD * 3
    path = f"file://{tmp_path}/tokens"
    token_store.write(make(texts), path, PATH, segment_tokens=50)
    rows = token_store.read_documents(spark, path, with_ids=True).orderBy("start").collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == brute.token_rows(list(enumerate(texts)), PATH)
    assert [len(r.ids) for r in rows] == [r.n_tokens for r in rows]
    assert spark.read.parquet(path).count() > 3
    assert all(r.ids[-1] == token_store.END_ID for r in rows)


def test_ans_round_trip():
    rng = np.random.default_rng(1)
    for ids in (np.array([5]), np.zeros(10_000, int), rng.integers(0, 50_257, 30_000), rng.zipf(1.3, 70_001) % 50_257, np.arange(50_257)):
        ids = ids.astype(np.uint32)
        parts = token_store.compress(ids)
        assert (token_store.expand(*parts) == ids).all()
        m = -(-len(ids) // min(token_store.LANES, len(ids)))
        assert (token_store.expand(*parts, only=slice(0, 1)) == ids[:m]).all()
        assert (token_store.expand(*parts, only=slice(-1, None)) == ids[(len(ids) - 1) // m * m :]).all()


def test_damaged_files_are_noticed(spark, make, tmp_path):
    path = f"file://{tmp_path}/tokens"
    token_store.write(make(["some text here"]), path, PATH)
    bad = spark.read.parquet(path).withColumn("payload", F.unhex(F.concat(F.hex("payload"), F.lit("5A"))))
    bad.write.parquet(f"{path}2")
    with pytest.raises(Exception, match="damaged"):
        token_store.read_documents(spark, f"{path}2").collect()
