"""Quality rules, classifier, personal data and decontamination."""

import random
import re

import ahocorasick  # noqa: F401
import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelens.llm import base, decontam, knn_quality, pii, quality_rules, queries

TEXTS = [None, "", " \n\t", "one", "a b c d " * 40, "word " * 100_000, "x\n\nx\n x\n", "é ñ z y " * 20, "The cat sat. " * 3 + "\nA | b | c |\n" * 30, "a@b.c"]
CLASH = {"n_words": "clash", "kept": 7, "score": "x", "hit_starts": 1}


def test_base_rules(make):
    rows = quality_rules.assess(make(TEXTS, CLASH), quality_rules.START_WEIGHTS).orderBy("doc_id").collect()
    for text, r in zip(TEXTS, rows, strict=True):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.base_rules(text)
        assert r.kept is False or not r.base_failed
        assert r.score == "x"


def test_base_rules_on_documents(documents, pairs):
    got = {r.doc_id: r[1:7] for r in quality_rules.assess(documents, quality_rules.START_WEIGHTS).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()}
    assert got == {i: brute.base_rules(t) for i, t in pairs}


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(50):
        rows, emit, step = rng.normal(size=(6, 3)), rng.normal(size=(2, 3)), rng.normal(size=(2, 2))
        score = lambda p: sum(rows[k] @ emit[x] for k, x in enumerate(p)) + sum(step[a, b] for a, b in zip(p, p[1:], strict=False))  # noqa: B023, E731
        best = max((tuple(int(c) for c in f"{k:06b}") for k in range(64)), key=score)
        assert tuple(quality_rules.viterbi(rows, emit, step)) == best


def test_rules_learn_from_labels(spark, sf_dir, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    weights = quality_rules.train(docs, labels)
    assert weights == quality_rules.train(docs.repartition(7), labels)
    got = quality_rules.assess(docs, weights).join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r.quality: r.kept for r in got.collect()}
    assert kept[1] > 0.98
    assert kept[0] < 0.1


def test_rules_without_labels(spark, make):
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality_rules.train(make(TEXTS), empty) == quality_rules.START_WEIGHTS
    assert quality_rules.assess(make([]), quality_rules.START_WEIGHTS).count() == 0


def test_classifier_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    model = knn_quality.train(docs, labels.where(~held))
    got = knn_quality.classify(docs, model).join(labels.where(held), "doc_id")
    right = got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.95
    assert got.where("score < 0 or score > 1").isEmpty()


def test_votes_against_single_vectors():
    """The scores of a block, with every cosine and every vote worked out one by one."""
    rng = np.random.default_rng(3)
    rows, quality = rng.random((40, 30)).astype(np.float32) * (rng.random((40, 30)) < 0.3), rng.integers(0, 2, 40)
    rows[20:25] = rows[3]  # ties
    model = knn_quality.learn(rows, quality, width=8)
    asked = np.vstack([rows[:10], rng.random((10, 30)).astype(np.float32), np.zeros((1, 30), np.float32)])
    got = knn_quality.vote(asked, model, neighbours=7)
    unit = lambda v: v / n if (n := float(np.linalg.norm(v))) > 1e-12 else v * 0
    for x, score in zip(asked, got, strict=True):
        own = unit(x.astype(np.float64) @ model["project"])
        near = sorted(((-round(float(own @ v) * 2**20), k) for k, v in enumerate(model["vectors"].astype(np.float64))))[:7]
        votes = [(max(0.0, -c / 2**20) ** knn_quality.POWER, quality[k]) for c, k in near]
        total = sum(w for w, _ in votes)
        want = sum(w * q for w, q in votes) / total if total else quality.mean()
        assert score == pytest.approx(want, abs=2e-3)
    assert set(knn_quality.vote(rows[20:25], model, neighbours=7).tolist()) == {got[3]}


def test_terms_tell_words_and_pairs():
    one, two, three = (knn_quality.terms(t)[-knn_quality.WORDS :] for t in (b"alpha beta gamma", b"ALPHA beta gamma", b"gamma beta alpha"))
    assert (one == two).all() and (one > 0).sum() == 5 and not (one == three).all()


def test_classifier_takes_a_row_for_each_labelled_document(spark, make, monkeypatch):
    labels = spark.createDataFrame([(k % 6, k % 2, 0) for k in range(300)], "doc_id bigint, quality int, toxic int")
    seen, learn = [], knn_quality.learn
    monkeypatch.setattr(knn_quality, "learn", lambda rows, quality: seen.append(rows.shape) or learn(rows, quality))
    model = knn_quality.train(make([(k % 6, f"text {k % 6} " * 9) for k in range(300)]), labels)
    assert seen == [(6, knn_quality.TERMS)] and len(model["quality"]) == 6


def test_held_out_without_doc_id(spark, make, tmp_path):
    make([(None, "some text"), (1, "more"), (2, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert {r.held_out for r in queries.op6_quality_classifier(spark, str(tmp_path)).where("doc_id is null").collect()} == {False}


def test_classifier_edges(spark, make):
    labels = spark.createDataFrame([(8, 1, 0), (4, 0, 0), (None, 1, 0), (3, None, 0), (5, 0, 0)], "doc_id bigint, quality int, toxic int")
    model = knn_quality.train(make(TEXTS), labels)
    rows = {r.doc_id: r for r in knn_quality.classify(make([*TEXTS, TEXTS[4]], CLASH), model).collect()}
    assert len(rows) == len(TEXTS) + 1
    assert rows[4].score == rows[len(TEXTS)].score
    assert rows[0].score == rows[1].score == pytest.approx(1 / 3, abs=1e-4)
    none = knn_quality.train(make(TEXTS), labels.where("quality = 1"))
    assert none is None
    assert {r.score for r in knn_quality.classify(make(TEXTS), none).collect()} == {0.5}
    assert knn_quality.classify(make([]), model).count() == 0


PERSONAL = [
    None, "", "a@b.c@d.e f%x@y.z", "@x.y a@b a@b..c a.b+c-d_%e@f-g.h-i.j.", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.255 1..2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112 5 5 5",
    "+1 (927) 555-7911 +1((( +12 +1.2.3.4.5.6.7.8.9.0.1.2.3.4.5.6 ++49 30 1234567-", "é@x.y ä1.2.3.4ü", "x" * 50_000 + "@a.b", "1" * 100_000, "@" * 10_000, "+1" * 5_000,
]


def test_personal_data(make, documents, pairs):
    rng = random.Random(4)
    mixed = ["".join(rng.choices(["a", "@", ".", "1", "2", " ", "-", "+", "(", "é", "b.c", "4111111111111111", "+1 555", "127.0.0.1"], k=rng.randint(1, 40))) for _ in range(2000)]
    texts = [*PERSONAL, *mixed]
    got = {r.doc_id: r for r in pii.scan(make(texts, {"spans": 1})).collect()}
    for k, text in enumerate(texts):
        base = brute.personal(text)
        assert got[k].base_sha256 == brute.sha(base), text
        assert ",".join(x for x in got[k].spans.split(",") if x.split(":")[0] in pii.BASE_KINDS) == base
    assert {r.doc_id: r.base_sha256 for r in pii.scan(documents).collect()} == {i: brute.sha(brute.personal(t)) for i, t in pairs}


def test_more_personal_data(make):
    text = 'see https://me:pw@host.org/x, IBAN: DE89 3704 0044 0532 0130 00. password=e3b3ed3cc8548923d6 token = "0641917ea4e9feb9" IBAN DE00 3704 0044 0532 0130 00 password: none'
    row = pii.scan(make([text]), redacted=True).first()
    assert [x.split(":")[0] for x in row.spans.split(",")] == ["email", "login", "account", "secret", "secret"] or [x.split(":")[0] for x in row.spans.split(",")] == ["login", "account", "secret", "secret"]
    assert "DE89" not in row.redacted and "e3b3ed" not in row.redacted and "me:pw" not in row.redacted and "DE00" in row.redacted
    assert pii.scan(make([])).count() == 0


def planted(rng):
    """(kind, text, what of it must be found) of each kind."""
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    name = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(3, 9)))
    key = "".join(rng.choices("0123456789abcdef", k=30)) + digits(2)
    yield "email", (x := f"{name()}.{digits(2)}@{name()}.example.com"), x
    yield "ip", (x := ".".join(str(rng.randint(0, 255)) for _ in range(4))), x
    yield "phone", (x := f"+{rng.randint(1, 99)} ({digits(3)}) 555-{digits(4)}"), x
    body = digits(rng.randint(12, 18))
    for d in "0123456789":
        yield "card" if brute.luhn(body + d) else "number", body + d, body + d
    yield "login", f"https://{(x := f'{name()}:{name()}@')}host.org/", x
    country = "".join(rng.choices("ABCDEFGH", k=2)), digits(16)
    value = int("".join(str(int(c, 36)) for c in country[1] + country[0] + "00"))
    yield "account", f"IBAN: {(x := f'{country[0]}{98 - value % 97:02d}{country[1]}')}", x
    yield "secret", f'{rng.choice(["token", "password", "API_KEY", "secret"])} = "{key}"', key


def test_recall_of_each_kind(make):
    """Every planted piece is found whole, under its kind, in any surroundings, and clean texts have none."""
    rng = random.Random(11)
    cases = [(kind, text, piece) for _ in range(40) for kind, text, piece in planted(rng)]
    filler = lambda: " ".join(rng.choices(["the", "of", "größe", "2.0.", "version 3.", "and,", "\n", "1234", "x=y", "CC BY-NC 4.0"], k=rng.randint(0, 30)))
    mark = lambda: rng.choice([" ", "\n", "\t"])
    texts = [filler() + " q" + mark() + text + mark() + "q " + filler() for _, text, _ in cases] + [filler() for _ in range(100)]
    rows = pii.scan(make(texts)).orderBy("doc_id").collect()
    for (kind, _, piece), text, r in zip(cases, texts, rows, strict=False):
        found = [x.split(":") for x in r.spans.split(",")]
        assert (kind, piece) in [(k, text[int(a) : int(b)]) for k, a, b in found], (kind, text, r.spans)
        assert r.n_spans == len(found)
    assert all(r.n_spans == 0 and r.spans == "" for r in rows[len(cases) :])


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("most", [decontam.PRINTS, 3])
def test_decontamination(spark, make, most):
    items = [(1, ITEM), (2, None), (3, ""), (4, "Short item"), (5, "one"), (None, "the the the the the the the the the the the"), (10, ITEM.upper() + " nu"), (7, "a b a b a b a b a b a b")]
    texts = [None, "", "!!", ITEM.replace(" ", ", ").title(), "x " + " ".join(ITEM.split()[:9]), "x " + " ".join(ITEM.split()[1:11]) + " y " + ITEM, "short ITEM, one", "the " * 5000, "b a " * 30, "beta " * 9]
    got = {r.doc_id: r[1:] for r in decontam.report(decontam.scan(make(texts, CLASH), bench(spark, items), most=most)).collect()}
    assert got == brute.contamination(list(enumerate(texts)), items)


def test_decontamination_of_documents(spark, sf_dir, documents, pairs):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = {r.doc_id: r[1:] for r in decontam.report(decontam.scan(documents, items)).collect()}
    assert got == brute.contamination(pairs, [(r.item_id, r.text) for r in items.collect()])
    assert any(r[4] for r in got.values())
    assert decontam.scan(documents, items.where("false")).where("size(hit_starts) > 0").isEmpty()
    assert decontam.scan(documents.where("false"), items).count() == 0


@pytest.mark.parametrize("most", [decontam.PRINTS, 0])
def test_decontamination_drops_rows(spark, make, most):
    """Whatever their other columns are called, and however often a row is stored."""
    hit = "and " + ITEM
    pairs = [(1, hit), (1, hit), (1, "clean text"), (None, hit), (None, "clean"), (2, None), (None, None), (3, ""), (4, hit.upper())]
    docs = make(pairs, {c: "x" for c in ("hit_id", "hit_key", "doc_key", "start", "size", "a", "item", "n_words", "hit_starts")})
    left = decontam.clean(docs, bench(spark, [(1, ITEM)]), most=most)
    assert left.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in left.collect()) == sorted([("1", "clean text"), ("None", "clean"), ("2", "None"), ("None", "None"), ("3", "")])
    found = decontam.report(decontam.scan(docs, bench(spark, [(1, ITEM)]), most=most))
    assert sorted((str(r.doc_id), r.n_words, r.contaminated) for r in found.collect()) == sorted(
        [("1", 13, True), ("1", 13, True), ("1", 2, False), ("None", 13, True), ("None", 1, False), ("2", 0, False), ("None", 0, False), ("3", 0, False), ("4", 13, True)]
    )


@pytest.mark.parametrize("most", [decontam.PRINTS, 100])
def test_decontamination_of_long_texts(spark, make, most):
    rng = random.Random(6)
    texts = [" ".join(str(rng.randint(0, 5000)) for _ in range(n)) for n in (150_000, 20, 3000)]
    texts[2] += " " + " ".join(texts[0].split()[149_000:149_040])
    items = [(1, " ".join(texts[0].split()[70_000:70_030])), (2, " ".join(texts[0].split()[149_010:149_030]))]
    got = {r.doc_id: r[1:] for r in decontam.report(decontam.scan(make(texts), bench(spark, items), most=most)).collect()}
    assert got == brute.contamination(list(enumerate(texts)), items)
    assert [got[k][1] for k in range(3)] == [50, 0, 20]


def test_decontamination_of_random_words(spark, make):
    rng = random.Random(2)
    items = [(k, " ".join(rng.choices("abc", k=rng.randint(0, 25)))) for k in range(30)]
    texts = [" ".join(rng.choices("abcd", k=rng.randint(0, 80))) for _ in range(200)]
    got = {r.doc_id: r[1:] for r in decontam.report(decontam.scan(make(texts), bench(spark, items))).collect()}
    assert got == brute.contamination(list(enumerate(texts)), items)


def test_words_are_those_of_the_pattern():
    text = "".join(map(chr, range(1, 700)))
    alone = lambda words, read: [base.word_codes(w.encode(), read)[0] for w in words]
    assert base.word_codes(text.encode(), decontam.WORDS).tolist() == alone(brute.bench_words(text), decontam.WORDS)
    assert base.word_codes(text.encode()).tolist() == alone(re.findall(brute.WORD, text), base.AS_IS)
    assert base.word_codes(text.encode(), base.LOWER).tolist() == alone(re.findall(brute.WORD, brute.lower(text)), base.AS_IS)


def test_codes_of_words_in_pieces():
    """Codes are those of the words alone, wherever a long text is cut; different words have different ones."""
    rng = random.Random(8)
    for text in [b"", None, b" \n", b"a", b" ab ", b"x" * 5000, b"y" * 70 + b" z " + b"x" * 300, bytes(range(256)) * 3, *(bytes(rng.choices(b"aB \t\xc3\x00", k=rng.randint(1, 300))) for _ in range(200))]:
        words = (text or b"").split()
        want = [base.word_codes(w)[0] for w in words]
        for piece in (1, 2, 7, 64, base.WORD_PIECE):
            assert base.word_codes(text, piece=piece).tolist() == want
        assert len(set(want)) == len(set(words))
