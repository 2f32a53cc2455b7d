"""Training of the quality rules: hidden labels of lines, under bounds from the labels of documents."""

import itertools
import random

import numpy as np
import pytest

from hirelens.llm import knn_quality, quality_rules


def junk(rng):
    return rng.choice([" | ".join(f"c{rng.randint(0, 99)}" for _ in range(9)), "### ".join(f"x{rng.randint(0, 99)}" for _ in range(9)), " ".join(["again"] * 9)])


def prose(rng):
    return " ".join(f"word{rng.randint(0, 9999)}" for _ in range(rng.randint(8, 11))) + "."


def halves(n, seed):
    """Documents of half content and half boilerplate, with the true labels of their lines."""
    rng = random.Random(seed)
    for k in range(n):
        blocks = [[0] * 6, [1] * 6] if k % 2 else [[1] * 3, [0] * 6, [1] * 3]
        truth = list(itertools.chain(*blocks))
        yield "\n".join((junk if x else prose)(rng) for x in truth), truth


def test_mixed_documents_get_both_labels(spark, make):
    """Trained on whole good and whole bad documents with a few strange lines, the field tells lines apart."""
    rng = random.Random(1)
    texts = []
    for k in range(200):
        own, odd = (junk, prose) if k % 2 else (prose, junk)
        texts.append("\n".join((odd if rng.random() < 0.15 else own)(rng) for _ in range(10)))
    labels = spark.createDataFrame([(k, 1 - k % 2, 0) for k in range(200)], "doc_id bigint, quality int, toxic int")
    weights = quality_rules.train(make(texts), labels)
    assert weights != quality_rules.START_WEIGHTS
    mixed = list(halves(40, 2))
    rows = quality_rules.assess(make([t for t, _ in mixed]), weights).orderBy("doc_id").collect()
    emit, step = np.array(weights["emit"]), np.array(weights["step"])
    right = total = 0
    for r, (text, truth) in zip(rows, mixed, strict=True):
        lines = text.encode().split(b"\n")
        sizes = np.array([len(x.split()) for x in lines])
        assert 0 < r.content_share < 1
        assert r.content_share == pytest.approx(sizes[np.array(truth) == 0].sum() / sizes.sum(), abs=0.2)
        right += (quality_rules.viterbi(quality_rules.features(lines), emit, step) == truth).sum()
        total += len(truth)
    assert right / total > 0.95


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_verdicts_against_all_label_sequences(make, spark, seed):
    """content_share and kept of whole documents, with the likeliest of all sequences."""
    rng = np.random.default_rng(seed)
    own = random.Random(seed)
    texts = ["\n".join(own.choice([junk, prose])(own) for _ in range(own.randint(1, 9))) for _ in range(30)] + [None, "", " \n "]
    weights = {"emit": rng.normal(size=(2, len(quality_rules.FEATURES))).tolist(), "step": rng.normal(size=(2, 2)).tolist()}
    emit, step = np.array(weights["emit"]), np.array(weights["step"])
    for r in quality_rules.assess(make(texts), weights).collect():
        lines = [x for x in (r.text or "").encode().split(b"\n") if x.strip()]
        share = 0.0
        if lines:
            score = quality_rules.features(lines) @ emit.T
            value = lambda s: sum(score[k, x] for k, x in enumerate(s)) + sum(step[a, b] for a, b in itertools.pairwise(s))  # noqa: B023, E731
            best = max(itertools.product((0, 1), repeat=len(lines)), key=value)
            share = sum(len(x.split()) for x, label in zip(lines, best, strict=True) if not label) / len(r.text.split())
        assert r.content_share == pytest.approx(share)
        assert r.kept == (not r.base_failed and share >= quality_rules.MIN_CONTENT)


def test_marginals_against_all_label_sequences():
    rng = np.random.default_rng(7)
    content, other, step = rng.normal(size=(3, 5)), rng.normal(size=(3, 5)), rng.normal(size=(2, 2))
    sizes = (5, 3, 1)
    on = np.arange(5) < np.array(sizes)[:, None]
    at, edge = quality_rules.marginals(content, other, on, step)
    for d, n in enumerate(sizes):
        weight = {s: np.exp(sum((content, other)[x][d, k] for k, x in enumerate(s)) + sum(step[a, b] for a, b in itertools.pairwise(s))) for s in itertools.product((0, 1), repeat=n)}
        total = sum(weight.values())
        for k in range(5):
            assert at[d, k] == pytest.approx(sum(w for s, w in weight.items() if k < n and s[k] == 0) / total)
            for i, j in itertools.product((0, 1), repeat=2):
                if k < 4:
                    assert edge[d, k, i, j] == pytest.approx(sum(w for s, w in weight.items() if k + 1 < n and s[k : k + 2] == (i, j)) / total)


def test_a_repeated_doc_id_is_one_row_of_the_sample(spark, make):
    labels = spark.createDataFrame([(k % 8, k % 2, 0) for k in range(400)], "doc_id bigint, quality int, toxic int")
    rows = [(k % 8, "one | two | three | four" if k % 2 == 0 else "The last words of a good text.") for k in range(400)]
    seen = []
    fit = quality_rules.fit
    quality_rules.fit = lambda documents: seen.append(len(documents)) or fit(documents)
    try:
        quality_rules.train(make(rows), labels)
    finally:
        quality_rules.fit = fit
    assert seen == [8]


def test_late_lines_reach_the_fit(spark, make):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(8)], "doc_id bigint, quality int, toxic int")
    start = "\n".join(f"Line {k} is a plain sentence with some words." for k in range(100))
    plain, odd = [start] * 8, [start + "\n" + ("one | two | three | four" if k % 2 == 0 else "The last words of a good text.") for k in range(8)]
    late = quality_rules.train(make(odd), labels)
    assert late != quality_rules.train(make(plain), labels)
    at = quality_rules.FEATURES.index("pipes")
    assert late["emit"][1][at] > 0 > late["emit"][0][at]


def test_groups_do_not_change_the_fit(monkeypatch):
    rng = np.random.default_rng(2)
    documents = [(rng.random((n, len(quality_rules.FEATURES)), np.float32), n % 2) for n in (1, 2, 2, 3, 5, 8, 13, 70, 75)]
    whole = quality_rules.fit(documents)
    assert len(quality_rules.batches_of(documents, 20)) > 3
    monkeypatch.setattr(quality_rules.batches_of, "__defaults__", (20,))
    split = quality_rules.fit(documents)
    assert np.allclose(whole["emit"], split["emit"]) and np.allclose(whole["step"], split["step"])


def test_scores_do_not_know_ids(spark, make):
    """The same texts under other doc_ids, ties among neighbours included, get the same scores."""
    rng = random.Random(11)
    texts = [" ".join(rng.choices(["the", "a", "cat", "sat", "on", "mat"] if k % 2 else ["$$$", "BUY", "now", "###"], k=12)) for k in range(40)]
    texts += texts[:20]  # equal texts, with labels that differ

    def scores(ids):
        rows = make(list(zip(ids, texts, strict=True)))
        labels = spark.createDataFrame([(i, (k + (k >= 40)) % 2, 0) for k, i in enumerate(ids)], "doc_id bigint, quality int, toxic int")
        return {ids.index(r.doc_id): r.score for r in knn_quality.classify(rows, knn_quality.train(rows, labels)).collect()}

    ids = list(range(60))
    other = ids[::-1]
    assert scores(ids) == scores([7 * i + 5 for i in other])
