"""Operator 6, quality classifier: nearest-neighbour voting in a latent semantic space.

Terms are hashed words and word pairs, hashed byte pairs, hashed triples of character classes, and
bins of a few counts (shares of repeated words, capitals, symbols). Weighted by inverse
document frequency and reduced by a truncated singular value decomposition they
give one unit vector for a text. The labelled vectors are broadcast: their
number and width are parameters, so they take at most
2 * sample_docs * width * 4 bytes. Each batch of documents is compared with all
of them by matrix products, block by block, and the k nearest vote with a power
of their cosine.

Edge cases: null and empty texts have no terms, hence no neighbours, and get the
share of good labels in the sample (with a balanced sample 0.5); the same holds
for every text if there are no labels of both kinds. Repeated rows get equal
scores, which are rounded to four places. Cosines count to the nearest 2**-20; of labelled vectors at one
distance the one whose text has the smaller hash is nearer. Of repeated labels of one doc_id the better one counts, of
repeated documents the text that is first in order is learned from. Very long texts are read whole, an empty
table gives an empty result, and columns other than doc_id and text are not read. Nothing but the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import LOWER, mix, small, text_bytes, word_codes

#: Bound of the training sample, for each label, and sizes of the model.
SAMPLE_DOCS = 1500
WORDS, PAIRS, SHAPES, BINS = 2048, 4096, 1024, 12  # PAIRS is a power of two
WIDTH, NEIGHBOURS, POWER, BLOCK = 48, 15, 12, 512
COUNTS = 6
TERMS = PAIRS + SHAPES + COUNTS * BINS + WORDS

_CLASS = np.full(256, 7, np.int64)
for _k, _group in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\n", b".,;:?'\"()-", b"#*$%&|<>=_~^\\/{}[]@+", b"!")):
    _CLASS[list(_group)] = _k


def terms(text: bytes) -> np.ndarray:
    """Weights of the hashed terms of one text."""
    out = np.zeros(TERMS, np.float32)
    b = np.frombuffer(text, np.uint8).astype(np.int64)
    if not len(b):
        return out
    if len(b) > 1:
        pairs = np.bincount((b[:-1] * 2654435761 + b[1:] * 40503 >> 7) & (PAIRS - 1), minlength=PAIRS)
        out[:PAIRS] = np.log1p(pairs)
        out[:PAIRS] /= np.linalg.norm(out[:PAIRS])
    c = _CLASS[b]
    if len(b) > 2:
        shapes = np.bincount(c[:-2] * 64 + c[1:-1] * 8 + c[2:], minlength=SHAPES)
        out[PAIRS : PAIRS + SHAPES] = np.sqrt(shapes)
        out[PAIRS : PAIRS + SHAPES] /= np.linalg.norm(out[PAIRS : PAIRS + SHAPES])
    words = word_codes(text)
    n, m = max(1, len(words)), len(b)
    of = np.bincount(c, minlength=8)
    same = np.count_nonzero(words[1:] == words[:-1]) / n
    counts = (len(np.unique(words)) / n, same, of[1] / m, of[5] / m, of[6] / m, min(1.0, m / n / 20))
    for k, x in enumerate(counts):
        out[PAIRS + SHAPES + k * BINS + min(BINS - 1, int(BINS * np.sqrt(x)))] = 0.5
    if len(words):
        own = word_codes(text, LOWER)
        both = np.r_[own, mix(own[:-1] * np.uint64(3) + own[1:])]
        out[-WORDS:] = np.log1p(np.bincount((mix(both) >> np.uint64(53)).astype(np.int64), minlength=WORDS))
        out[-WORDS:] *= 0.5 / np.linalg.norm(out[-WORDS:])
    return out


def learn(rows: np.ndarray, quality: np.ndarray, width: int = WIDTH) -> dict:
    """Inverse document frequencies, the projection, and the labelled vectors."""
    idf = np.log((1 + len(rows)) / (1 + (rows > 0).sum(0))).astype(np.float32) + 1
    x = rows * idf
    rng = np.random.default_rng(7)
    width = min(width, *x.shape)
    basis = np.linalg.qr(x.T @ (x @ rng.standard_normal((x.shape[1], width + 8), np.float32)))[0]
    for _ in range(3):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    turn = np.linalg.svd(x @ basis, full_matrices=False)[2][:width]
    project = (basis @ turn.T).astype(np.float32) * idf[:, None]
    return {"project": project, "vectors": unit(rows @ project), "quality": quality.astype(np.float32)}


def unit(x: np.ndarray) -> np.ndarray:
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def vote(rows: np.ndarray, model: dict | None, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Scores of a block of documents from the exact cosines with all labelled vectors."""
    if model is None:
        return np.full(len(rows), 0.5)
    near = np.rint(unit(rows @ model["project"]) @ model["vectors"].T * 2**20).astype(np.int64)
    n = near.shape[1]
    k = min(neighbours, n)
    ranked = near * -n + np.arange(n)  # without ties
    at = np.sort(np.argpartition(ranked, k - 1, axis=1)[:, :k], axis=1)
    weight = (np.maximum(np.take_along_axis(near, at, 1), 0) / 2**20) ** POWER
    total = weight.sum(1)
    prior = model["quality"].mean()
    score = np.where(total > 0, (weight * model["quality"][at]).sum(1) / np.maximum(total, 1e-300), prior)
    return np.round(score, 4)  # products of single precision differ a little with the size of a block


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict | None:
    """The model from at most sample_docs documents of each label, picked by a hash of doc_id."""
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    picked = [known.where(f"quality = {q}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs) for q in (0, 1)]
    few = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * sample_docs rows of two numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            made = [terms(t or b"") for t in text_bytes(batch.column("text"))]
            used = [np.flatnonzero(x) for x in made]
            places, values = ([x.astype(np.uint16).tobytes() for x in used], [x[u].tobytes() for x, u in zip(made, used, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column("text_key"), batch.column("quality"), pa.array(places, pa.binary()), pa.array(values, pa.binary())], names=["text_key", "quality", "places", "weights"])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(few, "doc_id")
    chosen = chosen.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # so that the bound holds for rows too
    chosen = chosen.select(F.xxhash64("text").alias("text_key"), "quality", "text")
    got = chosen.mapInArrow(run, "text_key bigint, quality int, places binary, weights binary").toArrow()
    got = got.sort_by([("text_key", "ascending"), ("quality", "ascending")])  # the order that decides ties; alike in both are alike
    quality = np.array(got["quality"].to_pylist())
    if len(set(quality.tolist())) < 2:
        return None
    rows = np.zeros((len(quality), TERMS), np.float32)
    for row, places, weights in zip(rows, got["places"].to_pylist(), got["weights"].to_pylist(), strict=True):
        row[np.frombuffer(places, np.uint16)] = np.frombuffer(weights, np.float32)
    return learn(rows, quality)


def classify(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, score and predicted for every document."""
    kept = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = text_bytes(batch.column("text"))
            score = np.concatenate([np.empty(0), *(vote(np.stack([terms(t or b"") for t in texts[k : k + BLOCK]]), kept.value) for k in range(0, len(texts), BLOCK))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
