"""Operator 3, substring dedup with difference-cover anchors.

COVER is a perfect difference set modulo PERIOD: for any two places i and j one
step k < PERIOD brings both i + k and j + k onto the cover. So of each window of
WINDOW words, anchors of WINDOW - PERIOD + 1 words are hashed only at places on
the cover, a fifth of all, and two documents that share a window share an
anchor inside it at the same distance from its start.

1. Anchors of all documents are counted; those of two or more documents stay.
2. Around these, and nowhere else, whole windows are hashed: the extension.
3. The smallest doc_id of each window is aggregated; windows of larger doc_ids go.

No pairs are formed: a passage of many documents costs one row for each of its
places, pre-aggregated before the shuffle, and joins back to a hash are split by
adaptive execution where one hash is frequent.

Edge cases: null, empty and short texts lose nothing; rows without doc_id have
no order and neither lose words nor take any; rows with one doc_id never take
words from each other, so repeated rows lose the same; very long texts are read whole, in
memory in proportion to the longest; an empty table gives an empty result; columns other
than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Scratch, doc_key, merged, mix, prefix_sums, small, text_bytes, windows, word_codes

WINDOW = 50
#: A perfect difference set of six residues modulo 31.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)


def anchors(sums: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places on the cover and the hashes of the anchors that start there."""
    size = window - PERIOD + 1
    n = len(sums) - size
    at = (np.arange(0, max(n, 0), PERIOD)[:, None] + np.array(COVER)).ravel()
    at = at[at < n]
    return at, windows(sums, size)[at] if n > 0 else np.empty(0, np.uint64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _repeat(values: list, counts: list[int], kind: pa.DataType) -> pa.Array:
    return pa.array(np.repeat(np.array(values, np.int64), counts), kind)


def removed(docs: DataFrame, scratch: Scratch, window: int = WINDOW) -> DataFrame:
    """doc_id, doc_key, and the merged spans of words to remove, for documents that lose any."""
    texts = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), doc_key().alias("doc_key"), "text")

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = [anchors(prefix_sums(word_codes(t)), window) for t in text_bytes(batch.column("text"))]
            counts = [len(a) for a, _ in found]
            if sum(counts):
                places, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([_signed(hashes), _repeat(batch.column("doc_id").to_pylist(), counts, pa.int64()), pa.array(places.astype(np.int32))], names=["anchor", "doc_id", "place"])

    marks = scratch.write(texts.select("doc_id", "text").mapInArrow(sample, "anchor bigint, doc_id bigint, place int"), "anchors")
    shared = marks.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("anchor")
    shared = scratch.write(shared, "shared")  # on its own, so that its shuffle is gone before the next
    near = scratch.write(marks.join(shared, "anchor").select("doc_id", "place"), "near")
    scratch.drop("anchors", "shared")
    near = near.groupBy("doc_id").agg(F.collect_list("place").alias("places"))  # of one document

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            hashes, checks, places = [], [], []
            for text, marked in zip(text_bytes(batch.column("text")), batch.column("places").to_pylist(), strict=True):
                own = word_codes(text)
                low = np.unique(np.array(marked, np.int64))
                starts, ends = merged(low - PERIOD + 1, low + 1)
                lengths = ends - starts
                at = np.repeat(starts - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(lengths.sum())
                at = at[(at >= 0) & (at + window <= len(own))]
                hashes.append(windows(prefix_sums(own), window)[at])
                checks.append(windows(prefix_sums(mix(own)), window)[at].view(np.int64).astype(np.int32))
                places.append(at.astype(np.int32))
            counts = [len(x) for x in places]
            if sum(counts):
                keys = [_repeat(batch.column(c).to_pylist(), counts, pa.int64()) for c in ("doc_id", "doc_key")]
                yield pa.RecordBatch.from_arrays([_signed(np.concatenate(hashes)), pa.array(np.concatenate(checks)), *keys, pa.array(np.concatenate(places))], names=["hash", "check", "doc_id", "doc_key", "place"])

    made = texts.join(near, "doc_id").select("doc_id", "doc_key", "text", "places").mapInArrow(extend, "hash bigint, check int, doc_id bigint, doc_key bigint, place int")
    made = scratch.write(made, "windows")
    first = made.groupBy("hash", "check").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("hash", "check", "low")
    first = scratch.write(first, "first")
    gone = made.join(first, ["hash", "check"]).where("doc_id > low").select("doc_id", "doc_key", "place")
    gone = scratch.write(gone.groupBy("doc_id", "doc_key").agg(F.collect_list("place").alias("places")), "gone")
    scratch.drop("windows", "near", "first")
    return gone


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept words for every document."""
    gone = removed(docs, Scratch(docs.sparkSession, "cover"), window).withColumnRenamed("doc_id", "gone_id").withColumnRenamed("doc_key", "gone_key")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows = []
            for text, places in zip(text_bytes(batch.column("text")), batch.column("places").to_pylist(), strict=True):
                own = (text or b"").split()
                kept = own
                if places:
                    at = np.array(places, np.int64)
                    steps = np.zeros(len(own) + 1, np.int64)
                    np.add.at(steps, at, 1)
                    np.add.at(steps, at + window, -1)
                    kept = [own[k] for k in np.flatnonzero(np.cumsum(steps)[:-1] == 0).tolist()]
                left = b" ".join(kept)
                rows.append((len(own), len(own) - len(kept), hashlib.sha256(left).hexdigest(), left.decode(errors="replace")))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    keyed = docs.select("doc_id", "text", doc_key().alias("doc_key"))
    both = keyed.join(gone, (F.col("doc_id") == F.col("gone_id")) & (F.col("doc_key") == F.col("gone_key")), "left").select("doc_id", "text", "places")
    return both.mapInArrow(finish, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
