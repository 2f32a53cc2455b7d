"""Operator 4, benchmark decontamination by winnowing.

Every run of T words holds T - K + 1 windows of K words. Of each such run the
window with the smallest hash is kept as its fingerprint, so any span of T
words that a document shares with an item leaves the same fingerprint in both.

1. Fingerprints of the benchmark, and its windows of T words, become tables. An item of
   fewer than T words is one window, and its own fingerprint.
2. Fingerprints of documents are joined with those of the benchmark. These are 8 bytes each: up to PRINTS
   of them are broadcast, sorted, and sought in the worker; beyond that, the documents' fingerprints
   are shuffled to them.
3. Each match is extended to the windows of T words around it, and these are joined with those of the
   benchmark by 128 bits of hash.

So neither the text of the benchmark nor an index of it stands in the memory of a task, and documents
are read once, or twice beyond PRINTS. Frequent windows: places are found by a semi join and items by windows that
are distinct for a document, so an occurrence is never multiplied by items; both joins are on tables that are
written first, which adaptive execution can split.

Edge cases: null, empty and wordless texts hit nothing and contain no item; an
item without words never occurs. Items with equal texts all occur together. A
null item_id takes part as the empty string. An empty benchmark hits nothing, an empty table gives an
empty result. Very long texts are read whole, in memory in proportion to the longest. Rows with equal
doc_id and text get equal results; a null doc_id is told apart by its text. Further columns
are carried by `clean` and not read by `scan`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Scratch, doc_key, merged, mix, prefix_sums, reading, sliding_min, small, text_bytes, windows, word_codes

T, K = 10, 5
#: Fingerprints that are broadcast at most: 64 MB, of some 28 million words.
PRINTS = 8_000_000

#: Words are lower-cased runs of ASCII letters, digits and anything beyond ASCII.
WORDS = reading(bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)))


def winnow(sums: np.ndarray, k: int, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the fingerprints; in each run of t words all places of the smallest hash."""
    grams = windows(sums, k)
    width = t - k + 1
    if len(grams) < width:
        return np.empty(0, np.int64), grams[:0]
    low = sliding_min(grams, width)
    at = np.flatnonzero(_is_a_minimum(grams, low, width))
    return at, grams[at]


def _is_a_minimum(grams: np.ndarray, low: np.ndarray, width: int) -> np.ndarray:
    """Whether a place holds the minimum of at least one of the runs over it."""
    found = np.zeros(len(grams), bool)
    for step in range(width):
        found[step : step + len(low)] |= grams[step : step + len(low)] == low
    return found


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _rows(columns: dict[str, list[np.ndarray]]) -> pa.RecordBatch:
    none = [np.empty(0, np.int64)]
    return pa.RecordBatch.from_arrays([_longs(np.concatenate(v or none)) for v in columns.values()], names=list(columns))


def _windows(codes: np.ndarray, sums: np.ndarray, size: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the windows of this many words that start at these places."""
    return windows(sums, size)[at], windows(prefix_sums(mix(codes)), size)[at]


def benchmark_tables(benchmark: DataFrame, scratch: Scratch, t: int = T, k: int = K) -> tuple[DataFrame, DataFrame]:
    """(size, print) and (size, a, b, item), both distinct: sizes below t are those of short items."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found: dict[str, list[np.ndarray]] = {"size": [], "a": [], "b": []}
            names: list[str] = []
            for name, text in zip(batch.column("item").to_pylist(), text_bytes(batch.column("text")), strict=True):
                own = word_codes(text, WORDS)
                if not len(own):
                    continue
                sums, size = prefix_sums(own), min(t, len(own))
                at = np.arange(len(own) - size + 1)
                a, b = _windows(own, sums, size, at)
                prints = winnow(sums, k, t)[1] if size == t else a
                names += [name] * len(at) + [None] * len(prints)
                found["size"].append(np.full(len(at) + len(prints), size))
                found["a"] += [a, prints]
                found["b"] += [b, np.zeros(len(prints), np.uint64)]
            batch = _rows(found)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string())], names=[*batch.schema.names, "item"])

    both = scratch.write(items.mapInArrow(run, "size bigint, a bigint, b bigint, item string").distinct(), "benchmark")
    return both.where("item is null").select("size", F.col("a").alias("print")), both.where("item is not null")


def fingerprints(own: np.ndarray, sizes: list[int], t: int, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, places, hashes) of a document: of each size of short items, and the winnowed ones."""
    sums = prefix_sums(own)
    for size in sizes:
        if size < t:
            hashes = windows(sums, size)
            yield size, np.arange(len(hashes)), hashes
        elif len(own) >= t:
            yield size, *winnow(sums, k, t)


def around(size: int, at: np.ndarray, n: int, t: int, k: int) -> np.ndarray:
    """Starts of the windows of this size that hold the fingerprints at these places."""
    if size < t:
        return at
    starts = at[:, None] - np.arange(t - k + 1)
    return np.unique(starts[(starts >= 0) & (starts + t <= n)])


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.searchsorted(known, x)
    at[at == len(known)] = 0
    return known[at] == x if len(known) else np.zeros(len(x), bool)


MARKS = "doc_id bigint, doc_key bigint, n_words bigint, size array<bigint>, start array<bigint>, a array<bigint>, b array<bigint>"
_MARK_NAMES = [x.split()[0] for x in MARKS.split(", ")]


def _marked(batch: pa.RecordBatch, found: list[tuple[int, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]]) -> pa.RecordBatch:
    """Rows of MARKS from the number of words of each document, and its (size, starts, a, b)."""
    counts = [sum(len(x[1]) for x in each) for _, each in found]
    ends = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
    parts = _rows({
        "size": [np.full(len(x[1]), x[0]) for _, each in found for x in each],
        **{name: [x[k] for _, each in found for x in each] for k, name in ((1, "start"), (2, "a"), (3, "b"))},
    })
    lists = [pa.ListArray.from_arrays(ends, x) for x in parts.columns]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("doc_key"), pa.array([n for n, _ in found], pa.int64()), *lists], names=_MARK_NAMES)


def _candidates(texts: DataFrame, prints: DataFrame, scratch: Scratch, t: int, k: int, most: int) -> DataFrame:
    """MARKS of every text: windows around fingerprints that the benchmark has too."""
    spark = texts.sparkSession
    few = prints.limit(most + 1).count() <= most
    sizes = sorted(r.size for r in prints.select("size").distinct().collect())  # t at most
    if few:
        got = prints.toArrow()  # most rows of two numbers
        table = {n: np.unique(got["print"].to_numpy()[got["size"].to_numpy() == n].astype(np.int64).view(np.uint64)) for n in sizes}
        known = spark.sparkContext.broadcast(table)

        def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in small(batches):
                found = []
                for text in text_bytes(batch.column("text")):
                    own = word_codes(text, WORDS)
                    hits = ((n, at[_among(hashes, known.value[n])]) for n, at, hashes in fingerprints(own, sizes, t, k))
                    found.append((len(own), [(n, *_extended(own, n, at, t, k)) for n, at in hits if len(at)]))
                yield _marked(batch, found)

        return scratch.write(texts.mapInArrow(seek, MARKS), "marks")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            columns: dict[str, list[np.ndarray]] = {"doc_id": [], "doc_key": [], "size": [], "print": [], "place": []}
            for doc, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("doc_key").to_pylist(), text_bytes(batch.column("text")), strict=True):
                for n, at, hashes in fingerprints(word_codes(text, WORDS), sizes, t, k):
                    for name, x in zip(columns, (np.full(len(at), doc), np.full(len(at), key), np.full(len(at), n), hashes, at), strict=True):
                        columns[name].append(x)
            yield _rows(columns)

    every = scratch.write(texts.mapInArrow(emit, "doc_id bigint, doc_key bigint, size bigint, print bigint, place bigint"), "prints")
    near = every.join(prints, ["size", "print"]).groupBy("doc_id", "doc_key").agg(F.collect_set(F.struct("size", "place")).alias("near"))  # of one document
    near = scratch.write(near, "near")
    scratch.drop("prints")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = []
            for text, places in zip(text_bytes(batch.column("text")), batch.column("near").to_pylist(), strict=True):
                own = word_codes(text, WORDS)
                by_size = {n: np.array(sorted(p["place"] for p in places or () if p["size"] == n), np.int64) for n in sizes}
                found.append((len(own), [(n, *_extended(own, n, at, t, k)) for n, at in by_size.items() if len(at)]))
            yield _marked(batch, found)

    both = texts.join(near, ["doc_id", "doc_key"], "left").select("doc_id", "doc_key", "text", "near")
    return scratch.write(both.mapInArrow(extend, MARKS), "marks")


def _extended(own: np.ndarray, size: int, at: np.ndarray, t: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = around(size, at, len(own), t, k)
    return starts, *_windows(own, prefix_sums(own), size, starts)


#: Stands for a null doc_id.
_NO_ID = -(1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("doc_id"), F.coalesce(doc_key(), F.lit(0)).alias("doc_key"), "text")


def _found(docs: DataFrame, benchmark: DataFrame, t: int, k: int, most: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """MARKS of every row; the candidate windows (doc_id, doc_key, start, size, a, b) that are in the benchmark; its windows."""
    scratch = Scratch(docs.sparkSession, "decontam")
    prints, known = benchmark_tables(benchmark, scratch, t, k)
    marks = _candidates(_keyed(docs), prints, scratch, t, k, most)
    each = marks.where(F.size("start") > 0).dropDuplicates(["doc_id", "doc_key"]).select("doc_id", "doc_key", F.explode(F.arrays_zip("size", "start", "a", "b")).alias("w")).select("doc_id", "doc_key", "w.*")
    distinct = scratch.write(known.select("size", "a", "b").distinct(), "windows")
    return marks, scratch.write(each.join(distinct, ["size", "a", "b"], "left_semi"), "hits"), known


def scan(docs: DataFrame, benchmark: DataFrame, t: int = T, k: int = K, most: int = PRINTS) -> DataFrame:
    """doc_id, n_words, the merged hit spans in words and the sorted item_ids that occur, for every row of docs."""
    marks, hits, known = _found(docs, benchmark, t, k, most)
    spans = hits.groupBy("doc_id", "doc_key").agg(F.array_sort(F.collect_list(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("spans"))  # of one document
    items = hits.select("doc_id", "doc_key", "size", "a", "b").distinct().join(known, ["size", "a", "b"]).groupBy("doc_id", "doc_key").agg(F.sort_array(F.collect_set("item")).alias("hit_items"))
    both = marks.select("doc_id", "doc_key", "n_words").join(spans.join(items, ["doc_id", "doc_key"]), ["doc_id", "doc_key"], "left")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for batch in small(batches):
            merged_spans = [merged(np.array([x["start"] for x in s or ()], np.int64), np.array([x["end"] for x in s or ()], np.int64)) for s in batch.column("spans").to_pylist()]
            columns = [pa.array([x[i].tolist() for x in merged_spans], longs) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), *columns, batch.column("hit_items")], names=["doc_id", "n_words", "hit_starts", "hit_ends", "hit_items"])

    found = both.select(F.nullif("doc_id", F.lit(_NO_ID)).cast(kind).alias("doc_id"), "n_words", "spans", F.coalesce("hit_items", F.array().cast("array<string>")).alias("hit_items"))
    return found.mapInArrow(join_up, f"doc_id {kind}, n_words bigint, hit_starts array<bigint>, hit_ends array<bigint>, hit_items array<string>")


def clean(docs: DataFrame, benchmark: DataFrame, t: int = T, k: int = K, most: int = PRINTS) -> DataFrame:
    """docs, with all their columns, without the rows that contain a window of the benchmark."""
    hits = _found(docs, benchmark, t, k, most)[1].select(F.col("doc_id").alias("hit_id"), F.col("doc_key").alias("hit_key")).distinct()
    same = (F.coalesce(docs["doc_id"].cast("bigint"), F.lit(_NO_ID)) == hits["hit_id"]) & (F.coalesce(F.xxhash64(docs["text"]), F.lit(0)) == hits["hit_key"])
    return docs.join(hits, same, "left_anti")


def report(found: DataFrame) -> DataFrame:
    """The digest of scan(): counts, hash of the item ids, and the verdict, by document."""
    n_hit = F.aggregate(F.arrays_zip("hit_starts", "hit_ends"), F.lit(0).cast("bigint"), lambda a, x: a + x["hit_ends"] - x["hit_starts"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )

