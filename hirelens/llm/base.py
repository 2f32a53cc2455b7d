"""What the operators share: the scratch folder, text columns as bytes, rolling hashes."""

from __future__ import annotations

import threading
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import shared

#: Shuffle files of a finished write are of no further use: its result is in the table.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Parquet tables in the shared folder that cut an operator's lineage.

    A lost executor costs the tasks of the running stage only, as finished
    stages are read back from these files. What an operator returns may read from them, so they stay
    until the end of the program, or of the block `with discarded():` they were made in.
    """

    _lock = threading.Lock()
    _writing = 0
    _before = "false"

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = shared.new_folder(spark, name)
        self.tables: list[str] = []

    def write(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        path = f"{self.root}/{name}"
        with self.cleaned():
            df.write.option("compression", codec).parquet(path)
        self.tables.append(name)
        return self.spark.read.schema(df.schema).parquet(path)

    @contextmanager
    def cleaned(self):
        """Shuffle files are deleted after the writes inside; the session's own setting is back after the last of them, in any thread."""
        with Scratch._lock:
            if not Scratch._writing:
                Scratch._before = self.spark.conf.get(CLEANUP)
                self.spark.conf.set(CLEANUP, "true")
            Scratch._writing += 1
        try:
            yield
        finally:
            with Scratch._lock:
                Scratch._writing -= 1
                if not Scratch._writing:
                    self.spark.conf.set(CLEANUP, Scratch._before)

    def drop(self, *names: str) -> None:
        """Deletes tables that no later step reads."""
        for name in names:
            shared.delete(self.spark, f"{self.root}/{name}")
        self.tables = [t for t in self.tables if t not in names]

    def drop_all_but(self, *names: str) -> None:
        self.drop(*(t for t in self.tables if t not in names))


#: Around a stage whose result has been written at the end: the tables of the operators called inside are deleted.
discarded = shared.temporary


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffled(rows: DataFrame) -> DataFrame:
    """A side of a join that grows with the input, which is never broadcast.

    Spark tells the size of a Parquet table from its compressed files: a million rows of two longs may take 7 MB there, less than
    spark.sql.autoBroadcastJoinThreshold, and hundreds in the driver.
    """
    return rows.hint("merge")


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    large = pa.types.is_large_string(column.type)
    return column.cast(pa.large_binary() if large else pa.binary()).to_pylist()


def small(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches in smaller ones, so that what is made of one at once stays small."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)
    pa.default_memory_pool().release_unused()


def binary_longs(column: pa.Array) -> Iterator[np.ndarray]:
    """Each value of a binary column as unsigned longs, without a copy."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].tolist()
    for a, b in zip(ends, ends[1:], strict=False):
        yield np.frombuffer(data, np.uint64, (b - a) // 8, a) if b > a else np.empty(0, np.uint64)


def doc_key(text: str = "text"):
    """Tells rows apart that carry one doc_id; rows alike in both are one document repeated."""
    return F.xxhash64(F.col(text))


def numbered(rows: DataFrame, key: str, order: Sequence[str], scratch: Scratch, name: str) -> DataFrame:
    """rows with `place`, from 0 among the rows of their key in this order (nulls first), and `many`, how many these are.

    All rows are sorted over all tasks, so a key with most of them is no one task's. A row knows its task and its
    number there; the keys' shares of tasks are counted, and what stands in earlier tasks is added. Rows that tie must be alike.
    """
    at = scratch.write(rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).withColumn("at", F.monotonically_increasing_id()), name)
    at = at.withColumn("task", F.shiftright("at", 33))  # the function's documented layout: task, then 33 bits of row number
    of_key = Window.partitionBy(key)  # a row for each task that has the key
    shares = at.groupBy(key, "task").agg(F.min("at").alias("first"), F.count("*").alias("here"))
    before = F.coalesce(F.sum("here").over(of_key.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("first")
    shares = scratch.write(shares.select(key, "task", before.alias("shift"), F.sum("here").over(of_key).alias("many")), f"{name}_shares")
    return at.join(shares, [key, "task"]).withColumn("place", F.col("at") + F.col("shift")).drop("at", "task", "shift")


# -- rolling hashes -----------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_U64 = np.uint64
_powers: list[np.ndarray] = [np.ones(1, _U64), np.ones(1, _U64)]
BYTE_CODES = np.random.default_rng(20_240_601).integers(1, 1 << 63, 256, dtype=np.uint64)


def _ladder(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 14)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, _U64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Sums of codes[i] * base**i modulo 2**64, from which the hash of any span follows."""
    up, _ = _ladder(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, _U64)
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return sums


def spans(sums: np.ndarray, starts, ends) -> np.ndarray:
    """Hashes of codes[starts:ends]; equal spans have equal hashes wherever they start."""
    _, down = _ladder(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def windows(sums: np.ndarray, length: int) -> np.ndarray:
    """Hashes of every window of this many codes."""
    n = len(sums) - length
    if n <= 0:
        return np.empty(0, _U64)
    _, down = _ladder(len(sums))
    return mix((sums[length:] - sums[:-length]) * down[:n])


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits, so that order by value is as good as random."""
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U64(29))) * _U64(0xA0761D6478BD642F)
    return x ^ (x >> _U64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window, by doubling."""
    have, low = 1, x
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    return low


def reading(alphabet: bytes) -> np.ndarray:
    """Codes of bytes by what a table for bytes.translate makes of them; what becomes white space parts words and has 0."""
    meant = np.frombuffer(alphabet, np.uint8)
    return np.where(np.isin(meant, list(b" \t\n\v\f\r")), _U64(0), BYTE_CODES[meant])


AS_IS, LOWER = reading(bytes(range(256))), reading(bytes(range(256)).lower())
#: Bytes of a long text whose words are coded at once.
WORD_PIECE = 1 << 18


def word_codes(text: bytes | None, read: np.ndarray = AS_IS, piece: int = WORD_PIECE) -> np.ndarray:
    """64-bit codes of the words of a text, in order: hashes of spans of bytes, so that no word is cut out or remembered.

    A long text is read in pieces; a word that runs over the end of one begins the next, which is longer if need be.
    """
    data = np.frombuffer(text or b"", np.uint8)
    found, begin, size = [np.empty(0, _U64)], 0, piece
    while begin < len(data):
        own = data[begin : begin + size]
        codes = np.zeros(len(own) + 2, _U64)  # a gap at each end
        codes[1:-1] = read[own]
        inside = codes != 0
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        ahead = len(own)
        if begin + ahead < len(data) and len(ends) and ends[-1] == ahead:
            ahead = int(starts[-1])
            if not ahead:
                size *= 2
                continue
            starts, ends = starts[:-1], ends[:-1]
        found.append(spans(prefix_sums(codes[1:-1]), starts, ends))
        begin, size = begin + ahead, piece
    return found[1] if len(found) == 2 else np.concatenate(found)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted half-open spans without overlap or touch, covering the same places."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(starts[1:] > ends[:-1]) + 1
    return starts[np.r_[0, new]], ends[np.r_[new - 1, len(ends) - 1]]
