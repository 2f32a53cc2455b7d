"""Operator 2, token ids in binary files coded by a range asymmetric numeral system.

A table of segments in ascending order of documents: by doc_id, or in the order in which the
rows of written files stand. The order of segments is that of (shard, segment). Each segment is one row:

* `freqs`: the segment's static frequency table, shared by all of its blocks:
  zlib of the used ids (uint32) and their frequencies (uint32), scaled to sum 2**SCALE;
* `heads`, `payload`: LANES interleaved blocks. Block j codes the contiguous ids
  [j * m, (j + 1) * m) of the segment independently of the others; its head is a
  checkpoint: its first state and the place of its words (uint32) in the payload;
* `ids_crc32` and `payload_crc32`: checksums, verified when read;
* `doc_ids`, `doc_tokens`: the documents and how many ids each of them has.

Blocks of a segment advance in step as lanes of numpy vectors, and any block can
be decoded alone from its checkpoint. The container is Parquet, so files are
committed by task, land in any store that Spark writes to, and a lost
executor's segments are written again.

Edge cases: a null or empty text is the end id alone; a null doc_id comes first;
rows with one doc_id follow the order of their texts; an empty table gives no
segments. A segment closes after SEGMENT_TOKENS ids, at the end of a document,
so memory is bounded by that and the longest text. Columns other than doc_id and text
are not read, whatever their names.
"""

from __future__ import annotations

import gc
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import Scratch

END_ID = 2
SEGMENT_TOKENS = 2_000_000
LANES = 4096
SCALE = 20
_LOW = np.uint64(1 << 31)
_U32, _MASK, _M = np.uint64(32), np.uint64((1 << SCALE) - 1), np.uint64(SCALE)

#: White space as Unicode defines it, which differs from that of Python's re.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
#: Where the byte-level pre-tokenizer always divides: before white space, between its last sign and a word,
#: and between a word of letters and a mark that is none.
_PIECES = re.compile(f" ?[{_LETTER}]+(?![^{_SPACE},.;:!?*#%&$])| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


#: Marks after a word of letters, from which the pre-tokenizer divides them.
_MARKS = ",.;:!?"
_WORD = re.compile(f"[{_LETTER}]+")


def _alphabet() -> list[str]:
    """The sign that stands for each byte in the vocabulary: itself if it can be seen, else the next free one."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(rest)) for b in range(256)]


_SIGNS = dict(enumerate(_alphabet()))
_BLANK = _SIGNS[32]


class Encoder:
    """The tokenizer with a bounded memory of words already encoded.

    Lines of words with one blank between them are put together from `front` (no blank before) and
    `inner` (one blank before). Texts with other white space go by _PIECES. Both know where a byte-level
    pre-tokenizer divides; with a tokenizer that works in another way the library encodes every text as a whole.
    """

    LIMIT = 600_000

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        before, model = self.tokenizer.pre_tokenizer, self.tokenizer.model
        self.byte_level = (
            self.tokenizer.normalizer is None and isinstance(before, ByteLevel) and before.use_regex and not before.add_prefix_space
            and isinstance(model, BPE) and not (model.dropout or model.unk_token or model.continuing_subword_prefix or model.end_of_word_suffix)
        )
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.line_feed = self._encode(["\n"])[0] if self.byte_level else b""
        self.front: dict[str, bytes] = {"": b""}
        self.inner: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32.

        Nothing made here refers to itself, so the search for such garbage, a fifth of the time, waits meanwhile.
        """
        if len(self.front) + len(self.inner) + len(self.pieces) > self.LIMIT:
            self.forget()
        collects = gc.isenabled()
        gc.disable()
        try:
            return [self._one(text) for text in texts]
        finally:
            if collects:
                gc.enable()

    def _one(self, text: str) -> bytes:
        if not self.byte_level or any(s in text for s in self.special):  # what the library makes of those reaches over words
            return self._encode([text])[0]
        if "\n\n\n" in text or "\n\n " in text or text.endswith("\n\n"):  # line feeds that make one token
            return self._by_pieces(text)
        words: list[str] = []
        found: list[bytes | None] = []
        for line in text.split("\n"):
            own = line.split(" ")
            words += own
            found.append(self.front.get(own[0]))
            found.extend(map(self.inner.get, islice(own, 1, None)))
            words.append("")
            found.append(self.line_feed)
        del found[-1]
        try:
            return b"".join(found)
        except TypeError:  # some are new
            return b"".join(found) if self._learn(words, found) else self._by_pieces(text)

    def _learn(self, words: list[str], found: list[bytes | None]) -> bool:
        """Encodes the words that are not found and puts them in; false if one has white space at an end."""
        new: list[tuple[int, dict[str, bytes], str, str, str]] = []
        odd: dict[str, None] = {}
        feed, front, inner = self.line_feed, self.front, self.inner
        for k in [k for k, ids in enumerate(found) if ids is None]:
            word = words[k]
            stem = word.rstrip(_MARKS)
            letters = stem.isalpha() if stem.isascii() else _WORD.fullmatch(stem)
            if not letters:
                if not word or word[0].isspace() or word[-1].isspace():
                    return False
                stem = word
            inside = k > 0 and found[k - 1] is not feed
            known = inner if inside else front
            if letters:
                ids = known.get(stem)
                if ids is None:
                    ids = known[stem] = self._word(stem, inside)
                if len(stem) == len(word):
                    found[k] = ids
                    continue
                if (after := front.get(word[len(stem) :])) is not None:
                    found[k] = known[word] = ids + after
                    continue
            elif stem not in known:
                odd[" " * inside + stem] = None
            marks = word[len(stem) :]
            if marks not in front:
                odd[marks] = None
            new.append((k, known, word, stem, marks))
        for text, ids in zip(odd, self._encode(list(odd)) if odd else [], strict=True):
            if text[0] == " ":
                inner[text[1:]] = ids
            else:
                front[text] = ids
        for k, known, word, stem, marks in new:
            found[k] = known[word] = known[stem] + front[marks] if marks else known[stem]
        return True

    def _word(self, word: str, inside: bool) -> bytes:
        """Ids of one word of letters, which the pre-tokenizer leaves whole, with the blank before it or without."""
        signs = word if word.isascii() else word.encode().decode("latin-1").translate(_SIGNS)
        if inside:
            signs = _BLANK + signs
        return array("I", [t.id for t in self.tokenizer.model.tokenize(signs)]).tobytes()

    def _by_pieces(self, text: str) -> bytes:
        pieces = _PIECES.findall(text)
        new = [p for p in dict.fromkeys(pieces) if p not in self.pieces]
        self.pieces.update(zip(new, self._encode(new), strict=True))
        return b"".join(map(self.pieces.__getitem__, pieces))


@lru_cache(1)
def shared_encoder(path: str) -> Encoder:
    """One for each worker process, so that tasks find the pieces of those before them."""
    return Encoder(path)


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Used ids and their scaled frequencies, each at least 1, summing to 2**SCALE."""
    count = np.bincount(ids)
    used = np.flatnonzero(count)
    count = count[used]
    whole = 1 << SCALE
    scaled = 1 + (count * ((whole - len(used)) / len(ids))).astype(np.int64)
    scaled[np.argmax(scaled)] += whole - scaled.sum()
    return used.astype(np.uint32), scaled.astype(np.uint32)


def compress(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(frequency table, block heads, payload) of the ids of one segment."""
    used, freq = frequencies(ids)
    first = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    f64 = freq.astype(np.uint64)
    number = np.zeros(int(used[-1]) + 1, np.int64)
    number[used] = np.arange(len(used))
    index = number[ids]
    lanes = min(LANES, len(ids))
    m = -(-len(ids) // lanes)
    lanes = -(-len(ids) // m)
    sizes = np.full(lanes, m)
    sizes[-1] = len(ids) - m * (lanes - 1)
    state = np.full(lanes, _LOW)
    words, owner = [], []
    starts = np.arange(lanes) * m
    all_lanes = np.arange(lanes)
    for t in range(m - 1, -1, -1):  # backwards, so that decoding runs forwards
        on = all_lanes if t < sizes[-1] else all_lanes[:-1]
        s = index[starts[: len(on)] + t]
        f, x = f64[s], state[: len(on)]
        full = np.flatnonzero(x >= f << np.uint64(63 - SCALE))
        if len(full):
            words.append((x[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            owner.append(full.astype(np.uint16))
            x[full] >>= _U32
        high = x // f
        state[: len(on)] = (high << _M) + (x - high * f) + first[s]
    words = np.concatenate(words)[::-1] if words else np.empty(0, np.uint32)
    owner = np.concatenate(owner)[::-1] if owner else np.empty(0, np.uint16)
    order = np.argsort(owner, kind="stable")
    begins = np.searchsorted(owner[order], all_lanes)
    heads = np.empty(lanes, [("state", "<u8"), ("at", "<u4"), ("size", "<u4")])
    heads["state"], heads["at"], heads["size"] = state, begins, sizes
    table = zlib.compress(used.astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 1)
    return table, heads.tobytes(), words[order].astype("<u4").tobytes()


def expand(table: bytes, heads: bytes, payload: bytes, only: slice = slice(None)) -> np.ndarray:
    """The ids of the chosen blocks of a segment, in order."""
    both = np.frombuffer(zlib.decompress(table), "<u4")
    used, freq = both[: len(both) // 2], both[len(both) // 2 :].astype(np.uint64)
    first = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    slots = np.repeat(np.arange(len(used), dtype=np.uint32), freq.astype(np.int64))
    head = np.frombuffer(heads, [("state", "<u8"), ("at", "<u4"), ("size", "<u4")])[only]
    words = np.append(np.frombuffer(payload, "<u4"), np.uint32(0))
    if not len(head):
        return np.empty(0, np.uint32)
    state, at, sizes = head["state"].astype(np.uint64), head["at"].astype(np.int64), head["size"].astype(np.int64)
    out = np.zeros((int(sizes.max()), len(head)), np.uint32)
    for t in range(len(out)):
        on = len(head) if t < sizes[-1] else len(head) - 1
        x = state[:on]
        low = x & _MASK
        s = slots[low]
        out[t, :on] = s
        x = freq[s] * (x >> _M) + low - first[s]
        short = np.flatnonzero(x < _LOW)
        if len(short):
            x[short] = (x[short] << _U32) | words[at[short]]
            at[short] += 1
        state[:on] = x
    if (state != _LOW).any():
        raise ValueError("a block does not end in its first state")
    flat = out.T.ravel() if (sizes == len(out)).all() else np.concatenate([out[:n, j] for j, n in enumerate(sizes)])
    return used[flat]


SEGMENT = "shard string, segment bigint, n_docs bigint, n_tokens bigint, doc_ids array<bigint>, doc_tokens array<bigint>, freqs binary, heads binary, payload binary, ids_crc32 bigint, payload_crc32 bigint"
_KINDS = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
_NAMES = [x.split()[0] for x in SEGMENT.split(", ")]


def _shard(name: str) -> str:
    """A partition's number or a file's name, with its numbers of one width, so that shards sort as text."""
    return re.sub(r"\d+", lambda m: m[0].zfill(10), name)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, segment_tokens: int = SEGMENT_TOKENS, as_stored: bool = False) -> None:
    """Writes the segments of docs (doc_id, text) in ascending order of doc_id.

    as_stored: in the order of the files that docs is read from instead, by file name and row, without a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, shard = shared_encoder(tokenizer), _shard(str(TaskContext.get().partitionId()))
        end = np.array([end_id], "<u4").tobytes()
        parts: list[bytes] = []
        owners: list[int | None] = []
        counts: list[int] = []
        first = total = 0

        def close() -> pa.RecordBatch:
            nonlocal parts, owners, counts, total
            ids = np.frombuffer(b"".join(parts), "<u4")
            table, heads, payload = compress(ids)
            row = (shard, first, len(owners), len(ids), owners, counts, table, heads, payload, zlib.crc32(ids), zlib.crc32(table + heads + payload))
            parts, owners, counts, total = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, _KINDS, strict=True)], names=_NAMES)

        done = after = 0
        shard_file = None
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                files = part.column("file").to_pylist() if as_stored else [None] * part.num_rows
                places = part.column("place").to_pylist() if as_stored else range(done, done + part.num_rows)
                done += part.num_rows
                own_ids = encoder.encode([t or "" for t in part.column("text").to_pylist()])
                for owner, ids, file, place in zip(part.column("doc_id").to_pylist(), own_ids, files, places, strict=True):
                    if as_stored:  # a task may have several parts of a file, between which others have theirs
                        if owners and (file != shard_file or place != after):
                            yield close()
                        if file != shard_file:
                            shard_file, shard = file, _shard(file)
                        after = place + 1
                    if not owners:
                        first = place
                    parts += [ids, end]
                    owners.append(owner)
                    counts.append(len(ids) // 4 + 1)
                    total += counts[-1]
                    if total >= segment_tokens:
                        yield close()
        if owners:
            yield close()

    own = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")]
    if as_stored:
        stored = docs.metadataColumn("_metadata")
        ordered = docs.select(*own, stored["file_name"].alias("file"), stored["row_index"].alias("place"))
    else:
        ordered = docs.select(*own).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    with Scratch(docs.sparkSession, "tokens").cleaned():
        ordered.mapInArrow(run, SEGMENT).write.option("compression", "uncompressed").option("parquet.block.size", 8 << 20).parquet(path)


def decode(batch: pa.RecordBatch) -> Iterator[tuple[dict, np.ndarray]]:
    """(row, ids) of each segment, after its checksums are verified."""
    for row in batch.to_pylist():
        if zlib.crc32(row["freqs"] + row["heads"] + row["payload"]) != row["payload_crc32"]:
            raise ValueError(f"segment {row['shard']}/{row['segment']}: damaged payload")
        ids = expand(row["freqs"], row["heads"], row["payload"])
        if zlib.crc32(ids.astype("<u4")) != row["ids_crc32"]:
            raise ValueError(f"segment {row['shard']}/{row['segment']}: damaged ids")
        yield row, ids


def read_documents(spark, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 by document, decoded from the files; ids too if asked for."""
    files = spark.read.schema(SEGMENT).parquet(path)
    shards = files.groupBy("shard").agg(F.sum("n_tokens").alias("in_shard"))
    # One row for each written partition meets in one task here: a few thousand longs.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("in_shard").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("shard", "segment", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("local_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                for row, ids in decode(batch.slice(k, 1)):
                    counts = np.array(row["doc_tokens"], np.int64)
                    ends = np.cumsum(counts)
                    begins = ends - counts
                    small = ids.astype("<u4")
                    crc = [zlib.crc32(small[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                    n = len(counts)
                    columns = [pa.array([row["shard"]] * n, pa.string()), pa.array(np.full(n, row["segment"], np.int64)), pa.array(row["doc_ids"], pa.int64()), pa.array(begins), pa.array(counts), pa.array(crc, pa.int64())]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(np.r_[begins, ends[-1:]].astype(np.int32)), pa.array(ids.astype(np.int64))))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "shard string, segment bigint, doc_id bigint, begin bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    names = [x.split()[0] for x in schema.split(", ")]
    found = files.select(*[n for n in _NAMES if n not in ("n_docs", "n_tokens")]).mapInArrow(run, schema)
    return (
        found.join(starts, ["shard", "segment"]).join(shards, "shard")
        .select("doc_id", (F.col("shard_start") + F.col("local_start") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
    )


def is_stored(docs: DataFrame) -> bool:
    """Whether docs is read from Parquet files, so that its rows have an order."""
    try:
        return "row_index" in docs.select(docs.metadataColumn("_metadata").alias("m")).schema["m"].dataType.names
    except AnalysisException:
        return False


def store(docs: DataFrame, tokenizer: str, end_id: int = END_ID, as_stored: bool = False) -> DataFrame:
    """Writes docs to the shared folder and returns what the files hold, by document."""
    spark = docs.sparkSession
    path = f"{Scratch(spark, 'token-files').root}/segments"
    write(docs, path, tokenizer, end_id, as_stored=as_stored)
    return read_documents(spark, path)
