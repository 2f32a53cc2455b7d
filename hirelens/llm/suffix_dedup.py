"""Operator 10, substring dedup with an enhanced suffix array, by common-prefix interval tree.

`maximal_repeats` sorts the suffixes of a bounded set of texts, scans the
common-prefix lengths of neighbours with a stack, and reports each interval of
the tree whose occurrences differ in the byte to their left: the maximal repeats
of MIN_BYTES or more, with all occurrences. A text that stands for several equal
ones is a leaf that repeats by itself.

So that a bounded set holds all occurrences of a repeat, texts are cut by content:

1. Each window of MIN_BYTES bytes names the smallest hash among its GRAM-byte
   strings (the rightmost of equals). Equal windows name equal strings, at equal
   distance. Consecutive windows that name one place form a context: the bytes
   from the first window's start to the last window's end.
2. Names that occur once in the corpus are out: their windows occur once.
3. Equal contexts are aggregated into one, with their number. Equality is that of hashes, 64 bits of the name
   and 64 of a digest of the context; two contexts of one name are told apart by the digest alone, and no bytes are compared.
4. Different contexts of one name form a part and meet in one task, where the
   tree of their suffixes is built; a name with one context has a tree of one leaf.
5. A part of more than PART contexts is cut further by content: all its windows
   have a string in common, and each window has half of its other bytes, or more, to
   the left of that string or to the right. With this half the common string is longer, and
   the windows that share it form a part of their own, of shorter contexts. Equal
   windows stay together, and after eight cuts at most a part is a single window,
   so every part ends up small, and every repeat is settled by a tree.

`repeat_groups` gives the groups as tables, `dedup` what is left of the texts. A
repeat that runs over several contexts is a group in each of them.

Edge cases: null, empty and short texts lose nothing; very long texts are searched
in pieces of PIECE places that overlap, with the same result; rows without doc_id
take part; a row stored twice is repeated; repeats may overlap; an empty table
gives an empty result; extra columns, whatever their names, are not read and no row
is dropped for them. Strings are judged on the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import BYTE_CODES, Scratch, doc_key, merged, mix, prefix_sums, sliding_min, small, spans, text_bytes, windows

MIN_BYTES = 200
GRAM = 64
#: Contexts that are compared at once, of at most 2 * MIN_BYTES bytes each; a larger part is cut by content.
PART = 1000
#: Bytes of contexts that are sorted at once.
BATCH_BYTES = 1_500_000
#: Places of a long text are searched in pieces of so many, with overlap.
PIECE = 1 << 22

_LOW = np.uint64((1 << 24) - 1)


def contexts(text: bytes, size: int = MIN_BYTES, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(name, digest, first window, end) of the contexts of a text, in order."""
    codes = BYTE_CODES[np.frombuffer(text, np.uint8)]
    names, digests, firsts, ends = [], [], [], []
    width = size - gram + 1
    for begin in range(0, max(1, len(codes) - size + 1), PIECE):
        own = codes[begin : begin + PIECE + size - 1]
        if len(own) < size:
            break
        sums = prefix_sums(own)
        grams = windows(sums, gram)
        ranked = (grams & ~_LOW) | (_LOW - np.arange(len(grams), dtype=np.uint64))
        place = (_LOW - (sliding_min(ranked, width) & _LOW)).astype(np.int64)
        first = np.r_[0, np.flatnonzero(place[1:] != place[:-1]) + 1]
        last = np.r_[first[1:] - 1, len(place) - 1]
        place, end = place[first], last + size
        names.append(grams[place])
        digests.append(mix(spans(sums, first, end) + mix(((place - first) * 1024 + (last - first)).astype(np.uint64))))
        firsts.append(first + begin)
        ends.append(end + begin)
    if not names:
        none = np.empty(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none
    return tuple(np.concatenate(x) for x in (names, digests, firsts, ends))


# -- the enhanced suffix array ------------------------------------------------


def _ranks(codes: np.ndarray, depth: int) -> dict[int, np.ndarray]:
    """Ranks of all suffixes by their first 8, 16, 32, ... bytes, by doubling; by fewer than 8 for a smaller depth."""
    word = np.zeros(len(codes), np.uint64)
    padded = np.r_[codes, np.zeros(8, np.uint8)].astype(np.uint64)
    found, h = {}, min(8, 1 << (depth.bit_length() - 1))
    for k in range(h):
        word = (word << np.uint64(8)) | padded[k : k + len(codes)]
    key = word
    while True:
        order = np.argsort(key)
        step = np.empty(len(key), np.int64)
        step[order] = np.cumsum(np.r_[0, key[order][1:] != key[order][:-1]])
        found[h] = step
        if 2 * h > depth:
            return found
        ahead = np.zeros(len(step), np.int64)
        ahead[:-h] = step[h:] + 1
        key = step * (len(step) + 1) + ahead
        h *= 2


def enhanced_array(texts: list[bytes], min_len: int, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order (of those whose first min_len bytes occur twice), and the common prefixes of neighbours.

    Also returns which text each place belongs to, where the texts start, and the bytes from
    each place to the end of its text. No common prefix goes beyond the end of a text. counts: how many equal texts each stands for.
    """
    lengths = np.array([len(t) for t in texts])
    starts = np.r_[0, np.cumsum(lengths + 1)[:-1]]
    spare = int(lengths.max(initial=0)) + min_len  # so that no key reaches beyond the last text
    codes = np.frombuffer(b"\xff".join([*texts, b""]) + b"\xff" * spare, np.uint8)
    n = len(codes)
    owner = np.repeat(np.arange(len(texts)), lengths + 1)
    room = (starts + lengths)[owner] - np.arange(len(owner))  # bytes to the end of the text
    ranks = _ranks(codes, min_len)
    top = max(ranks)
    places = np.flatnonzero(room >= min_len)
    head, tail = ranks[top][places], ranks[top][places + min_len - top]
    order = np.lexsort((tail, head))
    head, tail, places = head[order], tail[order], places[order]
    same = (head[1:] == head[:-1]) & (tail[1:] == tail[:-1])
    twice = np.zeros(len(places), bool)
    twice[1:] |= same
    twice[:-1] |= same
    if counts is not None:
        twice |= (counts[owner[places]] > 1) & (places == starts[owner[places]])
    places = places[twice]
    if not len(places):
        return places, places, owner, starts, room
    far = int(room[places].max())
    if far > 4 * top:
        ranks = _ranks(codes, far)
        top = max(ranks)
    keys = [ranks[top][np.minimum(places + k, n - 1)] for k in range(0, far, top)]
    places = places[np.lexsort(keys[::-1])]
    x, y = places[:-1], places[1:]
    common = np.zeros(len(x), np.int64)
    limit = np.minimum(room[x], room[y])
    for h in [top] * (far // top) + [h for h in sorted(ranks, reverse=True) if h < top]:
        a, b = np.minimum(x + common, n - 1), np.minimum(y + common, n - 1)
        common += h * ((ranks[h][a] == ranks[h][b]) & (common < limit))
    for _ in range(7):
        a, b = np.minimum(x + common, n - 1), np.minimum(y + common, n - 1)
        common += (codes[a] == codes[b]) & (common < limit)
    return places, np.minimum(common, limit), owner, starts, room


@dataclass
class Tree:
    """The maximal repeats of some texts: group g is found at the suffixes low[g] to high[g], without the last."""

    owner: np.ndarray
    offset: np.ndarray
    length: np.ndarray
    low: np.ndarray
    high: np.ndarray
    #: By suffix, the length of the longest maximal repeat that starts there.
    longest: np.ndarray


def interval_tree(texts: list[bytes], min_len: int = MIN_BYTES, counts: list[int] | None = None) -> Tree:
    """Scans the enhanced suffix array with a stack, in time linear in the suffixes."""
    many = np.ones(len(texts), np.int64) if counts is None else np.array(counts, np.int64)
    places, common, owner, starts, room = enhanced_array(texts, min_len, many)
    which = owner[places]
    offset = places - starts[which] if len(places) else places
    codes = np.frombuffer(b"\xff" + b"\xff".join(texts), np.uint8)
    # The byte to the left; the start of a text is unlike any other.
    left = np.where(offset == 0, -1, codes[places].astype(np.int64)).tolist()
    beside = np.r_[0, common, 0]
    leaf = ((many[which] > 1) & (offset == 0) & (room[places] > np.maximum(beside[:-1], beside[1:]))).tolist() if len(places) else []
    stack: list[list[int]] = []  # length, first suffix of the interval, byte to the left or -1 if they differ
    groups: list[tuple[int, int, int]] = []
    longest, open_ = np.zeros(len(places), np.int64), []  # open_: suffixes that no group has yet
    for k, length in enumerate([*common.tolist(), 0][: len(places)]):
        begin, seen = k, left[k]
        if leaf[k]:
            longest[k] = room[places[k]]
            groups.append((int(longest[k]), k, k + 1))
        else:
            open_.append(k)
        while stack and stack[-1][0] > length:
            size, begin, within = stack.pop()
            seen = within if within == seen else -1
            if seen < 0:
                groups.append((size, begin, k + 1))
                while open_ and open_[-1] >= begin:
                    longest[open_.pop()] = size
        if length >= min_len:
            if stack and stack[-1][0] == length:
                stack[-1][2] = seen if stack[-1][2] == seen else -1
            else:
                stack.append([length, begin, seen])
        elif stack:
            raise AssertionError("intervals are nested")
    found = np.array(groups, np.int64).reshape(-1, 3)
    return Tree(which, offset, found[:, 0], found[:, 1], found[:, 2], longest)


def maximal_repeats(texts: list[bytes], min_len: int = MIN_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, text numbers, places in them) of each maximal repeat, with all its occurrences."""
    tree = interval_tree(texts, min_len)
    for size, low, high in zip(tree.length.tolist(), tree.low.tolist(), tree.high.tolist(), strict=True):
        yield size, tree.owner[low:high], tree.offset[low:high]


def repeated_spans(texts: list[bytes], min_len: int = MIN_BYTES, counts: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """The merged spans of each text that maximal repeats cover."""
    tree = interval_tree(texts, min_len, counts)
    offsets = np.r_[0, np.cumsum([len(t) + 1 for t in texts])]
    steps = np.zeros(offsets[-1] + 1, np.int32)
    flat = (offsets[tree.owner] + tree.offset)[tree.longest > 0]
    np.add.at(steps, flat, 1)
    np.add.at(steps, flat + tree.longest[tree.longest > 0], -1)
    covered = np.cumsum(steps) > 0
    edge = np.diff(np.r_[False, covered, False].astype(np.int8))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = np.searchsorted(begins, offsets)
    return [(begins[a:b] - o, ends[a:b] - o) for a, b, o in zip(cuts[:-1], cuts[1:], offsets[:-1], strict=True)]


def halves(text: bytes, start: int, known: int, size: int = MIN_BYTES) -> Iterator[tuple[int, int, bytes, int, int]]:
    """(side, shift, bytes, start, known) of the two contexts into which one is cut, if they have windows.

    All windows of the text hold its known bytes from start. Those with half of their other bytes,
    or more, to the left go to side 0, and know these bytes too; the others to side 1.
    """
    rest = size - known
    half = (rest + 1) // 2
    last = len(text) - size
    edge = min(start - half, last)
    if edge >= 0:
        yield 0, 0, text[: edge + size], start - half, known + half
    first = max(0, start - half + 1)
    if first <= last:
        yield 1, first, text[first:], start - first, known + rest - half + 1


# -- over a table -------------------------------------------------------------


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


LEVEL = "part bigint, key bigint, n bigint, start int, known int, bytes binary"
_LEVEL_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _table(rows: list[tuple], names: list[str], kinds: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


@dataclass
class Parts:
    """What the corpus is cut into. levels: parts of at most PART contexts, and whence their contexts come."""

    #: name, digest, doc_id, doc_key, first, end of every context whose name occurs twice.
    found: DataFrame
    #: name, digest, n, first, end of the contexts that are alone with their name and found twice.
    leaves: DataFrame
    #: (LEVEL, (name, digest, shift, part, key) or None where part and key are name and digest)
    levels: list[tuple[DataFrame, DataFrame | None]]


def _distinct(rows: DataFrame) -> DataFrame:
    """Equal contexts of a part as one, with their number."""
    return rows.groupBy("part", "key").agg(F.sum("n").alias("n"), F.any_value("start").alias("start"), F.any_value("known").alias("known"), F.any_value("bytes").alias("bytes"))


def parts_of(docs: DataFrame, scratch: Scratch, size: int = MIN_BYTES, gram: int = GRAM, most: int = PART) -> Parts:
    """Cuts the texts of docs by content into parts that hold all occurrences of their repeats."""
    texts = docs.where("text is not null").select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("doc_id"), doc_key().alias("doc_key"), "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = [contexts(t, size, gram) for t in text_bytes(batch.column("text"))]
            counts = [len(x[0]) for x in found]
            if sum(counts):
                name, digest, first, end = (np.concatenate(x) for x in zip(*found, strict=True))
                keys = [pa.array(np.repeat(np.array(batch.column(c).to_pylist(), np.int64), counts)) for c in ("doc_id", "doc_key")]
                yield pa.RecordBatch.from_arrays([_longs(name), _longs(digest), *keys, _longs(first), _longs(end)], names=["name", "digest", "doc_id", "doc_key", "first", "end"])

    every = scratch.write(texts.mapInArrow(cut, "name bigint, digest bigint, doc_id bigint, doc_key bigint, first bigint, end bigint"), "every")
    known = scratch.write(every.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"), "known")  # written, so that a hot name is split in the join
    found = scratch.write(every.join(known, "name"), "found")
    scratch.drop("every", "known")

    each = found.groupBy("name", "digest").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "doc_key", "first", "end")).alias("at"))
    each = scratch.write(each.select("name", "digest", "n", "at.*"), "each")
    names = scratch.write(each.groupBy("name").agg(F.count("*").alias("contexts")).where("contexts > 1").select("name"), "names")
    leaves = each.join(names, "name", "left_anti").select("name", "digest", "n", "first", "end")
    wanted = each.join(names, "name").groupBy("doc_id", "doc_key").agg(F.collect_list(F.struct("name", "digest", "n", "first", "end")).alias("parts"))  # of one document

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows = []
            for text, parts in zip(text_bytes(batch.column("text")), batch.column("parts").to_pylist(), strict=True):
                for p in parts:
                    own = text[p["first"] : p["end"]]
                    rows.append((p["name"], p["digest"], p["n"], _named(own, size, gram), gram, own))
            if rows:
                yield _table(rows, LEVEL_NAMES, _LEVEL_KINDS)

    level = scratch.write(_distinct(texts.join(wanted, ["doc_id", "doc_key"]).select("text", "parts").mapInArrow(fetch, LEVEL)), "level0")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as hashed

        for batch in small(batches):
            rows = []
            for part, key, n, start, known, own in zip(*(batch.column(c).to_pylist() for c in LEVEL_NAMES), strict=True):
                for side, shift, piece, at, more in halves(own, start, known, size):
                    named = hashed(piece[at : at + more], seed=(2 * part + side) % (1 << 64))
                    rows.append((_signed(named), _signed(hashed(piece, seed=at)), n, at, more, piece, part, key, shift))
            if rows:
                yield _table(rows, [*LEVEL_NAMES, "of_part", "of_key", "shift"], (*_LEVEL_KINDS, pa.int64(), pa.int64(), pa.int64()))

    levels: list[tuple[DataFrame, DataFrame | None]] = []
    origins = None
    while True:
        k = len(levels)
        large = scratch.write(level.where(F.col("known") < size).groupBy("part").agg(F.count("*").alias("contexts")).where(F.col("contexts") > most).select("part"), f"large{k}")
        if large.isEmpty():
            return Parts(found, leaves, [*levels, (level, origins)])
        levels.append((level.join(large, "part", "left_anti"), origins))
        cuts = scratch.write(level.join(large, "part").select(*LEVEL_NAMES).mapInArrow(split, f"{LEVEL}, of_part bigint, of_key bigint, shift bigint"), f"cuts{k}")
        level = scratch.write(_distinct(cuts), f"level{k + 1}")
        here = cuts.select("of_part", "of_key", "shift", "part", "key")
        if origins is None:
            origins = here.select(F.col("of_part").alias("name"), F.col("of_key").alias("digest"), "shift", "part", "key")
        else:
            before = origins.select("name", "digest", F.col("shift").alias("shifted"), F.col("part").alias("of_part"), F.col("key").alias("of_key"))
            origins = before.join(here, ["of_part", "of_key"]).select("name", "digest", (F.col("shifted") + F.col("shift")).alias("shift"), "part", "key")
        origins = scratch.write(origins, f"origins{k}")


LEVEL_NAMES = [x.split()[0] for x in LEVEL.split(", ")]


def _named(context: bytes, size: int, gram: int) -> int:
    """Where the string stands that names a context."""
    codes = BYTE_CODES[np.frombuffer(context[:size], np.uint8)]
    grams = windows(prefix_sums(codes), gram) & ~_LOW
    return len(grams) - 1 - int(np.argmin(grams[::-1]))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Whole parts, sorted by part, in lists of about BATCH_BYTES."""
    held: list[tuple[int, int, int, bytes]] = []
    held_bytes = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("part", "key", "n", "bytes")), strict=True):
            if held and held_bytes > BATCH_BYTES and held[-1][0] != row[0]:
                yield held
                held, held_bytes = [], 0
            held.append(row)
            held_bytes += len(row[3])
    if held:
        yield held


def _together(level: DataFrame) -> DataFrame:
    return level.select("part", "key", "n", "bytes").repartition("part").sortWithinPartitions("part", "key")


def removed(docs: DataFrame, scratch: Scratch, size: int = MIN_BYTES, gram: int = GRAM, most: int = PART) -> DataFrame:
    """doc_id, doc_key and the spans of bytes to remove, for documents that lose any."""
    cut = parts_of(docs, scratch, size, gram, most)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _sets(batches):
            got = repeated_spans([r[3] for r in held], size, [r[2] for r in held])
            rows = [(r[0], r[1], a.tolist(), b.tolist()) for r, (a, b) in zip(held, got, strict=True) if len(a)]
            if rows:
                yield _table(rows, ["part", "key", "starts", "ends"], (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))

    moved = lambda x, by: F.transform(x, lambda y: y + F.col(by))
    verdicts = cut.leaves.where("n > 1").select("name", "digest", F.array(F.lit(0).cast("bigint")).alias("starts"), F.array(F.col("end") - F.col("first")).alias("ends"))
    for level, origins in cut.levels:
        got = _together(level).mapInArrow(compare, "part bigint, key bigint, starts array<bigint>, ends array<bigint>")
        if origins is None:
            verdicts = verdicts.unionByName(got.withColumnsRenamed({"part": "name", "key": "digest"}))
        else:
            verdicts = verdicts.unionByName(origins.join(got, ["part", "key"]).select("name", "digest", moved("starts", "shift").alias("starts"), moved("ends", "shift").alias("ends")))
    verdicts = scratch.write(verdicts, "verdicts")

    gone = cut.found.join(verdicts, ["name", "digest"]).select("doc_id", "doc_key", moved("starts", "first").alias("starts"), moved("ends", "first").alias("ends"))
    gone = gone.groupBy("doc_id", "doc_key").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"))  # of one document
    gone = scratch.write(gone, "gone")
    scratch.drop_all_but("gone")
    return gone


def repeat_groups(docs: DataFrame, size: int = MIN_BYTES, gram: int = GRAM, most: int = PART) -> tuple[DataFrame, DataFrame]:
    """The maximal repeats as (set, length, low, high), and their occurrences as (set, rank, doc_id, start).

    A group's occurrences are those of its set with low <= rank < high: nested groups
    share them, so both tables grow as the contexts, not as their pairs. Rows without
    doc_id have a null there. An occurrence of a row stored twice counts twice.
    """
    cut = parts_of(docs, Scratch(docs.sparkSession, "groups"), size, gram, most)
    longs = pa.list_(pa.int64())
    names = ("set", "length", "low", "high", "part", "key", "offset")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _sets(batches):
            tree = interval_tree([r[3] for r in held], size, [r[2] for r in held])
            if len(tree.length):
                part, key = np.array([r[0] for r in held], np.int64), np.array([r[1] for r in held], np.int64)
                row = (held[0][0], *(x.tolist() for x in (tree.length, tree.low, tree.high, part[tree.owner], key[tree.owner], tree.offset)))
                yield _table([row], list(names), (pa.int64(), *[longs] * 6))

    scratch = Scratch(docs.sparkSession, "trees")
    alone = cut.leaves.where("n > 1").select(F.xxhash64("name", "digest").alias("set"), F.col("name"), "digest", (F.col("end") - F.col("first")).alias("length"))
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    groups = alone.select("set", "length", zero.alias("low"), one.alias("high"))
    places = alone.select("set", zero.alias("rank"), "name", "digest", zero.alias("offset"))
    for k, (level, origins) in enumerate(cut.levels):
        trees = scratch.write(_together(level).mapInArrow(grow, "set bigint, " + ", ".join(f"{c} array<bigint>" for c in names[1:])), f"trees{k}")
        trees = trees.withColumn("set", F.xxhash64("set", F.lit(k)))
        groups = groups.unionByName(trees.select("set", F.explode(F.arrays_zip("length", "low", "high")).alias("g")).select("set", "g.*"))
        each = trees.select("set", F.posexplode(F.arrays_zip("part", "key", "offset")).alias("rank", "s")).select("set", F.col("rank").cast("bigint").alias("rank"), "s.*")
        if origins is None:
            each = each.withColumnsRenamed({"part": "name", "key": "digest"})
        else:
            each = each.join(origins, ["part", "key"]).select("set", "rank", "name", "digest", (F.col("offset") + F.col("shift")).alias("offset"))
        places = places.unionByName(each)
    doc_id = F.nullif("doc_id", F.lit(-(1 << 63)))
    return groups, places.join(cut.found, ["name", "digest"]).select("set", "rank", doc_id.alias("doc_id"), (F.col("first") + F.col("offset")).alias("start"))


def dedup(docs: DataFrame, size: int = MIN_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes for every document."""
    gone = removed(docs, Scratch(docs.sparkSession, "suffix"), size)
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("doc_key").alias("gone_key"), "starts", "ends")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows = []
            for text, starts, ends in zip(text_bytes(batch.column("text")), batch.column("starts").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                text = text or b""
                a, b = merged(np.array(starts or [], np.int64), np.array(ends or [], np.int64))
                kept = b"".join(text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)], strict=True))
                rows.append((len(text), len(text) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    keyed = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("own_id"), doc_key().alias("own_key"))
    both = keyed.join(gone, (F.col("own_id") == F.col("gone_id")) & (F.col("own_key") == F.col("gone_key")), "left").select("doc_id", "text", "starts", "ends")
    return both.mapInArrow(finish, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
