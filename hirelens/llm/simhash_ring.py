"""Operator 12, near duplicates by SimHash with pigeonring filtering.

A fingerprint bit is set if it is set in over half of the hashes of a text's shingles. Two
fingerprints link at BITS or fewer differing bits.

The 64 bits are a ring of SEGMENTS equal segments. If two fingerprints differ in BITS bits at most, then
from one segment at least the ring can be walked so that after every number l of segments the
differences so far are at most l * BITS / SEGMENTS (the pigeonring principle). With four segments of 16 bits the budgets
are 0, 1, 2 and 3.

1. Equal fingerprints become one. All below is about distinct ones.
2. Chains of two segments are a key of 32 bits: the first segment is equal, the second differs in one bit at
   most. Each fingerprint stands under its four own keys, and asks for these and for those that one bit of the second segment
   turns them into, 68 in all. Who stands and who asks under a key are joined; the budget of three segments
   prunes pairs before their whole difference is counted.
3. Hot keys, under which more than HOT fingerprints stand (many near copies of one text), are not joined so.
   There each is compared with one leader. Links so far make components; where all that stands and asks under a hot key is one
   component already, it is done. Elsewhere those that differ in component are compared, in blocks of at most
   BLOCK that stand and ASK that ask, and a block gives one link for each that asks and each component found.

So no pairs inside a component are formed under hot keys, and other keys have at most HOT partners for
each that asks. The links lose nothing: a pair that is not compared is in one component already.

Edge cases: fewer words than a shingle has are one shingle, the whole sequence; null, empty and wordless texts have the
fingerprint zero and link like any other; very long texts are read whole, in memory in proportion to the
longest; rows with one doc_id are judged each by its text; a row without doc_id links like any other but
gives no component its name, which is null where no row has one. An empty table gives an empty result.
Columns other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import Scratch, shuffled, small, text_bytes
from .jaccard_join import components

WORDS, SEED = 3, 42
BITS, SEGMENTS, WIDTH = 3, 4, 16
#: Fingerprints under a key beyond which it is hot, and the size of a block of a hot one.
HOT, BLOCK, ASK = 64, 4096, 1024
#: Hot keys up to which they are broadcast.
FEW = 100_000

_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes | None, n: int = WORDS) -> np.ndarray:
    """Hashes of all shingles, repeats included."""
    import xxhash

    own = (text or b"").lower().split()
    if not own:
        return np.empty(0, np.uint64)
    joined = b" ".join(own)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1)
    starts = np.r_[0, ends[:-1]]
    n = min(n, len(own))
    cuts = map(slice, starts[: len(own) - n + 1].tolist(), (ends[n - 1 :] - 1).tolist())
    return np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, cuts), repeat(SEED)), np.uint64, len(own) - n + 1)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits, counted in eight byte lanes at a time."""
    counts = np.zeros(64, np.int64)
    rows = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
    rows[: len(hashes)] = hashes
    for k in range(8):
        lanes = ((rows >> np.uint64(k)) & _LANES).reshape(-1, 255).sum(axis=1, dtype=np.uint64)  # 255 at most in each byte
        counts[k::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(hashes: np.ndarray) -> int:
    over = 2 * bit_counts(hashes) > len(hashes)
    return int((over.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64)) if len(hashes) else 0


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            prints = np.array([fingerprint(shingle_hashes(t)) for t in text_bytes(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, print bigint")


def turned(start: int, name: str = "print") -> Column:
    """The ring read from this segment on."""
    bits = WIDTH * start
    return F.expr(f"shiftleft({name}, {bits}) | shiftrightunsigned({name}, {64 - bits})") if start else F.col(name)


def chain(start: int) -> Column:
    """The key of the first two segments from here, and of the place itself."""
    return F.shiftrightunsigned(turned(start), 64 - 2 * WIDTH).bitwiseOR(F.lit(start << 2 * WIDTH).cast("bigint"))


def own_keys() -> Column:
    return F.explode(F.array(*map(chain, range(SEGMENTS))))


def asked_keys() -> Column:
    """Own keys, and those with one bit of the second segment turned."""
    turns = (0, *(1 << b for b in range(WIDTH)))
    return F.explode(F.array(*(chain(k).bitwiseXOR(F.lit(t).cast("bigint")) for k in range(SEGMENTS) for t in turns)))


def within(a: str, b: str) -> Column:
    """Whether three segments from where the key starts keep their budget of two bits, and all four theirs of three."""
    difference, start = f"({a} ^ {b})", f"cast(shiftright(key, {2 * WIDTH}) as int)"
    ring = f"(shiftleft({difference}, {WIDTH} * {start}) | if({start} = 0, 0L, shiftrightunsigned({difference}, 64 - {WIDTH} * {start})))"
    return F.expr(f"bit_count(shiftrightunsigned({ring}, {WIDTH})) <= 2 and bit_count({difference}) <= {BITS}")


def _compare(cells: DataFrame) -> DataFrame:
    """Links (a, b) in cells (key, block, copy) between those that ask (kind 1) and those that stand (kind 0), where components differ.

    Rows come sorted by cell and kind; what stands in a cell is BLOCK rows or so. Two of the largest component (top) are not compared.
    """

    def matches(p: np.ndarray, o: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(0, len(p), 256):
            x = p[k : k + 256, None] ^ o[None, :]
            near = np.bitwise_count(x) <= BITS
            at, to = np.nonzero(near)
            y = x[at, to]
            ring = (y << np.uint64(WIDTH * start)) | (y >> np.uint64(64 - WIDTH * start)) if start else y
            good = np.bitwise_count(ring >> np.uint64(WIDTH)) <= 2
            found.append((at[good] + k, to[good]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_at, held = None, np.empty((0, 3), np.int64)  # print, component and top of what stands in the cell
        for batch in batches:
            links = []
            cell = np.stack([batch.column(c).to_numpy() for c in ("key", "block", "copy")], axis=1)
            rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("print", "component", "top", "kind")], axis=1)
            ends = np.r_[np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1, len(cell)]
            for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True):
                name, part = tuple(cell[a].tolist()), rows[a:b]
                if name != held_at:
                    held_at, held = name, np.empty((0, 3), np.int64)
                stand, ask = part[part[:, 3] == 0], part[part[:, 3] == 1]
                held = np.concatenate([held, stand[:, :3]])
                for p, o in ((ask[ask[:, 2] == 0], held), (ask[ask[:, 2] == 1], held[held[:, 2] == 0])):
                    if not len(p) or not len(o):
                        continue
                    at, to = matches(p[:, 0].astype(np.uint64), o[:, 0].astype(np.uint64), name[0] >> 2 * WIDTH)
                    other = p[at, 1] != o[to, 1]
                    at, to = at[other], to[other]
                    _, first = np.unique(np.stack([at, o[to, 1]], axis=1), axis=0, return_index=True)  # one link for each component
                    links.append(np.stack([p[at[first], 0], o[to[first], 0]], axis=1))
            every = np.concatenate([np.empty((0, 2), np.int64), *links])
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(every[:, k])) for k in (0, 1)], names=["a", "b"])

    return cells.select("key", "block", "copy", "print", "component", "top", "kind").mapInArrow(run, "a bigint, b bigint")


def _hot_links(own: DataFrame, asked: DataFrame, parts: DataFrame, few: bool, scratch: Scratch) -> DataFrame:
    """Links under hot keys between components. own and asked are (key, print), parts (id, component); few: whether a row for each hot key may be broadcast."""
    rows = own.withColumn("kind", F.lit(0)).unionByName(asked.withColumn("kind", F.lit(1))).join(shuffled(parts.withColumnRenamed("id", "print")), "print", "left")
    rows = scratch.write(rows.withColumn("component", F.coalesce("component", "print")), "hot_rows")
    sizes = rows.groupBy("key", "component").agg(F.count_if(F.col("kind") == 0).alias("stand"), F.count_if(F.col("kind") == 1).alias("ask"))
    mixed = sizes.groupBy("key").agg(F.max(F.struct(F.col("stand") + F.col("ask"), "component"))["component"].alias("largest"), F.count("*").alias("parts"), F.sum("stand").alias("stand"), F.sum("ask").alias("ask")).where("parts > 1")
    dealt = lambda n, most: F.greatest(F.lit(1), F.ceil(F.col(n) / most).cast("int"))
    mixed = scratch.write(mixed.select("key", "largest", dealt("stand", BLOCK).alias("blocks"), dealt("ask", ASK).alias("copies")), "mixed")
    rows = rows.join(F.broadcast(mixed) if few else shuffled(mixed), "key").withColumn("top", (F.col("component") == F.col("largest")).cast("int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    hashed = lambda n, seed: F.pmod(F.xxhash64("print", F.lit(seed)), F.col(n)).cast("int")
    keep = ("key", "print", "component", "top", "kind")
    inside = rows.where("kind = 0").select(*keep, hashed("blocks", 0).alias("block"), every("copies").alias("copy"))
    outside = rows.where("kind = 1").select(*keep, every("blocks").alias("block"), hashed("copies", 1).alias("copy"))
    cell = ("key", "block", "copy")
    return _compare(inside.unionByName(outside).repartition(*cell).sortWithinPartitions(*cell, "kind", "print"))


def links(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) of distinct prints that have a link. prints is (print)."""
    own = scratch.write(prints.select("print", own_keys().alias("key")), "own")
    sizes = own.groupBy("key").agg(F.count("*").alias("many"), F.min("print").alias("leader"))
    hot = scratch.write(sizes.where(F.col("many") > HOT).select("key", "leader"), "hot")
    many = hot.count()
    few = many <= FEW
    hot = F.broadcast(hot) if few else shuffled(hot)
    asked = prints.select("print", asked_keys().alias("key"))
    # Of a pair the smaller print asks; under a hot key nobody stands here.
    cold = own.join(hot, "key", "left_anti").withColumnRenamed("print", "b")
    near = asked.withColumnRenamed("print", "a").join(shuffled(cold), "key").where((F.col("a") < F.col("b")) & within("a", "b")).select("a", "b")
    edges = scratch.write(near, "near")
    hot_own = own.join(hot, "key")
    led = hot_own.where((F.col("print") != F.col("leader")) & within("print", "leader")).select(F.col("leader").alias("a"), F.col("print").alias("b"))
    edges = edges.unionByName(scratch.write(led, "led"))
    parts = components(edges, scratch, "parts0_")
    if not many:
        return parts
    # Each pair meets under the own key of its larger print: above if that is cold, below if it is hot.
    hot_asked = asked.join(hot.select("key"), "key", "left_semi")
    rest = scratch.write(_hot_links(hot_own.select("key", "print"), hot_asked.select("key", "print"), parts, few, scratch), "rest")
    return components(edges.unionByName(rest), scratch, "parts_")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable, for every row."""
    scratch = Scratch(docs.sparkSession, "simhash")
    every = scratch.write(fingerprints(docs), "every")
    prints = scratch.write(every.groupBy("print").agg(F.min("doc_id").alias("id")), "prints")
    parts = links(prints.select("print"), scratch)
    named = prints.join(shuffled(parts.withColumnRenamed("id", "print")), "print", "left").withColumn("component", F.coalesce("component", "print"))
    named = scratch.write(named, "named")
    lowest = scratch.write(named.groupBy("component").agg(F.min("id").alias("component_id")), "lowest")
    named = scratch.write(named.join(shuffled(lowest), "component").select("print", "component_id"), "by_print")
    return every.join(shuffled(named), "print").select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
