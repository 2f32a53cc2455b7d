"""Operator 9, mixing sources to target weights over a time-varying curriculum (native).

Each source has a weight schedule over training time 0..1, given by knots of a
piecewise linear curve. Its integral is the source's weight; the weights share
the corpus size, and no source gets more than MAX_REPEATS times its own size.
The documents of a source, in the order of a hash, form a stream of words that is
passed over until the source's target is met. A copy that begins at word c of
its source's stream stands at the time when the integral of the schedule reaches
c / target; documents are range-sorted by that training position.

Running sums are two-level, so a source that holds a third of all rows is dealt
over BUCKETS ranges of the hash: sums by (source, bucket) are aggregated before
the shuffle, running sums over buckets are BUCKETS rows for a source, and inside
a bucket a window sums documents.

Edge cases: a null text has size 0; a null source is a source of its own, last
in order; a source of size 0 has target 0; documents of size 0 are never taken;
an empty table gives an empty result. A very long text is one document like any
other: only its number of words enters. Rows with equal doc_id and size follow the hash
of their texts; equal rows are interchangeable. A result column replaces an input column of its name; others
are carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import Scratch

MAX_REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"
#: Knots (time, weight) by weight class; sources take the classes in turn, in order of code points.
SCHEDULES = {1: [(0.0, 1.5), (1.0, 0.5)], 2: [(0.0, 2.0), (1.0, 2.0)], 3: [(0.0, 1.0), (0.5, 3.0), (1.0, 5.0)]}
#: Leading hexadecimal digits of the hash that name a bucket: 4,096 buckets.
BUCKET_DIGITS = 3

COLUMNS = ("size", "source_size", "target", "copies", "taken", "position")


def integral(knots: list[tuple[float, float]]) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False))


def sources(docs: DataFrame, schedules: dict = SCHEDULES, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source_key, class, source_size and target by source. A few rows: one for each source.

    docs needs mix_key and mix_total. With sources in order of limit per weight,
    those that reach their limit come first, so one running sum decides.
    """
    classes = [(k, integral(v)) for k, v in sorted(schedules.items())]
    by_size = docs.groupBy("mix_key").agg(F.sum("mix_total").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("mix_key")) - 1
    turn = rank % len(classes)
    weight = F.element_at(F.array(*[F.lit(w) for _, w in classes]), turn + 1)
    ranked = by_size.select("mix_key", "source_size", F.element_at(F.array(*[F.lit(k) for k, _ in classes]), turn + 1).alias("mix_class"), weight.alias("weight"))
    limit = (F.lit(max_repeats) * F.col("source_size")).cast("double")
    ahead = Window.orderBy(limit / F.col("weight"), "mix_key").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rest = F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum(limit).over(ahead), F.lit(0.0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(ahead), F.lit(0.0))
    judged = ranked.select("*", limit.alias("limit"), rest.alias("rest"), weights.alias("weights")).withColumn("full", F.col("rest") * F.col("weight") > F.col("limit") * F.col("weights"))
    left = F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))).over(everything), F.lit(0.0))
    free = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    return judged.select("mix_key", "mix_class", "source_size", F.when(F.col("full"), F.col("limit")).otherwise(left * F.col("weight") / free).alias("target"))


def _at(share: Column, knots: list[tuple[float, float]]) -> Column:
    """The time at which the integral of the knots reaches this share of the whole."""
    whole, done, out = integral(knots), 0.0, F.lit(1.0)
    pieces = []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        area = (t1 - t0) * (w0 + w1) / 2
        need = F.greatest(share * whole - done, F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        # w0 * x + slope / 2 * x**2 = need, in the form that stays exact for small slopes
        x = 2 * need / (w0 + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * need, F.lit(0.0)))) if w0 or slope else F.lit(0.0)
        done += area
        pieces.append((F.lit(done), t0 + x))
    for end, place in reversed(pieces):
        out = F.when(share * whole <= end, F.least(place, F.lit(1.0))).otherwise(out)
    return out


def curriculum(docs: DataFrame, schedules: dict = SCHEDULES, max_repeats: int = MAX_REPEATS, whole: bool = False) -> DataFrame:
    """docs with size, source_size, target, copies (position, words), taken and the first position.

    The last pass over a source ends inside one document; with whole, copies are
    entire documents, and that document stays if half of it or more is needed.
    """
    safe = {c: f"mix_carried_{k}" for k, c in enumerate(docs.columns) if c.startswith("mix_")}  # while helpers of such names are there
    docs = docs.withColumnsRenamed(safe)
    kept = [c for c in docs.columns if c not in COLUMNS]
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = docs.select(*kept).withColumns({
        "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint"),
        "mix_key": F.when(F.col("source").isNull(), F.lit("z")).otherwise(F.concat(F.lit("s"), F.col("source"))),
        "mix_hash": digest,
        "mix_bucket": F.substring(digest, 1, BUCKET_DIGITS),
        "mix_text": F.xxhash64("text"),
    })
    sums = sized.groupBy("mix_key", "mix_bucket").agg(F.sum("size").alias("mix_total"))
    sums = Scratch(docs.sparkSession, "mixing").write(sums, "sums")
    upto = Window.partitionBy("mix_key").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("mix_key", "mix_bucket", F.coalesce(F.sum("mix_total").over(upto), F.lit(0)).alias("mix_start"))
    starts = starts.join(F.broadcast(sources(sums, schedules, max_repeats)), "mix_key") if _few(sums) else starts.join(sources(sums, schedules, max_repeats), "mix_key")
    inside = Window.partitionBy("mix_key", "mix_bucket").orderBy("mix_hash", "doc_id", "size", "mix_text").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("mix_before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["mix_key", "mix_bucket"])
    goal = F.floor(F.col("target") + 0.5).cast("bigint")
    begin = F.col("mix_start") + F.col("mix_before")
    passes = F.when(F.col("source_size") > 0, F.expr("floor(target + 0.5) div greatest(source_size, 1)")).otherwise(0).cast("int")
    size, total = F.col("size"), F.col("source_size")

    def copy(k: Column) -> Column:
        at = k * total + begin
        words = F.greatest(F.least(size, goal - at), F.lit(0)).cast("bigint")
        if whole:
            words = F.when(words * 2 >= size, size).otherwise(0)
        share = F.when(F.col("target") > 0, at / F.col("target")).otherwise(0.0)
        place = F.lit(1.0)
        for k_, knots in schedules.items():
            place = F.when(F.col("mix_class") == k_, _at(share, knots)).otherwise(place)
        return F.struct(place.alias("position"), words.alias("words"))

    copies = F.filter(F.transform(F.sequence(F.lit(0), passes), copy), lambda c: c["words"] > 0)
    return (
        placed.withColumn("copies", copies)
        .withColumn("taken", F.aggregate("copies", F.lit(0).cast("bigint"), lambda a, c: a + c["words"]))
        .withColumn("position", F.get("copies", F.lit(0))["position"])
        .select(*kept, *COLUMNS).withColumnsRenamed({new: old for old, new in safe.items()})
    )


def _few(sums: DataFrame, most: int = 100_000) -> bool:
    """Whether there are so few sources that a row for each may be broadcast."""
    return sums.select("mix_key").distinct().limit(most + 1).count() <= most


def by_position(mixed: DataFrame) -> DataFrame:
    """Documents in training order; those not taken, which have no position, stay last in order of doc_id."""
    keys = [F.col("position").asc_nulls_last(), F.col("doc_id")]
    return mixed.repartitionByRange(*keys).sortWithinPartitions(*keys)


def training_order(mixed: DataFrame) -> DataFrame:
    """One row for each copy, range-sorted by its own training position; ties by doc_id, then by the hash of the text."""
    kept = [c for c in mixed.columns if c not in COLUMNS]
    copies = mixed.select(*kept, F.explode("copies").alias("copy")).select(*kept, F.col("copy.position").alias("position"), F.col("copy.words").alias("words"))
    return copies.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id", F.xxhash64("text"))
