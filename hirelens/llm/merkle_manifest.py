"""Operator 11, a Merkle manifest of a table, with proofs by coordinate lookup.

A row is a leaf: the hash of its fields. The leaves of a lang stand in order of doc_id and
form a tree in which every WIDTH consecutive nodes have one parent; the trees' tops form another tree
over the langs. So one hash names the whole table, and WIDTH - 1 hashes a level prove a row.

1. Leaves are numbered by a sort over all tasks (`numbered`), so a lang with most rows is no one task's.
2. Each level is a table of runs: (tree, run, digests), a run being the nodes under one parent. A level is
   made from the one below, an eighth as large.
3. Proofs: the leaves of a run ask for the same nodes above them, so they ask together. A run explodes the
   coordinates (level, run) above it, told from its own number and the size of the tree alone, joins them to
   the tables of levels, and puts what it finds in order; each leaf leaves itself out by its position.
4. Coordinates are asked for SPAN levels at a time, from the top down: a node is asked for by the runs
   at most SPAN levels below it, WIDTH ** SPAN of them, so the nodes near the top are no hot keys.
5. Siblings are concatenated and folded inside one row. All steps are DataFrame functions.

Edge cases: a null field is `-`, an empty one `0:`; rows with one doc_id stand by their leaf, equal rows are
leaves each; a null doc_id comes first; a null lang is a tree of its own, the first; a tree of one leaf has the leaf as
its top and no siblings; an empty table gives an empty result. Very long texts are hashed whole and go no further than
their scan. Columns other than the fields are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import Scratch, numbered

WIDTH, SPAN = 8, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The key of the tree over the tops.
TOP = "*"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(fields: Sequence[Column]) -> Column:
    """The hash of a row: each field with its length in bytes, so that no two rows spell the same."""
    one = lambda c: F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")))
    return digest(F.concat(*map(one, fields)))


def named(key: Column) -> Column:
    """A key as text: null before all others, these by their bytes."""
    return F.coalesce(F.concat(F.lit(":"), key.cast("string")), F.lit("-"))


def _nodes(level: int) -> Column:
    """How many nodes a tree of `many` leaves has at this level."""
    return F.expr(f"(many + {WIDTH**level - 1}L) div {WIDTH**level}L")


def _runs(nodes: DataFrame, *keep: str) -> DataFrame:
    """Runs of nodes (tree, many, place, hash, ...) in order: at most WIDTH in each."""
    return nodes.groupBy("tree", "many", F.expr(f"place div {WIDTH}L").alias("run")).agg(F.sort_array(F.collect_list(F.struct("place", "hash", *keep))).alias("members"))


def _digests(runs: DataFrame) -> DataFrame:
    return runs.select("tree", "many", "run", F.array_join("members.hash", "").alias("digests"))


@dataclass(frozen=True)
class Forest:
    """members (tree, many, run, members in order); levels of (tree, many, run, digests); tops (tree, top)."""

    members: DataFrame
    levels: list[DataFrame]
    tops: DataFrame
    scratch: Scratch
    name: str


def forest(leaves: DataFrame, order: Sequence[str], keep: Sequence[str], scratch: Scratch, name: str) -> Forest:
    """Trees over leaves (tree, hash, ...), each in this order."""
    members = scratch.write(_runs(numbered(leaves, "tree", order, scratch, f"{name}_leaves"), *keep), f"{name}_members")
    most = members.agg(F.max("many")).first()[0] or 0
    levels = [scratch.write(_digests(members), f"{name}_0")]
    while WIDTH ** len(levels) < most:
        k = len(levels)
        parents = levels[-1].where(_nodes(k) > 1).select("tree", "many", F.col("run").alias("place"), digest(F.col("digests")).alias("hash"))
        levels.append(scratch.write(_digests(_runs(parents)), f"{name}_{k}"))
    # Where a tree has one run of several nodes, that is below its top; a lone leaf is the top.
    ends = [rows.where(_nodes(k).between(1 if k == 0 else 2, WIDTH)) for k, rows in enumerate(levels)]
    last = ends[0]
    for rows in ends[1:]:
        last = last.unionByName(rows)
    tops = last.select("tree", F.when(F.col("many") == 1, F.col("digests")).otherwise(digest(F.col("digests"))).alias("top"))
    return Forest(members, levels, scratch.write(tops, f"{name}_tops"), scratch, name)


def paths(trees: Forest) -> DataFrame:
    """(tree, run, path): for each run of leaves the runs above it, itself first, as (level, digests)."""
    above = None
    for start in reversed(range(0, len(trees.levels), SPAN)):
        units = trees.levels[start].where(_nodes(start) > 1)
        own = F.array(F.struct(F.lit(start).alias("level"), "digests"))
        inside = trees.levels[start + 1 : start + SPAN]
        if inside:
            asked = units.select("tree", "run", F.explode(F.array_compact(F.array(*(F.when(_nodes(start + k) > 1, F.struct(F.lit(start + k).alias("level"), F.expr(f"run div {WIDTH**k}L").alias("at"))) for k in range(1, len(inside) + 1))))).alias("c"))
            nodes = [rows.select("tree", F.lit(start + k).alias("level"), F.col("run").alias("at"), "digests") for k, rows in enumerate(inside, 1)]
            table = nodes[0]
            for rows in nodes[1:]:
                table = table.unionByName(rows)
            found = asked.select("tree", "run", "c.*").join(table, ["tree", "level", "at"])
            ordered = found.groupBy("tree", "run").agg(F.sort_array(F.collect_list(F.struct("level", "digests"))).alias("rest"))
            here = units.join(ordered, ["tree", "run"], "left").select("tree", "run", F.concat(own, F.coalesce("rest", F.array().cast("array<struct<level:int,digests:string>>"))).alias("path"))
        else:
            here = units.select("tree", "run", own.alias("path"))
        if above is not None:
            over = above.select("tree", F.col("run").alias("over"), F.col("path").alias("higher"))
            here = here.withColumn("over", F.expr(f"run div {WIDTH**SPAN}L")).join(over, ["tree", "over"], "left").select("tree", "run", F.concat("path", F.coalesce("higher", F.array().cast("array<struct<level:int,digests:string>>"))).alias("path"))
        above = trees.scratch.write(here, f"{trees.name}_paths{start}")
    return above


SIDES = "array<struct<left:string,right:string>>"


def proofs(trees: Forest) -> DataFrame:
    """Every leaf (tree, place, hash, what was kept) with its siblings level by level, those on its left and on its right."""
    each = trees.members.join(paths(trees), ["tree", "run"], "left").select("tree", "path", F.explode("members").alias("leaf"))
    width, size = F.lit(WIDTH), 64

    def split(x: Column) -> Column:
        at = F.pmod(F.floor(F.col("leaf.place") / F.pow(width, x["level"])), width).cast("int")
        return F.struct(F.substring(x["digests"], F.lit(1), at * size).alias("left"), F.substring(x["digests"], (at + 1) * size + 1, F.lit(WIDTH * size)).alias("right"))

    return each.select("tree", "leaf.*", F.coalesce(F.transform("path", split), F.array().cast(SIDES)).alias("sides"))


def siblings(sides: Column) -> Column:
    """The hashes of a proof one after the other."""
    return F.array_join(F.transform(sides, lambda x: F.concat(x["left"], x["right"])), "")


def fold(start: Column, sides: Column) -> Column:
    """The hash at the top that follows from a leaf and its siblings."""
    return F.aggregate(sides, start, lambda h, x: digest(F.concat(x["left"], h, x["right"])))


def manifest(docs: DataFrame, fields: Sequence[Column] | None = None, claims: Sequence[Column] | None = None) -> DataFrame:
    """doc_id, lang's tree, place, leaf, subroot, root, proof (sides) and claimed, the leaf of the claims, for every row.

    claims are the fields as somebody has them now; without, they are the fields themselves.
    """
    scratch = Scratch(docs.sparkSession, "merkle")
    fields = [F.col(c) for c in FIELDS] if fields is None else fields
    own = leaf(fields)
    # salt deals equal rows over tasks; it is written, so it does not change.
    rows = docs.select(named(F.col("lang")).alias("tree"), "doc_id", own.alias("hash"), (own if claims is None else leaf(claims)).alias("claimed"), F.monotonically_increasing_id().alias("salt"))
    rows = scratch.write(rows, "leaves")
    langs = forest(rows, ["doc_id", "hash", "salt"], ["doc_id", "claimed"], scratch, "lang")
    scratch.drop("leaves")
    over = forest(langs.tops.select(F.lit(TOP).alias("tree"), F.col("tree").alias("lang_tree"), F.col("top").alias("hash")), ["lang_tree"], ["lang_tree"], scratch, "top")
    tops = proofs(over).join(over.tops, "tree").select(F.col("lang_tree").alias("tree"), F.col("hash").alias("subroot"), F.col("top").alias("root"), F.col("sides").alias("higher"))
    each = proofs(langs).join(scratch.write(tops, "subroots"), "tree")
    return each.select("doc_id", "tree", "place", F.col("hash").alias("leaf"), "subroot", "root", F.concat("sides", "higher").alias("proof"), "claimed")


def verify(rows: DataFrame) -> DataFrame:
    """The digest of manifest(): its hashes, that of the proof, the root that follows from the claimed leaf, and whether it is the root."""
    folded = fold(F.col("claimed"), F.col("proof"))
    return rows.select("doc_id", "leaf", "subroot", "root", digest(siblings(F.col("proof"))).alias("proof_sha256"), folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
