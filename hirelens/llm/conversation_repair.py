"""Operator 13, repair of conversations by signature deduplication.

A row is blank (no character but blanks), a duplicate (its role and text stand earlier in the conversation),
truncated (it does not end in a mark of SENTENCE_ENDS) or whole; the first of these counts. The cheapest edits
make the roles one optional system turn and then turns of user and assistant: keep (0), rerole to user or assistant (1), delete
(2; blank rows and duplicates must go), insert an empty turn (5). Truncated rows that stay cost 5 more. Of edits that cost
the same, those whose initials (D, I, K, R) come first are taken.

1. Rows are numbered over all tasks by conversation and turn (`numbered`) and cut into pieces of PIECE rows. A
   piece is a signature: one sign a row for its role and its fault. Texts play no part in it.
2. Each distinct signature is solved once, by a memoised recursion, for every state in which a piece may begin
   and end: its cost and its edits. Conversations of PIECE rows or fewer are one piece.
3. Solutions are joined back; pieces of a conversation are put together, state by state, from left to right. As
   edits of a piece end in a row, none are the beginning of others, and the first of all are those of the pieces.
4. Edits are replayed on the rows of each piece, in place: no row moves and no texts are gathered.

A conversation of any length is numbered, solved and replayed in pieces; only its edits, a sign a
row, come together, as they are one value of the result. Its digest is a hash of its repaired turns from first to last, so these
pass through one task in order, one batch at a time.

Edge cases: a null conv_id is a conversation of its own; null turns come first and are none of the numbers that gaps
count; a null role or text is one space, so such a text is blank and such a role is neither user nor assistant. Rows of one turn
stand by role and a hash of the text. An empty table gives an empty result; a conversation without rows has nothing to repair. Very
long texts are read whole. Columns other than conv_id, turn, role and text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import Scratch, numbered
from .merkle_manifest import named

BLANKS, SENTENCE_ENDS = " \t\n\x0b\x0c\r", ".!?"
#: Rows in a signature at most.
PIECE = 200
KEEP, REROLE, DELETE, TRUNCATED, INSERT = 0, 1, 2, 5, 5
#: States: nothing yet, after system, after user, after assistant. NEXT: the role due there, and the state after it.
STATES = "0sua"
NEXT = {"0": "u", "s": "u", "u": "a", "a": "u"}
#: What ends a conversation in each state: cost and edits.
CLOSING = {"0": (0, ""), "a": (0, ""), "u": (INSERT, "I"), "s": (2 * INSERT, "II")}
ROLES = {"u": "user", "a": "assistant"}

#: Signs of a signature: the role's initial (o: any other), in capitals if the row is truncated; a row that must go has
#: the sign of its initial in GONE.
INITIALS, GONE = "suao", {"s": "1", "u": "2", "a": "3", "o": "4"}
_INITIAL = {**{c: c for c in INITIALS}, **{c.upper(): c for c in INITIALS}, **{v: k for k, v in GONE.items()}}
LEGAL = {"su", "ua", "au"}


def solve(signature: str) -> dict[str, dict[str, tuple[int, str]]]:
    """For each state before the rows, and each state after them that can be reached: the least cost and the first edits of that cost.

    Inserts stand before a row; those after the last row of all are CLOSING.
    """

    @cache
    def best(at: int, state: str, inserted: int) -> dict[str, tuple[int, str]]:
        if at == len(signature):
            return {state: (0, "")}
        found: dict[str, tuple[int, str]] = {}

        def offer(cost: int, edit: str, rest: dict[str, tuple[int, str]]) -> None:
            for end, (more, edits) in rest.items():
                if end not in found or (cost + more, edit + edits) < found[end]:
                    found[end] = cost + more, edit + edits

        sign = signature[at]
        offer(DELETE, "D", best(at + 1, state, 0))
        if sign.isalpha():
            stays = TRUNCATED * sign.isupper()
            if sign.lower() == NEXT[state] or state == "0" and sign.lower() == "s":
                offer(KEEP + stays, "K", best(at + 1, sign.lower(), 0))
            offer(REROLE + stays, "R", best(at + 1, NEXT[state], 0))
        if inserted < 2:  # two more turns would lead back to the same state
            offer(INSERT, "I", best(at, NEXT[state], inserted + 1))
        return found

    return {state: best(0, state, 0) for state in STATES}


def joined(ways: list[list[dict]]) -> tuple[int, str, list[tuple[str, str]]]:
    """Cost, edits, and (state before, edits) of each piece, of the best way through pieces of these ways."""
    now: dict[str, tuple[int, int, tuple | None]] = {"0": (0, 0, None)}  # of each state: cost, rank among the edits so far, and the way back
    for piece in ways:
        after: dict[str, tuple[int, int, str, str]] = {}
        for w in piece:
            if w["start"] in now:
                cost, rank, _ = now[w["start"]]
                new = cost + w["cost"], rank, w["edits"], w["start"]
                after[w["end"]] = min(new, after.get(w["end"], new))
        # Edits that end in a row are no beginnings of each other, so those of earlier pieces decide first.
        ranks = {end: k for k, end in enumerate(sorted(after, key=lambda s: after[s][1:3]))}
        now = {end: (cost, ranks[end], (now[start][2], start, edits)) for end, (cost, _, edits, start) in after.items()}
    ends = []
    for state, (cost, _, back) in now.items():
        more, last = CLOSING[state]
        steps = []
        while back is not None:
            steps.append((back[1], back[2]))
            back = back[0]
        steps.reverse()
        if last:
            steps[-1] = steps[-1][0], steps[-1][1] + last
        ends.append((cost + more, "".join(x for _, x in steps), steps))
    return min(ends)


def replay(signature: str, state: str, edits: str) -> list[str]:
    """What each row becomes, as signs: U and A are inserted turns before it, u and a rerole it, = keeps it, - deletes it. Inserts after the last row stand with it."""
    out, now = [], ""
    for edit in edits:
        if edit == "I":
            state = NEXT[state]
            now += state.upper()
            continue
        if edit == "R":
            state = NEXT[state]
        elif edit == "K":
            state = _INITIAL[signature[len(out)]]
        out.append(now + {"D": "-", "R": state, "K": "="}[edit])
        now = ""
    out[-1] += now
    return out


def illegal_pairs(signature: str) -> int:
    """Neighbours whose roles do not follow each other."""
    roles = [_INITIAL[c] for c in signature]
    return sum(a + b not in LEGAL for a, b in zip(roles, roles[1:], strict=False))


def damage(rows: DataFrame, remove: str = SENTENCE_ENDS) -> DataFrame:
    """Rows as a faulty store would give them, by a hash of conv_id and turn: dropped, emptied, without sentence ends, doubled, or with role user."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(plain("text"), remove, "")).otherwise(plain("text"))
    role = F.when(kind == 4, "user").otherwise(plain("role"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def judged(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (conv, turn, role, text) numbered in their conversation, with piece, fault and sign."""
    plain = rows.select(named(F.col("conv_id")).alias("conv"), "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    order = ["turn", "role", "text_sum"]
    # salt deals equal rows of one turn over tasks; they are alike, so any of them may come first.
    kept = plain.withColumn("text_sum", F.sha2("text", 256)).withColumn("salt", F.monotonically_increasing_id())
    at = scratch.write(numbered(scratch.write(kept, "kept"), "conv", [*order, "salt"], scratch, "sorted").drop("salt", "many"), "numbered")
    scratch.drop("kept", "sorted", "sorted_shares")
    first = at.groupBy("conv", "role", "text_sum").agg(F.min("place").alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    both = at.join(scratch.write(first, "first"), ["conv", "role", "text_sum"], "left")
    said = F.btrim("text", F.lit(BLANKS))
    fault = (
        F.when(said == "", "blank").when(F.col("place") > F.col("first"), "duplicate")
        .when(F.instr(F.lit(SENTENCE_ENDS), F.right(said, F.lit(1))) == 0, "truncated")
    )
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin(*"sua"), initial).otherwise("o")
    sign = F.when(F.col("fault").isin("blank", "duplicate"), F.translate("initial", INITIALS, "".join(GONE[c] for c in INITIALS))).when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    rows = both.withColumns({"fault": fault, "initial": initial}).withColumn("sign", sign)
    rows = scratch.write(rows.select("conv", "turn", "role", "text", "place", F.expr(f"place div {PIECE}L").alias("piece"), "fault", "sign"), "judged")
    scratch.drop("numbered", "first")
    return rows


SOLVED = "signature string, inside bigint, ways array<struct<start:string,end:string,cost:bigint,edits:string>>"


def solutions(signatures: DataFrame) -> DataFrame:
    """SOLVED rows of distinct signatures: illegal neighbours inside, and the best edits from each state to each."""
    way = pa.struct([("start", pa.string()), ("end", pa.string()), ("cost", pa.int64()), ("edits", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.column("signature").slice(k, 64)
                solved = [[{"start": s, "end": e, "cost": c, "edits": t} for s, ends in solve(x).items() for e, (c, t) in ends.items()] for x in part.to_pylist()]
                inside = [illegal_pairs(x) for x in part.to_pylist()]
                yield pa.RecordBatch.from_arrays([part, pa.array(inside, pa.int64()), pa.array(solved, pa.list_(way))], names=["signature", "inside", "ways"])

    return signatures.select("signature").mapInArrow(run, SOLVED)


PLANNED = "conv string, illegal bigint, cost bigint, audit string, pieces array<struct<piece:bigint,plan:array<string>>>"


def plans(pieces: DataFrame) -> DataFrame:
    """PLANNED rows from (conv, pieces: array of (piece, signature, inside, ways) in order)."""
    plan = pa.list_(pa.struct([("piece", pa.int64()), ("plan", pa.list_(pa.string()))]))

    def one(found: list[dict]) -> tuple[int, int, str, list[dict]]:
        illegal = sum(x["inside"] for x in found) + sum(_INITIAL[a["signature"][-1]] + _INITIAL[b["signature"][0]] not in LEGAL for a, b in zip(found, found[1:], strict=False))
        cost, edits, steps = joined([x["ways"] for x in found])
        return illegal, cost, edits, [{"piece": x["piece"], "plan": replay(x["signature"], *step)} for x, step in zip(found, steps, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                done = [one(x) for x in part.column("pieces").to_pylist()]
                columns = [pa.array([x[i] for x in done], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.string(), plan))]
                yield pa.RecordBatch.from_arrays([part.column("conv"), *columns], names=["conv", "illegal", "cost", "audit", "pieces"])

    return pieces.select("conv", "pieces").mapInArrow(run, PLANNED)


def planned(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """PLANNED rows of every conversation of judged rows."""
    signed = F.array_join(F.sort_array(F.collect_list(F.struct("place", "sign")))["sign"], "")  # of one piece
    pieces = scratch.write(rows.groupBy("conv", "piece").agg(signed.alias("signature")), "pieces")
    solved = scratch.write(solutions(pieces.select("signature").distinct()), "solved")
    gathered = pieces.join(solved, "signature").groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("piece", "signature", "inside", "ways"))).alias("pieces"))
    return scratch.write(plans(gathered), "plans")


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The turns left, in order of (conv, place, step): role and text."""
    each = plans.select("conv", F.explode("pieces").alias("p")).select("conv", "p.piece", "p.plan")
    what = F.element_at("plan", (F.col("place") - F.col("piece") * PIECE + 1).cast("int"))
    signs = F.posexplode(F.split(what, "")).alias("step", "edit")
    steps = rows.join(each, ["conv", "piece"]).select("conv", "place", "role", "text", signs).where("edit not in ('', '-')")
    role = F.when(F.lower("edit") == "u", ROLES["u"]).when(F.lower("edit") == "a", ROLES["a"]).otherwise(F.col("role"))
    text = F.when(F.col("edit").isin("U", "A"), "").otherwise(F.col("text"))
    return steps.select("conv", "place", "step", role.alias("role"), text.alias("text"))


def digests(turns: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of turns (conv, place, step, role, text): a hash that is carried from turn to turn, whatever their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            done = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text")), strict=True):
                if conv != at:
                    if state is not None:
                        done.append((at, state.hexdigest()))
                    at, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            yield _digest_rows(done)
        if state is not None:
            yield _digest_rows([(at, state.hexdigest())])

    return turns.repartition("conv").sortWithinPartitions("conv", "place", "step").select("conv", "role", "text").mapInArrow(run, "conv string, repaired_sha256 string")


def _digest_rows(done: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], pa.string()) for k in (0, 1)], names=["conv", "repaired_sha256"])


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Judged rows, PLANNED rows, and the turns left."""
    scratch = Scratch(conversations.sparkSession, "conversations")
    rows = judged(conversations, scratch)
    made = planned(rows, scratch)
    return rows, made, repaired(rows, made)


def report(every: DataFrame, rows: DataFrame, made: DataFrame, turns: DataFrame) -> DataFrame:
    """A row for each conv_id of every: what was wrong, the edits and the digest of the repaired turns."""
    nothing = hashlib.sha256(b"").hexdigest()
    of = lambda name: F.count_if(F.col("fault") == name).alias(name)
    turn = F.col("turn").cast("bigint")
    gaps = F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn)
    counts = rows.groupBy("conv").agg(F.coalesce(gaps, F.lit(0).cast("bigint")).alias("gaps"), of("blank"), of("duplicate"), of("truncated"))
    found = counts.join(made.select("conv", "illegal", "cost", "audit"), "conv").join(digests(turns), "conv", "left")
    ids = every.select("conv_id", named(F.col("conv_id")).alias("conv")).distinct()
    number = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return ids.join(found, "conv", "left").select(
        "conv_id", *map(number, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
