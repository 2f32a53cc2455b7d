"""Conversation repair against a plain version, and the recursion against all edits."""

import itertools
import random

import brute
import pytest
from pyspark.sql import functions as F

from hirelens.llm import conversation_repair, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def run(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("conv", "place", "sign", "fault", "piece", "plan", "copy", "edits")})
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    return sorted((tuple(r) for r in queries.op13_conversation_repair(spark, str(tmp_path)).collect()), key=str)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_conversations(spark, scale):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{scale}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(tuple(r) for r in queries.op13_conversation_repair(spark, f"/root/testdata/{scale}").collect())
    assert got == sorted(brute.repairs(rows))
    assert len({r[7] for r in got}) > 5


def some_rows(seed, n=60):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", "Ends. ", "e.g. é", None, "Yes"]
    for conv in [None, *range(n)]:
        for turn in range(rng.choice([1, 2, 3, 5, 8, 30])):
            at = rng.choice([turn, turn, turn, turn + 1, None, 2 * turn])
            yield conv, at, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "upper"]), rng.choice(texts)


@pytest.mark.parametrize(("seed", "piece"), [(1, 200), (2, 3), (3, 1)])
def test_all_kinds_of_rows(spark, tmp_path, seed, piece, monkeypatch):
    """Nulls, blank and repeated rows, one turn twice, other roles; pieces of any size give the same."""
    monkeypatch.setattr(conversation_repair, "PIECE", piece)
    rows = list(some_rows(seed))
    assert run(spark, rows, tmp_path) == sorted(brute.repairs(rows), key=str)


def test_long_conversations(spark, tmp_path):
    """One of 3,000 turns, in pieces, and one of all rows alike; texts of 300,000 signs."""
    rng = random.Random(5)
    rows = [(1, k, rng.choice(["user", "assistant", "assistant", "system"]), f"t{k}" + rng.choice([".", "", "!"])) for k in range(3000)]
    rows += [(2, 7, "user", "Same.")] * 500 + [(3, 0, "user", "x" * 300_000 + "."), (3, 1, "assistant", "y" * 300_000)]
    assert run(spark, rows, tmp_path) == sorted(brute.repairs(rows), key=str)


def test_empty(spark, tmp_path):
    assert run(spark, [], tmp_path) == []


def test_a_conversation_without_rows_left(spark, tmp_path):
    gone = [(k, 0, "user", "Hi.") for k in range(200) if not list(brute.damaged([(k, 0, "user", "Hi.")]))]
    assert gone
    assert run(spark, gone, tmp_path) == sorted(((k, 0, 0, 0, 0, 0, 0, "", brute.sha("")) for k, *_ in gone), key=str)


def every_edit(signature):
    """(cost, audit) of all edits that make a legal conversation, with up to two inserts at each place."""
    due = {"0": "u", "s": "u", "u": "a", "a": "u"}
    for row_edits in itertools.product("DKR", repeat=len(signature)):
        for inserts in itertools.product(range(3), repeat=len(signature) + 1):
            state, cost, audit = "0", 0, ""
            for sign, edit, many in zip([*signature, None], [*row_edits, None], inserts, strict=True):
                for _ in range(many):
                    state, cost, audit = due[state], cost + 5, audit + "I"
                if edit is None:
                    break
                initial, must_go = conversation_repair._INITIAL[sign], not sign.isalpha()
                if edit != "D" and must_go or edit == "K" and not (initial == due[state] or state == "0" and initial == "s"):
                    break
                cost += {"D": 2, "K": 0, "R": 1}[edit] + 5 * (edit != "D" and sign.isupper())
                state = state if edit == "D" else initial if edit == "K" else due[state]
                audit += edit
            else:
                continue
            if edit is None and state in "0a":
                yield cost, audit


@pytest.mark.parametrize("seed", range(4))
def test_the_recursion_finds_the_first_of_the_cheapest(seed):
    rng = random.Random(seed)
    for _ in range(25):
        signature = "".join(rng.choice("suaoSUAO1234uauaua") for _ in range(rng.randint(1, 4)))
        ways = lambda x: [{"start": s, "end": e, "cost": c, "edits": t} for s, ends in conversation_repair.solve(x).items() for e, (c, t) in ends.items()]
        want = min(every_edit(signature))
        assert conversation_repair.joined([ways(signature)])[:2] == want, signature
        cut = rng.randint(0, len(signature))
        assert conversation_repair.joined([ways(x) for x in (signature[:cut], signature[cut:]) if x])[:2] == want, signature


def test_a_signature_is_solved_once(spark):
    """However many conversations have it."""
    scratch = conversation_repair.Scratch(spark, "test")
    rows = [(k, t, r, f"{k} {t}.") for k in range(500) for t, r in enumerate(("user", "assistant", "user"))]
    made = conversation_repair.planned(conversation_repair.judged(spark.createDataFrame(rows, SCHEMA), scratch), scratch)
    assert made.select("audit").distinct().count() == 1 and made.count() == 500
    assert spark.read.parquet(f"{scratch.root}/solved").count() == 1
