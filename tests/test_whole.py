"""Queries over whole tables: every row, and the whole of each text."""

import re
import unicodedata
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from test_queries import plain

DIR = "/root/testdata/sf0.01"
BLANK = "[ \\t\\n\\r\\x0b\\x0c\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"


@pytest.fixture(scope="module")
def con():
    found = duckdb.connect()
    for path in Path(DIR).glob("*.parquet"):
        found.sql(f"create view {path.stem} as select * from '{path}'")
    return found


def same(spark, con, name):
    made, told = __spark_entry__.queries()[name](spark, DIR), con.sql(__spark_entry__.oracle_sql()[name])
    got, want = made.select(*told.columns).collect(), told.fetchall()
    assert sorted(repr(plain(tuple(r))) for r in got) == sorted(repr(plain(r)) for r in want)
    return got


def normal(x):
    """Compatibility-composed lower case with plain marks and single blanks, sign by sign."""
    x = unicodedata.normalize("NFKC", x).lower()
    for signs, mark in (("‘’‚‛", "'"), ("“”„‟", '"'), ("‐‑‒–—―−", "-")):
        for sign in signs:
            x = x.replace(sign, mark)
    return re.sub(BLANK, " ", x).strip(" \x85")


def test_normalize_text(spark, con):
    want = {i: normal(t) for i, t in con.sql("select doc_id, text from documents").fetchall()}
    got = {r.doc_id: r.normalized for r in __spark_entry__.queries()["normalize_text"](spark, DIR).collect()}
    assert got == want


def test_the_quick_check_knows_its_signs(spark):
    """Each sign of STABLE, alone and after each other one, is as it is under NFKC; texts with others are normalized."""
    from hirelens.functions.columns import STABLE, normalized

    signs = re.findall(f"[{STABLE}]", "".join(map(chr, range(0x2100))))
    assert len(signs) > 300 and all(unicodedata.normalize("NFKC", a + b) == a + b for a in signs for b in signs)
    texts = ["".join(signs), "e\u0301", "\u0149 \u017f \u0132 \ufb01", "\u00b2\u00bd", "a\u0300\u0301", "\u1100\u1161", "日本 ﾊﾝ", "Ünïcode – “quotes”", "x\n"]
    got = [r.n for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k").select(normalized("t").alias("n")).collect()]
    assert got[1:] == [normal(t) for t in texts[1:]]


def test_line_faults(spark, con):
    got = same(spark, con, "line_faults")
    assert len(got) == 10_000 and max(r.event_id for r in got) == 9_999


def test_json_array_strings(spark, con):
    assert len(same(spark, con, "json_array_strings")) == 10_000


def test_not_null_checks(spark, con):
    assert same(spark, con, "not_null_checks")[0].row_count == 10_000


def test_regex_functions(spark, con):
    got = same(spark, con, "regex_functions")
    length = dict(con.sql("select doc_id, length(text) from documents").fetchall())
    assert {r.doc_id: len(r.swapped) for r in got} == length


def test_regex_functions_beyond_a_nul(spark, tmp_path):
    texts = ["x" * 50 + ", one two three", "a\x00b c\x00", "--\x00\n11.22. the", "one  two", "é one two", "w" * 100_000 + "\tand no"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in __spark_entry__.queries()["regex_functions"](spark, str(tmp_path)).collect()}
    assert {k: r.swapped for k, r in got.items()} == {k: re.sub(r"(\w+) (\w+)", r"\2 \1", t, count=1, flags=re.A) for k, t in enumerate(texts)}
    assert got[2].second == "22" and got[2].english and got[2].numbers == 2
