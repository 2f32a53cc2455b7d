"""The lexer and the reader of clauses, and which texts reach them."""

import pytest
from pyspark.sql import functions as F
from test_rules import YEARS, inputs, listings

from hirelens.operators import experience
from hirelens.operators.clauses import Clause, Reader, clauses, plain, tokens


def read(*texts, source="s"):
    return [(k, c.text) for k, c in clauses([(source, t) for t in texts], experience.OPTIONAL)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (None, ""), ("Twenty-five  YEARS", "25 years"), ("One (1) year", "1 year"), ("three (5) years", "3 years"), ("between three and five years", "3-5 years"),
        ("5 or more years", "5+ years"), ("a B.S. or Ph.D. in", "a bs or phd in"), ("x&nbsp;<b>y</b>\u200b\u2013z", "x y -z"), ("5 or greater things", "5 or greater things"), ("someone", "someone"),
    ],
)
def test_plain(text, want):
    assert plain(text) == want


def test_numbers_that_differ_are_marked():
    assert [(t.text, t.conflict) for t in tokens("three (5) years, 4 (4) years") if t.kind == "number"] == [("3", True), ("4", False)]
    assert Clause(tokens("with three (5) years")).conflicts == [5]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("a; b\nc<br>d \u2022 e", ["a", "b", "c", "d", "e"]), ("One two. Three (e) f.g 3.5 x.7", ["1 2", "3 (e) f", "g 3.5 x", "7"]), ("* a\n- b", ["a", "b"]),
        ("engineering10 - 20 years", ["engineering", "10 - 20 years"]), ("relatedExperience in USMinimum", ["related", "experience in us", "minimum"]),
        ("x Preferred Qualifications: y", ["x", "preferred qualifications:", "y"]), ("a, also b in addition c", ["a", "b", "c"]), ("a, preferably b", ["a", "preferably b"]),
        ("degree preferred 3 years", ["degree preferred", "3 years"]), ("5 years preferred 3 years", ["5 years preferred 3 years"]), ("(is a plus) 3 years", ["(is a plus)", "3 years"]),
        ("required certification", ["required", "certification"]), ("2 years experience, a master", ["2 years experience", "a master"]), ("2 years, a master", ["2 years, a master"]), ("", []), (" \n;", []),
    ],
)
def test_pieces(text, want):
    assert [Clause(p).text.strip() for p in Reader(tokens(text)).read()] == want


def test_alternatives_stay_together():
    assert read("BS with 5 years\nOR\nMS with 3 years") == [(0, "bs with 5 years or ms with 3 years")]
    assert read("a", "or b", "c") == [(0, "a or b"), (2, "c")]
    assert read("a or", "b") == [(0, "a or b")]
    assert [t for _, t in read("Option 1: x 2 years. Option 2: y 3 years.")] == ["x 2 years or y 3 years"]
    assert [t for _, t in read("Bachelor and 5 years experience. Master and 3 years experience.")] == ["bachelor and 5 years experience or master and 3 years experience"]
    assert len(read("Bachelor and 5 years experience", "Master and 3 years experience")) == 2
    mixed = list(clauses([("a", "x or"), ("b", "y")], experience.OPTIONAL))
    assert [c.text for _, c in mixed] == ["x or", "y"]


def test_branches():
    texts = lambda x: [b.text.strip() for b in Clause(tokens(x)).branches]
    assert texts("bs in science or mathematics or a master or 5 years") == ["bs in science or mathematics", "a master", "5 years"]
    assert texts("x or current nursing license or practical work") == ["x", "current nursing license or practical work"]
    line = Clause(tokens("5 years or ms"))
    assert [line.text[b.start : b.end] for b in line.branches] == ["5 years ", " ms"]


def test_only_speaking_texts_reach_python(spark):
    """What the filter leaves out has nothing to parse."""
    rows = listings(spark, [*YEARS, {"id": "silent", "description": "No limits, 5 days. " * 50}, {"id": "hidden", "description": "3 ye\u200bars of exp\u200berience"}])
    said = {r.id: r.s for r in rows.select("id", experience.speaking(experience.inputs()).alias("s")).collect()}
    assert not said["silent"] and said["hidden"]
    for c in YEARS:
        if not said[c["id"]]:
            assert experience.parse(inputs(c)) == {"years": None, "status": "unspecified", "evidence": []}
    got = {r.id: r for r in experience.with_years(rows).select("id", "required_years_experience", F.try_variant_get("required_years_experience_metadata", "$.status", "string").alias("s")).collect()}
    assert got["silent"].s == "unspecified" and got["hidden"].required_years_experience == 3


@pytest.mark.parametrize(("text", "years"), [("3 years of x, y and z, " * 10_000, None), ("5 years experience, a, b, " * 10_000, 5), ("word " * 100_000 + "2 years experience", 2), ("or 3 years, " * 3000, None)])
def test_very_long_texts(text, years):
    """One clause of many durations, commas or alternatives takes time in proportion to its length."""
    assert experience.parse([{"source": "description", "heading": None, "text": text}])["years"] == years
