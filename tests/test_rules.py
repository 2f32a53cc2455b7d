"""The golden cases of the two text rules, and normalization."""

import json

import pytest
from pyspark.sql import functions as F

from hirelens.functions.columns import normalized
from hirelens.operators import experience, work_setting
from hirelens.operators.listings import HIGHLIGHTS
from hirelens.plans.parsing import CASES

SETTINGS, YEARS = (json.loads((CASES / f"{n}.json").read_text()) for n in ("work_setting", "required_experience"))


def listings(spark, cases):
    rows = [(c["id"], c.get("title", "Data Engineer"), c.get("description"), c.get("extensions", []), [(h.get("title"), h.get("item")) for h in c.get("highlights", [])], c.get("wfh"), c.get("metadata")) for c in cases]
    return spark.createDataFrame(rows, f"id string, job_title string, job_description string, work_setting_extensions array<string>, work_setting_highlights {HIGHLIGHTS}, work_from_home boolean, work_setting_source_metadata string")


def test_work_setting(spark):
    got = {r.id: r.work_setting for r in work_setting.classify(listings(spark, SETTINGS)).select("id", "work_setting").collect()}
    assert got == {c["id"]: c["expected"] for c in SETTINGS}
    assert len(got) == 196


def test_work_setting_metadata(spark):
    rows = work_setting.classify(listings(spark, SETTINGS)).select("id", F.to_json("work_setting_metadata").alias("m")).where("id in ('null', 'true_flag')").collect()
    got = {r.id: json.loads(r.m) for r in rows}
    assert got["null"] == {"rule": "insufficient_evidence", "evidence": [], "confidence": "low", "conflict": False}
    assert list(got["true_flag"]) == ["confidence", "conflict", "evidence", "rule"]
    assert got["true_flag"]["evidence"] == [{"source": "serpapi_wfh", "text": "true", "normalized": "true", "strength": 1, "setting": "Remote", "conflict": False, "negative_remote": False, "office_days": None, "remote_days": None}]


def inputs(c):
    found = [("title", "", c.get("title", "Data Engineer")), ("description", "", c.get("description")), ("linkedin_preferences", "", c.get("metadata"))]
    found += [("highlight:" + (h.get("title") or ""), h.get("title"), h.get("item")) for h in c.get("highlights", [])]
    found += [("serpapi_extension", "", e) for e in c.get("extensions", [])]
    return [dict(zip(("source", "heading", "text"), x, strict=True)) for x in found]


@pytest.mark.parametrize("case", YEARS, ids=lambda c: c["id"])
def test_experience(case):
    assert experience.parse(inputs(case))["years"] == case["expected"]


def test_experience_table(spark):
    got = experience.with_years(listings(spark, YEARS))
    assert {r.id: r.required_years_experience for r in got.select("id", "required_years_experience").collect()} == {c["id"]: c["expected"] for c in YEARS}
    statuses = {r.s for r in got.select(F.try_variant_get("required_years_experience_metadata", "$.status", "string").alias("s")).collect()}
    assert statuses == {"ambiguous", "explicit_requirement", "unspecified"}


def test_normalized(spark):
    cases = [(None, None), ("", ""), (" \t\n", ""), ("ＦＵＬＬ\t Ｗｉｄｔｈ\n x", "full width x"), ("‘a’ “b”", "'a' \"b\""), ("a‐b‑c‒d–e—f―g−h", "a-b-c-d-e-f-g-h"), ("Café  X", "café x"), ("C++; .NET!", "c++; .net!")]
    rows = spark.createDataFrame([(k, x) for k, (x, _) in enumerate(cases)], "k int, x string")
    assert [r.y for r in rows.select("k", normalized("x").alias("y")).orderBy("k").collect()] == [y for _, y in cases]
