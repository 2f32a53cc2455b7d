"""From raw records to reporting tables, on literal rows."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hirelens.functions.columns import json_strings, json_text
from hirelens.operators import listings as L
from hirelens.plans import parsing
from hirelens.plans.models import Context
from hirelens.sources import records, sinks


def record(job, fetched="2026-09-01T12:00:00Z", query_id=1, **extra):
    body = {"source_name": "api", "query_id": query_id, "q": "data+engineer", "location": "united states", "fetched_at": fetched, "page": 1, "job": job}
    return json.dumps(body | extra)


JOB = {
    "job_id": "a", "title": "Sr Data Engineer", "company_name": "Acme", "via": "Board", "location": "Denver, CO", "description": "This role is fully remote. 5 years of experience required. Bachelor's degree.",
    "extensions": ["3 days ago", 7, None, "120K–150K a year", "Full-time"], "detected_extensions": {"posted_at": "3 days ago", "schedule_type": "Full-time", "work_from_home": True},
    "job_highlights": [{"title": "Role", "items": ["x", 1, "y"]}, {"items": "bad"}, {"title": None, "items": ["z"]}],
}


@pytest.fixture(scope="module")
def ctx(spark):
    lines = [record(JOB), record(JOB, "2026-09-10T12:00:00Z"), record(JOB | {"job_id": "b", "title": "Pilot II", "description": None}, "2026-10-09T01:00:00Z", 2)]
    raw = records.envelopes(spark.createDataFrame([(x, "f.jsonl") for x in lines], "value string, file string"))
    linked = spark.createDataFrame([("l", "desc", datetime(2026, 10, 9, 5), "Data Engineer", "utah", "Analyst", "Salt Lake City, UT · Reposted 2 weeks ago · 9 people", "$50/hr - $60/hr · Hybrid · Full-time")], records.LINKEDIN)
    seed = spark.createDataFrame([(1, "data+engineer", "united states", "en", "us", 200, "google.com", 1), (2, "pilot", None, "en", "us", 0, "google.com", 1)], records.SEED)
    enriched = spark.createDataFrame([], records.ENRICHED)
    return Context(spark, {"api_jobs": raw, "linkedin_jobs": linked, "query_versions": seed, "enriched": enriched}, date(2026, 10, 10))


def test_parse(ctx):
    row = ctx.ref("int_api_jobs").where("platform_job_id = 'a'").orderBy("created_at_utc").first()
    assert (row.search_term, row.low_annual_pay_range, row.high_annual_pay_range) == ("Data Engineer", 3.0, 3.0) or row.low_annual_pay_range == 120_000
    assert row.posted_date_parsed == date(2026, 8, 29)
    assert row.work_from_home is True
    assert row.degree_requirement == "Bachelor's"
    assert row.created_at_mst == datetime(2026, 9, 1, 6)
    assert [tuple(h) for h in row.work_setting_highlights] == [("Role", "x"), ("Role", "y"), (None, "z")]
    assert row.work_setting_extensions == ["3 days ago", "120K–150K a year", "Full-time"]


def test_linkedin(ctx):
    row = ctx.ref("int_linkedin_jobs").first()
    assert (row.low_annual_pay_range, row.high_annual_pay_range) == (96_000, 115_200)
    assert row.posted_date_parsed == date(2026, 9, 25)
    assert (row.schedule_type, row.work_location, row.job_location) == ("Full-time", "Hybrid", "Salt Lake City, UT ")


def test_detail(ctx):
    rows = {r.platform_job_id: r for r in ctx.ref("jobs_detail").collect()}
    assert set(rows) == {"a", "b", "l"}
    a = rows["a"]
    assert (a.work_setting, a.required_years_experience, a.job_level) == ("Remote", 5, "Senior")
    assert (a.listing_status, a.removed_date, a.days_listed) == ("Removed", date(2026, 9, 11), 12)
    assert (rows["b"].listing_status, rows["b"].job_level) == ("Active", "Mid Level")
    assert rows["b"].work_setting == "Remote"  # by its flag


def test_reports_keep_the_grain(ctx):
    assert ctx.ref("jobs_detail_report").count() == 3
    flow = {(r.week_beginning, r.type): r.jobs_count for r in ctx.ref("jobs_flow_week").where("search_term = 'Data Engineer' and job_platform = 'Board'").collect()}
    assert flow == {(date(2026, 8, 23), "New Jobs"): 1, (date(2026, 9, 6), "Removed Jobs"): 1}
    scores = ctx.ref("opportunity_month")
    assert scores.groupBy("month_start_date", "search_term", "search_location").count().where("count > 1").isEmpty()
    assert scores.where("opportunity_score < 0 or opportunity_score > 100").isEmpty()
    assert scores.where("active_jobs_count = 0 and new_jobs_count = 0 and prior_month_new_jobs_count = 0 and growth_score <> 0").isEmpty()
    assert ctx.ref("rpt_job_skills").isEmpty()


@pytest.mark.parametrize(("text", "low", "high"), [("$120K - $150K", 120e3, 150e3), ("$50/hr - $60/hr", 96e3, 115.2e3), ("$120,000", 120e3, None), ("", None, None)])
def test_preference_pay(spark, text, low, high):
    pay = L.preference_pay("t")
    assert tuple(spark.createDataFrame([(text,)], "t string").select(pay["low"], pay["high"]).first()) == (low, high)


@pytest.mark.parametrize(("text", "low", "high"), [("20 hours ago", 38400, 38400), ("$120,000 a year", 120, 0), ("10.5–12 an hour", 20160, 23040), ("no pay", None, None)])
def test_annual_pay_keeps_its_quirks(spark, text, low, high):
    pay = L.annual_pay(F.array("t"))
    assert tuple(spark.createDataFrame([(text,)], "t string").select(pay["low"], pay["high"]).first()) == (low, high)


@pytest.mark.parametrize(("details", "day"), [("x · 3 hours ago", date(2026, 3, 30)), ("x · Reposted 2 weeks ago", date(2026, 3, 17)), ("x · 1 month ago", date(2026, 2, 28)), ("x", None), (None, None), ("x · some days ago", None)])
def test_linkedin_dates(spark, details, day):
    row = spark.createDataFrame([(details, datetime(2026, 3, 31, 2))], "d string, t timestamp")
    assert row.select(L.linkedin_posted_date("d", "t")).first()[0] == day


def test_json_rules(spark):
    v = F.parse_json(F.lit('{"o": {"z": 1, "a": 2}, "n": null, "t": true, "s": "", "l": ["b", "b", "", 1, null, {"x": 1}], "w": {"k": []}}'))
    row = spark.range(1).select(json_text(v, "$.o"), json_text(v, "$.n"), json_text(v, "$.t"), json_text(v, "$.s"), json_text(v, "$.q"), json_strings(v, "$.l"), json_strings(v, "$.w"), json_strings(v, "$.q")).first()
    assert list(row) == [None, None, "true", "", None, ["b", "b", ""], [], []]


def test_skills(spark):
    rows = [("1", "A", "old", datetime(2026, 1, 1)), ("1", "A", " sql,Python , ,SQL, 5 years x", datetime(2026, 1, 2)), ("1", "B", "go", datetime(2026, 1, 1))]
    got = L.format_skills(L.dim_job_skills(spark.createDataFrame(rows, records.ENRICHED)))
    assert {tuple(r) for r in got.select("job_id", "data_source", "skill").collect()} == {("1", "A", "SQL"), ("1", "A", "PYTHON"), ("1", "B", "GO")}


def test_searches(spark):
    seed = spark.createDataFrame([(2, " data+engineer ", "Utah%2C United States", "", "us", 0, None, 1), (1, "x", None, "en", "us", 5, "g", 1), (3, "y", None, None, None, 1, None, 0)], records.SEED)
    got = [(r.query_id, r.q, r.location, r.hl, r.max_jobs) for r in records.active_searches(seed).collect()]
    assert got == [(1, "x", None, "en", 5), (2, "data engineer", "Utah, United States", None, 250)]


def test_partitions():
    assert sinks.partitions_to_replace(date(2026, 3, 1), " 2 ") == [date(2026, 3, 1), date(2026, 2, 28)]
    for bad in (0, -1, "x", "", 1.5):
        with pytest.raises(ValueError):
            sinks.partitions_to_replace(date(2026, 3, 1), bad)


def test_overwrite_days(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    days = [date(2026, 1, 1), date(2026, 1, 2)]
    old = spark.createDataFrame([(1, days[0]), (2, days[1])], "x int, created_date date")
    sinks.overwrite_days(old, path, days)
    sinks.overwrite_days(spark.createDataFrame([(9, days[0]), (9, days[1])], "x int, created_date date"), path, days[1:])
    assert {(r.x, r.created_date) for r in spark.read.parquet(path).collect()} == {(1, days[0]), (9, days[1])}
    with pytest.raises(ValueError):
        sinks.overwrite_days(old.withColumn("y", F.lit(1)), path, days)


def test_append_needs_a_table(spark):
    rows = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError):
        sinks.append(rows, "absent_table")
    sinks.materialize(rows, "present_table", "marts")
    sinks.append(rows, "present_table")
    assert spark.table("present_table").count() == 2
    spark.sql("drop table present_table")


def test_every_model_is_written_once(spark, ctx, tmp_path, monkeypatch):
    """The task writes each table and reads it back for those that follow; rows are those of one plan."""
    from hirelens.plans import tasks
    from hirelens.plans.models import MODELS

    lines = [record(JOB), record(JOB, "2026-09-10T12:00:00Z"), record(JOB | {"job_id": "b", "title": "Pilot II"}, "2026-10-09T01:00:00Z", 2)]
    (tmp_path / "api").mkdir()
    (tmp_path / "api" / "x.jsonl").write_text("\n".join([*lines, "{broken"]))
    ctx.raw["linkedin_jobs"].write.parquet(f"{tmp_path}/linkedin")
    spark.createDataFrame([("a", "Serpapi", "python, sql", datetime(2026, 9, 2))], records.ENRICHED).write.parquet(f"{tmp_path}/enriched")
    names = [c.split()[0] for c in records.SEED.split(", ")]
    (tmp_path / "query_versions.csv").write_text(",".join(names) + "\n1,data+engineer,united states,en,us,200,google.com,1\n")
    for name, value in (("RAW_DIR", str(tmp_path)), ("OUT_DIR", f"{tmp_path}/out"), ("AS_OF", "2026-10-10")):
        monkeypatch.setenv(name, value)
    assert tasks.build_models() == 0
    whole = tasks.context(spark)
    for name in MODELS:
        made, want = spark.read.parquet(f"{tmp_path}/out/{name}"), whole.ref(name)
        assert sorted(made.columns) == sorted(want.columns) and made.count() == want.count(), name  # the day of a folder is read last
    detail = spark.read.parquet(f"{tmp_path}/out/jobs_detail")
    assert {r.work_setting for r in detail.where("platform_job_id = 'a'").collect()} == {"Remote"}


def test_skills_are_told_apart_inside_a_row(spark):
    """No aggregation over all skills, which a task would keep in memory."""
    rows = [("j1", "a", "SQL, sql ,, Spark", 1), ("j1", "a", "Go", 0), ("j1", "b", "sql", 1), (None, "a", "X,x", 1), ("j2", "a", None, 1)]
    enriched = spark.createDataFrame(rows, "job_id string, data_source string, skills string, n int").selectExpr("job_id", "data_source", "skills", "timestamp_seconds(n) as created_at")
    got = L.dim_job_skills(enriched)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("j1", "a", "SQL"), ("j1", "a", "SPARK"), ("j1", "b", "SQL"), (None, "a", "X")], key=str)
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_degree_cues(spark):
    """A text that a degree's pattern matches has one of its cues, and its JSON is written once and orders are dealt over all tasks."""
    texts = ["high school diploma", "a high school degree", "ged", "associate", "associates", "associate's degree", "a.s. or", "x a.a. y", "2 year degree", "2-year degree", "bachelors", "b.s. x", "b.a. x", "b.sc", "b.sc.", "undergraduate degree", "4 year degree"]
    texts += ["masters", "master's", "mba", "m.s. x", "m.a. x", "m.sc", "phd", "ph.d", "p.hd", "p.h.d.", "doctorate", "doctoral", "pledged", "ambassador", "morpheus", "", None]
    plain = L.ladder([(L.matches("t", pattern), name) for name, pattern in L.DEGREES], L.NO_DEGREE)
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", L.degree(F.col("t")).alias("got"), plain.alias("want")).collect()
    assert [(r.t, r.got) for r in got] == [(r.t, r.want) for r in got]
    plan = parsing.api_listing_parse(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [o_orderkey" in plan and plan.count("evaluate(job_data") == 1
