"""Facts of the score: kept ones, brought up to date by changed jobs, are those of a full count."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hirelens.operators import opportunity as O

SCHEMA = "job_id string, search_term string, search_location string, company_name string, created_at_mst timestamp, posted_date date, removed_date date, avg_annual_pay_range double"


def some_job(rng, k):
    day = lambda *years: date(rng.choice(years), rng.randint(1, 12), rng.randint(1, 28))
    posted = rng.choice([None, day(2024, 2025)])
    removed = rng.choice([None, None, day(2023, 2025, 2026)])
    created = rng.choice([None, *[datetime(2025, rng.randint(1, 6), rng.randint(1, 28))] * 6])
    return str(k), rng.choice(["a", "b", "c", None]), rng.choice(["x", "y", None]), rng.choice(["m", "n", " ", None]), created, posted, removed, rng.choice([None, float(rng.randint(1, 9))])


def rows(df):
    return sorted((tuple(r) for r in df.select(*O.GRAIN, "entered", "left", *O.COUNTED).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_updates_equal_a_full_count(spark, seed):
    """Jobs that change, come, go, and move to another month, term or place; nulls everywhere."""
    rng = random.Random(seed)
    old = {k: some_job(rng, k) for k in range(300)}
    new = {k: v for k, v in old.items() if k >= 20} | {k: some_job(rng, k) for k in [*range(20, 60), *range(300, 330)]}
    frame = lambda jobs: spark.createDataFrame(jobs, SCHEMA)
    changed = [k for k in old.keys() | new.keys() if old.get(k) != new.get(k)]
    before, after = (frame([d[k] for k in changed if k in d]) for d in (old, new))
    got = O.updated_facts(O.month_facts(frame(list(old.values()))), before, after, frame(list(new.values())))
    want = [r for r in rows(O.month_facts(frame(list(new.values()))))]
    zero = lambda r: tuple(0 if k in (3, 4) and v is None else v for k, v in enumerate(r))
    assert sorted(map(str, map(zero, rows(got)))) == sorted(map(str, map(zero, want)))
    as_of = F.lit(date(2025, 8, 3))
    score = lambda facts: sorted(str(tuple(r)) for r in O.scores(facts, as_of).collect())
    assert score(got) == score(O.month_facts(frame(list(new.values()))))


def test_nothing_changed(spark):
    rng = random.Random(3)
    jobs = spark.createDataFrame([some_job(rng, k) for k in range(50)], SCHEMA)
    facts = O.month_facts(jobs)
    none = jobs.limit(0)
    zero = lambda rs: sorted(str(tuple(0 if k in (3, 4) and v is None else v for k, v in enumerate(r))) for r in rs)
    assert zero(rows(O.updated_facts(facts, none, none, jobs))) == zero(rows(facts))


def test_no_jobs(spark):
    facts = O.month_facts(spark.createDataFrame([], SCHEMA))
    assert facts.count() == 0 and O.scores(facts, F.lit(date(2025, 8, 3))).count() == 0


def test_counts_of_jobs_expand_no_rows(spark, sf_dir):
    """Distinct counts in two levels: the plans of the figures multiply no rows."""
    from hirelens.plans import adapter as A
    from hirelens.plans import queries as Q
    from hirelens.operators import reports as R

    for made in (R.kpis(A.placed(A.jobs(spark, sf_dir)), A.SOME), R.skill_kpis(*Q._skill_rows(spark, sf_dir), Q.SKILL_SPEC), O.month_facts(A.jobs(spark, sf_dir))):
        assert "Expand" not in made._jdf.queryExecution().executedPlan().toString()


def test_job_counts(spark):
    from hirelens.operators.reports import job_counts

    rows = spark.createDataFrame([("g", "1", 1.0), ("g", "1", None), ("g", "2", None), ("g", None, 5.0), ("h", "1", None)], "k string, job_id string, x double")
    got = {r.k: (r.jobs, r.some, r.mean) for r in job_counts(rows, ["k"], {"some": F.col("x") > 0}, {"mean": F.col("x")}).collect()}
    assert got == {"g": (2, 1, 3.0), "h": (1, 0, None)}
    assert tuple(job_counts(rows.limit(0), [], {"some": F.col("x") > 0}, {"mean": F.col("x")}).first()) == (0, 0, None)
