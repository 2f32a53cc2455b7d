"""Tables kept by day: replaced days, emptied ones, programs that end in between, and the table graph run twice."""

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest

from hirelens.plans import tasks
from hirelens.plans.models import INCREMENTAL, Context
from hirelens.sources import records, sinks

DAYS = [date(2026, 1, k) for k in (1, 2, 3)]
SCHEMA = "created_date date, x int"


def rows_of(spark, *rows):
    return spark.createDataFrame([(DAYS[d], x) for d, x in rows], SCHEMA)


def told(table):
    return sorted((r.created_date.day, r.x) for r in table.read().collect())


@pytest.fixture
def table(spark, tmp_path):
    made = sinks.DayTable(spark, f"file://{tmp_path}/t")
    made.replace(rows_of(spark, (0, 1), (1, 2), (1, 3), (2, 4)))
    return made


def test_emptied_days(spark, table):
    """Days 1 to 3 are replaced by rows of 1 and 3: the old row of day 2 goes."""
    table.replace(rows_of(spark, (0, 7), (2, 8)), DAYS)
    assert told(table) == [(1, 7), (3, 8)] and table.days() == [DAYS[0], DAYS[2]]
    table.replace(rows_of(spark, (0, 0)), DAYS[1:])  # rows of other days are not taken
    assert told(table) == [(1, 7)]
    table.replace(rows_of(spark), DAYS)
    assert told(table) == [] and table.read().columns == ["x", "created_date"] and table.newest().count() == 0
    table.replace(rows_of(spark, (1, 5)), DAYS)
    assert told(table) == [(2, 5)]


def test_the_whole_table(spark, table):
    """Without days everything goes, and the columns may change; rows without a day are kept."""
    table.replace(spark.createDataFrame([(None, "a"), (DAYS[1], "b")], "created_date date, y string"))
    assert sorted((r.y, r.created_date) for r in table.read().collect()) == [("a", None), ("b", DAYS[1])]
    assert [r.y for r in table.newest().collect()] == ["b"]
    with pytest.raises(ValueError, match="differs"):
        table.replace(rows_of(spark, (0, 1)), DAYS)


def test_other_days_keep_their_files(spark, table, tmp_path):
    def files(day):
        return {(p.name, p.stat().st_mtime_ns) for p in (tmp_path / "t" / f"created_date={day}").iterdir()}

    before = files(DAYS[0])
    table.replace(rows_of(spark, (0, 9), (1, 9)), DAYS[1:])
    assert files(DAYS[0]) == before and told(table) == [(1, 1), (2, 9)]


@pytest.mark.parametrize("step", range(1, 13))
def test_a_program_that_ends_at_any_step(spark, table, step, monkeypatch):
    """Whichever change to the store is the last one made, the next program sees the old days or the new ones, never both or neither."""
    made = []

    def counted(name):
        own = getattr(sinks.Folder, name)

        def run(self, *args):
            made.append(name)
            if len(made) >= step:
                raise RuntimeError("ended")
            return own(self, *args)

        return run

    with monkeypatch.context() as patch:
        for name in ("rename", "delete"):
            patch.setattr(sinks.Folder, name, counted(name))
        try:
            table.replace(rows_of(spark, (0, 7), (2, 8)), DAYS)
            committed = True
        except RuntimeError:
            committed = "rename" in made[:-1]  # the first rename makes the commit
    after = told(sinks.DayTable(spark, table.folder.root))
    assert after == ([(1, 7), (3, 8)] if committed else [(1, 1), (2, 2), (2, 3), (3, 4)])
    assert not [n for n in table.folder.names() if n.startswith(("_staged", "_commit"))]


def test_only_the_newest_day_is_read(spark, table):
    assert {Path(f).parent.name for f in table.newest().inputFiles()} == {"created_date=2026-01-03"}
    loads = table.newest().selectExpr("timestamp '2026-01-03 10:00:00' as created_at")
    hours = lambda n: sinks.F.lit(datetime(2026, 1, 3, 10) + timedelta(hours=n))
    assert [records.stale(loads, hours(n)).first().is_stale for n in (74, 75)] == [False, True]


def raw(spark, text, days):
    linked = spark.createDataFrame([(f"{text}{k}", text, datetime(2026, 1, d, 5), "t", "utah", "Analyst", "a · 3 days ago", "$50/hr") for k, d in enumerate(days)], records.LINKEDIN)
    record = '{"source_name": "s", "query_id": 1, "q": "q", "location": "l", "fetched_at": "2026-01-%02dT05:00:00Z", "job": {"job_id": "%s", "title": "T", "description": "%s"}}'
    api = records.envelopes(spark.createDataFrame([(record % (d, f"a{text}{d}", text), "f") for d in days], "value string, file string"))
    seed = spark.createDataFrame([(1, "q", None, "en", "us", 1, "g", 1)], records.SEED)
    return {"linkedin_jobs": linked, "api_jobs": api, "query_versions": seed, "enriched": spark.createDataFrame([], records.ENRICHED)}


def test_the_graph_replaces_changed_days_only(spark, tmp_path):
    """The second run, of two days, parses and writes these alone; a day that raw has lost goes; older files are not touched."""
    out, today = f"file://{tmp_path}", date(2026, 1, 6)

    def files(name, day):
        return {(p.name, p.stat().st_mtime_ns) for p in (tmp_path / name / f"created_date=2026-01-0{day}").glob("*.parquet")}

    tasks.refresh(Context(spark, raw(spark, "old", [1, 3, 5, 6]), today), out)
    before = {(n, d): files(n, d) for n in INCREMENTAL for d in (1, 3)}
    assert all(before.values())
    tasks.refresh(Context(spark, raw(spark, "new", [1, 3, 6]), today), out, 2)
    assert {(n, d): files(n, d) for n in INCREMENTAL for d in (1, 3)} == before
    facts = sinks.DayTable(spark, f"{out}/fact_scraped_jobs")
    assert facts.days() == [date(2026, 1, d) for d in (1, 3, 6)]
    assert sorted((r.created_date.day, r.data_source, r.job_description) for r in facts.read().collect()) == [(d, s, "new" if d == 6 else "old") for d in (1, 3, 6) for s in ("LinkedIn", "Serpapi")]
    # What follows is built from the whole of what is kept.
    assert {r.platform_job_id for r in spark.read.parquet(f"{out}/jobs_detail").collect()} >= {"aold1", "aold3", "anew6"}
