"""File validation and the states of an ingest."""

import itertools
import json
import shutil
import time
from pathlib import Path

import pytest

from hirelens.sources import records, sinks
from hirelens.streaming import ingest as I

GOOD = {"source_name": "s", "query_id": 1, "q": "q", "location": "l", "fetched_at": "2026-01-01T00:00:00Z", "job": {"job_id": "j"}}


def line(**changes):
    return json.dumps(GOOD | changes)


FILES = {
    "good.jsonl": f"{line()}\n\n{line(q='')}\n", "missing.jsonl": f"{line()}\n{line(job={})}\n", "null.jsonl": line(q=None), "json.jsonl": f"{line()}\n{{oops\n", "nan.jsonl": '{"a": NaN}\n',
    "array.jsonl": "[1]\n", "empty.jsonl": "\n \n", "other.csv": line(),
}
REASONS = {
    "good.jsonl": None, "missing.jsonl": I.FAILED_CHECK, "null.jsonl": I.FAILED_CHECK, "json.jsonl": "invalid_json", "nan.jsonl": "invalid_json", "array.jsonl": "non_object_json",
    "empty.jsonl": I.EMPTY, "other.csv": I.UNSUPPORTED, "utf8.jsonl": "invalid_utf8",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "utf8.jsonl").write_bytes(b'{"a": "\xff\xfe"}\n')
    return tmp_path


def test_verdicts(spark, folder):
    got = I.verdicts(spark, [f"file://{folder}/{n}" for n in REASONS])
    assert {v.file.rsplit("/", 1)[-1]: v.reason for v in got} == REASONS


def test_states(spark, folder):
    loaded, moved, told = [], [], []
    box = I.Ingest(spark, lambda df: loaded.append(df.count()), lambda f, to, why, _: moved.append((Path(f).name, to, why)), told.append)
    states = box.run([f"file://{folder}/good.jsonl", f"file://{folder}/json.jsonl"])
    assert list(states.values()) == ["archived", "rejected:invalid_json"]
    assert loaded == [2]
    assert moved == [("good.jsonl", "archive", None), ("json.jsonl", "rejected", "invalid_json")]
    assert len(told) == 2


def test_retries(spark, folder):
    def fail(df):
        raise TimeoutError

    moved = []
    box = I.Ingest(spark, fail, lambda f, to, why, _: moved.append((to, why)))
    states = [next(iter(box.run([f"file://{folder}/good.jsonl"]).values())) for _ in range(3)]
    assert states == ["incoming", "incoming", "rejected:transient_failure_exhausted"]

    def refuse(df):
        raise I.PermanentError

    assert list(I.Ingest(spark, refuse, lambda *a: None).run([f"file://{folder}/good.jsonl"]).values()) == ["rejected:permanent_failure"]
    assert [I.retry_delay(1), I.retry_delay(2), I.retry_delay(1, 99)] == [60, 120, 70]


def test_retries_outlive_the_checkpoint(spark, tmp_path):
    """A file that failed is offered again after its delay, by a new program too, though the stream has seen it."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "good.jsonl").write_text(FILES["good.jsonl"])
    now, calls = [1000.0], []

    def load(df):
        calls.append(df.count())
        if len(calls) < 3:
            raise TimeoutError

    def program():
        ledger = I.FileLedger(spark, f"file://{tmp_path}/waiting")
        box = I.Ingest(spark, load, I.hadoop_move(spark, f"file://{tmp_path}"), ledger=ledger, version=I.hadoop_version(spark), clock=lambda: now[0], jitter=lambda: 5.0)
        I.watch(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/checkpoint", box, once=True).awaitTermination(60)
        return {w.file.rsplit("/", 1)[-1]: (w.attempts, w.due) for w in box.ledger.all()}

    assert program() == {"good.jsonl": (1, 1065.0)}
    assert program() == {"good.jsonl": (1, 1065.0)} and len(calls) == 1
    now[0] = 1065.0
    assert program() == {"good.jsonl": (2, 1190.0)} and len(calls) == 2
    now[0] = 1190.0
    assert program() == {} and calls == [2, 2, 2]
    assert (tmp_path / "archive/good.jsonl").exists() and not (tmp_path / "in/good.jsonl").exists()


def test_watch_goes_on_without_new_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "good.jsonl").write_text(FILES["good.jsonl"])
    calls, seconds = [], itertools.count(0, 1000)

    def load(df):
        calls.append(1)
        if len(calls) == 1:
            raise TimeoutError

    box = I.Ingest(spark, load, I.hadoop_move(spark, f"file://{tmp_path}"), clock=lambda: next(seconds))
    stream = I.watch(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/checkpoint", box, interval="1 second")
    end = time.time() + 60
    while not (tmp_path / "archive/good.jsonl").exists() and time.time() < end:
        time.sleep(0.5)
    stream.stop()
    assert len(calls) == 2 and (tmp_path / "archive/good.jsonl").exists()


def test_a_file_that_changes_waits(spark, folder):
    name, moved = f"file://{folder}/good.jsonl", []
    versions = iter([1, 1, 2, 3, 3, 3])
    box = I.Ingest(spark, lambda df: None, lambda f, to, why, _: moved.append(to), version=lambda f: next(versions), clock=lambda: 0.0)
    assert list(box.run([name]).values()) == ["incoming"] and not moved
    assert box.due() == [name]
    assert list(box.run(box.due()).values()) == ["archived"] and moved == ["archive"] and not box.due()


def test_a_time_that_is_none_is_permanent(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text(line(fetched_at="soon"))
    box = I.Ingest(spark, lambda df: df.collect(), lambda *a: None)
    assert list(box.run([f"file://{tmp_path}/x.jsonl"]).values()) == ["rejected:permanent_failure"]


def test_moves(spark, tmp_path):
    (tmp_path / "archive").mkdir()
    (tmp_path / "archive" / "a.jsonl").write_text("old")
    (tmp_path / "a.jsonl").write_text("new")
    move = I.hadoop_move(spark, f"file://{tmp_path}")
    move(f"file://{tmp_path}/a.jsonl", "archive", None)
    assert (tmp_path / "archive/a.jsonl").read_text() == "new"
    with pytest.raises(Exception, match="a.jsonl"):
        move(f"file://{tmp_path}/a.jsonl", "archive", None)


def test_json_lines_by_search(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (1, "c")], "query_id int, x string")
    made = sinks.write_json_lines(rows, f"file://{tmp_path}", "api", "20260101T000000", prefix="raw/")
    names = ["1_20260101T000000.jsonl", "2_20260101T000000.jsonl"]
    assert sorted(m.rsplit("/", 1)[-1] for m in made) == names
    assert sorted(p.name for p in (tmp_path / "raw/api/incoming").glob("*.jsonl")) == names
    assert sorted(json.loads(x)["x"] for x in (tmp_path / "raw/api/incoming" / names[0]).read_text().split()) == ["a", "c"]


def test_watch(spark, folder, tmp_path_factory):
    incoming, out = tmp_path_factory.mktemp("incoming"), tmp_path_factory.mktemp("out")
    for name in ("good.jsonl", "json.jsonl"):
        shutil.copy(folder / name, incoming)
    rows = []
    box = I.Ingest(spark, lambda df: rows.append(df.count()), I.hadoop_move(spark, f"file://{out}"))
    I.watch(spark, f"file://{incoming}", f"file://{out}/checkpoint", box, once=True).awaitTermination(60)
    assert rows == [2]
    assert (out / "archive/good.jsonl").exists()
    assert (out / "rejected/json.jsonl.reason").read_text() == "invalid_json"
    assert not list(incoming.glob("*.jsonl"))


def test_ledger(spark):
    objects = spark.createDataFrame([("b", "1.jsonl"), ("b", "2.jsonl"), ("b", "x.txt")], "bucket string, object_name string")
    ledger = spark.createDataFrame([("b", "1.jsonl")], "bucket string, object_name string")
    assert [r.object_name for r in records.unseen(objects, ledger).collect()] == ["2.jsonl"]


def test_weekly_stream(spark, sf_dir, tmp_path):
    import duckdb
    from pyspark.sql import functions as F

    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    (tmp_path / "in").mkdir()
    shutil.copy(f"{sf_dir}/events.parquet", tmp_path / "in")
    events = spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in").withColumn("ts", F.col("ts").cast("timestamp"))
    query = I.weekly_stream(events, "ts", ["event_type"]).writeStream.format("memory").queryName("weekly").outputMode("append").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = {(r.week.start.date(), r.event_type): r["count"] for r in spark.table("weekly").collect()}
    want = duckdb.sql(f"select cast(ts as date) - cast(dayofweek(ts) as int) as week, event_type, count(distinct ts) as n from '{sf_dir}/events.parquet' group by all").fetchall()
    assert got
    assert set(got.items()) <= {((w, k), n) for w, k, n in want}


def incoming(tmp_path, many=3):
    (tmp_path / "in").mkdir(exist_ok=True)
    names = [f"f{k}.jsonl" for k in range(many)]
    for k, name in enumerate(names):
        (tmp_path / "in" / name).write_text("\n".join(line(q=f"{name} {j}") for j in range(k + 1)))
    return [f"file://{tmp_path}/in/{n}" for n in names]


def rows_in(log):
    return sorted(r.q for r in log.read().selectExpr("variant_get(job_data, '$.q', 'string') as q").collect())


@pytest.mark.parametrize("step", range(1, 16))
def test_a_crash_after_any_step_leaves_no_double_row(spark, tmp_path, step, monkeypatch):
    """Whichever change to the store is the last before the program ends, the next one has each row once and each file archived."""
    files, made = incoming(tmp_path, 2), []
    want = ["f0.jsonl 0", "f1.jsonl 0", "f1.jsonl 1"]

    def program():
        log = I.LoadLog(spark, f"file://{tmp_path}/landing")
        box = I.Ingest(spark, log, I.hadoop_move(spark, f"file://{tmp_path}"), ledger=I.FileLedger(spark, f"file://{tmp_path}/waiting"))
        return box.run(files), log

    def ends_at(own):
        def run(self, *args):
            made.append(own.__name__)
            if len(made) >= step:
                raise KeyboardInterrupt  # no failure of the load: the program itself ends
            return own(self, *args)

        return run

    with monkeypatch.context() as patch:
        for name in ("rename", "delete", "write"):
            patch.setattr(sinks.Folder, name, ends_at(getattr(sinks.Folder, name)))
        try:
            program()
        except KeyboardInterrupt:
            pass
    program()
    _, log = program()
    assert rows_in(log) == want
    assert sorted(p.name for p in (tmp_path / "archive").glob("[!.]*")) == ["f0.jsonl", "f1.jsonl"] and not list((tmp_path / "in").glob("*.jsonl"))


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    def jobs(many):
        folder = tmp_path / str(many)
        folder.mkdir()
        files = incoming(folder, many)
        spark.sparkContext.setJobGroup(f"tick{many}", "")
        log = I.LoadLog(spark, f"file://{folder}/landing")
        states = I.Ingest(spark, log, I.hadoop_move(spark, f"file://{folder}")).run(files)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert set(states.values()) == {"archived"} and len(rows_in(log)) == many * (many + 1) // 2
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"tick{many}"))

    assert jobs(12) == jobs(2)


def test_a_file_that_spoils_a_load_is_tried_alone(spark, tmp_path):
    files, now, calls = incoming(tmp_path, 3), [0.0], []

    class Log(I.LoadLog):
        def add(self, rows, files, unchanged):
            calls.append(len(files))
            if any("f1" in f for f in files):
                raise TimeoutError
            return super().add(rows, files, unchanged)

    log = Log(spark, f"file://{tmp_path}/landing")
    box = I.Ingest(spark, log, I.hadoop_move(spark, f"file://{tmp_path}"), clock=lambda: now[0], jitter=lambda: 0.0)
    assert set(box.run(files).values()) == {"incoming"}
    now[0] = 60.0
    assert [s for _, s in sorted(box.run(box.due()).items())] == ["archived", "incoming", "archived"]
    now[0] = 180.0
    assert list(box.run(box.due()).values()) == ["rejected:transient_failure_exhausted"]
    assert calls == [3, 1, 1, 1, 1] and len(rows_in(log)) == 4


def test_a_changed_file_is_not_loaded_as_it_was(spark, tmp_path):
    """Rows of a version that is gone when they are written are not committed; the new version is, once."""
    files = incoming(tmp_path, 2)

    class Log(I.LoadLog):
        def add(self, rows, files, unchanged):
            if len(files) == 2 and not (tmp_path / "changed").exists():
                (tmp_path / "changed").touch()
                (tmp_path / "in" / "f1.jsonl").write_text(line(q="anew and longer than before"))
            return super().add(rows, files, unchanged)

    log = Log(spark, f"file://{tmp_path}/landing")
    box = I.Ingest(spark, log, I.hadoop_move(spark, f"file://{tmp_path}"))
    assert [s for _, s in sorted(box.run(files).items())] == ["archived", "incoming"]
    assert list(box.run(box.due()).values()) == ["archived"]
    assert rows_in(log) == ["anew and longer than before", "f0.jsonl 0"]
    # The same content under the same name, stored again: another version, and so loaded again.
    assert list(box.run(files).values()) == ["gone", "gone"]


@pytest.mark.parametrize("step", range(1, 9))
def test_a_move_that_ends_at_any_step(spark, tmp_path, step, monkeypatch):
    """Neither the file nor one archived before under its name is lost, and the next call finishes."""
    (tmp_path / "archive").mkdir()
    (tmp_path / "archive" / "a.jsonl").write_text("older")
    (tmp_path / "a.jsonl").write_text("newer")
    file, made = f"file://{tmp_path}/a.jsonl", []
    version = I.hadoop_version(spark)(file)

    def ends_at(own):
        def run(self, *args):
            made.append(own.__name__)
            if len(made) >= step:
                raise KeyboardInterrupt
            return own(self, *args)

        return run

    with monkeypatch.context() as patch:
        for name in ("rename", "delete", "write"):
            patch.setattr(sinks.Folder, name, ends_at(getattr(sinks.Folder, name)))
        try:
            I.hadoop_move(spark, f"file://{tmp_path}")(file, "archive", "why", version)
        except KeyboardInterrupt:
            pass
    texts = sorted(p.read_text() for p in [*(tmp_path / "archive").glob("a.jsonl*"), tmp_path / "a.jsonl"] if p.exists() and not p.name.endswith(".reason"))
    assert "older" in texts and "newer" in texts
    I.hadoop_move(spark, f"file://{tmp_path}")(file, "archive", "why", version)
    assert (tmp_path / "archive/a.jsonl").read_text() == "newer" and not (tmp_path / "a.jsonl").exists()
    assert (tmp_path / "archive/a.jsonl.reason").read_text() == "why"
    assert [p.read_text() for p in (tmp_path / "archive").glob("a.jsonl.[0-9]*")] == ["older"]


def test_a_move_takes_one_version_only(spark, tmp_path):
    file = tmp_path / "a.jsonl"
    file.write_text("one")
    move, version = I.hadoop_move(spark, f"file://{tmp_path}"), I.hadoop_version(spark)(f"file://{file}")
    file.write_text("another")
    with pytest.raises(I.ChangedError):
        move(f"file://{file}", "archive", None, version)
    assert file.read_text() == "another" and not list(tmp_path.glob("archive/a*"))


def test_discovery_goes_on_where_it_was(spark, tmp_path):
    """A program that ends in the middle of a tick: the next offers that tick again, without what is gone, and then the rest, oldest first."""
    import os

    (tmp_path / "in").mkdir()
    for k, name in enumerate(["d", "b", "a", "c", "e"]):  # b and a are of one time
        (tmp_path / "in" / f"{name}.jsonl").write_text(name)
        os.utime(tmp_path / "in" / f"{name}.jsonl", (1000 + max(k, 2), 1000 + max(k, 2)) if name in "ab" else (1000 + k, 1000 + k))
    (tmp_path / "in" / ".hidden").write_text("x")
    seen = []

    def run(fail=None):
        from hirelens.streaming.discovery import new_files

        def batch(df, _):
            names = [r.file.rsplit("/", 1)[-1][0] for r in sorted(df.collect(), key=lambda r: (r.time, r.file))]
            seen.append("".join(names))
            if fail and fail in names:
                raise RuntimeError("ended")

        query = new_files(spark, f"file://{tmp_path}/in", 2).writeStream.foreachBatch(batch).option("checkpointLocation", f"file://{tmp_path}/checkpoint").trigger(processingTime="100 milliseconds").start()
        try:
            end = time.time() + 60
            while query.isActive and time.time() < end and not (seen and seen[-1] in ("e", "f")):
                time.sleep(0.2)
            query.stop()
        except Exception:
            pass

    run(fail="b")
    assert seen == ["da", "bc"] or seen == ["da"] + ["bc"] * (len(seen) - 1)
    seen.clear()
    run()
    assert [x for x in seen if x] == ["bc", "e"]
    seen.clear()
    (tmp_path / "in" / "f.jsonl").write_text("f")
    run()
    assert [x for x in seen if x] == ["f"]
