"""File ingest: validate each file as a whole, append the good ones once, archive or reject.

A file with one bad line or one failed check is rejected with the reason beside it; a file that
fails to load for a passing reason stays and is tried again, MAX_ATTEMPTS times in all, after a delay.
What waits for that is kept in a ledger in files, so that neither the end of the program nor the
stream's checkpoint, which offers each file once, loses it. A file that changes while it is loaded is
tried again as it then is.

All good files of a tick are one load, so the number of Spark jobs does not grow with them. A load knows each
file by its name and version (`LoadLog`): a program that ends between load and move finds the file loaded, and only
moves it. A file whose load failed is tried alone, so that one bad file does not hold up the others.
"""

from __future__ import annotations

import hashlib
import json
import random
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.errors import DateTimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.records import BAD_LINE, ENVELOPE, REQUIRED, envelopes, json_lines, not_null_counts
from ..sources.sinks import Folder
from .discovery import new_files

MAX_ATTEMPTS = 3
MAX_FILES = 100
INTERVAL = "1800 seconds"
# Why a file is rejected.
UNSUPPORTED, EMPTY, FAILED_CHECK, EXHAUSTED, PERMANENT = "unsupported_extension", "empty_file", "duckdb_check_failed", "transient_failure_exhausted", "permanent_failure"


class PermanentError(Exception):
    """A failure that no retry helps."""


class ChangedError(Exception):
    """A file is not what it was when its work began."""


def retry_delay(attempt: int, jitter: float = 0.0) -> float:
    """Seconds before the next attempt: 60, then 120, and up to 10 of jitter."""
    return 60.0 * 2 ** (attempt - 1) + min(max(jitter, 0.0), 10.0)


@dataclass(frozen=True)
class Verdict:
    file: str
    reason: str | None
    rows: int = 0


def verdicts(spark: SparkSession, files: list[str]) -> list[Verdict]:
    """What is wrong with each file, if anything; one row for each file comes to the driver."""
    wrong = [Verdict(f, UNSUPPORTED) for f in files if not f.endswith(".jsonl")]
    named = [f for f in files if f.endswith(".jsonl")]
    if not named:  # nor any file at all
        return wrong
    lines = json_lines(spark, named)
    order = F.array(*map(F.lit, BAD_LINE))
    faults = lines.groupBy("file").agg(F.min(F.nullif(F.array_position(order, F.col("fault")), F.lit(0))).alias("fault"))
    data = lines.where("fault is null").withColumn("job_data", F.parse_json("value"))
    time_text = F.try_variant_get("job_data", "$.fetched_at", "string")
    no_time = data.where(time_text.isNotNull() & F.try_to_timestamp(time_text).isNull()).groupBy("file").agg(F.lit(True).alias("no_time"))
    checks = not_null_counts(data, by=["file"]).join(no_time, "file", "left")
    failed = sum((F.coalesce(F.col(f"failed_{name}"), F.lit(0)) for name in REQUIRED), F.lit(0))
    found = {_tail(r.file): r for r in faults.join(checks, "file", "left").select("file", "fault", F.coalesce("row_count", F.lit(0)).alias("n"), failed.alias("failed"), "no_time").collect()}
    for f in named:
        row = found.get(_tail(f))
        if row is None:
            wrong.append(Verdict(f, EMPTY))
        elif row.fault is not None:
            wrong.append(Verdict(f, BAD_LINE[row.fault - 1], row.n))
        else:
            wrong.append(Verdict(f, FAILED_CHECK if row.failed else PERMANENT if row.no_time else None, row.n))  # a time that is none fails each time
    return wrong


def _tail(path: str) -> str:
    return path.split(":", 1)[-1].lstrip("/")


@dataclass
class Waiting:
    """How often a file has failed, and when it is tried again."""

    file: str
    attempts: int
    due: float


@dataclass
class Ledger:
    """What waits, in memory."""

    rows: dict[str, Waiting] = field(default_factory=dict)

    def get(self, file: str) -> Waiting | None:
        return self.rows.get(file)

    def put(self, row: Waiting) -> None:
        self.rows[row.file] = row

    def drop(self, file: str) -> None:
        self.rows.pop(file, None)

    def all(self) -> list[Waiting]:
        return list(self.rows.values())


class FileLedger(Ledger):
    """What waits, one small file for each in a folder of any store that Hadoop knows; the folder is read once."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.folder = Folder(spark, folder)
        if self.folder.names():
            texts = spark.read.option("wholetext", "true").text(folder).collect()  # of what waits
            self.rows = {row.file: row for row in (Waiting(**json.loads(t.value)) for t in texts)}

    @staticmethod
    def _name(file: str) -> str:
        return hashlib.sha256(file.encode()).hexdigest() + ".json"

    def put(self, row: Waiting) -> None:
        super().put(row)
        self.folder.write(self._name(row.file), json.dumps(row.__dict__))

    def drop(self, file: str) -> None:
        if file in self.rows:
            super().drop(file)
            self.folder.delete(self._name(file))


class LoadLog:
    """A table of ENVELOPE rows that takes each version of a file once.

    A load is a folder, named after the files and versions it is made of. It is written to a hidden place, after a note
    for each file and version says which load has it; renaming the folder to its place is the commit. So a load is
    there as a whole or not at all, and a file is loaded if the load in its note is there. What was written without a commit
    is overwritten or removed by the next load. The store must rename folders at once, as file systems do.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, Folder(spark, path)

    @staticmethod
    def _key(value: object) -> str:
        return hashlib.sha256(json.dumps(value, default=str).encode()).hexdigest()

    def _note(self, file: str, version: object) -> str:
        return f"_files/{self._key([file, version])}"

    def has(self, file: str, version: object) -> bool:
        note = self._note(file, version)
        return self.folder.exists(note) and self.folder.exists(f"load={self.folder.read(note)}")

    def add(self, rows: DataFrame, files: dict[str, object], unchanged: Callable[[], bool]) -> bool:
        """Loads the rows of these files and versions, if unchanged() still holds when they are written."""
        load = self._key(sorted(files.items(), key=str))
        for name in self.folder.names():
            if name.startswith("_staged-"):
                self.folder.delete(name)
        for file, version in files.items():
            self.folder.write(self._note(file, version), load)
        staged = f"_staged-{load}"
        rows.write.parquet(f"{self.folder.root}/{staged}")
        if not unchanged():
            self.folder.delete(staged)
            return False
        self.folder.rename(staged, f"load={load}")
        return True

    def read(self) -> DataFrame:
        return self.spark.read.schema(f"{ENVELOPE}, load string").parquet(self.folder.root).drop("load")


class Calls:
    """Loads by a call; what was loaded is known as long as the program lives."""

    def __init__(self, load: Callable[[DataFrame], None]):
        self.load, self.done = load, set()

    def has(self, file: str, version: object) -> bool:
        return (file, str(version)) in self.done

    def add(self, rows: DataFrame, files: dict[str, object], unchanged: Callable[[], bool]) -> bool:
        self.load(rows)
        if not unchanged():
            return False
        self.done |= {(f, str(v)) for f, v in files.items()}
        return True


class Ingest:
    """load is a LoadLog, or a call that appends rows of ENVELOPE; move(file, folder, reason, version) puts a file away; notify tells somebody, and may fail.

    version(file) tells one content of a file from another, None if there is none; clock gives seconds.
    """

    def __init__(
        self, spark: SparkSession, load: LoadLog | Callable[[DataFrame], None], move: Callable[[str, str, str | None, object], None], notify: Callable[[str], None] = lambda text: None,
        ledger: Ledger | None = None, version: Callable[[str], object] | None = None, clock: Callable[[], float] = time.time, jitter: Callable[[], float] = lambda: random.uniform(0, 10),
    ):
        self.spark, self.loads, self.move, self.notify = spark, load if hasattr(load, "add") else Calls(load), move, notify
        self.ledger, self.version, self.clock, self.jitter = Ledger() if ledger is None else ledger, version or hadoop_version(spark), clock, jitter

    def due(self) -> list[str]:
        """Files whose next attempt is due, the longest waiting first."""
        now = self.clock()
        return [w.file for w in sorted(self.ledger.all(), key=lambda w: (w.due, w.file)) if w.due <= now]

    def run(self, files: Iterable[str]) -> dict[str, str]:
        """The state of each file: archived, rejected:<reason>, incoming, or gone."""
        versions = {f: self.version(f) for f in files}
        states = dict.fromkeys(versions, "gone")  # moved by an earlier program, or by somebody else
        for file in (f for f, v in versions.items() if v is None):
            self.ledger.drop(file)
        there = {f: v for f, v in versions.items() if v is not None}
        ends: dict[str, tuple[str | None, int | None]] = {f: (None, None) for f, v in there.items() if self.loads.has(f, v)}  # files to put away: reason, rows
        found = {v.file: v for v in verdicts(self.spark, [f for f in there if f not in ends])}
        fresh: list[str] = []
        for file, verdict in found.items():
            if self.version(file) != there[file]:
                states[file] = self._wait(file, 0)
            elif verdict.reason:
                ends[file] = verdict.reason, None
            else:
                fresh.append(file)
        tried = {w.file for w in self.ledger.all() if w.attempts}
        first = [f for f in fresh if f not in tried]
        for group in ([first] if first else []) + [[f] for f in fresh if f in tried]:
            for file, state in self._load({f: there[f] for f in group}).items():
                if state is None:
                    ends[file] = None, found[file].rows
                else:
                    states[file] = state
        for file in there:
            if file in ends:
                states[file] = self._away(file, there[file], *ends[file])
        return states

    def _load(self, files: dict[str, object]) -> dict[str, str | None]:
        """The states of files that were not loaded, None for those that were."""
        states: dict[str, str | None] = {}
        while files:
            changed: list[str] = []

            def unchanged(files: dict[str, object] = files, changed: list[str] = changed) -> bool:
                changed += [f for f, v in files.items() if self.version(f) != v]
                return not changed

            try:
                if self.loads.add(envelopes(json_lines(self.spark, list(files))), files, unchanged):
                    return states | dict.fromkeys(files)
            except (PermanentError, DateTimeException):
                if len(files) == 1:
                    return states | {f: self._away(f, v, PERMANENT) for f, v in files.items()}
                return states | {f: self._failed(f, v) for f, v in files.items()}  # which of them it was, shows when each is tried alone
            except Exception:
                return states | {f: self._failed(f, v) for f, v in files.items()}
            states |= {f: self._wait(f, 0) for f in changed}
            files = {f: v for f, v in files.items() if f not in changed}
        return states

    def _failed(self, file: str, version: object) -> str:
        before = self.ledger.get(file)
        attempts = 1 + (before.attempts if before else 0)
        return self._away(file, version, EXHAUSTED) if attempts >= MAX_ATTEMPTS else self._wait(file, attempts)

    def _wait(self, file: str, attempts: int) -> str:
        self.ledger.put(Waiting(file, attempts, self.clock() + (retry_delay(attempts, self.jitter()) if attempts else 0)))
        return "incoming"

    def _away(self, file: str, version: object, reason: str | None, rows: int | None = None) -> str:
        try:
            self.move(file, "rejected" if reason else "archive", reason, version)
        except ChangedError:  # it is another file now
            return self._wait(file, 0)
        self.ledger.drop(file)
        self._tell(f"rejected {file}: {reason}" if reason else f"loaded {file}" + (f": {rows} rows" if rows is not None else " before, moved now"))
        return f"rejected:{reason}" if reason else "archived"

    def _tell(self, text: str) -> None:
        try:
            self.notify(text)
        except Exception:  # best effort
            return


def hadoop_version(spark: SparkSession) -> Callable[[str], object]:
    """Length and time of change of a file; None if it is gone."""

    def version(file: str) -> object:
        place = spark._jvm.org.apache.hadoop.fs.Path(file)
        fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(place):
            return None
        status = fs.getFileStatus(place)
        return status.getLen(), status.getModificationTime()

    return version


def hadoop_move(spark: SparkSession, root: str) -> Callable[..., None]:
    """Moves exactly one version of a file to root/<folder>/, in any store Hadoop knows; a reason is written beside it.

    The file is copied beside its place, and only if it is still the version asked for, the copy takes its place and the
    file is deleted. One of that name that is there already is kept under its name and time. Each step can be the last of a
    program: the next call goes on, and neither an archived file nor one that has changed meanwhile is lost.
    """
    version_of, away = hadoop_version(spark), Folder(spark, root)
    jvm, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()

    def move(file: str, folder: str, reason: str | None, version: object = None) -> None:
        name = file.rsplit("/", 1)[-1]
        target, part, mark = f"{folder}/{name}", f"{folder}/.{name}.part", f"{folder}/.{name}.version"
        have = version_of(file)
        wanted = str(version or have)
        here = away.exists(target) and away.exists(mark) and away.read(mark) == wanted
        if have is None and (version is None or not here):
            raise FileNotFoundError(file)
        if have is not None and str(have) != wanted:
            raise ChangedError(file)
        if not here:
            source = jvm.Path(file)
            jvm.FileUtil.copy(source.getFileSystem(conf), source, away.fs, away.path(part), False, True, conf)
            if str(version_of(file)) != wanted:
                away.delete(part)
                raise ChangedError(file)
            if away.exists(target):
                away.rename(target, f"{target}.{away.fs.getFileStatus(away.path(target)).getModificationTime()}")
            away.write(mark, wanted)
            away.rename(part, target)
        if reason:
            away.write(f"{target}.reason", reason)
        if have is not None:
            if str(version_of(file)) != wanted:
                raise ChangedError(file)
            source = jvm.Path(file)
            source.getFileSystem(conf).delete(source, False)

    return move


def watch(spark: SparkSession, incoming: str, checkpoint: str, ingest: Ingest, once: bool = False, interval: str = INTERVAL) -> StreamingQuery:
    """Runs ingest over new files, at most MAX_FILES a load, oldest first, and over those whose retry is due.

    The checkpoint remembers which files were offered; a clock stream makes a batch at each interval even if no file came.
    """
    names = new_files(spark, incoming, None if once else MAX_FILES)
    if once:
        ingest.run(ingest.due())
    else:
        ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(F.lit(None).cast("string").alias("file"), F.lit(None).cast("bigint").alias("time"))
        names = names.unionByName(ticks)

    def batch(df: DataFrame, _: int) -> None:
        new = [r.file for r in sorted(df.where("file is not null").distinct().collect(), key=lambda r: (r.time, r.file))]  # names only
        files = list(dict.fromkeys([*ingest.due()[:MAX_FILES], *new]))
        for k in range(0, len(files), MAX_FILES):
            ingest.run(files[k : k + MAX_FILES])

    writer = names.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def weekly_stream(events: DataFrame, time: str, keys: list[str], late: str = "3 days") -> DataFrame:
    """An extension for streams: distinct rows by key and time, counted by week from Sunday."""
    distinct = events.withWatermark(time, late).dropDuplicatesWithinWatermark([*keys, time])
    return distinct.groupBy(F.window(time, "7 days", "7 days", "3 days").alias("week"), *keys).count()
