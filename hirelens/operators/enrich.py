"""Skill extraction: an extractor that is plugged in, paced over several keys, and a dictionary that needs none."""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PER_MINUTE, COOLDOWN, RETRIES, FLUSH = 30, 60.0, 3, 50
ENRICHED = "job_id string, data_source string, skills string, created_at timestamp"
# Skills that the dictionary extractor knows.
SKILLS = (
    "airflow", "aws", "azure", "bigquery", "c++", "communication", "dbt", "docker", "excel", "gcp", "git", "go", "java", "javascript", "kafka", "kubernetes", "leadership", "linux",
    "looker", "machine learning", "nursing", "pandas", "postgresql", "power bi", "project management", "python", "r", "salesforce", "scala", "snowflake", "spark", "sql", "tableau", "terraform", "typescript",
)


class RateLimited(Exception):
    def __init__(self, retry_after: float | None = None):
        super().__init__("rate limited")
        self.retry_after = retry_after


class Passing(Exception):
    """A server or connection error that passes."""


@dataclass
class Key:
    call: Callable[[str], str]
    sent: int = 0
    since: float = 0.0
    free_at: float = 0.0


@dataclass
class KeyRing:
    """Calls an extractor in turn with each key, per_minute times a minute; a limited key rests."""

    keys: list[Key]
    per_minute: int = PER_MINUTE
    minute: float = 60.0
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    jitter: Callable[[], float] = random.random
    at: int = field(default=0)

    def _next(self) -> Key:
        order = self.keys[self.at :] + self.keys[: self.at]
        key = min(order, key=lambda k: max(0.0, k.free_at - self.clock()))  # the first that is free, else the next to be
        self.at = (self.keys.index(key) + 1) % len(self.keys)
        if (wait := key.free_at - self.clock()) > 0:
            self.sleep(wait)
        if not key.sent:
            key.since = self.clock()  # its minute begins with the first call
        if key.sent >= self.per_minute:
            if (left := self.minute - (self.clock() - key.since)) > 0:
                self.sleep(left)
            key.sent, key.since = 0, self.clock()
        return key

    def extract(self, text: str) -> str:
        for attempt in range(RETRIES + 1):
            key = self._next()
            key.sent += 1
            try:
                return key.call(text)
            except RateLimited as limit:
                key.free_at = max(key.free_at, self.clock() + (COOLDOWN if limit.retry_after is None else limit.retry_after))
                if attempt == RETRIES:
                    raise
            except Passing:
                if attempt == RETRIES:
                    raise
                self.sleep(min(60.0, 5 * 2**attempt + self.jitter()))
        raise AssertionError


_KNOWN = re.compile(r"(?<![\w+#])(" + "|".join(sorted(map(re.escape, SKILLS), key=len, reverse=True)) + r")(?![\w+#])", re.I)


def dictionary(text: str) -> str:
    """Known skills of a text in order of appearance, each once."""
    return ", ".join(dict.fromkeys(m.lower() for m in _KNOWN.findall(text)))


def enrich(candidates: DataFrame, keys: Sequence[Callable[[str], str]] | None = None, per_minute: int = PER_MINUTE, minute: float = 60.0) -> DataFrame:
    """ENRICHED rows of candidates (job_id, data_source, job_description), by the dictionary or by calls with these keys.

    Each key has a partition of its own, to which its share of the rows is dealt, so its budget of per_minute calls is
    one for the whole job, however many tasks read the candidates. A second attempt of a task waits out the minute of the
    first; do not run these jobs with speculative tasks. Rows whose extraction fails for good are left out and
    come up again as candidates.
    """
    key = F.pmod(F.xxhash64("job_id"), F.lit(len(keys) if keys else 1)).cast("int")
    dealt = candidates.select("job_id", "data_source", "job_description", key.alias("key"))
    if keys:
        dealt = dealt.repartitionById(len(keys), "key")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if keys and TaskContext.get().attemptNumber():
            time.sleep(minute)
        rings: dict[int, KeyRing] = {}  # of this task: one, or some where small partitions are read together

        def extract(number: int, text: str) -> str:
            if not keys:
                return dictionary(text)
            if number not in rings:
                rings[number] = KeyRing([Key(keys[number])], per_minute, minute)
            return rings[number].extract(text)

        for batch in batches:
            for start in range(0, len(batch), FLUSH):
                part, found = batch.iloc[start : start + FLUSH], []
                for row in part.itertuples():
                    try:
                        skills = extract(row.key, row.job_description)
                    except (RateLimited, Passing):
                        continue
                    found.append((row.job_id, row.data_source, skills))
                yield pd.DataFrame(found, columns=["job_id", "data_source", "skills"])

    made = dealt.mapInPandas(run, "job_id string, data_source string, skills string")
    return skill_rows(made.where("skills <> ''").withColumn("created_at", F.current_timestamp()))


def skill_rows(rows: DataFrame) -> DataFrame:
    """Rows as the skill table takes them: texts, and the time of now where created_at is missing or no time."""
    when = F.col("created_at").cast("string")
    texts = (F.col(c).cast("string").alias(c) for c in ("job_id", "data_source", "skills"))
    return rows.select(*texts, F.coalesce(F.try_to_timestamp(when), F.current_timestamp()).alias("created_at"))
