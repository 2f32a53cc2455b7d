"""Writers: appended, replaced by day, replaced as a whole, and JSON lines by search."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LAYERS = {"staging": "view", "int": "incremental", "marts": "table", "analysis": "table", "reporting": "table"}


def partitions_to_replace(run_date: date, num_days: object = 3) -> list[date]:
    """The run's UTC date and the days before it, num_days in all."""
    text = str(num_days).strip()
    if not re.fullmatch("[1-9][0-9]*", text):
        raise ValueError(f"num_days must be a positive integer, not {num_days!r}")
    return [run_date - timedelta(days=k) for k in range(int(text))]


class Folder:
    """A folder of any store that Hadoop knows, with the few operations that writers and ingest need."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.fs = self.path().getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str = "") -> list[str]:
        place = self.path(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(place)) if self.fs.exists(place) else []

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self.path(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def rename(self, name: str, to: str) -> None:
        if not self.fs.rename(self.path(name), self.path(to)):
            raise OSError(f"{self.root}/{name} could not be renamed to {to}")

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The file as a whole or not at all: it is written beside its place and renamed."""
        part = f"{name.rpartition('/')[0]}/" * ("/" in name) + f".{name.rsplit('/', 1)[-1]}.{uuid.uuid4().hex}"
        out = self.fs.create(self.path(part), True)
        out.write(bytearray(text.encode()))
        out.close()
        if self.exists(name):
            self.delete(name)
        self.rename(part, name)


class DayTable:
    """A Parquet table with a folder for each day, some of whose days are replaced at a time.

    A replacement is written to a hidden folder first. Then one file, the commit, names the days that have
    new rows and those that have none any more; from then on the replacement holds. It is carried out day by
    day: the old folder goes and the new one takes its place. A program that ends in between leaves the commit behind, and the next
    one carries out what is left; one that ends before the commit leaves the table as it was. All other days keep
    their files. Readers that run meanwhile may miss a day that is being replaced; there is one writer at a time.
    """

    COMMIT, STAGED, SCHEMA = "_commit.json", "_staged-", "_schema.json"
    #: How Spark names the folder of rows without a day.
    NO_DAY = "__HIVE_DEFAULT_PARTITION__"

    def __init__(self, spark: SparkSession, path: str, column: str = "created_date"):
        self.spark, self.column, self.folder = spark, column, Folder(spark, path)

    @property
    def schema(self) -> StructType | None:
        """Of the rows, kept beside them, as a table may have no day with rows."""
        if self.folder.exists(self.SCHEMA):
            return StructType.fromJson(json.loads(self.folder.read(self.SCHEMA)))
        return self.spark.read.parquet(self.folder.root).schema if self._days("") else None

    def read(self) -> DataFrame:
        self.finish()
        schema = self.schema
        if schema is None:
            raise ValueError(f"{self.folder.root} is no table")
        return self.spark.read.schema(schema).parquet(self.folder.root)

    def days(self) -> list[date]:
        """Those that have rows, from the names of folders."""
        return [date.fromisoformat(d) for d in self._days("") if d != self.NO_DAY]

    def _days(self, folder: str) -> list[str]:
        mark = f"{self.column}="
        return [n.removeprefix(mark) for n in self.folder.names(folder) if n.startswith(mark)]

    def newest(self) -> DataFrame:
        """Rows of the newest day only; no other folder is listed or read."""
        rows, days = self.read(), self.days()
        return self.spark.read.schema(rows.schema).option("basePath", self.folder.root).parquet(f"{self.folder.root}/{self.column}={days[-1]}") if days else rows.limit(0)

    def replace(self, df: DataFrame, days: Iterable[date] | None = None) -> None:
        """These days become what df has of them, nothing where it has nothing; without days, the whole table becomes df. A schema that differs is an error."""
        self.finish()
        have, new = self.schema, {f.name: f.dataType for f in df.schema.fields}
        if days is not None and have is not None and {f.name: f.dataType for f in have.fields} != new:
            raise ValueError(f"schema of {self.folder.root} differs")
        staged = f"{self.STAGED}{uuid.uuid4().hex}"
        days = None if days is None else list(days)
        chosen = df if days is None else df.where(F.col(self.column).isin(days))
        chosen.hint("rebalance", self.column).write.partitionBy(self.column).parquet(f"{self.folder.root}/{staged}")
        filled = self._days(staged)
        wanted = self._days("") if days is None else [str(d) for d in days]
        others = [f for f in df.schema.fields if f.name != self.column]  # read back, the day is the last column
        schema = StructType([*others, df.schema[self.column]]) if have is None or days is None else have
        self.folder.write(self.COMMIT, json.dumps({"staged": staged, "filled": filled, "emptied": sorted(set(wanted) - set(filled)), "schema": schema.jsonValue()}))
        self.finish()

    def finish(self) -> None:
        """Carries out a commit that is left, from wherever it stopped, and clears what was staged without one."""
        if self.folder.exists(self.COMMIT):
            commit = json.loads(self.folder.read(self.COMMIT))
            self.folder.write(self.SCHEMA, json.dumps(commit["schema"]))
            for day in commit["filled"]:
                name = f"{self.column}={day}"
                if self.folder.exists(f"{commit['staged']}/{name}"):  # else it is in its place already
                    self.folder.delete(name)
                    self.folder.rename(f"{commit['staged']}/{name}", name)
            for day in commit["emptied"]:
                self.folder.delete(f"{self.column}={day}")
            self.folder.delete(self.COMMIT)
        for name in self.folder.names():
            if name.startswith(self.STAGED):
                self.folder.delete(name)


def overwrite_days(df: DataFrame, path: str, days: list[date], column: str = "created_date") -> None:
    """Replaces these days of a table partitioned by day, those without new rows by nothing, and leaves all others; a schema that differs is an error."""
    DayTable(df.sparkSession, path, column).replace(df, days)


def exists(spark: SparkSession, path: str) -> bool:
    return Folder(spark, path).exists()


def append(df: DataFrame, table: str) -> None:
    """Appends to a table that must exist."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist")
    df.select(*spark.table(table).columns).write.mode("append").insertInto(table)


def materialize(df: DataFrame, name: str, layer: str) -> DataFrame:
    """A view or a table that replaces the one before, as the layer says."""
    if LAYERS[layer] == "view":
        df.createOrReplaceTempView(name)
    else:
        df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def schema_name(custom: str | None, target: str, default: str) -> str:
    """Everything goes to the default schema in development, to its own otherwise."""
    return default if target == "dev" or not custom else custom.strip()


def write_json_lines(df: DataFrame, path: str, source: str, stamp: str, prefix: str = "") -> list[str]:
    """Records (query_id, ...) as <prefix>/<source>/incoming/<query_id>_<stamp>.jsonl; a search without records leaves nothing.

    The records of a search are one file, as the ingest takes a file as a whole: a search is limited to some hundred
    records. Spark writes them to a folder of their own, from which each file is renamed to its place.
    """
    spark = df.sparkSession
    base = "/".join(x.strip("/") if k else x.rstrip("/") for k, x in enumerate((path, prefix, source, "incoming")) if x)
    staged = f"{base}/.{stamp}"
    df.withColumn("search", F.col("query_id")).repartition("search").write.partitionBy("search").mode("overwrite").json(staged)
    hadoop = spark._jvm.org.apache.hadoop.fs
    top = hadoop.Path(staged)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    made = []
    for folder in fs.globStatus(hadoop.Path(f"{staged}/search=*")):  # one for each search
        name = folder.getPath().getName().split("=", 1)[1]
        for k, part in enumerate(fs.globStatus(hadoop.Path(f"{folder.getPath()}/part-*"))):
            target = f"{base}/{name}_{stamp}{f'_{k}' * (k > 0)}.jsonl"
            if not fs.rename(part.getPath(), hadoop.Path(target)):
                raise OSError(f"{part.getPath()} could not be moved to {target}")
            made.append(target)
    fs.delete(top, True)
    return made
