"""A streaming source of new files in a folder, oldest first, so many a batch.

What was offered and is still there is the offset: each file by its time, size and name. A batch is what its end
offset has more than its start offset, so a batch that is run again after a restart offers the same files, whatever came or went
meanwhile. A file that is written anew is another file. The folder is listed by the driver's source process; names
only, the files are read by whoever takes them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

Seen = list[tuple[int, int, str]]


def _seen(offset: dict) -> Seen:
    return [tuple(x) for x in json.loads(offset["offered"])]


def _offset(files: Seen) -> dict:
    return {"offered": json.dumps(sorted(files))}


class NewFilesReader(SimpleDataSourceStreamReader):
    def __init__(self, folder: str, most: int | None):
        self.folder, self.most = folder.rstrip("/"), most

    def listed(self) -> Seen:
        """(time in ns, size, name) of the files that are there, without hidden ones and folders."""
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(self.folder)
        files = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return [(f.mtime_ns or 0, f.size or 0, f.base_name) for f in files if f.is_file and not f.base_name.startswith((".", "_"))]

    def rows(self, files: Seen) -> Iterator[tuple[str, int]]:
        return iter([(f"{self.folder}/{name}", time) for time, _, name in sorted(files, key=lambda x: (x[0], x[2]))])

    def initialOffset(self) -> dict:
        return _offset([])

    def read(self, start: dict) -> tuple[Iterator[tuple[str, int]], dict]:
        there = self.listed()
        offered = set(_seen(start)) & set(there)
        new = sorted(set(there) - offered, key=lambda x: (x[0], x[2]))[: self.most]
        return self.rows(new), _offset([*offered, *new])

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple[str, int]]:
        return self.rows(list(set(_seen(end)) - set(_seen(start))))


class NewFiles(DataSource):
    """Options: path, and most, the number of files in a batch."""

    @classmethod
    def name(cls) -> str:
        return "new_files"

    def schema(self) -> str:
        return "file string, time bigint"

    def simpleStreamReader(self, schema: StructType) -> NewFilesReader:
        most = self.options.get("most")
        return NewFilesReader(self.options["path"], int(most) if most else None)


def new_files(spark: SparkSession, folder: str, most: int | None = None) -> DataFrame:
    """A stream of (file, time)."""
    spark.dataSource.register(NewFiles)
    source = spark.readStream.format("new_files")
    return (source.option("most", most) if most else source).load(folder)
