"""Tables made of immutable folders and a pointer that is written last.

A version of a table is a small file that names its folders. It is written
under a temporary name and then renamed, after all folders are complete, so a
reader has one version whole, and a writer that dies leaves the last one as it
was. Folders are never written to again, so readers of an older version go on
undisturbed. One writer per table at a time; a second one is turned away when
it commits a number that is taken. All file access goes through Spark's file
systems, whatever store they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_system(spark: SparkSession, folder: str):
    """The file system of a folder, and its type of paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def read_text(spark: SparkSession, name: str) -> str:
    fs, path = file_system(spark, name)
    stream = fs.open(path(name))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, name: str, text: str) -> None:
    fs, path = file_system(spark, name)
    stream = fs.create(path(name), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


class VersionTaken(RuntimeError):
    """Another writer has committed that version."""


@dataclass(frozen=True)
class Versions:
    """The versions of the table at ``root``: lists of entries, each a dict with the ``path`` of a folder."""

    spark: SparkSession
    root: str

    @property
    def _folder(self) -> str:
        return f"{self.root}/_versions"

    def _fs(self):
        return file_system(self.spark, self._folder)

    def numbers(self) -> list[int]:
        fs, path = self._fs()
        if not fs.exists(path(self._folder)):
            return []
        names = (f.getPath().getName() for f in fs.listStatus(path(self._folder)))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def entries(self, version: int | None = None) -> tuple[int, list[dict]]:
        """The newest version, or the one asked for, and its entries; version 0 is the empty table."""
        version = version if version is not None else max(self.numbers(), default=0)
        if not version:
            return 0, []
        return version, json.loads(read_text(self.spark, f"{self._folder}/{version:012d}.json"))

    def commit(self, after: int, entries: Sequence[dict]) -> int:
        """Make ``entries`` the version after ``after``."""
        fs, path = self._fs()
        version = after + 1
        final = path(f"{self._folder}/{version:012d}.json")
        draft = path(f"{self._folder}/_draft-{uuid.uuid4().hex}")
        write_text(self.spark, draft.toString(), json.dumps(list(entries)))
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise VersionTaken(f"{self.root}: version {version}")
        return version

    def new_folder(self) -> str:
        return f"{self.root}/data-{uuid.uuid4().hex}"


def write_folders(df: DataFrame, path: str, partition_by: Sequence[str], *measures: Column) -> dict:
    """Write ``df`` in folders by value and observe ``measures`` in the same job; without rows, an empty file with its columns."""
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *measures)
    observed.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    found = seen.get
    if not found["rows"]:
        df.limit(0).write.mode("overwrite").parquet(path)
    return found


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> int:
    """Write ``df`` as the next version of the table at ``root``; what it was read from may be that table."""
    table = Versions(df.sparkSession, root)
    folder = table.new_folder()
    write_folders(df, folder, partition_by) if partition_by else df.write.parquet(folder)
    return table.commit(table.entries()[0], [{"path": folder}])


def read_entries(spark: SparkSession, entries: Sequence[dict], schema: T.StructType) -> DataFrame:
    paths = [e["path"] for e in entries]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_published(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest version of a published table, or an older one."""
    found, entries = Versions(spark, root).entries(version)
    if not found:
        raise FileNotFoundError(f"{root} has no published version")
    return spark.read.parquet(*[e["path"] for e in entries])
