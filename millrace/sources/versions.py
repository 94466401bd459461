"""Versioned tables on plain files.

Parquet folders have no UPDATE or MERGE, and overwriting a path that is being read loses data. A
table is therefore a folder of immutable versions; a change writes the next version, and a reader
takes the latest one whose write was committed (``_SUCCESS`` present).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, target = _filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


class VersionedTable:
    """A named table kept as ``<root>/<name>/version=<v>`` folders."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.name = spark, name
        self.path = f"{root.rstrip('/')}/{name}"

    def _folder(self, version: str) -> str:
        return f"{self.path}/version={version}"

    def versions(self) -> list[str]:
        """Committed versions, oldest first."""
        found = [c.split("=", 1)[1] for c in children(self.spark, self.path) if c.startswith("version=")]
        done = [v for v in found if exists(self.spark, f"{self._folder(v)}/_SUCCESS")]
        return sorted(done, key=natural_order)

    def latest(self) -> str | None:
        return (self.versions() or [None])[-1]

    def snapshot(self, df: DataFrame, version: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write an immutable version; fails if it exists."""
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self._folder(version))
        return self.read(version)

    def write_next(self, df: DataFrame) -> DataFrame:
        numbers = [int(c.split("=v", 1)[1]) for c in children(self.spark, self.path) if re.fullmatch(r"version=v\d+", c)]
        return self.snapshot(df, f"v{max(numbers, default=0) + 1}")

    def read(self, version: str | None = None) -> DataFrame:
        version = version or self.latest()
        if version is None:
            raise FileNotFoundError(f"no committed version of {self.name}")
        return self.spark.read.parquet(self._folder(version))

    # Table changes, each one a new version.

    def insert(self, rows: DataFrame) -> DataFrame:
        return self.write_next(self.read().unionByName(rows))

    def upsert(self, changes: DataFrame, keys: list[str]) -> DataFrame:
        return self.write_next(upsert(self.read(), changes, keys))

    def update(self, where: Column, values: dict[str, Column]) -> DataFrame:
        return self.write_next(update_where(self.read(), where, values))

    def delete(self, where: Column) -> DataFrame:
        return self.write_next(delete_where(self.read(), where))


def natural_order(version: str) -> list:
    return [int(part) if part.isdigit() else part for part in re.split(r"(\d+)", version)]


def upsert(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``changes`` replace current rows of the same key; other rows of both are kept.

    Two changes to one key are an error, as it would not be clear which one holds.
    """
    if changes.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError(f"several changes to one key ({', '.join(keys)})")
    kept = current.join(changes.select(*keys), keys, "left_anti")
    return kept.select(*current.columns).unionByName(changes.select(*current.columns))


def update_where(current: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    hit = F.coalesce(where, F.lit(False))
    return current.select(*[
        F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in current.columns
    ])


def delete_where(current: DataFrame, where: Column) -> DataFrame:
    """Rows for which the condition is false or unknown stay."""
    return current.where(~F.coalesce(where, F.lit(False)))
