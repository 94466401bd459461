"""Sinks and bounded client results."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

MAX_CLIENT_ROWS = 100_000


def write(df: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "parquet", **options) -> DataFrame:
    """Write and read back."""
    df.write.mode(mode).format(fmt).options(**options).save(path)
    return df.sparkSession.read.format(fmt).options(**options).schema(df.schema).load(path)


def write_sorted(df: DataFrame, path: str, keys: list[str], mode: str = "errorifexists") -> DataFrame:
    """Clustered layout: range-partitioned and sorted, so min/max statistics prune scans on the keys.

    A hash of the row comes after the keys in the range order, so rows of one heavy key may end up
    in several files instead of one.
    """
    ranges = df.repartitionByRange(*keys, F.xxhash64(*df.columns))
    ranges.sortWithinPartitions(*keys).write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def temporary_table(df: DataFrame, name: str) -> DataFrame:
    """Session-scoped table: a cached frame under a view name. Lost blocks are recomputed."""
    df.persist()
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def client_rows(df: DataFrame, limit: int = MAX_CLIENT_ROWS) -> list[Row]:
    """All rows at the client; refuses a result larger than ``limit`` instead of cutting it."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows: aggregate first, or stream them with client_stream")
    return rows


def client_stream(df: DataFrame) -> Iterator[Row]:
    """Rows one partition at a time, the next one being fetched meanwhile."""
    return df.toLocalIterator(prefetchPartitions=True)
