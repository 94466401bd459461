"""File and generated sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.sampling import key_hash


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True, sep: str = ",",
             **options) -> DataFrame:
    """Delimited files under a stated schema; inference would read everything twice."""
    return spark.read.schema(schema).options(header=header, sep=sep, **options).csv(path)


def read_any(spark: SparkSession, fmt: str, path: str, schema=None, **options) -> DataFrame:
    """Named format, then load. Avro needs the external spark-avro package on the classpath."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_json_variant(spark: SparkSession, path: str, column: str = "v", multiline: bool = False) -> DataFrame:
    """Each JSON document whole, in one VARIANT column."""
    return spark.read.option("singleVariantColumn", column).option("multiLine", multiline).json(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("rowTag", row_tag).xml(path)


def text_files(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """One row per text file: its name, its path and its whole text."""
    return (
        spark.read.option("wholetext", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
        .text(path)
        .select(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file_path"),
                F.col("value").alias("text"))
    )


def generate_rows(spark: SparkSession, n: int, columns: dict[str, Column], partitions: int | None = None) -> DataFrame:
    """``n`` rows numbered from 0 in ``id`` with derived columns.

    Derive values from ``id`` by hash (`uniform_int`) rather than ``rand``: a task that is rerun
    then makes the same rows again.
    """
    ids = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    return ids.select("id", *[c.alias(name) for name, c in columns.items()])


def uniform_int(keys: list[str | Column], low: int, high: int, seed: int = 0) -> Column:
    """Repeatable pseudo-random integer in [low, high] from key values."""
    return F.lit(low).cast("bigint") + F.pmod(key_hash(keys, seed), F.lit(high - low + 1).cast("bigint"))


def pick(options: list, keys: list[str | Column], seed: int = 0) -> Column:
    """Repeatable pseudo-random element of a short list for each row."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), uniform_int(keys, 1, len(options), seed).cast("int"))


def project_load(df: DataFrame, casts: dict[str, str], derived: dict[str, Column] | None = None) -> DataFrame:
    """Typed projection of loaded files: stated columns cast, further columns derived from them."""
    typed = df.select(*[F.col(c).cast(t).alias(c) for c, t in casts.items()])
    return typed.select("*", *[c.alias(n) for n, c in (derived or {}).items()])
