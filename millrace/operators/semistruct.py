"""Semi-structured values: variant paths, flattening, arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import scratch_dir
from millrace.sources.writers import write


def get_path(variant: str | Column, path: str, dtype: str) -> Column:
    """Element of a VARIANT at a JSON path such as ``station.name`` or ``air['dew-point']``, cast; NULL if absent."""
    return F.try_variant_get(F.col(variant) if isinstance(variant, str) else variant, f"$.{path}", dtype)


def flatten(df: DataFrame, array: str, keep: list[str | Column], outer: bool = False) -> DataFrame:
    """One row per array element, with ``index`` and ``value``; ``outer`` keeps rows with none."""
    expand = F.posexplode_outer if outer else F.posexplode
    return df.select(*keep, expand(F.col(array)).alias("index", "value"))


KINDS = {"array": "^ARRAY<", "object": "^OBJECT<", "both": "^(ARRAY|OBJECT)<"}


def flatten_variant(df: DataFrame, variant: str, path: str, keep: list[str], outer: bool = False, mode: str = "both") -> DataFrame:
    """Lateral flatten of the array or object at ``path`` of a VARIANT column, the column itself if the path is empty.

    Elements of arrays have an ``index``, fields of objects a ``key`` and their place as ``index``. ``mode`` says
    which of the two are expanded; ``outer`` keeps rows that have nothing to expand.
    """
    spark = df.sparkSession
    source = F.try_variant_get(variant, f"$.{path}", "variant") if path else F.col(variant)
    rows = df.withColumn("_source", F.when(F.schema_of_variant(source).rlike(KINDS[mode]), source))
    explode = spark.tvf.variant_explode_outer if outer else spark.tvf.variant_explode
    found = rows.select(*keep, "_source").lateralJoin(explode(F.col("_source").outer()))
    return found.select(*keep, "key", F.col("pos").alias("index"), F.col("value"))


def flatten_nested(df: DataFrame, variant: str, keep: list[str], mode: str = "both") -> DataFrame:
    """Every element at any depth: ``path``, ``key`` (fields of objects), ``index`` (elements of arrays) and ``value``.

    One pass per level of nesting, over the containers of that level only; each level is written, so no level is
    computed again for the next. ``mode`` limits what is opened to arrays or objects. Null and empty containers have no
    elements. ``keep`` must not name any of the four columns.
    """
    spark, levels = df.sparkSession, []
    level = df.select(*keep, F.lit("").alias("_path"), F.col(variant).alias("_parent"))
    while True:
        field = F.concat("_path", F.when(F.col("_path") != "", ".").otherwise(""), "key")
        item = F.concat("_path", F.lit("["), F.col("pos").cast("string"), F.lit("]"))
        opened = level.where(F.schema_of_variant("_parent").rlike(KINDS[mode]))
        found = opened.lateralJoin(spark.tvf.variant_explode(F.col("_parent").outer())).select(
            *keep, F.when(F.col("key").isNull(), item).otherwise(field).alias("path"), "key",
            F.when(F.col("key").isNull(), F.col("pos")).alias("index"), "value")
        found = write(found, scratch_dir(spark, "nested"))
        if levels and found.isEmpty():
            break
        levels.append(found)
        level = found.select(*keep, F.col("path").alias("_path"), F.col("value").alias("_parent"))
    out = levels[0]
    for deeper in levels[1:]:
        out = out.unionByName(deeper)
    return out


def split_to_rows(df: DataFrame, text: str, delimiter: str, keep: list[str]) -> DataFrame:
    """One row per piece of a string; the delimiter is taken literally."""
    pieces = F.split(F.col(text), "\\Q" + delimiter + "\\E")
    return df.select(*keep, F.posexplode(pieces).alias("index", "value"))


def json_array_rows(df: DataFrame, text: str, element: str, keep: list[str]) -> DataFrame:
    """Rows of a JSON array held as text."""
    return df.select(*keep, F.posexplode(F.from_json(F.col(text), f"array<{element}>")).alias("index", "value"))


def dot(a: Column, b: Column) -> Column:
    """Dot product of two equally long arrays, inside the JVM."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
