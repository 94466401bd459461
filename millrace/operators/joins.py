"""Joins that need more than ``DataFrame.join``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_GRID_ROWS = 10_000


def grid_product(df: DataFrame, small: DataFrame, limit: int = MAX_GRID_ROWS) -> DataFrame:
    """Every row of ``df`` with every row of a small frame.

    The small side is counted first and refused above ``limit``: a product of two sides that both
    grow has no plan that scales. It then travels as an array literal that each row explodes, so
    there is neither a shuffle nor a nested loop.
    """
    rows = small.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"the small side of a product has more than {limit} rows")
    if not rows:
        return df.limit(0).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in small.schema])
    literal = F.array(*[
        F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in small.schema]) for row in rows
    ])
    return df.withColumn("_item", F.explode(literal)).select(*df.columns, "_item.*")


def bind_columns(left: DataFrame, right: DataFrame, row_id: str) -> DataFrame:
    """Two frames side by side. Rows have no position in Spark, so an explicit id aligns them."""
    return left.join(right, row_id)

