"""Aggregations beyond a plain groupBy: shares, histograms, summaries, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.rangebuckets import exact_quantiles, null_safe_join


def share_of_total(grouped: DataFrame, measure: str, name: str = "share") -> DataFrame:
    """Each group row's percentage of the grand total.

    The total is a one-row aggregate of the group rows, read back as a scalar subquery, so no
    window over the whole result is needed.
    """
    total = grouped.agg(F.sum(measure).alias("total"))
    return grouped.select("*", (F.col(measure) * 100.0 / total.scalar()).alias(name))


def group_summary(df: DataFrame, by: Sequence[str], aggregates: Sequence[Column], medians: dict[str, str]) -> DataFrame:
    """Ordinary aggregates together with exact medians, without holding a group in one task."""
    found = exact_quantiles(df, {name: (column, 0.5) for name, column in medians.items()}, by=by)
    return null_safe_join(df.groupBy(*by).agg(*aggregates), found, by, "left")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows per equal-width bin between the column's minimum and maximum, empty bins included."""
    ends = df.agg(F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high")).first()
    low, high = ends["low"], ends["high"]
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, n bigint")
    width = (high - low) / bins
    value = F.col(column).cast("double")
    number = F.least(F.floor((value - low) / width), F.lit(bins - 1)) if width else F.lit(0)
    counts = df.where(value.isNotNull()).groupBy(number.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min and max per column in one pass, one row per column."""
    stats = {"n": F.count, "mean": F.avg, "stddev": F.stddev_samp, "low": F.min, "high": F.max}
    wide = df.agg(*[
        f(c).cast("bigint" if s == "n" else "double").alias(f"{c}|{s}") for c in columns for s, f in stats.items()
    ])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{s}`").alias(s) for s in stats]) for c in columns
    ])))


def correlation_matrix(df: DataFrame, columns: Sequence[str], diagonal: bool = True) -> DataFrame:
    """Pearson correlation of every pair of columns, long form, in one pass."""
    pairs = list((combinations_with_replacement if diagonal else combinations)(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    rows = [(a, b, f"{a}|{b}") for a, b in pairs] + [(b, a, f"{a}|{b}") for a, b in pairs if a != b]
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{c}`").alias("corr")) for a, b, c in rows
    ])))


def pivot(df: DataFrame, by: Sequence[str], column: str, values: Sequence, aggregate: Column) -> DataFrame:
    """One column per stated value; stating them saves the extra pass that would find them."""
    return df.groupBy(*by).pivot(column, list(values)).agg(aggregate)


def key_quality(df: DataFrame, keys: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """Violations of a declared key and of NOT NULL columns, as one row of counts.

    Row counts per key are pre-aggregated map-side, so one heavy key costs nothing extra.
    """
    required = list(dict.fromkeys([*keys, *required]))
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in required],
    )
    return per_key.agg(
        F.sum("_n").alias("n_rows"),
        F.count(F.when(F.col("_n") > 1, 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0)).alias("surplus_rows"),
        *[F.sum(f"null_{c}").alias(f"null_{c}") for c in required],
    )

