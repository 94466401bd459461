"""Order-dependent work without a single-task window.

Row numbers, running sums and exact quantiles over a whole table need a global order. Here the
order column is cut at literal boundary values into range buckets; counts per bucket give each
bucket's starting offset, and windows run inside a bucket only. Boundaries only balance the work:
results are exact for any choice of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import shuffle_width

_LABELS_PER_BUCKET = 16
FINE = 64
_TAIL_HALVINGS = 6
# Boundaries only balance the work, so they are taken from a sample; results never depend on them.
_BOUNDARY_SAMPLE = 0.05
MAX_BROADCAST_ROWS = 20_000
# A summary is off by at most one rank in so many.
ACCURACY = 10_000


def _fractions(buckets: int) -> list[float]:
    """Even shares, both ends halved again and again, and the ends themselves: a long tail is cut like the middle."""
    tails = [0.5 ** k / buckets for k in range(1, _TAIL_HALVINGS + 1)]
    return sorted({0.0, 1.0, *(i / buckets for i in range(1, buckets)), *tails, *(1 - t for t in tails)})


def _boundaries(found: Sequence | None) -> list:
    return sorted({p for p in found or [] if not isinstance(p, float) or math.isfinite(p)})


def split_points(df: DataFrame, column: str, buckets: int) -> list:
    """Boundary values that cut ``column`` into about ``buckets`` even ranges and its tails into smaller ones.

    For strings they are all of a sample of labels, ``_LABELS_PER_BUCKET`` to a range.
    """
    if buckets <= 1:
        return []
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        sample = df.select(column).sample(_BOUNDARY_SAMPLE, seed=0)
        return _boundaries(sample.agg(F.percentile_approx(column, _fractions(buckets), 10_000).alias("p")).first()["p"])
    # No percentile for strings: the labels with the smallest hashes are an even sample of them.
    sample = (
        df.select(column)
        .where(F.col(column).isNotNull())
        .distinct()
        .orderBy(F.xxhash64(column), column)
        .limit(buckets * _LABELS_PER_BUCKET)
        .collect()
    )
    return sorted(row[0] for row in sample)


def _coarse_bucket(value: Column, points: Sequence, dtype: T.DataType) -> Column:
    """Number of boundaries at or below ``value``, as a balanced tree of comparisons."""

    def literal(point) -> Column:
        if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.lit(str(point)).cast(dtype)
        return F.lit(point)

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(value < literal(points[mid]), tree(low, mid)).otherwise(tree(mid + 1, high))

    return tree(0, len(points))


def _fine_bucket(coarse: Column, number: Column, ladder: Column) -> Column:
    """Cut the range between two boundaries into equal widths, by arithmetic."""
    below, above = F.get(ladder, coarse - 1), F.get(ladder, coarse)
    width = F.when(above > below, above - below)  # NULL outside the outermost boundaries
    step = F.coalesce(F.floor((number - below) / width * F.lit(float(FINE))), F.lit(0))
    return coarse * F.lit(FINE) + F.greatest(F.lit(0), F.least(step, F.lit(FINE - 1))).cast("int")


def _label_bucket(value: Column, points: Sequence[str], dtype: T.DataType) -> tuple[Column, Column]:
    """Coarse and fine number of a label: a tree finds its group of boundaries, and those at or below it are counted."""
    groups = [points[i:i + _LABELS_PER_BUCKET] for i in range(0, len(points), _LABELS_PER_BUCKET)]
    coarse = _coarse_bucket(value, [g[0] for g in groups[1:]], dtype)
    inside = F.get(F.array(*[F.array(*[F.lit(p) for p in g]) for g in groups]), F.col("_coarse"))
    # NULL comes after all labels of the last group.
    fine = F.when(value.isNull(), _LABELS_PER_BUCKET).otherwise(F.size(F.filter(inside, lambda p: p <= value)))
    return coarse, F.col("_coarse") * (_LABELS_PER_BUCKET + 1) + fine


def _number(value: Column, dtype: T.DataType) -> Column:
    """The value as a double that grows with it; seconds for times, days for dates."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value) / F.lit(1e6)
    if isinstance(dtype, T.TimestampNTZType):
        # Field by field: going through a zoned timestamp could run backwards at a clock change.
        day = F.unix_date(value.cast("date")).cast("double")
        return day * 86400 + F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
    return value.cast("double")


def _point_number(point, dtype: T.DataType) -> float | None:
    if isinstance(dtype, T.NumericType):
        return float(point)
    if isinstance(dtype, T.DateType):
        return float((point - date(1970, 1, 1)).days)
    if isinstance(dtype, T.TimestampType):
        return point.timestamp()
    if isinstance(dtype, T.TimestampNTZType):
        return (point - datetime(1970, 1, 1)).total_seconds()
    return None


def with_bucket(df: DataFrame, column: str, points: Sequence, name: str = "_bucket") -> DataFrame:
    """Add the range bucket of ``column``: a number that never decreases as the value grows.

    A tree of comparisons finds the boundaries around the value. For numbers, dates and times the
    range between them is cut further, which multiplies the buckets without another pass; for strings
    the tree finds a group of boundaries. The tree is a column of its own, so that it is evaluated once.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType) and points:
        coarse, fine = _label_bucket(F.col(column), points, dtype)
        return df.withColumn("_coarse", coarse).withColumn(name, fine).drop("_coarse")
    coarse = _coarse_bucket(F.col(column), points, dtype)
    marks = [_point_number(p, dtype) for p in points]
    if not marks or marks[0] is None:
        return df.withColumn(name, coarse)
    ladder = F.array(*[F.lit(m) for m in marks])
    fine = _fine_bucket(F.col("_coarse"), _number(F.col(column), dtype), ladder)
    return df.withColumn("_coarse", coarse).withColumn(name, fine).drop("_coarse")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match; right-hand keys are dropped."""
    renamed = right
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_r_{key}")
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(renamed[f"_r_{key}"])
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{k}" for k in keys])


def running_sums(df: DataFrame, order_by: str, sums: dict[str, str], by: Sequence[str] = (),
                 buckets: int | None = None, points: Sequence | None = None) -> DataFrame:
    """Add inclusive running sums of weight columns in ``order_by`` order, per ``by`` group.

    ``sums`` maps an output name to its weight column. ``df`` should hold one row per
    (group, order value); pre-aggregate it so that equal values cannot pile up.
    """
    by = list(by)
    if points is None:
        points = split_points(df, order_by, buckets or shuffle_width(df.sparkSession))
    cut = with_bucket(df, order_by, points)
    keys = [*by, "_bucket"]
    totals = cut.groupBy(*keys).agg(*[F.sum(w).alias(f"_t_{o}") for o, w in sums.items()])
    # One row per bucket here, so this window holds at most `buckets * FINE` rows per group.
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, *[F.coalesce(F.sum(f"_t_{o}").over(earlier), F.lit(0)).alias(f"_o_{o}") for o in sums]
    )
    # NULLs fall into the last bucket, so they come last inside it as well.
    inside = Window.partitionBy(*keys).orderBy(F.col(order_by).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    local = cut
    for out, weight in sums.items():
        local = local.withColumn(out, F.sum(weight).over(inside))
    joined = null_safe_join(local, offsets, keys)
    for out in sums:
        joined = joined.withColumn(out, F.col(out) + F.col(f"_o_{out}"))
    return joined.drop("_bucket", *[f"_o_{o}" for o in sums])


def dense_ids(df: DataFrame, column: str, id_name: str, start: int = 0, buckets: int | None = None) -> DataFrame:
    """Map each distinct label to ``start, start + 1, ...`` in label order, NULL last."""
    labels = df.select(column).distinct()
    points = split_points(df if not isinstance(df.schema[column].dataType, T.StringType) else labels,
                          column, buckets or shuffle_width(df.sparkSession))
    counted = running_sums(labels.withColumn("_one", F.lit(1).cast("long")), column, {id_name: "_one"}, points=points)
    return counted.select(column, (F.col(id_name) - 1 + start).alias(id_name))


def _result_decimal(dtype: T.DataType) -> T.DecimalType | None:
    """A decimal for quantiles of whole numbers and decimals, with up to six digits more; None for types whose results are doubles."""
    if isinstance(dtype, T.IntegralType):
        return T.DecimalType(38, 6)
    if isinstance(dtype, T.DecimalType):
        return T.DecimalType(38, min(dtype.scale + 6, 38 - (dtype.precision - dtype.scale)))
    return None


def exact_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]], by: Sequence[str] = (),
                    buckets: int | None = None, decimals: bool = False) -> DataFrame:
    """Exact interpolated quantiles: one row per group, one column per ``{name: (column, probability)}``.

    Two passes. The first builds a mergeable summary per group and column, whose error bound brackets each wanted rank
    between two values. The second counts the rows below the bracket, and by value those inside it, a few
    in ten thousand; equal values are combined before they are shuffled, and a bracket is cut into ``buckets``
    ranges, so no task sees a whole group. Groups of fewer than ``2 * ACCURACY`` rows are counted by value whole.

    Each column is ranked in its own type, so whole numbers and decimals are exact however they are combined. The result is a
    double, rounded once; with ``decimals`` it is a decimal for such columns, which also holds numbers beyond 2^53.
    """
    by, columns = list(by), list(dict.fromkeys(c for c, _ in wanted.values()))
    kinds = {c: df.select(c).schema[0].dataType for c in columns}
    ranges = buckets or FINE
    margin = 2 / ACCURACY
    ends = {c: sorted({e for d, p in wanted.values() if d == c for e in (max(0.0, p - margin), min(1.0, p + margin))}) for c in columns}
    summaries = df.groupBy(*by).agg(*[
        x for i, c in enumerate(columns) for x in (
            F.count(c).alias(f"_n{i}"), F.percentile_approx(F.col(c).cast("double"), ends[c], ACCURACY).alias(f"_e{i}"))])
    summaries = broadcast_if_small(summaries)
    joined = null_safe_join(df.select(*dict.fromkeys([*by, *columns])), summaries, by) if by else df.select(*columns).crossJoin(F.broadcast(summaries))

    cells = []
    for w, (c, p) in enumerate(wanted.values()):
        i, value = columns.index(c), F.col(c).cast("double")
        large = F.col(f"_n{i}") >= 2 * ACCURACY
        low, high = (F.col(f"_e{i}")[ends[c].index(e)] for e in (max(0.0, p - margin), min(1.0, p + margin)))
        inside = ~large | ((value >= low) & (value <= high))
        step = F.coalesce(F.floor((value - low) / F.when(high > low, high - low) * ranges), F.lit(0))
        cells.append(F.struct(
            F.lit(w).alias("_w"), F.col(f"_n{i}").alias("_all"),
            F.when(F.col(c).isNull() | (large & (value > high)), None).when(~inside, -1).otherwise(
                F.greatest(F.lit(0), F.least(step, F.lit(ranges - 1))).cast("int")).alias("_range"),
            *[(F.when(inside, F.col(d)) if d == c else F.lit(None).cast(kinds[d])).alias(f"_v{j}") for j, d in enumerate(columns)]))
    values = [f"_v{i}" for i in range(len(columns))]
    keys = [*by, "_w", "_range"]
    counts = joined.select(*by, F.inline(F.array(*cells))).where("_range is not null").groupBy(*keys, *values).agg(
        F.max("_all").alias("_all"), F.count(F.lit(1)).alias("_c"))
    # At most `ranges + 1` rows per group and quantile go through this window.
    upto = Window.partitionBy(*by, "_w").orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    shares = F.array(*[F.lit(float(p)) for _, p in wanted.values()])
    position = F.get(shares, F.col("_w")) * (F.col("_all") - 1)
    ranks = F.array(*[F.struct(F.lit(side).alias("side"), rounding(position).cast("long").alias("rank")) for side, rounding in (("lo", F.floor), ("hi", F.ceil))])
    targets = (
        counts.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.max("_all").alias("_all"))
        .withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))
        .withColumn("_ranks", F.filter(ranks, lambda r: (r["rank"] >= F.col("_before")) & (r["rank"] < F.col("_before") + F.col("_n"))))
        .where("_range >= 0 and size(_ranks) > 0").select(*keys, "_before", "_ranks"))
    inside = Window.partitionBy(*keys).orderBy(*values).rowsBetween(Window.unboundedPreceding, 0)
    placed = null_safe_join(counts, targets, keys).withColumn("_end", F.col("_before") + F.sum("_c").over(inside))
    hits = placed.select(
        *by, "_w", "_all", *values,
        F.explode(F.filter("_ranks", lambda r: (r["rank"] >= F.col("_end") - F.col("_c")) & (r["rank"] < F.col("_end")))).alias("_r"))

    def pick(w: int, field: str, side: str) -> Column:
        return F.max(F.when((F.col("_w") == w) & (F.col("_r.side") == side), F.col(field)))

    sides = hits.groupBy(*by).agg(*[
        pick(w, field, side).alias(f"_{kind}{side}{w}") for w, (c, _) in enumerate(wanted.values())
        for kind, field, side in (("v", f"_v{columns.index(c)}", "lo"), ("v", f"_v{columns.index(c)}", "hi"), ("n", "_all", "lo"))])
    out = []
    for w, (name, (c, p)) in enumerate(wanted.items()):
        low, high, n = F.col(f"_vlo{w}"), F.col(f"_vhi{w}"), F.col(f"_nlo{w}")
        position, kind = F.lit(float(p)) * (n - 1), _result_decimal(kinds[c])
        share = position - F.floor(position)
        if kind is None:
            low, high = low.cast("double"), high.cast("double")
            value = low + F.when(low == high, 0.0).otherwise((high - low) * share)
        else:
            away = (high.cast(kind) - low.cast(kind)).cast("double") * share
            value = low.cast(kind) + away.cast(kind) if decimals else low.cast("double") + away
        out.append(value.alias(name))
    return sides.select(*by, *out)


def broadcast_if_small(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Compute a frame that is expected to be tiny. If it is, join it by broadcast; otherwise leave it
    as it is, to be joined by a shuffle."""
    rows = df.limit(limit + 1).collect()
    return df if len(rows) > limit else F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
