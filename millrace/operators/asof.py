"""As-of join: for each probe row, the nearest earlier (or later) row of the same key.

Both sides are put together and sorted by time within a key, where the last right row seen is the
answer: one shuffle and no join. A key too heavy for one task takes another way. Its time is cut
into range buckets, the sort covers one (key, bucket) pair, and what a bucket needs from those
before it is a single carried row. Its probe rows enter as distinct (key, time) pairs and are joined
back, and its right rows are made unique, so copies of a row do not pile up either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.rangebuckets import split_points, with_bucket
from millrace.session import shuffle_width

HEAVY_ROWS = 1_000_000
MAX_HEAVY_KEYS = 50_000
_DETECTION_SAMPLE = 0.01
_NULL_SPREAD = 4096


def join_asof(left: DataFrame, right: DataFrame, on: str | Sequence[str], left_ts: str, right_ts: str,
              columns: Sequence[str] | None = None, direction: str = "backward", allow_equal: bool = True,
              tolerance: str | None = None, how: str = "left", buckets: int | None = None,
              heavy_rows: int = HEAVY_ROWS, suffix: str | None = None) -> DataFrame:
    """Left rows with the columns of the nearest right row.

    ``direction`` is ``backward`` (last right row at or before), ``forward`` (first at or after) or
    ``equal``. ``allow_equal=False`` excludes an equal time. ``tolerance`` is an interval text such
    as ``'7 days'``. Among right rows with one key and time, the greatest by ``columns`` wins. Keys
    with more than ``heavy_rows`` rows are spread over ``buckets`` time ranges.

    A right column named like a left one, but for case, gets ``suffix``; without a suffix, or where that name
    is taken too, it is refused.
    """
    keys = [on] if isinstance(on, str) else list(on)
    columns = [c for c in right.columns if c not in keys] if columns is None else list(columns)
    matched = _join_views(left, [(right, right_ts, columns)], keys, left_ts, direction, allow_equal, tolerance, how, buckets, heavy_rows)
    return matched.toDF(*left.columns, *_free_names(left.columns, columns, suffix))


def _free_names(taken: Sequence[str], columns: Sequence[str], suffix: str | None) -> list[str]:
    """The right columns' names in the result, none of them a left column's or another's."""
    used, names = {c.lower() for c in taken}, []
    for column in columns:
        name = column + suffix if suffix and column.lower() in used else column
        if name.lower() in used:
            raise ValueError(f"both sides have a column {column}: give a suffix that makes it differ")
        used.add(name.lower())
        names.append(name)
    return names


def _join_views(left, views, keys, left_ts, direction="backward", allow_equal=True, tolerance=None, how="left", buckets=None,
                heavy_rows=HEAVY_ROWS):
    """As-of join with several right sides of one key and one time type; ``views`` holds (frame, time column, columns)."""
    dtype = views[0][0].schema[views[0][1]].dataType
    known = {}
    for number, (right, ts, columns) in enumerate(views):
        payload = F.struct(F.col(ts).alias("_rt"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)])
        known[f"_hit{number}"] = right.where(F.col(ts).isNotNull()).dropna(subset=keys).select(
            *keys, F.col(ts).alias("_t"), payload.alias("_hit"))
    backward = direction != "forward"

    if direction == "equal":
        matched = left
        for name, rows in known.items():
            matched = _joined_back(matched, rows.groupBy(*keys, "_t").agg(F.max("_hit").alias("_hit")), keys, left_ts, name)
    elif direction in ("backward", "forward"):
        heavy = _heavy_keys(left, list(known.values()), keys, heavy_rows)
        if heavy is None:
            matched = _by_key(left, known, keys, left_ts, dtype, backward, allow_equal)
        else:
            light = _by_key(left.join(heavy, keys, "left_anti"), {n: r.join(heavy, keys, "left_anti") for n, r in known.items()},
                            keys, left_ts, dtype, backward, allow_equal)
            some = full = left.join(heavy, keys, "left_semi")
            for name, rows in known.items():
                found = _by_bucket(some, rows.join(heavy, keys, "left_semi"), keys, left_ts, dtype, backward, allow_equal, buckets)
                full = _joined_back(full, found, keys, left_ts, name)
            matched = light.unionByName(full)
    else:
        raise ValueError(f"unknown direction: {direction}")

    taken = []
    for name, (_, _, columns) in zip(known, views):
        hit: Column = F.col(name)
        if tolerance is not None:
            gap = F.expr(f"INTERVAL {tolerance}")
            near = hit["_rt"] >= F.col(left_ts) - gap if direction == "backward" else hit["_rt"] <= F.col(left_ts) + gap
            hit = F.when(near, hit)
        matched = matched.withColumn(name, hit)
        if how == "inner":
            matched = matched.where(F.col(name).isNotNull())
        taken += [F.col(name)[f"_c{i}"].alias(c) for i, c in enumerate(columns)]
    return matched.select(*left.columns, *taken)


def _heavy_keys(left: DataFrame, rights: Sequence[DataFrame], keys: list[str], heavy_rows: int) -> DataFrame | None:
    """Keys that hold more than ``heavy_rows`` rows, ready to broadcast, or None.

    They are counted on a sample: a miss near the limit costs balance, never a result. A key must
    also hold more than one part in ``MAX_HEAVY_KEYS`` of the rows, so there cannot be more of them.
    """
    rate = 1.0 if heavy_rows < 100 / _DETECTION_SAMPLE else _DETECTION_SAMPLE
    rows = left.select(*keys)
    for right in rights:
        rows = rows.unionByName(right.select(*keys))
    rows = rows.dropna()
    counts = (rows if rate == 1.0 else rows.sample(rate, seed=0)).groupBy(*keys).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("total"))
    least = F.greatest(F.lit(heavy_rows * rate), F.coalesce(total.scalar(), F.lit(0)) / MAX_HEAVY_KEYS)
    found = counts.where(F.col("_n") > least).select(*keys).collect()
    return F.broadcast(left.sparkSession.createDataFrame(found, counts.select(*keys).schema)) if found else None


def _sides(allow_equal: bool) -> tuple[int, int]:
    """Sort order of (probe, right) rows at equal times: the row sorted first is not seen by the other."""
    return (1, 0) if allow_equal else (0, 1)


def _walk(partition: list[str], backward: bool, hits: Sequence[str] = ("_hit",)):
    time = F.col("_t").asc() if backward else F.col("_t").desc()
    # Ascending payload puts the greatest of equal-time right rows nearest to the probe. A row has one payload
    # only, so several of them do not disturb each other's order.
    return Window.partitionBy(*partition).orderBy(time, F.col("_side").asc(), *[F.col(h).asc() for h in hits]).rowsBetween(
        Window.unboundedPreceding, 0)


def _by_key(left, rights, keys, left_ts, dtype, backward, allow_equal):
    """Left rows with their nearest row of each right side, each key sorted by one task. One shuffle serves all sides."""
    probe_side, right_side = _sides(allow_equal)
    time = F.col(left_ts).cast(dtype)
    unmatched = time.isNull()
    for key in keys:
        unmatched = unmatched | F.col(key).isNull()
    # Rows that cannot match anything are spread, so that NULLs do not become a heavy key.
    spread = F.when(unmatched, F.pmod(F.xxhash64(*left.columns), F.lit(_NULL_SPREAD)) + 1).otherwise(F.lit(0))
    nothing = {name: F.lit(None).cast(right.schema["_hit"].dataType) for name, right in rights.items()}
    rows = left.select(
        *keys, spread.cast("long").alias("_spread"), time.alias("_t"), F.lit(probe_side).alias("_side"),
        F.struct(*left.columns).alias("_row"), *[n.alias(name) for name, n in nothing.items()])
    empty = F.lit(None).cast(rows.schema["_row"].dataType).alias("_row")
    for own, right in rights.items():
        rows = rows.unionByName(right.select(
            *keys, F.lit(0).cast("long").alias("_spread"), "_t", F.lit(right_side).alias("_side"), empty,
            *[(F.col("_hit") if name == own else n).alias(name) for name, n in nothing.items()]))
    walk = _walk([*keys, "_spread"], backward, list(rights))
    seen = [F.last(name, ignorenulls=True).over(walk).alias(name) for name in rights]
    return rows.select("_side", "_row", *seen).where(F.col("_side") == probe_side).select("_row.*", *rights)


def _joined_back(left, found, keys, left_ts, name):
    """Left rows with the hit of their (key, time) as ``name``; ``found`` has one row for each."""
    found = found.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_t", F.col("_hit").alias(name))
    condition = F.col(left_ts) == F.col("_t")
    for key in keys:
        condition = condition & (F.col(key) == F.col(f"_k_{key}"))
    return left.join(found, condition, "left").select(*left.columns, name)


def _by_bucket(left, right, keys, left_ts, dtype, backward, allow_equal, buckets):
    """(key, time, nearest right row) for each distinct (key, time) of the left side that has one."""
    right = right.groupBy(*keys, "_t").agg(F.max("_hit").alias("_hit"))
    points = split_points(right, "_t", buckets or shuffle_width(right.sparkSession))

    def bucketed(rows):
        rows = with_bucket(rows, "_t", points, "_b")
        return rows if backward else rows.withColumn("_b", -F.col("_b"))

    probe_side, right_side = _sides(allow_equal)
    probes = bucketed(left.select(*keys, F.col(left_ts).cast(dtype).alias("_t")).dropna().distinct())
    source = bucketed(right)

    # One carried row per (key, bucket): at most one per bucket and key, however heavy the key is.
    nothing = F.lit(None).cast(source.schema["_hit"].dataType)
    edge = F.max("_hit") if backward else F.min("_hit")
    steps = (
        source.select(*keys, "_b", "_hit")
        .unionByName(probes.select(*keys, "_b", nothing.alias("_hit")))
        .groupBy(*keys, "_b")
        .agg(edge.alias("_last"))
    )
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        steps.withColumn("_hit", F.last("_last", ignorenulls=True).over(before))
        .where(F.col("_hit").isNotNull())
        .select(*keys, F.col("_hit._rt").alias("_t"), "_hit", "_b", F.lit(right_side).alias("_side"))
    )
    rows = (
        source.select(*keys, "_t", "_hit", "_b", F.lit(right_side).alias("_side"))
        .unionByName(carried)
        .unionByName(probes.select(*keys, "_t", nothing.alias("_hit"), "_b", F.lit(probe_side).alias("_side")))
    )
    return (
        rows.withColumn("_hit", F.last("_hit", ignorenulls=True).over(_walk([*keys, "_b"], backward)))
        .where((F.col("_side") == probe_side) & F.col("_hit").isNotNull())
        .select(*keys, "_t", "_hit")
    )


def point_in_time(spine: DataFrame, views: Sequence[tuple[DataFrame, Sequence[str], str, Sequence[str]]],
                  spine_ts: str, **options) -> DataFrame:
    """Feature values as known at each spine row; ``views`` holds (frame, keys, time column, features).

    Views with the same keys and type of time share one shuffle and sort of the spine. ``options`` are those of
    ``join_asof``. Columns come in the order of the views.
    """
    together: dict[tuple, list] = {}
    for frame, keys, ts, features in views:
        kind = tuple(keys), frame.schema[ts].dataType.simpleString()
        together.setdefault(kind, []).append((frame.select(*keys, ts, *features), ts, list(features)))
    out = spine
    for (keys, _), some in together.items():
        out = _join_views(out, some, list(keys), spine_ts, **options)
    return out.select(*spine.columns, *[c for _, _, _, features in views for c in features])
