"""Dot products of many pairs of vectors, without a copy of a vector per pair."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.rangebuckets import MAX_BROADCAST_ROWS
from millrace.operators.semistruct import dot

LEFT, RIGHT = 0, 1
# What one task may hold: pairs of a cell, vector components of a side.
CELL_PAIRS = 4_000_000
CELL_VALUES = 20_000_000
_CHUNK = 1 << 15


def _matches(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each wanted id among sorted ids, and how often it is there."""
    first = np.searchsorted(ids, wanted, "left")
    return first, np.searchsorted(ids, wanted, "right") - first


def _side(vectors: pa.Table, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted ids, and of each one's vector its length (-1: unknown), its start and all components."""
    own = vectors.filter(pc.equal(vectors["_side"], side)).sort_by("_id").combine_chunks()
    lists = own["_v"].combine_chunks() if isinstance(own["_v"], pa.ChunkedArray) else own["_v"]
    sizes = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))])[:-1]
    return own["_id"].to_numpy(), sizes, starts, lists.flatten().to_numpy(zero_copy_only=False)


def _cell(left_id: str, right_id: str, names: list[str], output: str):
    def run(rows: pa.Table, vectors: pa.Table) -> pa.Table:
        (ids_a, size_a, start_a, flat_a), (ids_b, size_b, start_b, flat_b) = _side(vectors, LEFT), _side(vectors, RIGHT)
        first_a, n_a = _matches(ids_a, rows[left_id].to_numpy())
        first_b, n_b = _matches(ids_b, rows[right_id].to_numpy())
        # An id that stands for several vectors gives a row for each.
        times = n_a * n_b
        at = np.repeat(np.arange(len(times)), times)
        turn = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
        a, b = first_a[at] + turn // n_b[at], first_b[at] + turn % n_b[at]
        known = (size_a[a] == size_b[b]) & (size_a[a] >= 0)
        out = np.zeros(len(at))
        for size in np.unique(size_a[a][known]):
            same = np.flatnonzero(known & (size_a[a] == size))
            for k in range(0, len(same), _CHUNK):
                part, steps = same[k:k + _CHUNK], np.arange(size)[:, None]
                terms = flat_a[start_a[a[part]] + steps].astype(np.float64) * flat_b[start_b[b[part]] + steps]
                total = np.zeros(len(part))
                for term in terms:  # one after the other, as a sum over the arrays adds them
                    total += term
                out[part] = total
        return rows.select(names).take(pa.array(at)).append_column(output, pa.array(out, mask=~known))

    return run


def dot_pairs(pairs: DataFrame, left_id: str, right_id: str, left: DataFrame, right: DataFrame, output: str = "prediction",
              cells: int | None = None) -> DataFrame:
    """``pairs`` joined with the vectors ``v`` of ``left`` by ``left_id`` and of ``right`` by ``right_id``: their dot products.

    Ids are whole numbers. Pairs without a vector on either side drop out, an id with several vectors gives a row for each; the
    product is NULL where a vector is, has a NULL component or another length than the other.

    Both sides are dealt into ``cells`` blocks by a hash of the id; a task holds the pairs of two blocks and the vectors that they
    need. So a vector moves at most once per block and not once per pair. ``cells`` follows the counts of pairs and
    components unless given; few vectors are broadcast instead.
    """
    totals = [v.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.greatest(F.size("v"), F.lit(0))), F.lit(0)).alias("values")).first() for v in (left, right)]
    if not cells and max(t["n"] for t in totals) <= MAX_BROADCAST_ROWS:
        sides = (F.broadcast(v.select(F.col(c), F.col("v").cast("array<double>").alias(name))) for v, c, name in ((left, left_id, "_l"), (right, right_id, "_r")))
        joined = pairs.join(next(sides), left_id).join(next(sides), right_id)
        return joined.select(*pairs.columns, dot(F.col("_l"), F.col("_r")).alias(output))
    cells = cells or max(4, math.ceil(math.sqrt(pairs.count() / CELL_PAIRS)), math.ceil(max(t["values"] for t in totals) / CELL_VALUES))
    block = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(cells)).cast("int")
    dealt = pairs.where(F.col(left_id).isNotNull() & F.col(right_id).isNotNull()).withColumns({"_a": block(left_id), "_b": block(right_id)})

    def needed(vectors: DataFrame, name: str, side: int) -> DataFrame:
        whole = F.when(~F.exists("v", F.isnull), F.col("v").cast(kind))
        return dealt.select(name, "_a", "_b").distinct().join(vectors.select(name, "v"), name).select(
            F.lit(side).alias("_side"), F.col("_a").alias("_x"), F.col("_b").alias("_y"), F.col(name).cast("long").alias("_id"), whole.alias("_v"))

    single = all(isinstance(v.schema["v"].dataType.elementType, T.FloatType) for v in (left, right))
    kind = "array<float>" if single else "array<double>"
    vectors = needed(left, left_id, LEFT).unionByName(needed(right, right_id, RIGHT))
    schema = T.StructType([*pairs.schema.fields, T.StructField(output, T.DoubleType())])
    return dealt.groupBy("_a", "_b").cogroup(vectors.groupBy("_x", "_y")).applyInArrow(
        _cell(left_id, right_id, pairs.columns, output), schema)
