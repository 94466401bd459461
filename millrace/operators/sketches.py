"""Approximate aggregates whose states can be stored and merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def minhash_signature(df: DataFrame, item: str, by: Sequence[str], k: int = 64, name: str = "signature") -> DataFrame:
    """MinHash signature of each group's set of items: k minima of seeded hashes.

    All k minima are ordinary aggregates: they combine map-side, and a group of any size leaves
    each task as k numbers.
    """
    return df.where(F.col(item).isNotNull()).groupBy(*by).agg(
        F.array(*[F.min(F.xxhash64(item, F.lit(seed))) for seed in range(k)]).alias(name)
    )


def minhash_combine(signatures: DataFrame, by: Sequence[str], k: int, name: str = "signature") -> DataFrame:
    """Signature of the union of sets: the element-wise minimum."""
    return signatures.groupBy(*by).agg(F.array(*[F.min(F.col(name)[i]) for i in range(k)]).alias(name))


def signature_similarity(signatures: DataFrame, by: Sequence[str] = (), k: int = 64, name: str = "signature",
                         out: str = "similarity") -> DataFrame:
    """Estimated Jaccard index of all sets of a group together: the share of slots on which all agree.

    A slot agrees when its minimum equals its maximum, so this is one aggregate and no pairs of
    sets are formed.
    """
    slots = [F.when(F.min(F.col(name)[i]) == F.max(F.col(name)[i]), 1).otherwise(0) for i in range(k)]
    total = slots[0]
    for slot in slots[1:]:
        total = total + slot
    return signatures.groupBy(*by).agg((total / F.lit(k)).alias(out))


def hll_accumulate(df: DataFrame, item: str, by: Sequence[str], lg_k: int = 12) -> DataFrame:
    return df.groupBy(*by).agg(F.hll_sketch_agg(item, F.lit(lg_k)).alias("sketch"))


def hll_combine(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return states.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def hll_estimate(states: DataFrame, name: str = "n_distinct") -> DataFrame:
    return states.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")


def quantile_accumulate(df: DataFrame, value: str, by: Sequence[str], k: int = 400) -> DataFrame:
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def quantile_combine(states: DataFrame, by: Sequence[str] = (), k: int = 400) -> DataFrame:
    return states.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def quantile_estimate(states: DataFrame, probs: dict[str, float]) -> DataFrame:
    out = states
    for name, p in probs.items():
        out = out.withColumn(name, F.kll_sketch_get_quantile_double("sketch", F.lit(p)))
    return out.drop("sketch")


def topk_accumulate(df: DataFrame, item: str, by: Sequence[str], max_items: int = 10_000) -> DataFrame:
    return df.groupBy(*by).agg(F.expr(f"approx_top_k_accumulate({item}, {max_items})").alias("sketch"))


def topk_combine(states: DataFrame, by: Sequence[str] = (), max_items: int = 10_000) -> DataFrame:
    return states.groupBy(*by).agg(F.expr(f"approx_top_k_combine(sketch, {max_items})").alias("sketch"))


def topk_estimate(states: DataFrame, k: int) -> DataFrame:
    keep = [c for c in states.columns if c != "sketch"]
    return states.select(*keep, F.expr(f"inline(approx_top_k_estimate(sketch, {k}))").alias("item", "n"))
