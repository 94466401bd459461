"""Connected components of a graph given as edges, by alternating stars.

Each round points the larger neighbours of every node, then all of its smaller ones, at the least
node it knows, until the edges are stars around the least node of each component. Rounds are joins and
grouped minima; a node with many edges is combined before the shuffle and its join may be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import ensure_checkpoint_dir


def _towards_least(edges: DataFrame) -> DataFrame:
    """Each (u, v) with the least v of u beside it."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return edges.join(least, "u")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, a: str, b: str, most_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node that is not the least of its component; the component is its least node.

    Edges may repeat, run either way, or join a node to itself; null ends are ignored. The least node of a
    component, and a node without an edge to another one, are not listed. Without edges the result is empty.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    edges = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(f"`{a}` is not null and `{b}` is not null and u <> v").distinct().checkpoint()
    )
    before = _state(edges)
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _towards_least(both).where("v > u").select(F.col("v").alias("u"), F.least("least", "u").alias("v")).distinct()
        )
        known = _towards_least(large)
        edges = (
            known.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
            .unionByName(known.select("u", F.col("least").alias("v"))).distinct().checkpoint()
        )
        after = _state(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = after
    raise RuntimeError(f"components did not settle within {most_rounds} rounds")
