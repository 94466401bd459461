"""Searches over gradient-boosted trees on binned rows.

Every numeric input is cut into bins and every category numbered, within each fold from the rows the fold learns from. Rows that
agree in all bins are one cell with a count and a sum of labels, which is all that boosting reads, so that one pass over the
rows serves every point of a grid. A model of n rounds is the first n rounds of a longer one: each (rate, depth, fold) is
one fit, run as a task of its own over the cells of its fold, and gives the predictions for all numbers of rounds asked for. A
second pass over the rows scores all points on the rows their fold left out.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.models.trees import TreeTable
from millrace.operators.sampling import with_split

MOST_CELLS = 200_000
MOST_CATEGORIES = 1_000
BINS = 64
SHRINK = 1.0
LEAST_WEIGHT = 1.0
TINY = 2.220446049250313e-16
LOSSES = ("squared", "logistic")
SCORES = {"absolute_percentage": False, "squared": False, "f1": True}  # whether more is better


@dataclass(frozen=True)
class Point:
    rounds: int
    rate: float
    depth: int


@dataclass
class SearchResult:
    """``scores`` has a row ``(point, rounds, rate, depth, score)`` per point; ``best`` is refitted on all rows as ``model``."""

    scores: DataFrame
    best: Point
    model: TreeTable


def boost(codes: np.ndarray, named: np.ndarray, n: np.ndarray, s: np.ndarray, point: Point, loss: str, stops: Sequence[int], keep: bool = False):
    """Boosted trees over cells with counts ``n`` and label sums ``s``. Codes are bins, or category numbers where ``named``.

    Returns the margins of all cells after each number of rounds in ``stops``, and with ``keep`` also the base and the trees: per
    tree a list of levels ``(feature, split)`` per node, feature -1 where a node is not split, and the leaf values.
    """
    total = n.sum()
    mean = s.sum() / total
    base = float(mean if loss == "squared" else np.log(max(mean, 1e-9) / max(1 - mean, 1e-9)))
    margin = np.full(len(n), base)
    bins = int(codes.max(initial=0)) + 1
    kept, trees = {}, []
    for rounds in range(1, max(stops) + 1):
        if loss == "squared":
            g, h = s - n * margin, n
        else:
            p = 1 / (1 + np.exp(-margin))
            g, h = s - n * p, n * p * (1 - p)
        node, levels = np.zeros(len(n), np.int64), []
        for level in range(point.depth):
            width = 1 << level
            whole_g, whole_h = np.bincount(node, g, width), np.bincount(node, h, width)
            plain = whole_g ** 2 / (whole_h + SHRINK)
            gain, feature, split = np.full(width, 1e-9), np.full(width, -1), np.zeros(width, np.int64)
            for f in range(codes.shape[1]):
                at = node * bins + codes[:, f]
                one_g, one_h = (np.bincount(at, x, width * bins).reshape(width, bins) for x in (g, h))
                if not named[f]:
                    one_g, one_h = one_g.cumsum(axis=1), one_h.cumsum(axis=1)
                rest_g, rest_h = whole_g[:, None] - one_g, whole_h[:, None] - one_h
                better = one_g ** 2 / (one_h + SHRINK) + rest_g ** 2 / (rest_h + SHRINK) - plain[:, None]
                better[(one_h < LEAST_WEIGHT) | (rest_h < LEAST_WEIGHT)] = 0
                top = better.argmax(axis=1)
                most = better[np.arange(width), top]
                wins = most > gain
                gain[wins], feature[wins], split[wins] = most[wins], f, top[wins]
            levels.append((feature, split))
            own, cut = feature[node], split[node]
            code = codes[np.arange(len(n)), np.maximum(own, 0)]
            right = np.where(named[np.maximum(own, 0)], code != cut, code > cut) & (own >= 0)
            node = 2 * node + right
        width = 1 << point.depth
        leaf = point.rate * np.bincount(node, g, width) / (np.bincount(node, h, width) + SHRINK)
        margin = margin + leaf[node]
        if keep:
            trees.append((levels, leaf))
        if rounds in stops:
            kept[rounds] = margin
    return (kept, base, trees) if keep else kept


class _Bins:
    """Bin edges and category numbers, per fold, learnt from the rows outside the fold; the last set from all rows."""

    def __init__(self, rows: DataFrame, numeric: Sequence[str], categories: Sequence[str], folds: int, bins: int):
        self.numeric, self.categories, self.folds = list(numeric), list(categories), folds
        shares = [i / bins for i in range(1, bins)]
        learns = lambda f: F.lit(True) if f == folds else F.col("fold") != f
        found = rows.agg(*[
            F.percentile_approx(F.when(learns(f), F.col(c)), shares, 10_000).alias(f"{f}_{i}")
            for f in range(folds + 1) for i, c in enumerate(numeric)]).first() if numeric else {}
        self.edges = [[sorted({float(x) for x in found[f"{f}_{i}"] or []}) for i in range(len(numeric))] for f in range(folds + 1)]
        self.names: list[list[list[str]]] = [[] for _ in range(folds + 1)]
        for c in categories:
            pairs = rows.select(c, "fold").distinct().limit(MOST_CATEGORIES * folds + 1).collect()
            if len(pairs) > MOST_CATEGORIES * folds:
                raise ValueError(f"{c} has more than {MOST_CATEGORIES} categories")
            for f in range(folds + 1):
                self.names[f].append(sorted({r[0] for r in pairs if f == folds or r[1] != f}))

    def codes(self, f: int) -> Column:
        """Codes of a row under the bins of fold ``f``: the number of edges below a value, or 1 and more for known categories."""
        numbers = [self._bin(F.col(c), self.edges[f][i]) for i, c in enumerate(self.numeric)]
        named = [
            F.coalesce(F.array_position(F.array(*[F.lit(v) for v in self.names[f][i]]), F.col(c)).cast("int"), F.lit(0)) if self.names[f][i] else F.lit(0)
            for i, c in enumerate(self.categories)]
        return F.array(*numbers, *named)

    @staticmethod
    def _bin(value: Column, edges: list[float]) -> Column:
        def tree(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            mid = (low + high) // 2
            return F.when(value <= F.lit(edges[mid]), tree(low, mid)).otherwise(tree(mid + 1, high))

        return tree(0, len(edges))


def _tree_table(bins: _Bins, point: Point, base: float, trees: list, loss: str) -> TreeTable:
    """The kept trees with thresholds on the inputs themselves. A category is an input of its own, 1 where a row has it."""
    f, n_numeric = bins.folds, len(bins.numeric)
    inputs = [*bins.numeric, *[f"{c}={v}" for i, c in enumerate(bins.categories) for v in bins.names[f][i]]]
    first = np.cumsum([0, *[len(v) for v in bins.names[f]]]) + n_numeric
    feature, threshold, left, value, roots = [], [], [], [], []

    def put(at: int, levels: list, leaf: np.ndarray, level: int, node: int) -> None:
        while level < len(levels) and levels[level][0][node] < 0:  # not split: all rows went left
            level, node = level + 1, 2 * node
        if level == len(levels):
            value[at] = float(leaf[node])
            return
        own, cut = int(levels[level][0][node]), int(levels[level][1][node])
        numbers = own < n_numeric
        feature[at] = own if numbers else int(first[own - n_numeric]) + cut - 1
        edges = bins.edges[f][own] if numbers else []
        threshold[at] = edges[cut] if numbers else 0.5
        left[at] = len(left)
        for kind in (feature, threshold, left, value):
            kind += [0, 0]
        # Rows of the category went left there; here they are above the threshold, so the sides change.
        sides = (0, 1) if numbers else (1, 0)
        for side in (0, 1):
            put(left[at] + side, levels, leaf, level + 1, 2 * node + sides[side])

    for levels, leaf in trees:
        roots.append(len(left))
        for kind in (feature, threshold, left, value):
            kind.append(0)
        put(roots[-1], levels, leaf, 0, 0)
    return TreeTable(
        tuple(inputs), tuple(feature), tuple(threshold), tuple(left), tuple(value), tuple(roots), point.depth, base,
        "logistic" if loss == "logistic" else "none")


def with_categories(df: DataFrame, table: TreeTable) -> DataFrame:
    """Adds the columns ``category=value`` that a refitted model reads."""
    added = {n: (F.col(n.split("=", 1)[0]) == n.split("=", 1)[1]).cast("double") for n in table.inputs if "=" in n}
    return df.withColumns(added) if added else df


def _score_of(score: str, y: Column, p: list[Column]) -> list[Column]:
    """Per point the aggregate of the rows of a fold."""
    if score == "squared":
        return [F.avg((y - x) * (y - x)) for x in p]
    if score == "absolute_percentage":
        return [F.avg(F.abs(y - x) / F.greatest(F.abs(y), F.lit(TINY))) for x in p]
    out = []
    for x in p:
        said = (x > 0).cast("double")
        hits = F.sum(said * y)
        out.append(F.coalesce(2 * hits / F.nullif(F.sum(said) + F.sum(y), F.lit(0.0)), F.lit(0.0)))
    return out


def boosted_search(
    df: DataFrame, numeric: Sequence[str], label: str, keys: Sequence[str], points: Sequence[Point], categories: Sequence[str] = (),
    loss: str = "squared", score: str = "absolute_percentage", folds: int = 3, bins: int = BINS, most_cells: int = MOST_CELLS, seed: int = 0,
) -> SearchResult:
    """Cross-validated score of every point, the best one refitted on all rows.

    Learns from and scores the rows whose inputs and label are known; folds are drawn by a hash of ``keys``. ``loss`` is ``squared``, or
    ``logistic`` for labels 0 and 1; ``score`` is ``squared`` or ``absolute_percentage`` error, or ``f1``. A category that a fold has not
    learnt is like none of the others. The cells of a fold are what one task holds: while there are more than ``most_cells``, the
    bins are halved. Time grows with rows for the two passes, and with cells, rounds and depth for the fits.
    """
    if loss not in LOSSES or score not in SCORES or not points:
        raise ValueError("no such loss or score, or no points")
    points = list(points)
    rows = with_split(df.na.drop(subset=[*numeric, *categories, label]), [1.0] * folds, keys, seed, "fold").select(
        *[F.col(c).cast("double").alias(c) for c in numeric], *[F.col(c).cast("string").alias(c) for c in categories],
        F.col(label).cast("double").alias("y"), "fold").persist()
    try:
        return _search(rows, numeric, categories, points, loss, score, folds, bins, most_cells)
    finally:
        rows.unpersist()


def _search(rows: DataFrame, numeric, categories, points: list[Point], loss: str, score: str, folds: int, bins: int, most_cells: int) -> SearchResult:
    spark = rows.sparkSession
    while True:
        own = _Bins(rows, numeric, categories, folds, bins)
        learns = lambda f: F.lit(1) if f == folds else (F.col("fold") != f).cast("int")
        coded = rows.select(F.inline(F.array(*[
            F.struct(F.lit(f).alias("f"), own.codes(f).alias("codes"), learns(f).alias("n"), (learns(f) * F.col("y")).alias("s")) for f in range(folds + 1)])))
        cells = coded.groupBy("f", "codes").agg(F.sum("n").cast("double").alias("n"), F.sum("s").alias("s")).persist()
        most = cells.groupBy("f").count().agg(F.max("count")).first()[0]
        if most is None:
            raise ValueError("no row has all inputs and a label")
        if most <= most_cells:
            break
        cells.unpersist()
        if bins <= 2:
            raise ValueError(f"over {most_cells} different rows in two bins per input")
        bins //= 2

    named = np.array([False] * len(numeric) + [True] * len(categories))
    fits = sorted({(p.rate, p.depth) for p in points})
    stops = [sorted({p.rounds for p in points if (p.rate, p.depth) == fit}) for fit in fits]

    def stack(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = np.stack(table["codes"].to_numpy()).astype(np.int64)
        order = np.lexsort(codes.T)  # the same sums in the same order under any partitioning
        return codes[order], table["n"].to_numpy()[order], table["s"].to_numpy()[order]

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        k = key[1].as_py()
        codes, n, s = stack(table)
        margins = boost(codes, named, n, s, Point(0, *fits[k]), loss, stops[k])
        values = np.stack([margins[r] for r in stops[k]], axis=1)
        return pa.table({
            "f": pa.array(np.full(len(n), key[0].as_py()), pa.int32()), "k": pa.array(np.full(len(n), k), pa.int32()),
            "codes": pa.array(list(codes.astype(np.int32)), pa.list_(pa.int32())), "margins": pa.array(list(values), pa.list_(pa.float64()))})

    tasks = cells.where(F.col("f") < folds).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(len(fits) - 1))))
    fitted = tasks.repartition(max(1, min(folds * len(fits), 4 * spark.sparkContext.defaultParallelism)), "f", "k").groupBy("f", "k").applyInArrow(
        fit, "f int, k int, codes array<int>, margins array<double>")
    wide = fitted.groupBy("f", "codes").agg(F.map_from_entries(F.collect_list(F.struct("k", "margins"))).alias("margins"))

    at = reduce(lambda rest, f: F.when(F.col("fold") == f, own.codes(f)).otherwise(rest), range(folds), F.lit(None).cast("array<int>"))
    left_out = rows.select(F.col("fold").cast("int").alias("f"), at.alias("codes"), "y")
    places = [(fits.index((p.rate, p.depth)), stops[fits.index((p.rate, p.depth))].index(p.rounds)) for p in points]
    p = [F.col("margins")[k][i] for k, i in places]
    by_fold = left_out.join(wide, ["f", "codes"]).groupBy("f").agg(*[x.alias(f"s{i}") for i, x in enumerate(_score_of(score, F.col("y"), p))])
    row = by_fold.agg(*[F.avg(f"s{i}").alias(f"s{i}") for i in range(len(points))]).first()
    results = [float(x) for x in row]
    best = points[max(range(len(points)), key=lambda i: results[i] if SCORES[score] else -results[i])]

    def refit(table: pa.Table) -> pa.Table:
        codes, n, s = stack(table)
        _, base, trees = boost(codes, named, n, s, best, loss, [best.rounds], keep=True)
        return pa.table({"model": pa.array([pickle.dumps((base, trees))], pa.binary())})

    base, trees = pickle.loads(cells.where(F.col("f") == folds).groupBy("f").applyInArrow(refit, "model binary").first()["model"])
    cells.unpersist()
    scores = spark.createDataFrame(
        [(i, x.rounds, float(x.rate), x.depth, y) for i, (x, y) in enumerate(zip(points, results))], "point int, rounds int, rate double, depth int, score double")
    return SearchResult(scores, best, _tree_table(own, best, base, trees, loss))
