"""Boosted searches against plain Python over single rows, and tree ensembles as SQL against the models themselves."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.models import boosting as bo
from millrace.models import fits, trees
from millrace.models.registry import register_sql_model
from millrace.operators.sampling import with_split


def slow_boost(rows, ys, named, point, loss):
    """Boosting over single rows of codes, split by split. Returns the margin of each row."""
    mean = sum(ys) / len(ys)
    margin = [mean if loss == "squared" else math.log(mean / (1 - mean))] * len(ys)
    for _ in range(point.rounds):
        p = margin if loss == "squared" else [1 / (1 + math.exp(-m)) for m in margin]
        g = [y - x for y, x in zip(ys, p)]
        h = [1.0] * len(ys) if loss == "squared" else [x * (1 - x) for x in p]
        parts = [list(range(len(rows)))]
        for _ in range(point.depth):
            cut = []
            for part in parts:
                total = lambda ix: (sum(g[i] for i in ix), sum(h[i] for i in ix))
                gain_of = lambda t: t[0] ** 2 / (t[1] + 1)
                best, sides = 1e-9, (part, [])
                for f in range(len(named)):
                    for v in sorted({r[f] for r in rows}):
                        one = [i for i in part if (rows[i][f] == v if named[f] else rows[i][f] <= v)]
                        rest = [i for i in part if i not in set(one)]
                        a, b = total(one), total(rest)
                        if a[1] < 1 or b[1] < 1:
                            continue
                        gain = gain_of(a) + gain_of(b) - gain_of(total(part))
                        if gain > best + 1e-12:
                            best, sides = gain, (one, rest)
                cut += sides
            parts = cut
        for part in parts:
            step = point.rate * sum(g[i] for i in part) / (sum(h[i] for i in part) + 1)
            for i in part:
                margin[i] += step
    return margin


@pytest.mark.parametrize("loss", bo.LOSSES)
def test_cells_boost_like_rows(loss):
    rng = random.Random(4)
    rows = [(rng.randrange(6), rng.randrange(4), rng.randrange(3)) for _ in range(90)]
    ys = [float(r[0] * 2 - r[1] + (r[2] == 1) * 3 + rng.gauss(0, 1)) if loss == "squared" else float(r[0] + rng.random() * 3 > 4) for r in rows]
    cells = sorted(set(rows))
    n = np.array([float(rows.count(c)) for c in cells])
    s = np.array([sum(y for r, y in zip(rows, ys) if r == c) for c in cells])
    point, named = bo.Point(7, 0.3, 3), [False, False, True]
    found = bo.boost(np.array(cells), np.array(named), n, s, point, loss, [3, 7])
    for rounds in (3, 7):
        slow = slow_boost(rows, ys, named, bo.Point(rounds, 0.3, 3), loss)
        assert [found[rounds][cells.index(r)] for r in rows] == pytest.approx(slow, abs=1e-9)


def _data(spark, n=400):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        x, c = rng.random() * 10, rng.choice("abc")
        rows.append((i, x, rng.randrange(5), c, 5 + x * 2 + (c == "b") * 7 + rng.random()))
    rows += [(n, None, 1, "a", 1.0), (n + 1, 1.0, 1, None, 1.0), (n + 2, 1.0, 1, "a", None), (3, *rows[3][1:])]
    return spark.createDataFrame(rows, "id long, x double, k int, c string, y double")


GRID = [bo.Point(n, rate, depth) for n in (2, 8, 30) for rate in (0.1, 0.4) for depth in (1, 3)]


@pytest.mark.parametrize("score", ["absolute_percentage", "squared"])
def test_search_scores_the_rows_left_out(spark, score):
    df = _data(spark)
    found = bo.boosted_search(df, ["x", "k"], "y", ["id"], GRID, categories=["c"], score=score, bins=8)
    scores = {r.point: r.score for r in found.scores.collect()}
    assert len(scores) == len(GRID) and found.best == GRID[min(scores, key=scores.get)]
    # The same by hand for some points: bins, categories and trees from the rows of the other folds.
    rows = with_split(df.na.drop(), [1.0] * 3, ["id"], 0, "fold").withColumn("c", F.col("c").cast("string"))
    own = bo._Bins(rows.withColumn("x", F.col("x")).withColumn("k", F.col("k").cast("double")), ["x", "k"], ["c"], 3, 8)
    for place in (0, 5, 11):
        errors = []
        for f in range(3):
            coded = [(tuple(r.codes), r.y, r.fold) for r in rows.select(own.codes(f).alias("codes"), "y", "fold").collect()]
            cells = sorted({c for c, _, _ in coded})
            n = np.array([float(sum(c == x and w != f for x, _, w in coded)) for c in cells])
            s = np.array([sum(y for x, y, w in coded if x == c and w != f) for c in cells])
            p = GRID[place]
            margin = bo.boost(np.array(cells), np.array([False, False, True]), n, s, p, "squared", [p.rounds])[p.rounds]
            off = [y - margin[cells.index(c)] for c, y, w in coded if w == f]
            truth = [y for _, y, w in coded if w == f]
            errors.append(np.mean(np.square(off)) if score == "squared" else np.mean(np.abs(off) / np.abs(truth)))
        assert scores[place] == pytest.approx(np.mean(errors), rel=1e-6)


def test_refitted_model_as_columns(spark):
    """The model of all rows by expressions gives the margins of the cells; a missing input gives NULL, an unknown category none of the known."""
    df = _data(spark)
    found = bo.boosted_search(df, ["x", "k"], "y", ["id"], [bo.Point(20, 0.3, 4)], categories=["c"], bins=8)
    priced = trees.predict(bo.with_categories(df, found.model), found.model)
    known = df.na.drop().select(F.col("x"), F.col("k").cast("double").alias("k"), "c", "y").withColumn("fold", F.lit(0))
    own = bo._Bins(known, ["x", "k"], ["c"], 3, 8)
    coded = [(tuple(r.codes), r.y, (r.x, r.k, r.c)) for r in known.select(own.codes(3).alias("codes"), "y", "x", "k", "c").collect()]
    cells = sorted({c for c, _, _ in coded})
    n = np.array([float(sum(c == x for x, _, _ in coded)) for c in cells])
    s = np.array([sum(y for x, y, _ in coded if x == c) for c in cells])
    margin = bo.boost(np.array(cells), np.array([False, False, True]), n, s, bo.Point(20, 0.3, 4), "squared", [20])[20]
    want = {row: margin[cells.index(c)] for c, _, row in coded}
    rows = priced.collect()
    assert all(r.prediction == pytest.approx(want[r.x, float(r.k), r.c], abs=1e-9) for r in rows if None not in (r.x, r.c, r.y))
    assert all(r.prediction is None for r in rows if r.x is None or r.c is None)
    strange = trees.predict(bo.with_categories(df.limit(5).withColumn("c", F.lit("zz")), found.model), found.model)
    assert strange.where("prediction is null").count() == 0


def test_search_under_any_partitioning(spark):
    scores = set()
    for n in (1, 3, 8):
        found = bo.boosted_search(_data(spark).repartition(n), ["x", "k"], "y", ["id"], GRID[:4], categories=["c"], bins=8)
        scores.add((found.best, tuple(round(r.score, 9) for r in found.scores.orderBy("point").collect())))
    assert len(scores) == 1


def test_two_classes_and_limits(spark):
    df = _data(spark).withColumn("t", (F.col("y") > 17).cast("int"))
    found = bo.boosted_search(df, ["x", "k"], "t", ["id"], GRID, categories=["c"], loss="logistic", score="f1", bins=16)
    assert found.scores.agg(F.max("score")).first()[0] > 0.9
    shares = trees.predict(bo.with_categories(df, found.model), found.model).na.drop()
    assert shares.where("prediction not between 0 and 1").count() == 0
    assert shares.where("(prediction > 0.5) <> (t = 1)").count() < 0.1 * shares.count()
    coarse = bo.boosted_search(df, ["x", "k"], "y", ["id"], GRID[:2], bins=64, most_cells=60)
    assert coarse.scores.count() == 2
    with pytest.raises(ValueError, match="different rows"):
        bo.boosted_search(df, ["x", "k"], "y", ["id"], GRID[:1], most_cells=1)
    with pytest.raises(ValueError, match="no row"):
        bo.boosted_search(df.limit(0), ["x"], "y", ["id"], GRID[:1])
    with pytest.raises(ValueError, match="loss or score"):
        bo.boosted_search(df, ["x"], "y", ["id"], GRID[:1], score="other")


@pytest.mark.parametrize("kind", ["forest", "boosted", "regression"])
def test_trees_from_sql(spark, kind):
    df = _data(spark).withColumn("t", (F.col("y") > 17).cast("int"))
    known = df.na.drop()
    if kind == "regression":
        model, result = fits.boosted_regressor(["x", "k"], "y", rounds=6, depth=3).fit(known), F.col("prediction")
    else:
        from pyspark.ml.functions import vector_to_array
        learner = fits.forest(["x", "k"], "t", trees=9, depth=4) if kind == "forest" else fits.boosted_classifier(["x", "k"], "t", rounds=6, depth=3)
        model, result = learner.fit(known), vector_to_array("probability")[1]
    assert register_sql_model(spark, f"tree_{kind}", model) == ["x", "k"]
    direct = {(r.id, r.x): r.v for r in model.transform(known).select("id", "x", result.alias("v")).collect()}
    df.createOrReplaceTempView("tree_rows")
    called = spark.sql(f"SELECT id, x, y, c, tree_{kind}(x, k) AS v FROM tree_rows").collect()
    assert all(r.v == pytest.approx(direct[r.id, r.x], abs=1e-12) for r in called if (r.id, r.x) in direct)
    assert all((r.v is None) == (r.x is None) for r in called)
    with pytest.raises(TypeError):
        trees.tree_table(spark, fits.linear_many(known, ["x"], "y").stages[-1], ["x"])
