"""Distributed model fitting: MLlib estimators and closed forms from one aggregate."""

from __future__ import annotations

import math
import random
import uuid
from collections.abc import Iterator, Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml import Pipeline as SparkPipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALSModel
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.models import alternating
from millrace.operators.rangebuckets import dense_ids
from millrace.operators.sampling import with_split
from millrace.session import ensure_checkpoint_dir, scratch_dir

# Ratings of one block of the alternating fit, about 12 bytes each.
ALS_BLOCK_RATINGS = 60_000_000
# Points of k-means handled together, and the bytes of them that one task of a step may read.
KMEANS_BLOCK = 8192
KMEANS_TASK_BYTES = 64 << 20


def assembler(features: Sequence[str], output: str = "features") -> VectorAssembler:
    """Missing values become NaN in the vector, so no row is lost."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="keep")


def complete(features: str = "features") -> Column:
    """Whether a row's feature vector has all its values."""
    return ~F.exists(vector_to_array(features), F.isnan)


class MlPipeline(SparkPipeline):
    """A pipeline that learns from the rows whose inputs are all known, and keeps every row when it transforms.

    Predictions of the other rows mean nothing; ``score`` sets them to NULL.
    """

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        inputs = [c for s in self.getStages() if isinstance(s, VectorAssembler) for c in s.getInputCols()]
        return super()._fit(dataset.na.drop(subset=inputs) if inputs else dataset)


def score(model: PipelineModel, df: DataFrame, output: str = "prediction") -> DataFrame:
    """All rows of ``df`` with the model's columns; ``output`` is NULL where an input is missing."""
    scored = model.transform(df)
    return scored.withColumn(output, F.when(complete(), F.col(output)))


class NearestCentre(Model):
    """Adds ``cluster``, the number of the nearest centre, by a column expression."""

    def __init__(self, centres: np.ndarray, cost: float, costs: list[float]):
        super().__init__()
        self.centres, self.cost, self.costs = centres, cost, costs

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802 - as MLlib's model has it
        return list(self.centres)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array("features")
        away = [F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, y: t + y)
                for c in self.centres]
        return dataset.withColumn("_away", F.array(*away)).withColumn(
            "cluster", (F.array_position("_away", F.array_min("_away")) - 1).cast("int")).drop("_away")


class RestartedKMeans(Estimator):
    """k-means from several starts at a time; the one with the least cost stays.

    Each step is one pass over the points, which sums them up by start and nearest centre; starts that no longer move drop out.
    Starts are drawn by k-means++ from the distinct points with the least hashes, ``sample`` of them, so that they do not
    depend on how the rows are dealt or which task ends first.
    """

    def __init__(self, k: int, starts: int, seed: int, max_iter: int, tolerance: float = 1e-9, sample: int = 2000):
        super().__init__()
        self.k, self.starts, self.seed, self.max_iter, self.tolerance, self.sample = k, starts, seed, max_iter, tolerance, sample

    def _first_centres(self, points: DataFrame) -> list[np.ndarray]:
        drawn = points.distinct().orderBy(F.xxhash64(F.lit(self.seed), "x"), "x").limit(max(self.sample, 20 * self.k)).collect()
        found = np.array([r["x"] for r in drawn], np.float64)
        if not len(found):
            raise ValueError("no points to cluster")
        out = []
        for start in range(self.starts):
            random_ = np.random.default_rng([self.seed, start])
            chosen = [found[random_.integers(len(found))]]
            while len(chosen) < min(self.k, len(found)):
                away = np.min([((found - c) ** 2).sum(axis=1) for c in chosen], axis=0)
                chosen.append(found[random_.choice(len(found), p=away / away.sum())])
            out.append(np.array(chosen))
        return out

    def _fit(self, dataset: DataFrame) -> NearestCentre:
        points = dataset.select(vector_to_array("features").alias("x")).persist()
        packed = self._packed(points).persist()
        try:
            centres = self._first_centres(points)
            size = packed.agg(F.sum(F.length("points"))).first()[0]
            points.unpersist()
            # A step is short, so it has no more tasks than cores unless they would be too large.
            blocks = packed.coalesce(max(dataset.sparkSession.sparkContext.defaultParallelism, math.ceil(size / KMEANS_TASK_BYTES)))
            costs, moving = [float("inf")] * len(centres), set(range(len(centres)))
            for step in range(self.max_iter + 1):
                sums = self._step(blocks, {i: centres[i] for i in moving})
                for i in sorted(moving):
                    costs[i] = sum(r["cost"] for r in sums if r["start"] == i)
                    after = centres[i].copy()
                    for r in sums:
                        if r["start"] == i:
                            after[r["cluster"]] = np.array(r["total"]) / r["n"]
                    if step == self.max_iter or np.abs(after - centres[i]).max() <= self.tolerance * max(1.0, np.abs(centres[i]).max()):
                        moving.discard(i)  # the cost is that of the centres that stay
                    else:
                        centres[i] = after
                if not moving:
                    break
        finally:
            points.unpersist()
            packed.unpersist()
        best = min(range(len(costs)), key=costs.__getitem__)
        return NearestCentre(centres[best], costs[best], costs)

    @staticmethod
    def _packed(points: DataFrame) -> DataFrame:
        """The points' doubles as bytes, ``KMEANS_BLOCK`` points to a row: a step reads them without converting any."""
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, KMEANS_BLOCK):
                    x = batch["x"].slice(a, KMEANS_BLOCK).flatten().to_numpy(zero_copy_only=False)
                    yield pa.RecordBatch.from_arrays([pa.array([x.astype(np.float64, copy=False).tobytes()], pa.binary())], names=["points"])

        return points.mapInArrow(pack, "points binary")

    @staticmethod
    def _step(points: DataFrame, centres: dict[int, np.ndarray]) -> list:
        """Rows, sums and cost per start and nearest centre, of packed points: as many rows as there are centres."""
        width = len(next(iter(centres.values()))[0])

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Per start and centre: rows, cost, and the sum of each column.
            found = {i: np.zeros((2 + width, len(own))) for i, own in centres.items()}
            for batch in batches:
                for block in batch["points"]:
                    x = np.frombuffer(block.as_buffer(), np.float64).reshape(-1, width).T.copy()
                    for i, own in centres.items():
                        away = np.zeros((len(own), x.shape[1]))
                        for j in range(width):
                            away += (x[j] - own[:, j, None]) ** 2
                        nearest = away.argmin(axis=0)
                        for row, weights in zip(found[i], (None, away.min(axis=0), *x)):
                            row += np.bincount(nearest, weights, len(own))
            for i, own in found.items():
                number = np.flatnonzero(own[0])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(number), i), pa.int32()), pa.array(number, pa.int32()), pa.array(own[0, number].astype(np.int64)),
                    pa.array(own[1, number]), pa.array(list(own[2:, number].T), pa.list_(pa.float64()))],
                    names=["start", "cluster", "n", "cost", "total"])

        found = points.mapInArrow(sums, "start int, cluster int, n long, cost double, total array<double>")
        return found.groupBy("start", "cluster").agg(
            F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.array(*[F.sum(F.col("total")[j]) for j in range(width)]).alias("total")).collect()


def kmeans(features: Sequence[str], k: int, seed: int = 0, max_iter: int = 300, starts: int = 10) -> MlPipeline:
    """k-means from ``starts`` starts, the best of which stays; predictions go to ``cluster``."""
    return MlPipeline(stages=[assembler(features), RestartedKMeans(k, starts, seed, max_iter)])


def cluster_report(model: PipelineModel, scored: DataFrame, features: Sequence[str]) -> DataFrame:
    """Centre and size of each cluster; a row without cluster counts the rows that have none."""
    centres = [(i, *map(float, c)) for i, c in enumerate(model.stages[-1].clusterCenters())]
    schema = "cluster int, " + ", ".join(f"{f} double" for f in features)
    sizes = scored.groupBy("cluster").agg(F.count("*").alias("n"))
    none = sizes.where("cluster is null").select("*", *[F.lit(None).cast("double").alias(f) for f in features])
    return df_from(scored, centres, schema).join(sizes, "cluster", "left").fillna({"n": 0}).unionByName(none)


def df_from(like: DataFrame, rows: list, schema: str) -> DataFrame:
    return like.sparkSession.createDataFrame(rows, schema)


def linear_one(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least squares on one feature, in one aggregate."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


def linear_many(df: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    """Least squares on many features by the normal equations: one pass, state of size features squared."""
    return MlPipeline(stages=[
        assembler(features), LinearRegression(labelCol=label, solver="normal", regParam=0.0, standardization=False)
    ]).fit(df)


def coefficients(model: PipelineModel, like: DataFrame, features: Sequence[str]) -> DataFrame:
    fitted = model.stages[-1]
    rows = [("(intercept)", float(fitted.intercept))] + [(f, float(c)) for f, c in zip(features, fitted.coefficients)]
    return df_from(like, rows, "term string, value double")


class balanced_logistic:  # noqa: N801 - reads as a function at the call site
    """Logistic regression in which both classes carry the same total weight."""

    def __init__(self, features: Sequence[str], label: str, max_iter: int = 100, reg: float = 0.0):
        self.features, self.label, self.max_iter, self.reg = list(features), label, max_iter, reg

    def fit(self, df: DataFrame) -> PipelineModel:
        counts = {r[0]: r[1] for r in df.groupBy(self.label).count().limit(1001).collect()}
        if len(counts) > 1000:
            raise ValueError(f"{self.label} has too many classes")
        total = sum(counts.values())
        weight: Column = F.lit(1.0)
        for value, n in counts.items():
            weight = F.when(F.col(self.label) == F.lit(value), total / (len(counts) * n)).otherwise(weight)
        estimator = LogisticRegression(
            labelCol=self.label, weightCol="_weight", maxIter=self.max_iter, regParam=self.reg)
        return MlPipeline(stages=[assembler(self.features), estimator]).fit(df.withColumn("_weight", weight))


def naive_bayes(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Gaussian naive Bayes parameters: prior, mean and population variance per class and feature, in one pass."""
    wide = df.groupBy(label).agg(
        F.count("*").alias("n"),
        *[f(c).alias(f"{c}|{s}") for c in features for s, f in (("mean", F.avg), ("var", F.var_pop))])
    total = df.agg(F.count("*").alias("total"))
    return wide.select(
        F.col(label).alias("label"), (F.col("n") / total.scalar()).alias("prior"),
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(f"`{c}|mean`").alias("mean"), F.col(f"`{c}|var`").alias("variance"))
            for c in features])))


def naive_bayes_predict(df: DataFrame, parameters: DataFrame, features: Sequence[str], smoothing: float = 1e-9) -> DataFrame:
    """Most likely class by column expressions; parameters are one small row per class and feature."""
    rows = parameters.limit(2001).collect()
    if len(rows) > 2000:
        raise ValueError("too many class parameters for expressions")
    widest = max(r["variance"] for r in rows)
    scores = []
    for label in sorted({r["label"] for r in rows}):
        mine = {r["feature"]: r for r in rows if r["label"] == label}
        score = F.log(F.lit(next(iter(mine.values()))["prior"]))
        for c in features:
            variance = F.lit(mine[c]["variance"] + smoothing * widest)
            away = F.col(c) - F.lit(mine[c]["mean"])
            score = score - 0.5 * F.log(2 * F.pi() * variance) - away * away / (2 * variance)
        scores.append(F.struct(score.alias("score"), F.lit(label).alias("label")))
    return df.withColumn("prediction", F.greatest(*scores)["label"] if len(scores) > 1 else scores[0]["label"])


def forest(features: Sequence[str], label: str, trees: int = 300, depth: int = 5, seed: int = 0) -> MlPipeline:
    return MlPipeline(stages=[
        assembler(features), RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)])


def importances(model: PipelineModel, like: DataFrame, features: Sequence[str]) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray()
    return df_from(like, [(f, float(v)) for f, v in zip(features, values)], "feature string, importance double")


def boosted_regressor(features: Sequence[str], label: str, rounds: int = 100, rate: float = 0.1, depth: int = 5,
                      seed: int = 0) -> MlPipeline:
    return MlPipeline(stages=[
        assembler(features), GBTRegressor(labelCol=label, maxIter=rounds, stepSize=rate, maxDepth=depth, seed=seed)])


def boosted_classifier(features: Sequence[str], label: str, rounds: int = 100, rate: float = 0.1, depth: int = 5,
                       seed: int = 0) -> MlPipeline:
    return MlPipeline(stages=[
        assembler(features), GBTClassifier(labelCol=label, maxIter=rounds, stepSize=rate, maxDepth=depth, seed=seed)])


def with_folds(df: DataFrame, keys: Sequence[str], folds: int, seed: int = 0, name: str = "fold") -> DataFrame:
    """Fold number from a hash of a stable key: the same under any partitioning."""
    return with_split(df, [1.0] * folds, keys, seed, name)


def search(estimator, param_maps: list[dict], evaluator, df: DataFrame, keys: Sequence[str], folds: int = 3,
           seed: int = 0, parallelism: int = 8):
    """Cross-validated search. Returns the refitted best model and one row of mean score per point."""
    folded = with_folds(df, keys, folds, seed)
    fitted = CrossValidator(
        estimator=estimator, estimatorParamMaps=param_maps, evaluator=evaluator, numFolds=folds, foldCol="fold",
        parallelism=parallelism, collectSubModels=False).fit(folded)
    rows = [
        (i, ", ".join(sorted(f"{p.name}={v}" for p, v in point.items())), float(score))
        for i, (point, score) in enumerate(zip(param_maps, fitted.avgMetrics))
    ]
    return fitted.bestModel, df_from(df, rows, "point int, params string, score double")


def param_grid(grid: dict) -> list[dict]:
    """Every combination of the listed values."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def random_points(grid: dict, n: int, seed: int) -> list[dict]:
    """A seeded subset of the grid, without repeats."""
    points = param_grid(grid)
    return random.Random(seed).sample(points, min(n, len(points)))


def als_blocks(ratings: int) -> int:
    """Blocks a side for the alternating fit. A step sends each vector to every block that rates it, so no more than a task's share of ratings asks for."""
    return max(4, math.ceil(ratings / ALS_BLOCK_RATINGS))


def factorize(ratings: DataFrame, user: str, item: str, rating: str, rank: int = 10, iterations: int = 10,
              reg: float = 0.1, seed: int = 0, base: str | None = None) -> tuple[ALSModel, DataFrame, DataFrame]:
    """Factor a rating matrix without bias terms. Returns the model and both id maps.

    ALS wants 32-bit ids, so labels of any kind are numbered densely first. Ratings are computed once and written, as are
    the id maps and the ratings by number (``user_id``, ``item_id``, ``rating``): below ``base`` as ``users``, ``items`` and
    ``numbered``, by default in a new scratch folder.
    """
    spark = ratings.sparkSession
    ensure_checkpoint_dir(spark)
    base = base or scratch_dir(spark, "factors")
    ratings.select(user, item, F.col(rating).alias("rating")).write.parquet(f"{base}/ratings")
    ratings = spark.read.parquet(f"{base}/ratings")
    dense_ids(ratings, user, "user_id").write.parquet(f"{base}/users")
    dense_ids(ratings, item, "item_id").write.parquet(f"{base}/items")
    users, items = spark.read.parquet(f"{base}/users"), spark.read.parquet(f"{base}/items")
    ratings.join(users, user).join(items, item).select(
        F.col("user_id").cast("int"), F.col("item_id").cast("int"), "rating").write.parquet(f"{base}/numbered")
    numbered = spark.read.parquet(f"{base}/numbered")
    by_user, by_item = alternating.fit(
        numbered, "user_id", "item_id", "rating", rank, iterations, reg, seed, als_blocks(numbered.count()))
    made = spark._jvm.org.apache.spark.ml.recommendation.ALSModel(f"ALS_{uuid.uuid4().hex[:12]}", rank, by_user._jdf, by_item._jdf)
    model = ALSModel._from_java(made.setUserCol("user_id").setItemCol("item_id").setPredictionCol("prediction").setColdStartStrategy("nan"))
    return model, users, items


def factor_tables(model: ALSModel, users: DataFrame, items: DataFrame, user: str, item: str) -> tuple[DataFrame, DataFrame]:
    """(id, features) tables under the original labels."""
    made = []
    for factors, ids, number, label in ((model.userFactors, users, "user_id", user), (model.itemFactors, items, "item_id", item)):
        made.append(factors.join(ids, factors["id"] == ids[number]).select(
            F.col(label).alias("id"), F.col("features").cast("array<double>").alias("features")))
    return made[0], made[1]


def rank_features(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Features by strength of their correlation with the label."""
    wide = df.agg(*[F.corr(c, label).alias(c) for c in features])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr")) for c in features
    ]))).orderBy(F.desc(F.abs("corr")), "feature")
