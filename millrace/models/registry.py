"""Stored model versions and scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.models.fits import complete
from millrace.models.trees import register_sql_trees, tree_table
from millrace.sources.versions import children, natural_order


COMMITTED = "committed"


class ModelStore:
    """Fitted pipelines under ``<root>/<name>/<version>``; the newest version is the default."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def save(self, name: str, version: str, model: PipelineModel) -> None:
        """The marker is written last, so a version counts only once all of it is there."""
        path = f"{self.root}/{name}/{version}"
        model.write().save(path)
        self.spark.range(1).write.parquet(f"{path}/{COMMITTED}")

    def versions(self, name: str) -> list[str]:
        """Versions whose save was completed."""
        path = f"{self.root}/{name}"
        done = [v for v in children(self.spark, path) if "_SUCCESS" in children(self.spark, f"{path}/{v}/{COMMITTED}")]
        return sorted(done, key=natural_order)

    def load(self, name: str, version: str | None = None) -> PipelineModel:
        return PipelineModel.load(f"{self.root}/{name}/{version or self.versions(name)[-1]}")


def register_sql_model(spark: SparkSession, name: str, model: PipelineModel) -> list[str]:
    """Make a fitted pipeline callable in SQL: ``name(input, ...)`` is the probability of class 1, or the prediction of a regression.

    For two-class logistic models, forests and boosted models. The function is an SQL expression of the model, so
    queries that call it stay inside the JVM. Its parameters are the pipeline's inputs in order, which are returned; a
    missing input gives NULL.
    """
    inputs = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    fitted = model.stages[-1]
    if not isinstance(fitted, LogisticRegressionModel):
        register_sql_trees(spark, name, tree_table(spark, fitted, inputs))
        return list(inputs)
    terms = [f"{float(w)!r}D * p{i}" for i, w in enumerate(fitted.coefficients)]
    parameters = ", ".join(f"p{i} DOUBLE" for i in range(len(inputs)))
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS DOUBLE "
        f"RETURN 1 / (1 + exp(-({' + '.join([f'{float(fitted.intercept)!r}D', *terms])})))")
    return list(inputs)


def probabilities(scored: DataFrame, keys: list[str], classes: int = 2) -> DataFrame:
    """Keys, one probability column per class, and the predicted class; NULL where an input is missing."""
    values, known = vector_to_array("probability"), complete()
    return scored.select(
        *keys, *[F.when(known, values[i]).alias(f"probability_{i}") for i in range(classes)], F.when(known, F.col("prediction")).alias("prediction"))
