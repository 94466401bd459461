"""Model metrics, each as one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import ratio
from millrace.operators.aggregates import histogram
from millrace.operators.rangebuckets import running_sums

# Fixed value: the smallest denominator of a percentage error (the double-precision epsilon).
MAPE_EPSILON = 2.220446049250313e-16

MAX_LABELS = 300


def regression(df: DataFrame, actual: str, predicted: str, count: str | None = None) -> DataFrame:
    """R2 and RMSE. The residual sum and the spread of the actual values come from the same pass.

    ``count`` names a further column with the number of predictions, from that pass too.
    """
    error = F.col(actual) - F.col(predicted)
    sums = df.agg(
        F.sum(error * error).alias("sse"), F.var_pop(actual).alias("var"), F.count(error).alias("n"), F.count(predicted).alias("_predictions"))
    return sums.select(
        *([F.col("_predictions").alias(count)] if count else []),
        (1 - F.try_divide(F.col("sse"), F.col("var") * F.col("n"))).alias("r2"), F.sqrt(F.col("sse") / F.col("n")).alias("rmse"))


def mape(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    share = F.abs(F.col(actual) - F.col(predicted)) / F.greatest(F.abs(F.col(actual).cast("double")), F.lit(MAPE_EPSILON))
    return df.agg(F.avg(share).alias("mape"))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows per (actual, predicted) pair over the grid of all labels, zeros included.

    One pass counts the pairs that occur. A matrix has as many rows as labels squared, so more than
    ``MAX_LABELS`` labels are refused.
    """
    counts = df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))
    rows = counts.limit(MAX_LABELS**2 + 1).collect()
    labels = {r["actual"] for r in rows} | {r["predicted"] for r in rows}
    if len(labels) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    found = {(r["actual"], r["predicted"]): r["n"] for r in rows}
    return df.sparkSession.createDataFrame([(a, p, found.get((a, p), 0)) for a in labels for p in labels], counts.schema)


def classification(df: DataFrame, actual: str, predicted: str, positive=1) -> DataFrame:
    """Accuracy, precision, recall and F1; a quotient without a denominator is 0."""
    a, p = F.col(actual) == F.lit(positive), F.col(predicted) == F.lit(positive)
    c = df.agg(
        F.sum((a & p).cast("int")).alias("tp"), F.sum((~a & p).cast("int")).alias("fp"), F.sum((a & ~p).cast("int")).alias("fn"),
        F.sum((F.col(actual) == F.col(predicted)).cast("int")).alias("right"), F.count("*").alias("n"))
    zero = F.lit(0.0)
    return c.select(
        (F.col("right") / F.col("n")).alias("accuracy"),
        F.coalesce(ratio("tp", F.col("tp") + F.col("fp")), zero).alias("precision"),
        F.coalesce(ratio("tp", F.col("tp") + F.col("fn")), zero).alias("recall"),
        F.coalesce(ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), zero).alias("f1"))


def auc(df: DataFrame, actual: str, score: str, points: Sequence | None = None) -> DataFrame:
    """Area under the ROC curve, ties counted half.

    Rows are first counted per distinct score; the running number of negatives below each score
    then comes from range buckets, so no task sorts all scores.
    """
    per_score = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.sum((F.col(actual) == 1).cast("bigint")).alias("pos"), F.sum((F.col(actual) != 1).cast("bigint")).alias("neg"))
    ranked = running_sums(per_score, "score", {"neg_upto": "neg"}, points=points)
    below = F.col("neg_upto") - F.col("neg") / 2
    return ranked.agg(F.try_divide(
        F.sum(F.col("pos") * below), F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"))


def residual_histogram(df: DataFrame, actual: str, predicted: str, bins: int = 50) -> DataFrame:
    return histogram(df.select((F.col(actual) - F.col(predicted)).alias("residual")), "residual", bins)
