"""Univariate feature tests for all columns at once, and selections by their p-values.

Every test is one grouped aggregation that is combined before the shuffle; what is left is a few sums
per feature, from which the statistics are column expressions. Rows with a missing feature or label
do not count for that feature.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("k_best", "percentile", "fpr", "fdr", "fwe")
STEPS, TINY = 500, 1e-300


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after a shift of the argument beyond 10."""
    x = np.asarray(x, dtype=float)
    shift, low = np.zeros_like(x), x.copy()
    for _ in range(10):
        near = low < 10
        shift = shift + np.where(near, np.log(np.where(near, low, 1.0)), 0.0)
        low = np.where(near, low + 1, low)
    series = 1 / (12 * low) - 1 / (360 * low**3) + 1 / (1260 * low**5) - 1 / (1680 * low**7)
    return (low - 0.5) * np.log(low) - low + 0.5 * np.log(2 * np.pi) + series - shift


def _continued(first: np.ndarray, terms) -> np.ndarray:
    """A continued fraction first + a1/(b1 + a2/(b2 + ...)), evaluated forwards (modified Lentz)."""
    value = np.where(first == 0, TINY, first)
    up, down = value.copy(), np.zeros_like(value)
    for a, b in terms:
        down = b + a * down
        up = b + a / up
        down = 1 / np.where(down == 0, TINY, down)
        up = np.where(up == 0, TINY, up)
        value = value * up * down
        if np.all(np.abs(up * down - 1) < 1e-15):
            break
    return value


def _beta_share(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function, where x is below (a + 1) / (a + b + 2)."""
    def terms():
        one = np.ones_like(x)
        yield one, one
        for m in range(STEPS):
            if m:
                yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), one
            yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), one

    safe = np.clip(x, TINY, 1 - 1e-16)
    front = a * np.log(safe) + b * np.log1p(-safe) + _log_gamma(a + b) - _log_gamma(a) - _log_gamma(b)
    return np.where(x <= 0, 0.0, np.exp(front) * _continued(np.zeros_like(x), terms()) / a)


def f_tail(f: np.ndarray, df1: np.ndarray, df2: np.ndarray) -> np.ndarray:
    """Chance of a greater value under the F distribution."""
    f, df1, df2 = (np.asarray(v, dtype=float) for v in (f, df1, df2))
    a, b, x = df2 / 2, df1 / 2, df2 / (df2 + df1 * np.maximum(f, 0))
    swap = x > (a + 1) / (a + b + 2)
    left = _beta_share(np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x))
    return np.clip(np.where(swap, 1 - left, left), 0, 1)


def chi_tail(statistic: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Chance of a greater value under the chi-square distribution."""
    statistic, df = (np.asarray(v, dtype=float) for v in (statistic, df))
    a, x = df / 2, np.maximum(statistic, 0) / 2
    near = x < a + 1
    front = np.exp(a * np.log(np.maximum(x, TINY)) - x - _log_gamma(a))
    term = total = 1 / a
    inner = np.where(near, x, 0.0)
    for n in range(1, 100_000):
        term = term * inner / (a + n)
        total = total + term
        if np.all(term <= total * 1e-16):
            break
    outer = np.where(near, a + 2, x)

    def terms():
        for n in range(1, 100_000):
            yield n * (a - n), outer + 2 * n + 1 - a

    far = front / _continued(outer + 1 - a, terms())
    return np.where(statistic <= 0, 1.0, np.clip(np.where(near, 1 - front * total, far), 0, 1))


@F.pandas_udf(T.DoubleType())
def _f_tails(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    known = np.asarray(f.notna() & df1.gt(0) & df2.gt(0))
    return pd.Series(f_tail(*(np.where(known, v, 1.0) for v in (f, df1, df2)))).where(known)


@F.pandas_udf(T.DoubleType())
def _chi_tails(statistic: pd.Series, df: pd.Series) -> pd.Series:
    known = np.asarray(df, dtype=float) > 0
    return pd.Series(np.where(known, chi_tail(statistic, np.where(known, df, 1)), 1.0)).where(statistic.notna())


def _long(df: DataFrame, features: Sequence[str], kept: Sequence[Column], kind: str) -> DataFrame:
    """A row per feature and row of ``df``: ``feature``, ``value``."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast(kind).alias("value")) for f in features])
    return df.select(*kept, F.inline(pairs))


def anova_scores(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """F test of numeric features against a class label: (feature, statistic, df1, df2, p_value).

    The aggregation holds a row per class; spreads are taken about the class means, so large offsets do
    not cancel. A feature that is constant within every class has no statistic unless its means
    differ, then it is infinite with a chance of 0. NaN counts as missing.
    """
    known = [F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias(f) for f in features]
    classes = df.where(F.col(label).isNotNull()).select(F.col(label).alias("_class"), *known).groupBy("_class").agg(*[
        F.struct(F.count(f).alias("n"), F.avg(f).alias("m"), F.var_pop(f).alias("v")).alias(f) for f in features])
    rows = classes.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f)["n"].alias("n"), F.col(f)["m"].alias("m"), F.col(f)["v"].alias("v")) for f in features
    ]))).where("n > 0")
    total = Window.partitionBy("feature")
    centred = rows.withColumn("grand", F.sum(F.col("n") * F.col("m")).over(total) / F.sum("n").over(total))
    sums = centred.groupBy("feature").agg(
        F.sum(F.col("n") * F.pow(F.col("m") - F.col("grand"), 2)).alias("between"), F.sum(F.col("n") * F.col("v")).alias("within"),
        (F.count("*") - 1).alias("df1"), (F.sum("n") - F.count("*")).alias("df2"))
    return _with_f_tails(sums, (F.col("between") / F.col("df1")) / (F.nullif("within", F.lit(0.0)) / F.col("df2")),
                         (F.col("within") == 0) & (F.col("between") > 0))


def regression_scores(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """F test of a linear relation to a numeric label: (feature, statistic, df1, df2, p_value).

    One aggregation without grouping; a constant feature has no statistic.
    """
    both = df.select(*[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias(f) for f in features],
                     F.nanvl(F.col(label).cast("double"), F.lit(None).cast("double")).alias("_y"))
    pair = {f: F.col(f).isNotNull() & F.col("_y").isNotNull() for f in features}
    one = both.agg(*[F.struct(
        F.covar_pop(f, "_y").alias("c"), F.var_pop(F.when(both_known, F.col(f))).alias("x"), F.var_pop(F.when(both_known, F.col("_y"))).alias("y"),
        F.count_if(both_known).alias("n")).alias(f) for f, both_known in pair.items()])
    sums = one.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f)["n"].alias("n"),
                 F.try_divide(F.col(f)["c"] * F.col(f)["c"], F.col(f)["x"] * F.col(f)["y"]).alias("share")) for f in features
    ]))).select("feature", F.when(F.col("share") > 1, 1.0).otherwise(F.col("share")).alias("share"), F.lit(1).cast("bigint").alias("df1"), (F.col("n") - 2).alias("df2"))
    squared = F.col("share")
    return _with_f_tails(sums, squared / F.nullif(1 - squared, F.lit(0.0)) * F.col("df2"), (squared == 1) & (F.col("df2") > 0))


def _with_f_tails(sums: DataFrame, statistic: Column, endless: Column) -> DataFrame:
    usable = (F.col("df1") > 0) & (F.col("df2") > 0)
    scored = sums.withColumn("statistic", F.when(usable & endless, F.lit(float("inf"))).when(usable, statistic))
    return scored.select("feature", "statistic", "df1", "df2", F.when(F.col("statistic") == float("inf"), 0.0).otherwise(
        _f_tails("statistic", "df1", "df2")).alias("p_value"))


def contingency_scores(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Independence of discrete features and a label.

    (feature, statistic, df, p_value, mutual_information, information_p_value): Pearson's chi-square, and the
    mutual information in nats whose double times the number of rows is chi-square as well.
    One aggregation counts (feature, value, label) for all features; both margins are sums of its rows.
    Bin continuous columns first.
    """
    cells = _long(df.where(F.col(label).isNotNull()), features, [F.col(label).cast("string").alias("_class")], "string").where(
        "value is not null").groupBy("feature", "value", "_class").agg(F.count("*").alias("n"))
    by_value = cells.groupBy("feature", "value").agg(F.sum("n").alias("row"))
    by_class = cells.groupBy("feature", "_class").agg(F.sum("n").alias("col"))
    totals = by_class.groupBy("feature").agg(F.sum("col").alias("all"), F.count("*").alias("classes"))
    n, row, col, whole = F.col("n"), F.col("row"), F.col("col"), F.col("all")
    values = by_value.groupBy("feature").agg(F.count("*").alias("values"))
    sums = cells.join(by_value, ["feature", "value"]).join(by_class, ["feature", "_class"]).join(totals, "feature").groupBy("feature").agg(
        F.first("all").alias("all"), F.first("classes").alias("classes"), F.sum(n * n / (row * col.cast("double"))).alias("share"),
        F.sum(n / whole * F.log(n * whole.cast("double") / (row * col.cast("double")))).alias("mi"))
    scored = sums.join(values, "feature").select(
        "feature", (F.col("all") * F.greatest(F.col("share") - 1, F.lit(0.0))).alias("statistic"),
        ((F.col("classes") - 1) * (F.col("values") - 1)).alias("df"), F.greatest("mi", F.lit(0.0)).alias("mutual_information"), "all")
    return scored.select(
        "feature", "statistic", "df", _chi_tails("statistic", "df").alias("p_value"), "mutual_information",
        _chi_tails(2 * F.col("all") * F.col("mutual_information"), F.col("df")).alias("information_p_value"))


def select_by(scores: DataFrame, mode: str, limit: float, by: str = "statistic", p_value: str = "p_value") -> list[str]:
    """Names of the features a selection keeps, best first.

    ``k_best``: the ``limit`` greatest by ``by``; ``percentile``: that many hundredths of the features;
    ``fpr``: chance below ``limit``; ``fwe``: below ``limit`` over the number of features; ``fdr``: Benjamini
    and Hochberg's step-up rule. Ties go by name; features without a statistic are never kept. A score
    table has a row per column, so it is read by the driver.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    every = scores.select("feature", by, p_value).toPandas()
    known = every[every[by].notna() & every[p_value].notna()]
    ranked = known.sort_values([by, "feature"], ascending=[False, True])
    if mode == "k_best":
        return ranked["feature"].head(int(limit)).tolist()
    if mode == "percentile":
        return ranked["feature"].head(int(len(every) * limit / 100)).tolist()
    p = ranked[p_value]
    if mode == "fpr":
        return ranked["feature"][p < limit].tolist()
    if mode == "fwe":
        return ranked["feature"][p < limit / max(len(every), 1)].tolist()
    steps = np.sort(p.to_numpy())
    passed = steps[steps <= limit * np.arange(1, len(steps) + 1) / max(len(every), 1)]
    return ranked["feature"][p <= passed[-1]].tolist() if len(passed) else []
