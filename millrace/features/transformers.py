"""Feature transformers: ``fit`` is one aggregate pass, ``transform`` only adds column expressions.

The arithmetic follows the usual single-machine definitions, which MLlib does not share in places:
population standard deviation, 0 for a constant column under min-max scaling, and categories in
sorted order.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.rangebuckets import dense_ids, exact_quantiles
from millrace.session import scratch_dir

MAX_CATEGORIES = 10_000
MAX_ONE_HOT = 1_000


class Transformer:
    """Columns in, columns out. Without ``output_cols`` the inputs are replaced."""

    def __init__(self, input_cols: Sequence[str], output_cols: Sequence[str] | None = None, drop_input_cols: bool = False):
        self.input_cols = [input_cols] if isinstance(input_cols, str) else list(input_cols)
        self.output_cols = list(self.input_cols if output_cols is None else
                                [output_cols] if isinstance(output_cols, str) else output_cols)
        self.drop_input_cols = drop_input_cols
        if len(self.output_cols) != len(self.input_cols):
            raise ValueError("as many output columns as input columns are needed")

    def fit(self, df: DataFrame) -> Transformer:
        return self

    def column(self, name: str) -> Column:
        raise NotImplementedError

    def transform(self, df: DataFrame) -> DataFrame:
        made = {out: self.column(name) for name, out in zip(self.input_cols, self.output_cols)}
        return self._finish(df.withColumns(made))

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def _finish(self, df: DataFrame) -> DataFrame:
        gone = [c for c in self.input_cols if c not in self.output_cols] if self.drop_input_cols else []
        return df.drop(*gone)

    def _stats(self, df: DataFrame, **functions) -> dict[str, dict]:
        """Statistics of all input columns from one pass over the data."""
        row = df.agg(*[
            f(F.col(c).cast("double")).alias(f"{i}|{s}") for i, c in enumerate(self.input_cols) for s, f in functions.items()
        ]).first()
        return {c: {s: row[f"{i}|{s}"] for s in functions} for i, c in enumerate(self.input_cols)}


def _scaled(value: Column, offset: float | None, width: float | None) -> Column:
    """(value - offset) / width; a width of 0 (constant column) counts as 1. NULL if nothing was seen in ``fit``."""
    if offset is None or width is None:
        return F.lit(None).cast("double")
    return (value.cast("double") - F.lit(float(offset))) / F.lit(float(width) or 1.0)


class MinMaxScaler(Transformer):
    def __init__(self, input_cols, output_cols=None, drop_input_cols=False, feature_range=(0.0, 1.0), clip=False):
        super().__init__(input_cols, output_cols, drop_input_cols)
        self.feature_range, self.clip = feature_range, clip

    def fit(self, df):
        self.stats = self._stats(df, low=F.min, high=F.max)
        return self

    def column(self, name):
        low, high = self.feature_range
        seen = self.stats[name]
        value = _scaled(F.col(name), seen["low"], _width(seen["low"], seen["high"]))
        value = value * F.lit(float(high - low)) + F.lit(float(low))
        # least/greatest skip NULLs, so a NULL input must be kept NULL explicitly.
        return F.when(F.col(name).isNotNull(), F.greatest(F.least(value, F.lit(float(high))), F.lit(float(low)))) if self.clip else value


class StandardScaler(Transformer):
    def fit(self, df):
        self.stats = self._stats(df, mean=F.avg, std=F.stddev_pop)
        return self

    def column(self, name):
        return _scaled(F.col(name), self.stats[name]["mean"], self.stats[name]["std"])


class MaxAbsScaler(Transformer):
    def fit(self, df):
        self.stats = self._stats(df, high=lambda c: F.max(F.abs(c)))
        return self

    def column(self, name):
        return _scaled(F.col(name), 0.0, self.stats[name]["high"])


class RobustScaler(Transformer):
    """Centre on the median, scale by the interquartile range; exact quartiles unless ``exact=False``."""

    def __init__(self, input_cols, output_cols=None, drop_input_cols=False, exact=True):
        super().__init__(input_cols, output_cols, drop_input_cols)
        self.exact = exact

    def fit(self, df):
        if self.exact:
            quartiles = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
            row = exact_quantiles(df, {f"{q}|{c}": (c, p) for c in self.input_cols for q, p in quartiles.items()}).first()
            self.stats = {c: {q: row[f"{q}|{c}"] for q in quartiles} for c in self.input_cols}
        else:
            found = self._stats(df, q=lambda c: F.percentile_approx(c, [0.25, 0.5, 0.75]))
            self.stats = {c: dict(zip(("q1", "q2", "q3"), s["q"])) for c, s in found.items()}
        return self

    def column(self, name):
        s = self.stats[name]
        return _scaled(F.col(name), s["q2"], _width(s["q1"], s["q3"]))


class Normalizer(Transformer):
    """Scale each row's input columns to unit l1, l2 or max norm; a zero row stays as it is."""

    def __init__(self, input_cols, output_cols=None, drop_input_cols=False, norm="l2"):
        super().__init__(input_cols, output_cols, drop_input_cols)
        self.norm = norm

    def column(self, name):
        size = [F.abs(F.col(c).cast("double")) for c in self.input_cols]
        if self.norm == "max":
            length = F.greatest(*size) if len(size) > 1 else size[0]
        elif self.norm in ("l1", "l2"):
            total = F.lit(0.0)
            for s in size:
                total = total + (s * s if self.norm == "l2" else s)
            length = F.sqrt(total) if self.norm == "l2" else total
        else:
            raise ValueError(f"unknown norm: {self.norm}")
        return F.col(name).cast("double") / F.when(length == 0, F.lit(1.0)).otherwise(length)


class Binarizer(Transformer):
    def __init__(self, input_cols, output_cols=None, drop_input_cols=False, threshold=0.0):
        super().__init__(input_cols, output_cols, drop_input_cols)
        self.threshold = threshold

    def column(self, name):
        return (F.col(name) > F.lit(self.threshold)).cast("int").cast("double")


def _width(low: float | None, high: float | None) -> float | None:
    return None if low is None or high is None else high - low


def categories_of(df: DataFrame, columns: Sequence[str], limit: int) -> dict[str, list]:
    """Sorted distinct values per column; raises if a column has more than ``limit``.

    Columns of one type share a pass over the data. Values are made distinct before they leave
    their tasks.
    """
    found: dict[str, list] = {c: [] for c in columns}
    by_type: dict[str, list[str]] = {}
    for c in columns:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    for names in by_type.values():
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in names]))
        values = df.select(cells.alias("c")).select("c.*").where(F.col("value").isNotNull()).distinct()
        for row in values.limit(limit * len(names) + 1).collect():
            found[row["name"]].append(row["value"])
    for name, values in found.items():
        if len(values) > limit:
            raise ValueError(f"{name} has more than {limit} categories")
    return {name: sorted(values) for name, values in found.items()}


class OrdinalEncoder(Transformer):
    """Category to its position in a stated (or sorted) order; ``unknown`` is ``error`` or ``null``."""

    def __init__(self, input_cols, output_cols=None, drop_input_cols=False, categories=None, unknown="error"):
        super().__init__(input_cols, output_cols, drop_input_cols)
        self.categories = dict(categories or {})
        self.unknown = unknown

    def fit(self, df):
        missing = [c for c in self.input_cols if c not in self.categories]
        self.categories.update(categories_of(df, missing, MAX_CATEGORIES))
        return self

    def transform(self, df):
        out = df
        for name, target in zip(self.input_cols, self.output_cols):
            value = df.schema[name].dataType
            rows = [(v, float(i)) for i, v in enumerate(self.categories[name])]
            ids = df.sparkSession.createDataFrame(rows, f"_label {value.simpleString()}, _index double")
            joined = out.join(ids, out[name] == F.col("_label"), "left").drop("_label")
            index = F.col("_index")
            if self.unknown == "error":
                problem = F.raise_error(F.concat(F.lit(f"unknown category in {name}: "), F.col(name).cast("string")))
                index = F.when(F.col(name).isNull() | index.isNotNull(), index).otherwise(problem.cast("double"))
            out = joined.withColumn(target, index).drop("_index")
        return self._finish(out)


class LabelEncoder(Transformer):
    """Sorted labels to 0..n-1 by a join with the label table, so any number of labels will do.

    ``fit`` writes the tables, so the numbers stay as they are whatever happens to the rows they came from.
    """

    def fit(self, df):
        self.tables = {}
        for c in self.input_cols:
            ids = dense_ids(df.where(F.col(c).isNotNull()), c, "_id")
            path = scratch_dir(df.sparkSession, "labels")
            ids.write.parquet(path)
            self.tables[c] = df.sparkSession.read.schema(ids.schema).parquet(path)
        return self

    def transform(self, df):
        out = df
        for name, target in zip(self.input_cols, self.output_cols):
            ids = self.tables[name].withColumnRenamed(name, "_label")
            joined = out.join(ids, out[name] == F.col("_label"), "left").drop("_label")
            out = joined.withColumn(target, F.col("_id")).drop("_id")
        return self._finish(out)


class OneHotEncoder(Transformer):
    """One 0/1 column per category seen in ``fit``, named ``<output>_<category>``; unseen ones give all 0."""

    def __init__(self, input_cols, output_cols=None, drop_input_cols=False, categories=None):
        super().__init__(input_cols, output_cols, drop_input_cols)
        self.categories = dict(categories or {})

    def fit(self, df):
        missing = [c for c in self.input_cols if c not in self.categories]
        self.categories.update(categories_of(df, missing, MAX_ONE_HOT))
        return self

    def names(self) -> list[str]:
        return [f"{out}_{v}" for name, out in zip(self.input_cols, self.output_cols) for v in self.categories[name]]

    def transform(self, df):
        made = {
            f"{out}_{v}": F.coalesce((F.col(name) == F.lit(v)).cast("int"), F.lit(0)).cast("double")
            for name, out in zip(self.input_cols, self.output_cols) for v in self.categories[name]
        }
        out = df.withColumns(made)
        return out.drop(*self.input_cols) if self.drop_input_cols else out


class KBinsDiscretizer(Transformer):
    """Bin number by equal width (``uniform``) or equal frequency (``quantile``)."""

    def __init__(self, input_cols, output_cols=None, drop_input_cols=False, n_bins=5, strategy="quantile"):
        super().__init__(input_cols, output_cols, drop_input_cols)
        self.n_bins, self.strategy = n_bins, strategy

    def fit(self, df):
        inner = [i / self.n_bins for i in range(1, self.n_bins)]
        if self.strategy == "uniform":
            stats = self._stats(df, low=F.min, high=F.max)
            self.edges = {
                c: [] if s["low"] is None else [s["low"] + (s["high"] - s["low"]) * p for p in inner] for c, s in stats.items()}
        elif self.strategy == "quantile":
            wanted = {f"q{i}|{c}": (c, p) for c in self.input_cols for i, p in enumerate(inner)}
            row = exact_quantiles(df, wanted).first()
            found = {c: {row[f"q{i}|{c}"] for i in range(len(inner))} - {None} for c in self.input_cols}
            self.edges = {c: sorted(edges) for c, edges in found.items()}
        else:
            raise ValueError(f"unknown strategy: {self.strategy}")
        return self

    def column(self, name):
        number = F.lit(0)
        for edge in self.edges[name]:
            number = number + (F.col(name) >= F.lit(edge)).cast("int")
        return F.when(F.col(name).isNotNull(), number.cast("double"))


class PolynomialFeatures(Transformer):
    """All products of the inputs up to a degree, named by their factors (``a b`` for a*b, ``a^2``)."""

    def __init__(self, input_cols, degree=2, include_bias=True, interaction_only=False, drop_input_cols=False):
        super().__init__(input_cols, None, drop_input_cols)
        self.degree, self.include_bias, self.interaction_only = degree, include_bias, interaction_only

    def terms(self) -> dict[str, list[str]]:
        found = {"1": []} if self.include_bias else {}
        for d in range(1, self.degree + 1):
            for combo in combinations_with_replacement(self.input_cols, d):
                powers = {c: combo.count(c) for c in dict.fromkeys(combo)}
                if self.interaction_only and max(powers.values()) > 1:
                    continue
                found[" ".join(c if n == 1 else f"{c}^{n}" for c, n in powers.items())] = list(combo)
        return found

    def transform(self, df):
        made = {}
        for name, factors in self.terms().items():
            product = F.lit(1.0)
            for c in factors:
                product = product * F.col(c).cast("double")
            if name not in self.input_cols:
                made[name] = product
        out = df.withColumns(made)
        return out.drop(*self.input_cols) if self.drop_input_cols else out


class UpperCase(Transformer):
    """Example of a user-defined transformer: only ``column`` (and, if needed, ``fit``) is written."""

    def column(self, name):
        return F.upper(F.col(name))
