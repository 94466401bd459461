"""Python functions in the engine, and named driver routines.

A column expression is always the first choice. Where Python is needed, ``pandas_udf`` gets Arrow
batches; row UDFs run with Arrow transfer; table functions turn a row into several.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Types are objects, not text: text needs a running session to parse, and this module loads without one.
FACTS = T.StructType().add("num", "double").add("name", "string").add("value", "double")
TOTALS = T.StructType().add("key", "string").add("n", "long").add("total", "double")


def row_udf(function: Callable, returns: T.DataType | str):
    """Row-at-a-time UDF with Arrow transfer."""
    return F.udf(function, returns, useArrow=True)


def register(spark: SparkSession, name: str, function):
    """Make a UDF callable by name in SQL text, for this session."""
    return spark.udf.register(name, function)


def register_expression(spark: SparkSession, name: str, parameters: str, returns: str, body: str,
                        temporary: bool = True) -> None:
    """SQL function from an expression: inlined by the optimizer, so it costs nothing."""
    spark.sql(f"CREATE OR REPLACE {'TEMPORARY ' if temporary else ''}FUNCTION {name}({parameters}) RETURNS {returns} RETURN {body}")


@F.pandas_udf(T.DoubleType())
def margin_of_series(price: pd.Series, cost: pd.Series) -> pd.Series:
    return price - cost


@F.pandas_udf(T.DoubleType())
def margin_of_frame(rows: pd.DataFrame) -> pd.Series:
    return rows.iloc[:, 0] - rows.iloc[:, 1]


def scored_with(load: Callable[[], Any], apply: Callable[[Any, pd.Series], pd.Series], returns: str):
    """Vectorised UDF that loads its model or lexicon once per task, not once per batch."""

    @F.pandas_udf(returns)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            yield apply(model, batch)

    return run


@F.udtf(returnType=FACTS)
class NumberFacts:
    """Table function: nine facts about each number; NULL where a function is not defined there."""

    def eval(self, num: float):
        def at(defined: bool, function):
            return function(num) if num is not None and math.isfinite(num) and defined else None

        positive = num is not None and num > 0
        yield num, "number", num
        yield num, "square_root", at(num is not None and num >= 0, math.sqrt)
        yield num, "square", at(True, lambda x: x * x)
        yield num, "cube", at(True, lambda x: x * x * x)
        yield num, "ln", at(positive, math.log)
        yield num, "log_10", at(positive, math.log10)
        yield num, "sine", at(True, math.sin)
        yield num, "cosine", at(True, math.cos)
        yield num, "tangent", at(True, math.tan)


@F.udtf(returnType=TOTALS)
class PartitionTotals:
    """Table function with state per partition, emitted when the partition ends."""

    def __init__(self):
        self.key, self.n, self.total = None, 0, 0.0

    def eval(self, row):
        self.key = row["key"]
        self.n += 1
        self.total += row["value"]

    def terminate(self):
        if self.n:
            yield self.key, self.n, self.total


class Procedures:
    """Routines that run on the driver against a session, callable by object or by name."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._named: dict[str, Callable] = {}

    def add(self, function: Callable | None = None, name: str | None = None):
        """Register ``function(spark, ...)``; also a decorator."""
        if function is None:
            return lambda f: self.add(f, name)
        self._named[name or function.__name__] = function
        return function

    def call(self, name: str, *args) -> Any | DataFrame:
        return self._named[name](self.spark, *args)
