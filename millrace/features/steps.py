"""Ordered steps over frames: fit once, transform train and test alike."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml import Transformer as MlTransformer
from pyspark.sql import DataFrame


class Pipeline:
    """Named steps; MLlib estimators and transformers may be mixed in, usually at the end."""

    def __init__(self, steps):
        self.steps = list(steps)
        self.fitted = None

    def fit(self, df: DataFrame) -> Pipeline:
        self.fitted = []
        for i, (name, step) in enumerate(self.steps):
            if isinstance(step, (MlTransformer, Model)):
                done = step
            else:
                done = step.fit(df)
            self.fitted.append((name, done))
            if i < len(self.steps) - 1:
                df = done.transform(df)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.fitted is None:
            raise ValueError("fit the pipeline first")
        for _, step in self.fitted:
            df = step.transform(df)
        return df

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def __getitem__(self, name: str):
        return dict(self.fitted or self.steps)[name]


class ColumnTransformer:
    """Independent steps on their own columns, all fitted on the same input."""

    def __init__(self, steps):
        # (name, transformer class or instance, columns)
        self.steps = [(name, step(cols) if isinstance(step, type) else step, cols) for name, step, cols in steps]

    def fit(self, df: DataFrame) -> ColumnTransformer:
        for _, step, _ in self.steps:
            step.fit(df)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        for _, step, _ in self.steps:
            df = step.transform(df)
        return df

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


