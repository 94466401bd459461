"""Tree ensembles as data: one table of nodes, walked by column expressions or called from SQL."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_dir

LOGISTIC = {"none": "{}", "half": "1 / (1 + exp(-2 * ({})))", "logistic": "1 / (1 + exp(-({})))"}


@dataclass(frozen=True)
class TreeTable:
    """Nodes of all trees, children of a node side by side. A row goes to the right child if its value is above the threshold.

    ``left`` is 0 for a leaf. The result is ``base`` plus the sum of the leaf values, through the link.
    """

    inputs: tuple[str, ...]
    feature: tuple[int, ...]
    threshold: tuple[float, ...]
    left: tuple[int, ...]
    value: tuple[float, ...]
    roots: tuple[int, ...]
    depth: int
    base: float = 0.0
    link: str = "none"

    def expression(self, names: Sequence[str]) -> str:
        """SQL text of the result for inputs of these names: an array-coded walk, of a size that does not grow with the calls."""
        doubles = lambda xs: "array(" + ", ".join(f"{float(x)!r}D" for x in xs) + ")"
        whole = lambda xs: "array(" + ", ".join(map(str, xs)) + ")"
        values = "array(" + ", ".join(f"CAST({n} AS DOUBLE)" for n in names) + ")"
        step = (
            f"if({whole(self.left)}[at] = 0, at, {whole(self.left)}[at] + "
            f"if(x[{whole(self.feature)}[at]] > {doubles(self.threshold)}[at], 1, 0))")
        walk = f"aggregate(sequence(1, {max(self.depth, 1)}), root, (at, level) -> {step})"
        # The inputs are bound once, as the only element of an array, so that a walk does not build them at each step.
        total = f"transform(array({values}), x -> aggregate({whole(self.roots)}, {self.base!r}D, (total, root) -> total + {doubles(self.value)}[{walk}]))[0]"
        missing = " OR ".join(f"isnull({n}) OR isnan(CAST({n} AS DOUBLE))" for n in names)
        return f"CASE WHEN {missing} THEN NULL ELSE {LOGISTIC[self.link].format(total)} END"

    def column(self) -> Column:
        """The result for a frame that has the inputs as columns; NULL where one is missing."""
        return F.expr(self.expression([f"`{n}`" for n in self.inputs]))


def tree_table(spark: SparkSession, model, inputs: Sequence[str]) -> TreeTable:
    """Nodes of a fitted MLlib forest (two classes or regression) or boosted model, read from its stored form.

    The result is the probability of class 1, or the prediction of a regression.
    """
    forest = isinstance(model, RandomForestClassificationModel)
    if forest and model.numClasses != 2:
        raise ValueError("only forests of two classes")
    if not forest and not isinstance(model, (GBTClassificationModel, GBTRegressionModel, RandomForestRegressionModel)):
        raise TypeError(f"no tree ensemble: {type(model).__name__}")
    path = scratch_dir(spark, "trees")
    model.write().save(path)
    node = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    rows = node.select("treeID", "id", "prediction", "impurityStats", "leftChild", "rightChild", "split.*").collect()  # as large as the model
    weights = [1.0 / len(model.trees)] * len(model.trees) if isinstance(model, RandomForestRegressionModel) or forest else list(model.treeWeights)
    trees: dict[int, dict] = {}
    for r in rows:
        trees.setdefault(r["treeID"], {})[r["id"]] = r
    feature, threshold, left, value, roots, deepest = [], [], [], [], [], 0

    def put(at: int, tree: dict, r, weight: float, depth: int) -> None:
        nonlocal deepest
        deepest = max(deepest, depth)
        if r["leftChild"] < 0:
            own = r["impurityStats"][1] / max(sum(r["impurityStats"]), 1e-300) if forest else r["prediction"]
            value[at] = weight * own
            return
        if r["numCategories"] != -1:
            raise ValueError("only numeric splits")
        feature[at], threshold[at], left[at] = r["featureIndex"], r["leftCategoriesOrThreshold"][0], len(left)
        for kind in (feature, threshold, left, value):
            kind += [0, 0]
        put(left[at], tree, tree[r["leftChild"]], weight, depth + 1)
        put(left[at] + 1, tree, tree[r["rightChild"]], weight, depth + 1)

    for number in sorted(trees):
        roots.append(len(left))
        for kind in (feature, threshold, left, value):
            kind.append(0)
        put(roots[-1], trees[number], trees[number][0], weights[number], 0)
    return TreeTable(
        tuple(inputs), tuple(feature), tuple(threshold), tuple(left), tuple(value), tuple(roots), deepest,
        link="half" if isinstance(model, GBTClassificationModel) else "none")


def register_sql_trees(spark: SparkSession, name: str, table: TreeTable) -> None:
    """Make an ensemble callable in SQL: ``name(input, ...)`` in the order of its inputs; a missing input gives NULL."""
    names = [f"p{i}" for i in range(len(table.inputs))]
    parameters = ", ".join(f"{n} DOUBLE" for n in names)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS DOUBLE RETURN {table.expression(names)}")


def predict(df: DataFrame, table: TreeTable, output: str = "prediction") -> DataFrame:
    return df.withColumn(output, table.column())
