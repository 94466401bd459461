"""Transformers, pipelines, feature views, versions, sentiment."""

import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.features import transformers as tr
from millrace.features.steps import ColumnTransformer, Pipeline
from millrace.features.views import Entity, FeatureStore, FeatureView
from millrace.functions.text import lexicon_frame, sentiment_scores
from millrace.models import metrics
from millrace.operators.joins import grid_product
from millrace.sources.versions import VersionedTable, delete_where, update_where, upsert
from millrace.sources.writers import client_rows


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame([(1, 0.0, 5.0, "b"), (2, 10.0, 5.0, "a"), (3, 4.0, 5.0, None), (4, None, 5.0, "b")],
                                 "id int, x double, c double, s string")


def _column(df, name):
    return [r[name] for r in df.orderBy("id").collect()]


def test_scalers_and_constant_columns(numbers):
    scaled = tr.MinMaxScaler(["x", "c"], ["sx", "sc"]).fit_transform(numbers)
    assert _column(scaled, "sx") == [0.0, 1.0, 0.4, None]
    assert _column(scaled, "sc") == [0.0] * 4
    assert _column(tr.StandardScaler(["c"], ["z"]).fit_transform(numbers), "z") == [0.0] * 4
    assert _column(tr.RobustScaler(["c"], ["z"]).fit_transform(numbers), "z") == [0.0] * 4


def test_columns_without_values(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, x double")
    for step in (tr.MinMaxScaler(["x"], ["y"], clip=True), tr.StandardScaler(["x"], ["y"]), tr.RobustScaler(["x"], ["y"]),
                 tr.KBinsDiscretizer(["x"], ["y"]), tr.KBinsDiscretizer(["x"], ["y"], strategy="uniform")):
        assert _column(step.fit_transform(df), "y") == [None, None]


def test_clip_keeps_null_and_range(numbers):
    scaler = tr.MinMaxScaler(["x"], ["y"], clip=True).fit(numbers.where("id in (1, 3)"))
    assert _column(scaler.transform(numbers), "y") == [0.0, 1.0, 1.0, None]


def test_unknown_categories(numbers):
    known = numbers.where("s = 'a'")
    encoder = tr.OrdinalEncoder(["s"], ["code"], unknown="null").fit(known)
    assert _column(encoder.transform(numbers), "code") == [None, 0.0, None, None]
    with pytest.raises(Exception, match="unknown category"):
        tr.OrdinalEncoder(["s"], ["code"]).fit(known).transform(numbers).collect()
    hot = tr.OneHotEncoder(["s"], ["s"]).fit(known).transform(numbers)
    assert _column(hot, "s_a") == [0.0, 1.0, 0.0, 0.0]


def test_too_many_categories(spark, monkeypatch):
    monkeypatch.setattr(tr, "MAX_ONE_HOT", 10)
    with pytest.raises(ValueError, match="more than 10"):
        tr.OneHotEncoder(["id"]).fit(spark.range(50))


def test_normalizer_keeps_zero_rows(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 3.0, -4.0)], "id int, a double, b double")
    assert _column(tr.Normalizer(["a", "b"], norm="l2").transform(df), "b") == [0.0, -0.8]
    assert _column(tr.Normalizer(["a", "b"], norm="l1").transform(df), "a") == [0.0, 3 / 7]
    assert _column(tr.Normalizer(["a", "b"], norm="max").transform(df), "b") == [0.0, -1.0]


def test_pipeline_reuses_what_it_fitted(numbers):
    steps = Pipeline([("both", ColumnTransformer([("num", tr.MinMaxScaler, ["x"]), ("cat", tr.OneHotEncoder(["s"]), None)]))])
    out = steps.fit(numbers.where("id <= 2")).transform(numbers.where("id > 2"))
    assert _column(out, "x") == [0.4, None]
    assert _column(out, "s_b") == [0.0, 1.0]
    with pytest.raises(ValueError):
        Pipeline([]).transform(numbers)


def test_label_encoder_with_null(numbers):
    assert _column(tr.LabelEncoder(["s"], ["n"]).fit_transform(numbers), "n") == [1, 0, None, 1]


def test_feature_store(spark, tmp_path):
    frame = spark.createDataFrame([("a", "2024-01-01", 1.0, 2.0)], "k string, d string, f double, g double").withColumn("d", F.to_date("d"))
    view = FeatureView("v", Entity("e", ("k",)), frame, "d").describe_features({"f": "first"})
    store = FeatureStore(spark, str(tmp_path))
    store.get_or_register(view, "V_1")
    with pytest.raises(AnalysisException):
        store.register(view, "V_1")
    again = store.get_or_register(view, "V_1")
    assert (again.features, again.feature_descriptions, again.timestamp_col) == (["f", "g"], {"f": "first"}, "d")
    assert again.slice(["g"]).frame.columns == ["k", "d", "g"]
    assert [r["name"] for r in store.list_views().collect()] == ["v"]
    with pytest.raises(KeyError):
        store.get("absent")


def test_versions(spark, tmp_path):
    rows = VersionedTable(spark, str(tmp_path), "t")
    rows.write_next(spark.range(3).withColumn("v", F.lit("old")))
    rows.upsert(spark.range(2, 5).withColumn("v", F.lit("new")), ["id"])
    assert {r["id"]: r["v"] for r in rows.read().collect()} == {0: "old", 1: "old", 2: "new", 3: "new", 4: "new"}
    for _ in range(9):
        rows.delete(F.col("id") == 0)
    assert rows.latest() == "v11" and rows.read().count() == 4
    assert rows.read("v1").count() == 3
    with pytest.raises(AnalysisException):
        rows.snapshot(spark.range(1), "v1")


def test_change_conditions_with_null(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, v int")
    assert delete_where(df, F.col("v") > 3).count() == 1
    assert sorted(str(r["v"]) for r in update_where(df, F.col("v") > 3, {"v": F.lit(0)}).collect()) == ["0", "None"]
    assert upsert(df, df.limit(0), ["id"]).count() == 2


def test_sentiment(spark):
    docs = spark.createDataFrame([(1, "Crisp and FRESH!"), (2, "no, bad"), (3, ""), (4, None), (5, "plain words")], "id int, t string")
    found = {r["id"]: r for r in sentiment_scores(docs, ["id"], "t", lexicon_frame(spark)).collect()}
    s = 0.8 + 1.3
    assert found[1]["compound"] == pytest.approx(s / math.sqrt(s * s + 15))
    assert found[1]["pos"] == pytest.approx(4.1 / 5.1)
    assert [found[i]["sentiment"] for i in range(1, 6)] == ["POSITIVE", "NEGATIVE", "NEUTRAL", "NEUTRAL", "NEUTRAL"]
    assert found[3]["neu"] == found[4]["neu"] == 0.0 and found[5]["neu"] == 1.0


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "a int, p int")
    row = metrics.classification(df, "a", "p").first()
    assert row["accuracy"] == 1.0 and row["precision"] == row["recall"] == row["f1"] == 0.0
    assert metrics.mape(spark.createDataFrame([(2.0, 1.0)], "y double, p double"), "y", "p").first()["mape"] == 0.5


def test_bounds_refuse_instead_of_cutting(spark):
    with pytest.raises(ValueError):
        client_rows(spark.range(11), limit=10)
    with pytest.raises(ValueError):
        grid_product(spark.range(3), spark.range(11).withColumnRenamed("id", "b"), limit=10)
    assert grid_product(spark.range(3), spark.range(0).withColumnRenamed("id", "b")).count() == 0


@pytest.mark.parametrize("all_lines", [True, False])
def test_customer_features_read_lines_once_and_keep_odd_rows_right(spark, tmp_path, all_lines):
    from millrace.plans.feature_jobs import customer_features, lines_and_returns, order_key

    lines = [(1, 7, 2.0, 20.0, "N"), (1, 7, 1.0, 12.0, "R"), (1, 8, 4.0, 8.0, "N"), (2, 7, 5.0, 50.0, "N"), (2, None, 1.0, 9.0, "R"),
             (3, 9, None, 10.0, "R"), (3, 9, 3.0, 30.0, "N"), (None, 7, 1.0, 1.0, "R"), (4, 5, 2.0, None, "R"), (4, 6, 2.0, 4.0, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_returnflag string").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    orders = [(1, 10, "1995-01-02"), (2, 10, "1996-03-04"), (3, None, "1995-05-06"), (4, 11, None), (5, 12, "1999-01-01")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate string").write.parquet(str(tmp_path / "orders.parquet"))

    found = customer_features(spark, str(tmp_path), all_lines)
    scans = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert sum("l_orderkey" in line for line in scans) == 1 and len(scans) == 2

    # Line by line, from lines joined to what came back.
    per_order, key = {}, order_key(all_lines)
    for r in lines_and_returns(spark, str(tmp_path)).where(f"{key} is not null").collect():
        sold, back = per_order.setdefault(r[key], ([], []))
        if r["price"] is not None:
            sold.append((r["l_quantity"] or 0.0) * r["price"])
            back.append((r["back_quantity"] or 0.0) * r["price"])
    per_customer = {}
    for order, customer, day in orders:
        if order in per_order:
            sold, back = per_order[order]
            years, ratios, days = per_customer.setdefault(customer or 0, ({}, [], []))
            day = day or "1970-01-01"
            years[day[:4]] = years.get(day[:4], 0) + 1
            days.append(day)
            if sold and sum(sold):
                ratios.append(sum(back) / sum(sold))
    expected = {c: (sum(y.values()) / len(y), sum(x) / len(x) if x else None, max(d)) for c, (y, x, d) in per_customer.items()}
    rows = {r["o_custkey"]: (r["frequency"], r["return_ratio"], str(r["latest_order_date"])) for r in found.collect()}
    assert rows.keys() == expected.keys()
    for customer, (frequency, share, day) in expected.items():
        assert rows[customer] == (frequency, pytest.approx(share), day)
