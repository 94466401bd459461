"""Samples and splits depend on keys only."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import sampling
from millrace.operators.sampling import sample_files, sample_fraction, sample_n, split_random, with_split


def _ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_same_rows_under_any_layout(spark):
    df = spark.range(5000)
    wanted = _ids(sample_fraction(df, 0.2, ["id"], seed=400))
    assert 850 < len(wanted) < 1150
    assert _ids(sample_fraction(df.repartition(13), 0.2, ["id"], seed=400)) == wanted
    assert _ids(sample_fraction(df, 0.2, ["id"], seed=401)) != wanted


@pytest.mark.parametrize("n", [0, 1, 37, 1999, 2000, 5000])
def test_exactly_n(spark, n):
    df = spark.range(2000)
    found = _ids(sample_n(df, n, ["id"], seed=1))
    assert len(found) == len(set(found)) == min(n, 2000)
    assert _ids(sample_n(df.repartition(7), n, ["id"], seed=1)) == found


@pytest.mark.parametrize("top_rows", [0, sampling.TOP_ROWS])
def test_exactly_n_when_hashes_collide(spark, monkeypatch, top_rows):
    monkeypatch.setattr(sampling, "TOP_ROWS", top_rows)
    df = spark.range(300).select("id", F.lit("same").alias("k"))
    assert sample_n(df, 100, ["k"], seed=1).count() == 100


@pytest.mark.parametrize("n", [1, 37, 1999, 5000])
def test_top_k_and_cut_off_give_the_same_rows(spark, monkeypatch, n):
    df = spark.range(2000)
    by_top = _ids(sample_n(df, n, ["id"], seed=1))
    monkeypatch.setattr(sampling, "TOP_ROWS", 0)
    assert _ids(sample_n(df, n, ["id"], seed=1)) == by_top


def test_a_small_sample_is_one_scan(spark, tmp_path):
    spark.range(2000).write.parquet(str(tmp_path / "t"))
    chosen = sample_n(spark.read.parquet(str(tmp_path / "t")), 20, ["id"])
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and plan.count("FileScan") == 1


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(weights=st.lists(st.integers(1, 9), min_size=1, max_size=4), seed=st.integers(0, 1000))
def test_split_is_disjoint_and_complete(spark, weights, seed):
    df = spark.range(400)
    parts = [_ids(p) for p in split_random(df, weights, ["id"], seed)]
    assert sorted(i for p in parts for i in p) == list(range(400))


def test_split_shares(spark):
    counts = {r["_part"]: r["count"] for r in with_split(spark.range(20000), [0.8, 0.2], ["id"], 42).groupBy("_part").count().collect()}
    assert abs(counts[0] / 20000 - 0.8) < 0.02


def _scans(plan):
    """The file scans below a node of an executed plan."""
    if plan.nodeName().startswith("Scan"):
        return [plan]
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        return _scans(plan.executedPlan())
    children = plan.children()
    return [s for i in range(children.size()) for s in _scans(children.apply(i))]


def test_files_not_drawn_are_not_opened(spark, tmp_path):
    path = str(tmp_path / "blocks")
    spark.range(6000).repartition(60).write.parquet(path)
    lines = spark.read.parquet(path)
    by_file = {r["f"]: r["n"] for r in lines.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count("*").alias("n")).collect()}
    drawn = sample_files(lines, 0.25, seed=3)
    kept = {r["f"]: r["n"] for r in drawn.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count("*").alias("n")).collect()}
    assert 3 < len(kept) < 30 and all(by_file[f] == n for f, n in kept.items())
    rows = drawn.select("id")
    assert len(rows.collect()) == sum(kept.values())
    (scan,) = _scans(rows._jdf.queryExecution().executedPlan())
    assert scan.metrics().apply("numFiles").value() == len(kept)
    assert sample_files(lines, 1.0, seed=3).count() == 6000 and sample_files(lines, 0.0, seed=3).count() == 0
    with pytest.raises(ValueError):
        sample_files(lines, 1.5, seed=3)
