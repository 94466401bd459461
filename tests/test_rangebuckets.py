"""Numbering, running sums and exact quantiles against plain Python, for any number of buckets."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.models.metrics import auc
from millrace.operators import rangebuckets as rb


def _skewed(seed, n=3000):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        group = "hot" if i % 3 else rnd.choice(["a", "b", None])
        value = 42.0 if rnd.random() < 0.34 else rnd.choice([rnd.gauss(0, 100), float(rnd.randrange(5)), None])
        rows.append((group, value))
    return rows


@pytest.mark.parametrize("buckets", [1, 2, 16])
def test_exact_quantiles(spark, buckets):
    rows = _skewed(1)
    df = spark.createDataFrame(rows, "g string, v double").withColumn("w", F.col("v") * 2 + 1)
    wanted = {"low": ("v", 0.0), "q1": ("v", 0.25), "mid": ("v", 0.5), "high": ("v", 1.0), "w99": ("w", 0.99)}
    found = {r["g"]: r for r in rb.exact_quantiles(df, wanted, by=["g"], buckets=buckets).collect()}
    for group in {g for g, _ in rows}:
        values = np.array([v for g, v in rows if g == group and v is not None])
        for name, (column, p) in wanted.items():
            data = values if column == "v" else values * 2 + 1
            assert found[group][name] == pytest.approx(np.quantile(data, p), abs=1e-9), (group, name)


def test_quantiles_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(rb.broadcast_if_small, "__defaults__", (0,))
    rows = _skewed(2)
    df = spark.createDataFrame(rows, "g string, v double")
    found = {r["g"]: r["m"] for r in rb.exact_quantiles(df, {"m": ("v", 0.5)}, by=["g"], buckets=4).collect()}
    for group in {g for g, _ in rows}:
        assert found[group] == pytest.approx(np.median([v for g, v in rows if g == group and v is not None]))


@pytest.mark.parametrize("buckets", [1, 9])
def test_running_sums(spark, buckets):
    rnd = random.Random(4)
    rows = [(g, float(i), rnd.randrange(10)) for g in ("a", None) for i in rnd.sample(range(500), 200)]
    df = spark.createDataFrame(rows, "g string, v double, w long")
    found = {(r["g"], r["v"]): r["upto"] for r in rb.running_sums(df, "v", {"upto": "w"}, by=["g"], buckets=buckets).collect()}
    assert len(found) == len(rows)
    for g, v, _ in rows:
        assert found[g, v] == sum(w for h, u, w in rows if h == g and u <= v)


@pytest.mark.parametrize("buckets", [1, 5, 40])
def test_dense_ids(spark, buckets):
    labels = [f"label {i % 97:03d}é" for i in range(1000)] + ["zz"] * 500
    found = rb.dense_ids(spark.createDataFrame([(x,) for x in labels], "x string"), "x", "id", start=1, buckets=buckets).collect()
    assert {r["x"]: r["id"] for r in found} == {x: i + 1 for i, x in enumerate(sorted(set(labels), key=lambda s: s.encode()))}


@pytest.mark.parametrize("buckets", [1, 6])
def test_null_label_comes_last(spark, buckets):
    rows = [(x,) for x in (5.5, None, -1.0, float("nan"), 2.0, None, 5.5, *map(float, range(10, 40)))]
    found = rb.dense_ids(spark.createDataFrame(rows, "x double"), "x", "id", buckets=buckets).orderBy("id").collect()
    labels = [str(r["x"]) for r in found]
    assert labels[:4] == ["-1.0", "2.0", "5.5", "10.0"] and labels[-2:] == ["nan", "None"]
    assert [r["id"] for r in found] == list(range(len(found)))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "bigint", "decimal(12,3)", "string"])
def test_buckets_never_decrease(spark, kind):
    rnd = random.Random(5)
    start = datetime(2024, 3, 1)
    text = [str(rnd.randrange(-5000, 5000)) if kind in ("bigint", "decimal(12,3)", "string")
            else str(start + timedelta(seconds=rnd.randrange(40 * 86400))) for _ in range(500)]
    cast = F.to_date(F.substring("x", 1, 10)) if kind == "date" else F.col("x").cast(kind)
    df = spark.createDataFrame([(x,) for x in text], "x string").select(cast.alias("v"))
    points = rb.split_points(df, "v", 8)
    buckets = [r["_bucket"] for r in rb.with_bucket(df, "v", points).orderBy("v").collect()]
    assert buckets == sorted(buckets)
    assert len(set(buckets)) > 3


@pytest.mark.parametrize("kind", ["double", "string"])
def test_no_bucket_holds_a_large_share(spark, kind):
    """A long tail and labels that pile up at one end are cut as well: no bucket of 16 ranges has 4 % of the values."""
    long_tail = F.exp(F.randn(seed=3) * 3)
    value = long_tail if kind == "double" else F.concat(F.lit("key-"), F.md5(F.col("id").cast("string")))
    df = spark.range(20_000).select(value.alias("v"))
    sizes = [r["count"] for r in rb.with_bucket(df, "v", rb.split_points(df, "v", 16)).groupBy("_bucket").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 800


def test_not_a_number_is_no_boundary(spark):
    df = spark.createDataFrame([(float(x),) for x in range(300)] + [(float("nan"),), (float("inf"),), (float("-inf"),), (None,)] * 40, "v double")
    points = rb.split_points(df, "v", 4)
    assert points and all(abs(p) < 300 for p in points)
    assert rb.dense_ids(df, "v", "id", buckets=4).where("id = 0").first()["v"] == float("-inf")


def test_auc_with_ties(spark):
    rnd = random.Random(6)
    rows = [(rnd.randrange(2), float(rnd.randrange(20))) for _ in range(400)]
    pos, neg = [s for a, s in rows if a], [s for a, s in rows if not a]
    expected = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "a int, s double")
    assert auc(df, "a", "s").first()["auc"] == pytest.approx(expected)


def test_no_window_over_everything(spark):
    """Raw labels never meet in one task: only bucket totals go through a single partition."""
    df = spark.range(1000).select((F.col("id") * 7 % 500).alias("x"))
    plan = rb.dense_ids(df, "x", "id", buckets=4)._jdf.queryExecution().executedPlan().toString().splitlines()
    for number, line in enumerate(plan):
        if "SinglePartition" in line:
            assert "HashAggregate(keys=[_bucket" in plan[number + 1], line
    assert any("hashpartitioning(_bucket" in line for line in plan)


def test_columns_of_mixed_types(spark):
    """Whole numbers beyond 2^53, wide decimals and doubles side by side, each ranked as it is."""
    from decimal import Decimal

    longs = [2**53 + 1, 2**53 + 1, 2**53 + 3]
    fine = [Decimal("0.000000000000000000000000000001"), Decimal("1.5"), Decimal("99999999.000000000000000000000000000003")]
    rows = [(a, 10 ** 37 + b, c, float(b)) for a, b, c in zip(longs, (1, 2, 3), fine)]
    df = spark.createDataFrame([(a, Decimal(b), c, d) for a, b, c, d in rows], "a long, b decimal(38,0), c decimal(38,30), d double")
    found = rb.exact_quantiles(df, {x: (x, 0.5) for x in "abcd"}, decimals=True).first()
    assert (found["a"], found["b"], found["c"], found["d"]) == (2**53 + 1, 10**37 + 2, Decimal("1.5"), 2.0)
    assert rb.exact_quantiles(df, {"a": ("a", 0.5), "d": ("d", 1.0)}).first()["a"] == float(2**53 + 1)


@pytest.mark.parametrize("buckets", [None, 1, 7])
def test_quantiles_of_large_groups(spark, monkeypatch, buckets):
    """Groups beyond the limit of whole counting: brackets hold every rank, with ties, tails and infinite values."""
    monkeypatch.setattr(rb, "ACCURACY", 50)
    rng = np.random.default_rng(3)
    a = np.concatenate([rng.lognormal(0, 3, 3000), np.full(2500, 7.0), [np.inf, -np.inf], rng.integers(0, 5, 900)])
    rows = [("x", float(v), int(i % 37)) for i, v in enumerate(a)] + [("y", float(i % 11), i) for i in range(400)] + [(None, 1.0, 1), ("z", None, None)]
    df = spark.createDataFrame(rows, "g string, v double, k long").repartition(6)
    wanted = {f"q{i}": (c, p) for i, (c, p) in enumerate([("v", 0.0), ("v", 0.001), ("v", 0.37), ("v", 0.5), ("v", 0.99), ("k", 0.5), ("k", 1.0), ("k", 0.013)])}
    found = {r["g"]: r for r in rb.exact_quantiles(df, wanted, by=["g"], buckets=buckets).collect()}
    assert set(found) == {"x", "y", None}
    for g in found:
        for name, (c, p) in wanted.items():
            data = np.sort([(v if c == "v" else k) for h, v, k in rows if h == g])
            at = p * (len(data) - 1)
            low, high = data[int(np.floor(at))], data[int(np.ceil(at))]
            want = low if low == high else low + (high - low) * (at - np.floor(at))
            assert found[g][name] == pytest.approx(want, rel=1e-12), (g, name)


def test_quantiles_in_two_scans(spark, tmp_path):
    """The plan reads the rows once more after the summaries, and joins by broadcast."""
    path = str(tmp_path / "rows")
    spark.range(50_000).selectExpr("id % 3 AS g", "cast(id * 7919 % 50021 AS double) AS v", "id AS w").write.parquet(path)
    made = rb.exact_quantiles(spark.read.parquet(path), {"m": ("v", 0.5), "q": ("w", 0.9)}, by=["g"])
    rows = {r["g"]: r["m"] for r in made.collect()}
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(rows) == 3 and plan.count("FileScan") - plan.count("ReusedExchange") <= 1
