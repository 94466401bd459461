"""No row is lost, nothing is rounded early, and stored state is read again."""

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.features.views import Entity, FeatureStore, FeatureView
from millrace.functions.scalars import haversine, within_box
from millrace.models import fits
from millrace.models.registry import ModelStore, probabilities
from millrace.operators.rangebuckets import exact_quantiles
from millrace.session import scratch_dir
from millrace.sources.versions import upsert
from millrace.streaming.incremental import FeatureRefresh, change_stream


@pytest.fixture(scope="module")
def gaps(spark):
    """100 rows of which 10 miss an input."""
    return spark.range(100).select(
        "id", F.when(F.col("id") % 10 != 3, F.col("id").cast("double")).alias("a"), (F.col("id") % 7).cast("double").alias("b"),
        (F.col("id") > 50).cast("double").alias("target"))


@pytest.mark.parametrize("make", [
    lambda: fits.balanced_logistic(["a", "b"], "target"), lambda: fits.forest(["a", "b"], "target", trees=5),
    lambda: fits.boosted_classifier(["a", "b"], "target", rounds=3),
])
def test_scoring_keeps_rows(spark, gaps, make):
    scored = probabilities(make().fit(gaps).transform(gaps), ["id"]).collect()
    assert len(scored) == 100
    assert all((r.prediction is None) == (r.id % 10 == 3) == (r.probability_1 is None) for r in scored)


def test_regression_and_clusters_keep_rows(gaps):
    assert fits.score(fits.boosted_regressor(["a", "b"], "target", rounds=3).fit(gaps), gaps).where("prediction is null").count() == 10
    model = fits.kmeans(["a", "b"], 3, starts=3).fit(gaps)
    report = fits.cluster_report(model, fits.score(model, gaps, "cluster"), ["a", "b"]).collect()
    assert sum(r.n for r in report) == 100 and [r.n for r in report if r.cluster is None] == [10]


def test_the_cheapest_start_stays(gaps):
    found = fits.kmeans(["a", "b"], 5, starts=6, max_iter=3).fit(gaps).stages[-1]
    assert len(found.costs) == 6 and len(set(found.costs)) > 1 and found.cost == min(found.costs)
    scored = fits.assembler(["a", "b"]).transform(gaps.na.drop(subset=["a", "b"]))
    points = np.array([r.features.toArray() for r in scored.collect()])
    away = ((points[:, None] - found.centres[None]) ** 2).sum(axis=2)
    assert found.cost == pytest.approx(away.min(axis=1).sum())
    assert [r.cluster for r in found.transform(scored).collect()] == away.argmin(axis=1).tolist()


def test_clusters_under_any_partitioning(spark):
    """The same starts, the same cost, and one pass over the points per step for all of them."""
    points = spark.range(3000).select((F.rand(3) * 10 + (F.col("id") % 4) * 30).alias("a"), (F.randn(5) + (F.col("id") % 3) * 9).alias("b"))
    rows = spark.createDataFrame(points.collect(), points.schema)
    costs, steps, step = set(), [], fits.RestartedKMeans._step
    for n in (1, 3, 8):
        found = fits.kmeans(["a", "b"], 6, starts=4).fit(rows.repartition(n)).stages[-1]
        costs.add(round(found.cost, 6))
    assert len(costs) == 1

    def counted(points, centres):
        steps.append(len(centres))
        return step(points, centres)

    fits.RestartedKMeans._step = staticmethod(counted)
    try:
        fits.kmeans(["a", "b"], 6, starts=4).fit(rows)
    finally:
        fits.RestartedKMeans._step = staticmethod(step)
    assert steps[0] == 4 and steps == sorted(steps, reverse=True)
    with pytest.raises(ValueError, match="no points"):
        fits.kmeans(["a", "b"], 2).fit(rows.limit(0))
    few = fits.kmeans(["a", "b"], 5, starts=2).fit(spark.createDataFrame([(1.0, 2.0)] * 4, "a double, b double")).stages[-1]
    assert few.cost == 0.0 and len(few.centres) == 1


@pytest.mark.parametrize("lat, lon, radius", [(10.0, 179.9, 50_000), (-40.0, -179.95, 80_000), (89.8, 20.0, 60_000), (-89.9, 0.0, 90_000), (60.0, 0.0, 3_000_000), (0.0, 0.0, 25_000_000)])
def test_box_holds_the_circle(spark, lat, lon, radius):
    points = spark.range(20_000).select((F.rand(1) * 180 - 90).alias("lat"), (F.rand(2) * 360 - 180).alias("lon")).unionByName(
        spark.range(20_000).select(
            F.least(F.greatest(F.lit(lat) + F.randn(3), F.lit(-90.0)), F.lit(90.0)).alias("lat"),
            (F.pmod(F.lit(lon) + F.randn(4) + 180, F.lit(360.0)) - 180).alias("lon")))
    inside = points.where(haversine("lat", "lon", F.lit(lat), F.lit(lon)) <= radius)
    assert inside.count() > 0 and inside.where(~within_box("lat", "lon", lat, lon, radius)).count() == 0


def test_medians_beyond_doubles(spark):
    big = 2 ** 53
    rows = spark.createDataFrame([(big + 1,), (big + 1,), (big + 3,)], "v long")
    assert exact_quantiles(rows, {"m": ("v", 0.5)}, decimals=True).first()["m"] == big + 1
    wide = [Decimal("12345678901234567890.11"), Decimal("12345678901234567890.13"), Decimal("12345678901234567890.12")]
    found = exact_quantiles(spark.createDataFrame([(w,) for w in wide], "v decimal(30,2)"), {"m": ("v", 0.5), "q": ("v", 0.25)}, decimals=True).first()
    assert found["m"] == wide[2] and found["q"] == Decimal("12345678901234567890.115")


def _totals(rows):
    return rows.groupBy("k").agg(F.sum("v").alias("total"), F.count("*").alias("n"), F.max("v").alias("top"))


def _folder_of(spark, label, *parts):
    inbox = scratch_dir(spark, label)
    for values in parts:
        spark.createDataFrame(values, "k long, v long").coalesce(1).write.mode("append").parquet(inbox)
    return inbox


def test_refresh_goes_on_after_a_restart_with_another_width(spark):
    """State, not history: each run is a new query of a new object, under other shuffle widths, and reads its own rows."""
    root, inbox = scratch_dir(spark, "restart"), _folder_of(spark, "inbox", [(k, 1) for k in range(20)])
    width = spark.conf.get("spark.sql.shuffle.partitions")
    want = {k: (1, 1, 1) for k in range(20)}
    try:
        for step, partitions in enumerate([4, 16, 3, 8]):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            done = FeatureRefresh(spark, root, ["k"], _totals, compact_every=2).run(change_stream(spark, inbox, spark.read.parquet(inbox).schema))
            assert done.lastProgress.numInputRows == (20 if step == 0 else 2)
            assert sum(s.numRowsUpdated for s in done.lastProgress.stateOperators) == (20 if step == 0 else 1)
            found = {r["k"]: (r["total"], r["n"], r["top"]) for r in FeatureRefresh(spark, root, ["k"], _totals).current().collect()}
            assert found == want
            spark.createDataFrame([(step, 5), (step, 7)], "k long, v long").coalesce(1).write.mode("append").parquet(inbox)
            want[step] = (13, 3, 7)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


def test_refresh_reads_no_older_rows(spark):
    """The files of earlier batches can go: no later batch looks at them."""
    root, inbox = scratch_dir(spark, "forget"), _folder_of(spark, "inbox", [(1, 2), (2, 5)])
    old = spark.read.parquet(inbox)
    FeatureRefresh(spark, root, ["k"], _totals).run(change_stream(spark, inbox, old.schema))
    spark.createDataFrame([(1, 3)], old.schema).coalesce(1).write.mode("overwrite").parquet(inbox)
    refresh = FeatureRefresh(spark, root, ["k"], _totals)
    refresh.run(change_stream(spark, inbox, old.schema))
    assert sorted(map(tuple, refresh.current().collect())) == [(1, 5, 2, 3), (2, 5, 1, 5)]


def test_repeated_batch_and_compaction(spark):
    refresh = FeatureRefresh(spark, scratch_dir(spark, "again"), ["k"], _totals, compact_every=2).then(
        "large", lambda rows: rows.select("k", (F.col("total") > 3).alias("large")))
    for batch, rows in [(0, [(1, 2, 1, 2), (None, 9, 1, 9)]), (1, [(1, 5, 2, 3)]), (1, [(1, 5, 2, 3)]), (2, [(3, 1, 1, 1)])]:
        refresh.handle(spark.createDataFrame(rows, "k long, total long, n long, top long"), batch)
    assert sorted(map(tuple, refresh.current().collect()), key=str) == [(1, 5, 2, 3), (3, 1, 1, 1), (None, 9, 1, 9)]
    assert {r["k"]: r["large"] for r in refresh.current("large").collect()} == {1: True, 3: False, None: True}


def test_refresh_refuses_a_root_of_rows_and_late_history(spark):
    root = scratch_dir(spark, "old")
    spark.range(1).write.parquet(f"{root}/history/batch=0")
    with pytest.raises(ValueError, match="new root"):
        FeatureRefresh(spark, root, ["k"], _totals)
    root, inbox = scratch_dir(spark, "late"), _folder_of(spark, "inbox", [(1, 2)])
    rows = spark.read.parquet(inbox)
    FeatureRefresh(spark, root, ["k"], _totals).run(change_stream(spark, inbox, rows.schema))
    with pytest.raises(ValueError, match="first run"):
        FeatureRefresh(spark, root, ["k"], _totals, history=rows)


def test_refreshed_view_keeps_untouched_keys_and_versions_apart(spark):
    past = spark.createDataFrame([(k, 1) for k in (1, 2, 3) for _ in range(10)] + [(None, 4)], "k long, v long")
    store, inbox = FeatureStore(spark, scratch_dir(spark, "store")), _folder_of(spark, "inbox", [(1, 6)])
    view = FeatureView("v", Entity("k", ("k",)), _totals(past))
    store.register(view, "V_1")
    stream = lambda: change_stream(spark, inbox, past.schema)
    store.keep_fresh("v", stream(), _totals, history=past.where("k = 1"))
    rows = lambda frame: sorted(map(tuple, frame.collect()), key=str)
    others = [(2, 10, 10, 1), (3, 10, 10, 1), (None, 4, 1, 4)]
    assert rows(store.read("v")) == [(1, 16, 11, 6), *others]
    assert rows(store.read("v", "V_1")) == [(1, 10, 10, 1), *others]
    store.register(view, "V_2")
    assert rows(store.read("v")) == [(1, 10, 10, 1), *others]
    spark.createDataFrame([(None, 1), (7, 7)], past.schema).coalesce(1).write.mode("append").parquet(inbox)
    store.keep_fresh("v", stream(), _totals, history=past)
    assert rows(store.read("v")) == [(1, 16, 11, 6), (2, 10, 10, 1), (3, 10, 10, 1), (7, 7, 1, 7), (None, 5, 2, 4)]
    store.keep_fresh("v", stream(), _totals, version="V_1")
    with pytest.raises(ValueError, match="columns"):
        store.keep_fresh("v", stream(), lambda r: r.groupBy("k").count())


@pytest.mark.parametrize("every", [None, "200 milliseconds"])
def test_registered_view_refreshes_itself(spark, every):
    root, inbox = scratch_dir(spark, "store"), scratch_dir(spark, "inbox")
    rows = lambda *values: spark.createDataFrame(list(values), "k int, v int")
    totals = lambda found: found.groupBy("k").agg(F.sum("v").alias("total"))
    rows((1, 2), (2, 5)).write.parquet(inbox)
    FeatureStore(spark, root).register(FeatureView("totals", Entity("k", ("k",)), totals(spark.read.parquet(inbox)), refresh_every=every), "v1")
    store = FeatureStore(spark, root)
    assert store.get("totals").refresh_every == every

    def refresh():
        running = store.keep_fresh("totals", change_stream(spark, inbox, rows((0, 0)).schema), totals)
        if every:
            running.processAllAvailable()
            running.stop()
        return sorted(map(tuple, store.read("totals").collect()))

    assert sorted(map(tuple, store.read("totals").collect())) == [(1, 2), (2, 5)]
    assert refresh() == [(1, 2), (2, 5)]
    rows((1, 3)).write.mode("append").parquet(inbox)
    assert refresh() == [(1, 5), (2, 5)]
    assert sorted(map(tuple, store.read("totals", "v1").collect())) == [(1, 2), (2, 5)]


def test_half_written_versions_do_not_count(spark, gaps):
    store = ModelStore(spark, scratch_dir(spark, "models"))
    model = fits.balanced_logistic(["b"], "target").fit(gaps)
    store.save("m", "v1", model)
    model.write().save(f"{store.root}/m/v2")
    assert store.versions("m") == ["v1"]


def test_several_changes_to_one_key(spark):
    now = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError, match="several changes"):
        upsert(now, spark.createDataFrame([(1, "b"), (1, "c")], now.schema), ["k"])


def test_steps_of_clusters_read_few_packed_blocks(spark, monkeypatch):
    """However many partitions the points come in, a step has no more tasks than cores and converts no point."""
    rng = np.random.default_rng(7)
    rows = [(float(a), float(b), float(c)) for a, b, c in rng.normal(size=(20_000, 3)) + rng.integers(0, 4, (20_000, 1)) * 9]
    points = spark.createDataFrame(rows, "a double, b double, c double").repartition(40)
    seen, step = [], fits.RestartedKMeans._step

    def watched(packed, centres):
        seen.append((packed.dtypes, packed.rdd.getNumPartitions()))
        return step(packed, centres)

    monkeypatch.setattr(fits.RestartedKMeans, "_step", staticmethod(watched))
    found = fits.kmeans(["a", "b", "c"], 4, starts=2).fit(points).stages[-1]
    assert {tuple(t) for t, _ in seen} == {(("points", "binary"),)}
    assert max(n for _, n in seen) <= spark.sparkContext.defaultParallelism
    x = np.array(rows)
    assert found.cost == pytest.approx(((x[:, None] - found.centres[None]) ** 2).sum(axis=2).min(axis=1).sum())
