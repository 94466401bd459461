"""Incremental jobs add nothing when run again; sketches stay within their bounds."""

from pyspark.sql import functions as F

from millrace.operators import sketches as sk
from millrace.plans import QUERIES
from millrace.streaming.incremental import (
    FeatureRefresh, append_new, change_stream, load_once, read_batches, run_batches, write_batch,
)

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "id long, v double"


def _rows(spark, low, high):
    return spark.range(low, high).select("id", (F.col("id") * 1.5).alias("v"))


def test_load_once_twice(spark, tmp_path):
    inbox, out, state = (str(tmp_path / p) for p in ("inbox", "out", "state"))
    _rows(spark, 0, 10).write.parquet(inbox)
    schema = _rows(spark, 0, 1).schema
    for _ in range(2):
        load_once(spark, inbox, out, state, schema, purge=True)
        assert spark.read.parquet(out).count() == 10
    _rows(spark, 10, 15).write.mode("append").parquet(inbox)
    load_once(spark, inbox, out, state, schema, purge=True)
    assert spark.read.parquet(out).count() == 15


def test_replayed_batch_adds_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    for _ in range(2):
        write_batch(_rows(spark, 0, 10), out, 3)
    assert read_batches(spark, out, _rows(spark, 0, 1).schema).count() == 10


def test_watermark_append_repeats_an_unfinished_run(spark, tmp_path):
    source = spark.sql("SELECT id, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id AS int)) AS ts FROM range(100)")
    target = str(tmp_path / "t")
    assert append_new(spark, source, "ts", target, "2024-01-02 00:00:00") == 0
    # A run that wrote rows and died before its mark was committed.
    write_batch(source, f"{target}/rows", 1)
    assert append_new(spark, source, "ts", target, "2024-01-03 00:00:00") == 1
    assert append_new(spark, source, "ts", target, "2024-01-03 00:00:00") == 2
    rows = read_batches(spark, f"{target}/rows", source.schema)
    assert rows.count() == rows.select("id").distinct().count() == 49


def test_refresh_recomputes_touched_keys_only(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    make = lambda df: df.groupBy("k").agg(F.count("*").alias("n"))
    refresh = FeatureRefresh(spark, str(tmp_path / "root"), ["k"], make)
    schema = spark.range(1).select((F.col("id") % 2).alias("k"), "id").schema
    for low, high, mod in ((0, 10, 5), (10, 14, 2)):
        spark.range(low, high).select((F.col("id") % mod).alias("k"), "id").coalesce(1).write.mode("append").parquet(inbox)
        refresh.run(change_stream(spark, inbox, schema))
        refresh.run(change_stream(spark, inbox, schema))
    assert {r["k"]: r["n"] for r in refresh.current().collect()} == {0: 4, 1: 4, 2: 2, 3: 2, 4: 2}
    written = read_batches(spark, str(tmp_path / "root" / "features"), refresh.schemas["features"])
    assert {r["k"] for r in written.where("batch = 1").collect()} == {0, 1}


def test_empty_runs_do_nothing(spark, tmp_path):
    inbox, state, seen = str(tmp_path / "inbox"), str(tmp_path / "state"), []
    _rows(spark, 0, 5).write.parquet(inbox)
    for _ in range(3):
        run_batches(change_stream(spark, inbox, _rows(spark, 0, 1).schema), state, lambda df, i: seen.append(df.count()))
    assert seen == [5]


def test_distinct_sketches(spark):
    df = spark.range(60000).select((F.col("id") % 20000).alias("x"), (F.col("id") % 7).alias("g"))
    states = sk.hll_accumulate(df, "x", ["g"])
    assert abs(sk.hll_estimate(sk.hll_combine(states)).first()["n_distinct"] / 20000 - 1) < 0.06
    approx = df.agg(F.approx_count_distinct("x", 0.02)).first()[0]
    assert abs(approx / 20000 - 1) < 0.08


def test_quantile_sketches(spark):
    df = spark.range(50000).select(F.col("id").alias("x"), (F.col("id") % 5).alias("g"))
    merged = sk.quantile_combine(sk.quantile_accumulate(df, "x", ["g"]))
    row = sk.quantile_estimate(merged, {"m": 0.5, "p": 0.95}).first()
    assert abs(row["m"] - 25000) < 1000 and abs(row["p"] - 47500) < 1000


def test_topk_sketches(spark):
    df = spark.range(10000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 2).alias("x"), (F.col("id") % 4).alias("g"))
    found = sk.topk_estimate(sk.topk_combine(sk.topk_accumulate(df, "x", ["g"])), 1).first()
    assert (found["item"], found["n"]) == (1, 3334)


def test_minhash(spark):
    a = spark.range(0, 3000).select(F.lit("a").alias("g"), "id")
    b = spark.range(1000, 4000).select(F.lit("b").alias("g"), "id")
    signatures = sk.minhash_signature(a.union(b), "id", ["g"], k=256)
    similarity = sk.signature_similarity(signatures, k=256).first()["similarity"]
    assert abs(similarity - 0.5) < 0.12
    halves = a.union(b).withColumn("h", F.col("id") % 2)
    parts = sk.minhash_signature(halves, "id", ["g", "h"], k=256)
    merged = {r["g"]: r["signature"] for r in sk.minhash_combine(parts, ["g"], 256).collect()}
    assert merged == {r["g"]: r["signature"] for r in signatures.collect()}


def test_scans_are_pruned_and_filtered(spark, capsys):
    QUERIES["filter_chain"](spark, SF_DIR).explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(l_returnflag,R)" in plan and "GreaterThan(l_quantity,40.0)" in plan
    assert "l_extendedprice" not in plan


def test_no_products_of_rows(spark):
    for name in ("join_cross", "join_comma_theta", "m_confusion", "subq_scalar"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
