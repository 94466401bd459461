"""Change streams and incremental refresh, each fed in steps and compared with the whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.features.views import Entity, FeatureStore, FeatureView
from millrace.models.fits import kmeans, score
from millrace.plans.registry import query
from millrace.session import scratch_dir, table
from millrace.streaming.incremental import (
    FeatureRefresh, append_children, append_new, change_stream, preload, read_batches, run_batches, run_to_files, write_batch,
)

NOW = "1998-07-01 00:00:00"
LATER = "2000-01-01 00:00:00"


def _orders(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


STATUS_SQL = "select o_orderstatus, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by 1"


def _by_status(rows: DataFrame) -> DataFrame:
    return rows.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("change_stream", STATUS_SQL)
def change_stream_query(spark, sf):
    """Consumed after the first load and again after an append: the second run sees only new rows."""
    orders = _orders(spark, sf)
    inbox, out, state = (scratch_dir(spark, f"changes-{p}") for p in ("inbox", "out", "state"))
    past, rest = preload(orders, "o_orderdate", NOW)
    for part in (past, rest):
        part.write.mode("append").parquet(inbox)
        run_to_files(change_stream(spark, inbox, orders.schema), out, state)
    return _by_status(spark.read.schema(orders.schema).parquet(out))


@query("trigger_on_data", "select count(*) as n_rows, 2::bigint as runs_with_data from orders")
def trigger_on_data(spark, sf):
    """Four runs, of which two find new rows; the others do nothing."""
    orders = _orders(spark, sf)
    inbox, out, state = (scratch_dir(spark, f"trigger-{p}") for p in ("inbox", "out", "state"))
    runs = []

    def handle(rows, batch_id):
        write_batch(rows, out, batch_id)
        runs.append(batch_id)

    for part in preload(orders, "o_orderdate", NOW):
        part.write.mode("append").parquet(inbox)
        for _ in range(2):
            run_batches(change_stream(spark, inbox, orders.schema), state, handle)
    return read_batches(spark, out, orders.schema).agg(
        F.count("*").alias("n_rows"), F.lit(len(runs)).cast("bigint").alias("runs_with_data"))


@query("append_by_watermark", f"""
    select case when o_orderdate <= timestamp '{NOW}' then 0 else 1 end::bigint as run, count(*) as n, round(sum(o_totalprice), 2) as total
    from orders where o_orderdate <= timestamp '{LATER}' group by 1
""")
def append_by_watermark(spark, sf):
    """Appends up to one moment, again at the same moment (adds nothing), and up to a later one."""
    orders, target = _orders(spark, sf), scratch_dir(spark, "watermark")
    for now in (NOW, NOW, LATER):
        append_new(spark, orders, "o_orderdate", target, now)
    rows = read_batches(spark, f"{target}/rows", orders.schema)
    return rows.groupBy(F.when(F.col("batch") == 0, 0).otherwise(1).cast("bigint").alias("run")).agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("append_children", """
    select 'lines' as kind, count(*) as n, round(sum(l_quantity), 2) as quantity from lineitem where l_orderkey in (select o_orderkey from orders)
    union all select 'returns', count(*), round(sum(l_quantity), 2) from lineitem
    where l_returnflag = 'R' and l_orderkey in (select o_orderkey from orders)
""")
def append_children_query(spark, sf):
    """Orders arrive in two steps; each step appends their lines and returns."""
    orders = _orders(spark, sf)
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_quantity")
    children = {"lines": (lines, "l_orderkey"), "returns": (lines.where("l_returnflag = 'R'"), "l_orderkey")}
    inbox, out, state = (scratch_dir(spark, f"children-{p}") for p in ("inbox", "out", "state"))
    for part in preload(orders, "o_orderdate", NOW):
        part.write.mode("append").parquet(inbox)
        run_batches(change_stream(spark, inbox, orders.schema), state,
                    lambda rows, batch_id: append_children(rows, batch_id, children, "o_orderkey", out))
    counted = [
        read_batches(spark, f"{out}/{kind}", lines.schema).agg(
            F.lit(kind).alias("kind"), F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
        for kind in children
    ]
    return counted[0].unionByName(counted[1])


@query("preload_split", f"""
    select case when o_orderdate < timestamp '{NOW}' then 'past' else 'rest' end as part, count(*) as n from orders group by 1
""")
def preload_split(spark, sf):
    past, rest = preload(_orders(spark, sf), "o_orderdate", NOW)
    return past.agg(F.lit("past").alias("part"), F.count("*").alias("n")).unionByName(
        rest.agg(F.lit("rest").alias("part"), F.count("*").alias("n")))


def _habits(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.max("o_orderdate").alias("latest"))


def _refreshed(spark, sf, label: str, *dependents) -> FeatureRefresh:
    orders, inbox = _orders(spark, sf), scratch_dir(spark, f"{label}-inbox")
    refresh = FeatureRefresh(spark, scratch_dir(spark, label), ["o_custkey"], _habits)
    for name, derive in dependents:
        refresh.then(name, derive)
    for part in preload(orders, "o_orderdate", NOW):
        part.write.mode("append").parquet(inbox)
        refresh.run(change_stream(spark, inbox, orders.schema))
    return refresh


@query("scheduled_refresh", """
    select o_custkey, count(*) as n_orders, round(sum(o_totalprice), 2) as total, max(o_orderdate) as latest from orders group by 1
""")
def scheduled_refresh(spark, sf):
    return _refreshed(spark, sf, "refresh").current()


@query("refresh_chain", """
    select o_custkey, case when sum(o_totalprice) > 2500000 then 'large' when sum(o_totalprice) > 1000000 then 'middle' else 'small' end as segment
    from orders group by 1
""")
def refresh_chain(spark, sf):
    """A second view, derived from the feature rows of each refresh."""
    def segment(features: DataFrame) -> DataFrame:
        total = F.col("total")
        return features.select("o_custkey", F.when(total > 2500000, "large").when(total > 1000000, "middle").otherwise("small").alias("segment"))

    return _refreshed(spark, sf, "chain", ("segments", segment)).current("segments")


@query("read_refreshed_view", """
    select o_custkey, count(*) as n_orders, round(sum(o_totalprice), 2) as total, max(o_orderdate) as latest from orders group by 1
""")
def read_refreshed_view(spark, sf):
    """A view registered on past orders and refreshed by the later ones: customers without a later order keep their registered row."""
    orders, inbox = _orders(spark, sf), scratch_dir(spark, "view-inbox")
    past, rest = preload(orders, "o_orderdate", NOW)
    store = FeatureStore(spark, scratch_dir(spark, "store"))
    store.register(FeatureView("habits", Entity("customer", ("o_custkey",)), _habits(past), "latest"), "V1")
    rest.write.parquet(inbox)
    store.keep_fresh("habits", change_stream(spark, inbox, orders.schema), _habits, history=past)
    return store.read("habits")


@query("stream_scoring", f"select count(*) as n, true as clustered from orders where o_orderdate >= timestamp '{NOW}'")
def stream_scoring(spark, sf):
    """A fitted pipeline applied to rows as they arrive: each of them gets one of the three clusters."""
    orders = _orders(spark, sf)
    past, rest = preload(orders, "o_orderdate", NOW)
    model = kmeans(["o_totalprice", "o_custkey"], k=3).fit(past)
    inbox, out, state = (scratch_dir(spark, f"scoring-{p}") for p in ("inbox", "out", "state"))
    rest.write.parquet(inbox)
    scored = score(model, change_stream(spark, inbox, orders.schema), "cluster").select("o_orderkey", "cluster")
    run_to_files(scored, out, state)
    return spark.read.schema(scored.schema).parquet(out).agg(
        F.countDistinct("o_orderkey").alias("n"), F.every(F.coalesce(F.col("cluster").isin(0, 1, 2), F.lit(False))).alias("clustered"))
