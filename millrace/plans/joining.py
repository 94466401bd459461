"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.asof import join_asof
from millrace.operators.joins import bind_columns, grid_product
from millrace.plans.registry import query
from millrace.session import register_views, scratch_dir, table
from millrace.streaming.incremental import change_stream, run_to_files


@query("join_inner", """
    select o_orderkey, c_name, o_totalprice from orders join customer on o_custkey = c_custkey
""")
def join_inner(spark, sf):
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "o_totalprice")


@query("join_inner_using", """
    select user_id, event_type, n, total from
      (select user_id, event_type, count(*) as n from events group by 1, 2)
      join (select user_id, event_type, round(sum(value), 2) as total from events group by 1, 2)
      using (user_id, event_type)
""")
def join_inner_using(spark, sf):
    events = table(spark, sf, "events")
    counts = events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    totals = events.groupBy("user_id", "event_type").agg(F.round(F.sum("value"), 2).alias("total"))
    return counts.join(totals, ["user_id", "event_type"])


@query("join_multi_key", """
    select b.day, b.event_type, b.n, a.n as n_day_before from
      (select ts::date::varchar as day, event_type, count(*) as n from events group by 1, 2) b
      join (select (ts::date + 1)::varchar as day, event_type as kind, count(*) as n from events group by 1, 2) a
      on b.day = a.day and b.event_type = a.kind
""")
def join_multi_key(spark, sf):
    events = table(spark, sf, "events").withColumn("date", F.to_date("ts"))
    own = events.groupBy(F.col("date").cast("string").alias("day"), "event_type").agg(F.count("*").alias("n"))
    before = events.groupBy(F.date_add("date", 1).cast("string").alias("day"), F.col("event_type").alias("kind")).agg(
        F.count("*").alias("n_day_before"))
    return own.join(before, (own["day"] == before["day"]) & (own["event_type"] == before["kind"])).select(
        own["day"], "event_type", "n", "n_day_before")


def _customers_and_orders(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_custkey") + 700).alias("o_custkey"))
    return customers, orders, F.col("c_custkey") == F.col("o_custkey")


# Keys are shifted so that both sides have rows without a partner.
SIDES = """(select c_custkey, c_nationkey from customer) c {how} join
           (select o_orderkey, o_custkey + 700 as o_custkey from orders) o
           on c.c_custkey = o.o_custkey"""


@query("join_left", "select * from " + SIDES.format(how="left"))
def join_left(spark, sf):
    customers, orders, on = _customers_and_orders(spark, sf)
    return customers.join(orders, on, "left")


@query("join_right", "select * from " + SIDES.format(how="right"))
def join_right(spark, sf):
    customers, orders, on = _customers_and_orders(spark, sf)
    return customers.join(orders, on, "right")


@query("join_full", "select * from " + SIDES.format(how="full"))
def join_full(spark, sf):
    customers, orders, on = _customers_and_orders(spark, sf)
    return customers.join(orders, on, "full")


@query("join_semi", "select * from " + SIDES.format(how="semi"))
def join_semi(spark, sf):
    customers, orders, on = _customers_and_orders(spark, sf)
    return customers.join(orders, on, "left_semi")


@query("join_anti", "select * from " + SIDES.format(how="anti"))
def join_anti(spark, sf):
    customers, orders, on = _customers_and_orders(spark, sf)
    return customers.join(orders, on, "left_anti")


@query("join_cross", """
    with grid as (select n_nationkey, segment from nation cross join (select distinct c_mktsegment as segment from customer)),
    sizes as (select c_nationkey, c_mktsegment, count(*) as n from customer group by 1, 2)
    select n_nationkey, segment, coalesce(n, 0) as n_customers
    from grid left join sizes on n_nationkey = c_nationkey and segment = c_mktsegment
""")
def join_cross(spark, sf):
    customers = table(spark, sf, "customer")
    segments = customers.select(F.col("c_mktsegment").alias("segment")).distinct()
    grid = grid_product(table(spark, sf, "nation").select("n_nationkey"), segments)
    sizes = customers.groupBy(F.col("c_nationkey").alias("n_nationkey"), F.col("c_mktsegment").alias("segment")).agg(
        F.count("*").alias("n"))
    return grid.join(sizes, ["n_nationkey", "segment"], "left").select(
        "n_nationkey", "segment", F.coalesce("n", F.lit(0)).alias("n_customers"))


ASOF_SQL = """
    select l.event_id, l.user_id, l.ts, r.value as purchase_value, r.event_id as purchase_id
    from (select * from events where event_type = 'click') l
    asof left join (select * from events where event_type = 'purchase') r
    on l.user_id = r.user_id and {condition}
"""


def _clicks_and_purchases(spark, sf):
    events = table(spark, sf, "events")
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "ts")
    purchases = events.where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("bought"), F.col("value").alias("purchase_value"), F.col("event_id").alias("purchase_id"))
    return clicks, purchases


@query("join_asof", ASOF_SQL.format(condition="l.ts >= r.ts"))
def join_asof_query(spark, sf):
    clicks, purchases = _clicks_and_purchases(spark, sf)
    return join_asof(clicks, purchases, "user_id", "ts", "bought", columns=["purchase_value", "purchase_id"])


@query("join_asof_forward", ASOF_SQL.format(condition="l.ts <= r.ts"))
def join_asof_forward(spark, sf):
    clicks, purchases = _clicks_and_purchases(spark, sf)
    return join_asof(clicks, purchases, "user_id", "ts", "bought", columns=["purchase_value", "purchase_id"],
                     direction="forward")


@query("join_asof_tolerance", """
    select event_id, user_id, ts, case when bought >= ts - interval 12 hour then purchase_value end as purchase_value
    from (select l.event_id, l.user_id, l.ts, r.value as purchase_value, r.ts as bought
          from (select * from events where event_type = 'click') l
          asof left join (select * from events where event_type = 'purchase') r
          on l.user_id = r.user_id and l.ts > r.ts)
""")
def join_asof_tolerance(spark, sf):
    clicks, purchases = _clicks_and_purchases(spark, sf)
    return join_asof(clicks, purchases, "user_id", "ts", "bought", columns=["purchase_value"], allow_equal=False,
                     tolerance="12 hours")


@query("join_asof_equal", """
    select a.event_id, a.user_id, count(b.o_orderkey) > 0 as on_an_order_day
    from events a left join orders b on b.o_custkey = a.user_id and b.o_orderdate = date_trunc('day', a.ts) - interval 9000 day
    group by 1, 2
""")
def join_asof_equal(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", F.date_sub(F.to_date("ts"), 9000).cast("timestamp_ntz").alias("day"))
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"), "o_orderdate", "o_orderkey")
    matched = join_asof(events, orders, "user_id", "day", "o_orderdate", columns=["o_orderkey"], direction="equal")
    return matched.select("event_id", "user_id", F.col("o_orderkey").isNotNull().alias("on_an_order_day"))


@query("join_self_copy", """
    select a.c_nationkey, count(*) as n from customer a join customer b on a.c_custkey = b.c_custkey + 1 group by 1
""")
def join_self_copy(spark, sf):
    a = table(spark, sf, "customer").alias("a")
    b = table(spark, sf, "customer").alias("b")
    return a.join(b, F.col("a.c_custkey") == F.col("b.c_custkey") + 1).groupBy("a.c_nationkey").agg(F.count("*").alias("n"))


@query("join_chain_quirk", """
    with l as (select l_orderkey, l_partkey, l_quantity from lineitem),
    r as (select l_orderkey as back_order, l_partkey as back_part, max(l_quantity) as returned
          from lineitem where l_returnflag = 'R' group by 1, 2)
    select l_orderkey, l_partkey, l_quantity, returned, o_custkey
    from l left join r on l_orderkey = back_order and l_partkey = back_part
    join orders on back_order = o_orderkey
""")
def join_chain_quirk(spark, sf):
    """Left join whose right key then feeds an inner join: lines without a return are dropped."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    returns = table(spark, sf, "lineitem").where("l_returnflag = 'R'").groupBy(
        F.col("l_orderkey").alias("back_order"), F.col("l_partkey").alias("back_part")
    ).agg(F.max("l_quantity").alias("returned"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return (
        lines.join(returns, (F.col("l_orderkey") == F.col("back_order")) & (F.col("l_partkey") == F.col("back_part")),
                   "left")
        .join(orders, F.col("back_order") == F.col("o_orderkey"))
        .select("l_orderkey", "l_partkey", "l_quantity", "returned", "o_custkey")
    )


@query("join_table_function", """
    select event_type, key, count(*) as n, sum(value)::bigint as total from (
        select event_type, unnest(json_keys(props)) as key, (props->>'$.k')::bigint as value from events)
    group by 1, 2
""")
def join_table_function(spark, sf):
    events = table(spark, sf, "events").select("event_type", F.parse_json("props").alias("v"))
    entries = events.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    return entries.groupBy("event_type", "key").agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("bigint")).alias("total"))


@query("join_lateral_subquery", """
    select tier, level, count(*) as n from (
        select case when c_acctbal < 0 then 'debt' when c_acctbal < 5000 then 'plain' else 'gold' end as tier,
               c_nationkey % 3 as level from customer) group by 1, 2
""")
def join_lateral_subquery(spark, sf):
    register_views(spark, sf, "customer")
    return spark.sql("""
        SELECT d.tier, d.level, count(*) AS n
        FROM customer c, LATERAL (
            SELECT CASE WHEN c.c_acctbal < 0 THEN 'debt' WHEN c.c_acctbal < 5000 THEN 'plain' ELSE 'gold' END AS tier,
                   c.c_nationkey % 3 AS level) d
        GROUP BY d.tier, d.level
    """)


@query("bind_cols", """
    select p_partkey, p_size, round(p_retailprice * 1.1, 2) as predicted from part
""")
def bind_cols(spark, sf):
    parts = table(spark, sf, "part")
    inputs = parts.select("p_partkey", "p_size")
    predictions = parts.select("p_partkey", F.round(F.col("p_retailprice") * 1.1, 2).alias("predicted"))
    return bind_columns(inputs, predictions, "p_partkey")


@query("join_stream_static", """
    select o_orderstatus, count(*) as n_lines, round(sum(l_quantity), 2) as quantity
    from orders join lineitem on l_orderkey = o_orderkey group by 1
""")
def join_stream_static(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    inbox, out, state = (scratch_dir(spark, f"stream-static-{p}") for p in ("inbox", "out", "state"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    orders.write.parquet(inbox)
    stream = change_stream(spark, inbox, orders.schema)
    joined = stream.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderstatus", "l_quantity")
    run_to_files(joined, out, state)
    return spark.read.schema(joined.schema).parquet(out).groupBy("o_orderstatus").agg(
        F.count("*").alias("n_lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("join_comma_theta", """
    with mark as (select max(o_orderdate) as max_ts from orders where o_orderstatus = 'F')
    select o_orderkey, o_orderstatus from orders o, mark m where o.o_orderdate > m.max_ts - interval 30 day
""")
def join_comma_theta(spark, sf):
    orders = table(spark, sf, "orders")
    # The one-row side is a scalar subquery, so its value reaches the scan as a filter.
    mark = orders.where("o_orderstatus = 'F'").agg((F.max("o_orderdate") - F.expr("INTERVAL 30 DAYS")).alias("max_ts"))
    return orders.where(F.col("o_orderdate") > mark.scalar()).select("o_orderkey", "o_orderstatus")
