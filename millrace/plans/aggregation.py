"""Aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.scalars import ratio
from millrace.operators.aggregates import correlation_matrix, describe, group_summary, histogram, pivot, share_of_total
from millrace.operators.rangebuckets import exact_quantiles
from millrace.plans.registry import query
from millrace.session import register_views, table


@query("agg_group", """
    select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as quantity, round(avg(l_extendedprice), 4) as mean_price,
           count(*) as n from lineitem group by 1, 2
""")
def agg_group(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.avg("l_extendedprice"), 4).alias("mean_price"),
        F.count("*").alias("n"))


@query("agg_global", "select min(ts)::date::varchar as first_day, max(ts)::date::varchar as last_day from events")
def agg_global(spark, sf):
    return table(spark, sf, "events").agg(
        F.to_date(F.min("ts")).cast("string").alias("first_day"), F.to_date(F.max("ts")).cast("string").alias("last_day"))


@query("agg_basic", """
    select event_type, round(sum(value), 2) as total, round(avg(value), 4) as mean, min(value) as low, max(value) as high,
           count(value) as n_values, count(*) as n_rows,
           count(case when value > 100 then value end) as n_large
    from events group by 1
""")
def agg_basic(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.round(F.sum("value"), 2).alias("total"), F.round(F.avg("value"), 4).alias("mean"), F.min("value").alias("low"),
        F.max("value").alias("high"), F.count("value").alias("n_values"), F.count("*").alias("n_rows"),
        F.count(F.when(F.col("value") > 100, F.col("value"))).alias("n_large"))


@query("agg_shortcut", "select ts::date::varchar as day, round(avg(value), 4) as mean_value from events group by 1")
def agg_shortcut(spark, sf):
    daily = table(spark, sf, "events").withColumn("day", F.to_date("ts").cast("string")).groupBy("day").avg("value")
    return daily.withColumnRenamed("avg(value)", "mean_value").withColumn("mean_value", F.round("mean_value", 4))


@query("agg_two_level", """
    select o_custkey, round(avg(n), 4) as yearly from (
        select o_custkey, year(o_orderdate) as y, count(*) as n from orders group by 1, 2) group by 1
""")
def agg_two_level(spark, sf):
    yearly = table(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    return yearly.groupBy("o_custkey").agg(F.round(F.avg("n"), 4).alias("yearly"))


@query("agg_ratio", """
    select o_custkey, round(avg(ratio), 4) as return_ratio from (
        select l_orderkey, sum(case when l_returnflag = 'R' then l_extendedprice else 0 end)
                           / nullif(sum(l_extendedprice), 0) as ratio from lineitem group by 1)
    join orders on l_orderkey = o_orderkey group by 1
""")
def agg_ratio(spark, sf):
    price = F.col("l_extendedprice")
    per_order = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", price).otherwise(0.0)).alias("returned"), F.sum(price).alias("sold"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(
        F.round(F.avg(ratio("returned", "sold")), 4).alias("return_ratio"))


@query("agg_median", "select l_returnflag, median(l_extendedprice) as median_price from lineitem group by 1")
def agg_median(spark, sf):
    return exact_quantiles(table(spark, sf, "lineitem"), {"median_price": ("l_extendedprice", 0.5)}, by=["l_returnflag"])


@query("agg_count_distinct", """
    select l_returnflag, count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers from lineitem group by 1
""")
def agg_count_distinct(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers"))


@query("agg_having", """
    select l_orderkey, round(sum(l_quantity), 2) as quantity from lineitem group by 1 having sum(l_quantity) > 100
""")
def agg_having(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.round(F.sum("l_quantity"), 2).alias("quantity")).where(
        "quantity > 100")


@query("agg_round", "select l_suppkey, round(avg(l_discount), 2) as mean_discount from lineitem group by 1")
def agg_round(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.round(F.avg("l_discount"), 2).alias("mean_discount"))


@query("agg_cast", "select l_orderkey, sum(l_quantity)::integer as quantity from lineitem group by 1")
def agg_cast(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").cast("int").alias("quantity"))


@query("agg_case_sum", """
    select user_id, sum(case event_type when 'purchase' then 1 when 'error' then -1 else 0 end)::bigint as net
    from events group by 1
""")
def agg_case_sum(spark, sf):
    kind = F.col("event_type")
    return table(spark, sf, "events").groupBy("user_id").agg(
        F.sum(F.when(kind == "purchase", 1).when(kind == "error", -1).otherwise(0)).alias("net"))


SHARE_SQL = """
    select c_mktsegment, count(*) as n, round(count(*) * 100.0 / sum(count(*)) over (), 4)::double as share
    from customer group by 1
"""


@query("agg_share", SHARE_SQL)
def agg_share(spark, sf):
    groups = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    return share_of_total(groups, "n").withColumn("share", F.round(F.col("share").cast("double"), 4))


@query("agg_array_distinct", """
    select event_type, string_agg(distinct_value::varchar, ',' order by distinct_value) as keys from (
        select distinct event_type, (props->>'$.k')::bigint as distinct_value from events) group by 1
""")
def agg_array_distinct(spark, sf):
    # Made distinct first, so only the distinct values of a group ever travel.
    values = table(spark, sf, "events").select(
        "event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k")).distinct()
    arrays = values.groupBy("event_type").agg(F.array_sort(F.collect_set("k")).alias("keys"))
    return arrays.select("event_type", F.array_join(F.col("keys").cast("array<string>"), ",").alias("keys"))


@query("agg_group_ordinal", "select o_orderpriority, o_orderstatus, count(*) as n from orders group by 1, 2")
def agg_group_ordinal(spark, sf):
    register_views(spark, sf, "orders")
    return spark.sql("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")


@query("agg_corr", """
    select round(corr(l_quantity, l_extendedprice), 6) as quantity_price, round(corr(l_discount, l_tax), 6) as discount_tax
    from lineitem
""")
def agg_corr(spark, sf):
    return table(spark, sf, "lineitem").agg(
        F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("quantity_price"),
        F.round(F.corr("l_discount", "l_tax"), 6).alias("discount_tax"))


CORR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("corr_matrix", " union all ".join(
    f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as corr from lineitem" for a in CORR_COLUMNS for b in CORR_COLUMNS))
def corr_matrix(spark, sf):
    return correlation_matrix(table(spark, sf, "lineitem"), CORR_COLUMNS).withColumn("corr", F.round("corr", 6))


@query("describe", " union all ".join(
    f"""select '{c}' as "column", count({c}) as n, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as stddev,
        min({c})::double as low, max({c})::double as high from lineitem""" for c in CORR_COLUMNS))
def describe_query(spark, sf):
    return describe(table(spark, sf, "lineitem"), CORR_COLUMNS).withColumns(
        {"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@query("count_pairs", "select p_size, p_type, count(*) as n from part group by 1, 2")
def count_pairs(spark, sf):
    return table(spark, sf, "part").groupBy("p_size", "p_type").count().withColumnRenamed("count", "n")


@query("histogram", """
    with e as (select min(l_extendedprice) as low, max(l_extendedprice) as high,
                      (max(l_extendedprice) - min(l_extendedprice)) / 10 as w from lineitem),
    b as (select least(floor((l_extendedprice - low) / w), 9)::integer as bin, count(*) as n from lineitem, e group by 1)
    select g.bin::integer as bin, round(low + g.bin * w, 4) as low, round(low + (g.bin + 1) * w, 4) as high, coalesce(n, 0) as n
    from (select unnest(range(10)) as bin) g left join b on g.bin = b.bin, e
""")
def histogram_query(spark, sf):
    return histogram(table(spark, sf, "lineitem"), "l_extendedprice", 10).withColumns(
        {"low": F.round("low", 4), "high": F.round("high", 4)})


@query("mode_rate", """
    select o_orderpriority, round(avg((o_orderstatus = 'F')::integer) * 100, 1) as finished_rate from orders group by 1
""")
def mode_rate(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.round(F.avg((F.col("o_orderstatus") == "F").cast("int")) * 100, 1).alias("finished_rate"))


@query("agg_pivot", """
    select user_id, count(case when event_type = 'click' then 1 end) as click,
           count(case when event_type = 'error' then 1 end) as error,
           count(case when event_type = 'purchase' then 1 end) as purchase from events
    group by 1
""")
def agg_pivot(spark, sf):
    return pivot(table(spark, sf, "events"), ["user_id"], "event_type", ["click", "error", "purchase"],
                 F.count("event_id")).fillna(0)


@query("ship_avg", """
    select l_returnflag, l_linestatus, round(avg(l_quantity), 4) as mean_quantity, median(l_quantity) as median_quantity,
           median(l_extendedprice) as median_price, count(*) as n from lineitem group by 1, 2
""")
def ship_avg(spark, sf):
    return group_summary(
        table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"],
        [F.round(F.avg("l_quantity"), 4).alias("mean_quantity"), F.count("*").alias("n")],
        {"median_quantity": "l_quantity", "median_price": "l_extendedprice"},
    )
