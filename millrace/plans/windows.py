"""Numbering, totals and ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.aggregates import share_of_total
from millrace.operators.rangebuckets import dense_ids
from millrace.plans.aggregation import SHARE_SQL
from millrace.plans.registry import query
from millrace.session import register_views, table


@query("dense_ids", """
    select l_partkey, row_number() over (order by l_partkey) - 1 as id from (select distinct l_partkey from lineitem)
""")
def dense_ids_query(spark, sf):
    return dense_ids(table(spark, sf, "lineitem"), "l_partkey", "id")


@query("dense_ids_text", """
    select c_name, row_number() over (order by c_name) - 1 as id from (select distinct c_name from customer)
""")
def dense_ids_text(spark, sf):
    return dense_ids(table(spark, sf, "customer"), "c_name", "id")


@query("dense_ids_sql", """
    select o_custkey, row_number() over (order by o_custkey) - 1 as id from (select distinct o_custkey from orders)
""")
def dense_ids_sql(spark, sf):
    register_views(spark, sf, "orders")
    dense_ids(spark.sql("SELECT o_custkey FROM orders"), "o_custkey", "id").createOrReplaceTempView("customer_ids")
    return spark.sql("SELECT o_custkey, id FROM customer_ids")


@query("row_ids_any_order", "select count(*) as n, count(*) as ids, true as not_negative from part")
def row_ids_any_order(spark, sf):
    """Unique, increasing ids in no stated order: partition number and position, without a shuffle."""
    ids = table(spark, sf, "part").select(F.monotonically_increasing_id().alias("row_id"), "p_partkey")
    return ids.agg(F.count("p_partkey").alias("n"), F.countDistinct("row_id").alias("ids"), (F.min("row_id") >= 0).alias("not_negative"))


@query("win_total", SHARE_SQL)
def win_total(spark, sf):
    groups = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    return share_of_total(groups, "n").withColumn("share", F.round(F.col("share").cast("double"), 4))


@query("win_topn", """
    select o_custkey, round(sum(o_totalprice), 2) as total from orders group by 1 order by total desc, o_custkey limit 20
""")
def win_topn(spark, sf):
    totals = table(spark, sf, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return totals.orderBy(F.desc("total"), "o_custkey").limit(20)
