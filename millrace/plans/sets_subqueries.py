"""Set operations and subqueries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans.registry import query
from millrace.session import register_views, table


@query("union_all", """
    select kind, count(*) as n from (select 'customer' as kind, c_nationkey as k from customer
    union all select 'supplier', s_nationkey from supplier) group by 1
""")
def union_all(spark, sf):
    customers = table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("k"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"), F.lit("supplier").alias("kind"))
    return customers.unionByName(suppliers).groupBy("kind").agg(F.count("*").alias("n"))


@query("distinct", "select distinct l_returnflag, l_linestatus, l_suppkey from lineitem")
def distinct(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


@query("except_", """
    select o_custkey from orders where o_orderstatus = 'F' except select o_custkey from orders where o_orderstatus = 'P'
""")
def except_(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.where("o_orderstatus = 'F'").select("o_custkey").subtract(
        orders.where("o_orderstatus = 'P'").select("o_custkey"))


@query("except_all", """
    select o_custkey from orders where o_orderstatus = 'F'
    except all select o_custkey from orders where o_orderstatus = 'P'
""")
def except_all(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.where("o_orderstatus = 'F'").select("o_custkey").exceptAll(
        orders.where("o_orderstatus = 'P'").select("o_custkey"))


@query("subq_derived", """
    select o_orderkey, o_custkey, quantity from orders join (
        select l_orderkey, round(sum(l_quantity), 2) as quantity from lineitem group by 1 having sum(l_quantity) > 150) s
    on o_orderkey = l_orderkey
""")
def subq_derived(spark, sf):
    register_views(spark, sf, "orders", "lineitem")
    return spark.sql("""
        SELECT o_orderkey, o_custkey, quantity FROM orders JOIN (
            SELECT l_orderkey, round(sum(l_quantity), 2) AS quantity
            FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 150) s
        ON o_orderkey = l_orderkey
    """)


@query("subq_scalar", "select o_orderkey, o_totalprice from orders where o_totalprice > (select avg(o_totalprice) * 1.5 from orders)")
def subq_scalar(spark, sf):
    register_views(spark, sf, "orders")
    return spark.sql("""
        SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) * 1.5 FROM orders)
    """)


@query("subq_not_exists", """
    select c_custkey, c_name from customer where not exists (
        select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')
""")
def subq_not_exists(spark, sf):
    register_views(spark, sf, "customer", "orders")
    return spark.sql("""
        SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
            SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
    """)


CTE = """
    with lines as (select l_orderkey, {price} as sold, sum(case when l_returnflag = 'R' then l_extendedprice else 0 end) as returned
                   from lineitem group by l_orderkey),
    per_order as (select o_custkey, o_orderdate, returned / nullif(sold, 0) as ratio
                  from lines join orders on l_orderkey = o_orderkey),
    per_customer as (select o_custkey, avg(ratio) as ratio, max(o_orderdate) as latest from per_order group by o_custkey)
    select o_custkey, round(ratio, 4) as ratio, latest from per_customer where ratio > 0.5
"""


@query("cte_chain", CTE.format(price="sum(l_extendedprice)"))
def cte_chain(spark, sf):
    register_views(spark, sf, "orders", "lineitem")
    return spark.sql(CTE.format(price="sum(l_extendedprice)"))
