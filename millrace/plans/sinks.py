"""Sinks and actions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.aggregates import key_quality
from millrace.plans.registry import query
from millrace.session import register_views, scratch_dir, table
from millrace.sources.versions import VersionedTable, delete_where, update_where, upsert
from millrace.sources.writers import client_rows, client_stream, temporary_table, write, write_sorted

STATUS_SQL = "select o_orderstatus, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by 1"


def status_totals(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("write_overwrite", "select n_nationkey, n_name, n_regionkey from nation where n_name like 'NATION_1%'")
def write_overwrite(spark, sf):
    path = scratch_dir(spark, "overwrite")
    nations = table(spark, sf, "nation")
    write(nations, path)
    return write(nations.where(F.col("n_name").like("NATION_1%")), path, mode="overwrite")


@query("write_append", "select o_orderkey, o_totalprice from orders where o_orderstatus in ('F', 'P')")
def write_append(spark, sf):
    path = scratch_dir(spark, "append")
    orders = table(spark, sf, "orders")
    write(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), path)
    return write(orders.where("o_orderstatus = 'P'").select("o_orderkey", "o_totalprice"), path, mode="append")


@query("write_modes", "select r_regionkey, r_name, 'refused' as second_write from region")
def write_modes(spark, sf):
    from pyspark.errors import AnalysisException

    path = scratch_dir(spark, "modes")
    regions = table(spark, sf, "region")
    write(regions, path, mode="errorifexists")
    try:
        write(regions, path, mode="errorifexists")
        second = "written"
    except AnalysisException:
        second = "refused"
    kept = write(regions.limit(0), path, mode="ignore")  # leaves the first write alone
    return kept.withColumn("second_write", F.lit(second))


@query("write_temp", STATUS_SQL)
def write_temp(spark, sf):
    return temporary_table(status_totals(spark, sf), "status_totals")


@query("ctas", """
    select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as quantity, count(*) as n from lineitem group by 1, 2
""")
def ctas(spark, sf):
    register_views(spark, sf, "lineitem")
    path = scratch_dir(spark, "ctas")
    name = "ctas_" + path.rsplit("-", 1)[1]
    spark.sql(f"""
        CREATE TABLE {name} USING parquet LOCATION '{path}' AS
        SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS quantity, count(*) AS n
        FROM lineitem GROUP BY l_returnflag, l_linestatus
    """)
    return spark.table(name)


@query("ctas_sorted", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def ctas_sorted(spark, sf):
    return write_sorted(table(spark, sf, "customer"), scratch_dir(spark, "sorted"), ["c_nationkey", "c_custkey"])


@query("insert_select", "select p_brand, 2 * count(*) as n from part group by 1")
def insert_select(spark, sf):
    parts = VersionedTable(spark, scratch_dir(spark, "insert"), "part")
    parts.write_next(table(spark, sf, "part"))
    doubled = parts.insert(parts.read())
    return doubled.groupBy("p_brand").agg(F.count("*").alias("n"))


@query("view_temp", STATUS_SQL)
def view_temp(spark, sf):
    status_totals(spark, sf).createOrReplaceTempView("status_view")
    return spark.table("status_view")


@query("view_perm", STATUS_SQL)
def view_perm(spark, sf):
    # A permanent view may read catalogue tables and files, not temporary views.
    spark.sql(f"""
        CREATE OR REPLACE VIEW order_status_view AS
        SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total
        FROM parquet.`{sf}/orders.parquet` GROUP BY o_orderstatus
    """)
    return spark.table("order_status_view")


@query("show", "select c_custkey, c_name, c_acctbal from customer order by c_acctbal desc, c_custkey limit 10")
def show(spark, sf):
    top = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal").orderBy(
        F.desc("c_acctbal"), "c_custkey").limit(10)
    top.show(10, truncate=40)
    return top


@query("collect", STATUS_SQL)
def collect(spark, sf):
    totals = status_totals(spark, sf)
    return spark.createDataFrame(client_rows(totals), totals.schema)


@query("local_iter", "select count(*) as n, round(sum(total), 2) as total from (" + STATUS_SQL + ")")
def local_iter(spark, sf):
    n, total = 0, 0.0
    for row in client_stream(status_totals(spark, sf)):
        n, total = n + 1, total + row["total"]
    return spark.createDataFrame([(n, round(total, 2))], "n bigint, total double")


@query("count_rows", """
    select 'customer' as name, count(*) as n from customer union all select 'orders', count(*) from orders
    union all select 'lineitem', count(*) from lineitem
""")
def count_rows(spark, sf):
    names = ["customer", "orders", "lineitem"]
    return spark.createDataFrame([(name, table(spark, sf, name).count()) for name in names], "name string, n bigint")


@query("to_pandas", STATUS_SQL)
def to_pandas(spark, sf):
    totals = status_totals(spark, sf)  # an aggregate: three rows at any scale
    return spark.createDataFrame(totals.toPandas(), totals.schema)


@query("write_pandas", "select n_regionkey, count(*) as n from nation group by 1")
def write_pandas(spark, sf):
    grouped = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.count("*").alias("n"))
    local = grouped.toPandas()
    return write(spark.createDataFrame(local, grouped.schema), scratch_dir(spark, "pandas"))


@query("pandas_convert", "select c_mktsegment, round(max(c_acctbal), 2) as top_balance from customer group by 1")
def pandas_convert(spark, sf):
    import pyspark.pandas as ps

    with ps.option_context("compute.default_index_type", "distributed"):
        customers = table(spark, sf, "customer").select("c_mktsegment", "c_acctbal").pandas_api()
        top = customers.groupby("c_mktsegment")["c_acctbal"].max().reset_index()
        return top.to_spark().select("c_mktsegment", F.round("c_acctbal", 2).alias("top_balance"))


@query("key_check", """
    with k as (select l_orderkey, l_linenumber, count(*) as n,
                      sum((l_quantity is null)::int) as q from lineitem group by 1, 2)
    select sum(n)::bigint as n_rows, count(case when n > 1 then 1 end) as duplicate_keys,
           sum(case when n > 1 then n - 1 else 0 end)::bigint as surplus_rows,
           sum(case when l_orderkey is null then n else 0 end)::bigint as null_l_orderkey,
           sum(case when l_linenumber is null then n else 0 end)::bigint as null_l_linenumber,
           sum(q)::bigint as null_l_quantity
    from k
""")
def key_check(spark, sf):
    return key_quality(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity"])


@query("explain")
def explain(spark, sf):
    register_views(spark, sf, "orders")
    return spark.sql("""
        EXPLAIN FORMATTED SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total
        FROM orders GROUP BY o_orderstatus
    """)


@query("schema_of", """
    select column_name as name, case column_type when 'BIGINT' then 'bigint' when 'VARCHAR' then 'string'
           when 'DOUBLE' then 'double' when 'TIMESTAMP' then 'timestamp_ntz' end as type
    from (describe select * from orders)
""")
def schema_of(spark, sf):
    fields = table(spark, sf, "orders").schema.fields
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in fields], "name string, type string")


@query("dataset_snapshot", """
    select 'v2' as latest, 2::bigint as n_versions, o_orderstatus, count(*) as n
    from orders where o_totalprice > 1000 group by 3
""")
def dataset_snapshot(spark, sf):
    orders = table(spark, sf, "orders")
    data = VersionedTable(spark, scratch_dir(spark, "datasets"), "orders")
    data.snapshot(orders.select("o_orderstatus", "o_totalprice"), "v1")
    data.snapshot(orders.where("o_totalprice > 1000").select("o_orderstatus", "o_totalprice"), "v2")
    return data.read().groupBy("o_orderstatus").agg(F.count("*").alias("n")).select(
        F.lit(data.latest()).alias("latest"), F.lit(len(data.versions())).cast("bigint").alias("n_versions"),
        "o_orderstatus", "n",
    )


@query("upsert", """
    with changes as (select o_orderkey, o_custkey, 'X' as o_orderstatus, round(o_totalprice * 2, 2) as o_totalprice
                     from orders where o_orderstatus = 'P'
                     union all
                     select o_orderkey + (select max(o_orderkey) + 1 from orders), o_custkey, 'N', o_totalprice
                     from orders where o_orderpriority = '1-URGENT')
    select o_orderstatus, count(*) as n, round(sum(o_totalprice), 2) as total from (
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders
        where o_orderkey not in (select o_orderkey from changes)
        union all select * from changes) group by 1
""")
def upsert_query(spark, sf):
    current = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    top = table(spark, sf, "orders").agg((F.max("o_orderkey") + 1).alias("k"))
    changed = current.where("o_orderstatus = 'P'").withColumns(
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.round(F.col("o_totalprice") * 2, 2)})
    added = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(
        (F.col("o_orderkey") + top.scalar()).alias("o_orderkey"), "o_custkey", F.lit("N").alias("o_orderstatus"),
        "o_totalprice")
    result = upsert(current, changed.unionByName(added), ["o_orderkey"])
    return result.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("update_where", """
    select c_mktsegment, round(sum(case when c_acctbal < 0 then 0.0 else c_acctbal end), 2) as balance
    from customer group by 1
""")
def update_where_query(spark, sf):
    customers = table(spark, sf, "customer")
    fixed = update_where(customers, F.col("c_acctbal") < 0, {"c_acctbal": F.lit(0.0)})
    return fixed.groupBy("c_mktsegment").agg(F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("delete_where", "select c_mktsegment, count(*) as n from customer where not (c_acctbal < 0) group by 1")
def delete_where_query(spark, sf):
    kept = delete_where(table(spark, sf, "customer"), F.col("c_acctbal") < 0)
    return kept.groupBy("c_mktsegment").agg(F.count("*").alias("n"))
