"""Scans, sources and creation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans.registry import query
from millrace.session import register_views, scratch_dir, table
from millrace.sources.readers import (
    generate_rows, project_load, read_any, read_csv, read_json_variant, read_xml, text_files, uniform_int,
)
from millrace.streaming.incremental import load_once

# Fixed rank of each order priority, used as local data.
PRIORITY_RANKS = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]

PRIORITY_SQL = """
    select p.priority, p.rank, count(*) as n_orders
    from orders join (values ('1-URGENT', 1::bigint), ('2-HIGH', 2), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 4), ('5-LOW', 5))
         p(priority, rank) on o_orderpriority = p.priority
    group by 1, 2
"""


@query("scan_table", "select n_nationkey, n_name, n_regionkey from nation")
def scan_table(spark, sf):
    return table(spark, sf, "nation")


@query("scan_sql", """
    select o_orderpriority, count(*) as n_orders, round(sum(o_totalprice), 2) as total
    from orders where o_orderstatus = 'F' group by 1
""")
def scan_sql(spark, sf):
    register_views(spark, sf, "orders")
    return spark.sql("""
        SELECT o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
        FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority
    """)


@query("create_local", PRIORITY_SQL)
def create_local(spark, sf):
    ranks = spark.createDataFrame(PRIORITY_RANKS, ["priority", "rank"])
    orders = table(spark, sf, "orders")
    return orders.join(ranks, F.col("o_orderpriority") == F.col("priority")).groupBy("priority", "rank").agg(
        F.count("*").alias("n_orders")
    )


@query("create_typed", """
    select p.rank, count(*) as n_orders
    from orders join (values ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 4), ('5-LOW', 5))
         p(priority, rank) on o_orderpriority = p.priority
    group by 1
""")
def create_typed(spark, sf):
    schema = T.StructType([
        T.StructField("priority", T.StringType(), False),
        T.StructField("rank", T.IntegerType(), True),
    ])
    ranks = spark.createDataFrame(PRIORITY_RANKS, schema)
    orders = table(spark, sf, "orders")
    return orders.join(ranks, F.col("o_orderpriority") == F.col("priority")).groupBy("rank").agg(
        F.count("*").alias("n_orders")
    )


@query("to_df", "select r_regionkey as id, r_name as label from region")
def to_df(spark, sf):
    return table(spark, sf, "region").toDF("id", "label")


@query("read_csv", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def read_csv_query(spark, sf):
    path = scratch_dir(spark, "csv")
    suppliers = table(spark, sf, "supplier")
    suppliers.write.options(header=True, sep="\t").csv(path)
    return read_csv(spark, path, suppliers.schema, header=True, sep="\t")


@query("read_load", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def read_load(spark, sf):
    path = scratch_dir(spark, "load")
    customers = table(spark, sf, "customer")
    customers.write.format("csv").option("header", True).save(path)
    return read_any(spark, "csv", path, customers.schema, header=True)


@query("read_json", """
    select user_id, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2
""")
def read_json(spark, sf):
    path = scratch_dir(spark, "json")
    events = table(spark, sf, "events")
    events.select("user_id", F.struct("event_type", "value").alias("event")).write.json(path)
    documents = read_json_variant(spark, path)
    return (
        documents.select(
            F.variant_get("v", "$.user_id", "bigint").alias("user_id"),
            F.variant_get("v", "$.event.event_type", "string").alias("event_type"),
            F.variant_get("v", "$.event.value", "double").alias("value"),
        )
        .groupBy("user_id", "event_type")
        .agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    )


@query("read_parquet", "select p_partkey, p_retailprice from part where p_size > 25")
def read_parquet(spark, sf):
    return spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", "p_retailprice").where("p_size > 25")


@query("read_orc", "select p_brand, count(*) as n, max(p_size) as largest from part group by 1")
def read_orc(spark, sf):
    path = scratch_dir(spark, "orc")
    table(spark, sf, "part").write.orc(path)
    return spark.read.orc(path).groupBy("p_brand").agg(F.count("*").alias("n"), F.max("p_size").alias("largest"))


@query("read_xml", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def read_xml_query(spark, sf):
    path = scratch_dir(spark, "xml")
    suppliers = table(spark, sf, "supplier")
    suppliers.write.option("rootTag", "suppliers").option("rowTag", "supplier").xml(path)
    return read_xml(spark, path, "supplier", suppliers.schema)


@query("load_projected", """
    select o_orderkey::integer as order_id, o_custkey::integer as customer_id, o_orderdate::date as order_date,
           year(o_orderdate)::integer as order_year, round(o_totalprice / 100, 4) as hundreds
    from orders
""")
def load_projected(spark, sf):
    staged = table(spark, sf, "orders")
    loaded = project_load(
        staged.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                      F.col("o_orderdate").alias("order_date"), F.col("o_totalprice").alias("price")),
        {"order_id": "int", "customer_id": "int", "order_date": "date", "price": "double"},
        {"order_year": F.year("order_date"), "hundreds": F.round(F.col("price") / 100, 4)},
    ).drop("price")
    path = scratch_dir(spark, "load-projected")
    loaded.write.parquet(path)
    return spark.read.parquet(path)


@query("load_once", "select n_nationkey, n_name, n_regionkey from nation")
def load_once_query(spark, sf):
    inbox, out, state = (scratch_dir(spark, f"load-{part}") for part in ("inbox", "table", "state"))
    nations = table(spark, sf, "nation")
    nations.write.parquet(inbox)
    load_once(spark, inbox, out, state, nations.schema)
    load_once(spark, inbox, out, state, nations.schema)  # every file is consumed: adds nothing
    return spark.read.schema(nations.schema).parquet(out)


@query("scan_text_dir", "select role, count(*) as n_texts, sum(length(text))::bigint as n_chars from conversations group by 1")
def scan_text_dir(spark, sf):
    path = scratch_dir(spark, "texts")
    # Texts hold line breaks, so each is written as one JSON line; a file holds a bounded number.
    table(spark, sf, "conversations").select("role", F.to_json(F.struct("text")).alias("line")).write.option(
        "maxRecordsPerFile", 1000).partitionBy("role").text(path)
    files = text_files(spark, path)
    lines = files.select(
        F.regexp_extract("file_path", "role=([^/]+)", 1).alias("role"),
        F.explode(F.split(F.rtrim(F.col("text")), "\n")).alias("line"),
    )
    return (
        lines.select("role", F.get_json_object("line", "$.text").alias("text"))
        .groupBy("role")
        .agg(F.count("*").alias("n_texts"), F.sum(F.length("text")).alias("n_chars"))
    )


@query("gen_rows", """
    with n as (select count(*) as n from orders),
    g as (select unnest(generate_series(0::bigint, (select n from n) - 1)) as id)
    select bucket, count(*) as n from (
        select 50 + ('0x' || substr(md5(id || '|' || '7'), 1, 8))::bigint % 31 as bucket from g)
    group by 1
""")
def gen_rows(spark, sf):
    n = table(spark, sf, "orders").count()
    rows = generate_rows(spark, n, {"bucket": uniform_int(["id"], 50, 80, seed=7)})
    return rows.groupBy("bucket").agg(F.count("*").alias("n"))


@query("gen_rows_sql", """
    select c_custkey - (select min(c_custkey) from customer) as id,
           'Customer#' || lpad((c_custkey - (select min(c_custkey) from customer))::varchar, 9, '0') as name, 10 as note_length, true as grade_ok, true as score_ok from customer
""")
def gen_rows_sql(spark, sf):
    n = table(spark, sf, "customer").count()
    rows = spark.sql(
        """
        SELECT id, concat('Customer#', lpad(cast(id AS string), 9, '0')) AS name, randstr(10, 5) AS note,
               pmod(xxhash64(id, 1), 10) AS grade, uniform(0, 100, 42) AS score
        FROM range(:n)
        """,
        args={"n": n},
    )
    return rows.select(
        "id", "name", F.length("note").alias("note_length"), F.col("grade").between(0, 9).alias("grade_ok"), F.col("score").between(0, 100).alias("score_ok"))


@query("values_rows", PRIORITY_SQL.replace("::bigint", ""))
def values_rows(spark, sf):
    register_views(spark, sf, "orders")
    return spark.sql("""
        SELECT p.priority, p.rank, count(*) AS n_orders
        FROM orders JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 4), ('5-LOW', 5))
             AS p(priority, rank) ON o_orderpriority = p.priority
        GROUP BY p.priority, p.rank
    """)


@query("read_pandas", "select o_orderstatus, round(avg(o_totalprice), 2) as mean_price from orders group by 1")
def read_pandas(spark, sf):
    import pyspark.pandas as ps

    # A distributed index is made without counting rows first.
    with ps.option_context("compute.default_index_type", "distributed"):
        orders = ps.read_parquet(f"{sf}/orders.parquet", columns=["o_orderstatus", "o_totalprice"])
        means = orders.groupby("o_orderstatus")["o_totalprice"].mean().reset_index()
        return means.to_spark().select("o_orderstatus", F.round("o_totalprice", 2).alias("mean_price"))
