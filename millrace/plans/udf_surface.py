"""UDF, table function and procedure surface."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions.udfs import (
    PartitionTotals, Procedures, margin_of_frame, margin_of_series, register, register_expression, row_udf, scored_with,
)
from millrace.operators.semistruct import dot
from millrace.plans.registry import query
from millrace.session import scratch_dir, shuffle_width, table
from millrace.sources.readers import generate_rows, uniform_int
from millrace.sources.writers import write

CIRCLE_SQL = "select p_partkey, round(2 * pi() * p_size, 6) as circumference from part"


def _sizes(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("radius"))


@query("udf_lambda", CIRCLE_SQL)
def udf_lambda(spark, sf):
    circumference = row_udf(lambda r: 2 * math.pi * r, "double")
    return _sizes(spark, sf).select("p_partkey", F.round(circumference("radius"), 6).alias("circumference"))


@query("udf_named", CIRCLE_SQL)
def udf_named(spark, sf):
    @F.udf(returnType="double", useArrow=True)
    def circumference(radius: float) -> float:
        return 2 * math.pi * radius

    return _sizes(spark, sf).select("p_partkey", F.round(circumference("radius"), 6).alias("circumference"))


@query("udf_sql", CIRCLE_SQL)
def udf_sql(spark, sf):
    register(spark, "circumference_py", row_udf(lambda r: 2 * math.pi * r, "double"))
    _sizes(spark, sf).createOrReplaceTempView("part_sizes")
    return spark.sql("SELECT p_partkey, round(circumference_py(radius), 6) AS circumference FROM part_sizes")


@query("udf_register", CIRCLE_SQL)
def udf_register(spark, sf):
    register_expression(spark, "circumference_of", "radius DOUBLE", "DOUBLE", "2 * pi() * radius")
    _sizes(spark, sf).createOrReplaceTempView("part_sizes")
    return spark.sql("SELECT p_partkey, round(circumference_of(radius), 6) AS circumference FROM part_sizes")


MARGIN_SQL = """
    select l_orderkey, l_partkey, l_linenumber, l_quantity,
           round(p_retailprice * l_quantity - l_extendedprice * l_discount, 4) as margin
    from lineitem join part on l_partkey = p_partkey
"""


def _prices(spark, sf):
    lines, parts = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", (F.col("p_retailprice") * F.col("l_quantity")).alias("price"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("cost"))


LINE = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"]


@query("udf_vector_df", MARGIN_SQL)
def udf_vector_df(spark, sf):
    return _prices(spark, sf).select(*LINE, F.round(margin_of_frame(F.struct("price", "cost")), 4).alias("margin"))


@query("udf_vector_series", MARGIN_SQL)
def udf_vector_series(spark, sf):
    return _prices(spark, sf).select(*LINE, F.round(margin_of_series("price", "cost"), 4).alias("margin"))


@query("udf_vector_sql", MARGIN_SQL)
def udf_vector_sql(spark, sf):
    register(spark, "margin_vector", margin_of_series)
    _prices(spark, sf).createOrReplaceTempView("line_prices")
    return spark.sql("""
        SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, round(margin_vector(price, cost), 4) AS margin FROM line_prices
    """)


@query("udf_star_args", """
    select s_suppkey, round(s_nationkey + s_acctbal, 4) as everything from supplier
""")
def udf_star_args(spark, sf):
    @F.pandas_udf("double")
    def add_up(rows: pd.DataFrame) -> pd.Series:
        return rows.sum(axis=1).astype("float64")

    suppliers = table(spark, sf, "supplier").drop("s_name")
    inputs = [c for c in suppliers.columns if c != "s_suppkey"]
    return suppliers.select("s_suppkey", F.round(add_up(F.struct(*inputs)), 4).alias("everything"))


@query("udf_margin_compare", """
    select count(*) as n, 0::bigint as scalar_differs, 0::bigint as vector_differs,
           round(sum(p_retailprice * l_quantity - l_extendedprice * l_discount), 2) as margin
    from lineitem join part on l_partkey = p_partkey
""")
def udf_margin_compare(spark, sf):
    """One column computed by row UDF, vector UDF and expression; all three must agree."""
    scalar = row_udf(lambda price, cost: price - cost, "double")
    expression = F.col("price") - F.col("cost")
    computed = _prices(spark, sf).select(
        expression.alias("e"), scalar("price", "cost").alias("s"), margin_of_series("price", "cost").alias("v"))
    return computed.agg(
        F.count("*").alias("n"), F.count(F.when(F.col("e") != F.col("s"), 1)).alias("scalar_differs"),
        F.count(F.when(F.col("e") != F.col("v"), 1)).alias("vector_differs"), F.round(F.sum("e"), 2).alias("margin"))


@query("udf_variant_result", """
    select p_partkey, length(p_name)::bigint as n_chars, len(string_split(p_name, ' '))::bigint as n_words from part
""")
def udf_variant_result(spark, sf):
    facts = row_udf(lambda s: (len(s), len(s.split(" "))), "n_chars bigint, n_words bigint")
    return table(spark, sf, "part").select("p_partkey", facts("p_name").alias("f")).select("p_partkey", "f.*")


@query("udf_with_file", """
    select o_orderkey, case o_orderpriority when '1-URGENT' then 1.0 when '2-HIGH' then 0.5 else 0.0 end::double as weight from orders
""")
def udf_with_file(spark, sf):
    """The lookup is written once, and read once per task rather than once per batch."""
    path = scratch_dir(spark, "weights")
    weights = table(spark, sf, "orders").select("o_orderpriority").distinct().select(
        F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1.0).when(F.col("o_orderpriority") == "2-HIGH", 0.5).otherwise(0.0).alias("weight"))
    stored = write(weights, path).limit(1001).collect()
    if len(stored) > 1000:
        raise ValueError("too many priorities to ship as a lookup")
    shipped = spark.sparkContext.broadcast({r["priority"]: r["weight"] for r in stored})
    weight = scored_with(lambda: shipped.value, lambda lookup, batch: batch.map(lookup), "double")
    return table(spark, sf, "orders").select("o_orderkey", weight("o_orderpriority").alias("weight"))


@query("udtf_rows", """
    select p_partkey, name, round(value, 6) as value from (
        select p_partkey, unnest(['number', 'square_root', 'square', 'cube', 'ln', 'log_10', 'sine', 'cosine', 'tangent']) as name,
               unnest([p_size, sqrt(p_size), p_size * p_size, p_size ** 3, ln(p_size), log10(p_size), sin(p_size), cos(p_size), tan(p_size)]) as value from part)
""")
def udtf_rows(spark, sf):
    from millrace.functions.udfs import NumberFacts

    parts = _sizes(spark, sf)
    spark.udtf.register("number_facts", NumberFacts)
    parts.createOrReplaceTempView("part_sizes")
    return spark.sql("""
        SELECT p_partkey, f.name, round(f.value, 6) AS value FROM part_sizes p, LATERAL number_facts(p.radius) f
    """)


@query("udtf_partition", """
    select event_type as key, count(*) as n, round(sum(value), 2) as total from events group by 1
""")
def udtf_partition(spark, sf):
    """State per partition. A key is split by a salt first, so no key is one task's whole work."""
    spark.udtf.register("partition_totals", PartitionTotals)
    table(spark, sf, "events").select(
        F.col("event_type").alias("key"), "value", F.pmod(F.xxhash64("event_id"), F.lit(shuffle_width(spark))).alias("salt")
    ).createOrReplaceTempView("keyed_values")
    partial = spark.sql("SELECT key, n, total FROM partition_totals(TABLE(keyed_values) PARTITION BY (key, salt))")
    return partial.groupBy("key").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))


@query("sproc_scalar", """
    select 'by_object' as form, count(*) + max(o_orderkey) as result from orders
    union all select 'by_name', count(*) + max(o_orderkey) from orders
""")
def sproc_scalar(spark, sf):
    procedures = Procedures(spark)

    @procedures.add(name="add_two")
    def add(session, x, y):
        return x + y

    totals = table(spark, sf, "orders").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("k")).first()
    rows = [("by_object", add(spark, totals["n"], totals["k"])), ("by_name", procedures.call("add_two", totals["n"], totals["k"]))]
    return spark.createDataFrame(rows, "form string, result bigint")


@query("sproc_write", """
    with n as (select count(*) as n from customer),
    g as (select unnest(generate_series(0::bigint, (select n from n) - 1)) as id)
    select weight, 2 * count(*) as n from (
        select 50 + ('0x' || substr(md5(id || '|' || '5'), 1, 8))::bigint % 31 as weight from g) group by 1
""")
def sproc_write(spark, sf):
    procedures = Procedures(spark)

    @procedures.add(name="create_and_fill")
    def create_and_fill(session, path, n, overwrite):
        rows = generate_rows(session, n, {"weight": uniform_int(["id"], 50, 80, seed=5)})
        return write(rows, path, mode="overwrite" if overwrite else "append")

    path, n = scratch_dir(spark, "procedure"), table(spark, sf, "customer").count()
    procedures.call("create_and_fill", path, n, True)
    filled = procedures.call("create_and_fill", path, n, False)
    return filled.groupBy("weight").agg(F.count("*").alias("n"))


@query("sproc_table", "select c_nationkey, count(*) as n from customer where c_acctbal > 5000 group by 1")
def sproc_table(spark, sf):
    procedures = Procedures(spark)

    @procedures.add(name="rich_by_nation")
    def rich_by_nation(session, floor):
        return table(session, sf, "customer").where(F.col("c_acctbal") > floor).groupBy("c_nationkey").agg(F.count("*").alias("n"))

    return procedures.call("rich_by_nation", 5000)


@query("sproc_query", """
    select round(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: x[1]::double * x[2]::double)), 2) as rating
    from embeddings a, embeddings b
    where a.vec_id = (select min(vec_id) from embeddings) and b.vec_id = (select max(vec_id) from embeddings)
""")
def sproc_query(spark, sf):
    procedures = Procedures(spark)
    vectors = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))

    @procedures.add(name="predict_rating")
    def predict_rating(session, a, b):
        both = vectors.where(F.col("vec_id").isin(a, b)).agg(
            F.max(F.when(F.col("vec_id") == a, F.col("v"))).alias("u"), F.max(F.when(F.col("vec_id") == b, F.col("v"))).alias("i"))
        return both.select(F.round(dot(F.col("u"), F.col("i")), 2)).first()[0]

    ends = vectors.agg(F.min("vec_id").alias("a"), F.max("vec_id").alias("b")).first()
    return spark.createDataFrame([(procedures.call("predict_rating", ends["a"], ends["b"]),)], "rating double")
