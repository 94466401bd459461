"""Projection, filters, predicates and expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalars import flag
from millrace.plans.registry import query
from millrace.session import register_views, table


@query("select_cols", "select o_orderkey as order_key, o_totalprice as price from orders")
def select_cols(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").alias("price"))


@query("rename_forms", """
    select c_custkey as key_a, c_name as name_b, c_nationkey as nation_c, c_mktsegment as segment_d from customer
""")
def rename_forms(spark, sf):
    customers = table(spark, sf, "customer")
    return (
        customers.select(
            F.col("c_custkey").alias("key_a"), F.col("c_name").name("name_b"),
            F.expr("c_nationkey AS nation_c"), "c_mktsegment",
        ).withColumnRenamed("c_mktsegment", "segment_d")
    )


@query("with_column", """
    select s_suppkey, s_name, s_nationkey, round(s_acctbal * 2, 2) as s_acctbal, 'Hello World' as greeting from supplier
""")
def with_column(spark, sf):
    return table(spark, sf, "supplier").withColumn("s_acctbal", F.round(F.col("s_acctbal") * 2, 2)).withColumn(
        "greeting", F.lit("Hello World"))


@query("with_columns", """
    select o_orderkey, year(o_orderdate)::integer as order_year, round(o_totalprice / 1000, 5) as thousands from orders
""")
def with_columns(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice").withColumns({
        "order_year": F.year("o_orderdate"), "thousands": F.round(F.col("o_totalprice") / 1000, 5),
    }).drop("o_orderdate", "o_totalprice")


@query("drop_cols", "select c_custkey, c_name from customer")
def drop_cols(spark, sf):
    return table(spark, sf, "customer").drop("c_nationkey", "c_acctbal", "c_mktsegment")


@query("star_exclude", "select * exclude (p_retailprice, p_name) from part")
def star_exclude(spark, sf):
    register_views(spark, sf, "part")
    return spark.sql("SELECT * EXCEPT (p_retailprice, p_name) FROM part")


@query("star_plus", "select *, round(p_retailprice * 0.9, 2) as sale_price from part")
def star_plus(spark, sf):
    return table(spark, sf, "part").select("*", F.round(F.col("p_retailprice") * 0.9, 2).alias("sale_price"))


@query("index_cols", "select l_orderkey, l_quantity from lineitem")
def index_cols(spark, sf):
    return table(spark, sf, "lineitem")[["l_orderkey", "l_quantity"]]


@query("select_expr", "select o_orderkey, upper(o_orderpriority) as priority, o_totalprice * 1.0 as price from orders")
def select_expr(spark, sf):
    return table(spark, sf, "orders").selectExpr("o_orderkey", "upper(o_orderpriority) AS priority",
                                                 "o_totalprice * 1.0D AS price")


@query("sql_expr", """
    select l_orderkey, l_linenumber, l_partkey,
           greatest(l_quantity, 10) + least(l_discount, 0.05) as mixed from lineitem
""")
def sql_expr(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.expr("greatest(l_quantity, 10D) + least(l_discount, 0.05D)").alias("mixed"))


@query("filter_eq", "select o_orderkey, o_custkey from orders where o_orderpriority = '1-URGENT'")
def filter_eq(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderpriority") == F.lit("1-URGENT")).select("o_orderkey", "o_custkey")


@query("filter_range", """
    select o_orderkey, o_totalprice from orders where o_orderdate >= '1996-01-01' and o_orderdate <= '1996-12-31'
""")
def filter_range(spark, sf):
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").filter(
        (day >= F.to_timestamp_ntz(F.lit("1996-01-01"))) & (day <= F.to_timestamp_ntz(F.lit("1996-12-31")))
    ).select("o_orderkey", "o_totalprice")


@query("filter_chain", """
    select l_orderkey, l_partkey, l_linenumber from lineitem
    where l_returnflag = 'R' and l_linestatus = 'O' and l_quantity > 40
""")
def filter_chain(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .filter(F.col("l_returnflag") == "R").filter(F.col("l_linestatus") == "O").filter(F.col("l_quantity") > 40)
        .select("l_orderkey", "l_partkey", "l_linenumber")
    )


@query("filter_like", "select p_partkey, p_name from part where p_name like 's%' order by p_partkey")
def filter_like(spark, sf):
    return table(spark, sf, "part").where(F.col("p_name").like("s%")).select("p_partkey", "p_name")


@query("filter_ilike", "select p_partkey, p_name from part where p_name ilike '%RING%'")
def filter_ilike(spark, sf):
    return table(spark, sf, "part").where(F.col("p_name").ilike("%RING%")).select("p_partkey", "p_name")


@query("filter_sentinel", "select event_id, value from events where value < 300")
def filter_sentinel(spark, sf):
    return table(spark, sf, "events").filter(F.col("value") < 300).select("event_id", "value")


@query("filter_or_in", """
    select o_orderkey from orders
    where o_orderpriority = '1-URGENT' or o_orderpriority = '2-HIGH' or o_orderstatus in ('F', 'P')
""")
def filter_or_in(spark, sf):
    priority = F.col("o_orderpriority")
    return table(spark, sf, "orders").where(
        (priority == "1-URGENT") | (priority == "2-HIGH") | F.col("o_orderstatus").isin("F", "P")).select("o_orderkey")


@query("arith", """
    select p_partkey, p_size + 3 as added, p_size - 3 as taken, p_size * 2 as doubled,
           round(p_size / 7, 6) as divided, p_size % 7 as rest
    from part
""")
def arith(spark, sf):
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey", (size + 3).alias("added"), (size - 3).alias("taken"), (size * 2).alias("doubled"),
        F.round(size / 7, 6).alias("divided"), (size % 7).alias("rest"))


@query("compare_logic", """
    select l_returnflag,
           count(case when l_quantity < 10 and l_discount > 0.05 then 1 end) as small_cheap,
           count(case when l_quantity != 25 or l_tax = 0 then 1 end) as either,
           count(case when (l_discount = null) is null then 1 end) as unknown
    from lineitem group by 1
""")
def compare_logic(spark, sf):
    def hits(condition):
        return F.count(F.when(condition, 1))

    quantity, discount, tax = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        hits((quantity < 10) & (discount > 0.05)).alias("small_cheap"),
        hits((quantity != 25) | (tax == 0)).alias("either"),
        hits((discount == F.lit(None)).isNull()).alias("unknown"),
    )


@query("lateral_alias", """
    select l_returnflag, n, total, round(total / n, 4) as mean from (
        select l_returnflag, count(*) as n, round(sum(l_quantity), 2) as total from lineitem group by 1)
""")
def lateral_alias(spark, sf):
    register_views(spark, sf, "lineitem")
    return spark.sql("""
        SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS total, round(total / n, 4) AS mean
        FROM lineitem GROUP BY l_returnflag
    """)


@query("cast", """
    select o_orderkey::integer as key_int, o_custkey::double as cust_double, trunc(o_totalprice)::bigint as price_long,
           o_orderdate::date::varchar as day_text, try_cast(substr(o_orderpriority, 3) as integer) as no_number
    from orders
""")
def cast(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast(T.IntegerType()).alias("key_int"), F.col("o_custkey").cast("double").alias("cust_double"),
        F.col("o_totalprice").cast(T.LongType()).alias("price_long"),
        F.col("o_orderdate").cast(T.DateType()).cast("string").alias("day_text"),
        F.substring("o_orderpriority", 3, 100).try_cast("int").alias("no_number"),
    )


@query("literal", "select r_regionkey, 'Hello World' as words, 3.14::double as number, false as no, 7 as seven from region")
def literal(spark, sf):
    return table(spark, sf, "region").select(
        "r_regionkey", F.lit("Hello World").alias("words"), F.lit(3.14).alias("number"), F.lit(False).alias("no"),
        F.lit(7).alias("seven"))


@query("case_when", """
    select event_type, case event_type when 'purchase' then 1 when 'error' then -1 else 0 end as score, count(*) as n
    from events group by 1
""")
def case_when(spark, sf):
    kind = F.col("event_type")
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n")).withColumn(
        "score", F.when(kind == "purchase", 1).when(kind == "error", -1).otherwise(0))


@query("case_bands", """
    select case when l_discount = 0 then 'none' when l_discount <= 0.05 then 'low' else 'high' end as band,
           count(*) as n from lineitem group by 1
""")
def case_bands(spark, sf):
    discount = F.col("l_discount")
    band = F.when(discount == 0, "none").when(discount <= 0.05, "low").otherwise("high")
    return table(spark, sf, "lineitem").groupBy(band.alias("band")).agg(F.count("*").alias("n"))


@query("case_sql", """
    select case o_orderstatus when 'F' then 'finished' when 'O' then 'open' else 'other' end as state,
           case when o_totalprice > 250000 then 'large' else 'small' end as size,
           case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 else 9 end as rank, count(*) as n
    from orders group by 1, 2, 3
""")
def case_sql(spark, sf):
    register_views(spark, sf, "orders")
    return spark.sql("""
        SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'other' END AS state,
               if(o_totalprice > 250000, 'large', 'small') AS size,
               decode(o_orderpriority, '1-URGENT', 1, '2-HIGH', 2, 9) AS rank, count(*) AS n
        FROM orders GROUP BY 1, 2, 3
    """)


@query("bool_encode", """
    select c_custkey, (c_mktsegment = 'BUILDING')::integer::double as is_building,
           (c_acctbal > 0)::integer::double as in_credit from customer
""")
def bool_encode(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", flag(F.col("c_mktsegment") == "BUILDING").alias("is_building"),
        flag(F.col("c_acctbal") > 0).alias("in_credit"))


@query("derived_price", """
    select l_returnflag, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) as charge from lineitem group by 1
""")
def derived_price(spark, sf):
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.round(F.sum(charge), 2).alias("charge"))


@query("coalesce_fill", """
    select c_custkey, coalesce(round(sum(o_totalprice), 2), 0.0) as total
    from customer left join orders on c_custkey = o_custkey + 700 group by 1
""")
def coalesce_fill(spark, sf):
    # The key is shifted so that some customers have no orders.
    orders = table(spark, sf, "orders")
    totals = orders.groupBy((F.col("o_custkey") + 700).alias("c_custkey")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return table(spark, sf, "customer").select("c_custkey").join(totals, "c_custkey", "left").select(
        "c_custkey", F.coalesce("total", F.lit(0.0)).alias("total"))


@query("fillna_map", """
    select c_custkey, coalesce(n, 0) as n, coalesce(first_day, date '1970-01-01')::varchar as first_day,
           coalesce(priority, 'none') as priority
    from customer left join (
        select o_custkey + 700 as shifted, count(*) as n, min(o_orderdate)::date as first_day, min(o_orderpriority) as priority
        from orders group by 1) on c_custkey = shifted
""")
def fillna_map(spark, sf):
    # The key is shifted so that some customers have no orders.
    facts = table(spark, sf, "orders").groupBy((F.col("o_custkey") + 700).alias("c_custkey")).agg(
        F.count("*").alias("n"), F.min("o_orderdate").cast("date").alias("first_day"),
        F.min("o_orderpriority").alias("priority"))
    joined = table(spark, sf, "customer").select("c_custkey").join(facts, "c_custkey", "left")
    # fillna takes numbers, strings and booleans; a date default needs coalesce.
    return joined.fillna({"n": 0, "priority": "none"}).withColumn(
        "first_day", F.coalesce("first_day", F.lit(date(1970, 1, 1))).cast("string"))


@query("context_fns", "select r_regionkey, true as named, true as known_place, true as one_moment from region")
def context_fns(spark, sf):
    """User, catalogue, schema and time of the session: set, listed, and the same for all rows."""
    facts = table(spark, sf, "region").select(
        "r_regionkey", F.current_user().alias("user"), F.current_catalog().alias("catalog"),
        F.current_schema().alias("schema"), F.current_date().alias("today"), F.current_timestamp().alias("now"))
    catalog, schema = spark.catalog.currentCatalog(), spark.catalog.currentDatabase()
    return facts.select(
        "r_regionkey", (F.length("user") > 0).alias("named"), ((F.col("catalog") == catalog) & (F.col("schema") == schema)).alias("known_place"),
        (F.col("today") == F.to_date("now")).alias("one_moment"))
