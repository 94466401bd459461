"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.scalars import EARTH_RADIUS_M, haversine, weekday_name, within_box
from millrace.plans.registry import query
from millrace.session import register_views, table
from millrace.sources.readers import pick, uniform_int


@query("fn_upper", "select p_partkey, upper(p_name) as name from part")
def fn_upper(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.upper("p_name").alias("name"))


@query("fn_substring", "select c_custkey, substr(c_name, 10, 9) as digits from customer")
def fn_substring(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.substring("c_name", 10, 9).alias("digits"))


@query("fn_concat", "select p_partkey, p_name || ' (' || p_size || ')' as label from part")
def fn_concat(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.concat("p_name", F.lit(" ("), F.col("p_size").cast("string"), F.lit(")")).alias("label"))


@query("fn_split", "select p_partkey, string_split(p_name, ' ')[1] as first_word, string_split(p_brand, '#')[2]::integer as brand from part")
def fn_split(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.split("p_name", " ")[0].alias("first_word"),
        F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int").alias("brand"))


@query("fn_path_parse", """
    select p, substr(p, 1, position('_' in p) - 1)::integer as txn, replace(split_part(p, '_', 2), '.txt', '')::integer as item
    from (select conv_id || '_' || turn || '.txt' as p from conversations)
""")
def fn_path_parse(spark, sf):
    register_views(spark, sf, "conversations")
    return spark.sql("""
        SELECT p, cast(substr(p, 1, position('_' IN p) - 1) AS int) AS txn,
               cast(replace(split_part(p, '_', 2), '.txt', '') AS int) AS item
        FROM (SELECT concat(conv_id, '_', turn, '.txt') AS p FROM conversations)
    """)


@query("fn_trim", "select o_orderkey, trim(o_orderpriority, '12345-') as priority from orders")
def fn_trim(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.trim("o_orderpriority", F.lit("12345-")).alias("priority"))


@query("fn_pad_case", """
    select p_partkey, lpad(p_partkey::varchar, 8, '0') as code,
           upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) as kind,
           trim('  ' || p_name || ' ') as name, p_size::varchar as size_text from part
""")
def fn_pad_case(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("code"), F.initcap("p_type").alias("kind"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("name"), F.col("p_size").cast("string").alias("size_text"))


@query("fn_to_date", "select o_orderkey from orders where o_orderdate::date = date '1996-03-01'")
def fn_to_date(spark, sf):
    # A half-open range on the raw column is the pushable form of comparing its date.
    day = F.to_date(F.lit("1996-03-01"))
    return table(spark, sf, "orders").where(
        (F.col("o_orderdate") >= day.cast("timestamp_ntz")) & (F.col("o_orderdate") < F.date_add(day, 1).cast("timestamp_ntz"))
    ).select("o_orderkey")


@query("fn_year", "select year(o_orderdate)::integer as y, count(*) as n from orders group by 1")
def fn_year(spark, sf):
    return table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))


@query("fn_date_add_diff", """
    select o_orderkey, (o_orderdate::date + 30)::varchar as due, o_orderdate + interval 90 minute as later,
           date_diff('day', date '1995-01-01', o_orderdate::date)::integer as days
    from orders
""")
def fn_date_add_diff(spark, sf):
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.date_add(day, 30).cast("string").alias("due"),
        (F.col("o_orderdate") + F.expr("INTERVAL 90 MINUTES")).alias("later"),
        F.datediff(day, F.to_date(F.lit("1995-01-01"))).alias("days"))


@query("fn_weekday", "select dayname(o_orderdate) as weekday, count(*) as n from orders group by 1")
def fn_weekday(spark, sf):
    return table(spark, sf, "orders").groupBy(weekday_name("o_orderdate").alias("weekday")).agg(F.count("*").alias("n"))


@query("fn_math", """
    select p_partkey, round(sqrt(p_size), 6) as root, pow(p_size, 2)::double as square, round(ln(p_size), 6) as natural_log,
           round(log10(p_size), 6) as log_10, round(sin(p_size), 6) as sine, round(cos(p_size), 6) as cosine,
           round(tan(p_size), 6) as tangent from part
""")
def fn_math(spark, sf):
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey", F.round(F.sqrt(size), 6).alias("root"), F.pow(size, F.lit(2)).alias("square"),
        F.round(F.ln(size), 6).alias("natural_log"), F.round(F.log10(size), 6).alias("log_10"),
        F.round(F.sin(size), 6).alias("sine"), F.round(F.cos(size), 6).alias("cosine"), F.round(F.tan(size), 6).alias("tangent"))


@query("fn_math_sql", """
    select c_custkey, round(abs(c_acctbal), 1) as magnitude, ((c_nationkey - 12) % 5 + 5) % 5 as wrapped,
           ceil(c_acctbal)::bigint as up, least(c_acctbal, 100.0)::double as low, greatest(c_acctbal, 0.0)::double as high,
           nullif(c_nationkey, 7) as not_seven from customer
""")
def fn_math_sql(spark, sf):
    register_views(spark, sf, "customer")
    return spark.sql("""
        SELECT c_custkey, round(abs(c_acctbal), 1) AS magnitude, pmod(c_nationkey - 12, 5) AS wrapped,
               ceil(c_acctbal) AS up, least(c_acctbal, 100D) AS low, greatest(c_acctbal, 0D) AS high,
               nullif(c_nationkey, 7) AS not_seven FROM customer
    """)


@query("fn_hash_uniform", """
    select bucket, count(*) as n from (
        select ('0x' || substr(md5(o_orderkey || '|' || '1'), 1, 8))::bigint % 10 as bucket from orders) group by 1
""")
def fn_hash_uniform(spark, sf):
    return table(spark, sf, "orders").groupBy(uniform_int(["o_orderkey"], 0, 9, seed=1).alias("bucket")).agg(
        F.count("*").alias("n"))


@query("fn_random", "select c_custkey, true as number_ok, 8 as code_length, true as score_ok from customer")
def fn_random(spark, sf):
    """Random numbers, strings and whole numbers per row, with whether each keeps to its range."""
    drawn = table(spark, sf, "customer").select(
        "c_custkey", F.rand(1).alias("number"), F.randstr(F.lit(8), 2).alias("code"), F.uniform(F.lit(0), F.lit(100), 3).alias("score"))
    return drawn.select(
        "c_custkey", ((F.col("number") >= 0) & (F.col("number") < 1)).alias("number_ok"), F.length("code").alias("code_length"),
        F.col("score").between(0, 100).alias("score_ok"))


GEO_SQL = f"""
    with points as (select c_custkey, 37.0 + c_acctbal / 10000.0 as lat, -122.4 + c_nationkey / 25.0 as lon from customer),
    far as (select c_custkey, 2 * {EARTH_RADIUS_M} * asin(sqrt(
        pow(sin((radians(37.6) - radians(lat)) / 2), 2)
        + cos(radians(lat)) * cos(radians(37.6)) * pow(sin((radians(-122.0) - radians(lon)) / 2), 2))) as metres from points)
    select c_custkey, round(metres, 2) as metres from far where metres <= 30000
"""


@query("fn_geo_distance", GEO_SQL)
def fn_geo_distance(spark, sf):
    points = table(spark, sf, "customer").select(
        "c_custkey", (F.lit(37.0) + F.col("c_acctbal") / 10000.0).alias("lat"),
        (F.lit(-122.4) + F.col("c_nationkey") / 25.0).alias("lon"))
    near = points.where(within_box("lat", "lon", 37.6, -122.0, 30_000))
    metres = haversine("lat", "lon", F.lit(37.6), F.lit(-122.0))
    return near.select("c_custkey", metres.alias("metres")).where("metres <= 30000").withColumn("metres", F.round("metres", 2))


@query("fn_call_builtin", "select p_partkey, reverse(p_name) as backwards, length(p_name)::integer as n from part")
def fn_call_builtin(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.call_function("reverse", F.col("p_name")).alias("backwards"), F.expr("length(p_name)").alias("n"))


@query("fn_random_pick", """
    select segment, count(*) as n from (
        select list_extract(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'],
                            (1 + ('0x' || substr(md5(c_custkey || '|' || '3'), 1, 8))::bigint % 5)::integer) as segment
        from customer)
    group by 1
""")
def fn_random_pick(spark, sf):
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    customers = table(spark, sf, "customer").select(pick(segments, ["c_custkey"], seed=3).alias("segment"))
    return customers.groupBy("segment").agg(F.count("*").alias("n"))
