"""Semi-structured data, arrays and table functions.

The test tables hold no nested documents, so weather-like documents are derived from ``events``,
row by row: a station (the user) reports two observations per event, and an ``error`` event's
first reading is the sentinel 999.9.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.semistruct import (
    flatten, flatten_nested, flatten_variant, get_path, json_array_rows, split_to_rows,
)
from millrace.plans.registry import query
from millrace.session import spread, table

SENTINEL = 999.9


def weather_documents(spark, sf):
    """(event_id, t, v): one VARIANT document per event."""
    events = spread(table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value"))
    reading = F.when(F.col("event_type") == "error", SENTINEL).otherwise(F.col("value"))

    def observation(hours: int, temp):
        return F.struct(
            (F.col("ts") + F.expr(f"INTERVAL {hours} HOURS")).cast("string").alias("dt"),
            F.struct(temp.alias("temp"), F.round(F.col("value") / 2, 4).alias("dew-point")).alias("air"),
        )

    document = F.struct(
        F.struct(F.col("user_id").alias("id"), F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("ICAO"),
                 F.struct((F.col("user_id") / 10).alias("lat"), (F.col("user_id") / 5).alias("lon")).alias("coord")).alias("station"),
        F.struct(F.array(observation(0, reading), observation(1, F.round(F.col("value") + 1, 4))).alias("observations")).alias("data"),
    )
    return events.select("event_id", F.to_date("ts").alias("t"), F.parse_json(F.to_json(document)).alias("v"))


# The same observations in SQL.
OBSERVATIONS = """
    select event_id, user_id, 'S' || user_id as icao, 0 as index, ts as dt,
           case when event_type = 'error' then 999.9 else value end::double as temp, round(value / 2, 4) as dew from events
    union all
    select event_id, user_id, 'S' || user_id, 1, ts + interval 1 hour, round(value + 1, 4), round(value / 2, 4) from events
"""


@query("var_path", "select event_id, 'S' || user_id as icao, user_id as id, round(user_id / 10, 4) as lat from events")
def var_path(spark, sf):
    return weather_documents(spark, sf).select(
        "event_id", get_path("v", "station.ICAO", "string").alias("icao"), get_path("v", "station.id", "bigint").alias("id"),
        F.round(get_path("v", "station.coord.lat", "double"), 4).alias("lat"))


@query("var_path_sql", "select event_id, user_id as id, round(value / 2, 4) as dew from events")
def var_path_sql(spark, sf):
    weather_documents(spark, sf).createOrReplaceTempView("weather_documents")
    return spark.sql("""
        SELECT event_id, v:station.id::bigint AS id, v:data.observations[0].air['dew-point']::double AS dew
        FROM weather_documents
    """)


@query("flatten_array", f"select event_id, index, temp from ({OBSERVATIONS})")
def flatten_array(spark, sf):
    rows = flatten_variant(weather_documents(spark, sf), "v", "data.observations", ["event_id"])
    return rows.select("event_id", "index", get_path("value", "air.temp", "double").alias("temp"))


@query("flatten_outer", """
    select conv_id, turn, index, part from (
        select conv_id, turn, (unnest(range(len(parts))) )::integer as index, unnest(parts) as part from (
            select conv_id, turn, list_filter(string_split(role, 's'), lambda x: x <> role) as parts from conversations))
    union all
    select conv_id, turn, null, null from conversations where not contains(role, 's')
""")
def flatten_outer(spark, sf):
    """Rows whose array is empty stay, with NULL index and value."""
    turns = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.filter(F.split("role", "s"), lambda x: x != F.col("role")).alias("parts"))
    return flatten(turns, "parts", ["conv_id", "turn"], outer=True).withColumnRenamed("value", "part")


@query("flatten_object", """
    select event_id, unnest(['ICAO', 'coord', 'id']) as key, (unnest([null, round(user_id / 10, 4), null]))::double as lat from events
""")
def flatten_object(spark, sf):
    """The fields of an object, one row each."""
    rows = flatten_variant(weather_documents(spark, sf), "v", "station", ["event_id"], mode="object")
    return rows.select("event_id", "key", F.round(get_path("value", "lat", "double"), 4).alias("lat"))


NESTED_SQL = f"""
    with fields as (
        select event_id, unnest(['station', 'station.ICAO', 'station.id', 'station.coord', 'station.coord.lat', 'station.coord.lon',
                                 'data', 'data.observations', 'data.observations[0]', 'data.observations[1]']) as path from events
        union all
        select event_id, 'data.observations[' || index || ']' || unnest(['.dt', '.air', '.air.temp', '.air.dew-point']) from ({OBSERVATIONS}))
    select event_id, path, case when path like '%]' then null else string_split(path, '.')[-1] end as key,
           case when path like '%]' then path[-2]::integer end as index,
           case when path like '%[_].air.temp' then temp end as temp
    from fields left join ({OBSERVATIONS}) o using (event_id)
    where case when path like '%[_]%' then o.index = string_split(path, '[')[2][1]::integer else o.index = 0 end
"""


@query("flatten_recursive", NESTED_SQL)
def flatten_recursive(spark, sf):
    """Every element of the documents, at any depth."""
    temp = F.when(F.col("path").rlike(r"air\.temp$"), F.col("value").try_cast("double"))
    return flatten_nested(weather_documents(spark, sf), "v", ["event_id"]).select("event_id", "path", "key", "index", temp.alias("temp"))


@query("flatten_sql", f"select event_id, index, dew from ({OBSERVATIONS})")
def flatten_sql(spark, sf):
    weather_documents(spark, sf).createOrReplaceTempView("weather_documents")
    return spark.sql("""
        SELECT event_id, o.pos AS index, o.value:air['dew-point']::double AS dew
        FROM weather_documents, LATERAL variant_explode(variant_get(v, '$.data.observations', 'variant')) AS o
    """)


def observations(spark, sf):
    rows = flatten_variant(weather_documents(spark, sf), "v", "data.observations", ["t", "v"])
    return rows.select(
        get_path("v", "station.id", "bigint").alias("user_id"), get_path("v", "station.ICAO", "string").alias("icao"),
        get_path("value", "dt", "string").cast("timestamp_ntz").alias("dt"),
        get_path("value", "air.temp", "double").alias("temp"), get_path("value", "air['dew-point']", "double").alias("dew"),
    )


@query("flatten_weather", f"select distinct user_id, icao, dt, temp, dew from ({OBSERVATIONS})")
def flatten_weather(spark, sf):
    return observations(spark, sf).distinct()


DAILY_SQL = f"""
    select icao, dt::date::varchar as day, round(avg(temp), 8) as mean_temp, max(temp) as high, count(*) as n
    from ({OBSERVATIONS}) where temp < 999 group by 1, 2
"""


@query("flatten_agg", DAILY_SQL)
def flatten_agg(spark, sf):
    return observations(spark, sf).where("temp < 999").groupBy("icao", F.to_date("dt").cast("string").alias("day")).agg(
        F.round(F.avg("temp"), 8).alias("mean_temp"), F.max("temp").alias("high"), F.count("*").alias("n"))


@query("object_to_columns", """
    select o_orderkey::varchar as txn, o_custkey as customer, o_orderstatus as status, o_totalprice as total,
           o_orderdate as made, o_orderpriority as priority from orders
""")
def object_to_columns(spark, sf):
    objects = table(spark, sf, "orders").select(F.to_json(F.struct(
        F.col("o_orderkey").alias("TXN"), F.col("o_custkey").alias("CUSTOMER"), F.col("o_orderstatus").alias("STATUS"),
        F.col("o_totalprice").alias("TOTAL"), F.col("o_orderdate").cast("string").alias("MADE"),
        F.col("o_orderpriority").alias("PRIORITY"))).alias("data"))
    schema = T.StructType([
        T.StructField("TXN", T.StringType()), T.StructField("CUSTOMER", T.LongType()), T.StructField("STATUS", T.StringType()),
        T.StructField("TOTAL", T.DoubleType()), T.StructField("MADE", T.TimestampNTZType()),
        T.StructField("PRIORITY", T.StringType()),
    ])
    parsed = objects.select(F.from_json("data", schema, {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}).alias("o"))
    return parsed.select(*[F.col(f"o.{f.name}").alias(f.name.lower()) for f in schema])


@query("array_pack", """
    select l_returnflag, n::bigint as n, round(a, 2) as a, round(b, 2) as b from (
        select l_returnflag, count(*) as n, sum(l_quantity + l_tax) as a, max(greatest(l_quantity, l_discount, l_tax)) as b
        from lineitem group by 1)
""")
def array_pack(spark, sf):
    packed = table(spark, sf, "lineitem").select(
        "l_returnflag", F.array("l_quantity", "l_discount", "l_tax").alias("features"))
    return packed.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.round(F.sum(F.col("features")[0] + F.col("features")[2]), 2).alias("a"),
        F.round(F.max(F.array_max("features")), 2).alias("b"))


@query("array_unpack", """
    select vec_id, unnest(range(len(embedding)))::integer as index, unnest(embedding) as value from embeddings
""")
def array_unpack(spark, sf):
    return flatten(table(spark, sf, "embeddings"), "embedding", ["vec_id"])


@query("parse_json_rows", """
    select doc_id, value from (select doc_id, unnest([doc_id, n_chars, 7]) as value from documents)
""")
def parse_json_rows(spark, sf):
    texts = table(spark, sf, "documents").select(
        "doc_id", F.to_json(F.array("doc_id", "n_chars", F.lit(7).cast("bigint"))).alias("numbers"))
    return json_array_rows(texts, "numbers", "bigint", ["doc_id"]).select("doc_id", "value")


@query("split_to_table", """
    select p_partkey, (unnest(range(len(w))))::integer as index, unnest(w) as value
    from (select p_partkey, string_split(p_name, ' ') as w from part)
""")
def split_to_table(spark, sf):
    return split_to_rows(table(spark, sf, "part"), "p_name", " ", ["p_partkey"])


@query("table_fn_call", """
    select p_size as num, name, round(value, 6) as value from (
        select p_size, unnest(['number', 'square_root', 'square', 'cube', 'ln', 'log_10', 'sine', 'cosine', 'tangent']) as name,
               unnest([p_size, sqrt(p_size), p_size * p_size, p_size ** 3, ln(p_size), log10(p_size), sin(p_size), cos(p_size), tan(p_size)]) as value
        from (select distinct p_size from part))
""")
def table_fn_call(spark, sf):
    from millrace.functions.udfs import NumberFacts

    spark.udtf.register("number_facts", NumberFacts)
    table(spark, sf, "part").select(F.col("p_size").cast("double").alias("num")).distinct().createOrReplaceTempView("sizes")
    return spark.sql("""
        SELECT cast(f.num AS int) AS num, f.name, round(f.value, 6) AS value FROM sizes s, LATERAL number_facts(s.num) f
    """)
