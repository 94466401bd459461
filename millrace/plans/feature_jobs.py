"""Feature jobs: order features, point-in-time retrieval, reports and scoring."""

from __future__ import annotations

from datetime import date

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.features.transformers import OneHotEncoder
from millrace.features.views import Entity, FeatureStore, FeatureView, latest_spine
from millrace.functions.scalars import flag, ratio
from millrace.functions.text import lexicon_frame, sentiment_scores
from millrace.models.fits import balanced_logistic, boosted_classifier, forest, score
from millrace.models.registry import ModelStore, probabilities, register_sql_model
from millrace.operators.asof import point_in_time
from millrace.operators.pairs import dot_pairs
from millrace.plans.registry import query
from millrace.plans.text_jobs import SCORES_SQL
from millrace.session import register_views, scratch_dir, spread, table
from millrace.sources.writers import write

# ---- flagship -------------------------------------------------------------------------------

TOP_SQL = """
    select c.c_name as customer_name, s.oc as order_line_count, s.ck as customer_id, s.ok as order_id,
           s.tq::integer as lineitem_quantity_sum
    from customer c join (
        select c_custkey as ck, o_orderkey as ok, sum(l_quantity) as tq, count(o_orderkey) as oc
        from lineitem join orders on l_orderkey = o_orderkey join customer on c_custkey = o_custkey
        group by c_custkey, o_orderkey having sum(l_quantity) > 100) s on c.c_custkey = s.ck
    order by lineitem_quantity_sum desc, order_line_count desc, customer_id, order_id limit 10
"""


@query("top_quantity_orders", TOP_SQL)
def top_quantity_orders(spark, sf):
    """Largest orders over 100 units. Lines are totalled per order before anything is joined."""
    lines, orders, customers = (table(spark, sf, n) for n in ("lineitem", "orders", "customer"))
    totals = lines.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"), F.count("*").alias("order_line_count"))
    return (
        totals.where("q > 100")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("c_name").alias("customer_name"), F.col("o_orderkey").alias("order_id"), "order_line_count",
                F.col("c_custkey").alias("customer_id"), F.col("q").cast("int").alias("lineitem_quantity_sum"))
        .orderBy(F.desc("lineitem_quantity_sum"), F.desc("order_line_count"), "customer_id", "order_id")
        .limit(10)
    )


@query("top_quantity_orders_sql", TOP_SQL)
def top_quantity_orders_sql(spark, sf):
    register_views(spark, sf, "lineitem", "orders", "customer")
    return spark.sql("""
        WITH s AS (SELECT l_orderkey, sum(l_quantity) AS q, count(*) AS order_line_count
                   FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 100)
        SELECT c_name AS customer_name, order_line_count, c_custkey AS customer_id, o_orderkey AS order_id,
               cast(q AS int) AS lineitem_quantity_sum
        FROM s JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
        ORDER BY lineitem_quantity_sum DESC, order_line_count DESC, customer_id, order_id LIMIT 10
    """)


@query("customer_totals", """
    select c_name as customer_name, count(o_orderkey) as num_orders,
           coalesce(sum(o_totalprice::decimal(15, 2)), 0)::decimal(38, 2)::double as total_revenue
    from customer left join orders on c_custkey = o_custkey group by 1
""")
def customer_totals(spark, sf):
    """Orders and revenue per customer, customers without orders kept at zero. Totals are added up as decimals."""
    per_key = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(15,2)")).cast("decimal(38,2)").alias("total"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return customers.join(per_key, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy(
        F.col("c_name").alias("customer_name")
    ).agg(F.sum(F.coalesce("n", F.lit(0))).alias("num_orders"), F.coalesce(F.sum("total"), F.lit(0)).cast("double").alias("total_revenue"))


# ---- order features -------------------------------------------------------------------------

RETURNS_SQL = """
    select l_orderkey as back_order, l_partkey as back_part, sum(l_quantity) as back_quantity
    from lineitem where l_returnflag = 'R' group by 1, 2
"""

RAW_SQL = """
    select o_orderkey, coalesce(o_custkey, 0) as o_custkey, coalesce(o_orderdate::date, date '1970-01-01')::varchar as order_date,
           l_partkey, l_extendedprice / l_quantity as price, l_quantity, coalesce(back_quantity, 0.0) as back_quantity
    from lineitem {how} join (""" + RETURNS_SQL + """) on l_orderkey = back_order and l_partkey = back_part
    join orders on l_orderkey = o_orderkey
"""


def lines_and_returns(spark, sf) -> DataFrame:
    """Each line with what was returned of its order and product; NULL where nothing was."""
    lines = table(spark, sf, "lineitem")
    returns = lines.where("l_returnflag = 'R'").groupBy(
        F.col("l_orderkey").alias("back_order"), F.col("l_partkey").alias("back_part")
    ).agg(F.sum("l_quantity").alias("back_quantity"))
    on = (F.col("l_orderkey") == F.col("back_order")) & (F.col("l_partkey") == F.col("back_part"))
    return lines.select(
        "l_orderkey", "l_partkey", "l_quantity", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price")
    ).join(returns, on, "left")


def order_key(all_lines: bool) -> str:
    """The column an order is found by.

    By the key of the return, lines without a return drop out: the outer join before it is an inner
    one in effect. By the key of the line, they stay, with 0 returned.
    """
    return "l_orderkey" if all_lines else "back_order"


def order_lines(spark, sf, all_lines: bool) -> DataFrame:
    """Lines with their returns and their order, defaults filled in."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines_and_returns(spark, sf).join(orders, F.col(order_key(all_lines)) == F.col("o_orderkey")).select(
        "o_orderkey", "o_custkey", "o_orderdate", "l_partkey", "price", "l_quantity", "back_quantity"
    ).withColumns({
        "o_custkey": F.coalesce("o_custkey", F.lit(0)),
        "order_date": F.coalesce(F.to_date("o_orderdate"), F.lit(date(1970, 1, 1))),
        "back_quantity": F.coalesce("back_quantity", F.lit(0.0)),
    }).drop("o_orderdate")


def _shown(lines: DataFrame) -> DataFrame:
    return lines.withColumn("order_date", F.col("order_date").cast("string"))


@query("feat_raw_join", RAW_SQL.format(how=""))
def feat_raw_join(spark, sf):
    return _shown(order_lines(spark, sf, all_lines=False))


@query("feat_raw_join_all", RAW_SQL.format(how="left"))
def feat_raw_join_all(spark, sf):
    return _shown(order_lines(spark, sf, all_lines=True))


def customer_features(spark, sf, all_lines: bool) -> DataFrame:
    """Yearly order frequency, mean return ratio per order, and latest order date of each customer.

    Lines are read once: per order and product they give what was sold, their prices added up, and what
    came back; per order that gives both sides of the ratio. The ratio is then carried as a sum and a
    count, so both averages come from one walk per order, per customer and year, per customer.
    """
    price, back = F.col("l_extendedprice") / F.col("l_quantity"), F.col("l_returnflag") == "R"
    products = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_partkey").agg(
        F.sum(F.col("l_quantity") * price).alias("sold"), F.sum(price).alias("prices"),
        F.sum(F.when(back, F.col("l_quantity"))).alias("back_quantity"), F.count_if(back).alias("n_back"))
    if not all_lines:
        products = products.where("n_back > 0 and l_partkey is not null")
    returned = F.when(F.col("l_partkey").isNotNull(), F.col("back_quantity"))
    totals = products.groupBy("l_orderkey").agg(
        F.sum("sold").alias("sold"), F.sum(F.coalesce(returned, F.lit(0.0)) * F.col("prices")).alias("returned"))
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.coalesce("o_custkey", F.lit(0)).alias("o_custkey"),
        F.coalesce(F.to_date("o_orderdate"), F.lit(date(1970, 1, 1))).alias("order_date"))
    per_order = totals.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("ratio", ratio("returned", "sold"))
    per_year = per_order.groupBy("o_custkey", F.year("order_date").alias("order_year")).agg(
        F.count("*").alias("n"), F.sum("ratio").alias("ratios"), F.count("ratio").alias("n_ratios"),
        F.max("order_date").alias("latest"))
    return per_year.groupBy("o_custkey").agg(
        F.avg("n").alias("frequency"), ratio(F.sum("ratios"), F.sum("n_ratios")).alias("return_ratio"),
        F.max("latest").alias("latest_order_date"))


RFM_SQL = """
    with raw as (select o_orderkey, o_custkey, o_orderdate::date as order_date, l_extendedprice / l_quantity as price, l_quantity,
                        coalesce(back_quantity, 0.0) as rq
                 from lineitem {how} join (""" + RETURNS_SQL + """) on l_orderkey = back_order and l_partkey = back_part
                 join orders on l_orderkey = o_orderkey),
    g as (select o_custkey, o_orderkey, sum(l_quantity * price) as sold, sum(rq * price) as returned,
                 min(year(order_date)) as y, max(order_date) as latest from raw group by 1, 2),
    r as (select o_custkey, avg(returned / nullif(sold, 0)) as return_ratio, max(latest) as latest from g group by 1),
    f as (select o_custkey, avg(n) as frequency from (select o_custkey, y, count(*) as n from g group by 1, 2) group by 1)
    select o_custkey, round(frequency, 6) as frequency, round(return_ratio, 6) as return_ratio, latest::varchar as latest_order_date
    from f join r using (o_custkey)
"""


def _rounded_features(features: DataFrame) -> DataFrame:
    return features.withColumns({
        "frequency": F.round("frequency", 6), "return_ratio": F.round("return_ratio", 6),
        "latest_order_date": F.col("latest_order_date").cast("string")})


@query("feat_customer_rfm", RFM_SQL.format(how=""))
def feat_customer_rfm(spark, sf):
    return _rounded_features(customer_features(spark, sf, all_lines=False))


@query("feat_customer_rfm_all", RFM_SQL.format(how="left"))
def feat_customer_rfm_all(spark, sf):
    return _rounded_features(customer_features(spark, sf, all_lines=True))


# ---- feature store --------------------------------------------------------------------------

CUSTOMER = Entity("customer", ("o_custkey",), "a buying customer")
DESCRIPTIONS = {"frequency": "Average yearly order count", "return_ratio": "Mean share of an order's value that was returned"}


def customer_view(spark, sf) -> FeatureView:
    frame = customer_features(spark, sf, all_lines=True)
    return FeatureView("customer_habits", CUSTOMER, frame, "latest_order_date", "Buying habits").describe_features(DESCRIPTIONS)


@query("entity", """
    select 'customer_habits' as name, 'V_1' as version, 'customer' as entity, 'o_custkey' as keys, count(*) as n_rows
    from (select distinct o_custkey from orders join lineitem on l_orderkey = o_orderkey)
""")
def entity(spark, sf):
    store = FeatureStore(spark, scratch_dir(spark, "store"))
    view = store.register(customer_view(spark, sf), "V_1")
    rows = view.frame.agg(F.count("*").alias("n_rows"))
    return store.list_views().select("name", "version", "entity", "keys", rows.scalar().alias("n_rows"))


@query("feature_view", RFM_SQL.format(how="left"))
def feature_view(spark, sf):
    store = FeatureStore(spark, scratch_dir(spark, "store"))
    store.get_or_register(customer_view(spark, sf), "V_1")
    return _rounded_features(store.get("customer_habits", "V_1").frame)


@query("read_feature_view", RFM_SQL.format(how="left"))
def read_feature_view(spark, sf):
    store = FeatureStore(spark, scratch_dir(spark, "store"))
    store.register(customer_view(spark, sf), "V_1")
    return _rounded_features(store.read("customer_habits"))


@query("feature_slice", "select o_custkey, latest_order_date, frequency from (" + RFM_SQL.format(how="left") + ")")
def feature_slice(spark, sf):
    view = customer_view(spark, sf).slice(["frequency"])
    return view.frame.withColumns({
        "frequency": F.round("frequency", 6), "latest_order_date": F.col("latest_order_date").cast("string")})


@query("spine", "select user_id, max(ts) as asof from events where event_type = 'click' group by 1")
def spine(spark, sf):
    return latest_spine(table(spark, sf, "events").where("event_type = 'click'"), ["user_id"], "ts")


@query("point_in_time", """
    select s.event_id, s.user_id, s.ts, p.value as last_purchase, e.value as last_error
    from (select event_id, user_id, ts from events where event_type = 'click') s
    asof left join (select user_id, ts, value from events where event_type = 'purchase') p on s.user_id = p.user_id and s.ts >= p.ts
    asof left join (select user_id, ts, value from events where event_type = 'error') e on s.user_id = e.user_id and s.ts >= e.ts
""")
def point_in_time_query(spark, sf):
    events = table(spark, sf, "events")

    def kind(name: str, feature: str):
        frame = events.where(F.col("event_type") == name).select("user_id", F.col("ts").alias("at"), F.col("value").alias(feature))
        return frame, ["user_id"], "at", [feature]

    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "ts")
    return point_in_time(clicks, [kind("purchase", "last_purchase"), kind("error", "last_error")], "ts")


@query("feature_dataset", """
    with f as (select o_custkey, o_orderdate, o_totalprice from orders where o_orderpriority = '1-URGENT'
               qualify row_number() over (partition by o_custkey, o_orderdate order by o_totalprice desc) = 1),
    s as (select o_custkey, max(o_orderdate) as asof from orders where o_orderpriority <> '1-URGENT' group by 1)
    select s.o_custkey, s.asof, f.o_totalprice as last_urgent_price from s asof left join f
    on s.o_custkey = f.o_custkey and s.asof >= f.o_orderdate
""")
def feature_dataset(spark, sf):
    """Spine, point-in-time values, and an immutable dataset of both."""
    store = FeatureStore(spark, scratch_dir(spark, "store"))
    orders = table(spark, sf, "orders")
    urgent = orders.where("o_orderpriority = '1-URGENT'").groupBy("o_custkey", "o_orderdate").agg(
        F.max("o_totalprice").alias("last_urgent_price"))
    view = store.register(FeatureView("urgent", CUSTOMER, urgent, "o_orderdate"), "V_1")
    moments = latest_spine(orders.where("o_orderpriority <> '1-URGENT'"), ["o_custkey"], "o_orderdate")
    return store.generate_dataset("training", moments, [view], "asof")


# ---- reports --------------------------------------------------------------------------------

CHURN_FROM = "2001-01-01"
CHURN_SQL = f"""
    select c_custkey as id, (coalesce(max(o_orderdate), timestamp '1970-01-01') < timestamp '{CHURN_FROM}')::integer as target,
           c_acctbal, c_nationkey, c_mktsegment, count(o_orderkey) as n_orders
    from customer left join orders on c_custkey = o_custkey group by c_custkey, c_acctbal, c_nationkey, c_mktsegment
"""


def churn(spark, sf) -> DataFrame:
    """Customers with order counts; ``target`` is 1 for those with no order after a fixed date."""
    habits = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"), F.max("o_orderdate").alias("latest"))
    latest = F.coalesce("latest", F.lit("1970-01-01").cast("timestamp_ntz"))
    return table(spark, sf, "customer").join(habits, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("id"), (latest < F.lit(CHURN_FROM).cast("timestamp_ntz")).cast("int").alias("target"),
        "c_acctbal", "c_nationkey", "c_mktsegment", F.coalesce("n_orders", F.lit(0).cast("bigint")).alias("n_orders"))


@query("feat_churn_vector", f"""
    select id, target, n_orders::double as f1, c_acctbal as f2, (c_mktsegment = 'BUILDING')::integer::double as f3,
           (n_orders >= 10)::integer::double as f4, (c_nationkey = 3)::integer::double as f5 from ({CHURN_SQL})
""")
def feat_churn_vector(spark, sf):
    """Cast, binarised and one-hot features packed as one array, kept under a view name."""
    packed = churn(spark, sf).select("id", "target", F.array(
        F.col("n_orders").cast("double"), F.col("c_acctbal"), flag(F.col("c_mktsegment") == "BUILDING"),
        flag(F.col("n_orders") >= 10), flag(F.col("c_nationkey") == 3)).alias("features"))
    packed.createOrReplaceTempView("churn_features")
    return spark.table("churn_features").select("id", "target", *[F.col("features")[i].alias(f"f{i + 1}") for i in range(5)])


@query("tidy_daily", """
    select ts::date::varchar as day, round(avg(value), 6) as mean_value from events where value < 300 group by 1
""")
def tidy_daily(spark, sf):
    return (
        table(spark, sf, "events").where("value < 300").groupBy(F.to_date("ts").cast("string").alias("day")).avg("value")
        .withColumnRenamed("avg(value)", "mean_value").withColumn("mean_value", F.round("mean_value", 6))
    )


@query("flights_weather", """
    select a.day, errors, round(low, 2) as low, round(high, 2) as high, round(mean, 6) as mean from
      (select ts::date::varchar as day, count(*) as errors from events where event_type = 'error' group by 1) a
      join (select ts::date::varchar as day, min(value) as low, max(value) as high, avg(value) as mean
            from events where event_type <> 'error' group by 1) b on a.day = b.day
    order by errors desc, a.day
""")
def flights_weather(spark, sf):
    """Two daily aggregates joined on the day; both sides shrink to one row per day first."""
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts").cast("string"))
    errors = events.where("event_type = 'error'").groupBy("day").agg(F.count("*").alias("errors"))
    others = events.where("event_type <> 'error'").groupBy("day").agg(
        F.round(F.min("value"), 2).alias("low"), F.round(F.max("value"), 2).alias("high"), F.round(F.avg("value"), 6).alias("mean"))
    return errors.join(others, "day").orderBy(F.desc("errors"), "day")


@query("sentiment_by_group", f"""
    select source || ' (' || count(*) || ')' as annotated_name,
           sum(case sentiment when 'POSITIVE' then 1 when 'NEGATIVE' then -1 else 0 end)::bigint as net_sentiment
    from ({SCORES_SQL.format(keys='doc_id', table='documents')}) join documents using (doc_id) group by source
""")
def sentiment_by_group(spark, sf):
    documents = spread(table(spark, sf, "documents").select("doc_id", "source", "text"))
    scores = sentiment_scores(documents, ["doc_id", "source"], "text", lexicon_frame(spark))
    points = F.when(F.col("sentiment") == "NEGATIVE", -1).when(F.col("sentiment") == "POSITIVE", 1).otherwise(0)
    return scores.groupBy("source").agg(F.count("*").alias("n"), F.sum(points).alias("net_sentiment")).select(
        F.concat("source", F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("annotated_name"), "net_sentiment"
    ).orderBy(F.desc("net_sentiment"), "annotated_name")


REVIEWS_SQL = """
    select conv_id, turn, text as review, sentiment from conversations
    join (""" + SCORES_SQL.format(keys="conv_id, turn", table="conversations") + """) using (conv_id, turn) where {where}
"""


def _reviews(spark, sf, condition):
    turns = table(spark, sf, "conversations").where(condition).select("conv_id", "turn", "text")
    scores = sentiment_scores(turns, ["conv_id", "turn"], "text", lexicon_frame(spark))
    return scores.select("conv_id", "turn", "sentiment").join(turns, ["conv_id", "turn"]).withColumnRenamed("text", "review")


@query("reviews_of", REVIEWS_SQL.format(where="role like 'assist%'"))
def reviews_of(spark, sf):
    return _reviews(spark, sf, F.col("role").like("assist%"))


@query("reviews_whole", REVIEWS_SQL.format(where="turn = 0"))
def reviews_whole(spark, sf):
    return _reviews(spark, sf, F.col("turn") == 0)


@query("get_dummies", f"""
    select id, n_orders, (c_mktsegment = 'AUTOMOBILE')::integer::double as segment_AUTOMOBILE,
           (c_mktsegment = 'BUILDING')::integer::double as segment_BUILDING,
           (c_mktsegment = 'FURNITURE')::integer::double as segment_FURNITURE,
           (c_mktsegment = 'HOUSEHOLD')::integer::double as segment_HOUSEHOLD,
           (c_mktsegment = 'MACHINERY')::integer::double as segment_MACHINERY
    from ({CHURN_SQL}) where n_orders >= 10
""")
def get_dummies(spark, sf):
    """Fitted on the training rows; rows to score get the same columns in the same order."""
    customers = churn(spark, sf).select("id", "n_orders", "c_mktsegment")
    encoder = OneHotEncoder(["c_mktsegment"], ["segment"], drop_input_cols=True).fit(customers.where("n_orders < 10"))
    return encoder.transform(customers.where("n_orders >= 10"))


@query("score_pairs", """
    with n as (select count(*) as n from embeddings),
    v as (select vec_id, embedding::double[] as v from embeddings),
    p as (select o_orderkey, o_custkey % n as u, o_orderkey % n as i from orders, n)
    select o_orderkey, round(list_inner_product(a.v, b.v), 4) as prediction
    from p join v a on a.vec_id = u join v b on b.vec_id = i
""")
def score_pairs(spark, sf):
    """Predicted rating of any number of (user, item) pairs: two key joins and a dot product."""
    factors = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("v"))
    n = factors.agg(F.count("*").alias("n")).scalar()
    pairs = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_custkey") % n).alias("u"), (F.col("o_orderkey") % n).alias("i"))
    scored = dot_pairs(pairs, "u", "i", factors.withColumnRenamed("vec_id", "u"), factors.withColumnRenamed("vec_id", "i"))
    return scored.select("o_orderkey", F.round("prediction", 4).alias("prediction"))


SCORED_SQL = "select c_custkey as id, true as sums_to_one, true as likelier_class from customer"


def checked_scores(scored: DataFrame) -> DataFrame:
    """Per scored row, whether its probabilities are shares of one and its class is the likelier one."""
    likelier = F.when(F.col("probability_1") > F.col("probability_0"), 1.0).when(F.col("probability_1") < F.col("probability_0"), 0.0)
    return scored.select(
        "id", (F.col("probability_0").between(0, 1) & (F.abs(F.col("probability_0") + F.col("probability_1") - 1) < 1e-9)).alias("sums_to_one"),
        (F.col("prediction") == F.coalesce(likelier, "prediction")).alias("likelier_class"))


@query("score_batch", SCORED_SQL)
def score_batch(spark, sf):
    """Id, class probabilities and class of every customer, written; read again and checked."""
    data = churn(spark, sf)
    model = balanced_logistic(["c_acctbal", "n_orders"], "target").fit(data)
    scored = probabilities(model.transform(data), ["id"])
    return checked_scores(write(scored, scratch_dir(spark, "scores")))


@query("score_in_sql", "select c_custkey as id, true as same_v1, true as same_default from customer")
def score_in_sql(spark, sf):
    """Stored versions called from SQL; each gives what scoring the frame gives."""
    data = churn(spark, sf)
    models = ModelStore(spark, scratch_dir(spark, "models"))
    models.save("churn", "v1", balanced_logistic(["n_orders"], "target").fit(data))
    models.save("churn", "v2", balanced_logistic(["c_acctbal", "n_orders"], "target").fit(data))
    first, newest = models.load("churn", "v1"), models.load("churn")
    register_sql_model(spark, "churn_v1", first)
    register_sql_model(spark, "churn_default", newest)
    data.createOrReplaceTempView("churn_customers")
    called = spark.sql("SELECT id, churn_v1(n_orders) AS v1, churn_default(c_acctbal, n_orders) AS newest FROM churn_customers")
    direct = [
        probabilities(model.transform(data), ["id"]).select("id", F.col("probability_1").alias(name))
        for model, name in ((first, "direct_v1"), (newest, "direct_newest"))
    ]
    return called.join(direct[0], "id").join(direct[1], "id").select(
        "id", (F.abs(F.col("v1") - F.col("direct_v1")) < 1e-9).alias("same_v1"),
        (F.abs(F.col("newest") - F.col("direct_newest")) < 1e-9).alias("same_default"))


@query("score_trees_in_sql", "select c_custkey as id, true as same_v1, true as same_v2, true as same_default from customer")
def score_trees_in_sql(spark, sf):
    """Three stored versions, two boosted and the newest a forest, called from SQL by version; each gives what scoring the frame gives."""
    data, inputs = churn(spark, sf), ["c_acctbal", "c_nationkey", "n_orders"]
    models = ModelStore(spark, scratch_dir(spark, "models"))
    models.save("churn", "v1", boosted_classifier(inputs[1:], "target", rounds=10, depth=3).fit(data))
    models.save("churn", "v2", boosted_classifier(inputs, "target", rounds=10, depth=4).fit(data))
    models.save("churn", "v3", forest(inputs, "target", trees=20, depth=4).fit(data))
    customers = spread(data)
    customers.createOrReplaceTempView("churn_customers")
    out, calls = customers, []
    for name, version in (("v1", "v1"), ("v2", "v2"), ("default", None)):
        model = models.load("churn", version)
        used = register_sql_model(spark, f"churn_trees_{name}", model)
        calls.append(f"churn_trees_{name}({', '.join(used)}) AS {name}")
        direct = probabilities(model.transform(data), ["id"]).select(F.col("id").alias(f"id_{name}"), F.col("probability_1").alias(f"direct_{name}"))
        out = out.join(direct, F.col("id") == F.col(f"id_{name}")).drop(f"id_{name}")
    called = spark.sql(f"SELECT id AS called_id, {', '.join(calls)} FROM churn_customers")
    same = [(F.abs(F.col(n) - F.col(f"direct_{n}")) < 1e-9).alias(f"same_{n}") for n in ("v1", "v2", "default")]
    return out.join(called, F.col("id") == F.col("called_id")).select("id", *same)


@query("score_by_version", """
    select version, inputs, count(*) as n from customer, (values ('v1', 1), ('default', 2)) v(version, inputs) group by 1, 2
""")
def score_by_version(spark, sf):
    """Two stored versions of one model, of one and two inputs; the default is the newest. Each scores all customers."""
    data = churn(spark, sf)
    models = ModelStore(spark, scratch_dir(spark, "models"))
    models.save("churn", "v1", balanced_logistic(["n_orders"], "target").fit(data))
    models.save("churn", "v2", balanced_logistic(["c_acctbal", "n_orders"], "target").fit(data))
    scored = [
        score(models.load("churn", version), data).select(
            F.lit(label).alias("version"), F.size(vector_to_array("features")).alias("inputs"), "prediction")
        for version, label in (("v1", "v1"), (None, "default"))
    ]
    return scored[0].unionByName(scored[1]).where("prediction in (0, 1)").groupBy("version", "inputs").agg(F.count("*").alias("n"))


