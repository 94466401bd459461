"""Feature transformers on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.features import transformers as tr
from millrace.features.steps import ColumnTransformer, Pipeline
from millrace.plans.registry import query
from millrace.session import table


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax")


KEY = "l_orderkey, l_partkey, l_linenumber"
KEYS = ["l_orderkey", "l_partkey", "l_linenumber"]


def _shown(df, names):
    return df.select(*KEYS, *[F.round(n, 6).alias(n) for n in names])


@query("min_max_scale", f"""
    with s as (select min(l_quantity) as a, max(l_quantity) as b, min(l_extendedprice) as c, max(l_extendedprice) as d from lineitem)
    select {KEY}, round((l_quantity - a) / (b - a), 6) as quantity, round((l_extendedprice - c) / (d - c), 6) as price from lineitem, s
""")
def min_max_scale(spark, sf):
    scaler = tr.MinMaxScaler(["l_quantity", "l_extendedprice"], ["quantity", "price"], clip=True)
    return _shown(scaler.fit_transform(_lines(spark, sf)), ["quantity", "price"])


@query("standard_scale", f"""
    with s as (select avg(l_quantity) as m, stddev_pop(l_quantity) as d, avg(l_extendedprice) as n, stddev_pop(l_extendedprice) as e from lineitem)
    select {KEY}, round((l_quantity - m) / d, 6) as quantity, round((l_extendedprice - n) / e, 6) as price from lineitem, s
""")
def standard_scale(spark, sf):
    scaler = tr.StandardScaler(["l_quantity", "l_extendedprice"], ["quantity", "price"])
    return _shown(scaler.fit_transform(_lines(spark, sf)), ["quantity", "price"])


@query("robust_scale", f"""
    with s as (select quantile_cont(l_quantity, 0.5) as m, quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25) as w,
                      quantile_cont(l_extendedprice, 0.5) as n, quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25) as v
               from lineitem)
    select {KEY}, round((l_quantity - m) / w, 6) as quantity, round((l_extendedprice - n) / v, 6) as price from lineitem, s
""")
def robust_scale(spark, sf):
    scaler = tr.RobustScaler(["l_quantity", "l_extendedprice"], ["quantity", "price"])
    return _shown(scaler.fit_transform(_lines(spark, sf)), ["quantity", "price"])


@query("max_abs_scale", """
    with s as (select max(abs(c_acctbal)) as m from customer)
    select c_custkey, round(c_acctbal / m, 6) as balance from customer, s
""")
def max_abs_scale(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    scaled = tr.MaxAbsScaler(["c_acctbal"], ["balance"], drop_input_cols=True).fit_transform(customers)
    return scaled.withColumn("balance", F.round("balance", 6))


@query("normalize_rows", f"""
    with n as (select {KEY}, l_quantity as q, l_extendedprice as p, sqrt(l_quantity * l_quantity + l_extendedprice * l_extendedprice) as l from lineitem)
    select {KEY}, round(q / l, 6) as quantity, round(p / l, 6) as price from n
""")
def normalize_rows(spark, sf):
    normalizer = tr.Normalizer(["l_quantity", "l_extendedprice"], ["quantity", "price"], norm="l2")
    return _shown(normalizer.fit_transform(_lines(spark, sf)), ["quantity", "price"])


@query("ordinal_encode", """
    select o_orderkey, case o_orderpriority when '5-LOW' then 0.0 when '4-NOT SPECIFIED' then 1.0 when '3-MEDIUM' then 2.0
           when '2-HIGH' then 3.0 else 4.0 end::double as priority,
           case o_orderstatus when 'F' then 0.0 when 'O' then 1.0 else 2.0 end::double as status from orders
""")
def ordinal_encode(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    order = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]
    return tr.OrdinalEncoder(
        ["o_orderpriority", "o_orderstatus"], ["priority", "status"], drop_input_cols=True, categories={"o_orderpriority": order}
    ).fit_transform(orders)


@query("label_encode", """
    select p_partkey, dense_rank() over (order by p_brand) - 1 as brand, dense_rank() over (order by p_name) - 1 as name from part
""")
def label_encode(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    return tr.LabelEncoder(["p_brand", "p_name"], ["brand", "name"], drop_input_cols=True).fit_transform(parts)


@query("one_hot", """
    select o_orderkey, (o_orderstatus = 'F')::integer::double as status_F, (o_orderstatus = 'O')::integer::double as status_O,
           (o_orderstatus = 'P')::integer::double as status_P from orders
""")
def one_hot(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return tr.OneHotEncoder(["o_orderstatus"], ["status"], drop_input_cols=True).fit_transform(orders)


@query("k_bins", """
    with s as (select min(c_acctbal) as a, max(c_acctbal) as b, quantile_cont(c_acctbal, 0.25) as q1, quantile_cont(c_acctbal, 0.5) as q2,
                      quantile_cont(c_acctbal, 0.75) as q3 from customer)
    select c_custkey, least(floor((c_acctbal - a) / ((b - a) / 4)), 3)::double as even,
           ((c_acctbal >= q1)::int + (c_acctbal >= q2)::int + (c_acctbal >= q3)::int)::double as full from customer, s
""")
def k_bins(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    even = tr.KBinsDiscretizer(["c_acctbal"], ["even"], n_bins=4, strategy="uniform").fit_transform(customers)
    return tr.KBinsDiscretizer(["c_acctbal"], ["full"], n_bins=4, strategy="quantile", drop_input_cols=True).fit_transform(even)


@query("binarize", "select c_custkey, (c_acctbal > 1000)::integer::double as rich from customer")
def binarize(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return tr.Binarizer(["c_acctbal"], ["rich"], drop_input_cols=True, threshold=1000.0).fit_transform(customers)


@query("polynomial", f"""
    select {KEY}, 1.0::double as "1", l_quantity, l_tax, l_quantity * l_quantity as "l_quantity^2", round(l_quantity * l_tax, 6) as "l_quantity l_tax",
           round(l_tax * l_tax, 6) as "l_tax^2" from lineitem
""")
def polynomial(spark, sf):
    made = tr.PolynomialFeatures(["l_quantity", "l_tax"], degree=2).fit_transform(
        table(spark, sf, "lineitem").select(*KEYS, "l_quantity", "l_tax"))
    return made.withColumns({c: F.round(f"`{c}`", 6) for c in ("l_quantity l_tax", "l_tax^2")})


@query("custom_transformer", "select p_partkey, upper(p_name) as p_name, upper(p_type) as kind from part")
def custom_transformer(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    upper = tr.UpperCase(["p_name", "p_type"], ["p_name", "kind"], drop_input_cols=True)
    return upper.fit_transform(parts)


@query("fit_transform_steps", """
    with train as (select * from orders where o_orderstatus <> 'P'),
    s as (select min(o_totalprice) as a, max(o_totalprice) as b from train)
    select o_orderkey, round(least(greatest((o_totalprice - a) / (b - a), 0), 1), 6) as price,
           (o_orderpriority = '1-URGENT')::integer::double as "p_1-URGENT", (o_orderpriority = '2-HIGH')::integer::double as "p_2-HIGH",
           (o_orderpriority = '3-MEDIUM')::integer::double as "p_3-MEDIUM",
           (o_orderpriority = '4-NOT SPECIFIED')::integer::double as "p_4-NOT SPECIFIED", (o_orderpriority = '5-LOW')::integer::double as "p_5-LOW"
    from orders, s where o_orderstatus = 'P'
""")
def fit_transform_steps(spark, sf):
    """Fitted on finished and open orders, applied to the others."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    steps = Pipeline([
        ("encode", ColumnTransformer([
            ("num", tr.MinMaxScaler(["o_totalprice"], ["price"], drop_input_cols=True, clip=True), None),
            ("cat", tr.OneHotEncoder(["o_orderpriority"], ["p"], drop_input_cols=True), None),
        ])),
    ]).fit(orders.where("o_orderstatus <> 'P'"))
    return steps.transform(orders.where("o_orderstatus = 'P'")).drop("o_orderstatus").withColumn("price", F.round("price", 6))
