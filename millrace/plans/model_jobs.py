"""Model fitting and metrics as distributed jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.features import selection
from millrace.features.steps import ColumnTransformer, Pipeline
from millrace.features.transformers import MinMaxScaler, OneHotEncoder
from millrace.models import boosting, factors, fits, metrics
from millrace.models.registry import probabilities
from millrace.models.trees import predict
from millrace.plans.feature_jobs import SCORED_SQL, checked_scores, churn, customer_features
from millrace.plans.registry import query
from millrace.session import scratch_dir, spread, table
from millrace.sources.writers import write


def _points(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", (F.lit(37.0) + F.col("c_acctbal") / 10000.0).alias("lat"), (F.lit(-122.4) + F.col("c_nationkey") / 25.0).alias("lon"))


@query("kmeans", """
    select 3::bigint as clusters, count(*) as rows, round(avg(37.0 + c_acctbal / 10000.0), 4) as lat, round(avg(-122.4 + c_nationkey / 25.0), 4) as lon from customer
""")
def kmeans(spark, sf):
    """Best of ten starts. The clusters share out all rows, and their centres balance at the mean of the points."""
    points = _points(spark, sf)
    model = fits.kmeans(["lat", "lon"], k=3, seed=0).fit(points)
    report = fits.cluster_report(model, fits.score(model, points, "cluster"), ["lat", "lon"])
    mean = lambda c: F.round(F.sum(F.col(c) * F.col("n")) / F.sum("n"), 4).alias(c)
    return report.agg(F.count("cluster").alias("clusters"), F.sum("n").alias("rows"), mean("lat"), mean("lon"))


@query("fit_kmeans_scaled", """
    select 5::bigint as clusters, count(distinct o_custkey) as rows, true as inside
    from orders where o_orderkey in (select l_orderkey from lineitem)
""")
def fit_kmeans_scaled(spark, sf):
    """Clusters of scaled features: they share out all customers, and their centres lie in the scaled range."""
    features = write(customer_features(spark, sf, all_lines=True), scratch_dir(spark, "features"))
    scaled = ["scaled_return_share", "scaled_frequency"]
    model = Pipeline([
        ("scale", MinMaxScaler(["return_ratio", "frequency"], scaled, clip=True)), ("cluster", fits.kmeans(scaled, k=5, seed=0)),
    ]).fit(features)
    scored = model.transform(features).withColumn("cluster", F.when(fits.complete(), F.col("cluster")))
    report = fits.cluster_report(model["cluster"], scored, scaled)
    inside = [F.every(F.col("cluster").isNull() | F.col(c).between(0, 1)) for c in scaled]
    return report.agg(F.count("cluster").alias("clusters"), F.sum("n").alias("rows"), (inside[0] & inside[1]).alias("inside"))


@query("linear_fit", """
    select round(regr_slope(l_extendedprice, l_quantity), 4) as slope, round(regr_intercept(l_extendedprice, l_quantity), 3) as intercept,
           round(regr_r2(l_extendedprice, l_quantity), 6) as r2 from lineitem
""")
def linear_fit(spark, sf):
    return fits.linear_one(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice").select(
        F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"), F.round("r2", 6).alias("r2"))


@query("linear_fit_many", """
    with s as (select var_pop(l_quantity) as s11, var_pop(l_discount) as s22, covar_pop(l_quantity, l_discount) as s12,
                      covar_pop(l_quantity, l_extendedprice) as s1y, covar_pop(l_discount, l_extendedprice) as s2y,
                      avg(l_quantity) as m1, avg(l_discount) as m2, avg(l_extendedprice) as my from lineitem),
    b as (select *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) as b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) as b2 from s)
    select '(intercept)' as term, round(my - b1 * m1 - b2 * m2, 2) as value from b
    union all select 'l_quantity', round(b1, 2) from b union all select 'l_discount', round(b2, 2) from b
""")
def linear_fit_many(spark, sf):
    lines, features = table(spark, sf, "lineitem"), ["l_quantity", "l_discount"]
    model = fits.linear_many(lines, features, "l_extendedprice")
    return fits.coefficients(model, lines, features).withColumn("value", F.round("value", 2))


@query("logistic_fit", "select count(*) as rows, true as better_than_chance, true as in_range from customer")
def logistic_fit(spark, sf):
    """Scaled and one-hot features, balanced classes: every row scored, and the classes told apart better than by chance."""
    data = churn(spark, sf)
    prepared = Pipeline([("prepare", ColumnTransformer([
        ("num", MinMaxScaler, ["c_acctbal", "n_orders"]), ("cat", OneHotEncoder(["c_mktsegment"], drop_input_cols=True), None)]))])
    ready = prepared.fit(data).transform(data)
    features = ["c_acctbal", "n_orders", *[c for c in ready.columns if c.startswith("c_mktsegment_")]]
    scored = fits.balanced_logistic(features, "target").fit(ready).transform(ready)
    held = metrics.classification(scored, "target", "prediction")
    by_class = scored.agg(
        F.count("prediction").alias("rows"), F.avg(F.when(F.col("target") == 1, F.col("prediction"))).alias("hit"),
        F.avg(F.when(F.col("target") == 0, F.col("prediction"))).alias("false_alarm"))
    return by_class.crossJoin(F.broadcast(held)).select(
        "rows", (F.col("hit") > F.col("false_alarm")).alias("better_than_chance"),
        (F.col("accuracy").between(0, 1) & F.col("precision").between(0, 1) & (F.col("recall") == F.col("hit")) & F.col("f1").between(0, 1)).alias("in_range"))


NB_SQL = """
    with t as (select count(*) as total from orders)
    select label, round(n / total, 6) as prior, feature, round(mean, 4) as mean, round(variance, 2) as variance from (
        select o_orderstatus as label, count(*) as n, 'o_totalprice' as feature, avg(o_totalprice) as mean, var_pop(o_totalprice) as variance
        from orders group by 1
        union all select o_orderstatus, count(*), 'o_custkey', avg(o_custkey), var_pop(o_custkey) from orders group by 1), t
"""


@query("naive_bayes_fit", NB_SQL)
def naive_bayes_fit(spark, sf):
    return fits.naive_bayes(table(spark, sf, "orders"), ["o_totalprice", "o_custkey"], "o_orderstatus").select(
        "label", F.round("prior", 6).alias("prior"), "feature", F.round("mean", 4).alias("mean"), F.round("variance", 2).alias("variance"))


@query("naive_bayes_predict", """
    with p as (select o_orderstatus as label, ln(count(*) / (select count(*) from orders)) as prior,
                      avg(o_totalprice) as m1, var_pop(o_totalprice) as v1, avg(o_custkey) as m2, var_pop(o_custkey) as v2
               from orders group by 1),
    e as (select 1e-9 * greatest(max(v1), max(v2)) as eps from p),
    s as (select o_orderkey, label, prior - 0.5 * ln(2 * pi() * (v1 + eps)) - pow(o_totalprice - m1, 2) / (2 * (v1 + eps))
                 - 0.5 * ln(2 * pi() * (v2 + eps)) - pow(o_custkey - m2, 2) / (2 * (v2 + eps)) as score from orders, p, e)
    select prediction, count(*) as n from (select o_orderkey, arg_max(label, score) as prediction from s group by 1) group by 1
""")
def naive_bayes_predict(spark, sf):
    orders, features = table(spark, sf, "orders"), ["o_totalprice", "o_custkey"]
    parameters = fits.naive_bayes(orders, features, "o_orderstatus")
    return fits.naive_bayes_predict(orders, parameters, features).groupBy("prediction").agg(F.count("*").alias("n"))


FOREST_FEATURES = ["c_acctbal", "c_nationkey", "n_orders"]


@query("forest_fit", "select unnest(['c_acctbal', 'c_nationkey', 'n_orders']) as feature, true as valid, 1.0::double as total")
def forest_fit(spark, sf):
    """Importances: a share for each feature, one in all."""
    data = churn(spark, sf)
    model = fits.forest(FOREST_FEATURES, "target", trees=300).fit(data)
    shares = fits.importances(model, data, FOREST_FEATURES)
    total = shares.agg(F.round(F.sum("importance"), 6).alias("total"))
    return shares.crossJoin(F.broadcast(total)).select("feature", F.col("importance").between(0, 1).alias("valid"), "total")


@query("boosted_fit", SCORED_SQL)
def boosted_fit(spark, sf):
    data = churn(spark, sf)
    model = fits.boosted_classifier(FOREST_FEATURES, "target", rounds=100).fit(data)
    return checked_scores(probabilities(model.transform(data), ["id"]))


@query("boosted_regression", "select count(*) as rows, true as better_than_mean from part")
def boosted_regression(spark, sf):
    """Every part gets a price, nearer to its own than the mean price is."""
    parts = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", F.length("p_name").alias("name_length"))
    model = fits.boosted_regressor(["p_size", "p_partkey", "name_length"], "p_retailprice", rounds=100).fit(parts)
    scored = fits.score(model, parts)
    return metrics.regression(scored, "p_retailprice", "prediction").crossJoin(
        F.broadcast(scored.agg(F.count("prediction").alias("rows")))).select("rows", (F.col("r2") > 0).alias("better_than_mean"))


ROUNDS, RATES = [50, 100, 200, 300, 400, 500], [0.05, 0.1, 0.2, 0.3, 0.4, 0.5]
PRICE_INPUTS = ["p_partkey", "p_size"]


def _price_search(spark, sf, points) -> boosting.SearchResult:
    """Boosted models of the price, scored by their mean absolute percentage error on rows that were left out."""
    return boosting.boosted_search(
        table(spark, sf, "part"), PRICE_INPUTS, "p_retailprice", ["p_partkey"], points, categories=["p_type"], bins=32, folds=3)


def _error_of_mean(spark, sf):
    parts = table(spark, sf, "part")
    mean = parts.agg(F.avg("p_retailprice").alias("m")).scalar()
    return parts.agg(F.avg(F.abs(F.col("p_retailprice") - mean) / F.col("p_retailprice")).alias("error_of_mean"))


@query("grid_search", f"""
    select rounds, rate::double as rate, true as better_than_mean from (select unnest({ROUNDS}) as rounds), (select unnest({RATES}) as rate)
""")
def grid_search(spark, sf):
    """Six numbers of rounds by six learning rates: each scored on rows it was not fitted on, with a lower percentage error than the mean price."""
    scores = _price_search(spark, sf, [boosting.Point(n, rate, 6) for n in ROUNDS for rate in RATES]).scores
    return scores.crossJoin(F.broadcast(_error_of_mean(spark, sf))).select("rounds", "rate", (F.col("score") < F.col("error_of_mean")).alias("better_than_mean"))


@query("grid_search_best", "select count(*) as rows, true as least_error, true as better_than_mean from part")
def grid_search_best(spark, sf):
    """The best of twelve points, refitted on all parts and applied to them by column expressions."""
    found = _price_search(spark, sf, [boosting.Point(n, rate, 4) for n in (10, 20, 30, 40) for rate in (0.1, 0.3, 0.5)])
    parts = spread(table(spark, sf, "part"))
    priced = predict(boosting.with_categories(parts, found.model), found.model)
    error = F.avg(F.abs(F.col("prediction") - F.col("p_retailprice")) / F.col("p_retailprice"))
    least = found.scores.orderBy("score", "point").limit(1).select(
        ((F.col("rounds") == found.best.rounds) & (F.col("rate") == found.best.rate)).alias("least_error"))
    return priced.agg(F.count("prediction").alias("rows"), error.alias("error")).crossJoin(F.broadcast(least)).crossJoin(
        F.broadcast(_error_of_mean(spark, sf))).select("rows", "least_error", (F.col("error") < F.col("error_of_mean")).alias("better_than_mean"))


@query("grid_search_classes", """
    select row_number() over (order by iter, depth)::integer - 1 as point, 'depth=' || depth || ', rounds=' || iter as params, true as scored, true as best_above_majority
    from (select unnest([10, 25, 50, 100, 150, 200]) as iter), (select unnest([1, 3, 5, 7, 9]) as depth)
""")
def grid_search_classes(spark, sf):
    """Six numbers of rounds by five depths, scored by F1 on rows left out; the best is above the larger class's F1 of zero."""
    points = [boosting.Point(n, 0.3, depth) for n in (10, 25, 50, 100, 150, 200) for depth in (1, 3, 5, 7, 9)]
    scores = boosting.boosted_search(churn(spark, sf), FOREST_FEATURES, "target", ["id"], points, loss="logistic", score="f1", folds=3, bins=32).scores
    best = scores.agg((F.max("score") > 0).alias("best_above_majority"))
    return scores.crossJoin(F.broadcast(best)).select(
        "point", F.concat(F.lit("depth="), "depth", F.lit(", rounds="), "rounds").alias("params"), F.col("score").between(0, 1).alias("scored"), "best_above_majority")


@query("random_search", "select 8::bigint as points, 8::bigint as different, true as better_than_mean")
def random_search(spark, sf):
    """Eight different points of the grid of 36, each with a lower percentage error than the mean price."""
    points = [boosting.Point(p["rounds"], p["rate"], 6) for p in fits.random_points({"rounds": ROUNDS, "rate": RATES}, 8, seed=7)]
    scores = _price_search(spark, sf, points).scores
    return scores.crossJoin(F.broadcast(_error_of_mean(spark, sf))).agg(
        F.count("*").alias("points"), F.countDistinct("rounds", "rate").alias("different"), F.every(F.col("score") < F.col("error_of_mean")).alias("better_than_mean"))


def _ratings(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey", "l_partkey").agg(
        F.avg("l_quantity").alias("rating"))


RATED = "(select distinct o_custkey, l_partkey from lineitem join orders on l_orderkey = o_orderkey)"


@query("factorize", f"select count(*) as n, true as better_than_mean from {RATED}")
def factorize(spark, sf):
    """Every rating is fitted, and nearer than the mean rating is."""
    base = scratch_dir(spark, "factors")
    model, _, _ = fits.factorize(_ratings(spark, sf), "o_custkey", "l_partkey", "rating", rank=10, base=base)
    scored = model.transform(spark.read.parquet(f"{base}/numbered")).withColumn("prediction", F.col("prediction").cast("double"))
    return metrics.regression(scored, "rating", "prediction", count="n").select("n", (F.col("r2") > 0).alias("better_than_mean"))


@query("factor_tables", f"""
    select distinct 'user' as kind, o_custkey as id, 10 as width from {RATED} union all select distinct 'item', l_partkey, 10 from {RATED}
""")
def factor_tables(spark, sf):
    """Ten factors for every user and item."""
    model, users, items = fits.factorize(_ratings(spark, sf), "o_custkey", "l_partkey", "rating", rank=10)
    by_user, by_item = fits.factor_tables(model, users, items, "o_custkey", "l_partkey")
    both = by_user.withColumn("kind", F.lit("user")).unionByName(by_item.withColumn("kind", F.lit("item")))
    return both.select("kind", "id", F.size("features").alias("width"))


@query("factorize_blocks", f"select count(*) as n, true as better_than_mean from {RATED}")
def factorize_blocks(spark, sf):
    """Unpenalised factors by strata of blocks: every rating is fitted, with less than three quarters of the mean's squared error."""
    ratings = _ratings(spark, sf)
    scored = factors.factorize_blocks(ratings, "o_custkey", "l_partkey", "rating", rank=10, epochs=4).predict(ratings)
    return metrics.regression(scored, "rating", "prediction", count="n").select("n", (F.col("r2") > 0.25).alias("better_than_mean"))


@query("factor_tables_blocks", f"""
    select distinct 'user' as kind, o_custkey as id, 10 as width, true as finite from {RATED}
    union all select distinct 'item', l_partkey, 10, true from {RATED}
""")
def factor_tables_blocks(spark, sf):
    """Ten finite factors for every user and item."""
    by_user, by_item = factors.factorize_blocks(_ratings(spark, sf), "o_custkey", "l_partkey", "rating", rank=10, epochs=1, walks=1).tables()
    both = by_user.withColumn("kind", F.lit("user")).unionByName(by_item.withColumn("kind", F.lit("item")))
    return both.select("kind", "id", F.size("features").alias("width"), F.forall("features", lambda x: F.abs(x) < float("inf")).alias("finite"))


@query("select_features", " union all ".join(
    f"select '{c}' as feature, round(corr({c}, l_extendedprice), 6) as corr from lineitem" for c in ("l_quantity", "l_discount", "l_tax")))
def select_features(spark, sf):
    return fits.rank_features(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice").withColumn(
        "corr", F.round("corr", 6))


# ---- metrics: the price predicted from the quantity, the status from the price ---------------

def _predicted_prices(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500 + 800).alias("p"))


def _predicted_classes(spark, sf):
    return table(spark, sf, "orders").select(
        (F.col("o_orderstatus") == "F").cast("int").alias("a"), (F.col("o_totalprice") > 250000).cast("int").alias("p"),
        F.col("o_totalprice").alias("score"))


PRICES = "(select l_extendedprice as y, l_quantity * 1500 + 800 as p from lineitem)"
CLASSES = "(select (o_orderstatus = 'F')::integer as a, (o_totalprice > 250000)::integer as p, o_totalprice as score from orders)"


@query("m_r2_rmse", f"""
    select round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) as r2, round(sqrt(avg((y - p) * (y - p))), 4) as rmse from {PRICES}
""")
def m_r2_rmse(spark, sf):
    return metrics.regression(_predicted_prices(spark, sf), "y", "p").select(
        F.round("r2", 6).alias("r2"), F.round("rmse", 4).alias("rmse"))


@query("m_mape", f"select round(avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)), 6) as mape from {PRICES}")
def m_mape(spark, sf):
    return metrics.mape(_predicted_prices(spark, sf), "y", "p").withColumn("mape", F.round("mape", 6))


@query("m_confusion", f"""
    with l as (select distinct a as v from {CLASSES} union select distinct p from {CLASSES}),
    c as (select a, p, count(*) as n from {CLASSES} group by 1, 2)
    select x.v as actual, z.v as predicted, coalesce(n, 0) as n from l x cross join l z left join c on c.a = x.v and c.p = z.v
""")
def m_confusion(spark, sf):
    return metrics.confusion(_predicted_classes(spark, sf), "a", "p")


@query("m_class", f"""
    with c as (select sum((a = 1 and p = 1)::int) as tp, sum((a = 0 and p = 1)::int) as fp, sum((a = 1 and p = 0)::int) as fn,
                      sum((a = p)::int) as ok, count(*) as n from {CLASSES})
    select round(ok / n, 6) as accuracy, round(tp / (tp + fp), 6) as "precision", round(tp / (tp + fn), 6) as recall,
           round(2 * tp / (2 * tp + fp + fn), 6) as f1 from c
""")
def m_class(spark, sf):
    found = metrics.classification(_predicted_classes(spark, sf), "a", "p")
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


@query("m_auc", f"""
    with s as (select score, sum((a = 1)::int) as pos, sum((a <> 1)::int) as neg from {CLASSES} group by 1),
    r as (select pos, neg, sum(neg) over (order by score) as upto from s)
    select round(sum(pos * (upto - neg / 2)) / (sum(pos) * sum(neg)), 6) as auc from r
""")
def m_auc(spark, sf):
    return metrics.auc(_predicted_classes(spark, sf), "a", "score").withColumn("auc", F.round("auc", 6))


@query("m_auc_labels", f"""
    with s as (select p, sum((a = 1)::int) as pos, sum((a <> 1)::int) as neg from {CLASSES} group by 1),
    r as (select pos, neg, sum(neg) over (order by p) as upto from s)
    select round(sum(pos * (upto - neg / 2)) / (sum(pos) * sum(neg)), 6) as auc from r
""")
def m_auc_labels(spark, sf):
    """The same area computed from hard labels."""
    return metrics.auc(_predicted_classes(spark, sf), "a", "p").withColumn("auc", F.round("auc", 6))


@query("residuals", f"""
    with r as (select y - p as v from {PRICES}), e as (select min(v) as low, (max(v) - min(v)) / 50 as w from r),
    b as (select least(floor((v - low) / w), 49)::integer as bin, count(*) as n from r, e group by 1)
    select g.bin::integer as bin, round(low + g.bin * w, 3) as low, round(low + (g.bin + 1) * w, 3) as high, coalesce(n, 0) as n
    from (select unnest(range(50)) as bin) g left join b on g.bin = b.bin, e
""")
def residuals(spark, sf):
    return metrics.residual_histogram(_predicted_prices(spark, sf), "y", "p", 50).withColumns(
        {"low": F.round("low", 3), "high": F.round("high", 3)})


# ---- feature tests: returned lines from their numbers, statuses and months --------------------

TESTED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
DISCRETE = ("l_linestatus", "l_linenumber", "l_month")


@query("select_features_anova", " union all ".join(f"""
    select '{f}' as feature, round((sum(n * (m - grand) * (m - grand)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 6)::double as statistic,
           (count(*) - 1)::bigint as df1, (sum(n) - count(*))::bigint as df2
    from (select *, sum(n * m) over () / sum(n) over () as grand
          from (select count({f}) as n, avg({f}) as m, var_pop({f}) as v from lineitem group by l_returnflag))""" for f in TESTED))
def select_features_anova(spark, sf):
    """F test of every number of a line against its return flag."""
    scores = selection.anova_scores(table(spark, sf, "lineitem"), TESTED, "l_returnflag")
    return scores.select("feature", F.round("statistic", 6).alias("statistic"), "df1", "df2")


@query("select_features_f", " union all ".join(
    f"""select '{f}' as feature, round(r * r / (1 - r * r) * (n - 2), 2) as statistic, 1::bigint as df1, (n - 2)::bigint as df2
    from (select corr({f}, l_extendedprice) as r, count(*) as n from lineitem where {f} is not null and l_extendedprice is not null)"""
    for f in ("l_quantity", "l_discount", "l_tax")))
def select_features_f(spark, sf):
    """F test of a linear relation to the price."""
    scores = selection.regression_scores(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return scores.select("feature", F.round("statistic", 2).alias("statistic"), "df1", "df2")


@query("select_features_chi", " union all ".join(f"""
    select '{f}' as feature, round(any_value(whole) * (sum(n * n / (in_row * in_col)) - 1), 6) as statistic,
           ((count(distinct c) - 1) * (count(distinct v) - 1))::bigint as df, round(sum(n / whole * ln(n * whole / (in_row * in_col))), 9) as mutual_information
    from (select *, sum(n) over (partition by v) as in_row, sum(n) over (partition by c) as in_col, sum(n) over () as whole
          from (select {f} as v, l_returnflag as c, count(*)::double as n
                from (select *, month(l_shipdate) as l_month from lineitem) where {f} is not null and l_returnflag is not null group by all))""" for f in DISCRETE))
def select_features_chi(spark, sf):
    """Chi-square and mutual information of discrete columns with the return flag."""
    lines = table(spark, sf, "lineitem").withColumn("l_month", F.month("l_shipdate"))
    scores = selection.contingency_scores(lines, DISCRETE, "l_returnflag")
    return scores.select("feature", F.round("statistic", 6).alias("statistic"), "df", F.round("mutual_information", 9).alias("mutual_information"))
