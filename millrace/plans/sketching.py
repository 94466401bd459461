"""Approximate aggregates, each with what is exact beside it and whether the estimate keeps its bound."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import sketches as sk
from millrace.operators.rangebuckets import exact_quantiles
from millrace.plans.registry import query
from millrace.session import scratch_dir, table
from millrace.sources.writers import write


def _monthly(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_returnflag", "l_partkey", "l_extendedprice", F.date_format("l_shipdate", "yyyy-MM").alias("month"))


MONTH = "strftime(l_shipdate, '%Y-%m')"


def _beside_exact(estimates, lines, by, estimate="n_distinct", bound=0.08):
    """The exact distinct count, and whether the estimate is within its bound of it."""
    exact = lines.groupBy(*by).agg(F.countDistinct("l_partkey").alias("exact"))
    joined = exact.join(estimates, by) if by else exact.crossJoin(F.broadcast(estimates))
    return joined.select(*by, "exact", (F.abs(F.col(estimate) - F.col("exact")) <= F.greatest(F.col("exact") * bound, F.lit(1))).alias("within"))


def _ranks_hold(estimates, lines, by, wanted, bound=0.03):
    """Whether each estimated quantile lies where its share of the rows says it should."""
    checks = [
        ((F.avg((F.col("l_extendedprice") <= F.col(name)).cast("double")) >= p - bound)
         & (F.avg((F.col("l_extendedprice") < F.col(name)).cast("double")) <= p + bound)).alias(f"{name}_ok") for name, p in wanted.items()
    ]
    joined = lines.join(estimates, by) if by else lines.crossJoin(F.broadcast(estimates))
    return joined.groupBy(*by).agg(F.count("*").alias("n"), *checks)


@query("approx_distinct", """
    select count(distinct l_orderkey) as orders, count(distinct l_partkey) as parts, true as orders_ok, true as parts_ok from lineitem
""")
def approx_distinct(spark, sf):
    lines = table(spark, sf, "lineitem")
    rough = lines.agg(F.approx_count_distinct("l_orderkey", 0.02).alias("o"), F.approx_count_distinct("l_partkey", 0.02).alias("p"))
    exact = lines.agg(F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_partkey").alias("parts"))
    return exact.crossJoin(F.broadcast(rough)).select(
        "orders", "parts", (F.abs(F.col("o") - F.col("orders")) <= 0.08 * F.col("orders")).alias("orders_ok"),
        (F.abs(F.col("p") - F.col("parts")) <= 0.08 * F.col("parts")).alias("parts_ok"))


BY_MONTH = f"select {MONTH} as month, count(distinct l_partkey) as exact, true as within from lineitem group by 1"


@query("hll_accumulate", BY_MONTH.replace("true as within", "true as within, true as small"))
def hll_accumulate(spark, sf):
    """One state per month: bounded in size, and its estimate is within the bound."""
    states = sk.hll_accumulate(_monthly(spark, sf), "l_partkey", ["month"])
    sizes = states.select("month", (F.length("sketch") <= 8192).alias("small"))
    return _beside_exact(sk.hll_estimate(states), _monthly(spark, sf), ["month"]).join(sizes, "month")


@query("hll_combine", "select l_returnflag, count(distinct l_partkey) as exact, true as within from lineitem group by 1")
def hll_combine(spark, sf):
    states = sk.hll_accumulate(_monthly(spark, sf), "l_partkey", ["l_returnflag", "month"])
    return _beside_exact(sk.hll_estimate(sk.hll_combine(states, ["l_returnflag"])), _monthly(spark, sf), ["l_returnflag"])


@query("hll_estimate", BY_MONTH)
def hll_estimate(spark, sf):
    return _beside_exact(sk.hll_estimate(sk.hll_accumulate(_monthly(spark, sf), "l_partkey", ["month"])), _monthly(spark, sf), ["month"])


@query("hll_export_import", "select count(distinct l_partkey) as exact, true as within from lineitem")
def hll_export_import(spark, sf):
    """States stored as binary values, read back and merged."""
    stored = write(sk.hll_accumulate(_monthly(spark, sf), "l_partkey", ["month"]), scratch_dir(spark, "hll"))
    return _beside_exact(sk.hll_estimate(sk.hll_combine(stored)), _monthly(spark, sf), [])


@query("approx_quantile", "select count(*) as n, true as median_ok, true as p95_ok from lineitem")
def approx_quantile(spark, sf):
    lines = table(spark, sf, "lineitem")
    rough = lines.agg(
        F.percentile_approx("l_extendedprice", 0.5, 10_000).alias("median"), F.percentile_approx("l_extendedprice", 0.95, 10_000).alias("p95"))
    return _ranks_hold(rough, lines.select("l_extendedprice"), [], {"median": 0.5, "p95": 0.95}, bound=0.001)


@query("quantile_accumulate", f"select {MONTH} as month, count(*) as n from lineitem group by 1")
def quantile_accumulate(spark, sf):
    states = sk.quantile_accumulate(_monthly(spark, sf), "l_extendedprice", ["month"])
    return states.select("month", F.kll_sketch_get_n_double("sketch").alias("n"))


@query("quantile_combine", "select l_returnflag, count(*) as n, true as median_ok, true as p95_ok from lineitem group by 1")
def quantile_combine(spark, sf):
    wanted = {"median": 0.5, "p95": 0.95}
    states = sk.quantile_accumulate(_monthly(spark, sf), "l_extendedprice", ["l_returnflag", "month"])
    merged = sk.quantile_estimate(sk.quantile_combine(states, ["l_returnflag"]), wanted)
    return _ranks_hold(merged, _monthly(spark, sf), ["l_returnflag"], wanted)


@query("quantile_estimate", f"select {MONTH} as month, count(*) as n, true as median_ok from lineitem group by 1")
def quantile_estimate(spark, sf):
    rough = sk.quantile_estimate(sk.quantile_accumulate(_monthly(spark, sf), "l_extendedprice", ["month"]), {"median": 0.5})
    return _ranks_hold(rough, _monthly(spark, sf), ["month"], {"median": 0.5})


@query("quantile_exact", """
    select quantile_cont(l_extendedprice, 0.25) as q1, median(l_extendedprice) as q2, quantile_cont(l_extendedprice, 0.99) as q99 from lineitem
""")
def quantile_exact(spark, sf):
    return exact_quantiles(table(spark, sf, "lineitem"), {f"q{n}": ("l_extendedprice", p) for n, p in ((1, 0.25), (2, 0.5), (99, 0.99))})


@query("minhash", "select l_returnflag, 64 as slots, true as unchanged_by_copies from lineitem group by 1")
def minhash(spark, sf):
    """A signature depends on the set alone: rows given twice do not change it."""
    lines = _monthly(spark, sf)
    twice = sk.minhash_signature(lines.unionAll(lines), "l_partkey", ["l_returnflag"], k=64, name="again")
    return sk.minhash_signature(lines, "l_partkey", ["l_returnflag"], k=64).join(twice, "l_returnflag").select(
        "l_returnflag", F.size("signature").alias("slots"), (F.col("signature") == F.col("again")).alias("unchanged_by_copies"))


@query("minhash_combine", "select l_returnflag, true as same_as_direct from lineitem group by 1")
def minhash_combine(spark, sf):
    """Signatures of months merge to the signature of all their rows."""
    states = sk.minhash_signature(_monthly(spark, sf), "l_partkey", ["l_returnflag", "month"], k=64)
    direct = sk.minhash_signature(_monthly(spark, sf), "l_partkey", ["l_returnflag"], k=64, name="direct")
    return sk.minhash_combine(states, ["l_returnflag"], k=64).join(direct, "l_returnflag").select(
        "l_returnflag", (F.col("signature") == F.col("direct")).alias("same_as_direct"))


@query("approx_similarity", """
    with held as (select l_partkey, count(distinct l_returnflag) as flags from lineitem group by 1)
    select round(avg(case when flags = (select count(distinct l_returnflag) from lineitem) then 1.0 else 0.0 end), 6) as jaccard, true as within from held
""")
def approx_similarity(spark, sf):
    """The exact Jaccard index of all groups together, and whether the estimate is within four deviations of it."""
    lines = _monthly(spark, sf)
    rough = sk.signature_similarity(sk.minhash_signature(lines, "l_partkey", ["l_returnflag"], k=128), k=128)
    flags = lines.agg(F.countDistinct("l_returnflag")).first()[0]
    held = lines.groupBy("l_partkey").agg(F.countDistinct("l_returnflag").alias("flags"))
    exact = held.agg(F.round(F.avg((F.col("flags") == flags).cast("double")), 6).alias("jaccard"))
    return exact.crossJoin(F.broadcast(rough)).select("jaccard", (F.abs(F.col("similarity") - F.col("jaccard")) <= 4 * 0.5 / 128 ** 0.5).alias("within"))


def _top_holds(estimates, rows, item, by, counters=10_000):
    """Per group: number of items, whether each count is within the sketch's error, and whether no left-out item is clearly more frequent.

    The error of a frequent-items sketch is at most 3.5 rows in ``counters``.
    """
    exact = rows.groupBy(*by, F.col(item).alias("item")).agg(F.count("*").alias("exact"))
    sizes = exact.groupBy(*by).agg(F.ceil(3.5 * F.sum("exact") / counters).alias("error"))
    named = exact.join(estimates, [*by, "item"], "left")
    named = named.join(sizes, by) if by else named.crossJoin(F.broadcast(sizes))
    found = named.groupBy(*by).agg(
        F.count("n").alias("items"), F.every(F.coalesce(F.abs(F.col("n") - F.col("exact")) <= F.col("error"), F.lit(True))).alias("within"),
        F.min(F.when(F.col("n").isNotNull(), F.col("exact"))).alias("least"), F.max(F.when(F.col("n").isNull(), F.col("exact"))).alias("missed"),
        F.max("error").alias("error"))
    return found.select(*by, "items", "within", F.coalesce(F.col("missed") <= F.col("least") + F.col("error"), F.lit(True)).alias("heaviest"))


@query("approx_topk", "select least(10, count(distinct user_id)) as items, true as within, true as heaviest from events")
def approx_topk(spark, sf):
    events = table(spark, sf, "events")
    top = events.agg(F.expr("approx_top_k(user_id, 10, 10000)").alias("top")).select(F.inline("top").alias("item", "n"))
    return _top_holds(top, events, "user_id", [])


@query("topk_accumulate", """
    select event_type, least(3, count(distinct user_id)) as items, true as within, true as heaviest from events group by 1
""")
def topk_accumulate(spark, sf):
    events = table(spark, sf, "events")
    return _top_holds(sk.topk_estimate(sk.topk_accumulate(events, "user_id", ["event_type"]), 3), events, "user_id", ["event_type"])


@query("topk_combine", "select least(10, count(distinct user_id)) as items, true as within, true as heaviest from events")
def topk_combine(spark, sf):
    events = table(spark, sf, "events")
    states = sk.topk_accumulate(events, "user_id", ["event_type"])
    return _top_holds(sk.topk_estimate(sk.topk_combine(states), 10), events, "user_id", [])


@query("topk_estimate", """
    select event_type as item, count(*) as n from events group by 1 order by n desc, item limit 5
""")
def topk_estimate(spark, sf):
    """With fewer distinct values than counters the sketch holds exact counts."""
    states = sk.topk_accumulate(table(spark, sf, "events"), "event_type", ["user_id"], max_items=100)
    return sk.topk_estimate(sk.topk_combine(states, max_items=100), 5)


EXACT_SQL = """
    select l_returnflag, count(distinct l_partkey) as exact_parts, median(l_extendedprice) as exact_median,
           true as distinct_ok, true as merged_ok, true as median_ok, true as kll_ok
    from lineitem group by 1
"""


@query("exact_vs_approx", EXACT_SQL)
def exact_vs_approx(spark, sf):
    """Exact and approximate results side by side, with whether each error is within its bound."""
    lines = _monthly(spark, sf)
    by = ["l_returnflag"]
    exact = lines.groupBy(*by).agg(F.countDistinct("l_partkey").alias("exact_parts"))
    medians = exact_quantiles(lines, {"exact_median": ("l_extendedprice", 0.5)}, by=by)
    rough = lines.groupBy(*by).agg(
        F.approx_count_distinct("l_partkey", 0.02).alias("hll"), F.percentile_approx("l_extendedprice", 0.5, 10_000).alias("rough_median"))
    # Both kinds of state come from one pass per month and are merged in one more.
    states = lines.groupBy(*by, "month").agg(
        F.hll_sketch_agg("l_partkey", F.lit(12)).alias("h"), F.kll_sketch_agg_double("l_extendedprice", F.lit(400)).alias("q"))
    merged = states.groupBy(*by).agg(F.hll_union_agg("h").alias("h"), F.kll_merge_agg_double("q", F.lit(400)).alias("q")).select(
        *by, F.hll_sketch_estimate("h").alias("merged"), F.kll_sketch_get_quantile_double("q", F.lit(0.5)).alias("kll"))

    def close(estimate, exactly, bound):
        return F.abs(F.col(estimate) - F.col(exactly)) <= F.lit(bound) * F.col(exactly)

    return exact.join(medians, by).join(rough, by).join(merged, by).select(
        *by, "exact_parts", "exact_median", close("hll", "exact_parts", 0.08).alias("distinct_ok"),
        close("merged", "exact_parts", 0.08).alias("merged_ok"), close("rough_median", "exact_median", 0.05).alias("median_ok"),
        close("kll", "exact_median", 0.05).alias("kll_ok"))
