"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` picks the data, ``BENCH_CPUS`` the number of local cores. Each query runs twice
against a warm session and the faster run counts; results are consumed in full by a sink that
discards them.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from millrace.plans import QUERIES
from millrace.session import local_session

HEADLINE = [
    "top_quantity_orders", "top_quantity_orders_sql", "customer_totals", "ship_avg", "agg_group", "agg_median", "agg_count_distinct",
    "approx_distinct", "quantile_exact", "approx_quantile", "exact_vs_approx", "join_asof", "point_in_time", "feat_raw_join",
    "feat_customer_rfm", "dense_ids", "m_auc", "sample_n", "split_random", "flatten_agg", "sentiment_by_group",
    "udf_margin_compare", "udf_named", "udf_vector_series", "udf_register", "min_max_scale", "one_hot", "score_pairs",
    "logistic_fit", "score_batch", "score_by_version", "grid_search", "scheduled_refresh", "append_children", "upsert",
]


def run(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    run(spark, sf_dir, "agg_group")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        times[name] = round(min(run(spark, sf_dir, name) for _ in range(2)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline queries, total time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(found.group(1)) if found else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
