"""Times the headline queries; prints one JSON line.

Each query is built and fully evaluated into the no-op sink: once to warm up, then REPEATS times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tickloom.operators import models
from tickloom.plans.catalog import QUERIES
from tickloom.plans.learning import labelled
from tickloom.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
HEADLINE = [
    "tick_features", "future_volatility", "asof_past_price", "rule_baseline", "ks_test", "average_precision", "roc_auc",
    "histogram_quantile", "latency_report", "describe_features", "iqr_outliers", "stratified_split", "windowed_rates",
]


def seconds(build) -> float:
    times = []
    for i in range(REPEATS + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        if i:
            times.append(time.perf_counter() - start)
    return statistics.median(times)


def main() -> None:
    spark = local_session(CPUS, "bench")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    queries = {name: round(seconds(lambda n=name: QUERIES[n](spark, SF_DIR)), 4) for name in HEADLINE}

    rows = labelled(spark, SF_DIR).cache()
    n = rows.count()
    forest = models.fit_random_forest(rows, trees=100)
    queries["forest_scoring"] = round(seconds(lambda: models.apply_model(forest, rows)), 4)
    queries["rule_scoring"] = round(seconds(lambda: models.rule_baseline(rows)), 4)
    rates = {
        "feature_rows_per_sec": round(events / queries["tick_features"], 1),
        "forest_rows_per_sec": round(n / queries["forest_scoring"], 1),
        "rule_rows_per_sec": round(n / queries["rule_scoring"], 1),
    }
    sys.stdout.write(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(queries.values()), 3), "unit": "sec",
        "queries": queries, "sf": os.path.basename(SF_DIR.rstrip("/")), "cpus": CPUS, "rates": rates,
    }) + "\n")
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
