"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry.queries import queries  # noqa: E402
from basketry.session import build_session  # noqa: E402

HEADLINE = (
    "feature_matrix",
    "feat_category_window",
    "feat_multicity",
    "feat_distinct_counts",
    "latest_row_per_key",
    "upsert_latest",
    "lookup_preferred_match",
    "null_safe_join",
    "duplicate_rate_report",
    "conditional_aggregates",
    "clean_text",
    "labels_extract_all",
    "mask_email",
    "raw_monthly_partitions",
    "mart_dim_products",
)
# Timed too, once each, but left out of the total, which stays comparable between rounds. None is
# begun after HEAVY_UNTIL seconds, so that a slow machine still gets its line.
HEAVY = ("mart_dim_customers", "mart_fact_purchases", "mart_fact_purchase_items", "stream_marts")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEAVY_UNTIL = float(os.environ.get("BENCH_HEAVY_UNTIL", "240"))


def timed(spark, run, folder: str) -> float:
    start = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "basketry-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    wanted = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or [*HEADLINE, *HEAVY]
    start, times = time.perf_counter(), {}
    for name in wanted:
        if name in HEAVY and time.perf_counter() - start > HEAVY_UNTIL:
            continue
        runs = 1 if name in HEAVY else RUNS
        times[name] = round(min(timed(spark, registered[name], folder) for _ in range(runs)), 3)
    line = {
        "metric": "headline queries, best of runs, total",
        "value": round(sum(t for name, t in times.items() if name not in HEAVY), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
