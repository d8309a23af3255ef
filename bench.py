"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tallycast.plans import catalogue
from tallycast.session import local_session

HEADLINE = [
    "eligible_forecasts",
    "score_candidates",
    "score_joined",
    "score_to_leaderboard",
    "forecast_stats",
    "leaderboard_by_model",
    "leaderboard_weekly",
    "model_order",
    "bundle_forecasts",
    "validate_submissions",
    "standardize_forecast",
    "air_targets",
    "target_upsert",
    "qc_series",
    "stage2",
    "climatology_forecast",
    "catalog_items",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "tallycast-bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/nation.parquet").count()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            catalogue.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
