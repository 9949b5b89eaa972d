"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (default 3). Each query runs once to warm up, then
BENCH_RUNS times; the median wall time is reported (the model fit: its only run). Results are forced with
the ``noop`` sink, so the whole plan executes but nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "clean_yellow", "clean_hvfhv", "fact_trips", "agg_hourly_demand", "agg_zone_demand",
    "zone_profile", "hourly_profile", "top_zones", "demand_heatmap", "daily_trend",
    "weather_daily", "reject_reasons", "profile", "operator_share", "demand_features",
    "regression_metrics", "pipeline_row_counts", "fit_demand",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from tripdemand.session import get_spark
    from tripdemand import catalog

    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus, app_name="tripdemand-bench",
                      extra_conf={"spark.driver.memory": "16g",
                                  "spark.local.dir": scratch,
                                  "spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))

    def run(name: str) -> float:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times = {}
    for name in HEADLINE:
        if name == "fit_demand":  # the session keeps its model, so the first run is the fit
            times[name] = round(run(name), 3)
            continue
        run(name)  # warm-up
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
