"""Command-line entry: run the warehouse batch (and optionally the model).

    spark-submit -m tripdemand.cli --raw s3://bucket/raw --out s3://bucket/wh \\
        --months 2026-01 2026-02 2026-03 --weather s3://bucket/weather/ \\
        [--zones s3://bucket/taxi_zone_lookup.csv] [--model-cut 2026-03-01] [--append]

or ``python -m tripdemand.cli ...`` locally. ``--weather`` is a folder of JSON
payloads: files of one object of parallel hourly arrays, or of one a line.
"""

from __future__ import annotations

import argparse

from tripdemand.operators import ml
from tripdemand.operators import weather as wx
from tripdemand.plans.model import build_model
from tripdemand.plans.warehouse import append_months, build_warehouse, read_table, warehouse_row_counts
from tripdemand.session import get_spark
from tripdemand.sources.zones import read_zones


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tripdemand")
    ap.add_argument("--raw", required=True, help="folder of <service>_tripdata_<YYYY-MM>.parquet")
    ap.add_argument("--out", required=True, help="output folder for the warehouse tables")
    ap.add_argument("--months", nargs="+", required=True)
    ap.add_argument("--weather", required=True, help="folder of JSON weather payloads")
    ap.add_argument("--zones", help="zone lookup CSV (default: built-in 55 zones)")
    ap.add_argument("--master", help="Spark master (leave unset under spark-submit)")
    ap.add_argument("--cluster", action="store_true", help="large-cluster session settings")
    ap.add_argument("--model-cut", help="train before this date, test from it; fits and saves the model")
    ap.add_argument("--append", action="store_true", help="add the months that the warehouse does not have yet, instead of building it anew")
    ap.add_argument("--trees", type=int, default=ml.DEFAULT_PARAMS["n_trees"])
    args = ap.parse_args(argv)

    spark = get_spark(args.master, cluster=args.cluster)
    weather = wx.explode_weather(wx.read_payloads(spark, args.weather), "value")
    if args.append:
        new = append_months(spark, args.raw, args.out, args.months, weather)
        print(f"new months: {', '.join(new) or 'none'}")
        if args.model_cut and new:
            build_model(spark, args.out, ml.build_features(read_table(spark, args.out, "agg_hourly_demand")), args.model_cut, n_trees=args.trees)
        return
    zones = read_zones(spark, args.zones) if args.zones else None
    paths = build_warehouse(spark, args.raw, args.out, args.months, weather, zones,
                            model_cut=args.model_cut, n_trees=args.trees)
    warehouse_row_counts(spark, paths).show(truncate=False)


if __name__ == "__main__":
    main()
