"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Each query runs once to warm up, then 3 timed runs; the per-query value is the median wall time of
a full execution (``write.format("noop")``: every row computed, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "basin_forcing", "catchment_forcing", "catchment_forcing_centre", "coverage_fraction", "coverage_centre",
    "coverage_multipart_holes", "coverage_triangle_area", "compare_sources", "raster_table_roundtrip",
    "dense_pack", "nearest_fill", "round_decimals", "water_year_summary", "catalog_paths",
    "ensemble_wide", "nse_table", "nse_obs_all", "nonzero_features", "peak_feature", "three_way_join",
    "last_value_map", "step_map", "rescale_region", "forecast_align", "dedupe_last", "merge_outer",
    "completeness", "required_vars", "ledger_anti", "profile", "forecast_forcing", "catchment_forcing_shuffled",
    "chunk_scan", "polygon_container_scan", "incremental_daily",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    from catchflow.plans import load_all
    from catchflow.plans.registry import QUERIES
    from catchflow.session import get_spark
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    load_all()
    times, rows = {}, {}
    for name in HEADLINE:
        fn = QUERIES[name]
        rows[name] = fn(spark, sf_dir).count()  # warm-up (and the row count)
        ts = []
        for _ in range(reps):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            ts.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(ts), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "rows": rows, "sf": sf, "cpus": int(cpus), "reps": reps}))


if __name__ == "__main__":
    main()
