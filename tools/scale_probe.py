"""Throughput probe for the flagship plan on a generated raster (not a registered query).

Usage: python tools/scale_probe.py NX NY HOURS N_POLYGONS
Generates an hourly raster of NX x NY cells with 8 variables (spark.range, so nothing passes through
the driver), N rectangular catchments in 50 basins, and times coverage -> catchment mean -> basin mean
with a no-op sink. Prints one JSON line.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from catchflow.functions import geometry as geo  # noqa: E402
from catchflow.operators import coverage as cov  # noqa: E402
from catchflow.operators import forcing  # noqa: E402
from catchflow.schemas import ANALYSIS_VARIABLES, Grid  # noqa: E402
from catchflow.session import checkpoint_dir, get_spark  # noqa: E402


def main():
    nx, ny, hours, npoly = (int(a) for a in sys.argv[1:5])
    spark = get_spark()
    checkpoint_dir(spark)
    grid = Grid("probe", 0.0, 0.0, 1.0, 1.0, nx, ny)
    cells = nx * ny
    r = spark.range(cells * hours).select(
        (F.col("id") % cells).alias("c"), (F.col("id") / cells).cast("long").alias("h"))
    r = r.select(F.timestamp_add("HOUR", F.col("h"), F.lit("2000-01-01").cast("timestamp_ntz")).alias("time"),
                 (F.col("c") / nx).cast("long").alias("iy"), (F.col("c") % nx).alias("ix"),
                 *[(F.sin(F.col("c") * (i + 1) + F.col("h")) * 10 + i).alias(v) for i, v in enumerate(ANALYSIS_VARIABLES)])
    p = spark.range(npoly).select(
        (F.col("id") % 50).cast("string").alias("basin_id"), F.concat(F.lit("cat-"), F.col("id").cast("string")).alias("divide_id"),
        (F.rand(1) * (nx - 16)).alias("x0"), (F.rand(2) * (ny - 16)).alias("y0"),
        (F.rand(3) * 12 + 2).alias("w"), (F.rand(4) * 12 + 2).alias("hh"))
    divides = p.select("basin_id", "divide_id",
                       geo.rectangle(F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("hh")).alias("rings"))
    t0 = time.perf_counter()
    c = forcing.prepare_coverage(cov.coverage(divides, grid))
    ncov = c.count()
    t1 = time.perf_counter()
    cm = forcing.catchment_mean(r, c, ANALYSIS_VARIABLES)
    b = forcing.basin_mean(cm, ANALYSIS_VARIABLES)
    b.write.format("noop").mode("overwrite").save()
    t2 = time.perf_counter()
    rows = cells * hours
    print(json.dumps({"raster_rows": rows, "variables": 8, "polygons": npoly, "coverage_rows": ncov,
                      "coverage_sec": round(t1 - t0, 2), "forcing_sec": round(t2 - t1, 2),
                      "raster_rows_per_sec": int(rows / (t2 - t1))}))


if __name__ == "__main__":
    main()
