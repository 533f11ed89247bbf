"""Domain views derived from the driver's tables, so every query's work grows with the tables.

RASTER  (lineitem)  10 x 10 unit cells x month: time, iy, ix, y, x, qty, disc
DIVIDES (nation)    rectangles (or triangles) in basins = regions
SERIES  (events)    hourly mean per event type; 'click' is observed, the other four are members
FLOW    (events)    routed flow per feature (user) and day
RUNS    (events)    hourly forecast-run values
NEXUS   (customer)  nexus points per region (vpu)
LEDGER  (customer)  run ledger
WATER   (orders)    a daily series for water-year work
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..schemas import Grid

# The toy grid the RASTER view lives on.
GRID = Grid(grid_id="unit10", x0=0.0, y0=0.0, dx=1.0, dy=1.0, nx=10, ny=10, crs="EPSG:4326")
RASTER_VARS = ["qty", "disc"]
OBSERVED = "click"
MEMBERS = ["error", "purchase", "signup", "view"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ntz(c):
    """``date_trunc`` on timestamp_ntz returns timestamp; cast back."""
    return c.cast("timestamp_ntz")


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        F.pmod(F.expr("l_partkey div 10"), F.lit(10)).alias("iy"),
        F.pmod(F.col("l_partkey"), F.lit(10)).cast("bigint").alias("ix"),
        ntz(F.date_trunc("month", F.col("l_shipdate"))).alias("time"),
        "l_quantity", "l_discount")
    g = li.groupBy("time", "iy", "ix").agg(F.avg("l_quantity").alias("q"), F.avg("l_discount").alias("disc"))
    hole = F.pmod(F.col("ix") * 7 + F.col("iy") * 3 + F.month("time"), F.lit(29)) == 0
    return g.select("time", F.col("iy").cast("bigint").alias("iy"), F.col("ix").cast("bigint").alias("ix"),
                    (F.col("iy") + 0.5).alias("y"), (F.col("ix") + 0.5).alias("x"),
                    F.when(~hole, F.col("q")).alias("qty"), "disc")


def _nation_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    x0 = (k % 5) * 2 + 0.3
    y0 = F.expr("n_nationkey div 5") * 2 + 0.2
    return table(spark, sf_dir, "nation").select(
        F.col("n_regionkey").cast("string").alias("basin_id"),
        F.concat(F.lit("cat-"), k.cast("string")).alias("divide_id"),
        x0.cast("double").alias("x0"), (x0 + 1 + (k % 4) * F.lit(0.1).cast("double")).alias("x1"),
        y0.cast("double").alias("y0"), (y0 + 1.25).alias("y1"))


def divides(spark: SparkSession, sf_dir: str, shape: str = "rect") -> DataFrame:
    b = _nation_box(spark, sf_dir)
    make = geo.rectangle if shape == "rect" else geo.triangle
    return b.select("basin_id", "divide_id", make(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("rings"))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nation_box(spark, sf_dir)


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form ``datetime, id, value`` (hourly mean per event type)."""
    ev = table(spark, sf_dir, "events")
    return (ev.select(ntz(F.date_trunc("hour", "ts")).alias("datetime"), F.col("event_type").alias("id"), "value")
              .groupBy("datetime", "id").agg(F.avg("value").alias("value")))


def flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return (ev.select(F.col("user_id").alias("feature_id"), ntz(F.date_trunc("day", "ts")).alias("time"),
                      F.when(F.col("value") > 200, F.col("value")).otherwise(F.lit(0.0)).alias("f"))
              .groupBy("feature_id", "time").agg(F.sum("f").alias("flow")))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(ntz(F.date_trunc("hour", "ts")).alias("init_hour"), (F.col("user_id") % 3).cast("int").alias("step"),
                     F.col("event_type").alias("variable"), "value", F.col("event_id").alias("seq"))


def run_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RUNS placed on the grid: ``init_hour, step, variable, iy, ix, value, seq`` (several events can
    share a run, variable and cell: the keep-last case)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(ntz(F.date_trunc("hour", "ts")).alias("init_hour"), (F.col("user_id") % 3).cast("int").alias("step"),
                     F.col("event_type").alias("variable"),
                     F.pmod(F.expr("user_id div 3"), F.lit(10)).cast("bigint").alias("iy"),
                     F.pmod(F.expr("user_id div 30"), F.lit(10)).cast("bigint").alias("ix"),
                     "value", F.col("event_id").alias("seq"))


def nexus(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_nationkey").cast("string").alias("vpu"),
                    F.concat(F.lit("nex-"), F.col("c_custkey").cast("string")).alias("id"))


def nexus_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nexus output rows ``nex_id, index, value`` (index = file order)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").cast("string").alias("nex_id"), F.col("event_id").alias("index"), "value")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    m = F.pmod(F.col("c_custkey"), F.lit(3))
    return (c.filter(m != 2)
             .select(F.col("c_custkey").cast("string").alias("basin_id"),
                     F.when(m == 0, "finished").otherwise("processing").alias("status"),
                     F.lit(None).cast("timestamp_ntz").alias("ts")))


def basins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("basin_id"))


def water(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").cast("timestamp_ntz").alias("time"),
                    F.col("o_totalprice").alias("value"))
