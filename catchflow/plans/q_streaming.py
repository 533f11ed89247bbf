"""Query: incremental ingest in two arrivals equals the batch result (ST2 ST3 K9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ledger
from ..session import scratch_path
from ..streaming import daily
from . import sql_views as V
from . import views
from .q_forcing import _CATCH_SQL, rect_coverage
from .registry import r9, register


@register("incremental_daily", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CATCH_SQL + """
SELECT basin_id, divide_id, time, round(qty, 9) AS qty, round(disc, 9) AS disc FROM catch""")
def incremental_daily(spark, sf):
    r = views.raster(spark, sf).select("time", "iy", "ix", "qty", "disc")
    src, out = scratch_path(spark, "landing"), scratch_path(spark, "ingest")
    ckpt, led = scratch_path(spark, "ingest-ckpt"), scratch_path(spark, "ledger")
    cut = r.agg(F.percentile_approx("time", 0.5)).first()[0]  # one scalar: split the archive into two arrivals
    first, second = r.filter(F.col("time") < F.lit(cut)), r.filter(F.col("time") >= F.lit(cut))
    cov = rect_coverage(spark, sf)
    # one file holds whole time steps: hash-partition by time before writing
    first.repartition("time").write.mode("append").parquet(src)
    daily.ingest_daily(spark, src, r.schema, cov, views.RASTER_VARS, out, ckpt, ledger_path=led)
    second.repartition("time").write.mode("append").parquet(src)
    daily.ingest_daily(spark, src, r.schema, cov, views.RASTER_VARS, out, ckpt, ledger_path=led)  # new files only
    assert ledger.read_ledger(spark, led).filter(F.col("status") == "finished").limit(1).count() == 1
    res = daily.read_output(spark, out)
    return res.select("basin_id", "divide_id", "time", r9("qty", "qty"), r9("disc", "disc"))


@register("incremental_pieces", sql=V.with_(V.RASTER, V.BOXES, V.GRID10, V.RECT_COV) + _CATCH_SQL + """
SELECT basin_id, divide_id, time, round(qty, 9) AS qty, round(disc, 9) AS disc FROM catch""")
def incremental_pieces(spark, sf):
    """ST2: every time step lands in several pieces (halves of its cells, and each variable for itself) in different
    micro-batches; the result is the batch result."""
    from ..streaming import stateful
    long = views.raster(spark, sf).select("time", "iy", "ix", F.inline(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).alias("value")) for v in views.RASTER_VARS])))
    src, out, ckpt = (scratch_path(spark, n) for n in ("pieces", "pieces-out", "pieces-ckpt"))
    first = (F.col("ix") + F.col("iy")) % 2 == 0
    cov = rect_coverage(spark, sf)
    schema = long.schema
    long.where(first).repartition(1, "time").write.mode("append").parquet(src)
    stateful.ingest_pieces(spark, src, schema, cov, views.RASTER_VARS, out, ckpt, delay="4000 days")
    long.where(~first & (F.col("variable") == "qty")).repartition(1, "time").write.mode("append").parquet(src)
    long.where(~first & (F.col("variable") == "disc")).repartition(1, "time").write.mode("append").parquet(src)
    # the archive's end: a row beyond the grid moves the watermark past every step
    end = spark.createDataFrame([(-1, -1, "qty", None)], "iy bigint, ix bigint, variable string, value double")
    end.select(F.lit("2100-01-01 00:00:00").cast("timestamp_ntz").alias("time"), "iy", "ix", "variable", "value").write.mode("append").parquet(src)
    stateful.ingest_pieces(spark, src, schema, cov, views.RASTER_VARS, out, ckpt, delay="4000 days", max_files_per_trigger=1)
    res = daily.read_output(spark, out)
    return res.select("basin_id", "divide_id", "time", r9("qty", "qty"), r9("disc", "disc"))
