"""Several outputs of a run published as one (K1 K2 K3 K9).

A run stages each output below ``root/runs/run=<id>/output=<name>``, where no reader looks. When all are whole, one
manifest is written: ``root/manifest/<id>``, a row for each basin that the run worked on. It counts once Spark has
closed it with ``_SUCCESS``, so a run that ends anywhere before leaves every output at its older state, and no reader
sees one output of a run without the others. Readers take each basin from its latest published run.

Run ids start with a rising number, so the latest is the greatest; two runs at once that work on the same basin are
both whole, and the greater id counts. Null basins belong to no row and are not published.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import path_exists

MANIFEST = "basin_id string, run string, ts timestamp_ntz"


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    """The folders in ``path``, in order; none if it isn't there."""
    fs, p = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def begin(spark: SparkSession, root: str) -> str:
    """A new run's id, greater than all ids that are there, published or not."""
    there = [n.removeprefix("run=") for n in _names(spark, f"{root}/runs")] + _names(spark, f"{root}/manifest")
    return f"{max((int(n.split('-')[0]) for n in there), default=0) + 1:08d}-{uuid.uuid4().hex[:8]}"


def staged(root: str, run: str, output: str) -> str:
    """Where the run writes an output."""
    return f"{root}/runs/run={run}/output={output}"


def commit(basins: DataFrame, root: str, run: str) -> None:
    """Publish everything the run staged, for ``basins`` (basin_id). Call once, after the last write."""
    (basins.select(F.col("basin_id").cast("string").alias("basin_id")).where("basin_id IS NOT NULL").distinct()
     .select("basin_id", F.lit(run).alias("run"), F.localtimestamp().alias("ts"))
     .write.mode("errorifexists").parquet(f"{root}/manifest/{run}"))


def _closed(spark: SparkSession, root: str) -> list[str]:
    return [n for n in _names(spark, f"{root}/manifest") if path_exists(spark, f"{root}/manifest/{n}/_SUCCESS")]


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(basin_id, run, ts): each published basin's latest run and when it was published; no rows before the first."""
    paths = [f"{root}/manifest/{n}" for n in _closed(spark, root)]
    rows = spark.read.schema(MANIFEST).parquet(*paths) if paths else spark.createDataFrame([], MANIFEST)
    return rows.groupBy("basin_id").agg(F.max("run").alias("run"), F.max_by("ts", "run").alias("ts"))


def published(spark: SparkSession, root: str, output: str, schema: str, fmt: str = "csv", **options) -> DataFrame:
    """An output as it was last published: of each basin, the rows of its latest run.

    ``schema`` names the file's columns and the folders' (``basin_id`` among them). Only the files of runs that still
    own a basin are listed and read; an output that a run didn't write has no rows for its basins.
    """
    live = manifest(spark, root)
    paths = [p for r in live.select("run").distinct().collect() if path_exists(spark, p := staged(root, r["run"], output))]
    names = spark.createDataFrame([], schema).columns
    if not paths:
        return spark.createDataFrame([], schema)
    if fmt == "csv":
        options = {"header": True, "mode": "FAILFAST", **options}
    df = spark.read.format(fmt).schema(f"{schema}, run string, output string").options(basePath=f"{root}/runs", **options).load(paths)
    return df.join(live.select("basin_id", "run"), ["basin_id", "run"], "left_semi").select(*names)


def compact(spark: SparkSession, root: str) -> int:
    """All manifests as one, with a row for each basin; returns how many it replaces. What is published stays the same.

    The new one counts before the old ones go, and its rows are those that count already, so it may end anywhere.
    """
    old = _closed(spark, root)
    if len(old) < 2:
        return 0
    manifest(spark, root).write.mode("errorifexists").parquet(f"{root}/manifest/{begin(spark, root)}")
    for name in old:
        fs, p = _folder(spark, f"{root}/manifest/{name}")
        fs.delete(p, True)
    return len(old)


def vacuum(spark: SparkSession, root: str, hours: float = 24.0) -> list[str]:
    """Delete the staged files of runs that own no basin and are older than ``hours``; returns their ids.

    These are runs that ended before they published and runs whose basins all have a later one. ``hours`` has to be
    more than a run takes, as one that is still at work owns nothing yet, and more than a reader takes.
    """
    owners = {r["run"] for r in manifest(spark, root).select("run").distinct().collect()}  # a row for each run, not basin
    gone = []
    for name in _names(spark, f"{root}/runs"):
        fs, p = _folder(spark, f"{root}/runs/{name}")
        run = name.removeprefix("run=")
        newest = max([fs.getFileStatus(p).getModificationTime(), *(s.getModificationTime() for s in fs.listStatus(p))])
        if run not in owners and time.time() * 1000 - newest >= hours * 3_600_000:
            fs.delete(p, True)
            gone.append(run)
    return gone
