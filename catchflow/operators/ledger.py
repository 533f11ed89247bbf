"""Run ledger: resume by anti-join, append after a successful write (J11 K9 ST3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LEDGER
from ..session import path_exists


def pending(basins: DataFrame, ledger: DataFrame, skip: str = "finished", key: str = "basin_id") -> DataFrame:
    """Basins still to run.

    ``skip='finished'`` (default) re-runs a basin whose last attempt only reached ``processing``;
    ``skip='any'`` skips every basin with any ledger line, as the original loop did.
    """
    if skip == "finished":
        done = ledger.filter(F.col("status") == "finished")
    elif skip == "any":
        done = ledger
    else:
        raise ValueError(f"skip must be 'finished' or 'any', not {skip!r}")
    return basins.join(done.select(key).distinct(), key, "left_anti")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger table; empty when nothing was recorded yet (any other read error is raised)."""
    return spark.read.schema(LEDGER).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], LEDGER)


def record(ids: DataFrame, path: str, status: str, key: str = "basin_id") -> None:
    """K9: append one line per id; call with ``processing`` before the work and ``finished`` after its write.

    An id that already has this status gets no second line, so a retried batch changes nothing.
    """
    have = read_ledger(ids.sparkSession, path).where(F.col("status") == status).select(F.col("basin_id").alias(key)).distinct()
    (ids.withColumn(key, F.col(key).cast("string")).join(have, key, "left_anti").select(F.col(key).cast("string").alias("basin_id"), F.lit(status).alias("status"),
                F.localtimestamp().alias("ts"))
        .write.mode("append").parquet(path))


def compact(spark: SparkSession, path: str) -> int:
    """K9: all lines as one set of files with the first line of each id and status; returns how many files went.

    The new lines are added before the old files go, and a line twice means what it means once, so this may end
    anywhere and be run again. Not to be run beside a writer.
    """
    if not path_exists(spark, path):
        return 0
    old = [r["f"] for r in spark.read.schema(LEDGER).parquet(path).select(F.col("_metadata.file_path").alias("f")).distinct().collect()]  # files, not lines
    if len(old) < 2:
        return 0
    first = read_ledger(spark, path).groupBy("basin_id", "status").agg(F.min("ts").alias("ts"))
    first.select("basin_id", "status", "ts").write.mode("append").parquet(path)
    for f in old:
        p = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f))
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, False)
    return len(old)
