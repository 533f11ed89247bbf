"""Session helpers: a tuned SparkSession, the shared checkpoint folder, written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "catchflow", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE, skew join, UTC and the UI off."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = (SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
         .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a private one only in local mode (tests), where it is unset."""
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="catchflow-ckpt-")  # no folder named by the session: local runs and tests only
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def local_path(uri: str) -> str:
    """``file:`` URIs as plain paths (Spark reads both; Python file IO needs the plain form)."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for written intermediate tables.

    Writers that produce raw files from Python (chunk stores, polygon containers) need this folder
    on a POSIX file system shared by all executors; Spark's own writers work on any scheme.
    """
    base = local_path(checkpoint_dir(spark).rstrip("/"))
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, with a size the planner knows."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, on any file system that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``catchflow`` importable on the executors (``addPyFile`` of a zip of the package, once per
    SparkContext). Needed where Python runs on the workers: the byte decoders and fixture writers."""
    import zipfile
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    base = local_path(checkpoint_dir(spark))
    target_dir = base if "://" not in base else tempfile.mkdtemp(prefix="catchflow-pkg-")
    os.makedirs(target_dir, exist_ok=True)
    zpath = os.path.join(target_dir, f"catchflow-{key}.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)
