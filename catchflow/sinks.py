"""Partitioned writes (K1-K8): one job per output, partition columns instead of per-basin loops.

Every writer sorts within partitions by time (O1) instead of a global sort, and uses Spark's
file committer, so a lost executor's task is simply re-run. Rows are spread over tasks by the
output keys plus a deterministic salt (the year of the row, or a hash of a finer id), so a key
holding a third of all rows is written by many tasks, and a retried task rebuilds the same split.
An overwrite replaces only the partition folders it writes, so a resumed job keeps what is finished.
Nexus files are small and many, one a nexus, so their tasks write them through ``pyarrow.fs`` and move each into place
when it is whole; a task that is run again writes the same names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import scalars as S


def _ts_strings(df: DataFrame) -> DataFrame:
    """CSV carries times as ``yyyy-MM-dd HH:mm:ss`` text."""
    out = []
    for f in df.schema.fields:
        if f.dataType.simpleString() in ("timestamp_ntz", "timestamp"):
            out.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def write_catchment_series(df: DataFrame, path: str, time_col: str = "time", mode: str = "overwrite") -> None:
    """K2: one CSV series per catchment (``basin_id=/divide_id=`` folders)."""
    (_ts_strings(df.repartition("basin_id", "divide_id", F.year(time_col))
                 .sortWithinPartitions("basin_id", "divide_id", time_col))
        .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("basin_id", "divide_id").option("header", True).csv(path))


def write_basin_series(df: DataFrame, path: str, time_col: str = "time", mode: str = "overwrite") -> None:
    """K3: the basin aggregate, one CSV folder per basin."""
    (_ts_strings(df.repartition("basin_id", F.year(time_col)).sortWithinPartitions("basin_id", time_col))
        .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("basin_id").option("header", True).csv(path))


def write_daily_series(df: DataFrame, path: str, time_col: str = "time", mode: str = "overwrite") -> None:
    """K3 by day: one CSV folder per basin and valid day."""
    d = df.withColumn("day", F.to_date(time_col))
    (_ts_strings(d.repartition("basin_id", "day").sortWithinPartitions("basin_id", "day", time_col))
        .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("basin_id", "day").option("header", True).csv(path))


def write_coverage(cov: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: coverage cache keyed by basin (the grid id is part of ``path``)."""
    salt = F.pmod(F.xxhash64("divide_id"), F.lit(16))
    cov.repartition("basin_id", salt).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("basin_id").parquet(path)


def write_rounded(df: DataFrame, path: str, spec: dict[str, int], time_col: str = "time", by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    """K5: per-variable rounding (M1) then CSV."""
    r = S.round_columns(df, spec)
    by = by or []
    w = _ts_strings(r.sortWithinPartitions(*by, time_col)).write.mode(mode).option("header", True)
    (w.option("partitionOverwriteMode", "dynamic").partitionBy(*by) if by else w).csv(path)


def write_water_years(df: DataFrame, path: str, by: list[str], time_col: str = "time", compression: str | None = None,
                      mode: str = "overwrite") -> None:
    """K6/K7: split by water year (the helper column leaves the file body as a partition column).

    ``compression='gzip'`` gives one compressed archive set per water year (K7). A year's months go to
    tasks of their own, so one long year is not one task.
    """
    wy = df.withColumn("water_year", S.water_year(time_col))
    keys = by + ["water_year"]
    w = (_ts_strings(wy.repartition(*keys, F.month(time_col)).sortWithinPartitions(*keys, time_col))
         .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*keys).option("header", True))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def write_gage_series(df: DataFrame, path: str, time_col: str = "time", mode: str = "overwrite") -> None:
    """K8: compiled series per gage (``gage_id=`` folders), time-ordered inside each file, no index column."""
    (_ts_strings(df.repartition("gage_id", F.year(time_col)).sortWithinPartitions("gage_id", time_col))
        .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("gage_id").option("header", True).csv(path))


def write_dense(dense: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: dense model-input layout as Parquet, partitioned by basin and time chunk."""
    keys = [c for c in ("basin_id", "chunk") if c in dense.columns]
    salt = F.pmod(F.xxhash64("ids"), F.lit(16))
    dense.repartition(*keys, salt).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def _escaped(name: str) -> str:
    """A value as part of a path, as Spark escapes partition values."""
    return re.sub(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", name)


def _nexus_writer(root: str, run: str, outer: list[str], replace: bool):
    """Rows (outer..., nex_file, line), sorted by file -> the files, ``<nex_file>-<run>-<task>.csv`` in their region folder."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .sources.chunks import file_system
        fs, base = file_system(root)
        task, made, count, held, now, out = TaskContext.get(), {}, 0, None, None, None

        def close():
            out.close()
            fs.move(held[0], held[1])

        for b in batches:
            cols = [b.column(c).to_pylist() for c in (*outer, "nex_file", "line")]
            for key, rows in groupby(zip(*cols), lambda r: r[:-1]):
                if key != now or out is None:
                    if out is not None:
                        close()
                    *region, file = ["__HIVE_DEFAULT_PARTITION__" if v is None else _escaped(str(v)) for v in key]
                    folder = "/".join([base.rstrip("/"), *[f"{c}={v}" for c, v in zip(outer, region)]])
                    file = file if key[-1] is not None else "none_output"  # a file with a leading _ would be hidden
                    if folder not in made:
                        fs.create_dir(folder, recursive=True)
                        made[folder] = _of_other_runs(fs, folder, run) if replace else {}
                    for old in made[folder].pop(file, []):
                        _gone(fs, old)
                    held = (f"{folder}/.{file}-{run}-{task.taskAttemptId()}", f"{folder}/{file}-{run}-{task.partitionId()}.csv")
                    now, out, count = key, fs.open_output_stream(held[0]), count + 1
                out.write("".join(f"{r[-1]}\n" for r in rows).encode())
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["files"])
    return write


def _of_other_runs(fs, folder: str, run: str) -> dict[str, list[str]]:
    """Files that earlier runs left in a region folder, by nexus file name."""
    from pyarrow import fs as pafs
    found: dict[str, list[str]] = {}
    for f in fs.get_file_info(pafs.FileSelector(folder)):
        name, own, _ = f.base_name.rsplit("-", 2) if f.base_name.count("-") > 1 else (f.base_name, run, "")
        if own != run and not name.startswith("."):
            found.setdefault(name, []).append(f.path)
    return found


def _gone(fs, path: str) -> None:
    try:
        fs.delete_file(path)
    except FileNotFoundError:  # another task of this nexus was first
        pass


def write_nexus_files(series: DataFrame, path: str, id_col: str = "id", mode: str = "overwrite",
                      partition_by: list[str] | None = None) -> None:
    """Headerless ``index, datetime, value`` CSVs named ``nex-<id>_output`` (the S6 layout), one for each task that
    holds rows of the nexus, optionally below region folders (``partition_by=['vpu']``).

    ``overwrite`` replaces the files of the nexuses it writes, ``append`` leaves them; ``error`` and ``ignore`` refuse
    or keep what is there, as Spark's writer does.
    """
    from .session import path_exists, ship_package
    spark, outer = series.sparkSession, partition_by or []
    there = path_exists(spark, path)
    if there and mode in ("error", "errorifexists"):
        raise FileExistsError(path)
    if there and mode == "ignore":
        return
    ship_package(spark)
    s = series.select(*outer, F.concat(F.lit("nex-"), F.col(id_col), F.lit("_output")).alias("nex_file"), "index",
                      F.to_csv(F.struct("index", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"), "value")).alias("line"))
    rows = (s.repartition(*outer, "nex_file", F.floor(F.col("index") / 100_000)).sortWithinPartitions(*outer, "nex_file", "index")
            .select(*outer, "nex_file", "line"))
    write = _nexus_writer(path, uuid.uuid4().hex[:12], outer, mode == "overwrite" and there)
    rows.mapInArrow(write, "files long").agg(F.sum("files")).collect()
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)  # no rows leave an empty folder
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)


def write_raster(df: DataFrame, path: str, tile: int = 64, time_col: str = "time", mode: str = "overwrite") -> None:
    """S1 layout: raster rows partitioned by ``year`` and spatial tile (``ty``, ``tx`` = cell index div
    ``tile``), sorted by cell then time inside each file, so a year range and a cell extent prune
    folders and Parquet row groups. A task writes one tile-month (64 x 64 cells x 744 h at most)."""
    t = (df.withColumn("year", F.year(time_col))
           .withColumn("ty", F.floor(F.col("iy") / tile).cast("int"))
           .withColumn("tx", F.floor(F.col("ix") / tile).cast("int")))
    (t.repartition("year", "ty", "tx", F.month(time_col)).sortWithinPartitions("iy", "ix", time_col)
      .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("year", "ty", "tx").parquet(path))
