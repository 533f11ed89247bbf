"""File catalogs: listing, id parsing, run-file paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S

# level/variable pairs of the forecast archive (analysis and forecast files).
LEVEL_VARS_ANL = ["2m_above_ground/TMP", "2m_above_ground/SPFH", "surface/DLWRF", "surface/DSWRF",
                  "surface/PRES", "10m_above_ground/UGRD", "10m_above_ground/VGRD"]
LEVEL_VARS_FCST = ["surface/APCP_1hr_acc_fcst"]


def list_files(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """``path, length, modificationTime`` of the files under ``root``; file bytes are never read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", str(recursive).lower()).load(root)
            .select("path", "length", "modificationTime"))


def ids_from_names(names: DataFrame, col: str = "path", prefix: str = "Gage_", ext: str = ".gpkg") -> DataFrame:
    """S10 + T3: keep names with the extension, take the id after ``prefix``, distinct, sorted."""
    base = F.regexp_extract(F.col(col), r"([^/]+)$", 1)
    ok = names.filter(base.endswith(ext) & base.startswith(prefix))
    ident = F.split_part(F.regexp_replace(base, F.lit(ext.replace(".", r"\.") + "$"), F.lit("")), F.lit(prefix), F.lit(2))
    return ok.select(ident.alias("basin_id")).distinct().orderBy("basin_id")


def date_spine(days: DataFrame, d0: str = "d0", d1: str = "d1") -> DataFrame:
    """Every day between two dates inclusive as ``yyyyMMdd``, times every hour ``00``..``23``."""
    return (days.select(F.explode(F.sequence(F.col(d0), F.col(d1), F.expr("interval 1 day"))).alias("d"))
                .select(S.day_string("d").alias("day"), F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))
                .select("day", S.hour_string("h").alias("hour")))


def run_paths(runs: DataFrame, root: str = "sfc") -> DataFrame:
    """T4 + J12 + T5: one row per (run file, level/variable) with its data and metadata paths.

    ``runs``: ``init_hour, kind ('anl'|'fcst')``. The level/variable list is a literal array per kind,
    exploded on the run side: no join at all.
    """
    day = S.day_string("init_hour")
    path = F.format_string(f"{root}/%s/%s_%sz_%s.zarr", day, day, F.date_format("init_hour", "HH"), F.col("kind"))
    lv = F.when(F.col("kind") == "anl", F.array(*[F.lit(x) for x in LEVEL_VARS_ANL])).otherwise(
        F.array(*[F.lit(x) for x in LEVEL_VARS_FCST]))
    r = runs.select(path.alias("path"), day.alias("day"), "kind", F.explode(lv).alias("lv"))
    return r.select("path", "day", S.time_from_name("path").alias("init_hour"),
                    "kind", S.level_of("lv").alias("level"), S.variable_of("lv").alias("variable"),
                    F.concat_ws("/", "path", S.level_of("lv"), S.variable_of("lv"), S.level_of("lv")).alias("data_path"),
                    F.concat_ws("/", "path", S.level_of("lv"), S.variable_of("lv")).alias("meta_path"))
