"""Post-processing jobs: per-gage compilation and the cached coverage table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..schemas import Grid
from ..sources.series import scan_daily_basin_files


def compile_gage(spark: SparkSession, root: str, schema: T.StructType | str, time_col: str = "time",
                 gage_from=None) -> DataFrame:
    """S11 + T1 + P17: all daily basin files in one read; gage id padded to 8 characters when it lost
    its leading zero; ``divide_id`` set to the gage id when the files carry none.

    ``gage_from`` maps the parsed basin id column to the gage id (identity by default).
    """
    df = scan_daily_basin_files(spark, root, schema, time_col)
    gid = gage_from(F.col("basin_id")) if gage_from else F.col("basin_id")
    df = df.withColumn("gage_id", S.pad_gage(gid)).drop("basin_id")
    if "divide_id" not in df.columns:
        df = df.withColumn("divide_id", F.col("gage_id"))
    return df


def cached_coverage(spark: SparkSession, root: str, name: str, divides: DataFrame, grid: Grid, cells: str = "centre",
                    expand: int = 0, redo: bool = False) -> DataFrame:
    """K4 + S9: coverage read from the cache when present and ``redo`` is not set; else computed and written.

    The cache key holds a fingerprint of the polygons, all numbers of the grid and the cell rule as well as the
    name, so a cache is never read for other polygons or another grid, and only a completed write counts.
    Indices are global grid indices.
    """
    import hashlib

    from ..operators.coverage import coverage
    from ..schemas import COVERAGE
    from ..session import path_exists
    from ..sinks import write_coverage
    row = F.xxhash64("basin_id", "divide_id", F.to_json("rings"))
    mark = divides.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.bit_xor(row)).first()  # three scalars
    key = hashlib.sha256(repr((tuple(mark), grid, cells, expand)).encode()).hexdigest()[:16]
    path = f"{root.rstrip('/')}/{name}__{grid.grid_id}__{cells}__{key}_coverage.parquet"
    if redo or not path_exists(spark, f"{path}/_SUCCESS"):
        write_coverage(coverage(divides, grid, cells=cells, expand=expand), path)
    return spark.read.schema(COVERAGE).parquet(path)
