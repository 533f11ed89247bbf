"""Schemas of the data model and the NaN -> NULL boundary rule.

All times are ``timestamp_ntz`` and all ids are strings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField("hole", T.BooleanType()),
    T.StructField("pts", T.ArrayType(POINT)),
])
RINGS = T.ArrayType(RING)

DIVIDES = T.StructType([
    T.StructField("basin_id", T.StringType()),
    T.StructField("divide_id", T.StringType()),
    T.StructField("rings", RINGS),
])

COVERAGE = T.StructType([
    T.StructField("basin_id", T.StringType()),
    T.StructField("divide_id", T.StringType()),
    T.StructField("cell_id", T.LongType()),
    T.StructField("iy", T.LongType()),
    T.StructField("ix", T.LongType()),
    T.StructField("coverage", T.DoubleType()),
])

NESTED_COVERAGE = T.StructType([
    T.StructField("divide_id", T.StringType()),
    T.StructField("cells", T.ArrayType(T.StructType([
        T.StructField("cell_id", T.LongType()), T.StructField("coverage", T.DoubleType())]))),
])

NEXUS_SERIES = T.StructType([
    T.StructField("index", T.LongType()),
    T.StructField("datetime", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

LEDGER = T.StructType([
    T.StructField("basin_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
])

RUN_VALUES = T.StructType([
    T.StructField("init_hour", T.TimestampNTZType()),
    T.StructField("step", T.IntegerType()),
    T.StructField("variable", T.StringType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("iy", T.LongType()),
    T.StructField("ix", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("seq", T.LongType()),
])

# The eight variables of the analysis raster, in source order.
ANALYSIS_VARIABLES = ["APCP_surface", "DLWRF_surface", "DSWRF_surface", "PRES_surface",
                      "SPFH_2maboveground", "TMP_2maboveground", "UGRD_10maboveground", "VGRD_10maboveground"]
# The eight variables of the forecast raster.
FORECAST_VARIABLES = ["TMP", "SPFH", "DLWRF", "DSWRF", "PRES", "UGRD", "VGRD", "APCP_1hr_acc_fcst"]


@dataclass(frozen=True)
class Grid:
    """Regular grid metadata: cell (iy, ix) covers [x0+ix*dx, x0+(ix+1)*dx] x [y0+iy*dy, y0+(iy+1)*dy]."""
    grid_id: str
    x0: float
    y0: float
    dx: float
    dy: float
    nx: int
    ny: int
    crs: str = "EPSG:4326"

    @property
    def cell_area(self) -> float:
        return self.dx * self.dy


def nan_to_null(c: Column) -> Column:
    """NaN -> NULL; every operator downstream works on NULL only."""
    return F.nanvl(c, F.lit(None).cast("double"))


def clean_doubles(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Apply the NaN -> NULL rule to the double columns of ``df`` (all, or the listed ones)."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.select(*[nan_to_null(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])
