"""Dense catchment x time layout and back.

The dense layout has one row per catchment with ``Time`` and one array per variable. A group is
bounded by a time chunk (a year by default, 8,784 hours at most), never by the size of the archive,
so no group grows with the data; the chunk is a column of the output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CHUNKS = {
    "year": lambda t: F.year(t),
    "month": lambda t: F.year(t) * 100 + F.month(t),
    "day": lambda t: F.year(t) * 10000 + F.month(t) * 100 + F.dayofmonth(t),
}


def _field(name: str):
    return lambda s: s[name]


def to_dense(df: DataFrame, variables: list[str], chunk: str = "year", time_col: str = "time",
             id_col: str = "divide_id") -> DataFrame:
    """K1: ``basin_id, ids, chunk, Time array<timestamp_ntz>, <var> array<double>`` sorted by time."""
    keys = [c for c in ("basin_id",) if c in df.columns]
    g = (df.select(*keys, F.col(id_col).alias("ids"), _CHUNKS[chunk](F.col(time_col)).cast("int").alias("chunk"),
                   F.struct(F.col(time_col).alias("t"), *[F.col(v) for v in variables]).alias("s"))
           .groupBy(*keys, "ids", "chunk").agg(F.sort_array(F.collect_list("s")).alias("a")))
    return g.select(*keys, "ids", "chunk", F.transform("a", lambda s: s["t"]).alias("Time"),
                    *[F.transform("a", _field(v)).alias(v) for v in variables])


def from_dense(dense: DataFrame, variables: list[str], time_col: str = "time") -> DataFrame:
    """R1 inverse: one row per (catchment, time)."""
    keys = [c for c in ("basin_id",) if c in dense.columns]
    z = dense.select(*keys, F.col("ids").alias("divide_id"),
                     F.inline(F.arrays_zip(F.col("Time").alias("Time"), *[F.col(v).alias(v) for v in variables])))
    return z.select(*keys, "divide_id", F.col("Time").alias(time_col), *variables)
