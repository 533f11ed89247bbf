"""Map-ready tables: last value per nexus, per-step tables, per-frame normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schemas import nan_to_null


def last_value(values: DataFrame, key: str = "nex_id", order: str = "index") -> DataFrame:
    """The value of the last row in file order (``index``), not the latest time; skew safe (max_by)."""
    return values.groupBy(key).agg(F.max_by("value", order).alias("value"))


def map_table(features: DataFrame, values: DataFrame, keys: list[str], fill: float | None = 0.0) -> DataFrame:
    """J8 + V1: every feature keeps its row; missing (or NaN) values become ``fill`` (None keeps NULL)."""
    j = features.join(values, keys, "left")
    v = nan_to_null(F.col("value"))
    return j.withColumn("value", F.coalesce(v, F.lit(fill)) if fill is not None else v)


def frame_bounds(df: DataFrame, by: list[str], col: str = "value") -> DataFrame:
    """Min and max per frame (a grouped aggregate, joined back; no unbounded window)."""
    return df.groupBy(*by).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))


def rescale(df: DataFrame, col: str = "value", by: list[str] | None = None, out: str = "scaled") -> DataFrame:
    """M3 per frame (``by``) or over the whole table (``by=None``)."""
    if by:
        b = frame_bounds(df, by, col)
        j = df.join(b, by)
    else:
        lo, hi = df.agg(F.min(col), F.max(col)).first()  # one aggregate row, used as two literals
        j = df.select("*", F.lit(lo).cast("double").alias("_lo"), F.lit(hi).cast("double").alias("_hi"))
    return j.withColumn(out, S.rescale(F.col(col), F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")


def power_norm(df: DataFrame, col: str = "value", by: list[str] | None = None, gamma: float = 0.4,
               out: str = "norm") -> DataFrame:
    """M4 per frame."""
    b = frame_bounds(df, by, col)
    j = df.join(b, by)
    return j.withColumn(out, S.power_norm(F.col(col), F.col("_lo"), F.col("_hi"), gamma)).drop("_lo", "_hi")


def step_table(flow: DataFrame, steps: DataFrame, features: DataFrame, lo: int, hi: int,
               fill: float = 0.0) -> DataFrame:
    """P7 + J8 + V1: flow at time positions ``lo..hi`` for every map feature, zero-filled.

    ``flow``: ``id, time, flow``; ``steps``: ``time, time_idx`` (W3); ``features``: ``vpu, id``.
    The frame list is a generated range on the feature side, so the fill needs no cross join.
    """
    vals = (flow.join(steps.filter(F.col("time_idx").between(lo, hi)), "time")
                .select("id", "time_idx", F.col("flow").alias("value")))
    frames = features.select("vpu", "id", F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("time_idx"))
    return map_table(frames, vals, ["id", "time_idx"], fill)
