"""Simulated vs observed: ensemble alignment and mean, NSE score tables, extreme-feature search.

Series are long (``datetime, id, value``), so aligning N members needs no N-way join (J4): a pivot
with an explicit id list is one aggregate. Scores for every member (and the mean member) are one
grouped aggregate over a single join with the observations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nse import nse, obs_ss, sse


def ensemble_wide(series: DataFrame, ids: list[str], key: str = "datetime") -> DataFrame:
    """One column per member, outer-aligned on ``key``; of duplicate keys the largest value stays (A16 reports them)."""
    return series.groupBy(key).pivot("id", ids).agg(F.max("value"))


def ensemble_mean(series: DataFrame, key: str = "datetime", by: list[str] | None = None) -> DataFrame:
    """A3: mean across members per time step, skipping missing."""
    by = by or []
    return series.groupBy(*by, key).agg(F.avg("value").alias("value"))


def with_mean_member(members: DataFrame, key: str = "datetime", name: str = "mean",
                     by: list[str] | None = None) -> DataFrame:
    """The ensemble mean joins the members as one more member, scored like the others."""
    by = by or []
    m = ensemble_mean(members, key, by).withColumn("id", F.lit(name))
    return members.select(*by, key, "id", "value").unionByName(m.select(*by, key, "id", "value"))


def nse_table(obs: DataFrame, members: DataFrame, mode: str = "masked", key: str = "datetime",
              by: list[str] | None = None) -> DataFrame:
    """NSE per member id (and per ``by`` group, e.g. gage).

    ``obs``: ``[by], key, obs``; ``members``: ``[by], key, id, value``.
    ``mode='masked'``: inner join, both present, mean of matched observations (J5, P12).
    ``mode='obs_all'``: numerator over matched pairs; mean and denominator over all observations
    present in ``obs`` (J6); the denominator is one aggregate per group, joined back.
    """
    by = by or []
    j = members.join(obs, by + [key], "inner").where(F.col("obs").isNotNull() & F.col("value").isNotNull())
    if mode == "masked":
        return j.groupBy(*by, "id").agg(nse("obs", "value").alias("nse"),
                                         F.count(F.lit(1)).alias("n"))
    if mode != "obs_all":
        raise ValueError(f"mode must be 'masked' or 'obs_all', not {mode!r}")
    num = j.groupBy(*by, "id").agg(sse("obs", "value").alias("num"), F.count(F.lit(1)).alias("n"))
    if by:
        den = obs.groupBy(*by).agg(obs_ss("obs").alias("den"))
        out = num.join(den, by)
    else:  # one series: the denominator is one scalar
        den = obs.agg(obs_ss("obs")).first()[0]
        out = num.withColumn("den", F.lit(den).cast("double"))
    return out.select(*by, "id", F.when(F.col("den") > 0, F.lit(1.0) - F.try_divide("num", "den")).alias("nse"), "n")


# ---------------------------------------------------------------- routed-flow features

def position_index(df: DataFrame, col: str, name: str) -> DataFrame:
    """0-based dense position of the distinct values of ``col``; join it back by value.

    Numbered over the distinct values only (never the facts), range-partitioned, so no single
    task sorts the whole dimension.
    """
    from .ordering import ordered_index
    idx = ordered_index(df.select(col).distinct(), [col], name)
    return idx.select(col, F.col(name).cast("int").alias(name))


def feature_stats(flow: DataFrame, idx: DataFrame | None = None, dt: float | None = None) -> DataFrame:
    """A7-A10 in one aggregate pass: ``nonzero`` (NULL is not non-zero), ``peak``, ``flow_sum``, ``duration``.

    ``flow_sum`` is the plain sum of flow, as the reference reports it; with ``dt`` (seconds per step)
    a ``volume`` column (sum x dt) is added.
    """
    aggs = [F.coalesce(F.bool_or(F.col("flow") != 0), F.lit(False)).alias("nonzero"),
            F.max("flow").alias("peak"),
            F.sum("flow").alias("flow_sum"),
            F.count_if(F.col("flow") > 0).alias("duration")]
    if dt is not None:
        aggs.append((F.sum("flow") * F.lit(float(dt))).alias("volume"))
    g = flow.groupBy("feature_id").agg(*aggs)
    if idx is not None:
        g = g.join(idx, "feature_id")
    return g


def top_feature(stats: DataFrame, metric: str, order_col: str = "feature_idx") -> DataFrame:
    """A8-A10 + O5: the non-zero feature with the largest ``metric``; ties keep the first index."""
    return (stats.filter("nonzero").orderBy(F.col(metric).desc(), F.col(order_col).asc()).limit(1)
                 .select(order_col, "feature_id", F.lit(metric).alias("metric"), F.col(metric).cast("double").alias("score")))


def join_three(routed: DataFrame, ensemble: DataFrame, obs: DataFrame, year: int | None = None,
               key: str = "datetime") -> DataFrame:
    """J7 (+ P6): routed flow x ensemble mean x observed, inner on time, optionally one year."""
    j = routed.join(ensemble, key).join(obs, key)
    if year is None:
        return j
    return j.filter((F.col(key) >= F.lit(f"{year}-01-01").cast("timestamp_ntz"))
                    & (F.col(key) < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")))


def first_nonzero(stats: DataFrame, order_col: str = "feature_idx") -> DataFrame:
    """The non-zero feature with the smallest position (one row)."""
    return stats.filter("nonzero").orderBy(order_col).limit(1).select(order_col, "feature_id")
