"""Grid -> catchment -> basin forcing (J1, A1, A2) and the long/wide reshape.

The coverage table is written once, so the planner knows its size: a small one is broadcast and the raster
streams through one whole-stage-codegen span (scan, hash join, partial aggregate), a large one is joined by
a shuffle on the cell, which AQE splits where it is skewed. One plan serves any size. The raster is cut to
the covered rows and columns by literal ranges, which reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def prepare_coverage(cov: DataFrame) -> DataFrame:
    """Coverage with each catchment's cell count, written once to the shared folder.

    A catchment is a (basin, divide) pair: basins that share divides (nested gages) count their cells each for
    itself. The written table cuts the polygon-clipping lineage: every use and any retry after a lost executor
    reads it instead of clipping again.
    """
    base = written(cov.select("basin_id", "divide_id", "iy", "ix", "coverage"), "coverage")  # overlay runs once
    ncell = base.groupBy("basin_id", "divide_id").agg(F.count(F.lit(1)).alias("n_cells"))
    return written(base.join(ncell, ["basin_id", "divide_id"]), "coverage-cells")


def covered_box(c: DataFrame) -> tuple[int, int, int, int] | None:
    """The covered index ranges: first and last row, first and last column; None without any cell."""
    y0, y1, x0, x1 = c.agg(F.min("iy"), F.max("iy"), F.min("ix"), F.max("ix")).first()
    return None if y0 is None else (y0, y1, x0, x1)


def covered_range(raster: DataFrame, c: DataFrame) -> DataFrame:
    """The raster's rows within the covered index ranges (four scalars, as literals the scan can use)."""
    box = covered_box(c)
    if box is None:
        return raster.filter(F.lit(False))
    y0, y1, x0, x1 = box
    return raster.filter(F.col("iy").between(y0, y1) & F.col("ix").between(x0, x1))


def catchment_mean(raster: DataFrame, cov: DataFrame, variables: list[str], missing: str = "poison",
                   time_col: str = "time", dense: str | None = None, join: str | None = None) -> DataFrame:
    """A1: coverage-weighted mean of each variable per (basin, catchment, time).

    ``missing='poison'`` (the reference rule): a covered cell that is NULL or has no raster row makes
    the result NULL; the denominator is all coverage. ``missing='skip'`` averages what is present.
    ``cov`` is either a plain coverage table or the output of :func:`prepare_coverage`. With ``dense``
    (an interval such as ``'1 hour'``) every catchment gets a row per step, NULL where no raster row exists.
    ``join`` is a join hint for the coverage side (``'merge'`` forces the shuffle join); by default the
    planner chooses by size.
    """
    variables = [v for v in variables if v in raster.columns]  # P10
    if missing not in ("poison", "skip"):
        raise ValueError(f"missing must be 'poison' or 'skip', not {missing!r}")
    c = cov if "n_cells" in cov.columns else prepare_coverage(cov)
    out = _weighted(covered_range(raster, c), c.hint(join) if join else c, variables, missing, time_col)
    return out if dense is None else _densify(out, raster, c, variables, time_col, dense)


def _densify(out: DataFrame, raster: DataFrame, c: DataFrame, variables: list[str], time_col: str,
             step: str) -> DataFrame:
    """``dense='1 hour'`` (any interval): one row per catchment and time step from the raster's first to
    last time, NULL where a step has no raster row at all. The spine is a ``sequence`` exploded per
    catchment (the output itself), joined to the means by key; no cross join."""
    t0, t1 = raster.agg(F.min(time_col), F.max(time_col)).first()  # two scalars
    if t0 is None:
        return out
    spine = F.sequence(F.lit(t0), F.lit(t1), F.expr(f"interval {step}"))
    cats = c.select("basin_id", "divide_id").distinct().select("basin_id", "divide_id", F.explode(spine).alias(time_col))
    return cats.join(out, ["basin_id", "divide_id", time_col], "left").select("basin_id", "divide_id", time_col, *variables)


def _weighted(raster: DataFrame, c: DataFrame, variables: list[str], missing: str, time_col: str) -> DataFrame:
    r = raster.select(time_col, "iy", "ix", *variables)
    j = r.join(c, ["iy", "ix"])
    aggs = [F.max("n_cells").alias("_n"), F.sum("coverage").alias("_c")]
    for v in variables:
        aggs += [F.sum(F.col(v) * F.col("coverage")).alias(f"_s_{v}"), F.count(v).alias(f"_k_{v}")]
        if missing == "skip":
            aggs.append(F.sum(F.when(F.col(v).isNotNull(), F.col("coverage"))).alias(f"_w_{v}"))
    g = j.groupBy("basin_id", "divide_id", time_col).agg(*aggs)
    outs = []
    for v in variables:
        if missing == "poison":
            e = F.when(F.col(f"_k_{v}") == F.col("_n"), F.try_divide(F.col(f"_s_{v}"), F.col("_c")))
        else:
            e = F.try_divide(F.col(f"_s_{v}"), F.col(f"_w_{v}"))
        outs.append(e.alias(v))
    return g.select("basin_id", "divide_id", time_col, *outs)


def catchment_mean_long(raster_long: DataFrame, cov: DataFrame, variables: list[str] | None = None,
                        time_col: str = "time") -> DataFrame:
    """A1 on the long raster (``time, iy, ix, variable, value``, as chunk scans produce it).

    Joins coverage to the long rows and aggregates per (catchment, time, variable), so the raster is
    never pivoted; only the catchment-level result is turned wide (``variables`` fixes the columns).
    Poisoning as in :func:`catchment_mean`: a covered cell without a value for the variable makes it NULL.
    """
    c = cov if "n_cells" in cov.columns else prepare_coverage(cov)
    r = covered_range(raster_long, c).select(time_col, "iy", "ix", "variable", "value")
    if variables:
        r = r.filter(F.col("variable").isin(variables))
    g = (r.join(c, ["iy", "ix"])
          .groupBy("basin_id", "divide_id", time_col, "variable")
          .agg(F.sum(F.col("value") * F.col("coverage")).alias("_s"), F.count("value").alias("_k"),
               F.max("n_cells").alias("_n"), F.sum(F.when(F.col("value").isNotNull(), F.col("coverage"))).alias("_c")))
    long = g.select("basin_id", "divide_id", time_col, "variable",
                    F.when(F.col("_k") == F.col("_n"), F.try_divide("_s", "_c")).alias("value"))
    return long.groupBy("basin_id", "divide_id", time_col).pivot("variable", variables).agg(F.max("value"))


def basin_mean(catchment: DataFrame, variables: list[str], time_col: str = "time",
               weights: DataFrame | None = None) -> DataFrame:
    """A2: unweighted mean of catchments per basin and time, skipping missing.

    With ``weights`` (``divide_id, weight``) the mean is weighted instead (e.g. by catchment area).
    """
    if weights is None:
        return catchment.groupBy("basin_id", time_col).agg(*[F.avg(v).alias(v) for v in variables])
    j = catchment.join(weights, "divide_id")
    return j.groupBy("basin_id", time_col).agg(*[
        F.try_divide(F.sum(F.col(v) * F.col("weight")), F.sum(F.when(F.col(v).isNotNull(), F.col("weight")))).alias(v)
        for v in variables])


def to_long(df: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """Stack variables to one ``variable, value`` axis."""
    return df.unpivot(keys, variables, "variable", "value")


def to_wide(df: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """P16 inverse: one column per variable (listed, so the pivot needs no extra pass); of duplicates the largest stays."""
    return df.groupBy(*keys).pivot("variable", variables).agg(F.max("value"))
