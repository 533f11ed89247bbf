"""Forecast-archive assembly: alignment, de-duplication, merge, promised-time checks.

Everything is keyed by columns, never by position or input order: the "keep last" order is an
explicit ``seq`` column (the catalog order), and de-duplication is a ``max_by`` aggregate, which
combines map-side, so a key holding a third of all rows is still spread over every task.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written


def align_forecast(runs: DataFrame, horizon: int, day: str | None = None, init_col: str = "init_hour",
                   step_col: str = "step") -> DataFrame:
    """J13 + P15 + D6: step ``h`` of every run, stamped with its valid time ``init + (h + 1) hours``.

    The valid day is ``to_date(time)``, so day D gathers the previous day's late runs and the same
    day's early runs. A missing run leaves only its own valid hour missing.
    """
    if not 0 <= horizon <= 23:
        raise ValueError(f"forecast horizon must be 0..23, not {horizon}")
    r = runs.filter(F.col(step_col) == horizon)
    r = r.withColumn("time", F.timestamp_add("HOUR", F.lit(horizon + 1), F.col(init_col)))
    r = r.withColumn("day", F.to_date("time"))
    if day is not None:
        r = r.filter(F.col("day") == F.lit(day).cast("date"))
    return r


def align_analysis(runs: DataFrame, day: str | None = None, init_col: str = "init_hour", step_col: str = "step") -> DataFrame:
    """J13 for analysis files: step 0 of every run, valid at its init hour."""
    r = runs.filter(F.col(step_col) == 0).withColumn("time", F.col(init_col))
    r = r.withColumn("day", F.to_date("time"))
    return r if day is None else r.filter(F.col("day") == F.lit(day).cast("date"))


def dedupe_last(df: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """Per key keep the row with the largest ``seq`` (keep-last by input order)."""
    others = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(seq)).alias("_r"))
    return g.select(*keys, *[F.col("_r")[c].alias(c) for c in others])


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def drop_vars(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the listed variables when present (absent names are ignored)."""
    return df.drop(*names)


def merge_fields(left: DataFrame, right: DataFrame, keys: list[str], on_conflict: str = "error") -> DataFrame:
    """Full outer merge by coordinates; equal or one-sided values coalesce.

    A conflict (both present and different) raises at run time with ``on_conflict='error'``
    (``raise_error``, lazily, inside the plan), keeps the left value with ``'first'`` or becomes NULL
    with ``'null'``. Columns present on one side only pass through.
    """
    lc = [c for c in left.columns if c not in keys]
    rc = [c for c in right.columns if c not in keys]
    common = [c for c in lc if c in rc]
    l = left.select(*keys, *[F.col(c).alias(f"_l_{c}") if c in common else F.col(c) for c in lc])
    r = right.select(*keys, *[F.col(c).alias(f"_r_{c}") if c in common else F.col(c) for c in rc])
    j = l.join(r, keys, "full_outer")
    out = []
    for c in common:
        a, b = F.col(f"_l_{c}"), F.col(f"_r_{c}")
        conflict = a.isNotNull() & b.isNotNull() & (a != b)
        merged = F.coalesce(a, b)
        if on_conflict == "error":
            e = F.when(conflict, F.raise_error(F.concat(F.lit(f"merge conflict in {c}")))).otherwise(merged)
        elif on_conflict == "first":
            e = merged
        elif on_conflict == "null":
            e = F.when(conflict, F.lit(None)).otherwise(merged)
        else:
            raise ValueError(f"on_conflict must be 'error', 'first' or 'null', not {on_conflict!r}")
        out.append(e.cast(left.schema[c].dataType).alias(c))
    rest = [F.col(c) for c in lc + rc if c not in common]
    return j.select(*keys, *out, *rest)


def merge_conflicts(left: DataFrame, right: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """J9 report: keys where any of ``cols`` is present on both sides with different values."""
    l = left.select(*keys, *[F.col(c).alias(f"left_{c}") for c in cols])
    r = right.select(*keys, *[F.col(c).alias(f"right_{c}") for c in cols])
    j = l.join(r, keys, "inner")
    cond = None
    for c in cols:
        k = F.col(f"left_{c}").isNotNull() & F.col(f"right_{c}").isNotNull() & (F.col(f"left_{c}") != F.col(f"right_{c}"))
        cond = k if cond is None else (cond | k)
    return j.filter(cond)


def merge_many(inputs: list[DataFrame], keys: list[str], on_conflict: str = "salvage", var: str = "variable",
               value: str = "value") -> tuple[DataFrame, DataFrame, DataFrame]:
    """J9 for any number of long inputs (``var, *keys, value``; a key once in each) in one grouped aggregate.

    The value of a key is that of the first input that has one; a later input that has another value there is in
    conflict. ``on_conflict``: ``'error'`` raises at run time, ``'first'`` keeps the first value, ``'null'`` drops the
    value, ``'salvage'`` sets every variable of an input that is in conflict anywhere aside as a whole and merges the
    rest. Conflicts are judged against the first input, whether or not that one is set aside itself.

    Returns the merged rows, the rows set aside (with ``input``, its number), and ``input, variable, n_values,
    n_conflicts`` for each variable of each input.
    """
    if on_conflict not in ("error", "first", "null", "salvage"):
        raise ValueError(f"on_conflict must be 'error', 'first', 'null' or 'salvage', not {on_conflict!r}")
    n = len(inputs)
    tagged = reduce(DataFrame.union, [d.select(F.lit(i).alias("_input"), var, *keys, F.col(value).alias("_value")) for i, d in enumerate(inputs)])
    each = [F.max(F.when(F.col("_input") == i, F.col("_value"))).alias(f"_v{i}") for i in range(n)]
    wide = written(tagged.where(F.col("_value").isNotNull()).groupBy(var, *keys).agg(*each), "merge")
    first = F.coalesce(*[F.col(f"_v{i}") for i in range(n)])
    differs = [F.col(f"_v{i}").isNotNull() & (F.col(f"_v{i}") != first) for i in range(n)]
    told = F.inline(F.array(*[F.struct(F.lit(i).alias("input"), F.col(f"_n{i}").alias("n_values"), F.col(f"_c{i}").alias("n_conflicts")) for i in range(n)]))
    counts = [c for i in range(n) for c in (F.count(f"_v{i}").alias(f"_n{i}"), F.count_if(differs[i]).alias(f"_c{i}"))]
    report = wide.groupBy(var).agg(*counts).select(var, told).where("n_values > 0").select("input", var, "n_values", "n_conflicts")
    merged, aside = first, [F.lit(False)] * n
    if on_conflict == "error":
        merged = F.when(reduce(lambda a, b: a | b, differs), F.raise_error(F.concat(F.lit("merge conflict in "), F.col(var)))).otherwise(first)
    elif on_conflict == "null":
        merged = F.when(~reduce(lambda a, b: a | b, differs), first)
    elif on_conflict == "salvage":
        bad = report.where("n_conflicts > 0").collect()  # names: at most inputs x variables
        aside = [F.col(var).isin([r[var] for r in bad if r["input"] == i]) if any(r["input"] == i for r in bad) else F.lit(False) for i in range(n)]
        merged = F.coalesce(*[F.when(~aside[i], F.col(f"_v{i}")) for i in range(n)])
    out = wide.select(var, *keys, merged.cast(inputs[0].schema[value].dataType).alias(value))
    kept = F.filter(F.array(*[F.struct(F.lit(i).alias("input"), F.when(aside[i], F.col(f"_v{i}")).alias(value)) for i in range(n)]), lambda s: s[value].isNotNull())
    salvaged = wide.select(var, *keys, F.inline(kept)).select("input", var, *keys, value)
    return out.where(F.col(value).isNotNull()), salvaged, report


def promised_hours(spark: SparkSession, begin: dt.datetime, end: dt.datetime, analysis: list[str], forecast: list[str], horizon: int) -> DataFrame:
    """What an archive of hourly runs promises for the valid hours ``begin .. end``: ``store, variable, time``.

    Analysis is valid at its run's hour; the forecast for a valid hour comes from the run ``horizon + 1`` hours before.
    """
    hours = int((end - begin).total_seconds() // 3600) + 1
    what = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).alias("variable")) for k, vs in (("anl", analysis), ("fcst", forecast)) for v in vs])
    h = spark.range(max(0, hours)).select(F.timestamp_add("HOUR", F.col("id"), F.lit(begin).cast("timestamp_ntz")).alias("time"), F.inline(what))
    init = F.when(F.col("kind") == "fcst", F.timestamp_add("HOUR", F.lit(-horizon - 1), F.col("time"))).otherwise(F.col("time"))
    return h.select(F.concat(F.date_format(init, "yyyyMMdd_HH"), F.lit("z_"), F.col("kind"), F.lit(".zarr")).alias("store"), "variable", "time")


def hour_status(promised: DataFrame, seen: DataFrame, errors: DataFrame) -> DataFrame:
    """One status for each promised hour and for each hour that is there without a promise.

    ``promised`` and ``seen`` have ``store, variable, time``, ``errors`` has ``store, variable``. ``present``: there;
    ``unreadable``: not there, and something of that variable of that run couldn't be read; ``missing``; ``extra``:
    there, but never promised.
    """
    key = ["store", "variable", "time"]
    have = seen.select(*key).distinct().withColumn("_seen", F.lit(True))
    bad = errors.select("store", "variable").distinct().withColumn("_bad", F.lit(True))
    p = promised.select(*key).distinct().withColumn("_promised", F.lit(True))
    j = p.join(have, key, "full").join(bad, ["store", "variable"], "left")
    status = (F.when(F.col("_promised").isNull(), "extra").when(F.col("_seen"), "present").when(F.col("_bad"), "unreadable").otherwise("missing"))
    return j.select(*key, status.alias("status"))


def keep_promised(df: DataFrame, catalog: DataFrame, keys: list[str]) -> DataFrame:
    """Keep only data at times the catalog promised (semi-join on variable and valid time)."""
    return df.join(catalog.select(*keys).distinct(), keys, "left_semi")


def completeness(catalog: DataFrame, df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Promised vs matched times per group; ``shortfall`` = promised - matched."""
    have = df.select(*keys).distinct().withColumn("_m", F.lit(1))
    j = catalog.select(*set(keys + by)).distinct().join(have, keys, "left")
    g = j.groupBy(*by).agg(F.count(F.lit(1)).alias("n_promised"), F.count("_m").alias("n_matched"))
    return g.withColumn("shortfall", F.col("n_promised") - F.col("n_matched"))


def required_vars(df: DataFrame, required: list[str], key: str = "init_hour", var: str = "variable"):
    """Keep the ``key`` groups that have every required variable; also return the skipped keys."""
    present = (df.filter(F.col(var).isin(required)).select(key, var).distinct()
                 .groupBy(key).agg(F.count(F.lit(1)).alias("_k")))
    ok = present.filter(F.col("_k") == len(required)).select(key)
    kept = df.join(ok, key, "left_semi")
    skipped = df.select(key).distinct().join(ok, key, "left_anti")
    return kept, skipped
