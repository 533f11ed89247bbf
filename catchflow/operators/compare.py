"""Side-by-side comparison helpers (U4 P4 P6 P18 P19), table profile (A15), seeded sampling (P14), previews (O3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_union(sources: dict[str, DataFrame], keys: list[str], variables: list[str]) -> DataFrame:
    """U4: union of sources with a ``source`` label, variables unpivoted to ``variable, value``."""
    out = None
    for name, df in sources.items():
        vs = [v for v in variables if v in df.columns]  # P10: common variables only
        long = df.select(*keys, *vs).unpivot(keys, vs, "variable", "value").withColumn("source", F.lit(name))
        out = long if out is None else out.unionByName(long)
    return out


def in_range(df: DataFrame, col: str, lo: str, hi: str) -> DataFrame:
    """Inclusive time range (literals, so the predicate pushes down to the scan)."""
    return df.filter(F.col(col).between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")))


def slice_year(df: DataFrame, col: str, year: int) -> DataFrame:
    """Partial-date slice ``"2007"`` as a half-open, sargable range."""
    return df.filter((F.col(col) >= F.lit(f"{year}-01-01").cast("timestamp_ntz"))
                     & (F.col(col) < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")))


def in_span(obs: DataFrame, sim: DataFrame, col: str = "datetime") -> DataFrame:
    """P19 + A18: keep observations within the simulated first..last time.

    The span is one aggregate row, fetched as two scalars; as literals the range reaches the scan's
    pushed filters (no join at all).
    """
    t0, t1 = sim.agg(F.min(col), F.max(col)).first()
    if t0 is None:
        return obs.limit(0)
    return obs.filter(F.col(col).between(F.lit(t0), F.lit(t1)))


def profile(df: DataFrame) -> DataFrame:
    """One aggregate pass; per column its type, row count and non-null count."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(f"_nn_{i}") for i, c in enumerate(cols)])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                              F.col(f"_nn_{i}").alias("n_non_null")) for i, c in enumerate(cols)])
    return agg.select(F.col("_n").alias("n_rows"), F.inline(rows)).select(
        "column", "dtype", F.col("n_rows").cast("bigint"), F.col("n_non_null").cast("bigint"))


def sample_ids(ids: DataFrame, col: str, n: int, seed: int) -> DataFrame:
    """``n`` seeded draws with replacement from the distinct ids.

    Draw ``i`` picks position ``md5(seed:i) mod count`` (its first 8 hex digits) of the sorted distinct ids; the
    draws are generated as rows and joined to a position index of the ids (an equi-join).
    """
    from .ordering import ordered_index
    spark = ids.sparkSession
    d = ids.select(col).distinct()
    idx = ordered_index(d, [col], "_pos")
    total = idx.count()  # one scalar
    draws = spark.range(n).select(F.col("id").alias("draw"),
                                  (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))), 1, 8), 16, 10)
                                   .cast("long") % F.lit(total)).alias("_pos"))
    return draws.join(idx, "_pos").select("draw", col)


def head_tail(df: DataFrame, order: str, n: int = 5):
    """O3: first and last ``n`` rows by ``order`` (TakeOrderedAndProject, no full sort)."""
    return df.orderBy(F.col(order).asc()).limit(n), df.orderBy(F.col(order).desc()).limit(n)

