"""Mixing sources to target weights by systematic sampling.

Targets: sources in code-point order (null last) weigh 1, 2, 3, repeating, and share all words; no target goes
above ``cap`` times its source's size and the excess is shared again by weight. That is water-filling: one level
``v`` with ``target = min(cap * size, v * weight)``, read off prefix sums over the sources sorted by
``cap * size / weight``: with the first sources at their caps, the rest gives a level; the right one is the first
that fits its source, and levels only fall from there on.

Sampling: every document of a source expects ``target / source_size`` copies. The running sum of expected copies
is the document's rank in its source times that figure; with one offset added, a document is emitted once per
integer the sum crosses. Ranks order a source by size class, so every class is thinned or repeated alike and the
taken words come near the target. Within a class the order goes by a hash, then size, then id. Ranks are row
numbers within (source, class, hash byte) plus prefix sums of those groups' counts: no task holds a whole source.
A source's offset is that of ``OFFSETS``, fixed draws, whose taken words come nearest to the target, which matters
where a few long documents hold much of a small source. Every draw is tried on all documents.

Ranks are worked out once, on rows without text, and written; texts meet the copies in one join by a row number.

Results in edge cases: a null or empty text has size 0 and still takes part; null sources are one source, last;
null or repeated ids and repeated rows are documents of their own; no rows give no rows; other columns go along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import keep_table, prepare, running_offsets

WEIGHTS = (1, 2, 3)
CAP = 3
# offsets to draw from: multiples of 2**-20, so that sums with whole numbers are exact
OFFSETS = tuple(((2 * i + 1) * 648_055 % (1 << 20)) / (1 << 20) for i in range(24))
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``. Windows here run over sources, not documents."""
    k = len(weights)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % k + 1).cast("int"))
    w = sizes.withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * cap)
    by = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    all_ = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(all_) - F.coalesce(F.sum("most").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             / F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing)))
    lv = w.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("most") / F.col("weight"), F.col("level"))
    return (lv.withColumn("v", F.max(fits).over(all_))
            .withColumn("target", F.least(F.col("most").cast("double"), F.col("v") * F.col("weight")))
            .select("source", "source_size", "target"))


def _grouped(d: DataFrame) -> DataFrame:
    """``grp``: size class and first hash byte, an order of a source's rows in which sizes rise."""
    bits = F.bin("size")
    salt = F.conv(F.substring("hash", 1, 2), 16, 10).cast("long")
    return d.withColumn("grp", (F.length(bits) * 32 + F.conv(F.substring(bits, 1, 5), 2, 10)).cast("long") * 256 + salt)


def _ranked(slim: DataFrame, base: DataFrame) -> DataFrame:
    """``slim`` with its rank ``k`` in its source."""
    w = Window.partitionBy("source", "grp").orderBy("size", "id", "hash")
    out = slim.withColumn("nth", F.row_number().over(w).cast("long") - 1)
    out = out.join(base, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("grp") == F.col("b_grp")))
    return out.withColumn("k", F.col("nth") + F.col("before")).drop("hash", "grp", "nth", "b_source", "b_grp", "before")


def _copies(offset: Column) -> Column:
    """The integers that the running sum of expected copies crosses."""
    k = F.col("k")
    return (F.floor(offset + (k + 1) * F.col("rate")) - F.floor(offset + k * F.col("rate"))).cast("long")


def _with_best_offset(ranked: DataFrame, targets: DataFrame, offsets: tuple[float, ...]) -> DataFrame:
    """``targets`` with ``offset``, of ``offsets`` the one whose taken words come nearest to the target (of equals the first)."""
    taken = [F.sum(_copies(F.lit(x)) * F.col("size")).alias(f"x{i}") for i, x in enumerate(offsets)]
    tried = (ranked.join(targets, F.col("source").eqNullSafe(F.col("t_source")))
             .groupBy("t_source").agg(F.first("target").alias("goal"), *taken))
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"x{i}") - F.col("goal")).alias("off"), F.lit(i).alias("i"), F.lit(x).alias("offset"))
                                 for i, x in enumerate(offsets)]))
    best = tried.select(F.col("t_source").alias("o_source"), best["offset"].alias("offset"))
    return targets.join(best, F.col("t_source").eqNullSafe(F.col("o_source"))).drop("o_source")


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP,
                  offsets: tuple[float, ...] = OFFSETS) -> DataFrame:
    """``docs`` (doc_id, source, text, ...) with ``size, source_size, target, copies``; input columns of these names go.

    Without text, ``docs`` must have the columns ``_size`` and ``_hash`` of ``n_words`` and ``content_hash``.
    """
    prepare(docs.sparkSession)
    rest = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "_size", "_hash")]
    slim_only = not rest_columns(rest)
    if "text" in docs.columns:
        size, hash_ = n_words("text"), content_hash()
    else:
        size, hash_ = F.col("_size"), F.col("_hash")
    own = [F.col("source").alias("source"), F.col("doc_id").alias("id"), size.alias("size"), hash_.alias("hash")]
    rows = None
    if slim_only:
        slim = docs.select(*own)
    else:  # written once, so that a row's number is the same on every read
        rows = keep_table(docs.select(F.monotonically_increasing_id().alias("row"), *own, *[F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(rest)]), "mix-rows")
        slim = rows.select("row", "source", "id", "size", "hash")
    slim = keep_table(_grouped(slim), "mix-sizes")
    targets = source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap).select(
        F.col("source").alias("t_source"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"))
    targets = keep_table(targets, "mix-targets")
    base = running_offsets(slim.groupBy("source", "grp").count(), ["source"], "grp", "count", "before").select(
        F.col("source").alias("b_source"), F.col("grp").alias("b_grp"), "before")
    ranked = keep_table(_ranked(slim, keep_table(base, "mix-base")), "mix-ranks")
    targets = keep_table(_with_best_offset(ranked, targets, offsets), "mix-offsets")
    taken = (ranked.join(targets, F.col("source").eqNullSafe(F.col("t_source")))
             .withColumn("copies", _copies(F.col("offset"))))
    if slim_only:
        return taken.select(*[F.col({"source": "source", "doc_id": "id"}[c]).alias(c) for c in rest], "size", "source_size", "target", "copies")
    # the texts are shuffled once, at every size
    full = rows.select("row", *[f"c_{i}" for i in range(len(rest))]).join(taken.select("row", "size", "source_size", "target", "copies").hint("merge"), "row")
    return full.select(*[F.col(f"c_{i}").alias(c) for i, c in enumerate(rest)], "size", "source_size", "target", "copies")


def rest_columns(cols: list[str]) -> list[str]:
    """Columns beside the two that the sizes table has."""
    return [c for c in cols if c not in ("doc_id", "source")]


def content_hash() -> Column:
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"),
                          F.coalesce(F.col("text"), F.lit(""))))


def op8_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the default targets."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    slim = docs.select("doc_id", "source", n_words("text").alias("_size"), content_hash().alias("_hash"))
    return mix_documents(slim).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1 AS weight, 3 * source_size AS most FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM w),
t AS (SELECT source, source_size, least(CAST(most AS DOUBLE), (SELECT max(lev) FROM l WHERE lev <= most / weight) * weight) AS target FROM l),
r AS (
  SELECT doc_id, d.source, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY length(bin(size)), substr(bin(size), 1, 5), substr(h, 1, 2), size, doc_id, h) - 1 AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
o AS (SELECT unnest(range({len(OFFSETS)})) AS i, unnest([{", ".join(map(repr, OFFSETS))}]) AS x),
n AS (SELECT source, i, x, abs(sum(CAST((floor(x + (k + 1) * rate) - floor(x + k * rate)) * size AS BIGINT)) - any_value(target)) AS off
  FROM r, o GROUP BY source, i, x),
b AS (SELECT source, x FROM n QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, i) = 1)
SELECT doc_id, size, source_size, target, CAST((floor(x + (k + 1) * rate) - floor(x + k * rate)) * size AS BIGINT) AS taken
FROM r JOIN b ON r.source IS NOT DISTINCT FROM b.source
"""
