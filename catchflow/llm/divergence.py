"""Source divergence audit over run-length columns.

Every (lang, source) group and every lang give each kept term of the lang a smoothed share of 1,000,000,000; two
groups diverge by the sum, over all kept terms, of ``f(p, q) = floor((p - q)^2 / q)``. All figures are whole numbers.

1. *Counts.* Tasks count terms by group and pass on one row for each (lang, source, term); one shuffle by (lang, term)
   gives each term its sparse count vector over the sources, its documents and its occurrences.
2. *Reordered vocabulary.* Terms with the same vector are one pattern with a length, so the billions of rare terms
   become few rows. Patterns are dealt by their hash into ``PARTS`` parts a lang and sorted within, which puts equal
   counts side by side.
3. *Run-length columns.* In each part the column of a group is its runs of equal counts. For two groups the run
   boundaries are intersected and f is computed once for each common run and multiplied by the run's length. Sums
   are additive, so parts work alone and Spark adds them up; no pair of groups ever reads a term twice.

Memory: a task holds one part's sums, a square of the lang's number of sources, and ``CHUNK`` patterns; a lang's
sources are as many as the rows of the answer for one of its groups. Nothing goes to the driver.

Results in edge cases: null text, lang and source are read as ''. Repeated rows and ids are documents of their own. A
group without terms has count 0 everywhere; where a lang keeps no term, its groups' pair values are 0 and there are
no term rows. A lang with a single source has no pair rows. Ties go to the smaller item by UTF-8 bytes. No rows give
no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import LOWER, blocks, keep_table, partitions, prepare, text_bytes

SCALE = 1_000_000_000
PARTS = 64  # parts of a lang's vocabulary
CHUNK = 4096  # patterns whose columns are built at a time
FLUSH_ROWS = 1_000_000
# [^\x00-\x40\x5B-\x60\x7B-\x7F]: ASCII letters and all bytes of other characters
TERM = np.zeros(256, bool)
TERM[65:91] = TERM[97:123] = TERM[128:] = True


# ---------------------------------------------------------------- counts

def term_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the terms; none crosses a text."""
    inside = TERM[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = True
    before, after = np.append(False, inside[:-1]), np.append(inside[1:], False)
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def term_strings(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as a column of strings, A-Z lower-cased."""
    size = ends - starts
    at = np.append(0, np.cumsum(size))
    data = LOWER[buf[np.repeat(starts - at[:-1], size) + np.arange(at[-1])]]
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs): occurrences and documents, added up over as much of a task as fits the bound."""
    held: list[pa.Table] = []

    def merged() -> pa.Table:
        t = pa.concat_tables(held).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
        return t.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "n", "docs"])

    for batch in batches:
        if not batch.num_rows:
            continue
        names, group = [], np.zeros(batch.num_rows, np.int64)
        for c in ("lang", "source"):
            d = batch.column(c).dictionary_encode()
            names.append(d.dictionary)
            group = group * len(d.dictionary) + d.indices.to_numpy(zero_copy_only=False)
        buf, offs = text_bytes(batch.column("text"))
        for lo, _, b, o in blocks(buf, offs):
            starts, ends, doc = term_spans(b, o)
            if not len(starts):
                continue
            d = term_strings(b, starts, ends).dictionary_encode()
            size = len(d.dictionary)
            key, n = np.unique(doc * size + d.indices.to_numpy(), return_counts=True)
            key, at, docs = np.unique(group[lo + key // size] * size + key % size, return_inverse=True, return_counts=True)
            g = key // size
            held.append(pa.table({"lang": names[0].take(pa.array(g // len(names[1]))), "source": names[1].take(pa.array(g % len(names[1]))),
                                  "term": d.dictionary.take(pa.array(key % size)).cast(pa.string()),
                                  "n": np.bincount(at, weights=n).astype(np.int64), "docs": docs.astype(np.int64)}))
            if sum(t.num_rows for t in held) >= FLUSH_ROWS:
                held = [merged()]
                if held[0].num_rows >= FLUSH_ROWS // 2:
                    yield from held.pop().combine_chunks().to_batches()
    if held:
        yield from merged().combine_chunks().to_batches()


# ---------------------------------------------------------------- run-length columns

def shares(count: np.ndarray, total: int) -> np.ndarray:
    """``1 + floor(SCALE * (count + 1) / total)``, exact for any count."""
    if count.max(initial=0) < 9_000_000_000:
        return 1 + SCALE * (count + 1) // total
    return np.array([1 + SCALE * (int(c) + 1) // total for c in count], np.int64)


def excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def run_sums(counts: np.ndarray, lengths: np.ndarray, totals: list[int]) -> np.ndarray:
    """``out[g, h]``: the sum of f over the vocabulary, column g's share against column h's.

    ``counts`` has a row for each pattern (``lengths`` terms alike) and a column for each group.
    """
    end = np.append(0, np.cumsum(lengths))
    starts, values = [], []  # the columns' runs
    for g, total in enumerate(totals):
        new = np.ones(len(counts), bool)
        new[1:] = counts[1:, g] != counts[:-1, g]
        at = np.flatnonzero(new)
        starts.append(at)
        values.append(shares(counts[at, g], total))
    out = np.zeros((len(totals), len(totals)), np.int64)
    if not len(counts):
        return out
    for g in range(len(totals)):
        for h in range(g + 1, len(totals)):
            cut = np.union1d(starts[g], starts[h])
            p = values[g][np.searchsorted(starts[g], cut, "right") - 1]
            q = values[h][np.searchsorted(starts[h], cut, "right") - 1]
            size = np.diff(np.append(end[cut], end[-1]))
            out[g, h] = (excess(p, q) * size).sum()
            out[h, g] = (excess(q, p) * size).sum()
    return out


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, part, flag, source, total, vec, len), a part's groups first -> a row for each ordered pair of groups."""
    now, groups, totals, sums, vecs, lens = None, {}, [], None, [], []

    def fold() -> None:
        nonlocal sums
        counts = np.zeros((len(vecs), len(groups)), np.int64)
        for i, v in enumerate(vecs):
            for x in v:
                counts[i, groups[x["source"]]] = x["n"]
        found = run_sums(counts, np.array(lens, np.int64), totals)
        sums = found if sums is None else sums + found
        vecs.clear()
        lens.clear()

    def close() -> Iterator[pa.RecordBatch]:
        if vecs:
            fold()
        if sums is None and now[1] == 0:  # no patterns here: part 0 still names all pairs
            fold()
        if sums is None:
            return
        names = list(groups)
        for g, name in enumerate(names):
            others = [h for h in range(len(names)) if h != g]
            if others:
                yield pa.RecordBatch.from_arrays([pa.array([now[0]] * len(others)), pa.array([name] * len(others)), pa.array([names[h] for h in others]),
                                                  pa.array(sums[g, others])], names=["lang", "source", "item", "value"])

    for b in batches:
        for lang, part, flag, source, total, vec, n in zip(*[b.column(c).to_pylist() for c in ("lang", "part", "flag", "source", "total", "vec", "len")]):
            if (lang, part) != now:
                if now is not None:
                    yield from close()
                now, groups, totals, sums = (lang, part), {}, [], None
            if not flag:
                groups[source] = len(groups)
                totals.append(total)
                continue
            vecs.append(vec)
            lens.append(n)
            if len(vecs) >= CHUNK:
                fold()
    if now is not None:
        yield from close()


# ---------------------------------------------------------------- the audit

def _share(count: Column, total: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / total)`` in decimals, without rounding."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", top, total.cast("decimal(20,0)"))


def source_divergence(docs: DataFrame, min_docs: int = 3, top: int = 200, parts: int = PARTS) -> DataFrame:
    """``docs`` (text, lang, source) -> lang, source, part ('pair' or 'term'), item, value, rank."""
    spark = docs.sparkSession
    prepare(spark)
    d = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    n = partitions(spark)
    counted = (d.mapInArrow(_count_terms, "lang string, source string, term string, n long, docs long").repartition(n, "lang", "term")
               .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    kept = keep_table(counted.groupBy("lang", "term")
                      .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("vec"))
                      .where(F.col("docs") >= min_docs).select("lang", "term", "n", "vec"), "audit-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_n"))
    used = kept.select("lang", F.inline("vec")).groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = keep_table(d.select("lang", "source").distinct().join(used, ["lang", "source"], "left").join(langs, "lang", "left")
                        .select("lang", "source", (F.coalesce("group_n", F.lit(0)) + F.coalesce("terms", F.lit(0))).alias("total"),
                                (F.coalesce("lang_n", F.lit(0)) + F.coalesce("terms", F.lit(0))).alias("lang_total")), "audit-groups")
    # pairs of groups
    patterns = kept.groupBy("lang", "vec").agg(F.count("*").alias("len"))
    head = groups.select("lang", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("flag"), "source", "total",
                         F.lit(None).cast(kept.schema["vec"].dataType).alias("vec"), F.lit(0).cast("long").alias("len"))
    body = patterns.select("lang", F.pmod(F.xxhash64("vec"), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("flag"),
                           F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("total"), "vec", "len")
    dealt = head.union(body).repartition(n, "lang", "part").sortWithinPartitions("lang", "part", "flag", "source", "vec")
    by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pair = (dealt.mapInArrow(_pair_sums, "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
            .withColumn("rank", F.row_number().over(by)).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank"))
    # terms of a group above their lang
    each = kept.select("lang", F.col("term").alias("item"), F.col("n").alias("lang_n"), F.inline("vec")).join(groups, ["lang", "source"])
    p, q = F.col("p"), F.col("q")
    term = (each.withColumn("p", _share(F.col("n"), F.col("total"))).withColumn("q", _share(F.col("lang_n"), F.col("lang_total"))).where("p > q")
            .withColumn("value", F.call_function("div", (p - q) * (p - q), q))
            .withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
    return pair.union(term)


def op13_run_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: every pair of a lang's sources, and each source's 200 terms furthest above their lang."""
    return source_divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT a.lang, a.source, coalesce(sum(c.n), 0) + coalesce(any_value(v.v), 0) AS total
      FROM (SELECT DISTINCT lang, source FROM d) a LEFT JOIN c ON c.lang = a.lang AND c.source = a.source LEFT JOIN v ON v.lang = a.lang
      GROUP BY a.lang, a.source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // g.total::HUGEINT AS p
      FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
l AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 1)) // (sum(sum(n)) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang))::HUGEINT AS q
      FROM c GROUP BY lang, term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST((p.p - l.q) * (p.p - l.q) // l.q AS BIGINT) AS value
          FROM p JOIN l ON l.lang = p.lang AND l.term = p.term WHERE p.n > 0 AND p.p > l.q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 200
"""
