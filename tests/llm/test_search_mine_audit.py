"""Operators 11 to 13 against plain versions, on whole small tables and on tricky rows."""

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from llm_rows import SF, tricky_rows
from pyspark.sql import functions as F

from catchflow.llm import collision_search as cs
from catchflow.llm import divergence as dv
from catchflow.llm import hard_negatives as hn

VEC = "vec_id long, embedding array<double>, label int"


def tricky_vectors():
    rng = np.random.default_rng(5)
    base = [[float(c) for c in np.round(rng.standard_normal(4), 3)] for _ in range(40)]
    rows = [(i, e, i % 3) for i, e in enumerate(base)]
    rows += [(50, base[0], 0), (100, base[1], 1), (100, base[1], 1), (150, [2 * x for x in base[2]], 2), (200, base[3], 0), (250, [0.0] * 4, 1)]
    rows += [(300, None, 1), (350, [], 1), (400, [1.0, None, 0.0, 0.0], 1), (450, [math.nan, 1.0, 0.0, 0.0], 1), (500, [math.inf, 0.0, 0.0, 0.0], 0)]
    rows += [(550, [1.0, 2.0], 1), (551, [1.0, 2.1], 1), (552, [-1.0, 0.4], 0), (600, [3.0], 2), (None, base[4], 0), (650, base[5], None), (700, base[6], 8), (701, base[6], 9)]
    rows += [(750, [1e300, 0.0, 1e300, 0.0], 1), (751, [1e-300, 0.0, 1e-300, 0.0], 2)]
    return rows


def plain_nearest(rows, k=5):
    good = [(n, i, e) for n, (i, e, _) in enumerate(rows) if e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    out = []
    for n, i, e in good:
        if i is None or i % 50:
            continue
        def cosine(f):
            a, b = (np.ldexp(np.array(v), -max(math.frexp(x)[1] for x in v if x)) for v in (e, f))
            return float((a * b).sum() / (np.sqrt((b * b).sum()) * np.sqrt((a * a).sum())))
        near = sorted((-cosine(f), math.inf if j is None else j) for m, j, f in good if m != n and len(f) == len(e))[:k]
        out += [(i, r + 1, None if j == math.inf else j, -c) for r, (c, j) in enumerate(near)]
    return out


def plain_mine(rows):
    good = [(n, i, (la + 1) % 10 if i is not None and i % 7 == 0 else la, [math.floor(256 * x) for x in e])
            for n, (i, e, la) in enumerate(rows) if la is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for n, i, la, e in good:
        if i is None or i % 50:
            continue
        scored = [(sum(x * y for x, y in zip(e, f)), math.inf if j is None else j, lb) for m, j, lb, f in good if m != n and len(e) == len(f)]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for p, j, _ in [s for s in scored if s[2] == la][:5]:
            for r, (s, q, _) in enumerate([s for s in scored if s[2] != la and 50 * p <= 100 * s[0] <= 95 * p][:3]):
                out.append((i, None if j == math.inf else j, r + 1, None if q == math.inf else q, p, s))
    return out


def key(t):
    return tuple((x is None, x or 0) for x in t)


def same_up_to_rounding(got, want):
    got, want = sorted(got, key=lambda t: key(t[:3])), sorted(want, key=lambda t: key(t[:3]))
    assert [t[:3] for t in got] == [t[:3] for t in want]
    assert np.allclose([t[3] for t in got], [t[3] for t in want], rtol=0, atol=1e-12)


@pytest.mark.parametrize("block", [1000, 7])
def test_search_equals_brute_force_on_tricky_rows(spark, block):
    rows = tricky_vectors()
    df = spark.createDataFrame(rows, VEC)
    for d in (df, df.select("*", *[F.lit(1).alias(c) for c in ("node", "dim", "block", "query", "score", "rank", "query_id")])):
        got = [tuple(r) for r in cs.search(d, F.col("vec_id") % 50 == 0, block=block).collect()]
        same_up_to_rounding(got, plain_nearest(rows))  # few rows: the windows reach them all


def test_search_recall_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    got = cs.op11_collision_search(spark, sf)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and dict(got.dtypes)["rank"] == "int"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids = np.array([r[0] for r in rows])
    x = cs.unit(np.array([r[1] for r in rows], float))
    found, hits = defaultdict(list), 0
    for r in got.orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    for n in np.flatnonzero(ids % 50 == 0):
        c = x @ x[n]
        c[n] = -2
        mine = found.pop(int(ids[n]))
        hits += len({i for i, _ in mine} & set(ids[np.argsort(-c)[:5]].tolist()))
        assert len(mine) == 5 and all(abs(s - c[ids == i][0]) < 1e-12 for i, s in mine) and [s for _, s in mine] == sorted((s for _, s in mine), reverse=True)
    assert not found and hits >= 0.95 * 5 * (ids % 50 == 0).sum()


def test_search_verifies_few_where_neighbours_are_near():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((200, 32))
    x = (centres[:, None] + 0.1 * rng.standard_normal((200, 20, 32))).reshape(-1, 32)
    arrays = cs.SortedArrays(np.arange(len(x)), np.arange(len(x)), x)
    u = cs.unit(x)
    hits = 0
    for n in range(0, len(x), 40):
        c = u @ u[n]
        c[n] = -2
        hits += len(set(arrays.nearest(n, x[n], 5)[0].tolist()) & set(np.argsort(-c)[:5].tolist()))
    assert hits >= 0.95 * 500 and arrays.verified <= 0.05 * 100 * len(x)


def test_window_factor_gives_the_promised_probability():
    rng = np.random.default_rng(4)
    z = cs.window_factor(64, 48, 0.95)
    inside = (np.abs(rng.standard_normal((20000, 64))) <= z).sum(1)
    assert abs((inside >= 48).mean() - 0.95) < 0.01


@pytest.mark.parametrize("block", [1000, 7])
def test_mining_equals_brute_force_on_tricky_rows(spark, block):
    rows = [r for r in tricky_vectors() if r[0] not in (750, 751)]
    df = spark.createDataFrame(rows, VEC)
    for d in (df, df.select("*", *[F.lit(1).alias(c) for c in ("node", "dim", "block", "query", "positives", "place", "vec", "rank")])):
        got = sorted((tuple(r) for r in hn.mine(d, block=block).collect()), key=key)
        assert got == sorted(plain_mine(rows), key=key) and got


def test_mining_equals_sql_in_small_blocks(spark):
    sf = "/root/testdata/sf0.1"
    got = sorted(tuple(r) for r in hn.mine(spark.read.parquet(f"{sf}/embeddings.parquet"), block=300).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert got == sorted(con.execute(hn.OP12_SQL).fetchall())


def test_multi_index_stops_early_and_is_exact():
    rng = np.random.default_rng(9)
    centres = rng.integers(-200, 200, (16, 16))
    rows = (centres[:, None] + rng.integers(-8, 9, (16, 250, 16))).reshape(-1, 16)
    labels = rng.integers(0, 4, len(rows))
    books = hn.codebook(rows[::8, :8].astype(float)), hn.codebook(rows[::8, 8:].astype(float))
    index = hn.MultiIndex(np.arange(len(rows)), np.arange(len(rows)), labels, rows, books)
    scored = 0
    for n in range(0, len(rows), 97):
        score = rows @ rows[n]
        bounds = [b for b, _ in index.visits(rows[n])]
        assert bounds == sorted(bounds, reverse=True)
        best = [i for i in np.lexsort((np.arange(len(rows)), -score)) if labels[i] == labels[n] and i != n][:5]
        before = index.scored
        got, s = index.positives(n, labels[n], rows[n], 5)
        scored += index.scored - before
        assert index.ids[got].tolist() == best and s.tolist() == score[best].tolist()
        for p, (got, s) in zip(s.tolist(), index.negatives(labels[n], rows[n], s.tolist(), 3)):
            ok = (labels != labels[n]) & (100 * score >= 50 * p) & (100 * score <= 95 * p)
            want = [i for i in np.lexsort((np.arange(len(rows)), -score)) if ok[i]][:3]
            assert index.ids[got].tolist() == want
    assert scored < 0.4 * len(rows) * len(range(0, len(rows), 97))


def test_products_beyond_doubles_are_exact():
    rows = np.array([[2 ** 40, 3], [-(2 ** 40), 5]])
    assert hn.products(rows, np.array([2 ** 40 + 1, 1])).tolist() == [2 ** 80 + 2 ** 40 + 3, -(2 ** 80) - 2 ** 40 + 5]


def plain_audit(rows, top=200):
    docs = [((la or ""), (so or ""), Counter(t.translate({i: i + 32 for i in range(65, 91)}) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", tx or ""))) for _, tx, la, so, _ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df, groups = Counter(), defaultdict(Counter)
        for la, so, c in docs:
            if la == lang:
                df.update(c.keys())
                groups[so].update(c)
        kept = [t for t in df if df[t] >= 3]

        def share(c):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // total for t in kept}
        p, whole = {g: share(c) for g, c in groups.items()}, share(sum(groups.values(), Counter()))
        for g in groups:
            pairs = [(sum((p[g][t] - p[h][t]) ** 2 // p[h][t] for t in kept), h) for h in groups if h != g]
            terms = [((p[g][t] - whole[t]) ** 2 // whole[t], t) for t in kept if groups[g][t] and p[g][t] > whole[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, g, part, i, v, r + 1) for r, (v, i) in enumerate(ranked) if part == "pair" or r < top]
    return sorted(out)


def test_audit_equals_plain_version_on_tricky_rows(spark, tricky_clash, none):
    rows = tricky_rows() + [(60 + i, f"shared tErm Übung {'α ' * (i + 1)} w{i}", "xx", f"s{i % 4}", 1) for i in range(9)]
    rows += [(80, "lonely words", "yy", "a", 1), (81, "other things", "yy", "b", 1), (82, None, "yy", "c", 1), (83, "once once once", "zz", None, 1)]
    df = spark.createDataFrame(rows, tricky_clash.select("doc_id", "text", "lang", "source", "n_chars").schema)
    for parts in (1, 5):
        got = sorted(tuple(r) for r in dv.source_divergence(df, parts=parts).collect())
        assert got == plain_audit(rows)
    assert sorted(tuple(r) for r in dv.source_divergence(tricky_clash).collect()) == plain_audit(tricky_rows())
    assert dv.source_divergence(none).count() == 0


def test_audit_equals_plain_version_on_the_whole_table(spark):
    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in dv.op13_run_columns(spark, SF).collect()) == plain_audit(rows)


def test_run_sums_equal_sums_over_terms():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 3, (200, 4)) * rng.integers(0, 2, (200, 4))
    counts = counts[np.lexsort(counts.T[::-1])]
    counts[:5] *= 20_000_000_000  # beyond longs when scaled
    lengths, totals = rng.integers(1, 6, 200), [int(t) for t in counts.sum(0) + 900]
    got = dv.run_sums(counts, lengths, totals)
    for g in range(4):
        for h in range(4):
            p, q = ([1 + 10 ** 9 * (int(c) + 1) // totals[i] for c in counts[:, i]] for i in (g, h))
            assert got[g, h] == sum(int(n) * ((x - y) ** 2 // y) for x, y, n in zip(p, q, lengths))


def test_empty_vector_tables(spark):
    none = spark.createDataFrame([], VEC)
    assert cs.search(none, F.col("vec_id") % 50 == 0).count() == 0 and hn.mine(none).count() == 0
