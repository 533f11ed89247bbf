import math
from collections import defaultdict

import numpy as np
import pytest
from brute import near_groups, repeats, sha, vector_links
from llm_rows import SF, tricky_rows
from pyspark.sql import functions as F

from catchflow.llm import graph, metric_join, ngram_join, suffix_dedup

key = lambda rows: sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


# ---------------------------------------------------------------- components

def test_components_of_chains_stars_and_loops(spark):
    rng = np.random.default_rng(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(500, 500), (700, 701), (701, 700)]
    edges += [tuple(sorted(map(int, rng.integers(1000, 1100, 2)))) for _ in range(60)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    table = spark.createDataFrame(edges + [(None, 3)], "a long, b long").repartition(24)
    for least_hub in (graph.HUB, 2, 0):  # no hubs, some, all nodes that may be
        got = {r["node"]: r["root"] for r in graph.components(table, least_hub).collect()}
        assert got == {x: find(x) for x in list(up)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hub_edges_are_not_shuffled_by_their_hub(spark):
    """A node with half of all edges is joined by a broadcast, and what is broadcast is bounded by the share."""
    n = 6000
    e = spark.createDataFrame([(n + i, 0) for i in range(n)] + [(9 * n, n + i) for i in range(n)], "u long, v long")
    low = graph._low(e)
    hub = max(graph.HUB, 2 * 2 * n // graph.MOST)
    assert [r["c"] for r in low.where(F.col("n") > hub).collect()] == [9 * n]
    got = graph._beside(e, low, hub)
    assert "BroadcastHashJoin" in got._jdf.queryExecution().toString()
    assert got.where("u = 54000").agg(F.count("*"), F.min("m"), F.max("m")).first() == (n, n, n)
    assert got.count() == 2 * n


def test_contraction_in_small_pieces(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(graph, "CONTRACT", 3)
    pieces = [pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
              for u, v in (([2, 3], [1, 2]), ([4, 9], [3, 8]), ([], []), ([5], [4]))]
    out = [sorted(zip(b.column("u").to_pylist(), b.column("v").to_pylist())) for b in graph._contract(iter(pieces))]
    assert out == [[(2, 1), (3, 1), (4, 1), (9, 8)], [(5, 4)]]
    assert list(graph._contract(iter([]))) == []


# ---------------------------------------------------------------- vectors

def vectors():
    rng = np.random.default_rng(1)
    rows, n = [], 0
    for label in (0, 1, 2):
        centres = rng.normal(size=(5, 8))
        for _ in range(60):
            c = centres[rng.integers(5)]
            rows.append((n, [float(x) for x in c + rng.normal(size=8) * rng.choice([0, 0.05, 0.3])], label))
            n += 1
    rows += [(n, None, 0), (n + 1, [0.0] * 8, 0), (n + 2, [1.0, None] + [0.0] * 6, 0), (n + 3, [math.nan] + [1.0] * 7, 0), (n + 4, [math.inf] + [1.0] * 7, 0),
             (n + 5, rows[0][1], None), (n + 6, rows[0][1], 0), (n + 6, rows[0][1], 0), (n + 7, rows[0][1][:4], 0), (n + 8, [], 0), (None, rows[0][1], 0),
             (n + 9, [3.0, 4.0], 7), (n + 10, [0.0, 1.0], 7), (n + 11, [30.0, 40.0], 7)]
    return rows


@pytest.mark.parametrize("cell", [2048, 10])
def test_links_equal_brute_force(spark, cell):
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, node int, links int")
    exact = [(r[0], [None if x is None else float(np.float32(x)) for x in r[1]] if r[1] is not None else None, r[2]) for r in rows]
    got = metric_join.link_embeddings(df, cell=cell, pivots=40)
    assert key((r["vec_id"], r["n_links"], r["component_id"]) for r in got.collect()) == key(vector_links(exact))
    assert got.where("kept AND vec_id <> component_id").count() == 0
    assert metric_join.link_embeddings(df.limit(0)).count() == 0


def test_pivots_send_only_boundary_vectors():
    rng = np.random.default_rng(2)
    p = np.eye(8)[:4]
    x = rng.normal(size=(500, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cells = metric_join.Cells({(0, 8): p}, 0.2)
    home, goes = cells.assign((0, 8), x)
    near = x @ x.T >= 1 - 0.2 ** 2 / 2
    for i, j in zip(*np.nonzero(near)):  # whoever is within reach is sent to the other's home
        assert goes[j, home[i]]
    tight = np.repeat(p, 50, 0) + rng.normal(size=(200, 8)) * 0.01
    tight /= np.linalg.norm(tight, axis=1, keepdims=True)
    assert cells.assign((0, 8), tight)[1].sum() == 200  # far from all boundaries: no replication


# ---------------------------------------------------------------- shingle sets

@pytest.mark.parametrize("group", [2000, 2])
def test_sets_equal_brute_force(spark, tricky_clash, group):
    got = ngram_join.link_sets(tricky_clash, group=group)
    want = near_groups([(r[0], r[1]) for r in tricky_rows()])
    assert key((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == key(want)


def test_sets_of_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = ngram_join.op7_signature_trees(spark, SF).collect()
    assert key((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == key(near_groups(docs))


def test_sets_of_an_empty_table(spark, none):
    assert ngram_join.link_sets(none).count() == 0


def test_linked_sets_share_a_name():
    """The pigeonhole: any two sets at the limit have a part in common that both send."""
    rng = np.random.default_rng(9)
    parts = ngram_join.Parts(85)
    for n in [1, 2, 5, 6, 7, 11, 12, 13, 20, 40, 100, 333, 1000]:
        for trial in range(60):
            y = rng.choice(1 << 62, 2 * n + 40, replace=False).astype(np.uint64) * np.uint64(3)
            common = n
            extra_a, extra_b = int(rng.integers(0, n // 5 + 2)), int(rng.integers(0, n // 5 + 2))
            if 100 * common < 85 * (common + extra_a + extra_b):
                continue
            a, b = np.sort(y[:common + extra_a]), np.sort(np.concatenate([y[:common], y[common + extra_a:common + extra_a + extra_b]]))
            k, at = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
            name, row = ngram_join.part_names(k, at, np.array([0, 1]), parts)
            assert set(name[row == 0].tolist()) & set(name[row == 1].tolist()), (n, extra_a, extra_b)


def test_tree_joins_like_all_pairs():
    rng = np.random.default_rng(4)
    for trial in range(6):
        sets = []
        for _ in range(12):
            base = rng.choice(1 << 60, int(rng.integers(1, 120)), replace=False)
            for _ in range(int(rng.integers(1, 9))):
                s = base[rng.random(len(base)) > rng.choice([0, 0.02, 0.08, 0.2])]
                sets.append(np.unique(np.concatenate([s, rng.choice(1 << 60, int(rng.integers(0, 4)))])).astype(np.uint64))
        sets = [s for s in sets if len(s)]
        comp = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                if ngram_join.linked(sets[i], sets[j], 85):
                    a, b = comp[i], comp[j]
                    comp = [min(a, b) if c in (a, b) else c for c in comp]
        got = ngram_join.join_group(sets, 85)
        pairs = defaultdict(set)
        for x, y in zip(got.tolist(), comp):
            pairs[x].add(y)
        assert all(len(v) == 1 for v in pairs.values()) and len(pairs) == len(set(comp))


# ---------------------------------------------------------------- repeated strings

def ordered(rows):
    """Rows in the operator's order: null ids first; of one id, by a hash of the text (first rows of equal ones first)."""
    import hashlib
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, int(hashlib.md5((r[1] or "").encode()).hexdigest()[:15], 16)))


@pytest.mark.parametrize("length", [64, 100, 150])
def test_repeats_equal_brute_force(spark, tricky_clash, length):
    docs = ordered([(r[0], r[1]) for r in tricky_rows()])
    want = repeats(docs, length)
    got = suffix_dedup.remove_repeats(tricky_clash, length=length, with_text=True).collect()
    assert key((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == key(want)
    assert all(sha(bytes(r["kept"])) == r["kept_sha256"] for r in got)
    slim = suffix_dedup.remove_repeats(tricky_clash, length=length).collect()
    assert key((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in slim) == key((*w[:4], sha(w[4])) for w in want)
    assert {"node", "md5", "row", "c_0"} <= set(suffix_dedup.remove_repeats(tricky_clash).columns)


def test_repeats_of_whole_table(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = suffix_dedup.op3_previous_factors(spark, SF).collect()
    assert key((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == key((*w[:4], sha(w[4])) for w in repeats(docs))


def test_repeats_of_an_empty_table(spark, none):
    out = suffix_dedup.remove_repeats(none)
    assert out.count() == 0 and "kept_sha256" in out.columns


def test_suffix_order_and_smaller_neighbours():
    rng = np.random.default_rng(8)
    buf = rng.integers(97, 99, 600).astype(np.uint8)
    starts = np.arange(0, 600 - 64)
    rank = suffix_dedup.suffix_ranks(buf, starts, 64)
    text = buf.tobytes()
    want = {s: i for i, s in enumerate(sorted({text[i:i + 64] for i in starts}))}
    assert np.unique(rank, return_inverse=True)[1].tolist() == [want[text[i:i + 64]] for i in starts]
    place, joined = rng.permutation(200), rng.random(200) < 0.8
    joined[0] = False
    before, after = suffix_dedup.smaller_neighbours(place, joined)
    for i in range(200):
        j = i
        while joined[j]:
            j -= 1
            if place[j] < place[i]:
                break
        assert before[i] == (j if place[j] < place[i] else -1)
        j = i
        while j + 1 < 200 and joined[j + 1]:
            j += 1
            if place[j] < place[i]:
                break
        assert after[i] == (j if place[j] < place[i] else -1)
