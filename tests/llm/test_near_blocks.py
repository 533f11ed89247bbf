from collections import Counter

import numpy as np
import pytest
from brute import near_groups
from pyspark.sql import functions as F

from catchflow.llm import ngram_join


def joined(sets):
    return np.concatenate(sets), np.append(0, np.cumsum([len(s) for s in sets]))


def draw(rng, n):
    return np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))


@pytest.mark.parametrize("percent", [80, 85])
def test_unrelated_sets_share_no_name(percent):
    rng = np.random.default_rng(3)
    key, at = joined([draw(rng, n) for n in list(range(1, 61)) * 20 + [100, 150, 200] * 20])
    name, row = ngram_join.part_names(key, at, np.arange(len(at) - 1), ngram_join.Parts(percent))
    owners = Counter(x for x, _ in set(zip(name.tolist(), row.tolist())))
    assert max(owners.values()) == 1 and set(row.tolist()) == set(range(len(at) - 1))


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_of_all_sizes_share_a_name(percent):
    rng, parts, seen = np.random.default_rng(8), ngram_join.Parts(percent), 0
    ranks = rng.integers(ngram_join.COMMON - 20, ngram_join.COMMON + 20, ngram_join.BINS).astype(np.uint8)
    for n in list(range(4, 90)) + [150, 400]:
        for _ in range(40):
            x, y = (int(v) for v in rng.integers(0, n // 4 + 2, 2))
            if 100 * n < percent * (n + x + y):
                continue
            pool = rng.permutation(draw(rng, n + x + y))
            key, at = joined([np.sort(pool[:n + x]), np.sort(np.concatenate([pool[:n], pool[n + x:]]))])
            for common in (None, ranks):
                name, row = ngram_join.part_names(key, at, np.array([0, 1]), parts, common)
                assert set(name[row == 0].tolist()) & set(name[row == 1].tolist()), (n, x, y)
            seen += 1
    assert seen > 500


def test_shared_passages_do_not_chain_texts_into_large_groups(spark):
    rng = np.random.default_rng(12)
    passages = [" ".join(f"p{i}w{j}" for j in range(60)) for i in range(5)]
    docs = []
    for i in range(1500):  # texts of their own words with two common passages each
        own = [" ".join(f"d{i}x{j}" for j in range(at, at + 100)) for at in (0, 100)]
        a, b = rng.choice(5, 2, replace=False)
        docs.append((i, f"{own[0]} {passages[a]} {own[1]} {passages[b]}"))
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("text_hash", F.xxhash64("text"))
    ngram_join.prepare(spark)
    rows = ngram_join.keep_table(d.mapInArrow(ngram_join._set_rows(5), "doc_id long, text_hash long, n_shingles long, node long, slice int, counts binary"), "test-sets")
    sizes = ngram_join.candidate_groups(d, 5, 80, ngram_join.shingle_ranks(rows)).groupBy("root").count().agg(F.max("count")).first()[0]
    assert (sizes or 0) <= 20


def test_given_table_has_no_large_candidate_group_at_five_words_and_eighty_per_cent(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    ngram_join.prepare(spark)
    rows = ngram_join.keep_table(d.mapInArrow(ngram_join._set_rows(5), "doc_id long, text_hash long, n_shingles long, node long, slice int, counts binary"), "test-sets")
    groups = ngram_join.candidate_groups(d, 5, 80, ngram_join.shingle_ranks(rows)).groupBy("root").count()
    assert groups.agg(F.max("count")).first()[0] <= 100


def test_outsiders_meet_everything_once_in_bounded_blocks(spark):
    rows = [(7, n, 0 if n < 150 else n, "t") for n in range(400)]  # 150 sets are one component, 250 link with nothing
    state = spark.createDataFrame(rows, "root long, node long, comp long, text string")
    blocks, met = {}, Counter()
    for r in ngram_join.outside_pairs(state, 50).collect():
        blocks.setdefault(tuple(r["grp"]), []).append((r["node"], r["side"]))
    for b in blocks.values():
        assert len(b) <= 150  # two blocks of about 50
        met.update((x, y) for x, s in b for y, t in b if x < y and (s != t or s == 0))
    assert met == {(x, y): 1 for y in range(400) for x in range(y) if y >= 150}


def test_large_loose_group_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    docs, at = [], 0
    for i in range(160):  # texts that slide along: some neighbours link, others only share names
        docs.append((i, " ".join(f"w{j}" for j in range(at, at + 60))))
        at += int(rng.integers(2, 10))
    docs += [(1000 + i, f"short {i % 7} text") for i in range(40)]
    for k, percent in ((5, 80), (4, 85)):
        got = ngram_join.link_sets(spark.createDataFrame(docs, "doc_id long, text string"), k=k, percent=percent, group=10)
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == sorted(near_groups(docs, percent, k))
