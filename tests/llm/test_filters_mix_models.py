import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from brute import WORD, base_rules, reshared
from llm_rows import SF, tricky_rows

from catchflow.llm import mixing, quality_classifier, quality_rules, queries, toxicity, url_filters

SF_BIG = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- urls

URLS = ["http://a.com/x", "https://EXAMPLE.com/en/1", "https://www.example.com/en/1?q#f", "https://m.www.example.com/en/", "http://a.net/es/x", "http://a.net/de/x",
        "http://a.net", "http://notexample.com/en/1", "ftp://x.org/en/", "no scheme", "", None, "http://b.org?x=/en/", "a://b://c/d", "http://com/", "http://xcom/", "://h.net/fr/"]
WANT = ["com/", "example.com/en/", "www.example.com/en/", "www.example.com/en/", "net/es/", None, None, "com/", None, None, None, None, None, None, "com/", None, "net/fr/"]


def test_rules_hosts_and_paths(spark):
    rows = [(i, u, None if i % 2 else "<a href='/x'>", 3) for i, u in enumerate(URLS)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = {r["page_id"]: r for r in url_filters.filter_pages(df).collect()}
    assert [got[i]["rule"] for i in range(len(URLS))] == WANT
    for i, u in enumerate(URLS):
        tail = (u or "").partition("://")[2]
        host = tail[:min([tail.find(c) for c in "/?#" if c in tail], default=len(tail))]
        path = tail[len(host):]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
        assert (got[i]["host"], got[i]["path"]) == (host.lower(), path)
        if WANT[i]:
            assert got[i]["verdict"] == ("allow" if WANT[i] in ("com/", "www.example.com/en/") else "block")
    assert got[9]["verdict"] == got[11]["verdict"] == "allow"  # no host: nothing against it
    assert url_filters.filter_pages(df.limit(0)).count() == 0


def test_trust_and_distrust_follow_links(spark):
    rules = [("allow", "good.org", "/"), ("block", "bad.org", "/")]
    link = lambda *hosts: "".join(f'<a href="http://{h}/p">' for h in hosts)
    rows = [(1, "http://good.org/", link("friend.edu")), (2, "http://friend.edu/", link("pal.edu")), (3, "http://pal.edu/", None), (4, "http://spam.info/", link("bad.org", "farm.info")),
            (5, "http://farm.info/", link("bad.org")), (6, "http://bad.org/", link("victim.gov")), (7, "http://victim.gov/", None), (8, "http://alone.biz/", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_filters.filter_pages(df, rules=rules).collect()}
    assert got == {1: "allow", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "block", 7: "allow", 8: "allow"}


def test_spread_equals_dense_power_iteration(spark):
    rng = np.random.default_rng(0)
    n = 7
    w = rng.integers(0, 4, (n, n)) * (1 - np.eye(n, dtype=int))
    edges = [("k", f"h{i}", f"h{j}", float(w[i, j])) for i in range(n) for j in range(n) if w[i, j]]
    seeds = [("k", "h0", 3.0), ("k", "h4", 1.0)]
    s = np.zeros(n)
    s[0], s[4] = 0.75, 0.25
    p = np.divide(w, w.sum(1, keepdims=True), out=np.zeros((n, n)), where=w.sum(1, keepdims=True) > 0)
    r = s
    for _ in range(300):
        r = 0.15 * s + 0.85 * r @ p
    got = url_filters.spread(spark.createDataFrame(edges, "kind string, src string, dst string, weight double"),
                             spark.createDataFrame(seeds, "kind string, host string, mass double"), change=1e-9)
    got = {x["host"]: x["score"] for x in got.collect()}
    assert all(got.get(f"h{i}", 0.0) == pytest.approx(r[i] / r.sum(), abs=1e-8) for i in range(n))


# ---------------------------------------------------------------- quality rules

def test_base_rules_equal_brute_force(spark, tricky_clash):
    rows = quality_rules.judge_documents(tricky_clash, np.zeros(quality_rules.BUCKETS)).collect()
    stats = lambda r: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    want = [(r[0], base_rules(r[1])) for r in tricky_rows()]
    assert Counter((r["doc_id"], stats(r)) for r in rows) == Counter(want)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])


def test_ratio_equals_plain_counts(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    table = quality_rules.fit_ratio(docs, labels.where("quality = 1").unionAll(labels.where("quality = 1")))
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    rows = docs.collect()

    def grams(text):
        buf = np.frombuffer(text.encode(), np.uint8)
        return quality_rules._ngrams(buf, np.array([0, len(buf)]))[0].astype(int).tolist() if len(buf) else []
    raw, trusted = Counter(), Counter()
    for r in rows:
        raw.update(grams(r["text"]))
        if r["doc_id"] in good:
            trusted.update(grams(r["text"]))
    n, t, b = sum(raw.values()), sum(trusted.values()), quality_rules.BUCKETS
    for k in list(raw)[:500] + [0, 1]:
        assert table[k] == pytest.approx(np.log((trusted[k] + 1) / (t + b)) - np.log((raw[k] + 1) / (n + b)), abs=1e-9)
    judged = {r["doc_id"]: r for r in quality_rules.judge_documents(docs, table).collect()}
    for r in rows:
        g = grams(r["text"])
        x = judged[r["doc_id"]]
        assert x["ratio"] == pytest.approx(np.mean(table[g]) if g else 0, abs=1e-9)
        assert x["kept"] == (not x["base_failed"] and x["ratio"] >= quality_rules.THRESHOLD)


def test_rules_drop_junk_and_keep_clean(spark):
    rows = quality_rules.judge_documents(*_fit_rules(spark)).join(spark.read.parquet(f"{SF_BIG}/labels.parquet"), "doc_id").collect()
    fine = [r for r in rows if not r["base_failed"]]
    assert np.mean([r["kept"] for r in fine if r["quality"] == 1]) > 0.99
    assert np.mean([r["kept"] for r in fine if r["quality"] == 0]) < 0.05


def _fit_rules(spark):
    docs, labels = (spark.read.parquet(f"{SF_BIG}/{t}.parquet") for t in ("documents", "labels"))
    return docs, quality_rules.fit_ratio(docs, labels.where("quality = 1"))


def test_rules_without_rows_or_trust(spark, none, tricky):
    assert not quality_rules.fit_ratio(tricky, none).any()
    assert not quality_rules.fit_ratio(none, none).any()
    assert quality_rules.judge_documents(none, np.zeros(quality_rules.BUCKETS)).count() == 0


# ---------------------------------------------------------------- mixing

def test_targets_equal_resharing(spark):
    rng = np.random.default_rng(6)
    for trial in range(4):
        sizes = {f"s{i}": int(rng.lognormal(5, 2)) for i in range([1, 2, 7, 30][trial])} | {"z": 0}
        if trial > 1:
            sizes[None] = 50
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        want = reshared(sizes)
        assert got == pytest.approx(want) if None not in got else all(got[k] == pytest.approx(want[k]) for k in want)


def test_mix_meets_targets(spark):
    docs = spark.read.parquet(f"{SF_BIG}/documents.parquet").select("doc_id", "source")
    rows = mixing.op8_systematic_mix(spark, SF_BIG).join(docs, "doc_id").collect()
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
    assert target == pytest.approx(reshared(size))
    longest = defaultdict(int)
    for r in rows:
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in target)
    assert sum(taken.values()) == pytest.approx(sum(target.values()), rel=0.05)


def test_mix_tries_all_offsets(spark):
    """Each source's offset is that of all, tried on all documents, whose taken words come nearest to the target."""
    import hashlib
    from math import floor
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(["w"] * int(rng.lognormal(2, 1.5))), ["a", "b", "c", None][i % 4]) for i in range(160)]
    out = {r["doc_id"]: r for r in mixing.mix_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    for source in ("a", "b", "c", None):
        mine = []
        for i, text, s in rows:
            if s == source:
                n, h = len(WORD.findall(text)), hashlib.md5(f"{i}|{text}".encode()).hexdigest()
                mine.append((len(f"{n:b}"), f"{n:b}"[:5], h[:2], n, i, h))
        mine.sort()
        target, rate = out[mine[0][4]]["target"], out[mine[0][4]]["target"] / sum(m[3] for m in mine)
        tried = [[floor(x + (k + 1) * rate) - floor(x + k * rate) for k in range(len(mine))] for x in mixing.OFFSETS]
        off = [abs(sum(c * m[3] for c, m in zip(t, mine)) - target) for t in tried]
        assert len(mixing.OFFSETS) == 24 and len(set(off)) > 1
        assert [out[m[4]]["copies"] for m in mine] == tried[off.index(min(off))]


def test_mix_of_tricky_rows(spark, tricky_clash, none):
    out = mixing.mix_documents(tricky_clash).collect()
    assert len(out) == len(tricky_rows())
    sizes = Counter()
    for r in tricky_rows():
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["size"] == len(WORD.findall(r["text"] or "")) and 0 <= r["copies"] <= 3
        if r["target"] == 3 * r["source_size"] and r["source_size"]:
            assert r["copies"] == 3
    again = mixing.mix_documents(tricky_clash.repartition(5)).collect()
    assert Counter((r["doc_id"], r["text"], r["copies"]) for r in out) == Counter((r["doc_id"], r["text"], r["copies"]) for r in again)
    assert mixing.mix_documents(none).count() == 0


def test_sql_answers(spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_BIG}/{t}.parquet')")
    for name, sql in queries.ORACLES.items():
        df = queries.QUERIES[name](spark, SF_BIG)
        cur = con.execute(sql)
        cols = [d[0] for d in cur.description]
        assert sorted(cols) == sorted(df.columns)
        assert sorted(map(tuple, df.select(*cols).collect())) == sorted(cur.fetchall())


# ---------------------------------------------------------------- learnt scores

def _auc(score, y):
    order = np.argsort(np.argsort(score))
    n1, n0 = y.sum(), (1 - y).sum()
    return (order[y == 1].sum() - n1 * (n1 - 1) / 2) / n1 / n0


@pytest.mark.parametrize("name, label, mod, rest, auc", [("op10_zstd_quality", "quality", 3, 1, 0.97), ("op6_bigru_toxicity", "toxic", 5, 0, 0.93)])
def test_held_out_documents(spark, name, label, mod, rest, auc):
    sf = "/root/testdata/sf0.1"
    rows = queries.QUERIES[name](spark, sf).collect()
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % mod == rest)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    out = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    score, y = np.array([x for x, _ in out]), np.array([x for _, x in out])
    assert _auc(score, y) > auc


def test_compression_scores_of_tricky_rows(spark, tricky_clash, none):
    labels = spark.createDataFrame([(1, 1), (3, 0), (9, 1), (10, 0), (11, 1), (12, 0), (1, None), (None, 0)], "doc_id long, quality int")
    model = quality_classifier.fit(tricky_clash, labels)
    rows = quality_classifier.score_quality(tricky_clash, model).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in tricky_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    only = quality_classifier.fit(tricky_clash, labels.where("quality = 1"))
    assert {round(r["score"], 9) for r in quality_classifier.score_quality(tricky_clash, only).collect()} == {0.99}
    assert quality_classifier.score_quality(none, quality_classifier.fit(none, labels.limit(0))).count() == 0


def test_toxicity_of_tricky_rows(spark, tricky_clash, none):
    labels = spark.createDataFrame([(1, 1), (3, 0), (9, 1), (10, 0), (11, 1), (12, 0), (4, 1), (5, 0)], "doc_id long, toxic int")
    net = toxicity.fit(tricky_clash, labels, passes=2)
    out = toxicity.score_toxicity(tricky_clash, net)
    rows = out.collect()
    assert out.columns == [*tricky_clash.columns, "toxic_score"] and all(0 <= r["toxic_score"] <= 1 for r in rows)
    empty = {r["toxic_score"] for r in rows if not (r["text"] or "").strip(" \t\n\x0b\x0c\r")}
    assert len(empty) == 1  # one score for all texts without a word
    assert toxicity.score_toxicity(none, toxicity.fit(none, labels.limit(0))).count() == 0
    same = toxicity.fit(tricky_clash, labels, passes=2)
    assert all((same.w[k] == net.w[k]).all() for k in net.w)  # the same rows give the same model


def test_windows_cover_every_word():
    for n in [0, 1, 47, 48, 49, 79, 80, 81, 500]:
        first, length, text = toxicity.windows_of(np.array([0, n, n + 5]))
        seen = np.zeros(n + 5, int)
        for f, m in zip(first, length):
            seen[f:f + m] += 1
        assert (seen > 0).all() and (length <= toxicity.WINDOW).all() and (length > 0).all()


def test_gradients_equal_differences(monkeypatch):
    """Back-propagation through both directions, attention and both kinds of input, against finite differences."""
    monkeypatch.setattr(toxicity, "WORD_BINS", 11)
    monkeypatch.setattr(toxicity, "CHAR_BINS", 13)
    rng = np.random.default_rng(3)
    net = toxicity.Network()
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    word, kind = rng.integers(0, 11, 6), np.sort(rng.integers(0, 6, 15))
    gram, at = rng.integers(0, 13, 15), rng.integers(0, 6, (5, 4))
    length, y, weight = np.array([5, 3, 1, 4]), np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 0.5, 1])

    def loss():
        vecs = net.kinds(word, gram, kind)
        z = net.forward(vecs @ net.w["in_f"] + net.w["c_f"], vecs @ net.w["in_b"] + net.w["c_b"], at, length)
        p = 1 / (1 + np.exp(-z))
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()
    before = {k: v.copy() for k, v in net.w.items()}
    state = {}
    toxicity._step(net, state, word, gram, kind, at, length, y, weight, 0.0)
    for k in before:
        grad = state[k][0] * 10  # the first Adam moment is a tenth of the gradient
        for i in rng.integers(0, before[k].size, 4):
            idx = np.unravel_index(i, before[k].shape)
            net.w[k] = before[k].copy()
            net.w[k][idx] += 1e-3
            up = loss()
            net.w[k][idx] -= 2e-3
            down = loss()
            net.w[k] = before[k].copy()
            assert grad[idx] == pytest.approx((up - down) / 2e-3, abs=2e-4), k
