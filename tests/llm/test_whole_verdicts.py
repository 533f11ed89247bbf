"""Operators 4 and 10 on whole tables against plain versions of the whole method."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from llm_rows import SF
from pyspark.sql import functions as F

from catchflow.llm import quality_classifier as qc
from catchflow.llm import url_filters

LINK = re.compile(r"""(?:href|src)\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)""", re.I)


def lower(s):
    return s.translate({i: i + 32 for i in range(65, 91)})


def parents(host):
    parts = host.split(".")
    return [".".join(parts[i:]) for i in range(len(parts))]


def plain_verdicts(pages, rules, damping=0.85):
    """[(page_id, host, path, rule, verdict)]: rules, then dense power iterations of trust and distrust until they stand still."""
    out, seeds, links, hosts = [], {"allow": Counter(), "block": Counter()}, Counter(), set()
    for page_id, url, html in pages:
        m = re.search("://([^/?#]*)([^?#]*)", url or "", re.S)
        host, path = (lower(m[1]), m[2]) if m else ("", "")
        fits = [(len(h) + len(p), a == "block", h + p, a) for a, h, p in rules if host and h in parents(host) and path.startswith(p)]
        rule, action = max(fits)[2:] if fits else (None, None)
        out.append([page_id, host, path, rule, action])
        if action:
            seeds[action][host] += 1
        if host:
            hosts.add(host)
            for d in {lower(re.match("[^/]*//([^/?#]*)", u)[1]) for u in LINK.findall(html or "")} - {"", host}:
                links[host, d] += 1
                hosts.add(d)
    edges = Counter(links)
    for h in {p for host in hosts for p in parents(host)}:
        up = h.partition(".")[2]
        if up:
            edges[h, up] += 1
            edges[up, h] += 1
    nodes = sorted({x for e in edges for x in e} | set(seeds["allow"]) | set(seeds["block"]))
    at, score = {h: i for i, h in enumerate(nodes)}, {}
    for kind in ("allow", "block"):
        w = np.zeros((len(nodes), len(nodes)))
        for (a, b), n in edges.items():
            a, b = (a, b) if kind == "allow" else (b, a)
            w[at[a], at[b]] += n
        move = np.divide(w, w.sum(1, keepdims=True), out=np.zeros_like(w), where=w.sum(1, keepdims=True) > 0)
        start = np.array([seeds[kind][h] for h in nodes], float)
        start = start / start.sum() if start.sum() else start
        r = start
        for _ in range(400):
            r = (1 - damping) * start + damping * r @ move
        score[kind] = r / r.sum() if r.sum() else r
    for row in out:
        if row[4] is None:
            i = at.get(row[1])
            row[4] = "block" if i is not None and score["block"][i] > score["allow"][i] else "allow"
    return sorted(map(tuple, out), key=str)


def test_verdicts_of_all_pages_equal_a_plain_version(spark):
    pages = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = sorted((tuple(r) for r in url_filters.op4_host_trust(spark, SF).collect()), key=str)
    assert got == plain_verdicts(pages, url_filters.RULES)


def test_verdicts_follow_links_like_the_plain_version(spark):
    rng = np.random.default_rng(8)
    hosts = [f"h{i}.{t}" for i in range(12) for t in ("org", "info")] + ["good.com", "spam.net", "www.example.com", "example.com"]
    pages = []
    for i in range(120):
        links = "".join(f"<a href=\"http://{h}/x\">" for h in rng.choice(hosts, 3))
        pages.append((i, f"http://{hosts[i % len(hosts)]}/{('es', 'en', 'fr', 'x')[i % 4]}/p{i}", links if i % 5 else None))
    pages += [(500, None, "<a href=//h1.org/>"), (501, "no scheme", None), (501, "http://H1.ORG?x", None)]
    pages += [(600, "http://farm.biz/x", '<a href="http://only.net/es/">'), (601, "http://only.net/es/", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("kind", F.lit(1)).withColumn("score", F.lit(2))
    got = sorted((tuple(r) for r in url_filters.filter_pages(df).select("page_id", "host", "path", "rule", "verdict").collect()), key=str)
    want = plain_verdicts(pages, url_filters.RULES)
    assert got == want and {r[4] for r in want if r[3] is None} == {"allow", "block"}


def test_scores_of_all_documents_equal_a_plain_version(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = qc.fit(docs, labels.where(~qc.held_out(3, 1)))
    assert isinstance(model.weight, float) and model.weight > 0
    got = {r["doc_id"]: r for r in qc.op10_zstd_quality(spark, SF).collect()}
    sizes = defaultdict(int)
    for name, d in (("good", model.good), ("bad", model.bad)):
        c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), level=qc.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        for r in docs.collect():
            b = (r["text"] or "").encode()
            sizes[r["doc_id"], name] = sum(len(c.compress(b[i:i + qc.WINDOW])) for i in range(0, len(b), qc.WINDOW))
    for r in docs.collect():
        n = len((r["text"] or "").encode())
        z = model.weight * (sizes[r["doc_id"], "bad"] - sizes[r["doc_id"], "good"]) / (n + qc.SHORT) + model.shift
        assert got[r["doc_id"]]["score"] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)
        assert got[r["doc_id"]]["predicted"] == (got[r["doc_id"]]["score"] >= 0.5)
