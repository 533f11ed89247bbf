"""Quality rules: plain text statistics, then a log-likelihood ratio between two hashed n-gram models.

Words are ``[^\\x20\\x09-\\x0D]+``. Base rules: fewer than ``MIN_WORDS`` words, or more than half of the words in
repeated three-word windows, fail a document. The method: word unigrams and bigrams are hashed into ``BUCKETS``
bins; the trusted documents make one multinomial, the raw corpus (all documents) the other. A document's figure is
the mean over its n-grams of ``log p_trusted - log p_raw``; every document below ``threshold`` goes.

Counts cover all documents; each task sends at most ``BUCKETS`` partial counts, and the table that goes back to
the tasks has exactly ``BUCKETS`` entries.

Results in edge cases: a null, empty or all-white text has no words, all counts 0, and fails the base rules; a
null id can't be trusted but is judged; repeated rows are judged one by one, and count once each as raw text; a
repeated label counts once; without trusted documents the ratio is 0 everywhere. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, batch_blocks, mix, prepare, run_hashes, span_hashes, words

BUCKETS = 1 << 15
SMOOTHING = 1.0
THRESHOLD = -0.09
MIN_WORDS = 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


def _ngrams(buf: np.ndarray, offs: np.ndarray):
    """(buckets of all word unigrams and bigrams, their texts, word hashes, words' texts, starts, ends)."""
    starts, ends, doc = words(buf, offs)
    h = span_hashes(buf, starts, ends)
    two = run_hashes(h, 2)
    same = doc[1:] == doc[:-1]
    return np.concatenate([h, two[same]]) % np.uint64(BUCKETS), np.concatenate([doc, doc[1:][same]]), h, doc, starts, ends


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, trusted = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for batch, lo, hi, buf, offs in batch_blocks(batches):
        ok = batch.column("trusted").slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(float)
        bins, doc, *_ = _ngrams(buf, offs)
        bins = bins.astype(np.int64)
        raw += np.bincount(bins, minlength=BUCKETS)
        trusted += np.bincount(bins, weights=ok[doc], minlength=BUCKETS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_pydict({"bucket": some, "raw": raw[some].astype(np.int64), "trusted": trusted[some].astype(np.int64)})


def fit_ratio(docs: DataFrame, trusted: DataFrame, smoothing: float = SMOOTHING) -> np.ndarray:
    """``log p_trusted - log p_raw`` of each bucket. ``trusted``: the doc_ids of trusted documents."""
    prepare(docs.sparkSession)
    # the labels grow with the documents, so the join is a shuffle at every size
    ids = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct().withColumn("trusted", F.lit(True))
    flagged = docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    parts = flagged.mapInArrow(_counter, "bucket long, raw long, trusted long")
    sums = parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).collect()  # BUCKETS rows
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in sums:
        raw[r["bucket"]], good[r["bucket"]] = r["raw"], r["trusted"]
    if not good.sum():
        return np.zeros(BUCKETS)
    both = np.log((good + smoothing) / (good.sum() + smoothing * BUCKETS))
    return both - np.log((raw + smoothing) / (raw.sum() + smoothing * BUCKETS))


def _repeats(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Per text: words in three-word windows that the text has twice or more."""
    out = np.zeros(n, np.int64)
    if len(h) < 3:
        return out
    three = run_hashes(h, 3)
    same = doc[2:] == doc[:-2]
    at = np.flatnonzero(same)
    key = mix(three[at] + doc[at].astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    again = at[count[inverse] > 1]
    covered = np.zeros(len(h), bool)
    for j in range(3):
        covered[again + j] = True
    return np.bincount(doc[covered], minlength=n)


def _dup_lines(buf: np.ndarray, offs: np.ndarray, dark: np.ndarray) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of the text."""
    n, size = len(offs) - 1, len(buf)
    out = np.zeros(n, np.int64)
    if not size:
        return out
    feed = np.flatnonzero(buf == 0x0A)
    starts = np.concatenate([offs[:-1], feed + 1])
    doc = np.concatenate([np.arange(n), np.searchsorted(offs, feed, "right") - 1])
    order = np.lexsort((starts, doc))
    starts, doc = starts[order], doc[order]
    ends = np.append(starts[1:] - 1, offs[-1])
    last = np.append(doc[1:] != doc[:-1], True)
    ends[last] = offs[1:][doc[last]]
    seen = np.append(0, np.cumsum(dark))
    real = (ends > starts) & (seen[np.maximum(ends, starts)] > seen[starts])
    starts, ends, doc = starts[real], ends[real], doc[real]
    key = mix(span_hashes(buf, starts, ends) + doc.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    _, first = np.unique(key, return_index=True)
    return np.bincount(doc, minlength=n) - np.bincount(doc[first], minlength=n)


def _judge(table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, lo, hi, buf, offs in batch_blocks(batches):
            n = hi - lo
            bins, gram_doc, h, doc, starts, ends = _ngrams(buf, offs)
            dark = ~WHITE[buf]
            heads = np.append(0, np.cumsum(dark & ((buf & 0xC0) != 0x80)))  # code points begin here
            marks = np.append(0, np.cumsum(SYMBOLS[buf]))
            grams = np.bincount(gram_doc, minlength=n)
            ratio = np.bincount(gram_doc, weights=table[bins.astype(np.int64)], minlength=n) / np.maximum(grams, 1)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(lo, n), pa.array(np.bincount(doc, minlength=n)),
                pa.array(heads[offs[1:]] - heads[offs[:-1]]), pa.array(marks[offs[1:]] - marks[offs[:-1]]),
                pa.array(_dup_lines(buf, offs, dark)), pa.array(_repeats(h, doc, n)), pa.array(ratio)],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio"])
    return run


def judge_documents(docs: DataFrame, table: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """Every document's base statistics, ``ratio``, base_failed and kept."""
    prepare(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = d.mapInArrow(_judge(table), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                      "n_repeat_words long, ratio double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("ratio") >= threshold))


def op5_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged; documents labelled good are the trusted target."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return judge_documents(docs, fit_ratio(docs, labels.where("quality = 1"))).drop("ratio")
