"""Quality by compression: zstandard dictionaries of good and of bad labelled text.

Two dictionaries are built, one from texts labelled good and one from texts labelled bad. Each ``WINDOW`` bytes of a text
are compressed by themselves with either dictionary, so that it's the dictionaries that shorten them and not what the
text said before (junk that repeats itself would compress to next to nothing with both). The difference of the summed
sizes over the text's own size, ``(bad - good) / (bytes + SHORT)``, says which the text is like (``SHORT`` keeps a
difference of a byte or two in a text of a few words from counting much). Logistic regression of this one figure, on
labelled rows of its own and weighted to the labels' frequencies, makes it a probability.

The fit takes at most ``sample`` labelled texts of each class and only texts of at most ``longest`` bytes, chosen
by a hash of their ids; both are parameters. Scoring covers every text, whole.

Results in edge cases: a null or empty text has the difference 0 and gets a score like any other; null ids are held
out by the rule's null (false) and scored; repeated rows are scored one by one; with one class or no labels the
score is the labels' mean, or 0.5. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_blocks, prepare

SAMPLE = 1500
LONGEST = 32_768
DICTIONARY_BYTES = 112_640
LEVEL = 3
SHORT = 100
WINDOW = 512


def held_out(mod: int, rest: int) -> Column:
    """crc32(doc_id as text) mod ``mod`` = ``rest``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == rest, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int, longest: int, seed: str) -> DataFrame:
    """At most ``sample`` (doc_id, text, y) rows of each class, chosen by a hash of doc_id."""
    ids = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).alias("_y")).distinct()
    order = [F.md5(F.concat(F.lit(seed), F.col("doc_id").cast("string"))), F.col("doc_id")]
    parts = [ids.where(F.col("_y") == y).orderBy(*order).limit(sample) for y in (0, 1)]
    few = F.broadcast(parts[0].union(parts[1]))  # at most 2 * sample rows
    return (docs.select("doc_id", "text").join(few, "doc_id").where(F.octet_length("text") <= longest)
            .select("doc_id", "text", F.col("_y").alias("y")))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int, longest: int, seed: str) -> list:
    """The rows of ``labelled_rows``, in order; a bounded collect."""
    return sorted(labelled_rows(docs, labels, label, sample, longest, seed).collect(), key=lambda r: (r["doc_id"], r["text"]))


class CompressionModel:
    """Two dictionaries and a calibration (the figure's weight, and a shift). Plain values, so it travels."""

    def __init__(self, good: bytes, bad: bytes, weight: float = 0.0, shift: float = 0.0, level: int = LEVEL):
        self.good, self.bad, self.weight, self.shift, self.level = good, bad, weight, shift, level
        self._made = None

    def __getstate__(self):
        return {**self.__dict__, "_made": None}

    def _compressors(self):
        import zstandard as z
        if self._made is None:
            self._made = [z.ZstdCompressor(dict_data=z.ZstdCompressionDict(d), level=self.level, write_content_size=False,
                                           write_checksum=False, write_dict_id=False) if d else None
                          for d in (self.good, self.bad)]
        return self._made

    def difference(self, text) -> float:
        """How much shorter the good dictionary makes the text, as a share of its size."""
        good, bad = self._compressors()
        if good is None or bad is None:
            return 0.0
        windows = [text[i:i + WINDOW] for i in range(0, len(text), WINDOW)]
        return sum(len(bad.compress(w)) - len(good.compress(w)) for w in windows) / (len(text) + SHORT)

    def score(self, difference: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(difference * self.weight + self.shift, -40, 40)))


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary; texts too few or too alike to train on are taken as they are."""
    import zstandard as z
    try:
        return z.train_dictionary(size, texts).as_bytes()
    except z.ZstdError:
        return b"".join(texts)[-size:]


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[tuple[float, ...], float]:
    """Weighted logistic regression on standardised columns, by Newton steps with a small ridge: (weights, shift)."""
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 0, scale, 1.0)
    a = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], 1)
    ridge = np.diag([1e-2] * x.shape[1] + [1e-6])
    beta = np.zeros(a.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        step = np.linalg.solve((a * (w * p * (1 - p))[:, None]).T @ a + ridge + 1e-9 * np.eye(len(beta)), a.T @ (w * (y - p)) - ridge @ beta)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    slope = beta[:-1] / scale
    return tuple(float(v) for v in slope), float(beta[-1] - slope @ mean)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, longest: int = LONGEST,
        size: int = DICTIONARY_BYTES, level: int = LEVEL) -> CompressionModel:
    """Dictionaries from two thirds of the sampled rows, calibration from the rest. ``labels``: training rows only."""
    rows = labelled_sample(docs, labels, label, sample, longest, "compression")
    share = {r["_y"]: r["n"] for r in labels.where(F.col(label).isin(0, 1)).groupBy(F.col(label).alias("_y")).agg(F.count("*").alias("n")).collect()}
    texts = {y: [r["text"].encode() for r in rows if r["y"] == y and r["text"]] for y in (0, 1)}
    if not texts[0] or not texts[1]:
        total = sum(share.values())
        mean = min(0.99, max(0.01, share.get(1, 0) / total)) if total else 0.5
        return CompressionModel(b"", b"", shift=float(np.log(mean / (1 - mean))), level=level)
    parts = {y: ([t for i, t in enumerate(v) if i % 3 < 2 or len(v) < 3], [t for i, t in enumerate(v) if i % 3 == 2 or len(v) < 3])
             for y, v in texts.items()}
    model = CompressionModel(_dictionary(parts[1][0], size), _dictionary(parts[0][0], size), level=level)
    x = np.array([model.difference(t) for y in (0, 1) for t in parts[y][1]])
    y = np.array([float(k) for k in (0, 1) for _ in parts[k][1]])
    w = np.where(y == 1, share[1] / max(1, y.sum()), share[0] / max(1, (1 - y).sum()))
    (model.weight,), model.shift = _logistic(x[:, None], y, w / w.sum() * len(y))
    return model


def _scorer(model: CompressionModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, lo, hi, buf, offs in batch_blocks(batches):
            view = memoryview(np.ascontiguousarray(buf))
            figures = np.array([model.difference(view[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())])
            part = batch.slice(lo, hi - lo)
            rest = [c for c in range(part.num_columns) if part.schema.names[c] != "text"]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in rest], pa.array(model.score(figures))],
                                             names=[*[part.schema.names[c] for c in rest], "score"])
    return run


def score_quality(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """doc_id and ``score`` of every document."""
    prepare(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return d.mapInArrow(_scorer(model), "doc_id long, score double")


def op10_zstd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored; labels with crc32(doc_id) mod 3 = 1 are never learnt from."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = held_out(3, 1)
    scored = score_quality(docs, fit(docs, labels.where(~out)))
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
