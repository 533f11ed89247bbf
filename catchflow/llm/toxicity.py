"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is the sum of learnt vectors: one for the word (lower case, hashed into ``WORD_BINS``) and those of
its runs of three and of four bytes (hashed into ``CHAR_BINS``, word ends marked), over the root of their number.
One gated recurrent layer reads a window of ``WINDOW`` words forwards, one backwards; attention weights over the
joined states pool them, and a line makes the window's logit. Windows overlap by a third, every word is in one, and a document's logit is its largest
window's; a last line, fitted on the training documents, turns that into the score.

Training takes at most ``sample`` labelled documents of each class, of at most ``longest`` bytes, chosen by a hash
of their ids (all parameters). Documents are bags of windows: all windows of a toxic document count as toxic in the
first pass, only its highest in the later ones; windows of the others are never toxic. Seeds are fixed, so a model
depends on its rows alone. Scoring covers every window of every text.

Results in edge cases: a null, empty or all-white text has no window and gets the logit of an empty pool; null ids
are not held out and are scored; repeated rows are scored one by one; without rows of both classes the score is the
labels' mean, or 0. No rows give no rows; very long texts are scored window by window in bounded batches.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, batch_blocks, blocks, mix, prepare, span_hashes, text_bytes, trimmed, words
from .quality_classifier import _logistic, held_out, labelled_rows

WORD_BINS = 8192
CHAR_BINS = 16384
WIDTH = 12
HIDDEN = 8
WINDOW = 48
STRIDE = 32
SAMPLE = 1200
LONGEST = 16_384
PASSES = 6
BATCH = 256


# ---------------------------------------------------------------- inputs

def word_inputs(buf: np.ndarray, offs: np.ndarray):
    """Distinct words of a block: (number of each word's kind, texts' word offsets, word bins, run bins, their kinds)."""
    low = LOWER[buf]
    starts, ends, doc = words(low, offs)
    h = span_hashes(low, starts, ends)
    kinds, first, which = np.unique(h, return_index=True, return_inverse=True)
    size = ends[first] - starts[first]
    at = np.cumsum(size + 2) - (size + 2)  # each distinct word once, between two marks
    wide = np.zeros(int((size + 2).sum()), np.uint64)
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    wide[np.repeat(at + 1, size) + inner] = low[np.repeat(starts[first], size) + inner]
    kind = np.repeat(np.arange(len(first)), size)
    left = np.repeat(at, size) + inner
    three = (wide[left] << np.uint64(16)) | (wide[left + 1] << np.uint64(8)) | wide[left + 2]
    four = left[inner + 1 < np.repeat(size, size)]
    gram = np.concatenate([three, (three[inner + 1 < np.repeat(size, size)] << np.uint64(8)) | wide[four + 3] | np.uint64(1 << 40)])
    kind = np.concatenate([kind, kind[inner + 1 < np.repeat(size, size)]])
    order = np.argsort(kind, kind="stable")
    gram, kind = gram[order], kind[order]
    return (which.astype(np.int32), np.searchsorted(doc, np.arange(len(offs))), (kinds % np.uint64(WORD_BINS)).astype(np.int32),
            (mix(gram) % np.uint64(CHAR_BINS)).astype(np.int32), kind.astype(np.int32))


def windows_of(word_offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, length, text) of all overlapping windows; each text's last window ends with its last word."""
    n = np.diff(word_offs)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    first = nth * STRIDE
    length = np.minimum(WINDOW, n[text] - first)
    return word_offs[text] + first, length, text


# ---------------------------------------------------------------- the network

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _gru(x: np.ndarray, u: np.ndarray, live: np.ndarray, back: bool, keep: list | None = None) -> np.ndarray:
    """States (time, batch, hidden) over projected inputs (time, batch, 3 hidden)."""
    steps, batch, hid = x.shape[0], x.shape[1], u.shape[0]
    h, out = np.zeros((batch, hid), x.dtype), np.empty((steps, batch, hid), x.dtype)
    for t in range(steps - 1, -1, -1) if back else range(steps):
        hu = h @ u
        gates = _sigmoid(x[t, :, :2 * hid] + hu[:, :2 * hid])
        z, r = gates[:, :hid], gates[:, hid:]
        n = np.tanh(x[t, :, 2 * hid:] + r * hu[:, 2 * hid:])
        new = n + z * (h - n)
        if keep is not None:
            keep.append((t, h, z, r, n, hu[:, 2 * hid:]))
        h = h + (new - h) * live[t]
        out[t] = h
    return out


def _gru_back(grad: np.ndarray, u: np.ndarray, live: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs and of ``u`` from those of the states."""
    hid = u.shape[0]
    gx, gu, gh = np.zeros((*grad.shape[:2], 3 * hid), grad.dtype), np.zeros_like(u), np.zeros_like(grad[0])
    for t, h, z, r, n, hun in reversed(kept):
        gh = gh + grad[t]
        gn_ = gh * live[t]
        ga = gn_ * (1 - z) * (1 - n * n)
        gz = gn_ * (h - n) * z * (1 - z)
        gr = ga * hun * r * (1 - r)
        gx[t] = np.concatenate([gz, gr, ga], 1)
        gg = np.concatenate([gz, gr, ga * r], 1)
        gu += h.T @ gg
        gh = gh * (1 - live[t]) + gn_ * z + gg @ u.T
    return gx, gu


class Network:
    """All weights as float32 arrays by name; small enough to travel to every task."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale=0.1: rng.normal(0, scale, shape).astype(np.float32)
        h = HIDDEN
        self.w = {"word": draw(WORD_BINS, WIDTH), "char": draw(CHAR_BINS, WIDTH), "out": draw(2 * h, scale=0.3),
                  "look": draw(2 * h, scale=0.3), "bias": np.full(1, -1.0, np.float32)}
        for d in ("f", "b"):
            self.w |= {f"in_{d}": draw(WIDTH, 3 * h, scale=0.3), f"u_{d}": draw(h, 3 * h, scale=0.3), f"c_{d}": np.zeros(3 * h, np.float32)}
        self.slope, self.shift = 1.0, 0.0

    def kinds(self, word: np.ndarray, gram: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Input vectors of distinct words."""
        n = len(word)
        count = np.maximum(np.bincount(kind, minlength=n), 1).astype(np.float32)
        chars = np.stack([np.bincount(kind, weights=self.w["char"][gram, j], minlength=n) for j in range(WIDTH)], 1) if n else np.zeros((0, WIDTH))
        return self.w["word"][word] + (chars / np.sqrt(count)[:, None]).astype(np.float32)

    def forward(self, proj_f: np.ndarray, proj_b: np.ndarray, at: np.ndarray, length: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows. ``proj_*``: projected inputs of distinct words; ``at``: (time, batch) which word."""
        live = (np.arange(at.shape[0])[:, None] < length)[:, :, None].astype(np.float32)
        kf, kb = ([], []) if keep is not None else (None, None)
        states = np.concatenate([_gru(proj_f[at], self.w["u_f"], live, False, kf), _gru(proj_b[at], self.w["u_b"], live, True, kb)], 2)
        look = states @ self.w["look"] + (live[:, :, 0] - 1) * 1e4
        look = np.exp(look - look.max(0))
        look /= look.sum(0)
        pool = (look[:, :, None] * states).sum(0)
        if keep is not None:
            keep |= {"live": live, "kf": kf, "kb": kb, "states": states, "look": look, "pool": pool}
        return pool @ self.w["out"] + self.w["bias"][0]

    def logits(self, which, word, gram, kind, first, length) -> np.ndarray:
        vecs = self.kinds(word, gram, kind)
        pf, pb = vecs @ self.w["in_f"] + self.w["c_f"], vecs @ self.w["in_b"] + self.w["c_b"]
        out = np.empty(len(first), np.float32)
        order = np.argsort(length, kind="stable")  # windows of a length together; most are full
        for lo in range(0, len(first), 2048):
            k = order[lo:lo + 2048]
            steps = int(length[k].max())
            at = which[np.minimum(first[k] + np.arange(steps)[:, None], len(which) - 1)]
            out[k] = self.forward(pf, pb, at, length[k])
        return out

    def score(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.shift, -40, 40)))


def _step(net: Network, state: dict, word, gram, kind, at, length, y, weight, rate: float) -> None:
    """One Adam step on a batch of windows."""
    w = net.w
    vecs, keep = net.kinds(word, gram, kind), {}
    logit = net.forward(vecs @ w["in_f"] + w["c_f"], vecs @ w["in_b"] + w["c_b"], at, length, keep)
    g = ((_sigmoid(logit) - y) * weight / weight.sum()).astype(np.float32)
    states, look, pool = keep["states"], keep["look"], keep["pool"]
    grads = {"out": pool.T @ g, "bias": np.array([g.sum()], np.float32)}
    gpool = g[:, None] * w["out"]
    dot = (states * gpool).sum(2)
    glook = look * (dot - (look * dot).sum(0))
    grads["look"] = np.tensordot(glook, states, ([0, 1], [0, 1]))
    gstates = look[:, :, None] * gpool + glook[:, :, None] * w["look"]
    gvec = np.zeros_like(vecs)
    for d, part, kept in (("f", gstates[:, :, :HIDDEN], keep["kf"]), ("b", gstates[:, :, HIDDEN:], keep["kb"])):
        gx, grads[f"u_{d}"] = _gru_back(np.ascontiguousarray(part), w[f"u_{d}"], keep["live"], kept)
        flat = np.stack([np.bincount(at.ravel(), weights=gx[:, :, j].ravel(), minlength=len(vecs)) for j in range(3 * HIDDEN)], 1).astype(np.float32)
        grads[f"in_{d}"], grads[f"c_{d}"] = vecs.T @ flat, flat.sum(0)
        gvec += flat @ w[f"in_{d}"].T
    grads["word"] = np.zeros_like(w["word"])
    np.add.at(grads["word"], word, gvec)
    share = gvec / np.sqrt(np.maximum(np.bincount(kind, minlength=len(vecs)), 1)).astype(np.float32)[:, None]
    grads["char"] = np.stack([np.bincount(gram, weights=share[kind, j], minlength=CHAR_BINS) for j in range(WIDTH)], 1).astype(np.float32)
    state["t"] = state.get("t", 0) + 1
    for k, gk in grads.items():
        m, v = state.setdefault(k, (np.zeros_like(w[k]), np.zeros_like(w[k])))
        m += 0.1 * (gk - m)
        v += 0.001 * (gk * gk - v)
        w[k] -= rate * (m / (1 - 0.9 ** state["t"])) / (np.sqrt(v / (1 - 0.999 ** state["t"])) + 1e-8)


def train(texts: list[str], y: np.ndarray, prior: float, passes: int = PASSES, rate: float = 0.01) -> Network:
    """Fit on whole training texts; ``prior`` is the share of toxic rows among all labels."""
    net, state = Network(), {}
    buf, offs = text_bytes(pa.array(texts, pa.string()))
    inputs = word_inputs(buf, offs)
    which, word_offs, word, gram, kind = inputs
    first, length, text = windows_of(word_offs)
    gram_at = np.searchsorted(kind, np.arange(len(word) + 1))
    rng = np.random.default_rng(11)
    for p in range(passes):
        toxic = y[text] == 1
        rows = np.flatnonzero(toxic)
        if p:  # only the highest window of a toxic text
            logit = net.logits(which, word, gram, kind, first, length)
            best = rows[np.lexsort((-logit[rows], text[rows]))]
            rows = best[np.append(True, text[best][1:] != text[best][:-1])] if len(best) else best
        clean = np.flatnonzero(~toxic)
        if p:  # of the others, the highest of each and as many drawn again
            top = clean[np.lexsort((-logit[clean], text[clean]))]
            top = top[np.append(True, text[top][1:] != text[top][:-1])] if len(top) else top
            clean = np.concatenate([top, rng.choice(clean, min(len(clean), 2 * len(top) + 1), replace=False)])
        else:
            clean = rng.choice(clean, min(len(clean), max(1, len(rows))), replace=False)
        rows = rng.permutation(np.concatenate([rows, clean]))
        weight = np.where(y[text] == 1, 1.0 / max(1, (y[text[rows]] == 1).sum()), 1.0 / max(1, (y[text[rows]] == 0).sum()))
        for lo in range(0, len(rows), BATCH):
            k = rows[lo:lo + BATCH]
            at = np.minimum(first[k] + np.arange(int(length[k].max()))[:, None], len(which) - 1)
            seen, local = np.unique(which[at], return_inverse=True)  # only the batch's words
            size = gram_at[seen + 1] - gram_at[seen]
            pick = np.repeat(gram_at[seen] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            _step(net, state, word[seen], gram[pick], np.repeat(np.arange(len(seen)), size), local.reshape(at.shape), length[k],
                  y[text[k]].astype(np.float32), weight[k], rate * (1 - p / (passes + 1)))
    logit = document_logits(net, buf, offs)
    w = np.where(y == 1, prior / max(1, (y == 1).sum()), (1 - prior) / max(1, (y == 0).sum()))
    (net.slope,), net.shift = _logistic(logit[:, None], y.astype(float), w / w.sum() * len(y))
    return net


def document_logits(net: Network, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The largest window logit of each text; an empty pool's where there is no window."""
    out = np.full(len(offs) - 1, -np.inf)
    for lo, _, b, o in blocks(buf, offs):
        which, word_offs, word, gram, kind = word_inputs(b, o)
        first, length, text = windows_of(word_offs)
        if len(first):
            np.maximum.at(out, lo + text, net.logits(which, word, gram, kind, first, length))
    return np.where(np.isneginf(out), net.w["bias"][0], out)


# ---------------------------------------------------------------- on Spark

def _untrained(prior: float) -> Network:
    """A network that gives every text the labels' mean."""
    net, mean = Network(), min(1 - 1e-9, max(1e-9, prior))
    net.slope, net.shift = 0.0, float(np.log(mean / (1 - mean)))
    return net


def _trainer(prior: float, passes: int):
    """The whole (bounded) sample in one task -> one row, the network."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["doc_id"], r["text"], r["y"]) for b in batches for r in b.to_pylist() if r["text"].strip())
        y = np.array([r[2] for r in rows])
        net = train([r[1] for r in rows], y, prior, passes) if len(set(y.tolist())) == 2 else _untrained(prior)
        yield pa.RecordBatch.from_pydict({"net": pa.array([pickle.dumps(net)], pa.binary())})
    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, longest: int = LONGEST, passes: int = PASSES) -> Network:
    """Train in one task on a bounded sample of ``labels`` (training rows only); the driver gets the weights."""
    prepare(docs.sparkSession)
    share = {r["_y"]: r["n"] for r in labels.where(F.col(label).isin(0, 1)).groupBy(F.col(label).alias("_y")).agg(F.count("*").alias("n")).collect()}
    prior = share.get(1, 0) / max(1, sum(share.values()))
    rows = labelled_rows(docs, labels, label, sample, longest, "toxicity").repartition(1)
    got = rows.mapInArrow(trimmed(_trainer(prior, passes)), "net binary").collect()  # one row, none without a partition
    return pickle.loads(got[0]["net"]) if got else _untrained(prior)


def _scorer(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, lo, hi, buf, offs in batch_blocks(batches):
            score = net.score(document_logits(net, buf, offs))
            yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, pa.array(score)], names=[*batch.schema.names, "toxic_score"])
    return run


def score_toxicity(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` (text, ...) with ``toxic_score``."""
    prepare(docs.sparkSession)
    if "toxic_score" in docs.columns:
        raise ValueError("toxic_score is the result's name")
    return docs.mapInArrow(trimmed(_scorer(net)), T.StructType([*docs.schema.fields, T.StructField("toxic_score", T.DoubleType())]))


def _drop_text(batches: Iterator[pa.RecordBatch], net: Network) -> Iterator[pa.RecordBatch]:
    for b in _scorer(net)(batches):
        yield b.select(["doc_id", "toxic_score"])


def op6_bigru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored; labels with crc32(doc_id) mod 5 = 0 are never learnt from."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = held_out(5, 0)
    net = fit(docs, labels.where(~out))
    prepare(spark)
    scored = docs.select("doc_id", "text").mapInArrow(lambda it: _drop_text(it, net), "doc_id long, toxic_score double")
    return scored.select("doc_id", out.alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"))
