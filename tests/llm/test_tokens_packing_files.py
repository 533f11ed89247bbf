import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import SF, tricky_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from catchflow.llm import packing, token_files
from catchflow.llm.common import shared_path, text_bytes
from catchflow.llm.tokens import TextEncoder, tokenizer_file

FILES = [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "bytes")]


@pytest.fixture(scope="module", params=FILES, ids=[k for _, k in FILES])
def encoder(request):
    return TextEncoder(tokenizer_file(request.param[0]), request.param[1])


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from(" \n\t\r\x0b\x1c  aBzÉéß.,'s-1２́　\u0085  <|>中😀Σ"), max_size=40), max_size=12))
def test_ids_equal_the_library(texts):
    for name, kind in FILES:
        enc = TextEncoder(tokenizer_file(name), kind)
        buf, offs = text_bytes(pa.array(texts, pa.string()))
        ids, at = enc.encode(buf, offs, 5)
        want = [e.ids + [5] for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


def test_cache_does_not_change_ids(encoder, monkeypatch):
    texts = [f"Word{i} and the, other{i % 7}." for i in range(300)]
    buf, offs = text_bytes(pa.array(texts))
    first = encoder.encode(buf, offs)
    monkeypatch.setattr("catchflow.llm.tokens.CACHE_PIECES", 10)
    encoder.cache.clear()
    for _ in range(3):
        again = encoder.encode(buf, offs)
        assert (first[0] == again[0]).all() and (first[1] == again[1]).all()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 3000), st.sampled_from([1, 2, 9, 300, 50257, 1 << 32, 1 << 61, 1 << 64]), st.integers(0, 99))
def test_words_roundtrip(n, high, seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, high, n, dtype=np.uint64, endpoint=False) if high > 1 else np.zeros(n, np.uint64)
    if n > 200:
        ids[50:190] = 1
    words, first, escapes = token_files.encode_words(ids)
    assert (token_files.decode_words(words, first, escapes, n) == ids).all()
    assert len(first) == -(-n // token_files.BLOCK_IDS) + 1
    if n > token_files.BLOCK_IDS:  # a block is read alone
        got = token_files.decode_words(words[first[1]:first[2]], first[1:3] - first[1], escapes, min(n, 2 * token_files.BLOCK_IDS) - token_files.BLOCK_IDS)
        assert (got == ids[token_files.BLOCK_IDS:2 * token_files.BLOCK_IDS]).all()


def library_ids(name, text, end):
    enc = TextEncoder(tokenizer_file(name), "words")
    return np.array(enc.tok.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_files_hold_every_document(spark, tricky_clash):
    folder = shared_path(spark, "token-files-test")
    manifest = token_files.write_token_files(tricky_clash, folder)
    rows = token_files.read_token_files(spark, folder, manifest, with_ids=True).orderBy("start").collect()
    want = sorted(tricky_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in rows] == [r[0] for r in want]
    texts = defaultdict(list)
    for r in want:
        texts[r[0]].append(library_ids("byte_bpe_50k.json", r[1], 2).tolist())
    at = 0
    for r in rows:
        texts[r["doc_id"]].remove(list(r["ids"]))  # raises where it isn't there
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes()))
        at += r["n_tokens"]


def test_files_of_an_empty_table(spark, none):
    folder = shared_path(spark, "token-files-none")
    manifest = token_files.write_token_files(none, folder)
    assert token_files.read_token_files(spark, folder, manifest).count() == 0


def check_pieces(rows, docs, window, end=1):
    """Whole coverage: each id of each row in exactly one piece, sequences without gaps."""
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] > 0
    short = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        short += at < window
    assert short <= 1 and sorted(sequences) == list(range(len(sequences)))
    want = defaultdict(list)
    for i, t in docs:
        want[i].append(library_ids("word_bpe_49k.json", t, end).tolist())
    assert set(want) == set(by_doc)
    for i, pieces in by_doc.items():
        left = {len(x): [] for x in want[i]}
        for x in want[i]:
            left[len(x)].append(x)
        for size, texts in left.items():  # rows of an id with equal length share their starts
            mine = [p for p in pieces if p["doc_tokens"] == size]
            assert sum(p["length"] for p in mine) == size * len(texts)
            for p in mine:
                assert any(x[p["start"]:p["start"] + p["length"]] == p["ids"] for x in texts)


@pytest.mark.parametrize("window", [16, 64, 2048])
def test_packing_places_every_id_once(spark, tricky_clash, window):
    rows = packing.pack_documents(tricky_clash, window=window, with_ids=True).collect()
    check_pieces(rows, [(r[0], r[1]) for r in tricky_rows()], window)


def test_packing_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack_documents(docs, with_ids=True).collect()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 2048)
    assert packing.op1_nnls_packing(spark, SF).columns == packing.PIECE_SCHEMA.names


def test_packing_of_an_empty_table(spark, none):
    assert packing.pack_documents(none).count() == 0


def test_plan_fills_windows_and_keeps_the_histogram():
    rng = np.random.default_rng(3)
    for hist in (np.bincount(np.clip(rng.lognormal(4, 1, 20000).astype(int), 1, 255), minlength=256), np.bincount([100] * 5000, minlength=256), np.zeros(256, int)):
        hist = hist.copy()
        hist[0] = 0
        plan = packing.PackPlan(hist, 256)
        length = np.repeat(np.arange(256), hist)
        rank = np.concatenate([np.arange(n) for n in hist]) if len(length) else np.zeros(0, int)
        seq, at = plan.place(length, rank)
        fill = np.bincount(seq, weights=np.minimum(length, 256 - at), minlength=plan.sequences + 1)
        over = np.maximum(at + length - 256, 0)
        fill += np.bincount(seq + 1, weights=over, minlength=plan.sequences + 1)[:len(fill)]
        assert fill.sum() == length.sum() and (fill[:max(0, plan.sequences - 1)] == 256).all()
    lengths, mult = packing.combinations(256)
    assert ((lengths * mult).sum(1) == 256).all()
    full = packing.PackPlan(np.bincount(rng.integers(1, 256, 50000), minlength=256), 256)
    assert full.by_plan > 0.9 * 50000  # the least squares plan, not the leftovers, does the work
