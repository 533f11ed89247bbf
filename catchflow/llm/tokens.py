"""Whole texts to token ids, exactly as the tokenizers library gives them, at a fraction of its time.

A pre-tokenizer never joins characters across certain places of a text. Texts are cut there, each distinct
piece of a block is encoded once by the library, and the ids are put together again. All vocabularies of this
family split between a letter and an ASCII punctuation mark (the apostrophe is left out: it may open a
contraction). The other cuts depend on the kind of vocabulary:

* ``words`` (lower case, white space dropped, as in ``word_bpe_49k.json``): at every run of ASCII white space.
* ``bytes`` (a space belongs to the next word, as in ``byte_bpe_50k.json``): before a single space, and around
  a single line feed, that stands between two characters that are certainly not white space.

The library looks for the strings of added tokens (``<|endoftext|>``) in the text before anything else. A text
that holds one is not cut: the library encodes it whole, as it is.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa

from .common import LOWER, WHITE

CACHE_PIECES = 250_000  # short pieces whose ids a worker keeps (about 50 MB); results don't depend on it
ENCODE_BYTES = 4 << 20
JOINED = 64  # new pieces of a ``bytes`` vocabulary that go to the library as one string, a line each
# lines of at most one space, first, and characters that are certainly not white space
_LINES = re.compile(rb"(?: ?[^\s\x1c-\x1f\xc2\xe1-\xe3]+\n)+")

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True
_MARK[39] = False
_SPACE_LEAD = np.zeros(256, bool)  # every non-ASCII white space character starts with one of these bytes
_SPACE_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_ODD = WHITE.copy()
_ODD[0x1C:0x20] = True


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _letters(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that begin, and bytes that end, an ASCII or Latin-1 letter (two-byte letters start with C3)."""
    plain = _LETTER[buf]
    begins, ends = plain.copy(), plain
    lead = buf[:-1] == 0xC3
    if lead.any():
        two = lead & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
        begins[:-1] |= two
        ends = plain.copy()
        ends[1:] |= two
    return begins, ends


def _cuts(buf: np.ndarray, offs: np.ndarray, kind: str) -> np.ndarray:
    """Flags, one a byte and one for the end: a piece begins here."""
    n = len(buf)
    cut = np.zeros(n + 1, bool)
    begins, ends = _letters(buf)
    mark = _MARK[buf]
    cut[1:n] = (ends[:-1] & mark[1:]) | (mark[:-1] & begins[1:])
    if kind == "words":
        white = WHITE[buf]
        cut[1:n] |= white[1:] != white[:-1]
    elif n > 2:
        lead = _SPACE_LEAD[buf]
        dark = ~(_ODD[buf] | lead)
        near = lead.copy()
        near[1:] |= lead[:-1]
        near[2:] |= lead[:-2]
        near[3:] |= lead[:-3]
        alone = np.zeros(n, bool)
        alone[1:-1] = (dark & ((buf < 0x80) | ~near))[:-2] & dark[2:]
        edge = np.zeros(n + 1, bool)
        edge[offs] = True
        alone &= ~edge[:-1] & ~edge[1:]  # both neighbours are of the same text
        feed = alone & (buf == 0x0A)
        cut[:-1] |= feed | (alone & (buf == 0x20))
        cut[1:] |= feed
    cut[offs] = True
    return cut


_CACHES: dict[str, dict[bytes, bytes]] = {}


class TextEncoder:
    """Token ids of many texts. ``file`` is a tokenizers JSON file, ``kind`` is ``words`` or ``bytes``.

    ``keep`` is the number of short pieces whose ids the worker keeps, ``CACHE_PIECES`` if not given.
    """

    def __init__(self, file: str, kind: str, keep: int | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        if kind not in ("words", "bytes"):
            raise ValueError(f"unknown kind of vocabulary {kind!r}")
        self.tok, self.kind = Tokenizer.from_file(file), kind
        self.added = sorted({t.content.encode() for t in self.tok.get_added_tokens_decoder().values()} - {b""})
        self.dtype = np.dtype("<u2") if self.tok.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.cache, self.keep = _CACHES.setdefault(file, {}), keep
        feed = self.tok.encode("\n", add_special_tokens=False).ids if kind == "bytes" else []
        self.feed = feed[0] if len(feed) == 1 and not any(b"\n" in x for x in self.added) else None

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as bytes, from the library."""
        coded = self.tok.encode_batch_fast([x.decode("utf-8") for x in pieces], add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in coded]

    def _encode_lines(self, pieces: list[bytes]) -> list[bytes]:
        """As ``_encode``, many pieces in one string: a line feed between two pieces is an id of its own."""
        groups = [pieces[i:i + JOINED] for i in range(0, len(pieces), JOINED)]
        lines = [b"\n".join([*g, b""]) for g in groups]
        whole = [i for i, x in enumerate(lines) if _LINES.fullmatch(x) and x.count(b"\n") == len(groups[i])]
        coded = self.tok.encode_batch_fast([lines[i].decode("utf-8") for i in whole], add_special_tokens=False)
        out: list[list[bytes] | None] = [None] * len(groups)
        for i, e in zip(whole, coded):
            ids = np.array(e.ids, self.dtype)
            ends = (np.flatnonzero(ids == self.feed) * self.dtype.itemsize).tolist()
            if len(ends) == len(groups[i]):
                raw, step = ids.tobytes(), self.dtype.itemsize
                out[i] = [raw[a:z] for a, z in zip([0, *[x + step for x in ends]], ends)]
        return [x for g, ids in zip(groups, out) for x in (self._encode(g) if ids is None else ids)]

    def _pieces(self, pieces: list[bytes], plain: bool) -> list[bytes]:
        """The ids of each piece as bytes; recent pieces come from the cache. ``plain``: none holds an added token."""
        cache, keep = self.cache, CACHE_PIECES if self.keep is None else self.keep
        out = list(map(cache.get, pieces))
        missing = [i for i, x in enumerate(out) if x is None]
        if 2 * len(missing) > len(pieces) and len(cache) >= keep:
            cache.clear()  # the texts have changed
        new = [pieces[i] for i in missing]
        room = keep - len(cache)
        for i, x, ids in zip(missing, new, self._encode_lines(new) if plain and self.feed is not None else self._encode(new)):
            out[i] = ids
            if room > 0 and len(x) <= 24:
                cache[x] = ids
                room -= 1
        return out

    def _whole(self, buf: np.ndarray, offs: np.ndarray) -> list[tuple[int, int]]:
        """First and end byte of each text that holds the string of an added token."""
        data, found = buf.tobytes(), set()
        for string in self.added:
            at = data.find(string)
            while at >= 0:
                i = int(np.searchsorted(offs, at, "right")) - 1
                hi = int(offs[i + 1])
                if at + len(string) <= hi:
                    found.add((int(offs[i]), hi))
                    at = data.find(string, hi)
                else:  # it would cross into the next text
                    at = data.find(string, at + 1)
        return sorted(found)

    def encode(self, buf: np.ndarray, offs: np.ndarray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, joined, and the n + 1 offsets of the texts; ``end_id`` is put after each."""
        n = len(offs) - 1
        whole, raw = self._whole(buf, offs), buf
        if self.kind == "words":
            buf = LOWER[buf]  # what the vocabulary's normaliser does to A-Z
        cut = _cuts(buf, offs, self.kind)
        for lo, hi in whole:
            cut[lo + 1:hi] = False
            if self.kind == "words":
                buf[lo:hi] = raw[lo:hi]  # added tokens are looked for in the text as it is
        pos = np.flatnonzero(cut).astype(np.int32)
        found, which = [], np.zeros(0, np.int32)
        starts = pos[:-1]
        if len(starts):
            data = np.ascontiguousarray(buf)
            rows = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(pos), pa.py_buffer(data)])
            if self.kind == "words":
                dark = ~WHITE[buf[starts]] | np.isin(starts, [lo for lo, _ in whole])
                rows, starts = rows.filter(pa.array(dark)), starts[dark]
            coded = rows.dictionary_encode()
            found = self._pieces(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), not whole)
            which = coded.indices.to_numpy(zero_copy_only=False)
        per_text = np.searchsorted(starts, offs)  # pieces before each text
        if end_id is not None:
            which = np.insert(which, per_text[1:], len(found))
            found.append(array(self.code, [end_id]).tobytes())
            per_text = per_text + np.arange(n + 1)
        rows = pa.array(found, pa.large_binary()).take(pa.array(which))
        _, offsets, data = rows.buffers()
        ends = np.frombuffer(offsets, np.int64, len(rows) + 1) // self.dtype.itemsize if len(rows) else np.zeros(1, np.int64)
        ids = np.frombuffer(data, self.dtype, ends[-1]) if ends[-1] else np.zeros(0, self.dtype)
        return ids, ends[per_text]
