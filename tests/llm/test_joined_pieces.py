import pyarrow as pa
import pytest

from catchflow.llm.common import text_bytes
from catchflow.llm.tokens import TextEncoder, tokenizer_file


class Counted:
    """A tokenizer that notes how many strings it is given."""

    def __init__(self, tok):
        self.tok, self.strings = tok, 0

    def __getattr__(self, name):
        return getattr(self.tok, name)

    def encode_batch_fast(self, texts, **kw):
        self.strings += len(texts)
        return self.tok.encode_batch_fast(texts, **kw)


@pytest.fixture
def enc():
    out = TextEncoder(tokenizer_file("byte_bpe_50k.json"), "bytes")
    out.cache.clear()
    out.tok = Counted(out.tok)
    return out


def encoded(enc, texts):
    ids, at = enc.encode(*text_bytes(pa.array(texts, pa.string())), 2)
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def wanted(enc, texts):
    return [enc.tok.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_new_pieces_go_to_the_library_many_to_a_string(enc):
    texts = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{i} it's" for i in range(j, j + 500)) for j in range(0, 5000, 500)]
    assert encoded(enc, texts) == wanted(enc, texts)
    assert enc.tok.strings < 1000  # it was one for each of over 5,000 pieces
    assert encoded(enc, texts) == wanted(enc, texts)


def test_pieces_that_are_no_lines_go_alone(enc):
    odd = ["a\n\nb", "\n", " ", "a \n b", "x\n", "\ny", "a  b", "é  é", " z", "q\x1cr", "\x85", "a\tb", "'s it's", "<|endoftext", "…a", "中 文\n中", ""]
    for texts in (odd, [t + "<|endoftext|>" + t for t in odd], [*odd, "<|endoftext|>"], [""], ["", ""], [" " * 5, "\n\n\n"]):
        enc.cache.clear()
        assert encoded(enc, texts) == wanted(enc, texts)
    many = [f"{a}{i}{b}" for i in range(70) for a in odd[:8] for b in odd[8:]]
    enc.cache.clear()
    assert encoded(enc, many) == wanted(enc, many)
    ids, at = enc.encode(*text_bytes(pa.array(["", None], pa.string())))
    assert len(ids) == 0 and at.tolist() == [0, 0, 0]
