import functools

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from catchflow.llm.common import text_bytes
from catchflow.llm.tokens import TextEncoder, tokenizer_file

FILES = [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "bytes")]
END, START = "<|endoftext|>", "<|startoftext|>"


@functools.cache
def both(name, kind):
    """The encoder and, apart from it, the library's own tokenizer."""
    return TextEncoder(tokenizer_file(name), kind), Tokenizer.from_file(tokenizer_file(name))


def check(texts):
    for name, kind in FILES:
        buf, offs = text_bytes(pa.array(texts, pa.string()))
        encoder, fresh = both(name, kind)
        ids, at = encoder.encode(buf, offs, 5)
        want = [fresh.encode(t, add_special_tokens=False).ids + [5] for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want, name


def test_strings_of_added_tokens_have_the_library_s_ids():
    check([f"end of page {END} next page", END, START, f" \n{START} A b.{END}\n", f"{END}{END}x", "<|ENDOFTEXT|> <|EndOfText|>", f"ONE {END} TWO", "plain text, here",
           "<|endof", "text|>", f"{END}̸ é", "", f"a{START}", f"{START}b", f"long {'word ' * 50}{END}"])


@pytest.mark.parametrize("name,kind,want", [("byte_bpe_50k.json", "bytes", [437, 286, 2443, 220, 50256, 1306, 2443])])
def test_ids_of_the_review(name, kind, want):
    buf, offs = text_bytes(pa.array([f"end of page {END} next page"]))
    assert TextEncoder(tokenizer_file(name), kind).encode(buf, offs)[0].tolist() == want


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from([END, START, "<|ENDOFTEXT|>", "<|", "endoftext|>", " ", "\n", "\t", " ", "A", "b", "it's", ".", "̸", "é", "7"]), max_size=9).map("".join), max_size=9))
def test_ids_equal_a_fresh_tokenizer(texts):
    check(texts)


def test_input_bytes_are_not_changed():
    buf, offs = text_bytes(pa.array([f"A {END} B"]))
    before = np.array(buf)
    TextEncoder(tokenizer_file("word_bpe_49k.json"), "words").encode(buf, offs)
    assert (before == buf).all()
