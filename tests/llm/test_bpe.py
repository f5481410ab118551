"""BPE against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quire.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def codec():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Codec(f.read())


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    out = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(out.encode()).hexdigest()


def test_documents(spark, small, library):
    for r in bpe.encode_decode(small.withColumnRenamed("n", "m"), PATH).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(library, r.text)


def test_edges(edges, library):
    rows = bpe.encode_decode(edges, PATH, with_output=True).collect()
    assert len(rows) == edges.count()
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(library, r.text)
        assert library.decode(list(r.ids), skip_special_tokens=False) == r.decoded
        assert r.n == 5


def test_empty_table(nothing):
    assert bpe.encode_decode(nothing, PATH).count() == 0


SPECIAL = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "'s", "'LL", "don't", "</w>", "İ", "Σ", "ẞ", "\x1c", "\x85",
           "　", "​", "ำ", "\U0001d7d8", "ﬁ", "ͅ", "한", "한", "\x00", "\x7f", "a", "Z", "9", " ", "\n"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(SPECIAL), st.text(max_size=8)), max_size=12).map("".join))
def test_any_text(text):
    if any(0xD800 <= ord(c) <= 0xDFFF for c in text):
        return
    lib = Tokenizer.from_file(PATH) if not hasattr(test_any_text, "lib") else test_any_text.lib
    test_any_text.lib = lib
    if not hasattr(test_any_text, "codec"):
        with open(PATH, encoding="utf-8") as f:
            test_any_text.codec = bpe.Codec(f.read())
    ids = test_any_text.codec.encode(text)
    assert ids.tolist() == lib.encode(text, add_special_tokens=False).ids
    assert test_any_text.codec.decode(ids).decode() == lib.decode(ids.tolist(), skip_special_tokens=False)
