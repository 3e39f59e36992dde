"""Word encoding equals the tokenizers library, and decodes like it."""

import hashlib
import struct

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm import tokens
from ledgerlens.llm.queries import op8_bpe_encoding, vocabulary
from samples import SF, documents, nothing, odd  # noqa: F401

NAME = "word_bpe_49k.json"
CODER = tokens.WordCoder(vocabulary())


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path(NAME))
    t.no_truncation()
    t.no_padding()
    return t


LIBRARY = Tokenizer.from_file(public_tokenizers.path(NAME))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    got = CODER.encode(text)
    assert list(struct.unpack(f"<{len(got) // 4}I", got)) == want
    assert CODER.decode(got) == LIBRARY.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["ΑΣ ς Σ", "<|endoftext|>a<|startoftext|>", "it's we'll'd", "x" * 3000, "\x1c\x85 ² ª º", "<|EndOfText|>", "!?" * 900])
def test_corners(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    got = CODER.encode(text)
    assert list(struct.unpack(f"<{len(got) // 4}I", got)) == want


def test_query_over_documents(spark, documents, library):
    got = {r["doc_id"]: r for r in op8_bpe_encoding(spark, SF).collect()}
    for r in documents.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        row = got[r["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(odd, nothing):
    out = tokens.encode_documents(odd, vocabulary())
    rows = out.collect()
    assert len(rows) == odd.count() and all(r["ids"] == b"" and r["decoded"] == "" for r in rows if not r["text"])
    assert tokens.encode_documents(nothing, vocabulary()).count() == 0
