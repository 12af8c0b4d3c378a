"""BPE against the library, and an exact round trip."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starkeel.llm import bpe, queries

PATH = queries.tokenizer_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("ab '\n\t.1é<|endoftext|>", max_size=80))
def test_ids_and_text_as_the_library(library, text):
    own = bpe.load(PATH)
    ids = own.encode(text)
    expected = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == expected
    assert own.decode(ids) == library.decode(expected, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "x" * 20_000, "  \n\n x"])
def test_edges(library, text):
    expected = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(bpe.load(PATH).encode(text), "<u4").tolist() == expected


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    own = bpe.Bpe(PATH)
    text = " ".join(f"w{i}" for i in range(500))
    assert own.decode(own.encode(text)) == text
    assert len(own.newer) <= 10 and len(own.older) <= 10


def test_query_over_the_whole_table(spark, documents, library):
    got = {r["doc_id"]: r for r in queries.op8_bpe(spark, "/root/testdata/sf0.001").collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert got[r["doc_id"]]["n_tokens"] == len(ids)
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_awkward_rows(awkward, empty):
    rows = bpe.encode_decode(awkward, PATH).collect()
    assert len(rows) == 11
    assert sorted(r["decoded"] for r in rows) == sorted((r["text"] or "") for r in awkward.collect())
    assert bpe.encode_decode(empty, PATH).collect() == []
