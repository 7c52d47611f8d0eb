"""Token counts against the library."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stratalake.llm import tokens
from stratalake.llm.common import table

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_documents(spark, small):
    docs = table(spark, small, "documents")
    rows = tokens.token_counts(docs, PATH).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert [r.n_tokens for r in rows] == library([texts[r.doc_id] for r in rows])
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 512) for r in rows)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab 's't'r're'll'v \n\t\xa0é!?-中12<|endoftext|>"), max_size=60))
def test_any_text(text):
    assert tokens.counter(PATH).count([text]) == library([text])


def test_special_strings_contractions_and_white_space():
    texts = ["<|endoftext|>", "a<|endoftext|> b", "it's we're I'll 'tis ''s x' 's\n's", "  a  b \n\n c\t", "a" * 3000, "　x  ", "x\x00y", None, ""]
    assert tokens.counter(PATH).count(texts) == library(texts)


def test_long_texts_are_cut_safely(monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK", 500)
    rng = random.Random(2)
    text = "".join(rng.choice("ab cd'ef \n!1é") for _ in range(20_000))
    assert sum(map(len, tokens.blocks(text))) == len(text) and sum(1 for _ in tokens.blocks(text)) > 10
    assert tokens.TokenCounter(PATH).count([text, "b" * 3000]) == library([text, "b" * 3000])


def test_scan_composes_maps():
    rng = np.random.default_rng(0)
    maps = rng.integers(0, 12, (37, 12)).astype(np.uint8)
    want, state = [], np.arange(12)
    for m in maps:
        state = m[state]
        want.append(state)
    assert (tokens.scan(maps) == np.array(want)).all()


def test_hash_table():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 40, 50_000))
    held = tokens.Table()
    held.put(keys[::2], np.arange(len(keys[::2])))
    found = held.get(keys)
    assert (found[::2] == np.arange(len(keys[::2]))).all() and (found[1::2] == -1).all()


def test_edges(edges, empty):
    rows = tokens.token_counts(edges, PATH).collect()
    assert [r.n_tokens for r in rows] == library([r.text for r in edges.collect()])
    assert tokens.token_counts(empty, PATH).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        tokens.TokenCounter(public_tokenizers.path("word_bpe_49k.json"))
