"""Encoding by the table of prefixes, held against the library."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import clashing, documents, odd_rows, prose
from tillwork.llm import pieces

FILE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.model_at(FILE)


def same(model, text):
    ids = np.frombuffer(model.encode(text), pieces.ID).tolist()
    assert ids == model.library.encode(text)
    assert model.decode(ids) == model.library.decode(ids)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aeinthrsou ▁\n\tABé漢🙂01<>\x00", max_size=60))
def test_mixed_characters(text):
    same(pieces.model_at(FILE), text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    same(pieces.model_at(FILE), text)


@pytest.mark.parametrize("text", ["a" * 5000, " " * 100 + "x" + " " * 33, "the " * 3000, "x" * 63 + "\n" * 70, "", " ", "\n"])
def test_long_runs(model, text):
    same(model, text)


def test_pairs_by_definition(model):
    for seed in range(30):
        same(model, prose(seed, 60))
    told = list(model._apart.items())[:3000]
    for key, apart in told:
        a, b = model.pieces[key >> 24], model.pieces[key & 0xFFFFFF]
        assert apart == (model._merged(list(a + b)) == [a, b])


def test_cache_turns_over(model, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 20)
    for seed in range(20):
        same(model, prose(seed, 40))


def test_decode_of_loose_bytes(model):
    ids = [model.bytes[0xE6], model.bytes[0x41], model.ids["▁the"]]
    assert model.decode(ids) == model.library.decode(ids)
    assert model.decode([]) == ""


def test_rows(spark, model):
    rows = [r for r in odd_rows() if r[0] is not None]
    docs = clashing(documents(spark, rows))
    told = pieces.decode(pieces.encode(docs, FILE), FILE).collect()
    assert len(told) == len(rows)
    wanted = sorted((r[0], model.library.encode(r[1] or "")) for r in rows)
    assert sorted((r["doc_id"], r["ids"]) for r in told) == wanted
    assert all(r["decoded"] == model.library.decode(r["ids"]) for r in told)
    assert pieces.encode(docs.limit(0), FILE).count() == 0
