"""Files of patched frame-of-reference blocks: exact round trips."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import clashing, documents, odd_rows, prose
from tillwork.llm import idfiles

FILE = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=1024))
def test_block(values):
    ids = np.array(values, np.uint32)
    assert (idfiles.unpack_block(memoryview(idfiles.pack_block(ids))) == ids).all()


def test_exceptions_are_patched():
    ids = np.array([5] * 1000 + [70_000] * 24, np.uint32)
    data = idfiles.pack_block(ids)
    assert len(data) < 1024
    assert (idfiles.unpack_block(memoryview(data)) == ids).all()


def test_blocks_together_are_blocks_alone():
    rng = np.random.default_rng(4)
    for n in (1, 1024, 1025, 300 * 1024 + 7):
        tops = rng.choice([1, 2, 300, 50_000, 2**31], -(-n // 1024))
        flat = (rng.random(n) * np.repeat(tops, 1024)[:n]).astype(idfiles.ID) + rng.integers(0, 5, n).astype(idfiles.ID)
        flat[rng.random(n) < 0.03] = 2**32 - 1
        assert idfiles.pack_blocks(flat) == [idfiles.pack_block(flat[i : i + 1024]) for i in range(0, n, 1024)]


def test_file_and_random_access():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_000, n).astype(idfiles.ID) for n in (1, 3000, 1, 1023, 1024, 7)]
    data = memoryview(idfiles.pack_file(list(range(6)), [d.tobytes() for d in docs]))
    told = list(idfiles.unpack_file(data))
    assert [d for d, _, _ in told] == list(range(6))
    assert [s for _, s, _ in told] == np.cumsum([0] + [len(d) for d in docs])[:-1].tolist()
    assert all((a == b).all() for (_, _, a), b in zip(told, docs, strict=True))
    flat = np.concatenate(docs)
    assert (idfiles.read_ids(data, 1000, 4100) == flat[1000:4100]).all()
    with pytest.raises(ValueError, match="format"):
        idfiles.read_index(memoryview(b"\0" * 64))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab T's,.  \n\t.é漢🙂01\x85\xa0　\x1c​!", max_size=40))
def test_encoding_equals_the_library(text):
    encoder = idfiles.encoder_at(FILE)
    wanted = encoder.library.encode(text, add_special_tokens=False).ids + [idfiles.END_ID]
    assert np.frombuffer(encoder.encode([text])[0], idfiles.ID).tolist() == wanted


def test_special_strings_and_cache(monkeypatch):
    library = Tokenizer.from_file(FILE)
    encoder = idfiles.Encoder(FILE)
    monkeypatch.setattr(idfiles, "KEPT_SEGMENTS", 10)
    for text in ["a<|endoftext|> b", " x<|endoftext|>y z", "don't you'll", *[prose(i, 50) for i in range(10)]]:
        wanted = library.encode(text, add_special_tokens=False).ids + [0]
        assert np.frombuffer(encoder.encode([text])[0], idfiles.ID).tolist() == wanted


def test_rows(spark, monkeypatch):
    rows = odd_rows() + [(None, "another"), *((100 - i, prose(i, 30)) for i in range(40))]
    docs = clashing(documents(spark, rows).repartition(4))
    told = idfiles.digests(idfiles.round_trip(docs, FILE, partitions=5)).orderBy("start").collect()
    library = Tokenizer.from_file(FILE)
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    assert [r["doc_id"] for r in told] == [r[0] for r in ordered]
    start = 0
    for r, row in zip(told, ordered, strict=True):
        ids = library.encode(row[1] or "", add_special_tokens=False).ids + [0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)
    assert idfiles.round_trip(docs.limit(0), FILE).count() == 0


def test_rows_without_an_id_come_last(spark):
    docs = documents(spark, [(None, "a b"), (2, "c"), (None, None), (-5, "d")])
    told = idfiles.round_trip(docs, FILE, partitions=3).orderBy("start").collect()
    assert [r["doc_id"] for r in told] == [-5, 2, None, None]
    assert [len(r["ids"]) for r in told] == [2, 2, 1, 3]
    with pytest.raises(ValueError, match="last"):
        idfiles.pack_file([None, 1], [b"\0" * 4] * 2)


def test_several_files_in_a_partition(spark):
    """Files know their first id's number without the driver's list of them."""
    one = prose(1, 3000)
    docs = documents(spark, [(i, one) for i in range(1500)]).coalesce(1)
    files = idfiles.write_ids(docs, folder := idfiles.shared_folder(spark, "ids"), FILE, partitions=1)
    assert files.count() == 2
    told = idfiles.read_back(files, folder).select("doc_id", "start", F.size("ids").alias("n")).orderBy("start").collect()
    assert [r["doc_id"] for r in told] == list(range(1500))
    assert all(a["start"] + a["n"] == b["start"] for a, b in zip(told, told[1:], strict=False))
