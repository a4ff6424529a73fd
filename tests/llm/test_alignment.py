"""Alignment of two tokenizers, held against byte offsets of all tokens and plain counts."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import clashing, documents, odd_rows
from tillwork.llm import alignment, registry

FILES = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
EMPTY = [0] * 6 + [""]


@pytest.fixture(scope="module")
def libraries():
    left = Tokenizer.from_file(FILES[0])
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def spelled(libraries, text):
    """(id, start, end) of all tokens of both, or None where they do not spell the text; the left from the library's own decoder."""
    left, right = libraries
    letters = alignment.byte_letters()
    told = []
    ids = left.encode(" " + text, add_special_tokens=False).ids
    told.append([(i, bytes(letters[c] for c in left.id_to_token(i))) for i in ids])
    pieces = [(i, right.id_to_piece(i)) for i in right.encode(text)]
    told.append([(i, bytes([int(p[3:5], 16)]) if right.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces])
    out = []
    for tokens in told:
        if b"".join(b for _, b in tokens) != (" " + text).encode():
            return None
        at, placed = 0, []
        for i, b in tokens:
            placed.append((i, at, at + len(b)))
            at += len(b)
        out.append(placed)
    return out


def plain(libraries, rows):
    found, documents_of = [], Counter()
    for doc_id, text in rows:
        both = spelled(libraries, text) if text else None
        if both is None:
            found.append((doc_id, None))
            continue
        a, b = both
        links, start = [], 0
        for i, s, e in a:
            while b[start][2] <= s:
                start += 1
            for j, t, f in b[start:]:
                if t >= e:
                    break
                if f > s:
                    links.append((i, j))
        shared = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        place = [0, 0]
        for end in shared:
            part = []
            for k, tokens in enumerate(both):
                ids = []
                while place[k] < len(tokens) and tokens[place[k]][2] <= end:
                    ids.append(str(tokens[place[k]][0]))
                    place[k] += 1
                part.append(",".join(ids))
            groups.append("|".join(part))
            low = end
        assert low == len((" " + text).encode())
        documents_of.update(set(links))
        found.append((doc_id, (len(a), len(b), len(shared), links, hashlib.sha256(";".join(groups).encode()).hexdigest())))
    most = defaultdict(int)
    for (i, _), n in documents_of.items():
        most[i] = max(most[i], n)
    out = []
    for doc_id, told in found:
        if told is None:
            out.append((doc_id, *EMPTY))
        else:
            n_a, n_b, n_groups, links, digest = told
            n_best = sum(documents_of[x] == most[x[0]] for x in links)
            out.append((doc_id, n_a, n_b, n_groups, len(links), n_best, sum(documents_of[x] for x in links), digest))
    return sorted(out, key=str)


def told(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_given_documents(spark, libraries):
    read = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    rows = list(zip(read["doc_id"], read["text"], strict=True))
    assert told(registry.op11_alignment(spark, "/root/testdata/sf0.001")) == plain(libraries, rows)


def test_odd_rows_in_many_blocks(spark, libraries):
    rows = [r[:2] for r in odd_rows() if r[0] != 6]
    rows += [(20, "▁ is no space"), (21, "a" * 3000), (22, " "), (23, "\n\n  two  spaces \t"), (24, "<s> </s> <unk> <0x41> <|endoftext|>")]
    rows += [(30 + i, "the same text in many rows") for i in range(40)] + [(None, "the same text"), (25, "é ﬀ ① ½ Ａ x​")]
    frame = clashing(documents(spark, rows).repartition(3), "TEXT", "pair", "block", "n", "best")
    assert told(alignment.align(frame, *FILES, block_tokens=30)) == plain(libraries, rows)


def test_empty_tables_and_tables_without_tokens(spark):
    assert alignment.align(documents(spark, []), *FILES).count() == 0
    rows = [(1, None), (2, ""), (None, None)]
    got = alignment.align(documents(spark, rows), *FILES)
    assert told(got) == sorted(((i, *EMPTY) for i, _ in rows), key=str)


def test_a_long_text(spark, libraries):
    (row,) = [r[:2] for r in odd_rows() if r[0] == 6]
    (got,) = alignment.align(documents(spark, [row]), *FILES, block_tokens=1000).collect()
    assert got["n_links"] == got["n_a"] + got["n_b"] - got["n_groups"] == got["count_sum"] == got["n_best"]
    ids = libraries[0].encode(" " + row[1], add_special_tokens=False).ids
    assert got["n_a"] == len(ids)


@given(st.lists(st.text(alphabet=st.sampled_from("ab eé漢🙂▁\n\t<>0x41 's"), max_size=30), min_size=1, max_size=4))
@settings(max_examples=60, deadline=None)
def test_windows_are_whole(libraries, some):
    """Windows put together are the document, whatever it holds, and have its links."""
    both = alignment.tokenizers_at(*FILES)
    some = [s for s in some if s]
    for text, ids in zip(some, both.encode(some), strict=True):
        placed = spelled(libraries, text)
        assert both.verified([text, text], [ids, ids]).tolist() == [placed is not None] * 2
        if placed:
            cut = alignment.Cut([ids, ids], both)
            first, told = cut.distinct()
            for side in (0, 1):
                every = [i for w in told for i in cut.ids[side][cut.starts[side][first[w]] : cut.ends[side][first[w]]]]
                assert every == 2 * [i for i, *_ in placed[side]]
            links, widths, written = cut.align(first)
            ends = np.cumsum(widths)
            every = [link for w in told for link in links[ends[w] - widths[w] : ends[w]]]
            wanted = [i << 32 | j for i, s, e in placed[0] for j, t, f in placed[1] if t < e and f > s]
            assert sorted(every) == sorted(2 * wanted)
            assert cut.groups.sum() == sum(written[w].count("|") for w in told)


@given(st.lists(st.text(alphabet=st.sampled_from("ab eé漢🙂▁\n\n \t<>0x41 's"), max_size=30), max_size=6))
@settings(max_examples=150, deadline=None)
def test_ids_are_the_libraries(libraries, some):
    both = alignment.tokenizers_at(*FILES)
    for text, ids in zip(some, both.encode(some), strict=True):
        assert (ids is None) == (not text)
        if text:
            assert ids[0].tolist() == libraries[0].encode(" " + text, add_special_tokens=False).ids
            assert ids[1].tolist() == libraries[1].encode(text)


def test_verification():
    both = alignment.tokenizers_at(*FILES)
    some = ["two words", "a ▁ mark", "more text here", "é"]
    ids = both.encode(some)
    assert both.verified(some, ids).tolist() == [True, False, True, True]
    assert both.verified(["two wordz", "é"], [ids[0], ids[3]]).tolist() == [False, True]
    assert both.verified(["two words!", "é"], [ids[0], ids[3]]).tolist() == [False, True]
    assert both.verified(["two wordz"], ids[:1]).tolist() == [False]


def test_windows_of_equal_hash_are_told_apart(monkeypatch):
    both = alignment.tokenizers_at(*FILES)
    cut = alignment.Cut(both.encode(["two words here", "here two words two", "here here"]), both)
    first, told = cut.distinct()
    monkeypatch.setattr(alignment.Cut, "_alike", lambda *_: False)
    others, number = cut.distinct()
    assert (others[number] == first[told]).all()
    assert len(others) == len(first) == 3
    monkeypatch.undo()
    assert not cut._alike(np.zeros(len(told), int))
