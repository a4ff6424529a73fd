"""Removal of repeated windows, held against a plain scan."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import clashing, documents, odd_rows, prose
from tillwork.llm import repeats
from tillwork.llm.fm_index import FMIndex, WaveletMatrix, encode, suffix_order


def plain(rows, window=20):
    """n_words, n_removed, kept of each document, in order of doc_id."""
    seen, out = set(), {}
    for doc_id, text in sorted((r[0], (r[1] or "").encode()) for r in rows):
        words = text.split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        out[doc_id] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode())
    return out


def corpus(seed=4):
    """Copies, near copies, a passage that many share, a word repeated, a line that is common."""
    rng = random.Random(seed)
    shared, line = prose(900, 55), prose(901, 12)
    rows = [(i, prose(i, rng.randint(5, 120))) for i in range(40)]
    rows += [(100 + i, rows[i % 5][1]) for i in range(25)]
    rows += [(200 + i, prose(300 + i, 30) + " " + shared + "\n" + prose(400 + i, 30)) for i in range(30)]
    rows += [(300 + i, f"{line} {prose(500 + i, 25)} {line}") for i in range(20)]
    rows += [(400, "word " * 90), (401, "word " * 33 + prose(7, 40)), (402, rows[70][1].replace(" ", "\t") + " end")]
    rng.shuffle(rows)
    return rows


def told(df):
    rows = df.collect()
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in rows}, rows


def test_against_a_scan(spark):
    rows = corpus()
    got, all_rows = told(repeats.remove_repeats(clashing(documents(spark, rows)).repartition(5)))
    assert len(all_rows) == len(rows)
    assert got == plain(rows)
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in all_rows)


def test_crowded_anchors_and_small_shards(spark, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP_RUNS", 3)
    rows = corpus(8)
    assert told(repeats.remove_repeats(documents(spark, rows)))[0] == plain(rows)


@pytest.mark.parametrize(("window", "gram"), [(1, 1), (5, 5), (8, 3), (32, 8)])
def test_other_windows(spark, window, gram):
    rows = corpus(9)[:70]
    assert told(repeats.remove_repeats(documents(spark, rows), window=window, gram=gram))[0] == plain(rows, window)


def test_odd_rows(spark):
    got, rows = told(repeats.remove_repeats(documents(spark, odd_rows())))
    assert len(rows) == len(odd_rows())
    assert got[1] == (80, 0, odd_rows()[0][1])
    assert got[2] == (80, 80, "")
    assert got[3] == got[4] == got[5] == (0, 0, "")
    assert got[6][0] == 60_000
    assert got[None] == (3, 0, "no id here")
    assert repeats.remove_repeats(documents(spark, []).limit(0)).count() == 0
    with pytest.raises(ValueError, match="window"):
        repeats.remove_repeats(documents(spark, []), window=40)


def test_shards_end_at_anchors():
    rows = [(1, 0, "a b c d"), (2, 0, "x b c y"), (3, 5, "q b c r")]
    batch = repeats._searched(rows, 2)
    assert [r["mask"] for r in batch.to_pylist()] == [0b111, 0b101, 0b101]


def test_rank():
    rng = np.random.default_rng(2)
    symbols = rng.integers(0, 37, 1000)
    matrix = WaveletMatrix(symbols, 37)
    places = rng.integers(0, 1001, 500)
    wanted = rng.integers(0, 37, 500)
    counts = [int((symbols[:p] == s).sum()) for s, p in zip(wanted, places, strict=True)]
    assert matrix.rank(wanted, places).tolist() == counts


def test_matching_statistics():
    rng = random.Random(6)
    sequences = [[rng.choice("abc") for _ in range(rng.randint(1, 30))] for _ in range(40)]
    text, starts, size = encode(sequences)
    index = FMIndex(text, starts, size)
    joined = ["".join(s) for s in sequences]
    ends = np.flatnonzero(text > 0)
    length, low, high = index.statistics(text, ends, 12)
    for n, (end, got) in enumerate(zip(ends, length, strict=True)):
        which = int(np.searchsorted(starts, end, side="right")) - 1
        upto = joined[which][: end - starts[which] + 1]

        def count(k, upto=upto):
            return sum(s.startswith(upto[-k:], i) for s in joined for i in range(len(s)))

        best = max((k for k in range(1, min(12, len(upto)) + 1) if count(k) > 1), default=0)
        assert got == best
        if best:
            assert high[n] - low[n] == count(best)


def test_places_are_found_without_the_suffix_array():
    """Every suffix, by walking back to a kept place, and in few bytes a word."""
    rng = random.Random(9)
    sequences = [[rng.choice("abcdefgh") for _ in range(rng.randint(1, 70))] for _ in range(200)]
    sequences += [sequences[i % 5] for i in range(60)] + [["a"] * 32] * 3
    text, starts, size = encode(sequences)
    index = FMIndex(text, starts, size)
    rows = np.arange(len(text))
    assert (index.locate(rows) == suffix_order(text)).all()
    symbols, ranks = index.matrix.access(rows)
    transform = text[suffix_order(text) - 1]
    assert (symbols == transform).all()
    assert ranks[:500].tolist() == [int((transform[:i] == transform[i]).sum()) for i in range(500)]
    assert not hasattr(index, "text") and not hasattr(index, "order")


def test_bytes_of_an_index():
    """Some four to six bytes a word, with tens of thousands of different words, where text and suffix array take sixteen."""
    rng = random.Random(1)
    words = [f"w{i}" for i in range(60_000)]
    sequences = [[rng.choice(words) for _ in range(28)] for _ in range(14_000)]
    text, starts, size = encode(sequences)
    assert FMIndex(text, starts, size).nbytes / len(text) < 6


def test_rows_without_an_id_are_documents_of_their_own(spark):
    """A text without an id loses what a document repeats, whatever other rows without one hold at the same places."""
    shared = prose(77, 20)
    rows = [(1, shared), (None, shared), (None, prose(5, 20)), (None, prose(6, 60)), (None, prose(6, 60)), (2, prose(6, 60))]
    got = repeats.remove_repeats(documents(spark, rows)).collect()
    told = sorted((r["doc_id"] is None, r["n_words"], r["n_removed"]) for r in got)
    assert told == [(False, 20, 0), (False, 60, 0), (True, 20, 0), (True, 20, 20), (True, 60, 60), (True, 60, 60)]


def odd_words(seed: int, n: int) -> str:
    """Words of 1 to 100 bytes, some of which share their first bytes or hold a zero byte or letters of several bytes."""
    rng = random.Random(seed)
    return " ".join(rng.choice(["a", "a\x00", "abcdefgh", "abcdefghi", "é漢🙂", "x" * 64, "x" * 65, "x" * 100]) for _ in range(n))


def test_anchors_of_many_texts_at_once():
    """Grams alike have one hash wherever they stand, and the anchor of a window is its first gram of least hash; no window crosses texts."""
    told = [odd_words(i, n) for i, n in enumerate([0, 5, 20, 3, 0, 61, 20, 19, 300, 0])]
    found = repeats.Words([repeats.joined(t.encode()) for t in told], 20, 8)
    words = [t.encode().split() for t in told]
    flat = [w for ws in words for w in ws]
    assert [found.between(i, i + 1) for i in range(len(flat))] == flat
    grams = {}
    for i, value in enumerate(found.grams.tolist()):
        assert grams.setdefault(tuple(flat[i : i + 8]), value) == value
    assert len(set(grams.values())) == len(grams)
    starts = [int(found.first[i]) + k for i, ws in enumerate(words) for k in range(len(ws) - 19)]
    assert found.windows.tolist() == starts
    assert found.at.tolist() == [min(range(w, w + 13), key=lambda p: (found.grams[p], p)) for w in starts]


def test_words_are_hashed_by_batch(monkeypatch):
    """One call for the texts of a batch, where there was one for each document: most of the time of the operator."""
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(300)), "text": [prose(i, 60) for i in range(299)] + [None]})
    calls = []
    whole = repeats.gram_hashes
    monkeypatch.setattr(repeats, "gram_hashes", lambda hashed, gram: calls.append(len(hashed)) or whole(hashed, gram))
    once = pa.Table.from_batches(repeats._anchor_counts(iter([rows]), 20, 8)).to_pydict()
    assert calls == [299 * 60]
    monkeypatch.setattr(repeats, "CHUNK", 1)
    each = pa.Table.from_batches(repeats._anchor_counts(iter([rows]), 20, 8))
    assert len(calls) == 301
    total = each.group_by("anchor").aggregate([("n", "sum")]).to_pydict()
    assert dict(zip(total["anchor"], total["n_sum"], strict=True)) == dict(zip(once["anchor"], once["n"], strict=True))


def test_texts_side_by_side_keep_their_own_spans(spark):
    """Texts removed to their ends, beside each other and beside empty ones, with words of all lengths and all kinds of spaces."""
    text = odd_words(3, 40)
    rows = [(1, text), (2, text.replace(" ", "\v\f ")), (3, ""), (4, f"\n{text}\r\n"), (5, None), (6, text + " " + prose(8, 30)), (7, prose(9, 5))]
    got, all_rows = told(repeats.remove_repeats(documents(spark, rows).coalesce(1)))
    assert got == plain(rows)
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in all_rows}
    assert [spans[i] for i in (2, 3, 4, 5, 6, 7)] == [[(0, 40)], [], [(0, 40)], [], [(0, 40)], []]
