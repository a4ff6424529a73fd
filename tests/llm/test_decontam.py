"""Benchmark leaks, held against whole edit-distance tables."""

from __future__ import annotations

import gc
import random
import weakref

import numpy as np
import pytest

from tests.llm.helpers import clashing, documents, odd_rows, prose
from tillwork.llm import decontam


def fewest_edits(item, text):
    """Edits between an item and the nearest stretch of a text, by the whole table."""
    before = np.zeros(len(text) + 1, int)
    for i, c in enumerate(item, 1):
        now = [i]
        for j, t in enumerate(text, 1):
            now.append(min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (c != t)))
        before = np.array(now)
    return int(before.min())


def folded(text):
    return "".join(map(chr, decontam.fold(text)[0]))


def edited(text, n, rng):
    out = list(text)
    for _ in range(n):
        at = rng.randrange(len(out))
        kind = rng.random()
        out[at : at + 1] = [] if kind < 0.3 else [rng.choice("aeinrst")] if kind < 0.7 else [out[at], rng.choice("aeinrst")]
    return "".join(out)


def test_same_decisions_as_the_whole_table():
    rng = random.Random(3)
    items = [(i, prose(i, 12)) for i in range(8)]
    index = decontam.index_of(items)
    for n in range(60):
        i, item = rng.choice(items)
        host = prose(1000 + n, 30)
        cut = rng.randrange(len(host))
        text = f"{host[:cut]} {edited(item, rng.randint(0, len(item) // 7), rng)} {host[cut:]}"
        found = {s["item_id"]: s for s in decontam.leaks_of(text, index)}
        for j, other in items:
            k = int(index.budget[j])
            edits = fewest_edits(folded(other), folded(text))
            assert (j in found) == (edits <= k)
            if j in found:
                assert found[j]["edits"] == edits
                assert fewest_edits(folded(other), folded(text[found[j]["start"] : found[j]["end"]])) == edits


def test_spans_case_and_marks():
    index = decontam.index_of([(7, "The quick, brown fox jumps over the lazy dog.")])
    text = "Zz!  -- THE quick brown\n\nfox JUMPS over the lazy dog!! the end"
    (span,) = decontam.leaks_of(text, index)
    assert text[span["start"] : span["end"]] == "THE quick brown\n\nfox JUMPS over the lazy dog"
    assert span["edits"] == 0


@pytest.mark.parametrize("length", [8, 9, 15, 16, 17, 31])
def test_short_items(length):
    item = prose(5, 12)[:length].strip()
    index = decontam.index_of([(1, item)])
    assert (index.bound >= 1).all()
    assert decontam.leaks_of("some text " + item + " more", index)


def test_repeating_texts():
    index = decontam.index_of([(1, "ab " * 40), (2, "a" * 50), (3, "of the " * 30)])
    assert {s["item_id"] for s in decontam.leaks_of("of the " * 5000, index)} == {3}
    assert {s["item_id"] for s in decontam.leaks_of("a" * 3000, index)} == {2}
    assert decontam.leaks_of("b" * 3000, index) == []


def test_rows_and_blocks(spark, monkeypatch):
    items = [(i, prose(800 + i, 20)) for i in range(12)] + [(50, None), (51, ""), (52, "tiny"), (0, prose(800, 20))]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    rows = [*odd_rows(), *[(100 + i, f"{prose(700 + i, 25)} {prose(800 + i, 20)} tail") for i in range(6)]]
    docs = documents(spark, rows)
    wanted = {(100 + i, i, 0) for i in range(6)}
    for size in (decontam.BLOCK_CHARS, 300):
        monkeypatch.setattr(decontam, "BLOCK_CHARS", size)
        got = decontam.find_leaks(clashing(docs), bench).collect()
        assert {(r["doc_id"], r["item_id"], r["edits"]) for r in got} == wanted
        kept = decontam.remove_leaking(clashing(docs), bench)
        assert kept.columns == clashing(docs).columns
        assert kept.count() == len(rows) - 6
    assert decontam.find_leaks(docs.limit(0), bench).count() == 0
    assert decontam.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontam.remove_leaking(docs, bench.limit(0)).count() == len(rows)


def test_one_index_at_a_time(spark, monkeypatch):
    bench = spark.createDataFrame([(i, prose(800 + i, 20)) for i in range(12)], "item_id long, text string")
    docs = documents(spark, [(100 + i, f"{prose(700 + i, 25)} {prose(800 + i, 20)} tail") for i in range(6)])
    made, alive = [], []

    def counted(*told):
        gc.collect()
        alive.append(sum(ref() is not None for ref in made))
        index = index_of(*told)
        if index is not None:
            made.append(weakref.ref(index))
        return index

    index_of = decontam.index_of
    monkeypatch.setattr(decontam, "index_of", counted)
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 300)
    for told in (decontam.find_leaks(docs, bench), decontam.remove_leaking(docs, bench)):
        assert "MapInArrow" not in told._jdf.queryExecution().toString()
    assert len(made) > 4
    assert max(alive) == 0


def test_items_without_an_id(spark):
    items = [(None, prose(800, 20)), (None, prose(801, 20)), (0, prose(802, 20)), (None, prose(800, 20))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    text = " ".join(t for _, t in items[:3])
    docs = documents(spark, [(1, text), (2, f"{prose(700, 25)} {prose(801, 20)}"), (3, prose(701, 40)), (None, prose(802, 20))])
    got = decontam.find_leaks(docs, bench).collect()
    assert sorted((str(r["doc_id"]), str(r["item_id"]), r["edits"]) for r in got) == [
        ("1", "0", 0), ("1", "None", 0), ("1", "None", 0), ("2", "None", 0), ("None", "0", 0),
    ]
    assert [r["doc_id"] for r in decontam.remove_leaking(docs, bench).collect()] == [3]
    # different items without an id that overlap are both told
    index = decontam.index_of([(None, prose(800, 20)), (None, prose(800, 20) + " the")])
    assert [s["item_id"] for s in decontam.leaks_of(prose(800, 20) + " the", index)] == [None, None]


@pytest.mark.parametrize("item", ["7", "é?", "x7!", "42 x", "ab cd", "42 x7.", "a b c d", "  Q & A "])
def test_items_without_a_qgram(item):
    """Items of 1 to 7 characters leak where the same words stand, and nowhere else."""
    plain = folded(item)
    assert 0 < len(plain) < decontam.Q
    index = decontam.index_of([(1, item), (2, prose(3, 12))])
    alone = decontam.index_of([(1, item)])
    for host in (f"so {item} it is", item, f"{item}, and {item}", item.upper() + "\n" + prose(4, 40)):
        for told in (index, alone):
            spans = [s for s in decontam.leaks_of(host, told) if s["item_id"] == 1]
            places = [i for i in range(len(folded(host))) if f" {folded(host)} ".startswith(f" {plain} ", i)]
            assert len(spans) == len(places) > 0
            assert all(folded(host[s["start"] : s["end"]]) == plain and s["edits"] == 0 for s in spans)
    words = plain.split()
    for host in ("", "nothing here", "x".join(words) + "x", "z" + plain, plain + "z", " and ".join([*words, "so"]) if len(words) > 1 else "zz"):
        assert decontam.leaks_of(host, index) == decontam.leaks_of(host, alone) == []


def test_short_items_over_a_table(spark):
    items = spark.createDataFrame([(1, "42 x7"), (2, "..."), (3, prose(8, 15)), (None, "ok")], "item_id long, text string")
    docs = documents(spark, [(1, "say 42 X7 now"), (2, prose(8, 15)), (3, "..."), (4, "42 x 7"), (5, "OK"), (6, None), (7, "")])
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, items).collect()}
    assert got == {(1, 1), (2, 3), (5, None)}
    assert sorted(r["doc_id"] for r in decontam.remove_leaking(docs, items).collect()) == [3, 4, 6, 7]
    only_marks = items.where("item_id = 2")
    assert decontam.find_leaks(docs, only_marks).count() == 0
    assert decontam.remove_leaking(docs, only_marks).count() == 7
