"""SimHash groups, held against all pairs."""

from __future__ import annotations

import random

import xxhash

from tests.llm.helpers import clashing, documents, odd_rows, prose
from tillwork.llm import simhash


def plain_fingerprint(text):
    words, word = [], ""
    for c in text or "":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    words += [word] * bool(word)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Smallest id reachable over links, by trying all pairs."""
    ids = list(prints)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if bin(prints[a] ^ prints[b]).count("1") <= 3 and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_fingerprints():
    for text in [None, "", "one", "One two", "a B c", "a\x0bb\x0cc d e É", prose(1, 200)]:
        assert simhash.fingerprint(text, 3) == plain_fingerprint(text)


def test_every_close_pair_is_found(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(15)]
    prints = {b ^ sum(1 << p for p in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(12)} | {0, 7, 2**64 - 1}
    signed = [(p - 2**64 if p >> 63 else p,) for p in prints]
    for blocks in (4, 6, 7):
        got = simhash.links(spark.createDataFrame(signed, "fp long"), blocks=blocks).collect()
        pairs = {frozenset((r["a"] % 2**64, r["b"] % 2**64)) for r in got}
        assert len(pairs) == len(got)
        assert pairs == {frozenset((x, y)) for x in prints for y in prints if x < y and bin(x ^ y).count("1") <= 3}


def test_rows(spark):
    rng = random.Random(2)
    rows = [r for r in odd_rows() if r[0] is not None and r[0] != 6]
    for i in range(40):
        words = prose(i % 6 + 10, 120).split()
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = "changed"
        rows.append((200 + i, " ".join(words)))
    docs = documents(spark, rows)
    told = simhash.near_duplicates(clashing(docs)).collect()
    assert len(told) == len(rows)
    prints = {r[0]: plain_fingerprint(r[1]) for r in rows}
    wanted = groups(prints)
    assert {r["doc_id"]: r["fingerprint"] for r in told} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in told} == wanted
    kept = simhash.keep_first(clashing(docs))
    assert kept.columns == clashing(docs).columns
    assert sorted(r[0] for r in kept.collect()) == sorted(set(wanted.values()))


def test_missing_ids_and_empty_tables(spark):
    docs = documents(spark, [(None, "a b c d"), (None, "x y z"), (5, "a b c d")])
    told = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert told == {(None, 5), (None, None), (5, 5)}
    assert simhash.keep_first(docs).count() == 3
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_first(docs.limit(0)).count() == 0


def test_one_id_with_many_texts(spark):
    """Rows of one id that are no near duplicates all stay; which of near duplicates stays does not hang on the order."""
    rows = [(i % 20, prose(i, 40)) for i in range(60)]
    kept = {(r["doc_id"], r["text"]) for r in simhash.keep_first(documents(spark, rows)).collect()}
    assert kept == set(rows)
    copies = [(7, rows[0][1]), (0, rows[0][1]), (0, rows[0][1].upper()), (0, rows[0][1])]
    told = {
        tuple(sorted((r["doc_id"], r["text"]) for r in simhash.keep_first(documents(spark, order).repartition(n)).collect()))
        for n, order in enumerate([copies, copies[::-1], [*copies[2:], *copies[:2]]], 1)
    }
    assert len(told) == 1
    ((stays,),) = told
    assert stays in {(0, rows[0][1]), (0, rows[0][1].upper())}
