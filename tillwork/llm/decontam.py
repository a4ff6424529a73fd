"""Benchmark decontamination by the q-gram lemma over diagonal bands, checked by banded alignment.

If some region of a document is within ``k`` edits of a benchmark item of ``m`` characters, the two share at least
``m - q + 1 - k q`` q-grams, and these lie on at most ``k + 1`` neighbouring diagonals (place in the document less place in
the item).  Shared q-grams are counted in bands of ``2 (k + 1)`` diagonals that overlap by half, so one band holds all of
a region's; bands that reach the bound are aligned, and what stays within ``k`` edits is a leak.

Texts are compared in lower case, with every run of other characters than letters and digits as one space.  Items of fewer
than q characters have no q-gram and no budget: they are found where the same words stand.  The items
go to the tasks, in blocks of bounded size.  Of several blocks, each is one pass over the documents whose leaks are
written before the next index is made, so the driver and a task hold one index; documents are shuffled only then,
once, to remove those that leak.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.shared import kind_of, numbered, pick, ready, stored

Q = 8
#: Edits allowed, as a share of an item's characters.
ERROR = 0.1
#: Characters of benchmark items that one pass sends to the tasks, about.
BLOCK_CHARS = 4_000_000
#: Places of a document whose q-grams are looked up at a time.
SLICE = 100_000
SPACE = ord(" ")

SPAN = pa.struct(
    [("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())]
)
SPANS = "array<struct<item_id:long,start:int,end:int,edits:int>>"


@cache
def _folded() -> np.ndarray:
    """Lower case of every character of the basic plane, a space for what is no letter or digit."""
    table = np.full(1 << 16, SPACE, "<u4")
    for c in range(1 << 16):
        if chr(c).isalnum():
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def fold(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The characters that are compared, and the place of each in the text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    low = np.where(points < 1 << 16, _folded()[np.minimum(points, 0xFFFF)], points)
    blank = low == SPACE
    kept = ~blank
    kept[1:] |= ~blank[:-1]
    if len(kept) and blank[0]:
        kept[0] = False
    places = np.flatnonzero(kept)
    if len(places) and low[places[-1]] == SPACE:
        places = places[:-1]
    return low[places], places


def grams(points: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q-gram that starts at each place."""
    n = len(points) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    rolled = np.zeros(n, np.uint64)
    for i in range(q):
        rolled = rolled * np.uint64(0x100000001B3) + points[i : i + n].astype(np.uint64)
    return rolled * np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Index:
    """The q-grams of some items: sorted hashes, and the items and places that have each."""

    q: int
    ids: list[int | None]
    items: list[np.ndarray]  # folded characters
    budget: np.ndarray  # edits allowed
    bound: np.ndarray  # shared q-grams needed
    sieve: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # of each hash, among the entries
    entry_item: np.ndarray
    entry_place: np.ndarray
    short: dict[tuple[str, ...], list[int | None]]  # items of fewer than q characters, by their words


SIEVE_BITS = 22


def _words(points: np.ndarray) -> list[str]:
    """The words of folded characters."""
    return points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").split(" ")


def index_of(items: list[tuple[int | None, str]], q: int = Q, error: float = ERROR) -> Index | None:
    """The index of all items that have a letter or digit; None without any.

    Items too short for a sure shared q-gram under the full budget get the largest budget that leaves one.
    """
    folded = [(None if i is None else int(i), fold(text)[0]) for i, text in items]
    short: dict[tuple[str, ...], list[int | None]] = {}
    for i, points in folded:
        if 0 < len(points) < q:
            short.setdefault(tuple(_words(points)), []).append(i)
    told = [(i, points) for i, points in folded if len(points) >= q]
    if not told:
        none = np.zeros(0, np.int64)
        empty = Index(q, [], [], none, none, np.zeros(1 << SIEVE_BITS, bool), none.astype(np.uint64), np.zeros(1, np.int64), none, none, short)
        return empty if short else None
    lengths = np.array([len(points) for _, points in told])
    budget = np.minimum((lengths * error).astype(int), (lengths - q) // q)
    hashed = [grams(points, q) for _, points in told]
    flat = np.concatenate(hashed)
    item = np.repeat(np.arange(len(told)), [len(h) for h in hashed])
    place = np.concatenate([np.arange(len(h)) for h in hashed])
    order = np.argsort(flat, kind="stable")
    hashes, first = np.unique(flat[order], return_index=True)
    sieve = np.zeros(1 << SIEVE_BITS, bool)
    sieve[(hashes >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)] = True
    return Index(
        q, [i for i, _ in told], [points for _, points in told], budget, lengths - q + 1 - budget * q, sieve,
        hashes, np.append(first, len(flat)), item[order], place[order], short,
    )


def _band_counts(points: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Items and bands that share q-grams enough with a document."""
    if not index.items:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashed = grams(points, index.q)
    passed = np.flatnonzero(index.sieve[(hashed >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)])
    if len(passed):
        at = np.searchsorted(index.hashes, hashed[passed])
        at[at == len(index.hashes)] = 0
        same = index.hashes[at] == hashed[passed]
        passed, at = passed[same], at[same]
    if len(passed) < index.bound.min():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    often = index.first[at + 1] - index.first[at]
    # an item that shares too few q-grams with the whole document needs no bands
    total = np.zeros(len(index.items), np.int64)
    for i in range(0, len(at), SLICE):
        entries = _entries(index, at[i : i + SLICE], often[i : i + SLICE])[1]
        total += np.bincount(index.entry_item[entries], minlength=len(total))
    enough = total >= index.bound
    if not enough.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    step = index.budget + 1
    held = []
    for i in range(0, len(at), SLICE):
        which, entries = _entries(index, at[i : i + SLICE], often[i : i + SLICE])
        kept = enough[index.entry_item[entries]]
        which, entries = which[kept], entries[kept]
        item, place = index.entry_item[entries], index.entry_place[entries]
        band = (passed[i : i + SLICE][which] - place) // step[item]
        # a q-gram of the item counts once in a band, however often the document repeats it
        seen = np.stack([np.tile(item, 2), np.concatenate([band, band - 1]), np.tile(place, 2)])
        held.append(_distinct(seen))
    found = _distinct(np.concatenate(held, axis=1))
    new = np.flatnonzero(np.append(True, (np.diff(found[:2], axis=1) != 0).any(axis=0)))
    n = np.diff(np.append(new, found.shape[1]))
    item, band = found[0][new], found[1][new]
    full = n >= index.bound[item]
    return item[full], band[full]


def _distinct(columns: np.ndarray) -> np.ndarray:
    """The different columns, in order of the first row, then the second, then the third."""
    ordered = columns[:, np.lexsort(columns[::-1])]
    kept = np.append(True, (np.diff(ordered, axis=1) != 0).any(axis=0)) if ordered.shape[1] else []
    return ordered[:, kept] if ordered.shape[1] else ordered


def _entries(index: Index, at: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each lookup its entries: which lookup, which entry."""
    which = np.repeat(np.arange(len(at)), often)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(often) - often, often)
    return which, index.first[at][which] + offset


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int, free_start: bool = True) -> tuple[int, int]:
    """Fewest edits that turn the item into a stretch of the text along diagonals ``low`` to ``high``, and where it ends.

    The stretch starts anywhere on these diagonals, or at 0 unless ``free_start``.  Ends early, with some number over ``most``, once
    no fewer edits are possible.
    """
    far = 1 << 20
    diagonals = np.arange(low, high + 1)
    steps = np.arange(len(diagonals))
    edits = np.where((diagonals >= 0) & (diagonals <= len(text)), 0 if free_start else np.abs(diagonals), far)
    for i, c in enumerate(item):
        at = i + diagonals  # the place in the text that is compared
        inside = (at >= 0) & (at < len(text))
        same = inside & (text[np.clip(at, 0, max(0, len(text) - 1))] == c) if len(text) else inside
        new = np.where(inside, edits + ~same, far)
        new[:-1] = np.minimum(new[:-1], edits[1:] + 1)
        new[(at + 1 < 0) | (at + 1 > len(text))] = far
        edits = np.minimum(np.minimum.accumulate(new - steps) + steps, far)
        if i % 8 == 7 and edits.min() > most:
            break
    best = int(np.argmin(edits))
    return int(edits[best]), len(item) + int(diagonals[best])


def _exact(item: np.ndarray, text: np.ndarray) -> int | None:
    """The first place where the item stands in the text unchanged."""
    needle, hay, at = item.astype("<u4").tobytes(), text.astype("<u4").tobytes(), 0
    while (at := hay.find(needle, at)) >= 0:
        if at % 4 == 0:
            return at // 4
        at += 1
    return None


def _short_leaks(points: np.ndarray, places: np.ndarray, index: Index) -> Iterator[dict]:
    """Items of fewer than q characters, word for word; of overlapping places of one item the first."""
    words = _words(points)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    after: dict[tuple[str, ...], int] = {}
    for size in sorted({len(key) for key in index.short}):
        for at, key in enumerate(zip(*(words[i:] for i in range(size)), strict=False)):
            if key in index.short and at >= after.get(key, 0):
                after[key] = at + size
                start, end = int(ends[at]) - len(words[at]), int(ends[at + size - 1])
                for item_id in index.short[key]:
                    yield {"item_id": item_id, "start": int(places[start]), "end": int(places[end - 1]) + 1, "edits": 0}


def leaks_of(text: str | None, index: Index) -> list[dict]:
    """Regions of a text within the edit budget of an item: item_id, start, end, edits; start and end count the text's characters."""
    if not text:
        return []
    points, places = fold(text)
    found: dict[tuple[int | None, int | None, int], dict] = {}
    for item, band in zip(*_band_counts(points, index), strict=True):
        pattern, k = index.items[item], int(index.budget[item])
        low, high = int(band) * (k + 1) - k, (int(band) + 2) * (k + 1) + k
        begin = max(0, low)
        part = points[begin : max(0, high) + len(pattern) + k]
        whole = _exact(pattern, part)
        if whole is not None:
            edits, end, length = 0, whole + len(pattern), len(pattern)
        else:
            edits, end = align(pattern, part, low - begin, high - begin, k)
            if edits > k or end <= 0:
                continue
            behind = part[:end][::-1][: len(pattern) + k]
            length = align(pattern[::-1], behind, -k, k, k, free_start=False)[1]
        start = begin + end - length
        last = begin + end - 1
        item_id = index.ids[item]
        span = {"item_id": item_id, "start": int(places[start]), "end": int(places[last]) + 1, "edits": edits}
        # items without an id are told apart by their place in the index
        key = (item_id, int(item) if item_id is None else None, start // max(1, len(pattern) // 2))
        if key not in found or edits < found[key]["edits"]:
            found[key] = span
    spans = list(found.values())
    if index.short and len(points):
        spans += _short_leaks(points, places, index)
    return sorted(spans, key=lambda s: (s["start"], s["item_id"] is not None, s["item_id"] or 0))


def _scanned(batches: Iterator[pa.RecordBatch], index: Index, text: int, spans: int) -> Iterator[pa.RecordBatch]:
    """Append the leaks of one block of items to the spans of each row."""
    for batch in batches:
        before = batch.column(spans).to_pylist()
        now = [b + leaks_of(t, index) for b, t in zip(before, batch.column(text).to_pylist(), strict=True)]
        columns = [pa.array(now, pa.list_(SPAN)) if i == spans else c for i, c in enumerate(batch.columns)]
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def _passes(
    rows: DataFrame, text: str, benchmark: DataFrame, item_col: str, item_text_col: str, q: int, error: float
) -> list[Callable[[], DataFrame]]:
    """For each block of items, what makes ``rows`` (names all different) and a last column ``spans`` with its leaks.

    An index lives as long as the result of its pass; a pass whose result is written before the next is made is alone.
    """
    ready(rows.sparkSession)
    items = pick(benchmark, item_id=item_col, text=item_text_col).where("text is not null").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    told = rows.withColumn("spans", F.expr(f"cast(array() as {SPANS})"))

    def searched(block: int) -> DataFrame:
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        index = index_of([(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()], q, error)
        if index is None:
            return told
        scan = partial(_scanned, index=index, text=told.columns.index(text), spans=len(told.columns) - 1)
        return told.mapInArrow(scan, kind_of(told))

    return [partial(searched, block) for block in range(blocks)]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    q: int = Q,
    error: float = ERROR,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per leak: doc_id, item_id, start and end (characters of the text), edits; documents without leaks have none.

    Null and empty texts hold no leak; repeated rows of a document repeat its leaks; repeated items count once; an item
    without an id is searched like others and its leaks have a null ``item_id``; an item of fewer than ``q`` letters, digits and spaces
    between them leaks where its words stand unchanged, one without any nowhere; of overlapping regions of one item the best stays.  Other
    columns are ignored; an empty table of either kind gives no rows.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    passes = _passes(rows, "text", benchmark, item_col, item_text_col, q, error)
    if len(passes) == 1:
        return passes[0]().select("doc_id", F.inline("spans"))
    return reduce(DataFrame.unionAll, [stored(searched().select("doc_id", F.inline("spans")), "leaks") for searched in passes])


def remove_leaking(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    q: int = Q,
    error: float = ERROR,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose text holds no leak (see ``find_leaks``), with all their columns.

    Null and empty texts stay, and so do all rows if there are no items; repeated rows stay or go together.
    """
    flat = numbered(docs)
    text = f"c{docs.columns.index(text_col)}"
    passes = _passes(flat, text, benchmark, item_col, item_text_col, q, error)
    if len(passes) == 1:
        return passes[0]().where(F.size("spans") == 0).drop("spans").toDF(*docs.columns)
    # a row goes for its text alone, so the hash of the text stands for it
    told = F.sha2(text, 256).alias("told")
    leaking = [stored(searched().where(F.size("spans") > 0).select(told).distinct(), "leaking") for searched in passes]
    kept = flat.select("*", told).join(reduce(DataFrame.unionAll, leaking).distinct(), "told", "left_anti")
    return kept.select(*flat.columns).toDF(*docs.columns)
