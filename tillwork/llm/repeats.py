"""Removal of repeated passages: every window of some consecutive words stays only where it starts first.

Windows are compared by compressed FM-indexes, one for each shard of the text that can repeat at all:

1. Of the short word sequences within a window the one of smallest hash is its anchor.  Equal windows have equal anchors,
   so a window whose anchor occurs once in the corpus is unique; only the places of such single anchors go back to their documents.
2. Neighbouring windows that share an anchor are a run.  Equal runs, such as those of copied documents, are
   reduced to the first one before any text is moved.
3. The first runs are dealt to shards by anchor.  Each shard builds an FM-index of its runs and streams them through it: backward
   search gives the matching statistics, windows that reach the threshold are located, and the earliest place of each is told.
   Runs of an anchor that has very many different ones are cut into windows first, which are dealt by their own hash.
4. A window with a repeated anchor that is not told as earliest is removed, with the words it covers.

Texts are shuffled once (all uses read the same shuffle); everything else that moves is hashes and places.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.fm_index import FMIndex, encode
from tillwork.llm.shared import documents, ready

WINDOW = 20
#: Words of an anchor.
GRAM = 8
#: Different runs of one anchor beyond which they are cut into windows.
GROUP_RUNS = 4000
#: Words of a shard's index, about; a shard ends where an anchor does.
SHARD_WORDS = 400_000
#: Bytes of texts whose words are hashed together, about.
CHUNK = 1 << 20
#: Bytes of a word beyond which it is hashed by itself.
LONG = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACES = bytes.maketrans(b"\t\n\v\f\r", b"     ")
#: The lowest bytes of a number, by how many.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def joined(text: bytes | None) -> bytes:
    """The words between ASCII spaces and line ends, joined by a space."""
    told = text.translate(_SPACES).strip(b" ") if text else b""
    return b" ".join(told.split()) if b"  " in told else told


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word of ``data``, behind which eight more bytes stand; long words alone are hashed one by one."""
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    left = ends - starts
    hashed = (eights[starts] & _MASKS[np.minimum(left, 8)]) * _ODD
    hashed ^= hashed >> np.uint64(32)
    more = np.flatnonzero(left > 8)
    for at in range(8, LONG, 8):
        told = hashed[more] ^ (eights[starts[more] + at] & _MASKS[np.minimum(left[more] - at, 8)])
        told *= _ODD
        hashed[more] = told ^ (told >> np.uint64(32))
        more = more[left[more] > at + 8]
    for i in more.tolist():
        hashed[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]])
    return hashed * _ODD


def gram_hashes(hashed: np.ndarray, gram: int) -> np.ndarray:
    """The hash of the words of each gram."""
    n = max(0, len(hashed) - gram + 1)
    rolled = np.zeros(n, np.uint64)
    for i in range(gram):
        rolled *= np.uint64(0x100000001B3)
        rolled += hashed[i : i + n]
    rolled = (rolled ^ (rolled >> np.uint64(31))) * _ODD
    return rolled ^ (rolled >> np.uint64(29))


def least_places(values: np.ndarray, size: int) -> np.ndarray:
    """Of each stretch of ``size`` values the place of the least, the first of equal ones; stretches double until they have that size."""
    places, width = np.arange(len(values)), 1
    while width < size:
        ahead = min(width, size - width)
        here, there = places[: len(places) - ahead], places[ahead:]
        places = np.where(values[here] <= values[there], here, there)
        width += ahead
    return places


class Words:
    """The words of some texts, numbered through all of them, and the anchors of the windows, none of which crosses two texts."""

    def __init__(self, told: list[bytes], window: int, gram: int):
        self.data = b"".join([*(t + b" " for t in told if t), bytes(8)])
        self.ends = np.flatnonzero(np.frombuffer(self.data, np.uint8) == 32)
        self.starts = np.append(0, self.ends + 1)[:-1]
        self.sizes = np.array([t.count(b" ") + 1 if t else 0 for t in told], np.int64)
        #: Number of the first word of each text, and of all words.
        self.first = np.append(0, np.cumsum(self.sizes))
        self.counts = np.maximum(self.sizes - window + 1, 0)
        before = np.cumsum(self.counts) - self.counts
        #: First word of each window.
        self.windows = np.arange(self.counts.sum()) + np.repeat(self.first[:-1] - before, self.counts)
        self.grams = gram_hashes(word_hashes(self.data, self.starts, self.ends), gram)
        self.at = least_places(self.grams, window - gram + 1)[self.windows]
        #: First and last window of each run, by their first words, and its anchor.
        begins = np.flatnonzero(np.append(True, np.diff(self.at) != 0))[: len(self.at)]
        last = np.append(begins[1:], len(self.at))[: len(begins)] - 1
        self.begins, self.last, self.anchors = self.windows[begins], self.windows[last], self.at[begins]

    def text_of(self, places: np.ndarray) -> np.ndarray:
        """The text that each word belongs to."""
        return np.searchsorted(self.first, places, side="right") - 1

    def between(self, start: int, end: int) -> bytes:
        return self.data[self.starts[start] : self.ends[end - 1]]

    def flags(self, places: pa.Array) -> np.ndarray:
        """A mark at each of some places, listed by text; places beyond the end belong to another text under the same id."""
        owner, told = _listed(places)
        told = told.to_numpy(zero_copy_only=False).astype(np.int64)
        inside = told < self.sizes[owner]
        marked = np.zeros(self.first[-1], bool)
        marked[self.first[owner[inside]] + told[inside]] = True
        return marked


def _listed(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of each item of a column of lists, and the items."""
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), sizes), column.flatten()


def _read(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Rows with their words, some ``CHUNK`` bytes of texts at a time."""
    for batch in batches:
        told = [joined(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        start, held = 0, 0
        for i, text in enumerate(told, 1):
            held += len(text)
            if held >= CHUNK or i == len(told):
                yield batch.slice(start, i - start), Words(told[start:i], window, gram)
                start, held = i, 0


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _longs(values, signed: bool = True) -> pa.Array:
    found = np.asarray(values, np.uint64).view(np.int64) if not signed else np.asarray(values, np.int64)
    return pa.array(found, pa.int64())


def _anchor_counts(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Each anchor of some documents, how often it occurs there, and one place."""
    for batch, words in _read(batches, window, gram):
        found, where, n = np.unique(words.grams[words.anchors], return_index=True, return_counts=True)
        places = words.anchors[where]
        owner = words.text_of(places)
        yield pa.RecordBatch.from_arrays(
            [_longs(found, False), _longs(n), _longs(_ids(batch)[owner]), _longs(places - words.first[owner])],
            ["anchor", "n", "doc_id", "place"],
        )


def _columns(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def _run_hashes(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Anchor and 128-bit hash of the words of each run that may repeat; within a document the first of equal runs."""
    for batch, words in _read(batches, window, gram):
        several = np.flatnonzero(~words.flags(batch.column("single"))[words.anchors])
        begins = words.begins[several]
        owner = words.text_of(begins)
        spans = zip(words.starts[begins].tolist(), words.ends[words.last[several] + window - 1].tolist(), owner.tolist(), strict=True)
        data, digests, seen, first = words.data, [], {}, []
        for i, (a, b, text) in enumerate(spans):
            digest = xxhash.xxh3_128_digest(data[a:b])
            if seen.get(digest) != text:
                seen[digest] = text
                digests.append(digest)
                first.append(i)
        first = np.array(first, np.int64)
        halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        owner = owner[first]
        yield pa.RecordBatch.from_arrays(
            [
                _longs(words.grams[words.anchors[several[first]]], False), _longs(halves[:, 0]), _longs(halves[:, 1]),
                _longs(_ids(batch)[owner]), _longs(begins[first] - words.first[owner]),
            ],
            ["anchor", "h1", "h2", "doc_id", "start"],
        )


def _first_runs(batches: Iterator[pa.RecordBatch], window: int, gram: int, cut: bool) -> Iterator[pa.RecordBatch]:
    """The words of the first runs, whole or window by window."""
    for batch, words in _read(batches, window, gram):
        # a place where no run starts is one of another text under the same id
        first = np.flatnonzero(words.flags(batch.column("first"))[words.begins])
        begins, sizes = words.begins[first], words.last[first] - words.begins[first] + 1
        ends = words.last[first] + window
        keys = words.grams[words.anchors[first]]
        if cut:
            before = np.cumsum(sizes) - sizes
            begins, keys = np.arange(sizes.sum()) + np.repeat(begins - before, sizes), np.repeat(keys, sizes)
            ends = begins + window
        owner = words.text_of(begins)
        spans = zip(words.starts[begins].tolist(), words.ends[ends - 1].tolist(), strict=True)
        yield pa.RecordBatch.from_arrays(
            [
                _longs(keys, False), _longs(_ids(batch)[owner]), _longs(begins - words.first[owner]),
                _strings([words.data[a:b] for a, b in spans]),
            ],
            ["shard", "doc_id", "start", "words"],
        )


def _searched(rows: list[tuple[int, int, str]], window: int) -> pa.RecordBatch:
    """Of the runs of one shard, in order of their places, the windows that start first: a bit for each."""
    sequences = [words.split(" ") for _, _, words in rows]
    text, starts, size = encode(sequences)
    counts = np.array([len(s) - window + 1 for s in sequences])
    offsets = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    windows = np.repeat(starts, counts) + offsets
    own = FMIndex(text, starts, size).first_places(text, windows, window) == windows
    masks = np.add.reduceat(np.where(own, np.int64(1) << offsets, 0), np.cumsum(counts) - counts)
    kept = np.flatnonzero(masks)
    return pa.RecordBatch.from_arrays(
        [_longs([rows[i][0] for i in kept]), _longs([rows[i][1] for i in kept]), _longs(masks[kept])],
        ["doc_id", "start", "mask"],
    )


def _shards(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Cut a partition that is sorted by shard, doc_id and start into indexes of bounded size."""
    rows: list[tuple[int, int, str]] = []
    held, before = 0, None
    for batch in batches:
        for shard, doc_id, start, words in _columns(batch, "shard", "doc_id", "start", "words"):
            if held >= SHARD_WORDS and shard != before:
                yield _searched(rows, window)
                rows, held = [], 0
            rows.append((doc_id, start, words))
            held += words.count(" ") + 2
            before = shard
    if rows:
        yield _searched(rows, window)


def _kept(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch, words in _read(batches, window, gram):
        owner, firsts = _listed(batch.column("firsts"))
        starts, masks = (firsts.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "mask"))
        own = np.zeros(words.first[-1], bool)
        for i in range(window - gram + 1):
            told = (masks >> i & 1 > 0) & (starts + i < words.counts[owner])
            own[words.first[owner[told]] + starts[told] + i] = True
        single = words.flags(batch.column("single"))
        repeated = words.windows[~single[words.at] & ~own[words.windows]]
        edges = np.zeros(words.first[-1] + 1, np.int64)
        edges[repeated] += 1
        edges[repeated + window] -= 1
        gone = np.cumsum(edges[:-1]) > 0
        removed = np.append(0, np.cumsum(gone))[words.first]
        # spans end with their text
        inner = words.first[words.first < len(gone)]
        begins, ends = np.append(True, ~gone[:-1])[: len(gone)], np.append(~gone[1:], True)[: len(gone)]
        begins[inner], ends[inner - 1] = True, True
        begins, ends = np.flatnonzero(gone & begins), np.flatnonzero(gone & ends) + 1
        owner = words.text_of(begins)
        before = np.searchsorted(owner, np.arange(len(words.sizes) + 1))
        base = words.first[owner]
        spans = pa.StructArray.from_arrays([_longs(begins - base), _longs(ends - base)], ["start", "end"])
        kept = []
        for i, (first, n) in enumerate(zip(words.first[:-1].tolist(), words.sizes.tolist(), strict=True)):
            a, b = before[i], before[i + 1]
            edge = [first, *np.stack([begins[a:b], ends[a:b]], axis=1).ravel().tolist(), first + n] if a < b else [first, first + n]
            kept.append(b" ".join([words.between(x, y) for x, y in zip(edge[::2], edge[1::2], strict=True) if x < y]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("given_id"), _longs(words.sizes), _longs(np.diff(removed)), _strings(kept),
                pa.ListArray.from_arrays(pa.array(before, pa.int32()), spans),
            ],
            ["doc_id", "n_words", "n_removed", "kept", "spans"],
        )


def remove_repeats(
    docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept (the other words, joined by a space), spans (removed words, by place).

    A word goes if some window of ``window`` consecutive words that covers it also starts earlier: in a document of smaller id, or
    further forward in the same one; windows are those of the input.  Null and empty texts have no words; documents shorter than
    a window lose none.  doc_id should identify a text: rows that repeat both get the result of one, rows with
    one id and different texts are each treated with the marks of all of them.  A row without an id stands for its text: a hash of that
    takes the place of its id, among the largest, so that rows without an id and different texts are documents of their own.  Other
    columns are ignored; an empty table has no rows.
    """
    if not 0 < gram <= window <= 32:
        raise ValueError("an anchor fits in a window, and a window has 32 words at most")
    ready(docs.sparkSession)
    sizes = {"window": window, "gram": gram}
    own_id = F.xxhash64("text", F.lit("no id")).bitwiseOR(F.lit(1 << 62)).bitwiseAND(F.lit((1 << 63) - 1))
    told = documents(docs, id_col, text_col).select(
        F.coalesce(F.col("doc_id").cast("long"), own_id).alias("doc_id"), "text", F.col("doc_id").cast("long").alias("given_id")
    )

    counted = told.select("doc_id", "text").mapInArrow(partial(_anchor_counts, **sizes), "anchor long, n long, doc_id long, place long")
    once = counted.groupBy("anchor").agg(F.sum("n").alias("n"), F.min("doc_id").alias("doc_id"), F.min("place").alias("place"))
    single = once.where("n = 1").groupBy("doc_id").agg(F.collect_list(F.col("place").cast("int")).alias("single"))
    marked = told.join(single, "doc_id", "left")

    hashed = marked.mapInArrow(partial(_run_hashes, **sizes), "anchor long, h1 long, h2 long, doc_id long, start long")
    # as one struct, so that every use below reads the same columns, and hence the same shuffle
    firsts_of = hashed.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "start", "anchor")).alias("at"))
    distinct = firsts_of.select("at.anchor", "at.doc_id", "at.start")
    crowded = distinct.groupBy("anchor").count().where(F.col("count") > GROUP_RUNS).withColumnRenamed("count", "crowd")
    noted = distinct.join(crowded, "anchor", "left")

    def words_at(places: DataFrame, cut: bool) -> DataFrame:
        first = places.groupBy("doc_id").agg(F.collect_list("start").alias("first"))
        read = partial(_first_runs, cut=cut, **sizes)
        return told.join(first, "doc_id").mapInArrow(read, "shard long, doc_id long, start long, words string")

    cut = words_at(noted.where("crowd is not null"), cut=True)
    cut = cut.groupBy("words").agg(F.min(F.struct("doc_id", "start")).alias("at"))
    cut = cut.select(F.xxhash64("words").alias("shard"), "at.doc_id", "at.start", "words")
    dealt = words_at(noted.where("crowd is null"), cut=False).unionByName(cut)
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "doc_id", "start")
    found = dealt.mapInArrow(partial(_shards, window=window), "doc_id long, start long, mask long")
    firsts = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "mask")).alias("firsts"))

    result = "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:long,end:long>>"
    return marked.join(firsts, "doc_id", "left").select("given_id", "text", "single", "firsts").mapInArrow(partial(_kept, **sizes), result)
