"""Alignment of two tokenizers' tokens, and how often their ids meet in the corpus.

Both tokenizers encode the whole text.  A place where a token of each ends and the next token of each begins with a space is an
anchor, once the tokens' bytes have been verified to spell the text: there a document splits into windows, one word each as a rule, and a
window's alignment depends on its two tuples of ids alone.  So each different window of a block is aligned once, all of them
together, and every other occurrence takes what is remembered for its ids.

Documents are dealt into blocks.  A block asks for each of its different id pairs once, with the number of its documents that
link it; Spark adds these up over all blocks, finds each left id's highest count, and sends both back to the blocks that asked.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.idfiles import Encoder
from tillwork.llm.packing import pack, unpack
from tillwork.llm.pieces import LONGEST_KEPT, SPACE, MergeModel
from tillwork.llm.shared import documents, ready, stored, texts

#: Left tokens of a block, about; a longer document is a block of its own.
BLOCK_TOKENS = 400_000
#: Words whose ids a Python worker keeps; the half that is older goes when there are more.
KEPT_WORDS = 400_000


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level token stands for: printable Latin-1 letters for themselves, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Words(MergeModel):
    """A SentencePiece model that keeps the ids of words, and has its library encode new ones together."""

    def words_of(self, text: str) -> list[str] | None:
        """A text as words, each behind a space or a line end; None where runs of spaces reach from word to word."""
        string = self.library.normalize(text)
        if SPACE + SPACE in string or not self.lines_apart or string[:1] != SPACE:
            return None
        words: list[str] = []
        for number, line in enumerate(string.split("\n")):
            if line[-1:] == SPACE:
                return None
            here = line.split(SPACE)
            if number:
                here[0] = "\n" + here[0]
            words += here if number else here[1:]
        return words

    def encode_all(self, some: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; none without a text."""
        split = [self.words_of(text) if text else [] for text in some]
        whole = {i: self.encode(some[i]) for i, words in enumerate(split) if words is None}
        split = [words or [] for words in split]
        new = set().union(*split).difference(self.newer)
        self._keep(new)
        get = self.newer.__getitem__
        found = [whole.get(i) or b"".join(map(get, words)) for i, words in enumerate(split)]
        for word in new:
            if len(word) > LONGEST_KEPT:
                del self.newer[word]
        return found

    def _keep(self, words: set[str]) -> None:
        missing = []
        for word in words:
            known = self.older.get(word)
            if known is None:
                missing.append(word)
            else:
                self.newer[word] = known
        for word, ids in zip(missing, self.library.encode(missing, num_threads=1) if missing else [], strict=True):
            # the library puts a space before a line end, and no piece joins the two
            self.newer[word] = array("I", ids[1:] if word[0] == "\n" else ids).tobytes()


class Tokenizers:
    """A byte-level tokenizer (left) and a SentencePiece model (right), with the bytes that their tokens spell."""

    def __init__(self, byte_level: str, pieces: str):
        self.left, self.right = Encoder(byte_level), Words(pieces)
        library = self.left.library
        library.encode_special_tokens = True  # their strings are plain text
        letters, special = byte_letters(), library.get_added_tokens_decoder()
        left = [b""] * library.get_vocab_size()
        for token, i in library.get_vocab().items():
            left[i] = token.encode() if i in special else bytes(letters[c] for c in token)
        right = [p.replace("▁", " ").encode() for p in self.right.pieces]
        for b, i in self.right.bytes.items():
            right[i] = bytes([b])
        self.size = tuple(np.array([len(b) for b in told]) for told in (left, right))
        self.marked = tuple(np.array([b[:1] == b" " for b in told]) for told in (left, right))
        # all tokens' bytes behind one another, and where each token's begin
        self.bytes = tuple(np.frombuffer(b"".join(told), np.uint8) for told in (left, right))
        self.first = tuple(np.cumsum(size) - size for size in self.size)

        # all ids as decimals, a mark behind each
        told = [str(i) for i in range(max(len(left), len(right)))]
        size = np.array([len(t) for t in told])
        self.decimals = np.frombuffer(" ".join([*told, ""]).encode(), np.uint8), np.cumsum(size + 1) - size - 1, size

    def encode(self, some: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of each text; None without a text."""
        for words in (self.left, self.right):
            if len(words.newer) >= KEPT_WORDS // 2:
                words.older, words.newer = words.newer, {}
        left = self.left.encode([" " + text if text else None for text in some])
        right = self.right.encode_all(some)
        return [
            (np.frombuffer(a, "<u4")[:-1], np.frombuffer(b, "<u4")) if text else None
            for text, a, b in zip(some, left, right, strict=True)
        ]

    def verified(self, some: list[str], ids: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Of each text whether the bytes of its tokens, left and right, are a space and the text."""
        wanted = [b" " + text.encode() for text in some]
        lengths = np.array([len(w) for w in wanted], np.int64)
        sound = np.ones(len(some), bool)
        for side, (size, first, told) in enumerate(zip(self.size, self.first, self.bytes, strict=True)):
            flat = np.concatenate([pair[side] for pair in ids])
            ends = np.cumsum([len(pair[side]) for pair in ids])
            spelled = np.append(0, np.cumsum(size[flat]))[ends]
            sound &= np.diff(spelled, prepend=0) == lengths
            if not sound.all():
                some_left = np.flatnonzero(sound)
                if len(some_left):
                    kept = self.verified([some[i] for i in some_left], [ids[i] for i in some_left])
                    sound[some_left] = kept
                return sound
            here = told[_spread(first[flat], size[flat])] == np.frombuffer(b"".join(wanted), np.uint8)
            if not here.all():
                sound &= np.logical_and.reduceat(here, np.cumsum(lengths) - lengths)
                some_left = np.flatnonzero(sound)
                if len(some_left):
                    sound[some_left] = self.verified([some[i] for i in some_left], [ids[i] for i in some_left])
                return sound
        return sound


_tokenizers: dict[tuple[str, str], Tokenizers] = {}


def tokenizers_at(byte_level: str, pieces: str) -> Tokenizers:
    """The two tokenizers, read once in each Python worker."""
    key = (byte_level, pieces)
    if key not in _tokenizers:
        _tokenizers[key] = Tokenizers(*key)
    return _tokenizers[key]


# -- blocks ---------------------------------------------------------------------------------------------


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each range, one range after another."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _different(numbers: np.ndarray) -> np.ndarray:
    """The different numbers, ascending; sorting them is faster than hashing."""
    ordered = np.sort(numbers)
    return ordered[np.append(True, ordered[1:] != ordered[:-1])] if len(ordered) else ordered


class Cut:
    """Tokens of some documents that both tokenizers spell, cut at anchors into windows."""

    def __init__(self, some: list[tuple[np.ndarray, np.ndarray]], both: Tokenizers):
        self.both = both
        ids = [np.concatenate([pair[side] for pair in some]).astype(np.int64) for side in (0, 1)]
        ends = [np.cumsum(size[i]) for size, i in zip(both.size, ids, strict=True)]
        at = np.searchsorted(ends[1], ends[0])
        shared = np.flatnonzero(ends[1][at] == ends[0])
        beside = at[shared]
        # documents end where both do, and the last of them ends everything
        last = np.zeros(len(ids[0]), bool)
        last[np.cumsum([len(a) for a, _ in some]) - 1] = True
        finish = last[shared]
        after = [np.append(mark[i], True) for mark, i in zip(both.marked, ids, strict=True)]
        window = finish | (after[0][shared + 1] & after[1][beside + 1])
        self.ids = ids
        self.ends = [shared[window] + 1, beside[window] + 1]
        self.starts = [np.append(0, e[:-1]) for e in self.ends]
        self.sizes = [e - s for e, s in zip(self.ends, self.starts, strict=True)]
        self.finish = np.flatnonzero(finish[window]) + 1  # windows up to each document's end
        self.groups = np.diff(np.flatnonzero(finish) + 1, prepend=0)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The first window of each different pair of id tuples, and which of them each window is."""
        mixed = self.sizes[0].astype(np.uint64)
        for ids, starts, size, odd in zip(self.ids, self.starts, self.sizes, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), strict=True):
            within = (np.arange(len(ids)) - np.repeat(starts, size)).astype(np.uint64)
            salted = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(odd) + within * np.uint64(0x165667B19E3779F9)
            salted = (salted ^ (salted >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            mixed = mixed * np.uint64(odd) + np.add.reduceat(salted ^ (salted >> np.uint64(29)), starts)
        _, first, number = np.unique(mixed, return_index=True, return_inverse=True)
        if not self._alike(first[number]):  # equal hashes of different windows
            places: dict[tuple[bytes, bytes], int] = {}
            keys = zip(*([i[a:b].tobytes() for a, b in zip(s.tolist(), e.tolist(), strict=True)] for i, s, e in zip(self.ids, self.starts, self.ends, strict=True)), strict=True)
            number = np.array([places.setdefault(key, len(places)) for key in keys])
            first = np.unique(number, return_index=True)[1]
        return first, number

    def _alike(self, model: np.ndarray) -> bool:
        return all(
            (size == size[model]).all() and (ids == ids[_spread(starts[model], size)]).all()
            for ids, starts, size in zip(self.ids, self.starts, self.sizes, strict=True)
        )

    def align(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Of some windows: all links as pairs of ids, how many links each has, and each one's groups as text.

        The windows stand behind one another; each stretch between neighbouring ends belongs to one link.
        """
        sizes = [size[windows] for size in self.sizes]
        ids = [i[_spread(starts[windows], size)] for i, starts, size in zip(self.ids, self.starts, sizes, strict=True)]
        ends = [np.cumsum(size[i]) for size, i in zip(self.both.size, ids, strict=True)]
        every = _different(np.concatenate(ends))
        at = [np.searchsorted(e, every) for e in ends]
        links = ids[0][at[0]] << 32 | ids[1][at[1]]
        last = np.searchsorted(every, ends[0][np.cumsum(sizes[0]) - 1])
        shared = np.flatnonzero((ends[0][at[0]] == every) & (ends[1][at[1]] == every))
        # a group's left tokens, then its right ones
        ends = [i[shared] + 1 for i in at]
        counts = [np.diff(e, prepend=0) for e in ends]
        behind = [np.append(0, ends[1][:-1]), ends[0]]
        place = [np.arange(len(i)) + np.repeat(b, n) for i, b, n in zip(ids, behind, counts, strict=True)]
        told = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        mark = np.full(len(told), ord(","), np.uint8)
        for i, p in zip(ids, place, strict=True):
            told[p] = i
        mark[ends[0] + behind[0] - 1] = ord("|")
        mark[ends[0] + ends[1] - 1] = ord(";")
        digits, first, size = self.both.decimals
        width = size[told] + 1
        close = np.cumsum(width)
        spelled = digits[_spread(first[told], width)]
        spelled[close - 1] = mark
        # a window ends with a group, whose mark is left out
        cuts = close[(ends[0] + ends[1])[np.searchsorted(shared, last)] - 1].tolist()
        text = spelled.tobytes().decode("ascii")
        return links, np.diff(last + 1, prepend=0), [text[a : b - 1] for a, b in zip([0, *cuts], cuts, strict=False)]


def _close(block: int, rows: list[tuple[int | None, str, tuple[np.ndarray, np.ndarray] | None]], both: Tokenizers) -> pa.RecordBatch:
    """One row for a block: its documents' numbers, their windows, and the pairs that they link."""
    there = np.array([ids is not None for *_, ids in rows])
    if there.any():
        there[there] = both.verified([text for _, text, ids in rows if ids is not None], [ids for *_, ids in rows if ids is not None])
    some = [ids for (*_, ids), kept in zip(rows, there.tolist(), strict=True) if kept]
    n_a, n_b, n_groups, sizes = (np.zeros(len(rows), np.int64) for _ in range(4))
    digests = [""] * len(rows)
    told = links = widths = np.zeros(0, np.int64)
    if some:
        cut = Cut(some, both)
        first, told = cut.distinct()
        links, widths, written = cut.align(first)
        written = np.array(written, object)[told]
        for i, a, b in zip(np.flatnonzero(there).tolist(), [0, *cut.finish.tolist()], cut.finish.tolist(), strict=False):
            digests[i] = hashlib.sha256(";".join(written[a:b]).encode()).hexdigest()
        n_a[there], n_b[there] = [len(a) for a, _ in some], [len(b) for _, b in some]
        n_groups[there], sizes[there] = cut.groups, np.diff(cut.finish, prepend=0)
    pairs, place = np.unique(links, return_inverse=True)
    # documents of each pair: a document's windows once each, then their pairs once each
    width = len(widths) or 1
    seen = _different(np.repeat(np.arange(len(sizes)), sizes) * width + told)
    document, window = np.divmod(seen, width)
    spread = widths[window] if len(widths) else window
    linked = place[_spread((np.cumsum(widths) - widths)[window], spread)] if len(widths) else window
    here = _different(np.repeat(document, spread) + linked * len(rows))
    row = {
        "block": block,
        "doc_ids": [doc_id for doc_id, *_ in rows],
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": n_groups,
        "digests": digests,
        "sizes": pack(sizes),
        "told": pack(told),
        "widths": pack(widths),
        "links": pack(place),
        "pairs": pairs,
        "n_docs": np.bincount(here // len(rows), minlength=len(pairs)),
    }
    return pa.RecordBatch.from_pylist([row], _BLOCK_SCHEMA)


_LONGS = pa.list_(pa.int64())
_BLOCK_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        *((name, _LONGS) for name in ("doc_ids", "n_a", "n_b", "n_groups")),
        ("digests", pa.list_(pa.string())),
        *((name, pa.binary()) for name in ("sizes", "told", "widths", "links")),
        ("pairs", _LONGS),
        ("n_docs", _LONGS),
    ]
)
_BLOCK_KIND = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, digests array<string>, "
    "sizes binary, told binary, widths binary, links binary, pairs array<long>, n_docs array<long>"
)


def _blocks(batches: Iterator[pa.RecordBatch], byte_level: str, pieces: str, block_tokens: int) -> Iterator[pa.RecordBatch]:
    both, partition, number, held = tokenizers_at(byte_level, pieces), TaskContext.get().partitionId(), 0, 0
    rows: list[tuple[int | None, str, tuple[np.ndarray, np.ndarray] | None]] = []
    for batch in batches:
        some = texts(batch)
        for doc_id, text, ids in zip(batch.column(0).to_pylist(), some, both.encode(some), strict=True):
            size = 0 if ids is None else len(ids[0])
            if held and held + size > block_tokens:
                yield _close(partition << 32 | number, rows, both)
                rows, number, held = [], number + 1, 0
            rows.append((doc_id, text, ids))
            held += size
    if rows:
        yield _close(partition << 32 | number, rows, both)


_KIND = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _weighed(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums over the links of each document of a block, given the counts of its pairs."""
    row = left.to_pylist()[0]
    order = np.argsort(right.column("pair").to_numpy())
    count = right.column("n").to_numpy()[order]
    best = right.column("best").to_numpy()[order].astype(np.int64)
    sizes, widths = (unpack(row[name]).astype(np.int64) for name in ("sizes", "widths"))
    told, links = (unpack(row[name]).astype(np.int64) for name in ("told", "links"))

    def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        ends = np.cumsum(sizes)
        running = np.append(0, np.cumsum(values))
        return running[ends] - running[ends - sizes]

    n_a, n_b, n_groups = (np.array(row[name]) for name in ("n_a", "n_b", "n_groups"))
    return pa.table(
        {
            "doc_id": pa.array(row["doc_ids"], pa.int64()),
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": n_groups,
            "n_links": sums(sums(np.ones(len(links), np.int64), widths)[told], sizes),
            "n_best": sums(sums(best[links], widths)[told], sizes),
            "count_sum": sums(sums(count[links], widths)[told], sizes),
            "groups_sha256": row["digests"],
        }
    )


def aligned_blocks(
    docs: DataFrame, byte_level: str, pieces: str, *, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """Blocks of documents with their windows, links and different pairs, written to the shared folder."""
    ready(docs.sparkSession)
    block = partial(_blocks, byte_level=byte_level, pieces=pieces, block_tokens=block_tokens)
    return stored(documents(docs, id_col, text_col).mapInArrow(block, _BLOCK_KIND), "aligned")


def _asked(blocks: DataFrame) -> DataFrame:
    zipped = F.arrays_zip(F.col("pairs").alias("pair"), F.col("n_docs").alias("n"))
    return blocks.select("block", F.explode(zipped).alias("asked")).select("block", "asked.pair", "asked.n")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair (left id * 2^32 + right id), n (documents that link it), best (whether no pair of the left id has more), once each."""
    counts = _asked(blocks).groupBy("pair").agg(F.sum("n").alias("n"))
    left = F.shiftright("pair", 32).alias("a")
    highest = counts.groupBy(left).agg(F.max("n").alias("most"))
    return counts.withColumn("a", left).join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, byte_level: str, pieces: str, **settings) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A null or empty text, and one whose tokens do not spell a space and the text, has no tokens: zeros and an empty digest.
    Repeated rows and rows without an id are documents of their own, in the counts too; other columns are ignored; an empty
    table has no rows.
    """
    blocks = aligned_blocks(docs, byte_level, pieces, **settings)
    answers = _asked(blocks).select(F.col("block").alias("asker"), "pair").join(pair_counts(blocks), "pair")
    kept = blocks.drop("pairs", "n_docs")
    return kept.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(_weighed, _KIND)
