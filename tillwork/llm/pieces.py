"""SentencePiece merge-type encoding through a table of prefixes, and decoding.

In a merge-type (BPE) model the encoding of every prefix of a string has one last token.  The table keeps it:
an automaton over the pieces names those that end at a place; the one whose predecessor in the table
stays beside it when the two are encoded together is the last token there.  Walking the table
backwards from the end gives the ids.  Whether two tokens stay apart depends on these two alone and is
remembered, so no merge queue is kept.

No piece reaches from the end of a word into the next one, so texts are cut into words and the ids
of words are kept for reuse, up to a fixed number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tillwork.llm.shared import documents, pick, ready, texts

#: Words whose ids a Python worker keeps; the half that is older goes when there are more.
KEPT_WORDS = 600_000
LONGEST_KEPT = 64
#: Pairs of tokens whose compatibility a Python worker keeps.
KEPT_PAIRS = 400_000
SPACE = "▁"
HIDDEN = "\udc00"
ID = np.dtype("<i4")


class Pieces:
    """The pieces of a model, and the text that ids stand for."""

    def __init__(self, model_file: str):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.pieces = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if lib.is_byte(i)}
        self.hidden = hidden = {i for i in range(len(self.pieces)) if lib.is_control(i) or lib.is_unused(i) or lib.is_unknown(i)}
        # bytes over 127 and control ids stand as lone surrogates until their neighbours are known
        self.shown = [HIDDEN if i in hidden else p.replace(SPACE, " ") for i, p in enumerate(self.pieces)]
        self.shown[lib.unk_id()] = " \u2047 "
        for b, i in self.bytes.items():
            self.shown[i] = bytes([b]).decode("utf-8", "surrogateescape")

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces joined, without one space before all; bytes that are not UTF-8 become U+FFFD each."""
        text = "".join(map(self.shown.__getitem__, ids))
        if not text.isascii():
            try:
                text.encode()
            except UnicodeEncodeError:
                parts = [p.encode("utf-8", "surrogateescape") for p in text.split(HIDDEN)]
                text = "".join(p.decode("utf-8", "surrogateescape") for p in parts)
                text = re.sub("[\udc80-\udcff]", "\ufffd", text)
        first = next((i for i in ids if self.shown[i] != HIDDEN), None)
        return text[1:] if first is not None and self.pieces[first].startswith(SPACE) else text


class MergeModel(Pieces):
    """Ranks and the compatibility of neighbours in one merge-type model with byte fallback."""

    def __init__(self, model_file: str):
        super().__init__(model_file)
        lib, hidden = self.library, self.hidden
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in hidden and not lib.is_byte(i)}
        inner = [p for p in self.ids if SPACE in p.lstrip(SPACE) or re.match(f"{SPACE}{SPACE}+[^{SPACE}]", p)]
        if len(self.bytes) != 256 or inner:
            raise ValueError("only models with byte fallback and pieces within words are supported")
        self.rank = {p: -lib.get_score(i) for p, i in self.ids.items()}
        self._apart: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        self.halves: dict[str, list[str]] = {}  # what the last merge of a piece joined
        for piece, i in self.ids.items():
            if self._merged(list(piece)) == [piece]:  # else no encoding holds it
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        letters = "".join(re.escape(p) for p in sorted(self.ids) if len(p) == 1 and p != SPACE)
        self.words = re.compile(f"{SPACE}*[{letters}]+|{SPACE}+|[^{SPACE}{letters}]", re.DOTALL)
        self.known = re.compile(f"[{SPACE}{letters}]")
        self.lines_apart = "\n" not in self.ids and not any("\n" in p for p in self.ids)
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _merged(self, parts: list[str]) -> list[str]:
        """Join the best ranked neighbours, leftmost first, until none makes a piece (for short strings)."""
        while True:
            ranks = [self.rank.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
            best = min((r for r in ranks if r is not None), default=None)
            if best is None:
                return parts
            at = ranks.index(best)
            if len(parts) == 2:
                self.halves["".join(parts)] = parts
            parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]

    def apart(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay two tokens where they meet."""
        known = self._apart.get(left << 24 | right)
        if known is None:
            a, b = self.pieces[left], self.pieces[right]
            ranked_alike = a.endswith(SPACE) and b.startswith(SPACE)  # runs of spaces share one rank
            known = self._merged(list(a + b)) == [a, b] if ranked_alike else self._meets(a, b)
            if len(self._apart) >= KEPT_PAIRS:
                self._apart.clear()
            self._apart[left << 24 | right] = known
        return known

    def _meets(self, a: str, b: str) -> bool:
        """Undo the merges of both tokens, the latest first: no merge over their border may come before what is undone."""
        rank, halves, limit = self.rank, self.halves, float("inf")
        while True:
            over = rank.get(a + b)
            if over is not None and over < limit:
                return False
            if len(a) == len(b) == 1:
                return True
            if len(b) == 1 or len(a) > 1 and rank[a] > rank[b]:
                limit, a = rank[a], halves[a][1]
            else:  # of two equal merges the one further left comes first
                limit, b = rank[b] + 0.5, halves[b][0]

    def ids_of(self, word: str) -> list[int]:
        """Ids of a word of known characters, from its table of prefixes."""
        last: list[tuple[int, int] | None] = [None] * len(word)
        remembered = self._apart.get
        for end, (piece, length) in self.automaton.iter(word):
            if last[end] is not None:
                continue
            start = end - length
            if start < 0:
                last[end] = (piece, -1)
                continue
            left = last[start][0]
            apart = remembered(left << 24 | piece)
            if apart or apart is None and self.apart(left, piece):
                last[end] = (piece, start)
        ids, at = [], len(word) - 1
        while at >= 0:
            piece, at = last[at]
            ids.append(piece)
        return ids[::-1]

    def _spelled(self, string: str) -> bytes:
        """Ids of any normalised string as little-endian 32-bit integers."""
        ids: list[int] = []
        for word in self.words.findall(string):
            if self.known.match(word):
                ids += self.ids_of(word)
            else:  # a character that no piece has
                ids += [self.bytes[b] for b in word.encode("utf-8", "surrogatepass")]
        return np.array(ids, ID).tobytes()

    def word(self, word: str) -> bytes:
        """Ids of a space and ``word``, or of ``word`` alone if a line end opens it; kept for the next time."""
        spelled = self.older.get(word)
        if spelled is None:
            spelled = self._spelled(word if word[0] == "\n" else SPACE + word)
        if len(word) <= LONGEST_KEPT:
            self.newer[word] = spelled
        return spelled

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        if len(self.newer) >= KEPT_WORDS // 2:
            self.older, self.newer = self.newer, {}
        string = self.library.normalize(text)
        if SPACE + SPACE in string or not self.lines_apart or string[:1] != SPACE:
            return self._spelled(string)  # runs of spaces reach into the next word
        newer, slow, parts = self.newer.get, self.word, []
        for number, line in enumerate(string.split("\n")):
            if line[-1:] == SPACE:
                parts.append(self._spelled("\n" + line if number else line))
                continue
            words = line.split(SPACE)
            if number:
                words[0] = "\n" + words[0]
            else:
                del words[0]
            parts += [newer(word) or slow(word) for word in words]
        return b"".join(parts)


_models: dict[tuple[str, type], Pieces] = {}


def model_at(model_file: str, kind: type = MergeModel) -> Pieces:
    """The model, read once in each Python worker; those that only decode need no automaton."""
    key = (model_file, kind)
    if key not in _models:
        _models[key] = kind(model_file)
    return _models[key]


def _encoded(batches: Iterator[pa.RecordBatch], model_file: str) -> Iterator[pa.RecordBatch]:
    model = model_at(model_file)
    for batch in batches:
        spelled = [model.encode(text) if text else b"" for text in texts(batch)]
        ends = np.cumsum([0] + [len(s) // ID.itemsize for s in spelled])
        values = pa.array(np.frombuffer(b"".join(spelled), ID), pa.int32())
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], model_file: str) -> Iterator[pa.RecordBatch]:
    model = model_at(model_file, Pieces)
    for batch in batches:
        lists = batch.column(1).to_pylist()
        text = pa.array([None if ids is None else model.decode(ids) for ids in lists], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, text], ["doc_id", "ids", "decoded"])


def encode(docs: DataFrame, model_file: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids (array<int>), as the model's own library encodes the whole text.

    No begin or end ids.  Null and empty texts have no ids; repeated rows are treated alike; characters that no piece has
    become their bytes; other columns are ignored.  Nothing is shuffled.
    """
    ready(docs.sparkSession)
    told = documents(docs, id_col, text_col)
    return told.mapInArrow(partial(_encoded, model_file=model_file), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_file: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: doc_id, ids, decoded (the text of the ids; null for null ids)."""
    ready(encoded.sparkSession)
    told = pick(encoded, doc_id=id_col, ids=ids_col)
    kind = "doc_id long, ids array<int>, decoded string"
    return told.mapInArrow(partial(_decoded, model_file=model_file), kind)
