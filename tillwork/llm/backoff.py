"""Scores of texts under a smoothed n-gram model, by a weighted automaton with failure arcs.

A state is a context that the training texts have; an arc reads a token, adds its log-probability and goes to the longest context that
the text then ends in.  Where a state has no arc for a token, its failure arc adds the backoff weight and goes to the context less its first
token, at last to the root, which has an arc for everything.  One traversal from left to right scores a text.

No task holds the whole model.  Documents are dealt into blocks of a bounded number of tokens.  A block asks once for each of its different
n-grams: 64-bit keys, sorted, go to the bucket of their range, where equal keys of all blocks are added up, and the totals go back in the
order of the question.  So a block gets the part of the model that its documents can reach and builds its automaton from that.  What a context
was followed by is counted once in the corpus: the bucket names one of the blocks that have an n-gram its owner, and owners add
to the contexts' numbers in the next round, one order lower.

Smoothing is interpolated absolute discounting with discounts estimated from the counts of counts; the root has the additive
estimate (count + 0.5) / (tokens + 0.5 (different tokens + 1)).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.packing import pack, pack_flags, pack_sorted, unpack, unpack_flags, unpack_sorted
from tillwork.llm.shared import pick, ready, stored

#: Longest n-gram.
ORDER = 2
#: Tokens of a block, about; a longer document is a block of its own.
BLOCK_TOKENS = 500_000
#: Tokens of the corpus for each bucket of keys.
BUCKET_TOKENS = 1_000_000
# no word has white space
END, START = (xxhash.xxh64_intdigest(b"\n" + name) for name in (b"end", b"start"))
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

BLOCK_KIND = "block long, tokens long, doc_ids array<long>, learnt binary, sizes binary, words binary, told binary"
ASKED_KIND = "bucket long, block long, keys binary, counts binary, after binary"
ANSWER_KIND = "level int, block long, bucket long, counts binary, owned binary, after binary, sums array<long>"


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII spaces and line ends, A to Z in lower case."""
    return text.encode().lower().split() if text else []


# -- blocks ---------------------------------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch], block_tokens: int) -> Iterator[pa.RecordBatch]:
    """Documents of a partition in blocks: their words as places in the block's sorted list of word hashes."""
    partition, number = TaskContext.get().partitionId(), 0
    doc_ids: list[int | None] = []
    learnt: list[bool] = []
    told: list[np.ndarray] = []
    places: dict[bytes, int] = defaultdict(count().__next__)
    held = 0

    def close() -> pa.RecordBatch:
        nonlocal doc_ids, learnt, told, places, held, number
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in places), np.uint64, len(places))
        words, place = np.unique(hashes, return_inverse=True)
        sizes = np.array([len(t) for t in told], np.uint64)
        row = {
            "block": partition << 32 | number,
            "tokens": held,
            "doc_ids": doc_ids,
            "learnt": pack_flags(np.array(learnt, bool)),
            "sizes": pack(sizes),
            "words": pack_sorted(words),
            "told": pack(place[np.concatenate(told)] if len(place) else np.zeros(0, np.uint64)),
        }
        doc_ids, learnt, told, places, held, number = [], [], [], defaultdict(count().__next__), 0, number + 1
        return pa.RecordBatch.from_pylist([row], _BLOCK_SCHEMA)

    for batch in batches:
        for doc_id, text, learn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = words_of(text)
            if doc_ids and held + len(words) > block_tokens:
                yield close()
            told.append(np.fromiter(map(places.__getitem__, words), np.int64, len(words)))
            doc_ids.append(doc_id)
            learnt.append(learn)
            held += len(words) + 1
    if doc_ids:
        yield close()


_BLOCK_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        *((name, pa.binary()) for name in ("learnt", "sizes", "words", "told")),
    ]
)


@dataclass
class Level:
    """The different n-grams of one length in a block."""

    keys: np.ndarray
    at: np.ndarray  # of each place in the block the n-gram that ends there, or -1
    counts: np.ndarray  # in the block's learnt documents
    context: np.ndarray | None = None  # the n-gram without its last token, one level lower
    last: np.ndarray | None = None  # its last token
    suffix: np.ndarray | None = None  # the n-gram without its first token, one level lower
    order: np.ndarray = field(init=False)

    def __post_init__(self):
        self.order = np.argsort(self.keys, kind="stable")


class Block:
    """A block's documents as tokens, each opened by a start and closed by an end, and their n-grams."""

    def __init__(self, row: dict, order: int):
        sizes = unpack(row["sizes"]).astype(np.int64)
        words = unpack_sorted(row["words"])
        self.doc_ids = row["doc_ids"]
        self.learnt = unpack_flags(row["learnt"], len(sizes))
        self.end, self.start = len(words), len(words) + 1
        self.starts = np.cumsum(np.append(0, sizes[:-1] + 2))
        self.sizes = sizes + 1  # tokens that count
        length = int((sizes + 2).sum())
        self.tokens = np.full(length, -1)
        self.tokens[self.starts] = self.start
        self.tokens[self.starts + sizes + 1] = self.end
        self.tokens[self.tokens < 0] = unpack(row["told"])
        # how far a place is from its document's start
        within = np.arange(length) - np.repeat(self.starts, sizes + 2)
        learns = np.repeat(self.learnt, sizes + 2)
        keys = np.concatenate([words, np.array([END, START], np.uint64)])
        counts = np.bincount(self.tokens[learns], minlength=len(keys))
        self.levels = [Level(keys, self.tokens, counts)]
        for n in range(2, order + 1):
            self.levels.append(self._longer(self.levels[-1], within >= n - 1, learns))

    def _longer(self, shorter: Level, there: np.ndarray, learns: np.ndarray) -> Level:
        places = np.flatnonzero(there)
        width = len(self.levels[0].keys)
        codes = shorter.at[places - 1] * width + self.tokens[places]
        found, first, number = np.unique(codes, return_index=True, return_inverse=True)
        context, last = found // width, found % width
        keys = (shorter.keys[context] ^ (shorter.keys[context] >> np.uint64(29))) * _ODD[0] + self.levels[0].keys[last] * _ODD[1]
        keys ^= keys >> np.uint64(32)
        at = np.full(len(self.tokens), -1)
        at[places] = number
        counts = np.bincount(number[learns[places]], minlength=len(found))
        return Level(keys, at, counts, context, last, shorter.at[places[first]])


# -- questions and answers ------------------------------------------------------------------------------


def _question(block: int, level: Level, buckets: int, after: np.ndarray | None) -> pa.RecordBatch:
    """One row for each bucket: sorted keys, counts, and how many tokens follow a context once, twice and more often."""
    keys, counts = level.keys[level.order], level.counts[level.order]
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=np.uint64(buckets)) != 0), len(keys))
    rows = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        follow = None if after is None else pack(after[level.order[a:b]].ravel())
        told = {"keys": pack_sorted(keys[a:b]), "counts": pack(counts[a:b]), "after": follow}
        rows.append({"bucket": int(bucket[a]), "block": block} | told)
    return pa.RecordBatch.from_pylist(rows, _ASKED_SCHEMA)


_ASKED_SCHEMA = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), *((name, pa.binary()) for name in ("keys", "counts", "after"))])


def _ask_longest(batches: Iterator[pa.RecordBatch], order: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield _question(row["block"], Block(row, order).levels[-1], buckets, None)


def _answered(level: Level, told: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Totals, ownership and followers of a level's n-grams, from the answers of all buckets."""
    if not told:  # no document of the block is so long
        return np.zeros(0, np.int64), np.zeros(0, bool), np.zeros((0, 3), np.int64)
    told = sorted(told, key=lambda row: row["bucket"])
    counts = [unpack(row["counts"]).astype(np.int64) for row in told]
    owned = [unpack_flags(row["owned"], len(c)) for row, c in zip(told, counts, strict=True)]
    after = None
    if told[0]["after"] is not None:
        after = np.zeros((len(level.keys), 3), np.int64)
        after[level.order] = np.concatenate([unpack(row["after"]).astype(np.int64).reshape(-1, 3) for row in told])
    total, owner = np.zeros(len(level.keys), np.int64), np.zeros(len(level.keys), bool)
    total[level.order] = np.concatenate(counts)
    owner[level.order] = np.concatenate(owned)
    return total, owner, after


def _ask_shorter(left: pa.Table, right: pa.Table, length: int, buckets: int) -> pa.Table:
    """The n-grams of ``length``, with what this block's own longer n-grams say about them as contexts."""
    row = left.to_pylist()[0]
    levels = Block(row, length + 1).levels
    total, owner, _ = _answered(levels[length], right.to_pylist())
    kept = owner & (total > 0)
    often = np.minimum(total[kept], 3) - 1
    after = np.bincount(levels[length].context[kept] * 3 + often, minlength=3 * len(levels[length - 1].keys))
    return pa.Table.from_batches([_question(row["block"], levels[length - 1], buckets, after.reshape(-1, 3))])


def _add_up(asked: pa.Table, level: int) -> pa.Table:
    """A bucket's answers, one for each block that asked, and one row with its sums."""
    rows = sorted(asked.to_pylist(), key=lambda row: row["block"])
    keys = [unpack_sorted(row["keys"]) for row in rows]
    different, first, number = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    total = _summed(number, np.concatenate([unpack(row["counts"]) for row in rows]), len(different))
    owned = np.zeros(len(number), bool)
    owned[first] = True
    after = None
    if rows[0]["after"] is not None:
        each = np.concatenate([unpack(row["after"]).reshape(-1, 3) for row in rows])
        after = np.stack([_summed(number, column, len(different)) for column in each.T], axis=1)
    counted = total[(total > 0) & (different != np.uint64(START))] if level == 1 else total[total > 0]
    sums = [int(counted.sum()), len(counted), *(int((counted == i).sum()) for i in range(1, 5))]
    told = [{"level": level, "block": -1, "bucket": rows[0]["bucket"], "sums": sums}]
    start = 0
    for row, asking in zip(rows, keys, strict=True):
        mine = slice(start, start := start + len(asking))
        told.append(
            {
                "level": level,
                "block": row["block"],
                "bucket": row["bucket"],
                "counts": pack(total[number[mine]]),
                "owned": pack_flags(owned[mine]),
                "after": None if after is None else pack(after[number[mine]].ravel()),
            }
        )
    return pa.Table.from_pylist(told, _ANSWER_SCHEMA)


def _summed(number: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums by number; doubles hold these whole numbers exactly."""
    return np.bincount(number, weights=values, minlength=size).astype(np.int64)


_ANSWER_SCHEMA = pa.schema(
    [
        ("level", pa.int32()),
        ("block", pa.int64()),
        ("bucket", pa.int64()),
        *((name, pa.binary()) for name in ("counts", "owned", "after")),
        ("sums", pa.list_(pa.int64())),
    ]
)


# -- the model ------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Numbers of the whole corpus: training tokens, different ones, and the discounts of n-grams of two tokens and more."""

    tokens: int
    different: int
    discounts: tuple[tuple[float, float, float], ...]


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """What is taken off counts of one, two and more, from how many n-grams occur once, twice, three and four times.

    A part of each count is always left and taken, so that nothing seen gets less than what is not, and unseen tokens get something.
    """
    share = n1 / (n1 + 2 * n2) if n1 else 0.5
    numbers = [n1, n2, n3, n4]
    raw = [k - (k + 1) * share * numbers[k] / numbers[k - 1] if numbers[k - 1] else 0.5 * k for k in (1, 2, 3)]
    return tuple(min(max(d, 0.05 * k), 0.95 * k) for k, d in zip((1, 2, 3), raw, strict=True))


class Automaton:
    """The states and arcs of a model that a block's documents can reach.

    A state is an n-gram that can be a context, known by its length and its number in the block (the root has length 0).  The arcs of
    all states of one length are numbered as the n-grams that they complete; what is no n-gram of the model has no arc.
    """

    def __init__(self, block: Block, answers: list[tuple[np.ndarray, np.ndarray, np.ndarray | None]], model: Model):
        levels, total = block.levels, answers[0][0]
        chance = (total + 0.5) / (model.tokens + 0.5 * (model.different + 1))
        self.known = total > 0
        self.base = np.log10(chance)
        self.longest = len(levels) - 1
        self.root = self.base.tolist()
        self.live = (self.known & (self.longest > 0)).tolist()
        # by length of the state: weights of its arcs, _NONE where there is none, and of its failure arc
        self.arcs: list[list[float]] = [[]]
        self.back: list[list[float]] = [[]]
        for level, lower, (total, _, after), (seen, *_), taken in zip(
            levels[1:], levels, answers, answers[1:], np.array(model.discounts).reshape(-1, 3), strict=False
        ):
            kept = np.flatnonzero(seen > 0)
            held = np.flatnonzero((total > 0) & (after.sum(axis=1) > 0))
            left = np.ones(len(lower.keys))
            left[held] = after[held] @ taken / total[held]
            context, suffix, count = level.context[kept], level.suffix[kept], seen[kept]
            longer = np.zeros(len(level.keys))
            longer[kept] = (count - taken[np.minimum(count, 3) - 1]) / total[context] + left[context] * chance[suffix]
            chance = longer
            weights = np.full(len(level.keys), _NONE)
            weights[kept] = np.log10(longer[kept])
            self.arcs.append(weights.tolist())
            self.back.append(np.log10(left).tolist())

    def score(self, start: tuple[int, ...], places: Iterable[tuple[int, ...]]) -> float:
        """Log-probability (base 10) of a text, from left to right.

        ``places`` has, for each token, the numbers of the n-grams that end there, the shortest first, and ``start`` those of the start.
        """
        arcs, back, root, live, longest = self.arcs, self.back, self.root, self.live, self.longest
        total, before = 0.0, start
        length = 1 if live[start[0]] else 0
        for place in places:
            while length:
                weight = arcs[length][place[length]]
                if weight != _NONE:
                    total += weight
                    if length < longest:
                        length += 1
                    break
                # the failure arc: the same context less its first token
                length -= 1
                total += back[length + 1][before[length]]
            else:
                total += root[place[0]]
                length = 1 if live[place[0]] else 0
            before = place
        return total


#: No log-probability is above 0.
_NONE = 1.0


def _scored(left: pa.Table, right: pa.Table, order: int, model: Model) -> pa.Table:
    block = Block(left.to_pylist()[0], order)
    told: dict[int, list[dict]] = {}
    for row in right.to_pylist():
        told.setdefault(row["level"], []).append(row)
    automaton = Automaton(block, [_answered(level, told.get(n, [])) for n, level in enumerate(block.levels, 1)], model)
    there = np.ones(len(block.tokens), bool)
    there[block.starts] = False
    tokens = block.tokens[there]
    starts = block.starts - np.arange(len(block.starts))
    numbers = [level.at.tolist() for level in block.levels]
    scores = []
    for a, n in zip(block.starts.tolist(), block.sizes.tolist(), strict=True):
        start, *places = zip(*(at[a : a + n + 1] for at in numbers), strict=True)
        scores.append(automaton.score(start, places))
    return pa.table(
        {
            "doc_id": pa.array(block.doc_ids, pa.int64()),
            "held_out": pa.array(~block.learnt),
            "n_tokens": pa.array(block.sizes, pa.int64()),
            "n_known": pa.array(np.add.reduceat(automaton.known[tokens].astype(np.int64), starts), pa.int64()),
            "train_tokens": pa.array(np.full(len(starts), model.tokens), pa.int64()),
            "base_score": pa.array(np.add.reduceat(automaton.base[tokens], starts)),
            "score": pa.array(scores, pa.float64()),
        }
    )


SCORE_KIND = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(
    docs: DataFrame,
    learn: Column | None = None,
    *,
    order: int = ORDER,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_tokens: int = BLOCK_TOKENS,
    bucket_tokens: int = BUCKET_TOKENS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row, by a model learnt from the rows where ``learn`` holds.

    ``learn`` is a condition on a column ``doc_id``; without one all rows are learnt from.  ``held_out`` is its opposite; a row for which
    it is null, as one without an id, is held out.  Null and empty texts are an end alone.  Repeated rows are rows of their
    own, in the counts too; other columns are ignored; an empty table has no rows.  If nothing is learnt, every token has chance 1.
    ``base_score`` is the root's estimate alone.  Equal 64-bit hashes stand for equal words and n-grams.
    """
    spark = docs.sparkSession
    ready(spark)
    learns = F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))
    told = pick(docs, doc_id=id_col, text=text_col).select("doc_id", "text", learns.alias("learn"))
    blocks = stored(told.mapInArrow(partial(_blocks, block_tokens=block_tokens), BLOCK_KIND), "blocks")
    tokens = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    buckets = int(-(-tokens // bucket_tokens)) or 1
    answers: list[DataFrame] = []
    numbers = []
    for length in range(order, 0, -1):
        if not answers:
            asked = blocks.mapInArrow(partial(_ask_longest, order=order, buckets=buckets), ASKED_KIND)
        else:
            ask = partial(_ask_shorter, length=length, buckets=buckets)
            asked = _beside(blocks, answers[-1]).applyInArrow(_plain(ask), ASKED_KIND)
        add_up = partial(_add_up, level=length)
        answers.append(stored(asked.groupBy("bucket").applyInArrow(_plain_one(add_up), ANSWER_KIND), "answers"))
        sums = [F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)) for i in range(6)]
        numbers.append(tuple(answers[-1].where("block < 0").agg(*sums).first()))
    taken = tuple(discounts(*n[2:]) for n in reversed(numbers[:-1]))
    model = Model(numbers[-1][0], numbers[-1][1], taken)
    every = answers[0]
    for more in answers[1:]:
        every = every.unionByName(more)
    return _beside(blocks, every).applyInArrow(_plain(partial(_scored, order=order, model=model)), SCORE_KIND)


def _beside(blocks: DataFrame, answers: DataFrame):
    return blocks.groupBy("block").cogroup(answers.where("block >= 0").groupBy("block"))


def _plain(f: partial):
    """Spark reads the number of a function's parameters, which a partial hides."""

    def told(left: pa.Table, right: pa.Table) -> pa.Table:
        return f(left, right)

    return told


def _plain_one(f: partial):
    def told(table: pa.Table) -> pa.Table:
        return f(table)

    return told
