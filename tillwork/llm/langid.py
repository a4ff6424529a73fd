"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, runs of anything but letters become one space, and the n-grams of the rest are counted
in hashed slots.  A slot's weight in a text is its share of the text's n-grams times its inverse document
frequency.  The regression is trained by follow-the-regularised-leader with an elastic-net penalty, which leaves
most weights at zero, and its scores are divided by a temperature fitted on labelled texts that the training did not see.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.shared import documents, kind_of, numbered, pick, ready, texts

UNKNOWN = "und"
SLOTS = 1 << 16
SIZES = (1, 2, 3)
#: Languages that a model can learn; the weights take 512 KB for each of them.
MOST_LANGUAGES = 1000
#: About so many labelled texts train the model and fit its temperature, evenly by language.
SAMPLE = 6000
EPOCHS = 4
#: Shares are small numbers; times this they suit the step size.
SCALE = 100.0
# follow-the-regularised-leader: step size, its offset, and the two penalties
ALPHA, BETA, LASSO, RIDGE = 1.0, 1.0, 0.02, 0.01
# what \w takes besides letters, digits and "_": characters that stand for numbers, such as fractions and Roman numerals; sets that
# reach beyond the basic plane are slow, so those there are looked for only where a text has any such character
_NUMBERS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
_NUMERALS = re.compile(f"[{''.join(c for c in _NUMBERS if ord(c) < 1 << 16)}]")
_BEYOND = re.compile("[\U00010000-\U0010ffff]")
_RARE_NUMERALS = re.compile(f"[{''.join(c for c in _NUMBERS if ord(c) >= 1 << 16)}]")
_OTHER = re.compile(r"[\W\d_]+")


def slots(text: str | None) -> np.ndarray:
    """The slot of every character n-gram of a text; empty if the text has no letter."""
    lower = text.lower() if text else ""
    if not lower.isascii():
        lower = _NUMERALS.sub(" ", lower)
        if _BEYOND.search(lower):
            lower = _RARE_NUMERALS.sub(" ", lower)
    plain = _OTHER.sub(" ", lower).strip()
    if not plain:
        return np.zeros(0, np.int64)
    points = np.frombuffer(f" {plain} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    found, rolled = [], np.zeros(len(points), np.uint64)
    for size in range(1, max(SIZES) + 1):
        rolled = rolled[: len(points) - size + 1] * np.uint64(1_000_003) + points[size - 1 :]
        if size in SIZES:
            mixed = (rolled + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed >> np.uint64(64 - 16)).astype(np.int64))
    return np.concatenate(found)


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that hold each slot, summed over this task; slot -1 counts the texts."""
    held = np.zeros(SLOTS + 1, np.int64)
    for batch in batches:
        for text in texts(batch):
            found = slots(text)
            if len(found):
                here = np.zeros(SLOTS + 1, bool)
                here[found] = here[SLOTS] = True
                held += here
    some = np.flatnonzero(held)
    named = np.where(some == SLOTS, -1, some)
    yield pa.RecordBatch.from_arrays([pa.array(named, pa.int64()), pa.array(held[some], pa.int64())], ["slot", "n"])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Smoothed logarithmic inverse document frequency of every slot, over all values of ``text``."""
    counted = docs.select("text").mapInArrow(_slot_counts, "slot long, n long")
    rows = counted.groupBy("slot").agg(F.sum("n").alias("n")).toPandas()  # SLOTS + 1 rows at most
    held, total = np.zeros(SLOTS), 0
    for slot, n in zip(rows["slot"], rows["n"], strict=True):
        if slot < 0:
            total = n
        else:
            held[slot] = n
    return np.log((1 + total) / (1 + held)) + 1


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counted = [np.unique(slots(text), return_counts=True) for text in texts(batch)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(batch.schema.get_field_index("lang")),
                batch.column(batch.schema.get_field_index("place")),
                pa.array([s.astype(np.int32) for s, _ in counted], pa.list_(pa.int32())),
                pa.array([(c / max(1, c.sum())).astype(np.float32) for _, c in counted], pa.list_(pa.float32())),
            ],
            ["lang", "place", "slots", "shares"],
        )


@dataclass
class Model:
    classes: list[str]
    weights: np.ndarray  # slots x classes, inverse frequencies multiplied in
    bias: np.ndarray
    temperature: float = 1.0
    learnt: np.ndarray | None = None  # whether a slot has a weight
    usual: float = 1.0  # median share of learnt n-grams in the texts that fitted the temperature

    def known(self, text: str | None) -> float:
        """How far the n-grams of a text are learnt ones: their share, as a part of the usual share.

        The scores compare the languages with each other and are sure of one in any text; this tells whether it is one of them.
        """
        found = slots(text)
        return float(self.learnt[found].mean()) / self.usual if len(found) else 0.0

    def scores(self, text: str | None) -> np.ndarray | None:
        """Probabilities of the classes; None if the text has no letter."""
        found = slots(text)
        if not len(found):
            return None
        return softmax((self.weights[found].mean(axis=0, dtype=np.float64) + self.bias) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights (slots x classes) and bias by follow-the-regularised-leader, proximal form.

    Every coordinate keeps the sum of its shifted gradients and of their squares; its weight is the closed-form
    minimiser of the regularised sum, zero while the sum stays below the lasso penalty.
    """
    z, n = np.zeros((SLOTS + 1, classes)), np.zeros((SLOTS + 1, classes))  # the last row is the bias
    lasso = np.full((SLOTS + 1, 1), LASSO)
    lasso[SLOTS] = 0

    def weights_of(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        kept = np.sign(zs) * np.maximum(0, np.abs(zs) - lasso[at])
        return -kept / ((BETA + np.sqrt(n[at])) / ALPHA + RIDGE)

    for _ in range(EPOCHS):
        for label, at, value in rows:
            at, value = np.append(at, SLOTS), np.append(value, 1.0)
            w = weights_of(at)
            error = softmax(value @ w)
            error[label] -= 1
            g = value[:, None] * error
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    all_weights = weights_of(np.arange(SLOTS + 1))
    return all_weights[:SLOTS], all_weights[SLOTS]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which the labels are likeliest, by golden section over its logarithm."""

    def loss(t: float) -> float:
        p = softmax(logits / math.exp(t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-300)).mean())

    lo, hi, golden = math.log(0.25), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - golden * (hi - lo), lo + golden * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


def fit(
    docs: DataFrame,
    *,
    held_out: int | None = None,
    folds: int = 1,
    lang_col: str = "lang",
    text_col: str = "text",
    id_col: str = "doc_id",
    sample: int = SAMPLE,
) -> Model:
    """Fit on the labelled rows of ``docs``; document frequencies count all its rows.

    With ``held_out``, rows whose id falls into that fold (crc32 of the id as text, modulo ``folds``) are not read, nor are rows
    without an id.  Training takes about ``sample`` texts: of each language the share of rows that gives it an equal part,
    chosen by a hash of the id, and all rows of languages that have fewer.  One in five of them fits the temperature.
    Without labelled texts that have letters, as in an empty table, the model has no classes and calls everything ``und``.  More than
    ``MOST_LANGUAGES`` labels are an error.
    """
    ready(docs.sparkSession)
    told = pick(docs, doc_id=id_col, lang=lang_col, text=text_col)
    if held_out is not None:
        told = told.where(remainder("doc_id", folds) != held_out)
    labelled = told.where("lang is not null and text is not null")
    counted = labelled.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counted) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: {lang_col} holds something else")
    counts = {r["lang"]: r["count"] for r in counted}
    if not counts:
        return Model([], np.zeros((SLOTS, 0), np.float32), np.zeros(0))
    part = sample / len(counts)
    place = (F.xxhash64(F.col("doc_id"), F.lit("language sample")).bitwiseAND(F.lit((1 << 53) - 1))) / float(1 << 53)
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, part / n))))
    chosen = labelled.withColumn("place", place).where(F.col("place") < share[F.col("lang")])
    rows = chosen.select("lang", F.xxhash64("doc_id").alias("place"), "text").mapInArrow(
        _features, "lang string, place long, slots array<int>, shares array<float>"
    )
    inverse = SCALE * inverse_frequencies(told)
    classes = sorted(counts)
    return _trained(rows.toArrow(), classes, inverse)


def _trained(sample: pa.Table, classes: list[str], inverse: np.ndarray) -> Model:
    """The model of a sample; its rows are taken in the order of their hash, whichever task they come from."""
    order = np.argsort(sample["place"].to_numpy(), kind="stable")
    labels = [classes.index(x) for x in sample["lang"].to_pylist()]
    at, share = (sample[c].combine_chunks() for c in ("slots", "shares"))
    ends = at.offsets.to_numpy()
    flat, shares = at.values.to_numpy(), share.values.to_numpy().astype(float)
    rows, raw = [], []
    for i in order:
        found = flat[ends[i] : ends[i + 1]]
        if len(found):
            raw.append(shares[ends[i] : ends[i + 1]])
            rows.append((labels[i], found, raw[-1] * inverse[found]))
    kept = rows[::5]
    weights, bias = train([r for i, r in enumerate(rows) if i % 5] or kept, len(classes))
    model = Model(classes, (weights * inverse[:, None]).astype(np.float32), bias, learnt=(weights != 0).any(axis=1))
    if kept:
        shared = [share[model.learnt[at]].sum() for (_, at, _), share in zip(kept, raw[::5], strict=True)]
        model.usual = float(np.median(shared)) or 1.0
        logits = np.stack([value @ weights[at] + bias for _, at, value in kept])
        model.temperature = fit_temperature(logits, np.array([label for label, _, _ in kept]))
    return model


def _predicted(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scored = [model.scores(text) if model.classes else None for text in texts(batch)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([UNKNOWN if p is None else model.classes[int(p.argmax())] for p in scored], pa.string()),
                pa.array([0.0 if p is None else float(p.max()) for p in scored], pa.float64()),
            ],
            ["doc_id", "lang_pred", "score"],
        )


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (calibrated probability of lang_pred).

    Null texts and texts without a letter are ``und`` with score 0; of equal scores the language that sorts first wins;
    repeated rows are treated alike; nothing but the text is read.
    """
    ready(docs.sparkSession)
    told = documents(docs, id_col, text_col)
    return told.mapInArrow(partial(_predicted, model=model), "doc_id long, lang_pred string, score double")


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of an id as text, modulo ``divisor``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def identify(docs: DataFrame, *, held_out: int = 1, folds: int = 3, **settings) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, by a model fitted on the folds other than ``held_out``."""
    told = predict(docs, fit(docs, held_out=held_out, folds=folds, **settings))
    out = F.coalesce(remainder("doc_id", folds) == held_out, F.lit(False))
    return told.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def _identified(
    batches: Iterator[pa.RecordBatch], model: Model, text: int, least_score: float, least_known: float
) -> Iterator[pa.RecordBatch]:
    def sure(t: str | None) -> bool:
        p = model.scores(t) if model.classes else None
        return p is not None and p.max() >= least_score and (not least_known or model.known(t) >= least_known)

    for batch in batches:
        yield batch.filter(pa.array([sure(t) for t in batch.column(text).to_pylist()], pa.bool_()))


def keep_identified(
    docs: DataFrame, model: Model, *, least_score: float, least_known: float = 0.0, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is known with this score at least; none that are ``und``.

    With ``least_known``, texts whose n-grams are learnt to a lesser part of the usual share go too, whatever their score.
    """
    ready(docs.sparkSession)
    flat = numbered(docs)
    bounds = {"least_score": least_score, "least_known": least_known}
    chosen = partial(_identified, model=model, text=docs.columns.index(text_col), **bounds)
    return flat.mapInArrow(chosen, kind_of(flat)).toDF(*docs.columns)
