"""Toxicity scores: gradient-boosted trees over dense text features, with isotonic calibration.

The features of a text are densities of a lexicon, how near its words stand to the second person, shares of capitals
and punctuation, and rates of obfuscated words.  The lexicon is a short fixed list and what labelled texts teach: words, and beginnings of words, that
toxic texts hold far more often than others.  Four fifths of the labelled sample teach lexicon and trees, each half of them seen
by the trees through the lexicon of the other half; one fifth fits the calibration.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.langid import remainder
from tillwork.llm.shared import documents, pick, ready, stored, texts

#: About so many labelled texts teach lexicon and trees (4 in 5) and calibration (1 in 5).
SAMPLE = 16_000
#: Entries of the learnt lexicon at most, texts that must hold one, and its least z value.
LEXICON, LEAST_TEXTS, LEAST_Z = 400, 3, 4.0
BEGINNINGS = (5, 7)
NEAR = 4
THRESHOLD = 0.3

# Common insults, second-person words of four languages, characters that stand for letters.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb fool loser losers pathetic worthless trash garbage scum clown disgusting "
    "filthy vermin imbecile coward ugly idiote crétin imbécile stupide ordure débile dumm dummkopf blödmann abschaum "
    "trottel estúpido imbécil basura escoria payaso".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself youre u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch "
    "tú ti contigo tuyo usted ustedes".split()
)
LEET = str.maketrans("013457@$!", "oieastasi")

_WORD = re.compile(r"[^\W\d_]+")
#: Whole words of two letters or more without a to z: all that can be in capitals.
_CAPITALS = re.compile(r"[^\W\d_a-z](?<![^\W\d_][^\W\d_])[^\W\d_a-z]++(?![^\W\d_])")
# runs that hold a digit or mark: each is tried once, from its start
_CODED = re.compile(r"(?<![\w@$!*])[^\W0-9]*+[0-9@$!*][\w@$!*]*+")
_BEYOND = re.compile(r"[^\x00-\x7f]+")
_SPELT = re.compile(r"(?:\b[^\W\d_][.\-*_ ]){3,}[^\W\d_]\b")

FEATURES = (
    "hits", "hit_density", "hit_kinds", "hit_weight", "heaviest", "fixed_hits", "fixed_density", "near_second",
    "second_person", "capitals", "capital_words", "punctuation", "exclamations", "repeated_marks",
    "obfuscated", "obfuscated_hits", "spelt_out", "log_words", "word_length", "digits",
)


def units(word: str) -> list[str]:
    """A word, and its beginnings marked with a star."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def _unit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each label that hold each unit, summed over some texts at a time."""
    for batch in batches:
        toxic: Counter[str] = Counter()
        other: Counter[str] = Counter()
        for text, label in zip(texts(batch), batch.column(batch.schema.get_field_index("label")).to_pylist(), strict=True):
            held = {u for word in set(_WORD.findall((text or "").lower())) for u in units(word)}
            (toxic if label else other).update(held)
        names = list(toxic | other)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([toxic[n] for n in names], pa.int64()),
                pa.array([other[n] for n in names], pa.int64()),
            ],
            ["unit", "toxic", "other"],
        )


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Units that stand out in texts of label 1, with their logarithmic odds."""
    sums = {bool(r["label"]): r["count"] for r in labelled.groupBy("label").count().collect()}
    n1, n0 = sums.get(True, 0), sums.get(False, 0)
    if not n1 or not n0:
        return {}
    counted = labelled.select("text", "label").mapInArrow(_unit_counts, "unit string, toxic long, other long")
    counts = counted.groupBy("unit").agg(F.sum("toxic").alias("t"), F.sum("other").alias("o"))
    p = (F.col("t") + F.col("o")) / float(n1 + n0)
    z = (F.col("t") / float(n1) - F.col("o") / float(n0)) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * (1 / n1 + 1 / n0))
    odds = F.log((F.col("t") + 0.5) / (n1 + 1.0)) - F.log((F.col("o") + 0.5) / (n0 + 1.0))
    found = counts.where(F.col("t") >= LEAST_TEXTS).select("unit", z.alias("z"), odds.alias("odds"))
    best = found.where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "unit").limit(LEXICON)
    return {r["unit"]: r["odds"] for r in best.collect()}


def _weigh(word: str, lexicon: dict[str, float]) -> float:
    """The largest weight of a word's units."""
    get, n = lexicon.get, len(word)
    weight = get(word, 0.0)
    for size in BEGINNINGS:
        if n > size:
            other = get(word[:size] + "*", 0.0)
            if other > weight:
                weight = other
    return weight


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """The dense features of a text, all zero for a null or empty one."""
    if not text:
        return [0.0] * len(FEATURES)
    lower = text.lower()
    words = _WORD.findall(lower)
    n, length = max(1, len(words)), len(text)
    counts = Counter(words)
    weights: dict[str, float] = {}
    for word in counts:
        weight = _weigh(word, lexicon)
        if weight > 0 or word in INSULTS:
            weights[word] = max(weight, 1.0)
    hits = sum(counts[w] for w in weights)
    fixed = sum(counts[w] for w in weights if w in INSULTS)
    second = sum(counts[w] for w in SECOND_PERSON if w in counts)
    near = 0
    if hits and second:
        places = [i for i, w in enumerate(words) if w in SECOND_PERSON]
        near = sum(any(w in weights for w in words[max(0, i - NEAR) : i + NEAR + 1]) for i in places)
    upper = 0
    if lower != text:
        upper = sum(map(text.count, string.ascii_uppercase))
        if not text.isascii():
            upper += sum(map(str.isupper, "".join(_BEYOND.findall(text))))
    capital_words = sum(map(str.isupper, _CAPITALS.findall(text)))
    letters = sum(map(len, words))
    marks = length - letters - text.count(" ") - text.count("\n")
    coded = [w for w in _CODED.findall(lower) if any(c.isalpha() for c in w)] if marks else []
    decoded = [w.translate(LEET).strip("!*") for w in coded]
    coded_hits = sum(w in INSULTS or any(u in lexicon for u in units(w)) for w in decoded)
    doubled = sum(text.count(m) for m in ("!!", "??", "**", "##", "$$"))
    digits = sum(map(text.count, "0123456789"))
    return [
        math.log1p(hits), hits / n, float(len(weights)), sum(weights[w] * counts[w] for w in weights) / math.sqrt(n),
        max(weights.values(), default=0.0), float(fixed), fixed / n, near / n, second / n, upper / length,
        capital_words / n, marks / length, text.count("!") / n, doubled / n, len(coded) / n, float(coded_hits),
        float(len(_SPELT.findall(lower))) / n, math.log1p(len(words)), letters / n, digits / length,
    ]


def _featured(batches: Iterator[pa.RecordBatch], lexicon: dict[str, float]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place = batch.schema.get_field_index("text")
        rows = [features(text, lexicon) for text in texts(batch)]
        kept = [c for i, c in enumerate(batch.columns) if i != place]
        names = [n for i, n in enumerate(batch.schema.names) if i != place]
        columns = [pa.array(column, pa.float64()) for column in zip(*rows, strict=True)] or [pa.array([], pa.float64())] * len(FEATURES)
        yield pa.RecordBatch.from_arrays([*kept, *columns], [*names, *FEATURES])


_KINDS = ", ".join(f"{name} double" for name in FEATURES)


def _vectors(df: DataFrame, kind: str, lexicon: dict[str, float]) -> DataFrame:
    told = df.mapInArrow(partial(_featured, lexicon=lexicon), f"{kind}, {_KINDS}")
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(told)


@dataclass
class Model:
    """Trees and calibration; without both labels in the sample, one constant score."""

    constant: float = 0.0
    lexicon: dict[str, float] = field(default_factory=dict)
    trees: object = None
    calibration: object = None

    def score(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """One row per input row: doc_id, score (0 to 1), predicted (1 from THRESHOLD on).

        Null and empty texts are scored by features that are all zero; repeated rows are treated alike; nothing but the text is read.
        """
        ready(docs.sparkSession)
        told = documents(docs, id_col, text_col)
        if self.trees is None:
            scored = told.select("doc_id", F.lit(float(self.constant)).alias("score"))
        else:
            raw = self.trees.transform(_vectors(told, "doc_id long", self.lexicon))
            raw = raw.select("doc_id", _positive().alias("raw"))
            fitted = F.coalesce(F.col("calibrated"), F.lit(self.constant))
            scored = self.calibration.transform(raw).select("doc_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), fitted)).alias("score"))
        return scored.select("doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _positive() -> Column:
    return vector_to_array("probability")[1]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    seed: int = 7,
) -> Model:
    """Fit on about ``sample`` labelled texts, chosen evenly by a hash of their ids.

    Labels are 0 or 1; null and other labels and null ids are passed over, and an id with several labels counts as toxic if any says so.
    Without labels, as in an empty table, every score is 0; with labels of one kind it is their share.  Extra columns are
    ignored.  The sample's ids are broadcast: ``sample`` bounds them.
    """
    ready(docs.sparkSession)
    known = pick(labels, doc_id=id_col, label=label_col).where("doc_id is not null and label in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("label").cast("double").alias("label"))
    total, positive = known.agg(F.count("*"), F.sum("label")).first()
    if not total:
        return Model()
    place = F.xxhash64("doc_id", F.lit(seed)).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)
    share = min(1.0, sample / total)
    chosen = known.withColumn("place", place / share).where("place < 1").withColumn("part", (F.col("place") * 1e6).cast("long") % 5)
    told = documents(docs, id_col, text_col).join(F.broadcast(chosen.select("doc_id", "label", "part")), "doc_id")
    told = stored(told.select("label", "part", "text"), "toxicity-sample")
    # the trees must not see densities of words that their own texts taught: each half takes the other's lexicon
    halves = [told.where("part < 2"), told.where("part in (2, 3)")]
    first, second, lexicon = (learn_lexicon(x) for x in (*halves, told.where("part < 4")))
    parts = [(halves[0], second), (halves[1], first), (told.where("part = 4"), lexicon)]
    vectors = [_vectors(x, "label double, part long", words).select("label", "part", "features") for x, words in parts]
    vectors = stored(vectors[0].unionByName(vectors[1]).unionByName(vectors[2]), "toxicity-features")
    both = {(bool(r["cal"]), r["label"]): r["count"] for r in vectors.groupBy((F.col("part") == 4).alias("cal"), "label").count().collect()}
    if not all(both.get((cal, label)) for cal in (False, True) for label in (0.0, 1.0)):
        return Model(constant=positive / total, lexicon=lexicon)
    learner = GBTClassifier(labelCol="label", maxIter=40, maxDepth=4, stepSize=0.15, minInstancesPerNode=5, seed=seed)
    trees = learner.fit(vectors.where("part < 4").coalesce(4))
    raw = trees.transform(vectors.where("part = 4")).select("label", _positive().alias("raw"))
    calibration = IsotonicRegression(labelCol="label", featuresCol="raw", predictionCol="calibrated").fit(raw)
    return Model(positive / total, lexicon, trees, calibration)


def assess(
    docs: DataFrame,
    labels: DataFrame,
    *,
    held_out: int = 2,
    folds: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    **settings,
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, by a model fitted on the folds other than ``held_out``."""
    fold = remainder("doc_id", folds)
    told = documents(docs, id_col, text_col)
    known = pick(labels, doc_id=id_col, toxic=label_col)
    model = fit(told.where(fold != held_out), known.where(fold != held_out), **settings)
    out = F.coalesce(fold == held_out, F.lit(False))
    return model.score(told).select("doc_id", out.alias("held_out"), "score", "predicted")
