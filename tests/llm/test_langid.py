"""Language identification: held-out accuracy, sparsity, calibration and odd rows."""

from __future__ import annotations

import math
import random

import corpus_pipeline
import numpy as np
import pytest

from tests.llm.helpers import clashing, documents, prose
from tillwork.llm import langid

SYLLABLES = {"aa": "the ing tion er ed wh", "bb": "ung sch keit der ie ver", "cc": "ción ra ado ez que í"}


def text(lang, seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES[lang].split(), k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, text(lang, i), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    return documents(spark, [*rows, (900, None, "aa"), (901, "", "aa"), (902, "123 !", "bb"), (903, text("aa", 3), None), (None, "the", "aa")])


def test_held_out_accuracy(spark, docs):
    told = langid.identify(clashing(docs.withColumnRenamed("lang", "lang"))).collect()
    known = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in told if r["held_out"] and r["doc_id"] < 180]
    assert len(held) > 40
    assert np.mean([r["lang_pred"] == known[r["doc_id"]] for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in told)
    by = {r["doc_id"]: r for r in told}
    assert {by[i]["lang_pred"] for i in (900, 901, 902)} == {"und"}
    assert by[903]["lang_pred"] == "aa"
    assert len(told) == docs.count()


def test_held_out_rows_and_other_columns_do_not_matter(spark, docs):
    fold = langid.remainder("doc_id", 3)
    changed = docs.selectExpr(
        "doc_id", "text", "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 'zz' else lang end as lang",
        "'other' as source", "n_chars",
    )
    assert fold is not None
    a, b = ({(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(d).collect()} for d in (docs, changed))
    assert a == b


def test_partitions_do_not_matter(docs):
    a, b = ({(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(d).collect()} for d in (docs, docs.repartition(7)))
    assert a == b


def test_weights_are_sparse(docs):
    model = langid.fit(docs)
    assert model.classes == ["aa", "bb", "cc"]
    assert 0 < np.count_nonzero(model.weights) < 0.2 * model.weights.size
    assert 0.2 < model.temperature < 21


def test_temperature():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(4000, 3)) * 2
    labels = np.array([rng.choice(3, p=langid.softmax(z / 2.0)) for z in logits])
    assert 1.7 < langid.fit_temperature(logits, labels) < 2.3


def test_nothing_to_learn(spark):
    none = documents(spark, [(1, "some words", None), (2, None, "aa")])
    assert {r["lang_pred"] for r in langid.identify(none).collect()} == {"und"}
    assert langid.identify(none.limit(0)).count() == 0
    one = documents(spark, [(i, "some words here", "aa") for i in range(9)])
    assert {r["lang_pred"] for r in langid.identify(one).collect()} == {"aa"}


def test_kept_rows_have_their_columns(spark, docs):
    model = langid.fit(docs)
    kept = langid.keep_identified(clashing(docs), model, least_score=0.3)
    assert kept.columns == clashing(docs).columns
    assert {r[0] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - {900, 901, 902}


@pytest.mark.parametrize("languages", [2, 3, 4])
def test_the_pipeline_drops_unlearnt_languages(spark, languages):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(f"lang in {('en', 'de', 'es', 'fr')[:languages]}")
    model = langid.fit(docs, held_out=1, folds=3)
    gone = ["Η γρήγορη αλεπού πηδάει πάνω από το σκυλί", "敏捷的棕色狐狸跳过了懒狗", "Быстрая лиса прыгает", "สุนัขจิ้งจอกสีน้ำตาล", "xqzvkqqjwxzkjqvvz"]
    stay = ["the house", "The land is on the other one.", "der Hund ist", "Und die Kinder."]
    rows = documents(spark, list(enumerate(gone + stay)))
    kept = langid.keep_identified(rows, model, least_score=corpus_pipeline.LEAST_SCORE, least_known=corpus_pipeline.LEAST_KNOWN)
    assert {r["text"] for r in kept.collect()} == set(stay)
    # clean texts of the table itself stay
    whole = corpus_pipeline.language_id(spark, docs, "")
    assert whole.count() == docs.where("text rlike '[a-zA-Z]'").count()


@pytest.mark.parametrize("text", ["½ ② ²", "Ⅷ ⅷ", "⁵", "①②", "\U00010140\U0001f101", "३४", "7_8", "…"])
def test_numbers_are_no_letters(text):
    """What is no letter has no language, numerals of all scripts included."""
    assert not any(c.isalpha() for c in text)
    assert len(langid.slots(text)) == 0
    model = langid.Model(["de", "en"], np.ones((langid.SLOTS, 2), np.float32), np.zeros(2))
    assert model.scores(text) is None
    assert len(langid.slots(f"{text} a {text}")) == len(langid.slots("a"))


def test_und_for_numbers(spark):
    rows = [(i, prose(i, 30), "en") for i in range(30)] + [(100 + i, "und der die das ist nicht mit ein sich auf", "de") for i in range(30)]
    rows += [(500, "½ ② ²", None), (501, "Ⅷ ⅷ", "de")]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(documents(spark, rows)).collect()}
    assert got[500] == got[501] == ("und", 0.0)
    assert got[0][0] == "en"


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 3)
    rows = [(i, "some text", f"l{i}") for i in range(5)]
    with pytest.raises(ValueError, match="more than 3 languages"):
        langid.fit(documents(spark, rows))


def test_against_a_plain_regression():
    """Weights of dense proximal steps, one coordinate at a time."""
    rng = np.random.default_rng(3)
    rows = []
    for n in range(40):
        at = np.unique(rng.integers(0, 12, 5)) + 100
        rows.append((n % 3, at, rng.random(len(at)) * (1 + (at % 3 == n % 3) * 3)))
    weights, bias = langid.train(rows, 3)
    z, n = {}, {}

    def weight(j, c):
        zs = z.get((j, c), 0.0)
        lasso = 0 if j == "bias" else langid.LASSO
        if abs(zs) <= lasso:
            return 0.0
        return -(zs - math.copysign(lasso, zs)) / ((langid.BETA + math.sqrt(n.get((j, c), 0.0))) / langid.ALPHA + langid.RIDGE)

    for _ in range(langid.EPOCHS):
        for label, at, value in rows:
            told = [*zip(at.tolist(), value.tolist(), strict=True), ("bias", 1.0)]
            logits = [sum(v * weight(j, c) for j, v in told) for c in range(3)]
            top = max(logits)
            total = sum(math.exp(x - top) for x in logits)
            old = {(j, c): weight(j, c) for j, _ in told for c in range(3)}
            for j, v in told:
                for c in range(3):
                    g = v * (math.exp(logits[c] - top) / total - (c == label))
                    before = n.get((j, c), 0.0)
                    step = (math.sqrt(before + g * g) - math.sqrt(before)) / langid.ALPHA
                    z[j, c] = z.get((j, c), 0.0) + g - step * old[j, c]
                    n[j, c] = before + g * g
    for j in range(100, 112):
        assert weights[j] == pytest.approx([weight(j, c) for c in range(3)], abs=1e-9)
    assert bias == pytest.approx([weight("bias", c) for c in range(3)], abs=1e-9)
    assert (weights[:100] == 0).all()
