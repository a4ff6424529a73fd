"""The registered queries over the given tables."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tests.llm.helpers import clashing, documents, odd_rows, prose
from tests.llm.test_repeats import plain as plain_repeats
from tests.llm.test_simhash import groups, plain_fingerprint
from tillwork.llm import decontam, langid, pii, registry
from tillwork.llm.shared import stored

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{SMALL}/documents.parquet").to_pandas()


def test_all_are_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    found = __spark_entry__.queries()
    assert all(sum(q.startswith(n) for q in found) == 1 for n in names)
    assert "pipeline" in found
    assert set(registry.oracle_sql()) <= set(__spark_entry__.oracle_sql())


def test_op1(spark, docs):
    got = registry.op1_pii(spark, SMALL).toPandas().set_index("doc_id")
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        new, found = pii.replace(text, pii.DEMO_KEY.encode())
        row = got.loc[doc_id]
        assert (row.text, row.n_found) == (new, len(found))
        assert [(f["kind"], text[f["start"] : f["end"]]) for f in row.found] == [(f["kind"], text[f["start"] : f["end"]]) for f in found]
        # what was found is nowhere left in the places that it had
        done, parts = 0, []
        for f in found:
            parts += [text[done : f["start"]], f["pseudonym"]]
            done = f["end"]
        assert "".join([*parts, text[done:]]) == new
    assert got.n_found.sum() > 20


def test_op5(spark, docs):
    got = registry.op5_toxicity(spark, SMALL).toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()


def test_op7(spark, docs):
    got = registry.op7_token_files(spark, SMALL).toPandas().set_index("doc_id")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start = 0
    for doc_id, text in sorted(zip(docs.doc_id, docs.text, strict=True)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        assert got.loc[doc_id].tolist() == [start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())]
        start += len(ids)


def test_op2(spark, docs):
    got = registry.op2_substring_dedup(spark, SMALL).toPandas()
    wanted = plain_repeats(list(zip(docs.doc_id, docs.text, strict=True)))
    told = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got.itertuples()}
    assert told == {i: (n, g, hashlib.sha256(k.encode()).hexdigest()) for i, (n, g, k) in wanted.items()}


def test_op3(spark, docs):
    got = registry.op3_language_id(spark, SMALL).toPandas().merge(docs, on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert (got.lang == got.lang_pred)[got.held_out].mean() > 0.9


def test_op4(spark, docs):
    got = registry.op4_simhash(spark, SMALL).toPandas().set_index("doc_id")
    prints = {i: plain_fingerprint(t) for i, t in zip(docs.doc_id, docs.text, strict=True)}
    assert got.fingerprint.to_dict() == {i: f"{p:016x}" for i, p in prints.items()}
    assert got.component_id.to_dict() == groups(prints)


@pytest.mark.parametrize(
    ("name", "key"), [("op2_substring_dedup", "doc_id"), ("op6_embedding_dedup", "vec_id"), ("op8_chat_formatting", "conv_id")]
)
def test_sql(spark, name, key):
    got = registry.queries()[name](spark, SMALL).toPandas().sort_values(key, ignore_index=True)
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    wanted = con.execute(registry.oracle_sql()[name]).df().sort_values(key, ignore_index=True)
    pd.testing.assert_frame_equal(got, wanted[got.columns])


def test_op9(spark, docs):
    got = registry.op9_decontamination(spark, SMALL).toPandas()
    items = pq.read_table(f"{SMALL}/benchmark.parquet").to_pandas()
    fold = {i: "".join(map(chr, decontam.fold(t)[0])) for i, t in zip(items.item_id, items.text, strict=True)}
    whole = {(d, i) for d, t in zip(docs.doc_id, docs.text, strict=True) for i, f in fold.items() if f in "".join(map(chr, decontam.fold(t)[0]))}
    assert whole <= set(zip(got.doc_id, got.item_id, strict=True))


def test_op10(spark, docs):
    got = registry.op10_sentencepiece(spark, SMALL).toPandas().set_index("doc_id")
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        ids = library.encode(text)
        sums = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        assert [len(ids), *sums] == got.loc[doc_id].tolist()


def test_pipeline(spark, docs):
    """Each stage on its own input, against plain forms of what the stages promise."""
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        before = frame
        frame = stored(stage(spark, frame, SMALL), name)
        outputs.append((name, before.toPandas(), frame))
    known, deduped, clean, private, told = outputs
    for _, _, out in outputs[:-1]:
        assert out.columns == DOCUMENTS
    model = langid.fit(spark.read.parquet(f"{SMALL}/documents.parquet"), held_out=1, folds=3)
    sure = [t is not None and (p := model.scores(t)) is not None and p.max() >= corpus_pipeline.LEAST_SCORE for t in docs.text]
    assert set(known[2].toPandas().doc_id) == set(docs.doc_id[sure])
    label = groups({i: plain_fingerprint(t) for i, t in zip(deduped[1].doc_id, deduped[1].text, strict=True)})
    assert sorted(deduped[2].toPandas().doc_id) == sorted(set(label.values()))
    items = pq.read_table(f"{SMALL}/benchmark.parquet").to_pandas()
    index = decontam.index_of(list(zip(items.item_id, items.text, strict=True)))
    free = [not decontam.leaks_of(t, index) for t in clean[1].text]
    assert sorted(clean[2].toPandas().doc_id) == sorted(clean[1].doc_id[free])
    after = private[2].toPandas().set_index("doc_id").text
    assert all(after[i] == pii.replace(t, pii.DEMO_KEY.encode())[0] for i, t in zip(private[1].doc_id, private[1].text, strict=True))
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    last = told[2].toPandas().set_index("doc_id")
    assert {i: list(x) for i, x in last.ids.items()} == {i: library.encode(t) for i, t in after.items()}
    assert (last.decoded == [library.decode(list(x)) for x in last.ids]).all()
    whole = registry.queries()["pipeline"](spark, SMALL).toPandas().set_index("doc_id")
    assert whole.decoded.to_dict() == last.decoded.to_dict()
    assert np.array_equal(np.sort(whole.index), np.sort(last.index))


@pytest.fixture
def odd_dir(spark, tmp_path):
    """Tables of odd rows, in columns that clash, beside empty ones."""
    known = [(100 + i, prose(100 + i, 60), "en" if i % 2 else "fr") for i in range(30)]
    made = documents(spark, [*odd_rows(), (8, prose(9, 40) + " mail jo@example.com"), (9, prose(9, 40)), *known])
    made = clashing(made, "fp", "spans", "h1", "best", "block")
    for name, frame in {"odd": made, "none": made.limit(0)}.items():
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        items = spark.createDataFrame([(1, prose(2, 60)), (None, None), (2, "")], "item_id long, text string")
        (items if name == "odd" else items.limit(0)).write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    return tmp_path


def test_pipeline_over_odd_rows_and_empty_tables(spark, odd_dir):
    """Every stage keeps the columns of its input, whatever they are; nothing comes of nothing."""
    frame = spark.read.parquet(f"{odd_dir}/odd/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = frame
        frame = stored(stage(spark, frame, f"{odd_dir}/odd"), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert frame.columns == before.columns
    got = {r["doc_id"]: r["decoded"] for r in frame.collect()}
    # null, empty and blank texts have no language; documents 1 and 2 hold a benchmark item
    assert not {1, 2, 3, 4, 5} & set(got)
    assert 6 in got and len(got[6].split()) == 60_000
    assert all("jo@" not in text for text in got.values())
    empty = corpus_pipeline.run(spark, f"{odd_dir}/none")
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_tokens", "ids", "decoded"]


@pytest.mark.parametrize("name", ["op11_alignment", "op12_lm_scoring"])
def test_queries_of_documents_over_odd_rows(spark, odd_dir, name):
    assert registry.queries()[name](spark, f"{odd_dir}/odd").count() == len(odd_rows()) + 32
    assert registry.queries()[name](spark, f"{odd_dir}/none").count() == 0
