"""The corpus pipeline: documents in, token ids and round-trip text of the kept ones out.

Each stage takes (spark, docs, sf_dir) and works on what the stage before kept; its rows are written as Parquet to the shared
folder and read again as the next stage's ``docs``.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import decontam, langid, pieces, pii, simhash
from tillwork.llm.shared import ready, stored

#: Documents whose language is less sure than this go, and those without a letter.
LEAST_SCORE = 0.3
#: Documents go whose share of learnt n-grams is below this part of the usual one: those in no learnt language, and noise.
LEAST_KNOWN = 0.5

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that are in one of the learnt languages, surely enough."""
    model = langid.fit(docs, held_out=1, folds=3)
    return langid.keep_identified(docs, model, least_score=LEAST_SCORE, least_known=LEAST_KNOWN)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group: the one of smallest id."""
    return simhash.keep_first(docs, shingle=3, max_bits=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return decontam.remove_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts."""
    return pii.pseudonymise_rows(docs)


def sentencepiece_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded: the ids of each text and the text that they decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    told = pieces.decode(pieces.encode(docs, model), model)
    return told.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_pseudonyms", pii_pseudonyms),
    ("sentencepiece_round_trip", sentencepiece_round_trip),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
