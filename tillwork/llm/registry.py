"""The registered queries of the subpackage, one per operator, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import alignment, backoff, chats, decontam, idfiles, langid, pieces, pii, repeats, simhash, toxicity, vectors, whitening

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(_read(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = repeats.remove_repeats(_read(spark, sf_dir, "documents"), window=20)
    return told.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.assess(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_read(spark, sf_dir, "embeddings"), threshold=0.9)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return idfiles.digests(idfiles.round_trip(_read(spark, sf_dir, "documents"), tokenizer))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.format_chats(_read(spark, sf_dir, "conversations"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    told = pieces.decode(pieces.encode(_read(spark, sf_dir, "documents"), model), model)
    return told.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.align(_read(spark, sf_dir, "documents"), *files)


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.crc32(F.col("doc_id").cast("string")) % 5 != 1
    return backoff.score(_read(spark, sf_dir, "documents"), learn)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact deviation is a long here; where it does not fit one it is null, and ``whitening.whiten`` has it as a decimal."""
    told = whitening.whiten(_read(spark, sf_dir, "embeddings"), components=4)
    return told.withColumn("deviation", F.col("deviation").try_cast("long"))


#: Every window as text, kept where it comes first; no index.
OP2_SQL = r"""
with split as (
    select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as words from documents
),
words as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as place from split),
windows as (
    select doc_id, place as start, count(*) over ahead as size, string_agg(word, ' ') over ahead as told
    from words
    window ahead as (partition by doc_id order by place rows between current row and 19 following)
),
later as (
    select doc_id, start from (
        select doc_id, start, row_number() over (partition by told order by doc_id, start) as place
        from windows where size = 20)
    where place > 1
),
gone as (select distinct doc_id, start + step as place from later, unnest(range(20)) as steps(step)),
told as (
    select w.doc_id, count(*) as n_words, count(g.place) as n_removed,
        coalesce(string_agg(w.word, ' ' order by w.place) filter (g.place is null), '') as kept
    from words w left join gone g on g.doc_id = w.doc_id and g.place = w.place
    group by w.doc_id
)
select s.doc_id, coalesce(n_words, 0)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
    sha256(coalesce(kept, '')) as kept_sha256
from split s left join told t on t.doc_id = s.doc_id
"""

#: All pairs; the operator looks at those that share a cell.
OP6_SQL = """
with recursive sound as (
    select vec_id, embedding::double[] as v from embeddings
    where embedding is not null and vec_id is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
link as (
    select a.vec_id as a, b.vec_id as b from sound a join sound b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    where list_cosine_similarity(a.v, b.v) >= 0.9
),
reach as (
    select vec_id as a, vec_id as b from embeddings
    union
    select reach.a, link.b from reach join link on link.a = reach.b
),
degree as (select a, count(*) as n from link group by a),
lowest as (select a, min(b) as low from reach group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, low as component_id, low = vec_id as kept
from embeddings join lowest on lowest.a = vec_id left join degree on degree.a = vec_id
"""

#: Openings are compared as text here, turn by turn, where the operator compares hashes.
OP8_SQL = """
with turns as (
    select conv_id, turn, role, text, row_number() over (
        partition by conv_id order by turn nulls first, role nulls first, text nulls first) as place
    from (select distinct conv_id, turn, role, text from conversations where conv_id is not null)
),
openings as (
    select conv_id, place, count(*) over (partition by conv_id) as n,
        string_agg(coalesce(role, chr(2)) || chr(31) || coalesce(text, chr(2)), chr(30)) over (
            partition by conv_id order by place rows between unbounded preceding and current row) as opening
    from turns
),
whole as (
    select opening, place as n_turns, min(conv_id) as conv_id, count(*) as n_copies
    from openings where place = n group by opening, place
),
kept as (
    select conv_id, n_turns, n_copies from whole
    where not exists (select 1 from openings o where o.place < o.n and o.place = whole.n_turns and o.opening = whole.opening)
)
select k.conv_id, k.n_turns, k.n_copies,
    string_agg('<|' || replace(coalesce(t.role, 'unknown'), '<|', '< |') || '|>' || chr(10)
        || replace(coalesce(t.text, ''), '<|', '< |') || '<|end|>', chr(10) order by t.place) as rendered
from kept k join turns t on t.conv_id = k.conv_id
group by k.conv_id, k.n_turns, k.n_copies
"""


QUERIES: tuple[Query, ...] = (
    op1_pii,
    op2_substring_dedup,
    op3_language_id,
    op4_simhash,
    op5_toxicity,
    op6_embedding_dedup,
    op7_token_files,
    op8_chat_formatting,
    op9_decontamination,
    op10_sentencepiece,
    op11_alignment,
    op12_lm_scoring,
    op13_whitening,
)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = {"op2_substring_dedup": OP2_SQL, "op6_embedding_dedup": OP6_SQL, "op8_chat_formatting": OP8_SQL}
    found |= {"pipeline": corpus_pipeline.ORACLE_SQL}
    return {name: sql for name, sql in found.items() if sql}
