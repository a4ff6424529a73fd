"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

Fingerprints that differ in at most ``max_bits`` of 64 bits agree on all bits of some ``blocks - max_bits`` out of ``blocks``
blocks.  Every fingerprint is filed under each such choice of blocks with the bits it has there; only
fingerprints filed together are compared.  Documents of one fingerprint are one row there, however many they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tillwork.llm.components import components
from tillwork.llm.shared import documents, numbered, ready, stored, texts

SEED = 42
BITS = 64


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of a text's word shingles as an unsigned integer; 0 without words."""
    words = text.encode().lower().split() if text else []  # both know the ASCII letters and spaces only
    if len(words) <= shingle:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = [b" ".join(s) for s in zip(*(words[i:] for i in range(shingle)), strict=False)]
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65_536):
        part = hashes[i : i + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(text, shingle) for text in texts(batch)], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])


def _row_fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(text, shingle) for text in texts(batch)], np.uint64).view(np.int64)
        columns = [batch.column(0), batch.column(2), batch.column(3), pa.array(found, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h1", "h2", "fp"])


def fingerprints(docs: DataFrame, *, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a long), one row per input row."""
    ready(docs.sparkSession)
    told = documents(docs, id_col, text_col)
    return told.mapInArrow(partial(_fingerprints, shingle=shingle), "doc_id long, fp long")


def _masks(max_bits: int, blocks: int) -> list[int]:
    """The bits of every choice of blocks that a close pair may agree on, as signed 64-bit integers."""
    bounds = [round(BITS * i / blocks) for i in range(blocks + 1)]
    bits = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(bounds, bounds[1:], strict=False)]
    chosen = [sum(some) for some in combinations(bits, blocks - max_bits)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in chosen]


def links(distinct: DataFrame, *, max_bits: int = 3, blocks: int = 6) -> DataFrame:
    """a, b: all pairs of the different fingerprints ``fp`` that differ in at most ``max_bits`` bits, once each."""
    if not max_bits < blocks <= BITS:
        raise ValueError("more blocks than differing bits are needed")
    masks = _masks(max_bits, blocks)
    keys = F.array(*(F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)))
    filed = distinct.select("fp", F.inline(keys))
    left = filed.withColumnRenamed("fp", "a")
    right = filed.withColumnRenamed("fp", "b")
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    pairs = left.join(right, ["choice", "bits"]).where(close)
    return pairs.select("a", "b").distinct()


def _labels(classes: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """fp, label (equal for the fingerprints of one component), for every fingerprint of ``classes``."""
    found = components(links(classes.select("fp"), max_bits=max_bits, blocks=blocks))
    told = classes.join(found, classes["fp"] == found["node"], "left")
    return told.select(*classes.columns, F.coalesce("component", "fp").alias("label"))


def near_duplicates(
    docs: DataFrame,
    *,
    shingle: int = 3,
    max_bits: int = 3,
    blocks: int = 6,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links).

    Null texts and texts without words have fingerprint zero and link as any other; repeated rows share a
    fingerprint and hence a component; a null doc_id is never a component_id unless all of a component's are null.  Other
    columns are ignored; an empty table has no rows.
    """
    prints = stored(fingerprints(docs, shingle=shingle, id_col=id_col, text_col=text_col), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    labelled = _labels(classes, max_bits, blocks)
    first = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_class = labelled.join(first, "label").select(F.col("fp").alias("of_fp"), "component_id")
    return prints.join(of_class, F.col("fp") == F.col("of_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(
    docs: DataFrame,
    *,
    shingle: int = 3,
    max_bits: int = 3,
    blocks: int = 6,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of each component of near duplicates (see ``near_duplicates``), with all its columns.

    That of smallest id stays.  Of several rows with that id, in one component, that of smallest hash of all its columns
    stays, whatever the order in which they come; rows of one id whose texts are no near duplicates are in components of their own
    and each can stay.  Rows without an id cannot stand for a group, and all stay.  An empty table has no rows.
    """
    flat, key, text = numbered(docs), f"c{docs.columns.index(id_col)}", f"c{docs.columns.index(text_col)}"
    plain = [f.name for f in flat.schema if not isinstance(f.dataType, MapType)]
    marked = flat.withColumns(
        {"h1": F.xxhash64(*plain, *[F.col(c).isNull() for c in plain]), "h2": F.xxhash64(F.lit(1), *plain, *[F.col(c).isNull() for c in plain])}
    )
    row = [key, "h1", "h2"]
    told = marked.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *[F.col(c) for c in ("h1", "h2")])
    kind = "doc_id long, h1 long, h2 long, fp long"
    prints = stored(told.mapInArrow(partial(_row_fingerprints, shingle=shingle), kind), "row-fingerprints")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2")).alias("best")
    labelled = _labels(prints.groupBy("fp").agg(best), max_bits, blocks)
    first = labelled.groupBy("label").agg(F.min("best").alias("best")).select("best.doc_id", "best.h1", "best.h2")
    same = [marked[key].cast("long") == first["doc_id"], marked["h1"] == first["h1"], marked["h2"] == first["h2"]]
    # rows that are alike in all columns are one
    kept = marked.join(first, same, "left_semi").dropDuplicates(row).select(*flat.columns)
    return kept.unionByName(flat.where(F.col(key).isNull())).toDF(*docs.columns)
