"""Embedding near-duplicates: randomised-rotation binary codes with correction factors, and exact checks where they don't decide.

A unit vector is rotated at random and each coordinate is replaced by its sign.  With the stored factor of a code (the
inner product of the vector and its code's direction), the inner product of two vectors has an unbiased estimate from
one code and the other vector's rotation, with an error bound that holds at the chosen confidence.  A pair whose
upper bound misses the threshold is dropped; every other pair is recomputed exactly in double precision.

Pairs come from tables of signs: each table files a vector under some signs of a rotation of its own, and vectors that are filed
together are compared.  The number of signs grows with the logarithm of the number of vectors, and the number of tables
is what gives a pair just at the threshold the chosen chance to meet.  Equal vectors are one row.

Only codes go to the tables.  Two codes differ in each sign with a chance that is the vectors' angle over pi, so a pair whose codes
differ in more signs than the threshold's angle allows, at the chosen confidence, is dropped there; the vectors themselves are
fetched only for those cells and vectors that have a pair left.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.components import components
from tillwork.llm.shared import pick, ready, stored

SEED = 20_240_607
#: Chance that a pair just at the threshold shares a table.
RECALL = 0.96
#: Vectors that a table's cell holds on average, about.
PER_CELL = 256
#: Standard deviations of the estimate's error within which a pair is recomputed.
CONFIDENCE = 5.0
#: The same for the signs in which two codes differ, before vectors are fetched: one pair at the threshold in some thousands is lost.
SIEVE = 3.5
#: Rows of a cell, about, beyond which it is split into chunks whose pairs are tasks of their own.
CHUNK = 2048
#: Rows that are compared with each other at a time.
SIDE = 512


@cache
def rotation(dim: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is made."""
    made = np.random.default_rng([SEED, dim, number]).standard_normal((dim, dim))
    q, r = np.linalg.qr(made)
    return q * np.sign(np.diag(r))


def tables_for(vectors: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """Signs of a table, and tables, for so many vectors."""
    signs = max(4, math.ceil(math.log2(max(2, vectors) / PER_CELL)))
    same = (1 - math.acos(threshold) / math.pi) ** signs
    return signs, max(1, math.ceil(math.log(1 - recall) / math.log1p(-same)))


def scaled(vectors: list) -> np.ndarray:
    """Rows in double precision, each times a power of two so that no square overflows or vanishes."""
    rows = np.array(vectors, float)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def cells(units: np.ndarray, signs: int, tables: int) -> np.ndarray:
    """The cell of every vector in every table."""
    dim = units.shape[1]
    per = max(1, dim // signs) if dim >= signs else 1
    weights = 1 << np.arange(signs, dtype=np.int64)
    found, turned, used = np.zeros((len(units), tables), np.int64), None, 0
    for t in range(tables):
        if dim >= signs:
            if t % per == 0:
                turned = units @ rotation(dim, 1 + t // per).T >= 0
            bits = turned[:, (t % per) * signs : (t % per + 1) * signs]
        else:  # few dimensions: signs of as many rotations as it takes
            parts = [units @ rotation(dim, 1 + used + i).T >= 0 for i in range(-(-signs // dim))]
            bits, used = np.concatenate(parts, axis=1)[:, :signs], used + len(parts)
        found[:, t] = bits @ weights
    return found


def encode(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated vectors, and the correction factor of each: its inner product with its code's direction."""
    turned = units @ rotation(units.shape[1], 0).T
    return np.packbits(turned >= 0, axis=1, bitorder="little"), np.abs(turned).sum(axis=1) / math.sqrt(units.shape[1])


def undecided(codes: np.ndarray, factors: np.ndarray, units: np.ndarray, threshold: float, confidence: float = CONFIDENCE) -> np.ndarray:
    """Which pairs (row of ``units``, row of ``codes``) the codes cannot rule out.

    The code's direction o' satisfies <o', q> = f <o, q> + sqrt(1 - f f) <e, q> for a direction e that is uniform among those
    at right angles to o; so <o', q> / f is unbiased for <o, q>, and its error has standard deviation
    sqrt((1 - f f) / f f) sqrt(1 - <o, q>^2) / sqrt(dim - 1).
    """
    dim = units.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim, bitorder="little").astype(np.float32) * 2 - 1
    turned = (units @ rotation(dim, 0).T).astype(np.float32)
    estimate = turned @ signs.T / np.float32(math.sqrt(dim)) / factors.astype(np.float32)
    spread = np.sqrt(np.maximum(0, 1 - factors**2)) / factors * math.sqrt(1 - threshold**2) / math.sqrt(max(1, dim - 1))
    return estimate >= threshold - confidence * spread - 1e-5


def _coded(batches: Iterator[pa.RecordBatch], signs: int, tables: int) -> Iterator[pa.RecordBatch]:
    """Code, factor and cells of each class; vectors of different lengths never share a cell."""
    for batch in batches:
        vectors = batch.column("vector").to_pylist()
        for dim in sorted({len(v) for v in vectors}):
            which = [i for i, v in enumerate(vectors) if len(v) == dim]
            units = unit(scaled([vectors[i] for i in which]))
            codes, factors = encode(units)
            part = batch.take(which)
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns,
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(factors),
                    pa.array(cells(units, signs, tables).tolist(), pa.list_(pa.int64())),
                ],
                [*part.schema.names, "code", "factor", "cells"],
            )


def most_differing(dim: int, threshold: float, confidence: float = SIEVE) -> float:
    """Signs in which the codes of a pair at the threshold differ at most, at this confidence."""
    chance = math.acos(threshold) / math.pi
    return dim * chance + confidence * math.sqrt(dim * chance * (1 - chance)) + 0.5


def _near(a: np.ndarray, b: np.ndarray, most: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of two tables of codes have a row in the other whose code is near; of one table, another row."""
    left, right = np.zeros(len(a), bool), np.zeros(len(b), bool)
    for i in range(0, len(a), SIDE):
        for j in range(0, len(b), SIDE):
            differing = np.bitwise_count(a[i : i + SIDE, None] ^ b[None, j : j + SIDE]).sum(axis=2)
            close = differing <= most
            if same and i == j:
                np.fill_diagonal(close, False)
            left[i : i + SIDE] |= close.any(axis=1)
            right[j : j + SIDE] |= close.any(axis=0)
    return left, right


def _sieved(key: tuple, rows: pa.Table, threshold: float) -> pa.Table:
    """The classes of one pair of chunks that have a partner by their codes."""
    dim, low, high = (key[i].as_py() for i in (2, 3, 4))
    size = -(-dim // 64) * 8
    codes = np.frombuffer(b"".join(c.ljust(size, b"\0") for c in rows["code"].to_pylist()), "<u8").reshape(len(rows), -1)
    side, ids = rows["side"].to_numpy(), rows["class_id"].to_numpy()
    at, beside = np.flatnonzero(side == low), np.flatnonzero(side == high)
    left, right = _near(codes[at], codes[beside], most_differing(dim, threshold), low == high)
    kept = np.unique(np.concatenate([at[left], beside[right]]))
    told = {name: [value.as_py()] * len(kept) for name, value in zip(_PLACE, key, strict=True)}
    return pa.table({name: pa.array(v, pa.int64()) for name, v in told.items()} | {"side": side[kept].astype(np.int64), "class_id": ids[kept]})


_PLACE = ("table", "cell", "dim", "low", "high")


class Cell:
    """Rows of one chunk of a cell."""

    def __init__(self, rows: pa.Table, signs: int, tables: int):
        self.ids, self.copies, self.factors = (rows[c].to_numpy() for c in ("class_id", "copies", "factor"))
        self.rows = scaled(rows["vector"].to_pylist())
        self.norms = np.linalg.norm(self.rows, axis=1)
        self.units = unit(self.rows)
        self.codes = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(self.ids), -1)
        self.cells = cells(self.units, signs, tables)  # those of the tables before this one


def _links(a: Cell, b: Cell, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked rows of two chunks (or of one, then each pair once) that meet in no earlier table."""
    found = [(np.zeros(0, int), np.zeros(0, int))]
    for i in range(0, len(a.ids), SIDE):
        for j in range(i if a is b else 0, len(b.ids), SIDE):
            x, y = np.nonzero(undecided(b.codes[j : j + SIDE], b.factors[j : j + SIDE], a.units[i : i + SIDE], threshold))
            x, y = x + i, y + j
            if a is b:
                x, y = x[x < y], y[x < y]
            if a.cells.shape[1]:
                new = ~(a.cells[x] == b.cells[y]).any(axis=1)
                x, y = x[new], y[new]
            exact = np.einsum("ij,ij->i", a.rows[x], b.rows[y]) / (a.norms[x] * b.norms[y])
            found.append((x[exact >= threshold], y[exact >= threshold]))
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _forest(a: np.ndarray, b: np.ndarray) -> dict[int, int]:
    """For each node of these links the smallest one that they join it with."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(x), root(y)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in list(parent)}


def _compared(key: tuple, rows: pa.Table, signs: int, threshold: float) -> pa.Table:
    """Links of one pair of chunks: each class, the copies it is linked with here, and the smallest class it is joined with here."""
    table, low, high = (key[i].as_py() for i in (0, 3, 4))
    side = rows["side"].to_numpy()
    a = Cell(rows.filter(side == low), signs, table)
    b = a if low == high else Cell(rows.filter(side == high), signs, table)
    x, y = _links(a, b, threshold)
    ids = np.concatenate([a.ids[x], b.ids[y]])
    nodes, back = np.unique(ids, return_inverse=True)
    sums = np.zeros(len(nodes), np.int64)
    np.add.at(sums, back, np.concatenate([b.copies[y], a.copies[x]]))
    joined = _forest(a.ids[x], b.ids[y])
    return pa.table(
        {
            "class_id": pa.array(nodes, pa.int64()),
            "links": pa.array(sums, pa.int64()),
            "peer": pa.array([joined[n] for n in nodes.tolist()], pa.int64()),
        }
    )


def _pairs(classes: DataFrame, signs: int, tables: int, threshold: float) -> DataFrame:
    """class_id, links, peer: what each pair of chunks of each cell found."""
    vector = classes.schema["vector"].dataType.simpleString()
    kind = f"class_id long, copies long, vector {vector}, code binary, factor double, cells array<long>"
    told = classes.select("class_id", "copies", "vector")
    coded = stored(told.mapInArrow(partial(_coded, signs=signs, tables=tables), kind), "codes")
    dim = F.size("vector").cast("long").alias("dim")
    filed = coded.select("class_id", "code", dim, F.posexplode("cells").alias("table", "cell"))
    filed = filed.withColumn("table", F.col("table").cast("long"))
    cell = ["table", "cell", "dim"]
    large = filed.groupBy(*cell).count().where(F.col("count") > CHUNK)
    chunks = F.coalesce(F.ceil(F.col("count") / CHUNK), F.lit(1)).cast("int")
    split = filed.join(large, cell, "left").withColumn("chunks", chunks).drop("count")
    split = split.withColumn("side", F.pmod(F.xxhash64("class_id"), F.col("chunks")))
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    placed = split.select(*cell, F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "class_id", "code")
    sieve, compare = partial(_sieved, threshold=threshold), partial(_compared, signs=signs, threshold=threshold)
    near = placed.groupBy(*_PLACE).applyInArrow(
        lambda key, rows: sieve(key, rows), ", ".join(f"{name} long" for name in (*_PLACE, "side", "class_id"))
    )
    rows = coded.select("class_id", "copies", "vector", "code", "factor")
    fetched = stored(near, "near").join(rows, "class_id")
    return fetched.groupBy(*_PLACE).applyInArrow(lambda key, rows: compare(key, rows), "class_id long, links long, peer long")


def near_duplicates(
    vectors: DataFrame,
    *,
    threshold: float = 0.9,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id (smallest vec_id reachable), kept.

    Two vectors are linked if they share a table's cell and their cosine in double precision reaches ``threshold``.  A vector that is
    null, empty, zero or holds a null or non-finite component, and one without an id, links with nothing and is its own
    component; so do vectors of different lengths.  Repeated rows are vectors of their own that link with each other; rows of one
    id with different vectors each have their own links.  Other columns are ignored; an empty table has no rows.
    """
    ready(vectors.sparkSession)
    told = pick(vectors, vec_id=id_col, vector=vector_col)
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    sound = F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    told = told.withColumn("vector", F.when(F.coalesce(sound, F.lit(False)), F.col("vector")))
    valid = told.where("vector is not null")
    classes = valid.groupBy("vector").agg(F.min("vec_id").cast("long").alias("first_id"), F.count("*").alias("copies"))
    # an id may have several vectors, so classes are numbered; the numbers hold once they are written
    classes = stored(classes.select(F.monotonically_increasing_id().alias("class_id"), "first_id", "copies", "vector"), "classes")
    found = stored(_pairs(classes, *tables_for(classes.count(), threshold, recall), threshold), "links")
    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    labels = components(found, "class_id", "peer").select(F.col("node").alias("class_id"), "component")
    labelled = classes.join(links, "class_id", "left").join(labels, "class_id", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "class_id"))
    first = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = labelled.join(first, "component").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    ids = told.join(known, "vector", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return ids.withColumn("kept", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)))
