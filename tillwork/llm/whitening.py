"""Whitened embeddings through Chebyshev-filtered subspace iteration.

The covariance matrix is never formed.  A pass over the fit list multiplies it with a block of vectors: every task
centres its rows, forms its part of XᵀXQ, and Spark adds the parts dimension by dimension.  A Chebyshev polynomial in the covariance,
by its three-term recurrence of such passes, damps the part of the spectrum below the block's least Ritz value; the block is made
orthonormal by QR and turned to its Ritz vectors.  That repeats until the residuals of the wanted components reach
rounding, and a fresh random block, filtered alike beside them, holds nothing that belongs among them.

The driver holds the sums of the dimensions and the block: their size is the dimension times the block, whatever the number of rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.shared import pick, ready, stored

COMPONENTS = 4
SCALE = 256
#: Vectors in the block for each wanted component.
BLOCK = 8
#: Largest degree of the polynomial, and the growth of the first component that it keeps below.
DEGREE, GROWTH = 10, 1e8
LANCZOS = 8
ROUNDS = 200
#: Residuals below this part of the first eigenvalue are rounding.
SETTLED = 1e-13

Times = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Whitening:
    """The components of a fit list of ``n`` vectors whose entries add up to ``sums``."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray  # a column each
    values: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def scales(self) -> np.ndarray:
        """What a projection is multiplied by; not a number where a component has no variance."""
        return 1 / np.sqrt(np.where(_varies(self.values), self.values, np.nan))


def _varies(values: np.ndarray) -> np.ndarray:
    return values > (64 * np.finfo(float).eps * values[0] if len(values) else 0)


def _whole(vector: Column, scale: int) -> Column:
    """floor(scale * entry) of every entry; one that is no 64-bit integer fails the query."""
    def entry(c: Column) -> Column:
        scaled = scale * c.cast("double")
        too_large = F.raise_error(F.lit("an embedding has an entry too large to be scaled")).cast("long")
        return F.when(F.abs(scaled) < float(1 << 62), F.floor(scaled)).otherwise(too_large)

    return F.transform(vector, entry)


def _sound(vector: Column) -> Column:
    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    return F.coalesce(F.forall(vector, lambda c: finite(c.cast("double"))), F.lit(False))


def scaled(embeddings: DataFrame, *, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x (array<long>) of the rows whose vector is whole and finite."""
    told = pick(embeddings, vec_id=id_col, vector=vector_col)
    return told.where(_sound(F.col("vector"))).select("vec_id", _whole(F.col("vector"), scale).alias("x"))


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    lists = batch.column(batch.schema.get_field_index(column))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count and sums of the dimensions, in chunks whose sums stay below 64 bits."""
    for batch in batches:
        if len(batch):
            x = _matrix(batch, "x")
            sums = x.sum(axis=0) if np.abs(x.astype(float)).max() * len(x) < 2.0**62 else x.astype(object).sum(axis=0)
            told = [int(s) for s in sums]
            yield pa.RecordBatch.from_pydict({"dim": list(range(len(told))), "n": [len(x)] * len(told), "s": [str(s) for s in told]})


def _multiplied(batches: Iterator[pa.RecordBatch], mean: np.ndarray, block: np.ndarray) -> Iterator[pa.RecordBatch]:
    """This partition's part of (X - mean)ᵀ(X - mean) times the block, a row for each dimension, and its squares."""
    total, squares, seen = np.zeros(block.shape), np.zeros(len(mean)), False
    for batch in batches:
        if len(batch):
            centred = _matrix(batch, "x") - mean
            total += centred.T @ (centred @ block)
            squares += (centred**2).sum(axis=0)
            seen = True
    if seen:
        columns = [pa.array(range(len(mean)), pa.int64()), pa.array(squares)]
        columns += [pa.array(np.ascontiguousarray(column)) for column in total.T]
        yield pa.RecordBatch.from_arrays(columns, ["dim", "own", *(f"q{j}" for j in range(block.shape[1]))])


class Covariance:
    """The covariance of a fit list, known only by what it does to a block of vectors."""

    def __init__(self, fit: DataFrame, n: int, mean: np.ndarray):
        self.fit, self.n, self.mean, self.passes, self.trace = fit, n, mean, 0, 0.0

    def __call__(self, block: np.ndarray) -> np.ndarray:
        """One pass over the fit list; what comes back has a row for each dimension."""
        names = [f"q{j}" for j in range(block.shape[1])]
        kind = ", ".join(["dim long", "own double", *(f"{name} double" for name in names)])
        parts = self.fit.mapInArrow(partial(_multiplied, mean=self.mean, block=block), kind)
        added = parts.groupBy("dim").agg(*[F.sum(name).alias(name) for name in ("own", *names)])
        rows = sorted(added.collect())
        self.passes += 1
        self.trace = float(sum(row["own"] for row in rows)) / self.n
        return np.array([row[2:] for row in rows]) / self.n


def lanczos_bounds(times: Times, dim: int, rng: np.random.Generator, steps: int = LANCZOS) -> tuple[float, float]:
    """An interval that holds the spectrum but for what a few Lanczos steps do not tell."""
    v, before, beta = rng.normal(size=dim), np.zeros(dim), 0.0
    v /= np.linalg.norm(v)
    diagonal, beside = [], []
    for _ in range(min(steps, dim)):
        w = times(v[:, None])[:, 0] - beta * before
        diagonal.append(v @ w)
        w -= diagonal[-1] * v
        beta = float(np.linalg.norm(w))
        beside.append(beta)
        if beta <= 1e-12 * abs(diagonal[0]):
            break
        before, v = v, w / beta
    ritz = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1))
    return max(0.0, ritz[0] - beta), ritz[-1] + beta


def chebyshev(times: Times, block: np.ndarray, image: np.ndarray, low: float, high: float, top: float) -> np.ndarray:
    """A polynomial of the matrix times the block: below 1 on [low, high], growing beyond; ``image`` is the matrix times the block."""
    centre, half = (low + high) / 2, (high - low) / 2
    reach = max((top - centre) / half, 1.0 + 1e-9)
    rate = reach + np.sqrt(reach * reach - 1)
    degree = int(np.clip(np.log(GROWTH) / np.log(rate), 1, DEGREE))
    before, now = block, (image - centre * block) / half
    for _ in range(degree - 1):
        before, now = now, 2 / half * (times(now) - centre * now) - before
    return now


def _ritz(block: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values from the largest on, the Ritz vectors of an orthonormal block, and the matrix times these."""
    inner = block.T @ image
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], block @ turn, image @ turn


def leading(times: Times, dim: int, components: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their unit vectors (columns) of a positive semi-definite matrix given by its products."""
    rng = np.random.default_rng(seed)
    size, wanted = min(dim, BLOCK * components), min(dim, components)
    low, _ = lanczos_bounds(times, dim, rng) if size < dim else (0.0, 0.0)
    block = np.linalg.qr(rng.normal(size=(dim, size)))[0]
    image, best, stalled = times(block), np.inf, 0
    for _ in range(ROUNDS):
        values, block, image = _ritz(block, image)
        rest = np.linalg.norm(image[:, :wanted] - block[:, :wanted] * values[:wanted], axis=0).max()
        stalled = stalled + 1 if rest > best / 2 else 0
        best = min(best, rest)
        if rest <= SETTLED * values[0] or (stalled >= 3 and rest <= 1e-10 * values[0]) or size == dim:
            found, vectors = values[:wanted], block[:, :wanted]
            missed = _beside(times, vectors, size, low, values, rng) if size < dim else None
            if missed is None or missed[0][0] <= found[-1] + 1e-9 * found[0]:
                return found, vectors
            # a direction that the first block had no part of goes in, in place of the last ones
            block = np.linalg.qr(np.hstack([block[:, :-wanted], missed[1][:, :wanted]]))[0]
            best, stalled = np.inf, 0
        else:
            high = max(values[-1], low + 1e-9 * values[0])
            block = np.linalg.qr(chebyshev(times, block, image, min(low, high * (1 - 1e-6)), high, values[0]))[0]
        image = times(block)
    raise RuntimeError(f"the components have not settled after {ROUNDS} rounds: residual {rest:g} of {values[0]:g}")


def _beside(
    times: Times, vectors: np.ndarray, size: int, low: float, values: np.ndarray, rng: np.random.Generator
) -> tuple[np.ndarray, np.ndarray] | None:
    """Ritz values and vectors of a fresh random block, filtered, beside the found vectors."""
    def apart(block: np.ndarray) -> np.ndarray:
        return block - vectors @ (vectors.T @ block)

    count = min(size, len(vectors) - vectors.shape[1])
    if count < 1:
        return None
    fresh = np.linalg.qr(apart(rng.normal(size=(len(vectors), count))))[0]
    high = max(values[-1], low + 1e-9 * values[0])
    told = chebyshev(lambda b: apart(times(b)), fresh, apart(times(fresh)), min(low, high * (1 - 1e-6)), high, values[0])
    fresh = np.linalg.qr(apart(told))[0]
    return _ritz(fresh, apart(times(fresh)))[:2]


def _unlike(batches: Iterator[pa.RecordBatch], mean: np.ndarray, turn: np.ndarray) -> Iterator[pa.RecordBatch]:
    """This partition's part of the products and sums of whitened values."""
    k = turn.shape[1]
    products, sums = np.zeros((k, k)), np.zeros(k)
    for batch in batches:
        if len(batch):
            white = (_matrix(batch, "x") - mean) @ turn
            products += white.T @ white
            sums += white.sum(axis=0)
    flat = [*products.ravel(), *sums]
    yield pa.RecordBatch.from_pydict({"place": list(range(len(flat))), "v": flat})


def _identity_error(fit: DataFrame, n: int, mean: np.ndarray, turn: np.ndarray) -> float:
    """Largest absolute entry of the covariance of the whitened fit list, less the identity."""
    k = turn.shape[1]
    if not k:
        return 0.0
    parts = fit.mapInArrow(partial(_unlike, mean=mean, turn=turn), "place long, v double")
    flat = np.array([row["v"] for row in sorted(parts.groupBy("place").agg(F.sum("v").alias("v")).collect())]) / n
    sums = flat[k * k :]
    return float(np.abs(flat[: k * k].reshape(k, k) - np.outer(sums, sums) - np.eye(k)).max())


def fit(rows: DataFrame, *, components: int = COMPONENTS, seed: int = 0) -> Whitening | None:
    """The whitening of the distinct vectors of ``rows`` (column x of ``scaled``); None if there are none.

    Of vectors of several lengths the length that most distinct vectors have counts, and of equally frequent ones the largest.
    """
    ready(rows.sparkSession)
    distinct = stored(rows.select("x").where("size(x) > 0").distinct(), "whitening")
    lengths = Counter({r["d"]: r["count"] for r in distinct.groupBy(F.size("x").alias("d")).count().collect()})
    if not lengths:
        return None
    dim = max(lengths, key=lambda d: (lengths[d], d))
    chosen = distinct.where(F.size("x") == dim)
    told = chosen.mapInArrow(_summed, "dim long, n long, s string")
    added = told.groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    totals = sorted(added.collect())
    n, sums = totals[0]["n"], tuple(int(r["s"]) for r in totals)
    mean = np.array([s / n for s in sums])
    times = Covariance(chosen, n, mean)
    values, vectors = leading(times, dim, components, seed)
    values = np.maximum(values, 0)
    alive = _varies(values)
    turn = vectors[:, alive] / np.sqrt(values[alive])
    return Whitening(n, sums, vectors, values, times.trace, _identity_error(chosen, n, mean, turn))


_KIND = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
_DEVIATION = pa.decimal128(38, 0)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """Sum over dimensions of (n * x - S)², exactly: in 64 bits where they suffice, else in integers of any length."""
    reach = n * int(np.abs(x.astype(float)).max(initial=0) + 1) + max(map(abs, sums))
    kind = np.int64 if len(sums) * reach * reach < 1 << 62 else object
    apart = n * x.astype(kind) - np.array(sums, kind)
    return [int(v) for v in (apart * apart).sum(axis=1)]


def _projected(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    k = len(model.values)
    turn, mean = model.vectors * model.scales, model.mean
    explained = model.values / model.trace if model.trace > 0 else np.full(k, np.nan)
    for batch in batches:
        if not len(batch):
            continue
        x = _matrix(batch, "x")
        white = ((x - mean) @ turn).ravel()
        apart = [Decimal(v) for v in _deviations(x, model.n, model.sums)]
        columns = [
            batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))),
            pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
            pa.array(np.full(len(white), model.n), pa.int64()),
            pa.array(apart, _DEVIATION).take(pa.array(np.repeat(np.arange(len(x)), k))),
            pa.array(white, mask=np.isnan(white)),
            pa.array(np.tile(explained, len(x)), mask=np.isnan(np.tile(explained, len(x)))),
            pa.array(np.full(len(white), model.identity_error)),
        ]
        names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        yield pa.RecordBatch.from_arrays(columns, names)


def project(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """One row per row of ``rows`` (see ``scaled``) and component; vectors of another length than the model's are left out."""
    if model is None:
        return rows.sparkSession.createDataFrame([], _KIND)
    ready(rows.sparkSession)
    like = rows.where(F.size("x") == len(model.sums))
    return like.mapInArrow(partial(_projected, model=model), _KIND)


def whiten(
    embeddings: DataFrame, *, components: int = COMPONENTS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """vec_id, component, n, deviation (decimal(38,0)), whitened, explained, identity_error of each row and component.

    Rows whose vector is null or holds a null or a number that is not finite are left out, and so are empty vectors and those of
    another length than most distinct vectors have (no component takes them).  Repeated rows and null ids keep
    their rows; the fit list has each vector once.  A component without variance (fewer distinct vectors
    than dimensions) has a null in ``whitened``; there are no more components than dimensions.  Other columns are ignored and an
    empty table has no rows.  An entry beyond 2^62 / scale fails the query.
    """
    rows = scaled(embeddings, scale=scale, id_col=id_col, vector_col=vector_col)
    return project(rows, fit(rows, components=components))
