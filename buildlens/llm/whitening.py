"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance V of the vectors is never built. All that is asked of the table is the product V Q of the covariance and
a block Q of a few columns, one distributed pass each: every task centres its rows, multiplies them by Q, the result by
the transposed rows, and hands on a sum of the size of Q. Between passes the driver holds blocks of that size only.

1. A random orthonormal block, wider than the number of components asked for.
2. Rayleigh-Ritz: the eigenvalues and vectors of V within the block. The block's least Ritz value b is no greater than
   the eigenvalue of that place, so all wanted ones lie above it.
3. A Chebyshev polynomial of V, by its three-term recurrence: on [0, b], the unwanted part of the spectrum, it stays
   within one, above b it grows as fast as a polynomial can. It is of a degree at which the greatest growth is still
   harmless to rounding; components that are found already are projected out and do not count for that.
4. QR, and again from 2, until certified: the residual |V q - e q| of each wanted component is at rounding, and a fresh
   random column that went through the last filter has brought nothing above the least of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildlens.llm.common import written

#: A component c becomes floor(SCALE * c) + SHIFT; beyond +-LIMIT it stays there (doubles hold such integers exactly).
SCALE, SHIFT, LIMIT = 1024, 100_000, 1 << 52
#: Columns of the block beyond the wanted ones, and the greatest degree of the filter.
GUARDS, DEGREE = 24, 10
#: Growth of one filter that rounding allows.
GROWTH = 1e8
#: Residual, as a share of the greatest eigenvalue, at which a component is found, and passes after which it must be.
RESIDUAL, PASSES = 2e-14, 600
#: An eigenvalue of a smaller share of the trace is rounding, not a component.
NOUGHT = 1e-12


@dataclass
class Centre:
    """Size of the table and its mean as an integer part and a rest, so that centring is exact but for the last digit."""

    n: int
    sums: list[int]
    #: greatest distance of an entry from the integer part
    reach: int

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """Sums that the integer part leaves, below n."""
        return np.array([s % self.n for s in self.sums], np.int64)


@dataclass
class Whitening:
    """Eigenvectors as columns, by falling eigenvalue, and the trace of the covariance."""

    centre: Centre
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    #: residuals of the eigenvectors, and distributed passes made
    residuals: np.ndarray
    passes: int


def integers(vectors: DataFrame, id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """id, x: the rows whose vector is not null and holds finite entries only, as integers."""
    entry = F.col(embedding)
    finite = F.forall(entry, lambda c: F.abs(c.cast("double")) < F.lit(math.inf))
    scaled = F.transform(
        entry,
        lambda c: F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))) + SHIFT,
    )
    return vectors.filter(entry.isNotNull() & finite).select(F.col(id).alias("id"), scaled.alias("x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers; a vector shorter than the longest one has zero entries there."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) * width == len(values) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.full((len(sizes), width), SHIFT, np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def measure(rows: DataFrame) -> Centre:
    """Exact counts, sums and extremes of the dimensions."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            width = int(column.value_lengths().to_numpy(zero_copy_only=False).max(initial=0))
            x = matrix(column, width)
            dims, shifted = np.arange(-1, width), x - SHIFT
            # sums in two halves: no partial sum leaves 64 bits
            parts = [np.concatenate([[0], f(shifted)]) for f in (_high, _low, _least, _most)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.astype(np.int64)) for a in (dims, np.full(width + 1, len(x)), *parts)],
                ["dim", "n", "high", "low", "least", "most"],
            )

    found = (
        rows.select("x")
        .mapInArrow(partial, "dim long, n long, high long, low long, least long, most long")
        .groupBy("dim")
        .agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")], F.min("least").alias("least"), F.max("most").alias("most"))
        .orderBy("dim")
        .collect()
    )
    if not found:
        return Centre(0, [], 0)
    n = found[0]["n"]
    sums = [(r["high"] << 26) + r["low"] + n * SHIFT for r in found[1:]]
    reach = 0
    for r, s in zip(found[1:], sums):
        # rows without this dimension hold SHIFT, that is zero here
        least, most = min(r["least"], 0) + SHIFT, max(r["most"], 0) + SHIFT
        reach = max(reach, most - s // n, s // n - least)
    return Centre(n, sums, reach)


def _high(x: np.ndarray) -> np.ndarray:
    return (x >> 26).sum(0)


def _low(x: np.ndarray) -> np.ndarray:
    return (x & ((1 << 26) - 1)).sum(0)


def _least(x: np.ndarray) -> np.ndarray:
    return x.min(0, initial=0)


def _most(x: np.ndarray) -> np.ndarray:
    return x.max(0, initial=0)


def centred(x: np.ndarray, centre: Centre) -> np.ndarray:
    return (x - centre.whole).astype(np.float64) - centre.rest / centre.n


def deviations(x: np.ndarray, centre: Centre) -> pa.Array:
    """The sum over dimensions of (n * x - sum) ** 2 of each row, exactly; null where 64 bits do not hold it."""
    most = centre.n * (centre.reach + 1)
    if most * most * max(1, x.shape[1]) < 1 << 63:
        own = centre.n * (x - centre.whole) - centre.rest
        return pa.array((own * own).sum(1))
    own = centre.n * (x - centre.whole).astype(object) - centre.rest.astype(object)
    return pa.array([s if s < 1 << 63 else None for s in ((row * row).sum() for row in own)], pa.int64())


def _added(rows: DataFrame, terms, shape: tuple[int, int]) -> np.ndarray:
    """The sum over all rows of a matrix that ``terms`` makes of a batch of them: added per task, then by Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            total += terms(batch.column(0))
        columns = [pa.array(np.arange(shape[0])), *[pa.array(total[:, j].copy()) for j in range(shape[1])]]
        yield pa.RecordBatch.from_arrays(columns, ["line", *names])

    names = [f"c{j}" for j in range(shape[1])]
    schema = "line long, " + ", ".join(f"{c} double" for c in names)
    found = rows.select("x").mapInArrow(partial, schema).groupBy("line").agg(*[F.sum(c).alias(c) for c in names]).collect()
    out = np.zeros(shape)
    for r in found:
        out[r["line"]] = r[1:]
    return out


def product(rows: DataFrame, centre: Centre, block: np.ndarray) -> np.ndarray:
    """V Q: one pass over the rows."""

    def terms(column: pa.Array) -> np.ndarray:
        a = centred(matrix(column, len(block)), centre)
        return a.T @ (a @ block)

    return _added(rows, terms, block.shape) / centre.n


def chebyshev(apply, block: np.ndarray, found: np.ndarray, bound: float, top: float, degree: int) -> np.ndarray:
    """The block under the polynomial of the given degree that is least on [0, bound], scaled by its size at ``top``.

    What lies along the columns of ``found`` is projected out at every step.
    """

    def away(x: np.ndarray) -> np.ndarray:
        return x - found @ (found.T @ x)

    half = bound / 2
    sigma = half / (top - half)
    tau = 2 / sigma
    before, now = away(block), None
    now = away(apply(before) - half * before) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (tau - sigma)
        step = away(apply(now) - half * now) * (2 * after / half) - sigma * after * before
        before, now, sigma = now, step, after
    return away(now)


def fit(rows: DataFrame, components: int = 8, seed: int = 0) -> Whitening:
    """The leading eigenvectors of the covariance of ``rows`` (x), a written table: it is read once per pass."""
    centre = measure(rows)
    width, passes = len(centre.sums), 0
    if not centre.n or not width:
        return Whitening(centre, np.zeros((width, 0)), np.zeros(0), 0.0, np.zeros(0), 0)

    def squares(column: pa.Array) -> np.ndarray:
        return (centred(matrix(column, width), centre) ** 2).sum(0)[:, None]

    trace = float(_added(rows, squares, (width, 1)).sum() / centre.n)
    rng = np.random.default_rng(seed)
    block = np.linalg.qr(rng.standard_normal((width, min(width, components + GUARDS))))[0]

    def apply(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return product(rows, centre, q)

    filtered, best, least = block.shape[1] == width, math.inf, None
    while True:
        image = apply(block)
        inner = block.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        wanted = int((values[:components] > NOUGHT * trace).sum())
        residuals = np.linalg.norm(image - block * values, axis=0)
        worst = residuals[:wanted].max(initial=0)
        at_rounding = worst <= RESIDUAL * values[0] or (worst <= 1e-11 * values[0] and worst > best / 2)
        # the first filter after a new least wanted value must have confirmed it
        settled = least is not None and wanted == least[0] and (not wanted or abs(values[wanted - 1] / least[1] - 1) < 1e-9)
        if block.shape[1] == width or (filtered and at_rounding and settled) or not trace > 0:
            break
        if passes > PASSES:
            raise RuntimeError(f"not certified after {passes} passes: residual {worst:.1e} of {values[0]:.1e}")
        best, least = min(best, worst), (wanted, values[wanted - 1] if wanted else 0.0)
        done = 0
        while done < wanted and residuals[done] <= RESIDUAL * values[0]:
            done += 1
        done = min(done, max(0, wanted - 1))
        bound = max(values[-1], NOUGHT * trace)
        growth = math.acosh(max(2 * values[done] / bound - 1, 1 + 1e-9))
        degree = max(1, min(DEGREE, int(math.log(2 * GROWTH) / growth)))
        fresh = np.concatenate([block[:, done:-1], rng.standard_normal((width, 1)) / math.sqrt(width)], axis=1)
        rest = chebyshev(apply, fresh, block[:, :done], bound, max(values[done], bound * (1 + 1e-6)), degree)
        block, filtered = np.linalg.qr(np.concatenate([block[:, :done], rest], axis=1))[0], True
    return Whitening(centre, block[:, :wanted], values[:wanted], trace, residuals[:wanted], passes)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The greatest entry of the whitened rows' covariance less the identity, by absolute value."""
    k, n = len(model.values), model.centre.n
    if not k:
        return 0.0

    def terms(column: pa.Array) -> np.ndarray:
        w = projected(matrix(column, len(model.vectors)), model)
        return np.concatenate([w.T @ w, w.sum(0)[None]])

    found = _added(rows, terms, (k + 1, k)) / n
    return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())


def projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    return centred(x, model.centre) @ model.vectors / np.sqrt(model.values)


def transform(rows: DataFrame, model: Whitening, error: float) -> DataFrame:
    """One row for each row of ``rows`` (id, x) and component."""
    k, width = len(model.values), len(model.vectors)
    explained = model.values / model.trace if k else model.values
    id_type = rows.schema["id"].dataType.simpleString()

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), width)
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), model.centre.n)),
                    deviations(x, model.centre).take(each),
                    pa.array(projected(x, model).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(each), error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.select("id", "x").mapInArrow(whiten, schema)


def whitened(vectors: DataFrame, id: str = "vec_id", embedding: str = "embedding", components: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and component.

    A row whose vector is null or holds a null or non-finite entry is no usable row. A vector shorter than the longest
    one has zeros in its place, an empty one too. A row with a null id stays, with that id; repeated rows count and
    come as often as they are there; other columns are not looked at. Components whose eigenvalue is nought (constant
    or dependent dimensions, a single row, equal rows) are left out, so there may be fewer than ``components``, or
    none: then, as for an empty table, the result is empty. Equal eigenvalues may have any basis of their plane.
    """
    rows = written(integers(vectors, id, embedding), "integers")
    model = fit(rows, components)
    return transform(rows, model, identity_error(rows, model))
