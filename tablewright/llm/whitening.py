"""Whitening of vectors with eigenvectors found by a block Jacobi-Davidson method.

The covariance is never formed. All the solver asks for is its product with a few columns, one pass over the distinct
vectors: tasks centre their vectors first, multiply, and add up, and sums of (dimension x columns) numbers come back.
The driver keeps a search space of a few dozen columns, does Rayleigh-Ritz in it, and locks pairs from the largest on
as their residuals reach double precision. The others get correction equations, projected against all Ritz vectors and
solved by a few steps of MINRES; the steps of all columns are taken together, so that they share their passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import id_type, written
from tablewright.llm.vectors import is_finite

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Integers up to here are taken: sums over any table stay exact, and quotients keep their digits.
LARGEST = float(1 << 40)
#: Bytes of vectors in a row of the fit list.
BLOCK_BYTES = 1 << 19
#: A residual is converged at this share of the largest eigenvalue.
RESIDUAL = 1e-13
#: Eigenvalues up to this share of the largest are rounding: there is no component.
RANK = 1e-11
#: Every inner step is a pass over the vectors; a few keep their number smallest.
INNER_STEPS, INNER_REDUCTION, OUTER_STEPS = 3, 0.05, 200
SEED = 20_240_711

Product = Callable[[np.ndarray], np.ndarray]


def whole_vectors(table: DataFrame, vector_col: str, scale: int, shift: int, name: str = "x") -> DataFrame:
    """Rows with finite vectors, as longs ``floor(scale * c) + shift`` in column ``name``, ending in zeros up to the widest.

    Components too large for whole numbers that add up exactly are an error.
    """
    finite = table.where(is_finite(F.col(vector_col)))
    width = finite.agg(F.max(F.size(vector_col))).first()[0] or 0

    def whole(c):
        scaled = c.cast("double") * scale
        too_large = F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST:.0f}")).cast("long")
        return F.when(F.abs(scaled) <= LARGEST, F.floor(scaled) + shift).otherwise(too_large)

    missing = F.array_repeat(F.lit(shift).cast("long"), F.lit(width) - F.size(vector_col))
    return finite.withColumn(name, F.concat(F.transform(vector_col, whole), missing))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(-1, width)


def _packed(vectors: DataFrame, width: int) -> DataFrame:
    """Vectors of equal width in blocks of bytes, which pass to Python as they are."""
    rows = max(1, BLOCK_BYTES // (8 * width))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), width)
            blocks = [x[k : k + rows].tobytes() for k in range(0, len(x), rows)]
            if blocks:
                yield pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.binary())})

    return vectors.mapInArrow(pack, "block binary")


class FitList:
    """The distinct vectors, spread over the cluster, with their number and exact sums."""

    def __init__(self, vectors: DataFrame) -> None:
        """``vectors`` has one column of arrays of longs, all of one width."""
        first = vectors.first()
        self.width = len(first[0]) if first else 0
        self.n, self.sums = 0, []
        if not self.width:
            return
        width = self.width
        self.blocks = written(_packed(vectors.distinct(), width), "fit-list")

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in batch.column(0):
                    x = np.frombuffer(block.as_buffer(), "int64").reshape(-1, width)
                    yield pa.RecordBatch.from_pydict(
                        {"place": np.arange(-1, width), "total": np.concatenate([[len(x)], x.sum(0)])}
                    )

        parts = self.blocks.mapInArrow(added, "place long, total long")
        totals = {r.place: int(r.total) for r in parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()}
        self.n = totals[-1]
        self.sums = [totals[k] for k in range(width)]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums`` exactly: longs, or Python's integers where these do not fit."""
        largest = max(float(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums)))
        if largest < 2.0**61:
            return x * self.n - np.array(self.sums, "int64")
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype("float64")

    def sum_over(self, size: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of ``of(centred block)``, ``size`` numbers, over all blocks; one pass."""
        width, fit = self.width, _Centring(self)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                for block in batch.column(0):
                    total += of(fit.centred(np.frombuffer(block.as_buffer(), "int64").reshape(-1, width)))
            yield pa.RecordBatch.from_pydict({"place": np.arange(size), "total": total})

        parts = self.blocks.mapInArrow(partial, "place long, total double")
        out = np.zeros(size)
        for r in parts.groupBy("place").agg(F.sum("total").alias("total")).collect():
            out[r.place] = r.total
        return out

    def trace(self) -> float:
        return float(self.sum_over(1, lambda c: np.array([(c * c).sum()]))[0]) / self.n

    def product(self, columns: np.ndarray) -> np.ndarray:
        """The covariance times ``columns``, of which there are few."""
        sums = self.sum_over(columns.size, lambda c: (c.T @ (c @ columns)).ravel())
        return sums.reshape(columns.shape) / self.n

    def covariance_of(self, weights: np.ndarray) -> np.ndarray:
        """The covariance of the centred vectors times ``weights``, from these products themselves."""
        k = weights.shape[1]

        def moments(c: np.ndarray) -> np.ndarray:
            w = c @ weights
            return np.concatenate([w.sum(0), (w.T @ w).ravel()])

        sums = self.sum_over(k + k * k, moments) / self.n
        return sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k])


class _Centring(FitList):
    """What tasks need of a fit list; it holds no table."""

    def __init__(self, fit: FitList) -> None:
        self.n, self.sums = fit.n, fit.sums


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to orthonormal columns; directions that are all rounding go."""
    basis = np.concatenate(against, axis=1)
    lengths = np.linalg.norm(new, axis=0)
    new = new[:, lengths > 0] / lengths[lengths > 0]
    for _ in range(2):
        new = new - basis @ (basis.T @ new)
    left, sizes, _ = np.linalg.svd(new, full_matrices=False)
    left = left[:, sizes > 1e-8]
    left = left - basis @ (basis.T @ left)
    return np.linalg.qr(left)[0] if left.shape[1] else left


def minres_together(operator: Callable[[np.ndarray, np.ndarray], np.ndarray], right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of symmetric systems, one per column of ``right``, by MINRES steps taken together.

    ``operator(columns, which)`` applies the systems ``which`` to one column each. A column stops where its residual
    has fallen to ``INNER_REDUCTION``.
    """
    count = right.shape[1]
    solution, w, w2 = (np.zeros_like(right) for _ in range(3))
    r1, r2, y = right.copy(), right.copy(), right.copy()
    first = np.linalg.norm(right, axis=0)
    beta, left = first.copy(), first.copy()
    old_beta, d_bar, epsilon, sine = (np.zeros(count) for _ in range(4))
    cosine = -np.ones(count)
    on = np.flatnonzero(first > 0)
    for step in range(steps):
        if not len(on):
            break
        v = y[:, on] / beta[on]
        new = operator(v, on)
        if step:
            new = new - (beta[on] / old_beta[on]) * r1[:, on]
        alpha = (v * new).sum(0)
        new = new - (alpha / beta[on]) * r2[:, on]
        r1[:, on], r2[:, on], y[:, on] = r2[:, on], new, new
        old_beta[on], beta[on] = beta[on], np.linalg.norm(new, axis=0)
        old_epsilon = epsilon[on]
        delta = cosine[on] * d_bar[on] + sine[on] * alpha
        g_bar = sine[on] * d_bar[on] - cosine[on] * alpha
        epsilon[on], d_bar[on] = sine[on] * beta[on], -cosine[on] * beta[on]
        gamma = np.maximum(np.hypot(g_bar, beta[on]), np.finfo(float).tiny ** 0.5)
        cosine[on], sine[on] = g_bar / gamma, beta[on] / gamma
        move, left[on] = cosine[on] * left[on], sine[on] * left[on]
        w1, w2[:, on] = w2[:, on], w[:, on]
        w[:, on] = (v - old_epsilon * w1 - delta * w2[:, on]) / gamma
        solution[:, on] += move * w[:, on]
        on = on[(left[on] > INNER_REDUCTION * first[on]) & (beta[on] > 1e-14 * first[on])]
    return solution


def leading_pairs(product: Product, dimension: int, wanted: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit vectors, of a symmetric matrix known by its products."""
    wanted = min(wanted, dimension)
    locked = np.zeros((dimension, 0))
    space, image = np.zeros((dimension, 0)), np.zeros((dimension, 0))
    new = np.random.default_rng(seed).standard_normal((dimension, min(dimension, wanted + 4)))
    largest, best, stalled = 0.0, np.inf, 0
    for _ in range(OUTER_STEPS):
        new = _orthonormal(new, locked, space)
        if new.shape[1]:
            space, image = np.concatenate([space, new], axis=1), np.concatenate([image, product(new)], axis=1)
        inner = space.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        largest = max(largest, float(np.abs(values[:1]).max(initial=0)))
        open_pairs = min(wanted - locked.shape[1], space.shape[1])
        residual = image[:, :open_pairs] - space[:, :open_pairs] * values[:open_pairs]
        sizes = np.linalg.norm(residual, axis=0)
        worst = float(sizes.max(initial=0))
        stalled = stalled + 1 if worst > best / 2 else 0
        best = min(best, worst)
        done = sizes <= RESIDUAL * largest
        # Nothing new to look at, or nothing but rounding for some steps: these are the pairs to double precision.
        if not new.shape[1] or (stalled >= 4 and worst <= 1000 * RESIDUAL * largest):
            done[:] = True
        first = int(np.argmin(done)) if not done.all() else open_pairs
        locked = np.concatenate([locked, space[:, :first]], axis=1)
        space, image, values = space[:, first:], image[:, first:], values[first:]
        if locked.shape[1] == wanted:
            break
        residual, open_pairs = residual[:, first:], open_pairs - first
        if space.shape[1] > 6 * wanted:
            space, image, values = space[:, : 2 * wanted], image[:, : 2 * wanted], values[: 2 * wanted]
        chosen = np.flatnonzero(~done[first:])
        shut, theta = np.concatenate([locked, space[:, :open_pairs]], axis=1), values[chosen]

        def away(columns: np.ndarray, shut: np.ndarray = shut) -> np.ndarray:
            return columns - shut @ (shut.T @ columns)

        def corrected(columns: np.ndarray, which: np.ndarray, theta: np.ndarray = theta, away=away) -> np.ndarray:
            columns = away(columns)
            return away(product(columns) - columns * theta[which])

        new = minres_together(corrected, -away(residual[:, chosen]), INNER_STEPS)
    else:
        raise RuntimeError(f"residuals are at {best:.1e} after {OUTER_STEPS} steps")
    inner = locked.T @ product(locked)
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    return values[::-1], locked @ turn[:, ::-1]


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per finite vector and component: columns ``id_col``, ``component`` from 1, ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``.

    Entries become ``x = floor(64 * c) + 1000000``; means and covariance are those of the distinct x vectors, ``n`` of
    them. ``deviation`` is the sum of ``(n * x - S)**2``, NULL where that is beyond a long. Rows whose vector is NULL or
    has entries that are NULL or not finite are left out; shorter vectors end in zeros. Repeated rows count once in the fit
    and are all returned; an id may be NULL. There are fewer components where the distinct vectors span fewer (none at
    all for a single one or an empty table): an eigenvalue of zero cannot be whitened. Equal eigenvalues have any
    orthonormal vectors of their space. Entries beyond 2**40 in size are an error. Other columns do not matter.
    """
    vectors = whole_vectors(table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")), "v", SCALE, SHIFT)
    fit = FitList(vectors.select("x"))
    values, basis, trace, error = np.zeros(0), np.zeros((fit.width, 0)), 0.0, 0.0
    if fit.n > 1:
        trace = fit.trace()
        values, basis = leading_pairs(fit.product, fit.width, components)
        real = values > RANK * values[0]
        values, basis = values[real], basis[:, real]
        basis = basis * np.sign(basis[np.abs(basis).argmax(0), np.arange(basis.shape[1])])
        weights = basis / np.sqrt(values)
        error = float(np.abs(fit.covariance_of(weights) - np.eye(len(values))).max(initial=0))
    schema = (
        f"`{id_col}` {id_type(table, id_col)}, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )
    if not len(values):
        return table.sparkSession.createDataFrame([], schema)
    centring, width, k, n = _Centring(fit), fit.width, len(values), fit.n
    explained = values / trace

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            far = centring.deviations(x)
            if float(np.abs(far).max(initial=0)) ** 2 * width >= 2.0**62:
                far = far.astype(object)
            squares = [d if d < 1 << 63 else None for d in (far * far).sum(1).tolist()]
            rows = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype="int32"), len(x))),
                    pa.array(np.full(len(rows), n, "int64")),
                    pa.array(squares, pa.int64()).take(pa.array(rows)),
                    pa.array((((far / n).astype("float64")) @ weights).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(rows), error)),
                ],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.select("id", "x").mapInArrow(projected, schema)
