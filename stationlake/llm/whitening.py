"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

With X the centred rows, each step multiplies X by a direction (a vector of one dimension) and the
transpose of X by the resulting left vector (one entry a row). Both stay orthogonal to all earlier ones
by full reorthogonalisation, done twice. The singular values and vectors of the small bidiagonal matrix
give the components of X. A left vector never leaves the tasks: it is X times a vector of one
dimension, kept beside it, so tasks make all left vectors of a block of rows anew with one product and
only sums over rows travel.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import written

SCALE = 256
#: Entries beyond this cannot be scaled to whole numbers exactly; they count as not finite.
LARGEST = float(1 << 30)
#: Rows of a block that a task works on.
BLOCK_ROWS = 4_096
#: Relative size of a residual, and of a vector, that counts as nothing.
CONVERGED = 1e-14
NOTHING = 1e-12
#: Steps between two looks at the residuals.
CHECKED = 8
SEED = 23


def whole_numbers(vector: Column) -> Column:
    """floor(256 * c) of every entry as long; null unless all entries are there, finite and not too large."""
    entries = vector.cast("array<double>")
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LARGEST))
    return F.when(~bad, F.transform(entries, lambda c: F.floor(c * SCALE).cast("long")))


def _blocks(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.column(batch.num_columns - 1).slice(start, BLOCK_ROWS)
            yield part.flatten().to_numpy().reshape(-1, dimension)


class Fit:
    """The distinct rows ``x`` (arrays of long, one length) with their number, sums and sums over products."""

    def __init__(self, rows: DataFrame, dimension: int):
        self.rows, self.dimension = rows, dimension
        sums = self._summed(lambda x: x.sum(axis=0, dtype=np.int64), dimension + 1, whole=True)
        self.sums, self.n = [int(s) for s in sums[:-1]], int(sums[-1])
        # The whole part is taken off exactly, so that a far-away mean costs no digits.
        self.base = np.array([s // max(1, self.n) for s in self.sums], dtype=np.int64)
        self.rest = np.array([(s % max(1, self.n)) / max(1, self.n) for s in self.sums])

    def centre(self) -> Callable[[np.ndarray], np.ndarray]:
        """What tasks need to centre rows; it must not hold on to the table."""
        base, rest = self.base, self.rest
        return lambda x: (x - base).astype(np.float64) - rest

    def _summed(self, compute: Callable[[np.ndarray], np.ndarray], size: int, whole: bool = False) -> np.ndarray:
        """Sums over all blocks of a vector of ``size`` numbers, added up by position; whole ones count rows last."""
        dimension, kind = self.dimension, np.int64 if whole else np.float64

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size, dtype=kind)
            for x in _blocks(batches, dimension):
                total += np.append(compute(x), len(x)) if whole else compute(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["at", "v"])

        parts = self.rows.mapInArrow(work, f"at int, v {'long' if whole else 'double'}")
        found = np.zeros(size, dtype=object if whole else np.float64)
        for row in parts.groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)") if whole else "v").alias("v")).collect():
            found[row.at] = row.v
        return found

    def products(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For u = X right and U = X left: the products of u with each of U and with itself, and X' u."""
        both = np.column_stack([left, right])
        centred = self.centre()

        def compute(x: np.ndarray) -> np.ndarray:
            x = centred(x)
            made = x @ both
            u = made[:, -1]
            return np.concatenate([u @ made, u @ x])

        found = self._summed(compute, both.shape[1] + self.dimension)
        return found[: both.shape[1]], found[both.shape[1] :]

    def covariance(self, matrix: np.ndarray) -> np.ndarray:
        """The covariance of X times ``matrix``, centred by its own mean before multiplying."""
        k, centred = matrix.shape[1], self.centre()
        mean = self._summed(lambda x: (centred(x) @ matrix).sum(axis=0), k) / self.n

        def compute(x: np.ndarray) -> np.ndarray:
            y = centred(x) @ matrix - mean
            return (y.T @ y).ravel()

        return self._summed(compute, k * k).reshape(k, k) / self.n

    def trace(self) -> float:
        """The sum of all variances."""
        centred = self.centre()
        return float(self._summed(lambda x: np.square(centred(x)).sum(axis=0), self.dimension).sum()) / self.n


def _orthogonal(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """The vector without its parts along the basis; a second turn takes off what rounding left."""
    for _ in range(2 if basis else 0):
        columns = np.column_stack(basis)
        vector = vector - columns @ (columns.T @ vector)
    return vector


def bidiagonalise(fit: Fit, k: int, found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, bool]:
    """The ``k`` largest singular values of X across the directions in ``found``, their right vectors,
    and whether all directions were used up.

    Steps go on until the residuals of all ``k`` are nothing, or no direction is left. When a left or
    right vector vanishes, the next direction is drawn anew across all earlier ones.
    """
    random = np.random.default_rng(SEED + len(found))
    dimension = fit.dimension
    steps = dimension - len(found)
    rights: list[np.ndarray] = []  # orthonormal directions v
    lefts = np.zeros((dimension, 0))  # columns p with u = X p, orthonormal over the rows
    images = np.zeros((dimension, 0))  # columns X' u
    matrix = np.zeros((steps, steps))  # X v in the left vectors; upper bidiagonal but for rounding
    v, beta, scale = None, 0.0, 0.0
    while len(rights) < steps:
        if v is None:
            v = _orthogonal(random.standard_normal(dimension), [*found, *rights])
            v, beta = v / np.linalg.norm(v), 0.0
        rights.append(v)
        j = len(rights) - 1
        p = v
        if j:
            p, matrix[j - 1, j] = v - beta * lefts[:, -1], beta
        while True:  # across all earlier left vectors, again as long as much had to be taken off
            inner, image = fit.products(lefts, p)
            along, square = inner[:-1], max(float(inner[-1]), 0.0)
            matrix[:j, j] += along
            p, image = p - lefts @ along, image - images @ along
            if np.linalg.norm(along) <= 1e-6 * np.sqrt(square) or np.sqrt(square) <= NOTHING * scale:
                break
        alpha = np.sqrt(max(0.0, square - float(along @ along)))
        scale = max(scale, alpha, beta)
        if alpha <= NOTHING * scale:
            lefts, images = (np.column_stack([m, np.zeros(dimension)]) for m in (lefts, images))
            v = None
        else:
            matrix[j, j] = alpha
            lefts, images = np.column_stack([lefts, p / alpha]), np.column_stack([images, image / alpha])
            v = _orthogonal(images[:, -1], [*found, *rights])
            beta = float(np.linalg.norm(v))
            v = v / beta if beta > NOTHING * scale else None
        size = len(rights)
        if v is not None and size >= k and size % CHECKED == 0 and size < steps:
            left, values, _ = np.linalg.svd(matrix[:size, :size])
            if np.all(beta * np.abs(left[-1, :k]) <= CONVERGED * values[0]):
                break
    size = len(rights)
    _, values, right = np.linalg.svd(matrix[:size, :size])
    return values[:k], np.column_stack(rights) @ right[:k].T, size == steps


def principal(fit: Fit, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of the covariance, ``k`` at most, those above zero only.

    A run that stops early cannot see that a singular value is there twice. So it is repeated across
    what was found, until the greatest value left does not exceed the smallest kept.
    """
    values, vectors = np.zeros(0), np.zeros((fit.dimension, 0))
    wanted = min(k, fit.dimension)
    while fit.n > 1 and vectors.shape[1] < fit.dimension:
        more, across, whole = bidiagonalise(fit, 1 if len(values) else wanted, list(vectors.T))
        seen = len(values) >= wanted and more[0] <= values[wanted - 1]
        values, vectors = np.append(values, more), np.column_stack([vectors, across])
        order = np.argsort(-values, kind="stable")
        values, vectors = values[order], vectors[:, order]
        if seen or whole and len(more) == wanted:
            break
    values, vectors = values[:k] ** 2 / max(1, fit.n), vectors[:, :k]
    kept = values > (values[0] if len(values) else 0.0) * NOTHING**2
    return values[kept], vectors[:, kept]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Each entry c becomes x = floor(256 * c). The ``n`` distinct x vectors are what is fitted;
    ``deviation`` is the sum of (n * x - S)^2 over the dimensions, S their sums (null if beyond a long);
    ``whitened`` the centred x along the component in standard deviations; ``explained`` the share of
    the component; ``identity_error`` how far the covariance of ``whitened`` over the distinct rows is
    from the identity. Vectors that are null or hold null or non-finite entries, or one beyond
    2^30, take no part; of several lengths the commonest takes part (the longest of equally common
    ones), empty vectors never. Only components with a variance are returned: one distinct row gives no
    rows, as an empty table does. Null and repeated ids are kept, other columns are not looked at.
    """
    if components < 1:
        raise ValueError("components must be at least 1")
    usable = vectors.select(F.col(id_col).cast("long").alias("vec_id"), whole_numbers(F.col(vector_col)).alias("x"))
    usable = written(usable.where("x IS NOT NULL AND size(x) > 0"), "whole-vectors")
    lengths = usable.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length"))
    common = lengths.first()
    fields = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if common is None:
        return vectors.sparkSession.createDataFrame([], fields)
    usable = usable.where(F.size("x") == common.length)
    fit = Fit(written(usable.select("x").distinct(), "distinct-vectors"), common.length)
    values, directions = principal(fit, components)
    if not len(values):
        return vectors.sparkSession.createDataFrame([], fields)
    scaled = directions / np.sqrt(values)
    error = float(np.abs(fit.covariance(scaled) - np.eye(len(values))).max())
    explained = values / fit.trace()
    return usable.mapInArrow(_projector(fit, scaled, explained, error), fields)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum of (n * x - S)^2 for each row, exactly; None beyond a long."""
    largest = n * max(int(np.abs(x).max()), 1) + max(map(abs, sums))
    if largest * largest * len(sums) < 1 << 63:
        return np.square(n * x - np.array(sums, dtype=np.int64)).sum(axis=1).tolist()
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
    return [d if d < 1 << 63 else None for d in exact]


def _projector(fit: Fit, scaled: np.ndarray, explained: np.ndarray, error: float):
    n, sums, centred, k = fit.n, fit.sums, fit.centre(), scaled.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                x = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)
                rows = part.num_rows
                repeated = pa.array(np.repeat(np.arange(rows), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(repeated),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * k, n)),
                        pa.array(_deviations(x, n, sums), pa.int64()).take(repeated),
                        pa.array((centred(x) @ scaled).ravel()),
                        pa.array(np.tile(explained, rows)),
                        pa.array(np.full(rows * k, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return work
