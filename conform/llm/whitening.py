"""Whitening of embeddings: leading components of the covariance by spectrum slicing."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm.staging import check_columns, staged

#: Whole numbers that a double holds exactly, and sums that a long holds.
_EXACT, _LONG = 1 << 53, 1 << 62
_EPS = np.finfo(float).eps
#: Pivots of the factorisation are of order two where that bounds growth better, by Bunch and Kaufman.
_ALPHA = (1 + math.sqrt(17)) / 8


@dataclass(frozen=True)
class Whitening:
    """The fit on the vectors of one length: ``n`` different ones, their sums, unit components and eigenvalues."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float


def whole_numbers(vector: Column, scale: int = 64, shift: int = 1_000_000) -> Column:
    """floor(scale * c) + shift of every entry as double; null where the vector or an entry is null or not finite.

    An entry whose result a double does not hold exactly, beyond 2^53, fails the job instead of being changed.
    """
    entries = vector.cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(
        entries,
        lambda c: F.when(F.abs(c * scale) < _EXACT - shift, F.floor(c * scale) + shift).otherwise(
            F.raise_error(F.concat(F.lit("an entry is too large: "), c.cast("string"))).cast("bigint")
        ),
    )
    return F.when(finite, scaled)


def whitened_vectors(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = 16,
    scale: int = 64,
    shift: int = 1_000_000,
) -> DataFrame:
    """A row per usable row of ``df`` and component: id, component, n, deviation, whitened, explained and identity_error.

    ``fitted`` gives the fit on the different vectors of whole numbers x. ``whitened`` is x without the mean, projected on the component and divided
    by the root of its eigenvalue; ``deviation`` is the sum over the dimensions of (n x - S)^2, exact, and fails the
    job where a long does not hold it; ``explained`` is the component's share of all variance; ``identity_error`` is
    the largest absolute entry of the covariance of the whitened fit list minus the identity.

    Rows whose vector is null or has entries that are null, infinite or NaN are left out. Vectors of each length have a fit of their own.
    There are as many components as ``components`` says, the dimensions, and the eigenvalues above rounding allow: different vectors that lie in
    fewer dimensions have fewer, a single different vector and an empty vector have none and give no rows. Copies count once in
    the fit and are returned as often as they occur, whatever their ids; an empty table gives an empty one. Other columns are not touched.
    """
    check_columns(df, id_column, vector_column)
    rows = df.select(F.col(id_column), whole_numbers(F.col(vector_column), scale, shift).alias("__x"))
    rows = rows.where(F.col("__x").isNotNull())
    fits = fitted(staged(rows.select(F.col("__x").alias("x")).distinct(), "fit-list"), components)
    # One row per length of a vector and component.
    described = [
        (size, i + 1, fit.n, float(fit.explained[i]), fit.identity_error)
        for size, fit in fits.items()
        for i in range(len(fit.eigenvalues))
    ]
    schema = "__size int, component int, n long, explained double, identity_error double"
    known = df.sparkSession.createDataFrame(described, schema)

    @F.pandas_udf("deviation long, whitened array<double>")
    def project(vectors: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in vectors:
            deviations, projections = np.zeros(len(batch), dtype=np.int64), np.empty(len(batch), dtype=object)
            for size, part in batch.groupby(batch.map(len)):
                fit = fits.get(size)
                at = batch.index.get_indexer(part.index)
                if fit is None:
                    projections[at] = [np.zeros(0)] * len(at)
                    continue
                x = np.stack(part.to_numpy())
                deviations[at] = _deviation(x, fit)
                projections[at] = list(_whitened(x, fit))
            yield pd.DataFrame({"deviation": deviations, "whitened": pd.Series(projections, dtype=object)})

    found = rows.select(id_column, F.size("__x").alias("__size"), project("__x").alias("__p"))
    found = found.select(id_column, "__size", "__p.deviation", F.posexplode("__p.whitened").alias("__at", "whitened"))
    found = found.withColumn("component", F.col("__at") + 1).join(F.broadcast(known), ["__size", "component"])
    return found.select(id_column, "component", "n", "deviation", "whitened", "explained", "identity_error")


def fitted(vectors: DataFrame, components: int = 16) -> dict[int, Whitening]:
    """The fit for each length of the vectors in the column ``x`` (array of bigint), each row counting once.

    Counts and sums come first; then every task multiplies what is left of its vectors once the whole part of the mean is
    taken away, in integers, so that the sums do not depend on how rows are dealt out and nothing cancels. The rest
    of the mean, below one, is taken off exactly. What reaches the driver is a triangle of numbers per length,
    however many vectors there are. There the eigenvalues are sliced; one more pass measures the whitened covariance.
    """
    spark = vectors.sparkSession
    totals = _totals(vectors).groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    counts: dict[int, tuple[int, list[int]]] = {}
    for row in totals.orderBy("size", "i").collect():
        counts.setdefault(row["size"], (row["n"], []))[1].append(int(row["s"]))
    centres = {size: [s // n for s in sums] for size, (n, sums) in counts.items()}
    gram: dict[int, dict[tuple[int, int], int]] = {size: {} for size in counts}
    for row in _products(vectors, centres).groupBy("size", "i", "j").agg(F.sum("g").alias("g")).toLocalIterator():
        gram[row["size"]][row["i"], row["j"]] = int(row["g"])
    fits = {}
    for size, (n, sums) in counts.items():
        covariance = _covariance(n, sums, centres[size], gram[size])
        values, axes = leading_components(covariance, min(components, size))
        trace = float(np.trace(covariance))
        if len(values):
            fits[size] = Whitening(n, tuple(sums), axes, values, values / trace, 0.0)
    return _with_error(spark, vectors, fits)


def _totals(vectors: DataFrame) -> DataFrame:
    """size, i, n and s: the vectors of a task and the sums of their entries, in whole numbers."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, part in batch["x"].groupby(batch["x"].map(len)):
                x = np.stack(part.to_numpy())
                wide = x if int(np.abs(x).max(initial=0)) * len(x) < _LONG else x.astype(object)
                counts[size] = counts.get(size, 0) + len(x)
                sums[size] = sums.get(size, 0) + wide.sum(axis=0).astype(object)
        for size, total in sums.items():
            yield pd.DataFrame(
                {"size": size, "i": range(size), "n": counts[size], "s": [Decimal(int(each)) for each in total]}
            )

    return vectors.select("x").mapInPandas(add, "size int, i int, n long, s decimal(38,0)")


def _products(vectors: DataFrame, centres: dict[int, list[int]]) -> DataFrame:
    """size, i, j >= i and g: sums of products of centred entries over the vectors of a task, in whole numbers."""

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, part in batch["x"].groupby(batch["x"].map(len)):
                if size == 0:
                    continue
                y = np.stack(part.to_numpy()) - np.array(centres[size], dtype=np.int64)
                largest = int(np.abs(y).max())
                if largest * largest * len(y) < _EXACT:
                    exact = y.astype(float)
                    product = (exact.T @ exact).astype(np.int64)
                else:
                    product = y.astype(object).T @ y.astype(object)
                total = sums.get(size)
                if total is not None and (total.dtype == object or product.dtype == object or np.abs(total).max() > _LONG):
                    total, product = total.astype(object), product.astype(object)
                sums[size] = product if total is None else total + product
        for size, total in sums.items():
            i, j = np.triu_indices(size)
            yield pd.DataFrame({"size": size, "i": i, "j": j, "g": [Decimal(int(g)) for g in total[i, j]]})

    return vectors.select("x").mapInPandas(multiply, "size int, i int, j int, g decimal(38,0)")


def _covariance(n: int, sums: list[int], centre: list[int], gram: dict[tuple[int, int], int]) -> np.ndarray:
    """(n G - s s') / n^2 with s the sums of the centred entries: each entry is rounded once, by the division."""
    rest = [total - n * whole for total, whole in zip(sums, centre, strict=True)]
    size = len(sums)
    covariance = np.empty((size, size))
    for i in range(size):
        for j in range(i, size):
            covariance[i, j] = covariance[j, i] = (n * gram[i, j] - rest[i] * rest[j]) / (n * n)
    return covariance


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - S/n in doubles: the whole part of the mean is taken off in whole numbers."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole) - rest


def _whitened(x: np.ndarray, fit: Whitening) -> np.ndarray:
    return _centred(x, fit.n, fit.sums) @ fit.components.T / np.sqrt(fit.eigenvalues)


def _deviation(x: np.ndarray, fit: Whitening) -> np.ndarray:
    whole = np.array([s // fit.n for s in fit.sums], dtype=np.int64)
    y = x - whole
    rest = [s % fit.n for s in fit.sums]
    bound = fit.n * (int(np.abs(y).max(initial=0)) + 1)
    if bound * bound * len(rest) < _LONG:
        return ((fit.n * y - np.array(rest, dtype=np.int64)) ** 2).sum(axis=1)
    exact = fit.n * y.astype(object) - np.array(rest, dtype=object)
    return np.array([sum(part * part for part in row) for row in exact], dtype=np.int64)


def _with_error(spark: SparkSession, vectors: DataFrame, fits: dict[int, Whitening]) -> dict[int, Whitening]:
    """The fits with the largest difference between the covariance of their whitened vectors and the identity."""
    if not fits:
        return fits

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, part in batch["x"].groupby(batch["x"].map(len)):
                if size in fits:
                    w = _whitened(np.stack(part.to_numpy()), fits[size])
                    w = np.hstack([np.ones((len(w), 1)), w])  # the first row and column give the mean
                    sums[size] = sums.get(size, 0) + w.T @ w
        for size, total in sums.items():
            i, j = np.triu_indices(len(total))
            yield pd.DataFrame({"size": size, "i": i, "j": j, "g": total[i, j]})

    products = vectors.select("x").mapInPandas(multiply, "size int, i int, j int, g double")
    found: dict[int, np.ndarray] = {size: np.zeros((len(fit.eigenvalues) + 1,) * 2) for size, fit in fits.items()}
    for row in products.groupBy("size", "i", "j").agg(F.sum("g").alias("g")).collect():
        found[row["size"]][row["i"], row["j"]] = found[row["size"]][row["j"], row["i"]] = row["g"]
    measured = {}
    for size, fit in fits.items():
        total = found[size] / fit.n
        error = total[1:, 1:] - np.outer(total[0, 1:], total[0, 1:]) - np.eye(len(total) - 1)
        measured[size] = Whitening(
            fit.n, fit.sums, fit.components, fit.eigenvalues, fit.explained, float(np.abs(error).max())
        )
    return measured


# --- slicing the spectrum ----------------------------------------------------------------------------------


class Factors:
    """P (A - shift I) P' = L D L' of a symmetric matrix, D with blocks of order one and two."""

    def __init__(self, matrix: np.ndarray, shift: float):
        a = matrix - shift * np.eye(len(matrix))
        size = len(a)
        self.order, self.blocks = np.arange(size), []
        # A pivot that is zero is moved by a rounding error of the matrix, which moves the shift by as much.
        tiny = _EPS * max(np.abs(matrix).max(initial=0.0), abs(shift), np.finfo(float).tiny)
        k = 0
        while k < size:
            width, swap = self._pivot(a, k)
            at = k + width - 1
            if swap != at:
                a[[at, swap]] = a[[swap, at]]
                a[:, [at, swap]] = a[:, [swap, at]]
                self.order[[at, swap]] = self.order[[swap, at]]
            block = a[k : k + width, k : k + width].copy()
            if width == 1 and abs(block[0, 0]) < tiny:
                block[0, 0] = -tiny if block[0, 0] < 0 else tiny
            below = a[k + width :, k : k + width]
            if len(below):
                multipliers = np.linalg.solve(block, below.T).T if width == 2 else below / block[0, 0]
                a[k + width :, k + width :] -= multipliers @ below.T
                a[k + width :, k : k + width] = multipliers
            self.blocks.append((k, block))
            k += width
        self.lower = a

    @staticmethod
    def _pivot(a: np.ndarray, k: int) -> tuple[int, int]:
        """Order of the next block and the row to be its last one, which bounds the growth of what is left."""
        column = np.abs(a[k + 1 :, k])
        largest = column.max(initial=0.0)
        if largest == 0 or abs(a[k, k]) >= _ALPHA * largest:
            return 1, k
        r = k + 1 + int(column.argmax())
        row = np.abs(a[r, k:])
        row[r - k] = 0
        if abs(a[k, k]) * row.max() >= _ALPHA * largest**2:
            return 1, k
        if abs(a[r, r]) >= _ALPHA * row.max():
            return 1, r
        return 2, r

    def above(self) -> int:
        """How many eigenvalues lie above the shift: the inertia of D, by Sylvester's law."""
        return sum(1 if len(block) == 2 else int(block[0, 0] > 0) for _, block in self.blocks)

    def solve(self, right: np.ndarray) -> np.ndarray:
        y = right[self.order].copy()
        for k, block in self.blocks:
            end = k + len(block)
            y[end:] -= self.lower[end:, k:end] @ y[k:end]
        for k, block in self.blocks:
            end = k + len(block)
            y[k:end] = np.linalg.solve(block, y[k:end])
        for k, block in reversed(self.blocks):
            end = k + len(block)
            y[k:end] -= self.lower[end:, k:end].T @ y[end:]
        solved = np.empty_like(y)
        solved[self.order] = y
        return solved


def leading_components(covariance: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a covariance, falling, and their unit eigenvectors as rows.

    Counts of eigenvalues above a shift, from the inertia of L D L', cut the spectrum into slices until one eigenvalue
    alone, or a cluster that rounding cannot part, is left between two shifts. Rayleigh quotient iteration starts in the middle of
    the slice and converges cubically; whenever the quotient leaves the slice, counts halve it once more. What was found is
    certified by counts just above and below it, so that no eigenvalue is missed or numbered twice. Vectors are kept
    orthogonal to those found before, which settles eigenvalues that are equal. Signs make the largest entry
    positive. Eigenvalues within rounding of zero are left out.
    """
    size = len(covariance)
    scale = float(np.abs(covariance).sum(axis=1).max(initial=0.0))  # no eigenvalue is larger
    if scale == 0 or not math.isfinite(scale):
        return np.zeros(0), np.zeros((0, size))
    rounding = 4 * size * _EPS * scale
    counts = {scale + rounding: 0, -rounding: size}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = Factors(covariance, shift).above()
        return counts[shift]

    count = min(count, above(2 * rounding))
    values, axes = np.zeros(0), np.zeros((0, size))
    while len(values) < count:
        number = len(values) + 1
        low = max(shift for shift, over in counts.items() if over >= number)
        high = min(shift for shift, over in counts.items() if over < number)
        while high - low > rounding and not (above(low) == number and above(high) == number - 1):
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= number else (low, middle)
        value, axis = _refined(covariance, low, high, axes, above, number, rounding)
        values, axes = np.append(values, value), np.vstack([axes, axis])
    return values, axes


def _refined(covariance, low, high, axes, above, number, rounding) -> tuple[float, np.ndarray]:
    """The eigenpair with this number, which lies between the two shifts."""
    rng = np.random.default_rng(number)
    while True:
        axis = _orthogonal(rng.standard_normal(len(covariance)), axes)
        shift, last = (low + high) / 2, math.inf
        for step in range(40):
            solved = _orthogonal(Factors(covariance, shift).solve(axis), axes)
            product = covariance @ solved
            value = float(solved @ product)
            residual = float(np.linalg.norm(product - value * solved))
            axis = solved
            inside = low - rounding <= value <= high + rounding
            # Iterated until rounding stops the residual from falling.
            if inside and residual <= rounding and residual >= last / 2:
                margin = 2 * (residual + rounding)
                if above(value - margin) >= number > above(value + margin):
                    return value, axis * (1 if axis[np.abs(axis).argmax()] > 0 else -1)
                break
            last = residual
            # The quotient takes over once it is in the slice; before that, the middle of the slice draws towards it.
            shift = value if inside and step else (low + high) / 2
        middle = (low + high) / 2
        if high - low <= rounding:
            raise ArithmeticError(f"eigenvalue {number} does not settle between {low} and {high}")
        low, high = (middle, high) if above(middle) >= number else (low, middle)


def _orthogonal(vector: np.ndarray, axes: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vector = vector / np.linalg.norm(vector)
        vector = vector - axes.T @ (axes @ vector)
    return vector / np.linalg.norm(vector)
