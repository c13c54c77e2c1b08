"""Embedding whitening: bit-sliced cross-products give an exact covariance, whose eigenvectors whiten.

An entry c becomes the integer x = floor(64 c) + 1,000,000. Less its dimension's least value, x is a
few bits long; the planes of these bits, packed along the rows into words, give every sum of products
as weighted counts of the bits that two planes have in common. Sums are integers throughout, so
neither the shift nor the number of rows costs a digit, and the covariance is centred before it is
rounded for the first time.
"""

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, TOP = 64, 32
# A component counts if its variance is more than this share of the first one's; below, it is rounding.
LEAST_SHARE = 1e-12
# Entries of a block of rows, and bits of the pieces in which tasks hand over their sums.
BLOCK, LIMB = 1 << 18, 60


@dataclass(frozen=True)
class Grid:
    """How entries of `dim` dimensions become integers from 0 to `top`: u = floor(64 c) - base."""

    dim: int
    base: list[int]
    top: list[int]

    @property
    def is_small(self) -> bool:
        return all(abs(b) < 1 << 52 and t < 1 << 52 for b, t in zip(self.base, self.top))

    def integers(self, x: np.ndarray) -> np.ndarray:
        """u of each entry, as machine integers where all dimensions allow it."""
        if self.is_small:
            return np.floor(x * SCALE).astype(np.int64) - np.array(self.base, np.int64)
        return np.array([[scaled(c) - b for c, b in zip(row, self.base)] for row in x.tolist()], object).reshape(x.shape)


@dataclass(frozen=True)
class Whitening:
    """n vectors on `grid`, exact sums of u per dimension, and the components by falling variance.

    `variances` are those of x / 2^halvings, which keeps them in range; `explained` are shares of the trace.
    """

    n: int
    grid: Grid
    sums: list[int]
    halvings: int
    variances: np.ndarray
    components: np.ndarray
    explained: np.ndarray


def scaled(c: float) -> int:
    """floor(64 c), exactly, also where 64 c is beyond the range of doubles."""
    return math.floor(c * SCALE) if abs(c) < 1e300 else int(c) * SCALE


def is_whole(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    finite = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(math.inf)), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def blocks(batches: Iterable[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches and their vectors (last column) as rows of doubles; short ones end in zeros."""
    rows = max(64, BLOCK // max(1, dim) // 64 * 64)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            piece = batch.slice(start, rows)
            vectors = piece.column(piece.num_columns - 1)
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
            x = np.zeros((len(sizes), dim))
            x[np.arange(dim) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
            yield piece, x


def extents(dim: int) -> Callable:
    """Per task: (low, high) with the least and the greatest entry of each dimension."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(dim, math.inf), np.full(dim, -math.inf)
        for _, x in blocks(batches, dim):
            low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        if (low <= high).any():
            dims = pa.array(np.arange(dim, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([dims, pa.array(low), pa.array(high)], names=["d", "low", "high"])

    return run


def bit_planes(u: np.ndarray, widths: list[int]) -> np.ndarray:
    """(plane, word): bit b of dimension d over all rows, 64 rows to a word, planes in order of (d, b)."""
    planes = [((u[:, d] >> b) & 1).astype(np.uint8) for d, width in enumerate(widths) for b in range(width)]
    bits = np.zeros((len(planes), -(-len(u) // 64) * 64), np.uint8)
    bits[:, :len(u)] = np.array(planes, np.uint8).reshape(len(planes), len(u))
    return np.packbits(bits, axis=1).view(np.uint64)


def scatter(grid: Grid) -> Callable:
    """Per task: (d, e, limb, part), the sum of u_d u_e over its rows for d <= e, and of u_d with e = -1.

    Sums are handed over in pieces of LIMB bits, so that they stay exact whatever their size.
    """
    widths = [t.bit_length() for t in grid.top]
    live = [d for d, w in enumerate(widths) if w]
    starts = np.cumsum([0, *widths])
    weights = np.array([1 << b for w in widths for b in range(w)], object)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = np.zeros((len(weights), len(weights)), np.int64)
        for _, x in blocks(batches, grid.dim):
            words = bit_planes(grid.integers(x), widths)
            for p, word in enumerate(words):
                common[p, p:] += np.bitwise_count(words[p:] & word).sum(1, dtype=np.int64)
        common = np.triu(common) + np.triu(common, 1).T
        ones, out = np.diag(common).astype(object) * weights, []

        def put(d: int, e: int, value: int) -> None:
            for limb in range(-(-value.bit_length() // LIMB)):
                out.append((d, e, limb, value >> limb * LIMB & (1 << LIMB) - 1))

        for i, d in enumerate(live):
            mine = slice(starts[d], starts[d + 1])
            per_plane = (common[mine].astype(object) * weights[mine, None]).sum(0) * weights
            put(d, -1, int(ones[mine].sum()))
            for e in live[i:]:
                put(d, e, int(per_plane[starts[e]:starts[e + 1]].sum()))
        if out:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["d", "e", "limb", "part"])

    return run


def fit(vectors: DataFrame, vector: str = "embedding", top: int = TOP) -> Whitening:
    """Fit on all vectors that are there and finite; the driver gets sums by dimension, no rows.

    The dimension is the length of the longest vector; shorter ones are taken to end in zeros. No
    vectors, or vectors without any spread, give no components.
    """
    given = vectors.select(F.col(f"`{vector}`").alias("embedding")).where(is_whole(F.col("embedding")))
    n, dim = given.agg(F.count("*"), F.max(F.size("embedding"))).first()
    dim = dim or 0
    ends = given.mapInArrow(extents(dim), "d int, low double, high double")
    ends = sorted(ends.groupBy("d").agg(F.min("low"), F.max("high")).collect()) if dim else []
    grid = Grid(dim, [scaled(low) for _, low, _ in ends], [scaled(high) - scaled(low) for _, low, high in ends])
    sums, products = [0] * dim, np.zeros((dim, dim), object)
    parts = given.mapInArrow(scatter(grid), "d int, e int, limb int, part long")
    for d, e, limb, part in parts.groupBy("d", "e", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)"))).collect():
        value = int(part) << limb * LIMB
        if e < 0:
            sums[d] += value
        else:
            products[d, e] += value
            products[e, d] = products[d, e]
    return Whitening(n, grid, sums, *principal(n, np.array(sums, object), products, top))


def principal(n: int, sums: np.ndarray, products: np.ndarray, top: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(halvings, variances, components, explained) from exact sums; a component's largest entry is positive."""
    centred = n * products - np.outer(sums, sums)  # n^2 times the covariance, in integers
    bits = max((int(v).bit_length() for v in np.diag(centred)), default=0) - 2 * n.bit_length()
    halvings = max(0, bits // 2 - 400)
    covariance = np.array([[v / (n * n << 2 * halvings) for v in row] for row in centred.tolist()]).reshape(centred.shape)
    if not covariance.any():
        return 0, np.zeros(0), np.zeros((len(sums), 0)), np.zeros(0)
    variances, components = np.linalg.eigh(covariance)
    order = np.argsort(-variances, kind="stable")[:top]
    order = order[variances[order] > LEAST_SHARE * variances.max()]
    variances, components = variances[order], components[:, order]
    components = components * np.sign(components[np.abs(components).argmax(0), np.arange(len(order))])
    return halvings, variances, components, variances / np.trace(covariance)


def project(model: Whitening, x: np.ndarray) -> tuple[list[int | None], np.ndarray]:
    """Exact squared deviations times n^2 (None beyond 64 bits), and the whitened rows."""
    u, grid = model.grid.integers(x), model.grid
    largest = max((model.n * t for t in grid.top), default=0)
    if u.dtype == np.int64 and grid.dim * largest * largest < 1 << 63:
        y = model.n * u - np.array(model.sums, np.int64)
        deviations, centred = (y * y).sum(1).tolist(), y / model.n
    else:
        y = model.n * u.astype(object) - np.array(model.sums, object)
        exact = (y * y).sum(1).tolist()
        deviations, centred = [v if v < 1 << 63 else None for v in exact], (y / (model.n << model.halvings)).astype(float)
    if len(model.variances):
        # Dimensions without planes are zero throughout; the others are at a scale that doubles hold.
        return deviations, centred @ model.components / np.sqrt(model.variances)
    return deviations, np.zeros((len(x), 0))


def whitened_rows(model: Whitening) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.variances)
        for piece, x in blocks(batches, model.grid.dim):
            deviations, w = project(model, x)
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * k)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(deviations, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(w.ravel()))],
                names=["key", "deviation", "whitened"])

    return run


def whiten(vectors: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, deviation, whitened) of every vector that is there and finite; repeated rows come each time.

    `deviation` is the sum over dimensions of (n x - S)^2, null if it is beyond a long; `whitened` has
    one entry per component. Vectors longer than the model's are not to be had from the fitted table.
    """
    given = vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("embedding"))
    kind = given.schema["key"].dataType.simpleString()
    return given.where(is_whole(F.col("embedding"))).mapInArrow(
        whitened_rows(model), f"key {kind}, deviation long, whitened array<double>")


def task_sums(k: int, means: np.ndarray | None) -> Callable:
    """Per task: sums of the whitened entries, or of the products of the entries less `means`."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k if means is None else (k, k))
        for _, w in blocks(batches, k):
            total += w.sum(0) if means is None else (w - means).T @ (w - means)
        places = pa.array(np.arange(total.size, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([places, pa.array(total.ravel())], names=["place", "total"])

    return run


def identity_error(whitened: DataFrame, n: int, k: int) -> float | None:
    """Largest absolute entry of the covariance of `whitened` less the identity, measured on the rows."""
    if not k:
        return None

    def summed(means: np.ndarray | None) -> np.ndarray:
        sums = whitened.select("whitened").mapInArrow(task_sums(k, means), "place int, total double")
        return np.array([t for _, t in sorted(sums.groupBy("place").agg(F.sum("total")).collect())]) / n

    covariance = summed(summed(None)).reshape(k, k)
    return float(np.abs(covariance - np.eye(k)).max())
