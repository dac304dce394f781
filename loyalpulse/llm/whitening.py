"""Whitening of embeddings from exact bit-sliced cross-products.

Vectors become whole numbers.  Of the distinct ones, every dimension is shifted by its least value
and cut into bit planes; a plane holds one bit of one dimension for 64 rows a word.  The number of
rows with bit ``p`` of dimension ``i`` and bit ``q`` of dimension ``j`` is the popcount of two planes'
AND, so ``sum x_i x_j = sum 2**(p + q) popcount`` is exact.  Sums of all tasks are added as whole
numbers and centred as such, ``n * sum x_i x_j - sum x_i * sum x_j``, before the eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalpulse.llm.store import stored
from loyalpulse.llm.vectors import matrix

#: Entries beyond this count as this.
LARGEST = 1 << 62
#: Rows whose planes are held at once, and the size of a limb of a sum sent to the driver.
ROWS = 1 << 14
LIMB = 32
#: Eigenvalues below this part of the largest one are rounding, not variance.
NOISE = 1e-12


def whole(vector: str, scale: int, offset: int) -> str:
    """SQL for ``floor(scale * c) + offset`` of the entries; null for vectors that take no part."""
    number = f"least(greatest(floor({scale} * CAST(c AS DOUBLE)), -{LARGEST}L), {LARGEST}L) + {offset}L"
    return f"""CASE WHEN size({vector}) > 0 AND forall({vector}, c -> c IS NOT NULL
            AND NOT isnan(c) AND abs(CAST(c AS DOUBLE)) < double('Infinity'))
        THEN transform({vector}, c -> {number}) END"""


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    low = high = None
    for batch in batches:
        if len(batch):
            x = matrix(batch.column(0))
            below, above = x.min(axis=0), x.max(axis=0)
            low = below if low is None else np.minimum(low, below)
            high = above if high is None else np.maximum(high, above)
    if low is not None:
        columns = [pa.array(np.arange(len(low))), pa.array(low), pa.array(high)]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "low", "high"])


def bit_planes(x: np.ndarray, low: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """One row of 64-bit words per plane: the bits of dimension 0 from the lowest, then 1, ..."""
    shifted = (x - low).astype(np.uint64)
    planes = [
        np.packbits((shifted[:, i] >> np.uint64(p)).astype(np.uint8) & 1)
        for i in range(len(bits))
        for p in range(bits[i])
    ]
    out = np.zeros((len(planes), -(-len(x) // 64) * 8), dtype=np.uint8)
    if planes:
        out[:, : len(planes[0])] = planes
    return out.view(np.uint64)


def plane_products(planes: np.ndarray) -> np.ndarray:
    """The popcounts of all pairs of planes' AND."""
    out = np.zeros((len(planes), len(planes)), dtype=np.int64)
    for k in range(len(planes)):
        out[k, k:] = np.bitwise_count(planes[k] & planes[k:]).sum(axis=1, dtype=np.int64)
    return out


def _scatter(low: np.ndarray, bits: np.ndarray):
    """Sums of products of shifted dimensions, and with -1 for ``j`` of the dimensions alone."""
    ends = np.cumsum(bits)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, many = np.zeros((ends[-1], ends[-1]), dtype=np.int64), 0
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                x = matrix(batch.column(0).slice(at, ROWS))
                total += plane_products(bit_planes(x, low, bits))
                many += len(x)
        found = []
        weight = np.array([1 << p for width in bits for p in range(width)], dtype=object)
        alone = weight * np.diag(total).astype(object)
        for i in range(len(bits)):
            mine = slice(ends[i] - bits[i], ends[i])
            found.append((i, -1, int(alone[mine].sum())))
            for j in range(i, len(bits)):
                yours = slice(ends[j] - bits[j], ends[j])
                block = total[mine, yours]
                if i == j:
                    block = block + np.triu(block, 1).T
                found.append((i, j, int(weight[mine] @ block.astype(object) @ weight[yours])))
        limbs = [
            (i, j, k, (value >> (LIMB * k)) & ((1 << LIMB) - 1))
            for i, j, value in found
            for k in range(-(-value.bit_length() // LIMB))
        ]
        limbs.append((-1, -1, 0, many))
        columns = [pa.array(column, type=pa.int64()) for column in zip(*limbs)]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "limb", "value"])

    return rows


class Whitening:
    """Fitted to the distinct whole-number vectors of a table with one column ``x``.

    ``n`` vectors of ``width`` dimensions with exact ``sums``; ``covariance`` has divisor ``n``;
    ``values`` and ``vectors`` are its eigenvalues, falling, and unit eigenvectors as columns.
    The driver gets numbers of dimensions squared, never of rows.
    """

    def __init__(self, distinct: DataFrame):
        found = (
            distinct.mapInArrow(_ranges, "i bigint, low bigint, high bigint")
            .groupBy("i")
            .agg(F.min("low").alias("low"), F.max("high").alias("high"))
            .orderBy("i")
            .collect()
        )
        low = np.array([row.low for row in found], dtype=np.int64)
        bits = np.array([(row.high - row.low).bit_length() for row in found], dtype=np.int64)
        width = self.width = len(found)
        sums, products = [0] * width, [[0] * width for _ in range(width)]
        self.n = 0
        if width:
            limbs = (
                distinct.mapInArrow(_scatter(low, bits), "i bigint, j bigint, limb bigint, value bigint")
                .groupBy("i", "j", "limb")
                .agg(F.sum("value").alias("value"))
            )
            for i, j, limb, value in limbs.toLocalIterator():
                part = value << (LIMB * limb)
                if i < 0:
                    self.n += part
                elif j < 0:
                    sums[i] += part
                else:
                    products[i][j] += part
                    if i != j:
                        products[j][i] += part
        n = self.n
        centred = [[n * products[i][j] - sums[i] * sums[j] for j in range(width)] for i in range(width)]
        self.sums = [s + n * int(m) for s, m in zip(sums, low)]
        self.covariance = np.array(
            [[value / (n * n) for value in row] for row in centred], dtype=np.float64
        ).reshape(width, width)
        values, vectors = np.linalg.eigh(self.covariance)
        self.values, self.vectors = values[::-1], vectors[:, ::-1]
        trace = sum(centred[i][i] for i in range(width))
        self.trace = trace / (n * n) if n else 0.0

    def variance(self, component: int) -> float:
        """The eigenvalue of a component, from 0; 0 where it is no more than rounding."""
        value = float(self.values[component])
        return value if value > NOISE * max(float(self.values[0]), 0.0) else 0.0

    def project(self, x: np.ndarray, components: int) -> np.ndarray:
        """Whitened rows; nan in components without variance."""
        means = [divmod(s, self.n) for s in self.sums]
        whole_part = np.array([q for q, _ in means], dtype=np.int64)
        rest = np.array([r / self.n for _, r in means])
        scale = np.array([self.variance(k) for k in range(components)])
        centred = (x - whole_part).astype(np.float64) - rest
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(scale > 0, centred @ self.vectors[:, :components] / np.sqrt(scale), np.nan)

    def deviation(self, x: np.ndarray) -> list[int]:
        """The exact sum over dimensions of ``(n * x - sum) ** 2``."""
        whole_part = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n for s in self.sums], dtype=object)
        apart = x - whole_part
        reach = self.n * (int(np.abs(apart).max(initial=0)) + 1)
        if reach * reach * self.width < 1 << 63:
            return ((self.n * apart - rest.astype(np.int64)) ** 2).sum(axis=1).tolist()
        return ((self.n * apart.astype(object) - rest) ** 2).sum(axis=1).tolist()


def _moments(fit: Whitening, components: int, means: np.ndarray | None):
    """Sums of whitened rows, or with their means of products of centred rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (components, 1 if means is None else components)
        total = np.zeros(shape)
        for batch in batches:
            if len(batch):
                w = fit.project(matrix(batch.column(0)), components)
                total += w.sum(axis=0)[:, None] if means is None else (w - means).T @ (w - means)
        a, b = np.indices(shape)
        columns = [pa.array(part.ravel()) for part in (a, b, total)]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "value"])

    return rows


def _summed(distinct: DataFrame, fit: Whitening, components: int, means: np.ndarray | None):
    out = np.zeros((components, 1 if means is None else components))
    parts = distinct.mapInArrow(_moments(fit, components, means), "a bigint, b bigint, value double")
    for a, b, value in parts.groupBy("a", "b").agg(F.sum("value")).toLocalIterator():
        out[a, b] = value / fit.n
    return out


def identity_error(distinct: DataFrame, fit: Whitening, components: int) -> float | None:
    """The largest absolute entry of the whitened rows' covariance minus the identity.

    Components without variance are left out; None where none has any.
    """
    means = _summed(distinct, fit, components, None)[:, 0]
    covariance = _summed(distinct, fit, components, means)
    live = np.flatnonzero([fit.variance(k) > 0 for k in range(components)])
    if not len(live):
        return None
    return float(np.abs(covariance[np.ix_(live, live)] - np.eye(len(live))).max())


def _answers(fit: Whitening, components: int, error: float | None):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        explained = np.array(
            [float(fit.values[k]) / fit.trace if fit.trace else 0.0 for k in range(components)]
        )
        for batch in batches:
            many = len(batch)
            if not many:
                continue
            x = matrix(batch.column(1))
            whitened = fit.project(x, components).ravel()
            deviation = pa.array(fit.deviation(x), type=pa.decimal128(38, 0))
            ids = np.repeat(np.arange(many), components)
            columns = [
                batch.column(0).take(pa.array(ids)),
                pa.array(np.tile(np.arange(1, components + 1, dtype=np.int32), many)),
                pa.array(np.full(len(ids), fit.n, dtype=np.int64)),
                deviation.take(pa.array(ids)),
                pa.array(whitened, mask=np.isnan(whitened)),
                pa.array(np.tile(explained, many)),
                pa.array([error] * len(ids), type=pa.float64()),
            ]
            names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows


def whiten(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    components: int = 16,
    scale: int = 64,
    offset: int = 1_000_000,
) -> DataFrame:
    """One row per usable row of ``vectors`` and component, from 1 by falling variance.

    Entries become ``x = floor(scale * c) + offset``.  The fit is over the distinct ``x`` vectors,
    ``n`` of them with sums ``S``; ``deviation`` is the exact ``sum (n * x - S) ** 2``, ``whitened``
    the projection of ``x - S / n`` over the root of the component's variance, ``explained`` the
    variance's share and ``identity_error`` how far the whitened rows' covariance is from the identity.

    Rows whose vector is null, empty or holds null or non-finite entries are dropped, and so are
    vectors shorter than the longest, as their last entries are missing.  Repeated rows count once
    in the fit and are answered each; rows with a null id are answered too; other columns are left
    out.  Components without variance (constant dimensions, few vectors) have null ``whitened``;
    without any variance ``explained`` is 0 and ``identity_error`` null.  An empty table gives an
    empty one.  Entries beyond ``2 ** 62`` count as that; deviations beyond 38 digits fail.
    Equal variances leave the choice of their components open.
    """
    given = vectors.select(F.col(id).alias("id"), F.expr(whole(vector, scale, offset)).alias("x"))
    kind = given.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    widest = given.agg(F.max(F.size("x"))).first()[0] or 0
    given = given.filter(F.size("x") == widest)
    distinct = stored(given.select("x").distinct())
    fit = Whitening(distinct)
    components = min(components, fit.width)
    error = identity_error(distinct, fit, components) if components else None
    out = given.mapInArrow(_answers(fit, components, error), schema)
    return out.withColumnRenamed("id", id)
