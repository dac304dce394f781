"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector passes it if it lies in the cap around it.  Directions
form a random product code: each of two halves of a vector's coordinates has its own list
of random unit vectors, and every pair of one of each, joined, is a direction.  So a vector
is compared with ``2 * size`` short vectors, and the sorted scores of the two halves are
merged to list exactly the filters it passes, out of ``size ** 2``.

Cap height and code size follow the width and the number of vectors: a filter is passed by few unlike
vectors, and two vectors at the least similarity share ``EXPECTED_SHARED`` filters of a
code on average.  As the filters of one code are not independent, several codes are drawn;
how many follows from the measured chance that such a pair shares no filter of a code.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalpulse.llm.components import components
from loyalpulse.llm.store import stored
from loyalpulse.llm.vectors import matrix, unit, usable

#: Filters of one code that two vectors at the least similarity share, on average.
EXPECTED_SHARED = 3.0
#: Chance that two vectors at the least similarity share no filter of any code.
MISSED = 1e-4
#: Unlike vectors that pass one filter, about.
UNLIKE_IN_FILTER = 16.0
#: Vectors of one filter that are compared with each other, or with as many others, at once.
BLOCK = 512
#: Most pairs at the least similarity that one code may miss; wider caps are taken before.
MOST_MISSED = 0.5
#: Fewest coordinates, widest cap as a share of the sphere, and most short vectors of a half
#: with which filters are used at all; otherwise all pairs of a label are compared.
LEAST_WIDTH, WIDEST, MOST_SHORT = 4, 0.1, 1 << 13
#: Rows, of many filters, that one task call compares.
COMPARED_TOGETHER = 16_384


def _caps(width: int, steps: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Angles from 0 to pi, and the share of the sphere in ``width`` dimensions within each."""
    angle = np.linspace(0, math.pi, steps + 1)
    if width < 2:  # two points
        return angle, np.where(angle < math.pi, 0.5, 1.0)
    middle = (angle[1:] + angle[:-1]) / 2
    share = np.cumsum(np.sin(middle) ** (width - 2))
    return angle, np.append(0.0, share / share[-1])


def _both_within(width: int, cap: float, similarity: float) -> float:
    """Share of directions within the angle ``cap`` of both of two vectors of that cosine."""
    at, share = _caps(width)
    edges = np.linspace(0, cap, 2001)
    ring = np.diff(np.interp(edges, at, share))
    middle = (edges[1:] + edges[:-1]) / 2
    apart = math.sqrt(1 - min(similarity, 1 - 1e-12) ** 2)
    least = (math.cos(cap) - similarity * np.cos(middle)) / (apart * np.sin(middle))
    within = np.interp(np.arccos(np.clip(least, -1, 1)), *_caps(width - 1))
    return float(ring @ np.where(least > 1, 0.0, within))


class ProductCodes:
    """The filters for vectors of ``width`` coordinates of which there are about ``count``.

    Caps are widened until a code misses at most ``MOST_MISSED`` of the pairs at the least
    similarity.  Where only caps of much of the sphere would do, there is one filter that
    all vectors pass (``all_pairs``), so they are all compared, in blocks.
    """

    def __init__(self, width: int, count: int, similarity: float, seed: int = 5) -> None:
        self._width, self._seed = width, seed
        self.all_pairs = width < LEAST_WIDTH
        share = min(0.02, UNLIKE_IN_FILTER / max(count, 1))
        while not self.all_pairs:
            at, shares = _caps(width)
            cap = float(np.interp(share, shares, at))
            self.height = math.sqrt(width) * math.cos(cap)
            wanted = EXPECTED_SHARED / max(_both_within(width, cap, similarity), 1e-300)
            self.size = max(4, math.ceil(math.sqrt(wanted)))
            if self.size <= MOST_SHORT:
                self._codes = [self._code(0)]
                missed = self._missed(similarity)
                if missed <= MOST_MISSED:
                    count_of_codes = max(2, math.ceil(math.log(MISSED) / math.log(missed)))
                    self._codes += [self._code(k) for k in range(1, count_of_codes)]
                    break
            share *= 2
            self.all_pairs = share > WIDEST
        #: Blocks of the commonest label that every vector meets, if all pairs are compared.
        self.blocks = math.ceil(count / BLOCK) if self.all_pairs else 0

    def _code(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A rotation and the short vectors of both halves."""
        random = np.random.default_rng([self._seed, k, self._width, self.size])
        rotation = np.linalg.qr(random.normal(size=(self._width, self._width)))[0]
        halves = []
        for w in ((self._width + 1) // 2, self._width // 2):
            rows = random.normal(size=(self.size, w))
            halves.append(math.sqrt(w) * rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300))
        return rotation, halves[0], halves[1]

    def _missed(self, similarity: float, trials: int = 500) -> float:
        """Share of random pairs of that similarity without a common filter of the first code.

        It is estimated from above, by three standard errors.
        """
        random = np.random.default_rng([self._seed, self._width])
        one = unit(random.normal(size=(trials, self._width)))
        other = random.normal(size=(trials, self._width))
        other -= (one * other).sum(axis=1, keepdims=True) * one
        other = similarity * one + math.sqrt(1 - similarity**2) * unit(other + 1e-12)
        both = zip(self.filters(one), self.filters(other), strict=True)
        found = sum(not len(np.intersect1d(a, b)) for a, b in both)
        return (found + 3 * math.sqrt(found) + 3) / trials

    def filters(self, rows: np.ndarray) -> list[np.ndarray]:
        """The filters that each unit vector passes, ascending."""
        if self.all_pairs:
            return [np.zeros(1, dtype=np.int64) for _ in rows]
        out: list[list[np.ndarray]] = [[] for _ in rows]
        for k, (rotation, left, right) in enumerate(self._codes):
            turned = rows @ rotation
            first, second = turned[:, : left.shape[1]] @ left.T, turned[:, left.shape[1] :] @ right.T
            order = np.argsort(-second, axis=1)
            falling = -np.take_along_axis(second, order, axis=1)
            many = first - falling[:, :1] >= self.height
            base = k * self.size**2
            for r in np.flatnonzero(many.any(axis=1)):
                near = np.flatnonzero(many[r])
                last = np.searchsorted(falling[r], first[r, near] - self.height, "right")
                out[r] += [base + i * self.size + order[r, :n] for i, n in zip(near.tolist(), last.tolist(), strict=True)]
        empty = [np.empty(0, dtype=np.int64)]
        return [np.sort(np.concatenate(parts or empty)).astype(np.int64) for parts in out]


def _members(classes: DataFrame, codes: dict[int, ProductCodes]) -> DataFrame:
    """``(label, width, filter, id, copies, passed, vector)``, a row per filter passed."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy(zero_copy_only=False)
            for width in np.unique(widths):
                part = batch.filter(pa.array(widths == width))
                found = codes[int(width)].filters(unit(matrix(part.column("vector")).astype(np.float64)))
                for at in range(0, len(found), 64):
                    own = found[at : at + 64]
                    many = np.array([len(f) for f in own])
                    row = pa.array(np.repeat(np.arange(at, at + len(own)), many))
                    if len(row) == 0:
                        continue
                    passed = pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32)),
                        pa.array(np.concatenate(own)),
                    )
                    columns = [part.column(c).take(row) for c in ("label", "width", "id", "copies")]
                    columns += [
                        pa.array(np.concatenate(own)),
                        passed.take(pa.array(np.asarray(row) - at)),
                        part.column("vector").take(row),
                    ]
                    yield pa.RecordBatch.from_arrays(
                        columns, names=["label", "width", "id", "copies", "filter", "passed", "vector"]
                    )

    kinds = dict(classes.dtypes)
    schema = (
        f"label {kinds['label']}, width int, id bigint, copies bigint, "
        f"filter bigint, passed array<bigint>, vector {kinds['vector']}"
    )
    return classes.select("label", "width", "id", "copies", "vector").mapInArrow(spread, schema)


def _pairs(
    rows: np.ndarray, block: np.ndarray, here: int, passed: list[np.ndarray], least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of one filter that are linked and share no filter smaller than ``here``."""
    linked = rows @ rows.T >= least
    linked &= np.triu(np.ones(linked.shape, dtype=bool), 1)
    if block.min() != block.max():  # two blocks: each is compared with the other only
        linked &= block[:, None] != block[None, :]
    a, b = np.nonzero(linked)
    if len(a) == 0:
        return a, b
    owner = np.repeat(np.arange(len(rows)), [len(p) for p in passed])
    names = np.concatenate(passed)
    owner, names = owner[names < here], names[names < here]
    if len(names):
        _, column = np.unique(names, return_inverse=True)
        before = np.zeros((len(rows), column.max() + 1), dtype=np.float32)
        before[owner, column] = 1
        fresh = (before @ before.T)[a, b] == 0
        a, b = a[fresh], b[fresh]
    return a, b


def _forest(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """For every row the first row that it is joined to by the pairs."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def _linked(classes: DataFrame, codes: dict[int, ProductCodes], least: float) -> DataFrame:
    """``(id, n, root)`` from every filter: links first found there and one linked vector.

    A filter with many vectors is cut into blocks, and every two blocks meet on their own.
    Filters are compared many to a call.  What leaves it is a row per vector, not per pair.
    """
    members = _members(classes, codes)
    key = ["label", "width", "filter"]
    sizes = members.groupBy(key).agg(F.count("*").alias("size")).filter(f"size > {BLOCK}")
    blocks = f"CAST(ceil(coalesce(size, 1) / {BLOCK}) AS INT)"
    met = (
        members.join(sizes, key, "left")
        .selectExpr("*", f"pmod(xxhash64(id), {blocks}) AS block", f"{blocks} AS blocks")
        .selectExpr("*", "explode(sequence(0, blocks - 1)) AS other")
        .selectExpr(
            *key,
            "CAST(least(block, other) AS INT) AS one",
            "CAST(greatest(block, other) AS INT) AS two",
            "CAST(block AS INT) AS block",
            "id",
            "copies",
            "passed",
            "vector",
        )
    )
    a_vector = 24 + max((c.blocks for c in codes.values()), default=0)
    calls = max(1, a_vector * classes.count() // COMPARED_TOGETHER)
    grouped = met.withColumn("call", F.expr(f"pmod(xxhash64(label, width, filter, one, two), {calls})"))

    def compare(table: pa.Table) -> pa.Table:
        part = table.drop_columns(["passed", "vector"]).to_pandas()
        part["label"] = part["label"].factorize()[0]
        order = np.lexsort([part[c] for c in ("two", "one", "filter", "width", "label")])
        keys = part[["label", "width", "filter", "one", "two"]].to_numpy()[order]
        changes = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = np.concatenate([[0], changes, [len(order)]])
        ids, copies, block = (part[c].to_numpy() for c in ("id", "copies", "block"))
        passed_all, vectors = (table.column(c).combine_chunks() for c in ("passed", "vector"))
        starts = passed_all.offsets.to_numpy()
        names = passed_all.values.to_numpy(zero_copy_only=False)
        first, values = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
        out = [(np.empty(0, np.int64),) * 3]
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            if high - low < 2:
                continue
            own = order[low:high]
            rows = unit(np.stack([values[first[i] : first[i + 1]] for i in own]).astype(np.float64))
            passed = [names[starts[i] : starts[i + 1]] for i in own]
            a, b = _pairs(rows, block[own], int(keys[low, 2]), passed, least)
            if len(a) == 0:
                continue
            n = np.zeros(len(own), dtype=np.int64)
            np.add.at(n, a, copies[own][b])
            np.add.at(n, b, copies[own][a])
            keep = n > 0
            root = _forest(a, b, len(own))
            out.append((ids[own][keep], n[keep], ids[own][root[keep]]))
        return pa.table(dict(zip(("id", "n", "root"), map(np.concatenate, zip(*out, strict=True)), strict=True)))

    return grouped.groupBy("call").applyInArrow(compare, "id bigint, n bigint, root bigint")


def near_vectors(
    vectors: DataFrame,
    least: float = 0.98,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row of ``vectors``.

    Two vectors are linked if their labels are equal and not null and their cosine, in
    double precision, is ``least`` or more.  Equal vectors are merged before the search.
    Vectors that are null, empty, zero or hold null or non-finite parts, and rows without
    label or id, are linked with nothing; so are vectors of different lengths.
    """
    rows = vectors.select(
        F.col(id_column).cast("bigint").alias("vec_id"),
        F.col(label_column).alias("label"),
        F.col(vector_column).alias("vector"),
    ).withColumn("usable", usable("vector") & F.expr("label IS NOT NULL AND vec_id IS NOT NULL"))
    classes = stored(
        rows.filter("usable")
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
        .withColumn("width", F.size("vector"))
    )
    # a row per vector length, and the count of the commonest label there
    widths = classes.groupBy("width", "label").count().groupBy("width").agg(F.max("count").alias("n"))
    codes = {row["width"]: ProductCodes(row["width"], row["n"], least) for row in widths.collect()}
    found = stored(_linked(classes, codes, least))
    own = found.groupBy("id").agg(F.sum("n").alias("n"))
    joined = components(found.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    known = (
        classes.select("label", "vector", "id", "copies")
        .join(own, "id", "left")
        .join(joined.withColumnRenamed("node", "id"), "id", "left")
        .selectExpr(
            "label",
            "vector",
            "coalesce(n, 0) + copies - 1 AS n_links",
            "coalesce(component, id) AS component_id",
        )
    )
    linked = rows.filter("usable").join(known, ["label", "vector"])
    alone = rows.filter("NOT coalesce(usable, false)").withColumns(
        {"n_links": F.lit(0).cast("bigint"), "component_id": F.col("vec_id")}
    )
    columns = ["vec_id", "n_links", "component_id"]
    return (
        linked.select(*columns)
        .unionByName(alone.select(*columns))
        .withColumn("kept", F.expr("coalesce(vec_id = component_id, true)"))
    )
