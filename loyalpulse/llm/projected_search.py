"""Nearest vectors by inner product through stable projections and kd-trees.

Vectors are scaled to at most length 1 and given one more coordinate that makes it 1, so
the largest inner product is the smallest distance.  A Gaussian projection to
``PROJECTED`` dimensions multiplies a squared distance by a chi-square variable of that
many degrees.  A kd-tree over the projections, its upper levels split on a bounded sample,
deals all rows to leaves; inside a task each leaf's part has its lower levels.  A query
meets the boxes of the tree by rising projected distance, verifies their vectors exactly
and stops once the next box is so far that a vector nearer than the k-th found would lie
there with a probability below ``1 - CONFIDENCE``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalpulse.llm.store import stored
from loyalpulse.llm.vectors import matrix, usable

PROJECTED = 8
CONFIDENCE = 0.97
#: Rows from which the upper splits and each query's first bound are taken, at most.
SAMPLE = 4_096
MOST_LEAVES = 4_096
#: Vectors of one leaf that a task searches together, and queries it does that for.
LEAF_ROWS, QUERY_ROWS = 8_192, 2_048
BOX_ROWS = 64
_RESULT = "query_id bigint, vec_id bigint, score double"


def chi_square_quantile(p: float, degrees: int) -> float:
    """For an even number of degrees."""
    low, high = 0.0, 50.0 * degrees
    for _ in range(200):
        x = (low + high) / 2
        term, total = 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        low, high = (x, high) if 1 - math.exp(-x / 2) * total < p else (low, x)
    return (low + high) / 2


class Space:
    """Scaling and projection of the vectors of one width."""

    def __init__(self, width: int, longest: float, seed: int = 11) -> None:
        self.longest = longest
        self._directions = np.random.default_rng([seed, width]).normal(size=(width + 1, PROJECTED))

    def points(self, rows: np.ndarray) -> np.ndarray:
        rows = rows / self.longest
        rest = np.sqrt(np.maximum(0, 1 - (rows**2).sum(axis=1)))
        return rows @ self._directions[:-1] + rest[:, None] * self._directions[-1]

    def queries(self, rows: np.ndarray) -> np.ndarray:
        return rows / np.linalg.norm(rows, axis=1, keepdims=True) @ self._directions[:-1]

    def squared_distance(self, score: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Of a query of that length to a vector with that inner product."""
        return np.maximum(0, 2 - 2 * score / (length * self.longest))


def median_splits(points: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """Dimension and value of every split of a balanced tree, level by level."""
    groups, splits = [points], []
    for _ in range(depth):
        halves = []
        for group in groups:
            spread = np.ptp(group, axis=0) if len(group) else np.zeros(points.shape[1])
            axis = int(spread.argmax())
            value = float(np.median(group[:, axis])) if len(group) else 0.0
            splits.append((axis, value))
            halves += [group[group[:, axis] < value], group[group[:, axis] >= value]]
        groups = halves
    return splits


def leaves(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    node = np.zeros(len(points), dtype=np.int64)
    if splits:
        axis = np.array([a for a, _ in splits])
        value = np.array([v for _, v in splits])
        for _ in range((len(splits) + 1).bit_length() - 1):
            right = points[np.arange(len(points)), axis[node]] >= value[node]
            node = 2 * node + 1 + right
    return node - len(splits)


class LocalTree:
    """Lower levels of the tree for one part of a leaf: boxes of about ``BOX_ROWS`` rows."""

    def __init__(self, points: np.ndarray) -> None:
        depth = max(0, math.ceil(math.log2(max(1, len(points) / BOX_ROWS))))
        node = leaves(points, median_splits(points, depth))
        self.order = np.argsort(node, kind="stable")
        self.bounds = np.searchsorted(node[self.order], np.arange(2**depth + 1))
        filled = np.flatnonzero(np.diff(self.bounds))
        self.boxes = [(self.bounds[i], self.bounds[i + 1]) for i in filled]
        sorted_points = points[self.order]
        self.low = np.array([sorted_points[a:b].min(axis=0) for a, b in self.boxes])
        self.high = np.array([sorted_points[a:b].max(axis=0) for a, b in self.boxes])


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    out = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        p = points[:, axis, None]
        out += np.maximum(0, np.maximum(low[:, axis] - p, p - high[:, axis])) ** 2
    return out


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        keep = np.flatnonzero(score >= least)
        return keep[np.lexsort((ids[keep], -score[keep]))[:k]]
    return np.lexsort((ids, -score))[:k]


def _search_part(
    space: Space, ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
    limits: np.ndarray, k: int, stop: float,
) -> tuple[list, list, list]:
    tree = LocalTree(space.points(rows))
    ids, rows = ids[tree.order], rows[tree.order]
    far = box_distance(space.queries(queries), tree.low, tree.high)
    near_first = np.argsort(far, axis=1)
    lengths = np.linalg.norm(queries, axis=1)
    out: tuple[list, list, list] = ([], [], [])
    for q, (own, query) in enumerate(zip(query_ids, queries, strict=True)):
        bound = limits[q]
        kept_ids, kept = np.empty(0, np.int64), np.empty(0)
        at, batch = 0, 4
        while at < len(near_first[q]):
            upto = at + batch
            boxes = [i for i in near_first[q, at:upto] if far[q, i] <= bound * stop]
            if not boxes:
                break
            place = np.concatenate([np.arange(*tree.boxes[i]) for i in boxes])
            score = rows[place] @ query
            found = ids[place]
            other = found != own
            kept_ids = np.concatenate([kept_ids, found[other]])
            kept = np.concatenate([kept, score[other]])
            best = _best(kept, kept_ids, k)
            kept_ids, kept = kept_ids[best], kept[best]
            if len(kept) == k:
                bound = min(bound, float(space.squared_distance(kept[-1], lengths[q])))
            at, batch = upto, 2 * batch
        out[0].append(np.full(len(kept), own))
        out[1].append(kept_ids)
        out[2].append(kept)
    return out


def _search_width(rows: DataFrame, width: int, count: int, longest: float, k: int, every: int) -> DataFrame:
    space = Space(width, longest)
    stop = chi_square_quantile(CONFIDENCE, PROJECTED)
    # a bounded sample, by hash; all rows where there are few
    share = min(1.0, 0.9 * SAMPLE / count) if count > SAMPLE else 1.0
    sample = (
        rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)))
        .limit(SAMPLE)
        .select("id", "vector")
        .collect()
    )
    known = np.array([r["vector"] for r in sample], dtype=np.float64).reshape(len(sample), width)
    known_ids = np.array([r["id"] for r in sample], dtype=np.int64)
    depth = min(int(math.log2(MOST_LEAVES)), max(0, math.ceil(math.log2(count / LEAF_ROWS))))
    splits = median_splits(space.points(known), depth)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = space.points(matrix(batch.column("vector")).astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(leaves(points, splits)),
                    pa.FixedSizeListArray.from_arrays(pa.array(points.ravel()), PROJECTED).cast(
                        pa.list_(pa.float64())
                    ),
                ],
                names=["id", "vector", "leaf", "point"],
            )

    kind = dict(rows.dtypes)["vector"]
    index = stored(
        rows.select("id", "vector").mapInArrow(
            deal, f"id bigint, vector {kind}, leaf bigint, point array<double>"
        )
    )
    # one row per leaf: how many rows it has and the box around them
    sides = [f"{f}(point[{i}]) AS {f}{i}" for f in ("min", "max") for i in range(PROJECTED)]
    boxes = index.groupBy("leaf").agg(F.count("*").alias("n"), *map(F.expr, sides)).orderBy("leaf").collect()
    leaf_ids = np.array([b["leaf"] for b in boxes])
    low = np.array([[b[f"min{i}"] for i in range(PROJECTED)] for b in boxes])
    high = np.array([[b[f"max{i}"] for i in range(PROJECTED)] for b in boxes])
    parts = {b["leaf"]: -(-b["n"] // LEAF_ROWS) for b in boxes}

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queries = matrix(batch.column("vector")).astype(np.float64)
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            score = queries @ known.T
            score[ids[:, None] == known_ids] = -np.inf
            lengths = np.linalg.norm(queries, axis=1)
            if score.shape[1] > k:
                kth = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
                limit = space.squared_distance(kth, lengths)
            else:
                limit = np.full(len(ids), np.inf)
            reach = box_distance(space.queries(queries), low, high) <= limit[:, None] * stop
            q, leaf = np.nonzero(reach)
            count_of = np.array([parts[x] for x in leaf_ids.tolist()])[leaf]
            each = np.repeat(np.arange(len(q)), count_of)
            part = np.arange(len(each)) - np.repeat(np.cumsum(count_of) - count_of, count_of)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(q[each])),
                    batch.column("vector").take(pa.array(q[each])),
                    pa.array(leaf_ids[leaf[each]]),
                    pa.array(part),
                    pa.array(limit[q[each]]),
                ],
                names=["id", "vector", "leaf", "part", "bound"],
            )

    queries = rows.filter(F.col("id") % every == 0).select("id", "vector")
    turns = max(1, -(-queries.count() // QUERY_ROWS))
    asked = queries.mapInArrow(
        visit, f"id bigint, vector {kind}, leaf bigint, part bigint, bound double"
    ).withColumn("turn", F.expr(f"pmod(xxhash64(id), {turns})"))
    many = F.create_map(*(F.lit(x) for pair in parts.items() for x in pair))
    dealt = (
        index.select("id", "vector", "leaf")
        .withColumn("part", F.pmod(F.xxhash64("id", F.lit("part")), many[F.col("leaf")]))
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1)).cast("array<bigint>")))
    )

    def search(points: pa.Table, asked: pa.Table) -> pa.Table:
        if points.num_rows == 0 or asked.num_rows == 0:
            return pa.table({"query_id": [], "vec_id": [], "score": []}, schema=_schema)
        found = _search_part(
            space,
            points.column("id").to_numpy(),
            matrix(points.column("vector").combine_chunks()).astype(np.float64),
            asked.column("id").to_numpy(),
            matrix(asked.column("vector").combine_chunks()).astype(np.float64),
            asked.column("bound").to_numpy(),
            k,
            stop,
        )
        return pa.table([np.concatenate(c) for c in found], schema=_schema)

    key = ["leaf", "part", "turn"]
    return dealt.groupBy(key).cogroup(asked.groupBy(key)).applyInArrow(search, _RESULT)


_schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def nearest(
    vectors: DataFrame,
    every: int,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` found nearest to each query.

    Queries are the rows whose id is divisible by ``every``; all other rows are searched.
    The score is the inner product of the vectors as given, in double precision; ties go to
    the smaller id.  Vectors that are null, empty, zero or hold null or non-finite parts
    and rows without id take no part; vectors of different lengths never meet.  Rows that
    repeat an id and vector count once.
    """
    rows = (
        vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).alias("vector"))
        .filter(usable("vector") & F.col("id").isNotNull())
        .distinct()
        .withColumn("width", F.size("vector"))
        .withColumn(
            "length",
            F.expr("sqrt(aggregate(vector, 0D, (a, x) -> a + CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))"),
        )
    )
    rows = stored(rows)
    widths = rows.groupBy("width").agg(F.count("*").alias("n"), F.max("length").alias("longest")).collect()
    out = vectors.sparkSession.createDataFrame([], _RESULT)
    for w in widths:  # one round per vector length, usually the only one
        own = rows.filter(F.col("width") == w["width"])
        out = out.unionByName(_search_width(own, w["width"], w["n"], w["longest"], k, every))
    rank = "CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank"
    return (
        out.selectExpr("query_id", rank, "vec_id", "score").filter(f"rank <= {k}")
    )
