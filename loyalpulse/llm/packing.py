"""Packing of documents into sequences of bounded length by minimum bin slack.

Only the lengths of the pieces matter for a packing, and there are at most ``capacity`` of
them.  Spark counts the pieces of each length; for the counts, sequences are closed one
after the other, each with the fullest combination of the lengths still there, found by a
subset-sum table kept as one bitset per length.  A combination is used as long as its
lengths last, so the number of combinations is bounded by the lengths as well, however many
documents there are.  Every piece then finds its place from its rank among the pieces of
its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalpulse.llm.encode import encoded
from loyalpulse.llm.store import stored

CAPACITY = 2048
#: Pieces of one length that are numbered within one task, about.
RANKED_TOGETHER = 1_000
_RANK_BITS = 44


@dataclass(frozen=True)
class Combination:
    """``times`` sequences that each hold ``parts``: length and how often."""

    times: int
    parts: tuple[tuple[int, int], ...]


def _with_multiples(reach: int, length: int, count: int, mask: int) -> int:
    """Sums reachable when up to ``count`` pieces of ``length`` may be added."""
    step = 1
    while count > 0:
        taken = min(step, count)
        reach |= (reach << (taken * length)) & mask
        count -= taken
        step *= 2
    return reach


def minimum_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[Combination]:
    """Combinations that use up all lengths; of equally full ones, long pieces first."""
    lengths = sorted(length for length, count in counts.items() if count > 0)
    left = [counts[length] for length in lengths]
    usable = [min(c, capacity // n) for c, n in zip(left, lengths, strict=True)]
    mask = (1 << (capacity + 1)) - 1
    reach = [1] * (len(lengths) + 1)
    stale, out = 0, []
    while any(left):
        for i in range(stale, len(lengths)):
            reach[i + 1] = _with_multiples(reach[i], lengths[i], usable[i], mask)
        open_space = reach[-1].bit_length() - 1
        parts = []
        for i in range(len(lengths) - 1, -1, -1):
            if open_space == 0:
                break
            length = lengths[i]
            for used in range(min(usable[i], open_space // length), -1, -1):
                if reach[i] >> (open_space - used * length) & 1:
                    break
            if used:
                parts.append((i, used))
                open_space -= used * length
        times = min(left[i] // used for i, used in parts)
        stale = len(lengths)
        for i, used in parts:
            left[i] -= times * used
            now = min(left[i], capacity // lengths[i])
            if now != usable[i]:
                usable[i], stale = now, min(stale, i)
        out.append(Combination(times, tuple((lengths[i], used) for i, used in parts)))
    return out


class Places:
    """Where the pieces of each length go, by their rank among them."""

    def __init__(self, combinations: list[Combination]) -> None:
        taken: dict[int, int] = {}
        rows, first_sequence = [], 0
        for combination in combinations:
            offset = 0
            for length, used in combination.parts:
                rank = taken.get(length, 0)
                rows.append((length << _RANK_BITS | rank, rank, used, first_sequence, offset))
                taken[length] = rank + combination.times * used
                offset += length * used
            first_sequence += combination.times
        rows.sort()
        table = np.array(rows, dtype=np.int64).reshape(len(rows), 5)
        self._key, self._rank, self._used, self._sequence, self._offset = table.T.copy()

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self._key, length << _RANK_BITS | rank, "right") - 1
        within = rank - self._rank[at]
        sequence, slot = np.divmod(within, self._used[at])
        return self._sequence[at] + sequence, self._offset[at] + slot * length


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: documents, cut only where too long."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            row, number, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encoded(batch.column("text"), tokenizer)):
                ids = np.concatenate([ids, end])
                bounds = list(range(len(ids), 0, -capacity))[::-1]
                at = 0
                for k, upto in enumerate(bounds):
                    row.append(i)
                    number.append(k)
                    start.append(at)
                    length.append(upto - at)
                    crc.append(zlib.crc32(ids[at:upto].astype("<u4")))
                    at = upto
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        cut, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def ranked(cut: DataFrame) -> DataFrame:
    """Numbers the pieces of each length from 0.

    Pieces are spread over buckets by hash; a bucket's share of a length is numbered on
    its own and shifted by the shares before it, so a length that a third of all pieces
    have is numbered by many tasks.
    """
    buckets = max(1, cut.count() // RANKED_TOGETHER)
    spread = cut.withColumn("bucket", F.expr(f"pmod(xxhash64(doc_id, piece, ids_crc32), {buckets})"))
    shares = spread.groupBy("length", "bucket").count()
    before = shares.selectExpr(
        "length",
        "bucket",
        "sum(count) OVER (PARTITION BY length ORDER BY bucket) - count AS before",
    )
    numbered = spread.selectExpr(
        "*",
        "row_number() OVER (PARTITION BY length, bucket ORDER BY doc_id, piece, ids_crc32) - 1 AS own",
    )
    return numbered.join(before, ["length", "bucket"]).withColumn("rank", F.expr("own + before"))


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY
) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    A null text counts as empty, a document of its end id alone.  Documents longer than
    ``capacity`` are cut from their end, so only their first piece can be shorter.  Rows
    of one ``doc_id`` are documents of their own.
    """
    cut = stored(pieces(docs, tokenizer, end_id, capacity))
    # at most ``capacity`` rows, whatever the input
    counts = {row["length"]: row["count"] for row in cut.groupBy("length").count().collect()}
    places = Places(minimum_slack(counts, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = places(length, rank)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    rows = ranked(cut).selectExpr(
        "doc_id", "piece", "start", "length", "ids_crc32", "CAST(rank AS BIGINT) AS rank"
    )
    return rows.mapInArrow(
        place,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint",
    )
