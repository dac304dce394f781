"""Exact check of candidate pairs on their whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalpulse.llm.words import same_share, utf8

SetOf = Callable[[np.ndarray], np.ndarray]


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two non-empty sorted sets."""
    if len(a) == 0 or len(b) == 0:
        return False
    both, union = same_share(a, b)
    return 100 * both >= percent * union


def confirmed(pairs: DataFrame, texts: DataFrame, set_of: SetOf, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose texts ``(id, text)`` have sets that are alike.

    Both joins are plain equi-joins on an id, so a text with very many partners is split
    by adaptive execution; only one pair at a time is in memory.
    """
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None
        for batch in batches:
            ids_b = batch.column("b").to_pylist()
            keep = np.zeros(batch.num_rows, dtype=bool)
            texts_a, texts_b = utf8(batch.column("text_a")), utf8(batch.column("text_b"))
            for i, (one, other) in enumerate(zip(texts_a, texts_b, strict=True)):
                if last is None or last != ids_b[i]:
                    last, kept = ids_b[i], set_of(other)
                keep[i] = alike(set_of(one), kept, percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    kinds = dict(joined.dtypes)
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(
        check, f"a {kinds['a']}, b {kinds['b']}"
    )
