"""Joins that stay fast when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def splittable_join(
    rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner"
) -> DataFrame:
    """Join on a text key whose hot values adaptive execution can split.

    A side just aggregated by the key is normally joined where it lies, which saves its
    shuffle but pins each key to one task.  Joining on a computed copy of the key makes
    both sides shuffle for the join, and only such joins are split.
    """
    copy = F.concat(F.col(key), F.lit("")).alias("_join_key")
    return (
        rows.select("*", copy)
        .join(lookup.select(copy, *(c for c in lookup.columns if c != key)), "_join_key", how)
        .drop("_join_key")
    )


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """An inner, left or full join on ``on`` that takes NULL as a value like any other."""
    named = right.withColumnsRenamed({name: f"_right_{name}" for name in on})
    same = reduce(lambda a, b: a & b, (left[n].eqNullSafe(named[f"_right_{n}"]) for n in on))
    joined = left.join(named, same, how)
    keys = [F.coalesce(left[n], named[f"_right_{n}"]).alias(n) for n in on]
    rest = [left[c] for c in left.columns if c not in on]
    return joined.select(*keys, *rest, *(named[c] for c in right.columns if c not in on))
