"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalpulse.llm.store import stored


def _nearest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every linked node; the component is its smallest node.

    Rounds of two steps move links towards the smallest node: first every node hands its
    larger neighbours to its smallest one, then its smaller ones.  Chains shorten by a
    constant factor a round, and a node with very many links only ever meets a join that
    adaptive execution can split.  Each round is a written table; nothing is collected
    but the number and checksum of the links, which tell when they stop changing.
    """
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    )
    seen = _fingerprint(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = _nearest(both).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        large = stored(large)
        # in `large` every v is smaller than its u
        down = large.join(_nearest(large), "u")
        small = down.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = stored(small.unionByName(_nearest(large).withColumnRenamed("m", "v")).distinct())
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
