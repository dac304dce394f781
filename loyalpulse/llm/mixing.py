"""Mixing sources to target weights, block by block.

The words of each source's documents, laid in a row, are cut into blocks of ``block``
words.  A source's target in blocks is filled in passes: every pass goes through the
source's blocks in a pseudorandom order of its own, so after any number of slots no block
has been taken more than once oftener than another.  Output shards draw how many slots of
each source they hold from a multinomial distribution; slots drawn beyond a source's
target are void, and what a source then lacks fills one more shard.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalpulse.llm.store import stored
from loyalpulse.llm.words import mix, utf8, word_spans

WEIGHTS = (5.0, 2.0, 1.0)
MOST_PASSES = 3
BLOCK = 64
SHARD_SLOTS = 1024
#: Documents whose places within their source are summed up within one task, about.
PLACED_TOGETHER = 1_000
#: Texts that are cut and handed on together.
_CUT_TOGETHER = 500


def shares(sizes: Sequence[int], weights: Sequence[float], most: float = MOST_PASSES) -> list[float]:
    """Splits the sum of the sizes by weight; none gets more than ``most`` times its size.

    What a source cannot take is shared among the others by weight, until none is above.
    """
    target = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), float(sum(sizes))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if unit * weights[i] > most * sizes[i]}
        for i in full or open_:
            target[i] = most * sizes[i] if full else unit * weights[i]
        if not full:
            break
        left -= sum(target[i] for i in full)
        open_ -= full
    return target


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of ``range(size)`` per ``key``, applied to ``index``.

    Four rounds of a Feistel cipher on the next even number of bits; values that leave the
    range are enciphered again until they are back in it.
    """
    half = np.ones(len(size), dtype=np.uint64)
    while True:
        small = (np.uint64(1) << (half * np.uint64(2))) < size.astype(np.uint64)
        if not small.any():
            break
        half += small.astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), dtype=bool)
    while todo.any():
        left, right = out[todo] >> half[todo], out[todo] & low[todo]
        for turn in range(1, 5):
            scrambled = mix(right * np.uint64(2 * turn + 1) ^ mix(key[todo] + np.uint64(turn)))
            left, right = right, left ^ (scrambled & low[todo])
        out[todo] = left << half[todo] | right
        todo[todo] = out[todo] >= size[todo].astype(np.uint64)
    return out.astype(np.int64)


def _sized(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size, tie)`` of every row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [0 if t is None else len(word_spans(t)[0]) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["doc_id", "source", "tie"]).columns, pa.array(sizes, pa.int64())],
                names=["doc_id", "source", "tie", "size"],
            )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64("text").alias("tie"),
        "text",
    ).mapInArrow(count, "doc_id bigint, source string, tie bigint, size bigint")


class Mix:
    """A mix of ``docs``: its documents with their places, its sources and its slots."""

    def __init__(
        self,
        docs: DataFrame,
        weights: Sequence[float] = WEIGHTS,
        most: int = MOST_PASSES,
        block: int = BLOCK,
        seed: int = 1,
    ) -> None:
        self.spark, self.block, self.seed = docs.sparkSession, block, seed
        sized = stored(_sized(docs))
        # one row per source
        per_source = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
        found = [(row["source"], row["size"]) for row in per_source]
        found.sort(key=lambda s: (s[0] is None, s[0] or ""))
        sizes = [size for _, size in found]
        self.targets = shares(sizes, [weights[i % len(weights)] for i in range(len(sizes))], most)
        self.sizes = sizes
        self.blocks = [-(-size // block) for size in sizes]
        self.slots_of = [self._slots_for(t, s) for t, s in zip(self.targets, sizes, strict=True)]
        rows = [
            (i, name, size, float(target))
            for i, ((name, size), target) in enumerate(zip(found, self.targets, strict=True))
        ]
        schema = "s int, source string, source_size bigint, target double"
        self.sources = self.spark.createDataFrame(rows, schema)
        self.documents = stored(self._placed(sized))

    def _slots_for(self, target: float, size: int) -> int:
        passes, rest = divmod(target, size) if size else (0, 0)
        # the last block of a source may be shorter, so a pass counts in full blocks
        return int(passes) * -(-size // self.block) + min(round(rest / self.block), -(-size // self.block))

    def _placed(self, sized: DataFrame) -> DataFrame:
        """Where each document starts among the words of its source.

        Sums within a bucket of a source are shifted by the sums of the buckets before, so
        a source with most of the documents is summed up by many tasks.
        """
        known = sized.join(self.sources, sized.source.eqNullSafe(self.sources.source)).drop(
            self.sources.source
        )
        buckets = max(1, sized.count() // PLACED_TOGETHER)
        spread = known.withColumn("bucket", F.expr(f"pmod(xxhash64(doc_id, tie), {buckets})"))
        before = (
            spread.groupBy("s", "bucket")
            .agg(F.sum("size").alias("size"))
            .selectExpr("s", "bucket", "sum(size) OVER (PARTITION BY s ORDER BY bucket) - size AS before")
        )
        own = """sum(size) OVER (PARTITION BY s, bucket ORDER BY doc_id, tie
                 ROWS UNBOUNDED PRECEDING) - size AS own"""
        return (
            spread.selectExpr("*", own)
            .join(before, ["s", "bucket"])
            .selectExpr("doc_id", "tie", "s", "source", "size", "source_size", "target", "own + before AS start")
        )

    def shards(self) -> DataFrame:
        """``(shard, s, first, count)``: the slots of each source that a shard holds."""
        total = sum(self.slots_of)
        slots = max(SHARD_SLOTS, total // 10_000)
        count = -(-total // slots)
        odds = np.array(self.slots_of, dtype=np.float64) / max(total, 1)
        seed = self.seed

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                shard, s, n = [], [], []
                for k in batch.column("id").to_pylist():
                    size = min(slots, total - k * slots)
                    drawn = np.random.default_rng([seed, k]).multinomial(size, odds)
                    held = np.flatnonzero(drawn)
                    shard += [k] * len(held)
                    s += held.tolist()
                    n += drawn[held].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int64()), pa.array(s, pa.int32()), pa.array(n, pa.int64())],
                    names=["shard", "s", "n"],
                )

        drawn = self.spark.range(count).mapInArrow(draw, "shard bigint, s int, n bigint")
        wanted = self.spark.createDataFrame(
            list(enumerate(self.slots_of)), "s int, wanted bigint"
        ).selectExpr("s", f"CAST({count} AS BIGINT) AS shard", "wanted")
        # the last shard would take all that is wanted; what others hold before it is clipped
        rows = drawn.join(wanted.select("s", "wanted"), "s").select("shard", "s", "n", "wanted")
        rows = rows.unionByName(wanted.selectExpr("shard", "s", "wanted AS n", "wanted"))
        return rows.selectExpr(
            "shard", "s", "n", "wanted", "sum(n) OVER (PARTITION BY s ORDER BY shard) - n AS first"
        ).selectExpr("shard", "s", "first", "least(n, wanted - first) AS count").filter("count > 0")

    def slots(self) -> DataFrame:
        """``(shard, s, slot, pass, block)``: what each slot of each shard is filled with."""
        blocks, seed = np.array(self.blocks, dtype=np.int64), np.uint64(self.seed)

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                s = batch.column("s").to_numpy(zero_copy_only=False).astype(np.int64)
                slot = batch.column("slot").to_numpy(zero_copy_only=False)
                turn, within = np.divmod(slot, blocks[s])
                key = mix(mix(s.astype(np.uint64) + seed * np.uint64(1 << 32)) + turn.astype(np.uint64))
                block = permuted(within, blocks[s], key)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(turn), pa.array(block)],
                    names=["shard", "s", "slot", "pass", "block"],
                )

        rows = self.shards().selectExpr(
            "shard", "s", "explode(sequence(first, first + count - 1)) AS slot"
        )
        return rows.repartition("s", "slot").mapInArrow(
            fill, "shard bigint, s int, slot bigint, pass bigint, block bigint"
        )

    def segments(self) -> DataFrame:
        """``(s, source, block, doc_id, tie, start, from, upto)``: a document's words in each block."""
        size = self.block
        parts = self.documents.filter("size > 0").selectExpr(
            "*", f"explode(sequence(start DIV {size}, (start + size - 1) DIV {size})) AS block"
        )
        return parts.selectExpr(
            "s",
            "source",
            "block",
            "doc_id",
            "tie",
            "start",
            f"greatest(block * {size} - start, 0) AS `from`",
            f"least((block + 1) * {size} - start, size) AS upto",
        )

    def taken(self) -> DataFrame:
        """Each segment with the number of times the mix takes it."""
        times = self.slots().groupBy("s", "block").agg(F.count("*").alias("times"))
        return self.segments().join(times, ["s", "block"])

    def per_document(self) -> DataFrame:
        """``(doc_id, size, source_size, target, taken)`` of every row of ``docs``.

        A null or wordless text has size 0 and none of it is taken.  Documents without a
        source form a source of their own, the last.
        """
        words = (
            self.taken()
            .groupBy("s", "start", "doc_id")
            .agg(F.sum(F.expr("times * (upto - `from`)")).alias("taken"))
            .select("s", "start", "taken")
        )
        whole = self.documents.filter("size > 0").join(words, ["s", "start"], "left")
        empty = self.documents.filter("size = 0").withColumn("taken", F.lit(0).cast("bigint"))
        columns = ["doc_id", "size", "source_size", "target"]
        return whole.unionByName(empty, allowMissingColumns=True).select(
            *columns, F.coalesce("taken", F.lit(0)).alias("taken")
        )


def _cut(text: np.ndarray, spans: list[tuple[int, int]]) -> bytes:
    """The words of the spans, neighbours joined, others on lines of their own."""
    starts, ends = word_spans(text)
    joined: list[list[int]] = []
    for a, b in sorted(spans):
        if joined and joined[-1][1] == a:
            joined[-1][1] = b
        else:
            joined.append([a, b])
    if joined == [[0, len(starts)]]:
        return text.tobytes()
    return b"\n".join(text[starts[a] : ends[b - 1]].tobytes() for a, b in joined)


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix with the columns of ``docs``.

    A document gives one row for every pass that takes some of it: whole where all its
    blocks are taken, otherwise with the taken words alone.  ``n_chars``, where there is
    one, follows the text.  Of rows with the same id, source and text, each is mixed, with
    the other columns of one of them.
    """
    mixed = Mix(docs, **how)
    spans = (
        mixed.taken()
        .selectExpr("*", "explode(sequence(1, CAST(times AS INT))) AS turn")
        .groupBy("source", "start", "doc_id", "tie", "turn")
        .agg(F.collect_list(F.struct("from", "upto")).alias("_spans"))
        .selectExpr("doc_id AS _id", "tie AS _hash", "source AS _from", "_spans")
    )
    names = docs.columns
    rows = docs.withColumns(
        {
            "_doc": F.col("doc_id").cast("bigint"),
            "_tie": F.xxhash64("text"),
            "_source": F.col("source").cast("string"),
        }
    ).dropDuplicates(["_doc", "_tie", "_source"])
    joined = rows.join(
        spans,
        rows._doc.eqNullSafe(spans._id)
        & (rows._tie == spans._hash)
        & rows._source.eqNullSafe(spans._from),
    ).select(*(rows[name] for name in names), spans._spans)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = names.index("text")
        for batch in batches:
            for start in range(0, batch.num_rows, _CUT_TOGETHER):
                part = batch.slice(start, _CUT_TOGETHER)
                every = part.column("_spans").to_pylist()
                texts = [
                    _cut(text, [(s["from"], s["upto"]) for s in spans]).decode("utf-8", "replace")
                    for text, spans in zip(utf8(part.column("text")), every, strict=True)
                ]
                columns = part.columns[:-1]
                columns[place] = pa.array(texts, part.schema.field("text").type)
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(part.schema)[:-1]))

    out = joined.mapInArrow(cut, docs.schema)
    if "n_chars" in names:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.char_length("text").cast(kind))
    return out
