"""Near-duplicate documents by MinHash with tensored banding.

A table key needs ``2 * rows`` minhashes.  Instead of drawing them anew for each of
``collection ** 2`` tables, two collections of ``collection`` half-keys (``rows``
minhashes each) are drawn, and every pair of a half-key of the first and one of the
second forms a table: ``2 * collection * rows`` minhashes serve ``collection ** 2`` tables.
Two documents of similarity s share a table with probability
``(1 - (1 - s ** rows) ** collection) ** 2``: 0.9996 at 0.8, 0.999999 at 0.9.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalpulse.llm.components import components
from loyalpulse.llm.line_dedup import text_key
from loyalpulse.llm.store import discard, stored
from loyalpulse.llm.verify import confirmed
from loyalpulse.llm.words import mix, shingle_set, shingle_sets, utf8

ROWS = 3
COLLECTION = 12
CENTRES = 16
#: 64-bit words of a set's parity map.
MAP = 16

#: Heads of a bucket that its stray members are checked against.
HEADS = 8
#: Bytes of texts that are signed at once.
CHUNK = 1 << 18

#: From the sorted shingles of some sets and where each begins, a row of keys per set.
KeysOf = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(977)
    odd = random.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, random.integers(0, 2**63, count, dtype=np.uint64)


def half_keys(found: np.ndarray, starts: np.ndarray, rows: int, collection: int) -> np.ndarray:
    """The half-keys of both collections, a row per set; the sets begin at ``starts``."""
    odd, shift = _multipliers(2 * collection * rows)
    least = np.stack(
        [np.minimum.reduceat((found ^ shift[i]) * odd[i], starts) for i in range(len(odd))], axis=1
    )
    least = mix(least).reshape(len(starts), 2 * collection, rows)
    key = np.tile(np.arange(2 * collection, dtype=np.uint64), (len(starts), 1))
    for row in range(rows):
        key = mix(key * np.uint64(31) + least[:, :, row])
    return key


def parity_maps(found: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """Of each of ``count`` sets, ``64 * MAP`` bits: whether an odd number of shingles falls on it.

    The maps of two sets differ in no more bits than the sets do in shingles.
    """
    wide = 64 * MAP
    bit = (found >> np.uint64(32)).astype(np.int64) % wide
    odd = np.bincount(owner * wide + bit, minlength=count * wide).reshape(count, wide) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def tensored(collection: int) -> str:
    """SQL of all table keys of a row's half-keys."""
    return f"""flatten(transform(slice(keys, 1, {collection}), x ->
        transform(slice(keys, {collection + 1}, {collection}), y -> xxhash64(x, y))))"""


def _chunks(texts: Iterable[np.ndarray | None]) -> Iterator[list[np.ndarray | None]]:
    """Texts that lie in a row, about ``CHUNK`` bytes or one longer text at a time."""
    held, size = [], 0
    for text in texts:
        more = 0 if text is None else len(text)
        if held and (size + more > CHUNK or len(held) >= CHUNK // 64):
            yield held
            held, size = [], 0
        held.append(text)
        size += more
    if held:
        yield held


def signatures(units: DataFrame, width: int, keys_of: KeysOf) -> DataFrame:
    """Per unit its number of shingles, a 128-bit name of its set, its parity map and keys."""

    def rows_of(values: np.ndarray, sets: np.ndarray, total: int) -> pa.Array:
        """A list per unit: the rows of ``values`` of those that have a set, else null."""
        lengths = np.zeros(total, dtype=np.int64)
        lengths[sets] = values.shape[1]
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.ravel()))
        return pc.if_else(pa.array(lengths > 0), lists, pa.scalar(None, lists.type))

    def describe(texts: list[np.ndarray | None]) -> list[pa.Array]:
        found, owner = shingle_sets(texts, width)
        n = np.bincount(owner, minlength=len(texts))
        sets = np.flatnonzero(n)
        starts = (np.cumsum(n) - n)[sets]
        names = np.zeros((2, len(texts)), dtype=np.int64)
        keys = np.empty((0, 1), dtype=np.int64)
        if len(sets):
            names[0, sets] = np.add.reduceat(mix(found), starts).view(np.int64)
            other = mix(found ^ np.uint64(0x5BD1E995))
            names[1, sets] = np.add.reduceat(other, starts).view(np.int64)
            keys = keys_of(found, starts).view(np.int64)
        maps = parity_maps(found, owner, len(texts))[sets]
        lists = (rows_of(values, sets, len(texts)) for values in (maps, keys))
        return [pa.array(n.astype(np.int64)), *map(pa.array, names), *lists]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _chunks(utf8(batch.column("text"))):
                ids = batch.column("id").slice(at, len(texts))
                at += len(texts)
                columns = ["id", "n", "lo", "hi", "map", "keys"]
                yield pa.RecordBatch.from_arrays([ids, *describe(texts)], names=columns)

    kind = dict(units.dtypes)["id"]
    schema = f"id {kind}, n bigint, lo bigint, hi bigint, map array<bigint>, keys array<bigint>"
    return units.select("id", "text").mapInArrow(sign, schema)


def _alike_in_size(a: str, b: str, percent: int) -> str:
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def _alike_in_map(a: str, b: str, percent: int) -> str:
    apart = " + ".join(f"bit_count({a}.map[{i}] ^ {b}.map[{i}])" for i in range(MAP))
    shared = f"ceil({percent} * ({a}.n + {b}.n) / {100 + percent})"
    return f"{apart} <= {a}.n + {b}.n - 2 * {shared}"


def buckets(classes: DataFrame, every_key: str) -> DataFrame:
    """``(key, id, n, first, n_first)`` of every table key that two or more sets share.

    The first of a bucket is drawn by hash, one of ``CENTRES`` draws by key, so a large
    group is checked against about as many of its members and not against one alone.
    """
    keys = classes.selectExpr("id", "n", f"explode({every_key}) AS key")
    return keys.selectExpr(
        "key",
        "id",
        "n",
        f"""min(struct(xxhash64(id, pmod(key, {CENTRES})) AS draw, id, n))
            OVER (PARTITION BY key) AS head""",
        "count(*) OVER (PARTITION BY key) AS size",
    ).selectExpr("key", "id", "n", "head.id AS first", "head.n AS n_first", "size").filter("size > 1")


def near_groups(
    units: DataFrame, width: int, percent: int, keys_of: KeysOf, every_key: str = "keys"
) -> DataFrame:
    """``(id, n, component)`` of every unit ``(id, text)``; ids may be of any orderable type.

    Equal sets are merged first.  Members of a bucket are then checked against its first
    one, which joins almost all that belong together.  Members outside the largest
    component of their bucket are checked against ``HEADS`` more of it.  What is left,
    pairs of a bucket that lie in different components, passes an exact filter on the
    sets' parity maps and is checked in full.  So no link that the buckets offer is lost, and a group of
    thousands of copies never meets all its pairs.

    A unit without shingles or id has no component.
    """
    set_of = partial(shingle_set, width=width)
    signed = stored(signatures(units, width, keys_of))
    classes = (
        signed.filter("n > 0 AND id IS NOT NULL")
        .groupBy("lo", "hi")
        .agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    )
    shared = stored(buckets(classes, every_key))
    members = shared.select("id").distinct()
    texts = stored(
        units.select("id", "text").join(members, "id", "left_semi").dropDuplicates(["id"])
    )
    first = stored(
        shared.filter("id <> first AND " + _alike_in_size("n", "n_first", percent))
        .selectExpr("least(first, id) AS a", "greatest(first, id) AS b")
        .distinct()
    )
    links = stored(confirmed(first, texts, set_of, percent))
    maps = signed.groupBy("id").agg(F.first("map").alias("map"))
    fits = f"""p.component <> q.component AND {_alike_in_size("p.n", "q.n", percent)}
        AND {_alike_in_map("p", "q", percent)}"""
    pair = ["least(p.id, q.id) AS a", "greatest(p.id, q.id) AS b"]

    def mixed(known: DataFrame) -> DataFrame:
        """``(key, p, stray)`` of buckets of several components; strays are not of the largest."""
        placed = stored(
            shared.join(known.withColumnRenamed("node", "id"), "id", "left").selectExpr(
                "key", "id", "n", "coalesce(component, id) AS component"
            )
        )
        main = (
            placed.groupBy("key", "component")
            .count()
            .groupBy("key")
            .agg(F.max_by("component", "count").alias("main"), F.count("*").alias("parts"))
            .filter("parts > 1")
            .select("key", "main")
        )
        return stored(
            placed.join(main, "key")
            .join(maps, "id")
            .selectExpr("key", "struct(id, n, component, map) AS p", "component <> main AS stray")
        )

    def strays(of: DataFrame) -> DataFrame:
        return of.filter("stray").select("key", F.col("p").alias("q"))

    known = components(links)
    parts = mixed(known)
    drawn = [F.expr(f"min_by(p, xxhash64(p.id, key, {i}))") for i in range(HEADS)]
    heads = (
        parts.filter("NOT stray")
        .groupBy("key")
        .agg(F.array(*drawn).alias("heads"))
        .select("key", F.explode(F.array_distinct("heads")).alias("p"))
    )
    second = stored(
        strays(parts).join(heads, "key").filter(fits).selectExpr(*pair).distinct()
        .join(first, ["a", "b"], "left_anti")
    )
    more = stored(confirmed(second, texts, set_of, percent))
    if not more.isEmpty():
        links = links.unionByName(more)
        known = components(links)
        parts = mixed(known)
    rest = (
        strays(parts).join(parts.select("key", "p"), "key").filter(fits).selectExpr(*pair).distinct()
        .join(first, ["a", "b"], "left_anti")
        .join(second, ["a", "b"], "left_anti")
    )
    last = stored(confirmed(rest, texts, set_of, percent))
    if not last.isEmpty():
        known = components(links.unionByName(last))
    sets = (
        classes.select("lo", "hi", "id")
        .join(known.withColumnRenamed("node", "id"), "id", "left")
        .selectExpr("lo", "hi", "coalesce(component, id) AS component")
    )
    found = signed.drop("map", "keys").join(sets, ["lo", "hi"], "left")
    return found.selectExpr("id", "n", "if(id IS NULL, NULL, component) AS component")


def with_units(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with ``_unit``, the same for rows equal in id and text, and the units made for it.

    The unit of a document is its id.  Only texts that share an id with other texts get units
    of their own, below every id: ``(_unit, _doc, _copy)``, or None where no id is shared.  Ids
    must lie above -2 ** 62.
    """
    keyed = docs.withColumns({"_doc": F.col("doc_id").cast("bigint"), "_copy": text_key()})
    several = stored(
        keyed.filter("_doc IS NOT NULL")
        .groupBy("_doc")
        .agg(F.min("_copy").alias("least"), F.max("_copy").alias("most"))
        .filter("least <> most")
        .select("_doc")
    )
    if several.isEmpty():
        discard(several)
        return keyed.withColumn("_unit", F.col("_doc")).drop("_doc", "_copy"), None
    lowest = min(0, keyed.agg(F.min("_doc")).first()[0])
    made = stored(
        keyed.select("_doc", "_copy")
        .join(several, "_doc")
        .distinct()
        .withColumn("_unit", F.lit(lowest - 1) - F.monotonically_increasing_id())
    )
    discard(several)
    placed = keyed.join(made, ["_doc", "_copy"], "left")
    return placed.select(*docs.columns, F.coalesce("_unit", "_doc").alias("_unit")), made


def _unit_groups(units: DataFrame, width: int, percent: int, rows: int, collection: int) -> DataFrame:
    """``(_unit, n, part)`` of every row; units that are linked share a part."""
    keys_of = partial(half_keys, rows=rows, collection=collection)
    named = units.select(F.col("_unit").alias("id"), "text")
    found = near_groups(named, width, percent, keys_of, tensored(collection))
    return found.selectExpr("id AS _unit", "n", "coalesce(component, id) AS part")


def _joined_by_id(found: DataFrame, made: DataFrame) -> DataFrame:
    """``(doc_id, n, part)`` where the parts of one document's texts are one, named by its least id."""
    placed = stored(
        found.join(made.select("_unit", F.col("_doc").alias("owner")), "_unit", "left").selectExpr(
            "coalesce(owner, _unit) AS doc_id", "n", "part", "owner IS NOT NULL AS several"
        )
    )
    several = placed.filter("several").select("doc_id", "part").distinct()
    least = several.groupBy("doc_id").agg(F.min("part").alias("a"))
    links = several.join(least, "doc_id").select("a", F.col("part").alias("b"))
    whole = components(links).select(F.col("node").alias("part"), F.col("component").alias("_whole"))
    named = placed.join(whole, "part", "left").selectExpr(
        "doc_id", "n", "coalesce(_whole, part) AS part"
    )
    smallest = named.groupBy("part").agg(F.min("doc_id").alias("least"))
    return named.join(smallest, "part", "left").selectExpr("doc_id", "n", "least AS part")


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    rows: int = ROWS,
    collection: int = COLLECTION,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row.

    A null or wordless text has no shingles and is linked with nothing.  Rows of one
    ``doc_id`` count as one document, linked with whatever any of its texts is linked with;
    a row without id is no one's copy (component null, kept).
    """
    units, made = with_units(docs)
    found = _unit_groups(units, width, percent, rows, collection)
    found = found.withColumnRenamed("_unit", "doc_id") if made is None else _joined_by_id(found, made)
    return found.selectExpr(
        "doc_id",
        "n AS n_shingles",
        "part AS component_id",
        "coalesce(doc_id = part, true) AS kept",
    )


def without_near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    rows: int = ROWS,
    collection: int = COLLECTION,
) -> DataFrame:
    """One document of each group, that of the least id, with all its columns.

    Texts that share an id are documents of their own here, so a clean one is not lost with
    another's copy.  Of rows equal in id and text one stays; rows without id all stay.
    """
    units, made = with_units(docs)
    found = _unit_groups(units, width, percent, rows, collection).filter("_unit IS NOT NULL")
    if made is None:
        kept = found.filter("_unit = part").select("_unit").distinct()
    else:
        order = F.struct(F.coalesce("_doc", "_unit").alias("doc"), "_copy", "_unit")
        kept = (
            found.join(made, "_unit", "left")
            .groupBy("part")
            .agg(F.min(order).alias("first"))
            .select("first._unit")
        )
    chosen = units.filter("_unit IS NOT NULL").dropDuplicates(["_unit"]).join(kept, "_unit", "left_semi")
    return chosen.select(docs.columns).unionByName(docs.filter("doc_id IS NULL"))
