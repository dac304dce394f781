"""Near-duplicate lines by an exact set-similarity join.

A line is the set of its words.  Words are ordered from rare to common; two lines of
similarity ``percent`` / 100 share a word among the first few of each (the prefix), so only
lines that share one meet.  Before their whole sets are compared, pairs are filtered by
size, by the places of the shared word, and by a 128-bit parity map of the sets, whose
differing bits are at most the differing words.  All filters are exact.

A line is repeated if any earlier one is alike, so a set is first checked against the earlier
candidate whose map is nearest, which settles nearly all members of a group of near copies;
only sets still open are checked against their other candidates.

Rarity is counted over all lines in a table of fixed size by word hash.  Any order of words
keeps the join exact; words that share a cell only make a prefix a little commoner.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyalpulse.llm.store import discard, stored
from loyalpulse.llm.words import NEWLINE, mix, utf8, word_hashes

PERCENT = 80
#: Lines with fewer distinct words take no part; with 1, every line with a word does.
LEAST_WORDS = 1
CELLS = 1 << 18
#: Rows of one prefix word that are compared at once; commoner words go another, exact way.
SMALL = 512
#: Bits of the table that tells whose whole sets may be needed.
WANTED = 1 << 24
#: Words of 64 bits of the parity maps that spare most sets their whole comparison.
MAPS = 8
MAP_NAMES = [f"map{k}" for k in range(MAPS)]
_CHUNK = 1 << 13
_RUN = 1 << 18


@dataclass
class Run:
    """Some documents in a row, every line ended: words by line, lines by document and copy.

    ``copy`` tells apart texts of one document id; it is the hash of the text.
    """

    hashes: np.ndarray
    line: np.ndarray
    doc: np.ndarray
    copy: np.ndarray
    number: np.ndarray


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Run]:
    """All documents that have id and words, about ``_RUN`` bytes at a time."""
    end = np.array([NEWLINE], dtype=np.uint8)
    for batch in batches:
        held, ids, size = [], [], 0
        keys = zip(batch.column("doc_id").to_pylist(), batch.column("copy").to_pylist(), strict=True)
        for key, text in zip(keys, utf8(batch.column("text")), strict=True):
            if text is not None and key[0] is not None and len(text):
                held += [text, end]
                ids.append(key)
                size += len(text)
            if size > _RUN:
                yield _run(held, ids)
                held, ids, size = [], [], 0
        if held:
            yield _run(held, ids)


def _run(held: list[np.ndarray], ids: list[tuple[int, int]]) -> Run:
    data = np.concatenate(held)
    ends = np.flatnonzero(data == NEWLINE)
    hashes, starts, _ = word_hashes(data)
    upto = np.cumsum([len(part) for part in held])[1::2]
    lines = np.diff(np.searchsorted(ends, upto), prepend=0)
    number = np.arange(len(ends)) - np.repeat(np.cumsum(lines) - lines, lines)
    doc, copy = np.repeat(np.array(ids, dtype=np.int64).T, lines, axis=1)
    words = np.diff(np.searchsorted(starts, ends), prepend=0)
    return Run(hashes, np.repeat(np.arange(len(ends)), words), doc, copy, number)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", text_key().alias("copy"))


def text_key() -> Column:
    """What tells apart texts that share a document id."""
    return F.xxhash64(F.col("text").cast("string"))


def _added(parts: DataFrame, out: np.ndarray, add: np.ufunc) -> np.ndarray:
    """``(chunk, part)`` rows of all tasks brought together in ``out``, a table of fixed size.

    Tasks send compact chunks of ``_CHUNK`` numbers, and each chunk is brought together by one task.
    """
    kind = out.dtype

    def bring(table: pa.Table) -> pa.Table:
        total = np.zeros(_CHUNK, dtype=kind)
        for part in table.column("part").to_pylist():
            total = add(total, np.frombuffer(part, dtype=f"<u{len(part) // _CHUNK}").astype(kind))
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "part": [total.tobytes()]})

    for row in parts.groupBy("chunk").applyInArrow(bring, "chunk int, part binary").collect():
        out[row["chunk"] * _CHUNK : (row["chunk"] + 1) * _CHUNK] = np.frombuffer(row["part"], kind)
    return out


def _chunks(table: np.ndarray) -> pa.RecordBatch:
    parts = table.reshape(-1, _CHUNK)
    used = np.flatnonzero(parts.any(axis=1))
    return pa.RecordBatch.from_pydict(
        {"chunk": used.astype(np.int32), "part": [parts[i].tobytes() for i in used]},
        schema=pa.schema([("chunk", pa.int32()), ("part", pa.binary())]),
    )


def count_words(docs: DataFrame) -> np.ndarray:
    """By cell, how often its words occur; as many numbers for any corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, held = np.zeros(CELLS, dtype=np.int64), []
        for run in _runs(batches):
            held.append(_cell(run.hashes))
            if sum(map(len, held)) > CELLS:
                sums += np.bincount(np.concatenate(held), minlength=CELLS)
                held = []
        if held:
            sums += np.bincount(np.concatenate(held), minlength=CELLS)
        yield _chunks(sums.astype("<u4" if sums.max() < 2**32 else "<u8"))

    parts = docs.mapInArrow(count, "chunk int, part binary")
    return _added(parts, np.zeros(CELLS, dtype=np.int64), np.add)


def ranks(counts: np.ndarray) -> np.ndarray:
    """One byte per cell, rising with its count."""
    return np.minimum(255, np.round(8 * np.log2(1 + counts))).astype(np.uint8)


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(46)).astype(np.int64)


def _ordered(run: Run, own: np.ndarray) -> np.ndarray:
    """The order of the words by line, rank and hash.

    Line, rank, the upper bits of the hash and the place are one number, as numpy sorts numbers
    several times faster than it finds their order.
    """
    n = len(run.line)
    places = n.bit_length()
    left = 56 - places - (int(run.line[-1]).bit_length() if n else 0)
    if left >= 8:
        key = run.line.astype(np.uint64) << np.uint64(8) | own.astype(np.uint64)
        key = key << np.uint64(left) | run.hashes >> np.uint64(64 - left)
        key = np.sort(key << np.uint64(places) | np.arange(n, dtype=np.uint64))
        order = (key & np.uint64((1 << places) - 1)).astype(np.int64)
        key >>= np.uint64(places)
        hashes = run.hashes[order]
        if not ((key[1:] == key[:-1]) & (hashes[1:] != hashes[:-1])).any():
            return order
    return np.lexsort((run.hashes, own, run.line))  # words alike in their upper bits


def _sets_of(run: Run, rank: np.ndarray, least: int):
    """Sets of the lines with ``least`` or more words: line, size, name, map and words in order."""
    own = rank[_cell(run.hashes)]
    order = _ordered(run, own)
    hashes, line = run.hashes[order], run.line[order]
    first = np.ones(len(line), dtype=bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (line[1:] != line[:-1])
    hashes, line = hashes[first], line[first]
    starts = np.flatnonzero(np.diff(line, prepend=-1))
    sizes = np.diff(np.append(starts, len(line)))
    if len(starts) == 0:
        return line, sizes, hashes, np.empty((0, 2), dtype=np.uint64), starts, hashes
    named = np.add.reduceat(mix(hashes ^ np.uint64(0xA24BAED4963EE407)), starts)
    bit = np.uint64(1) << (hashes & np.uint64(63))
    upper = (hashes & np.uint64(64)).astype(bool)
    halves = (np.where(upper, np.uint64(0), bit), np.where(upper, bit, np.uint64(0)))
    bits = np.stack([np.bitwise_xor.reduceat(half, starts) for half in halves], axis=1)
    keep = np.flatnonzero(sizes >= least)
    return line[starts[keep]], sizes[keep], mix(named[keep]), bits[keep], starts[keep], hashes


def _prefix(size: np.ndarray, percent: int) -> np.ndarray:
    """Words of which two alike sets share one: size - ceil(percent% of size) + 1."""
    return size - -(-percent * size // 100) + 1


def _lists(values: np.ndarray, starts: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of the slices of ``many`` values at ``starts``."""
    offsets = np.concatenate([[0], np.cumsum(many)])
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], many)
    return offsets.astype(np.int32), values[np.repeat(starts, many) + place]


def lines_of(docs: DataFrame, rank: np.ndarray, percent: int, least: int) -> DataFrame:
    """Every line that takes part, with the prefix words of the first of its set in a run.

    A set too small to be alike any but its equal (at 80 %, of fewer than 4 words) has none.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            line, sizes, names, bits, starts, words = _sets_of(run, rank, least)
            one = np.zeros(len(names), dtype=bool)
            one[np.unique(names, return_index=True)[1]] = True
            one &= 100 * sizes >= percent * (sizes + 1)
            offsets, prefix = _lists(words, starts, np.where(one, _prefix(sizes, percent), 0))
            prefix = (prefix >> np.uint64(32)).astype(np.uint32).view(np.int32)
            columns = [
                pa.array(names.view(np.int64)),
                pa.array(run.doc[line]),
                pa.array(run.copy[line]),
                pa.array(run.number[line].astype(np.int32)),
                pa.array(sizes.astype(np.int32)),
                pa.array(np.ascontiguousarray(bits[:, 0]).view(np.int64)),
                pa.array(np.ascontiguousarray(bits[:, 1]).view(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(prefix)),
            ]
            names = "name doc copy line size bits more_bits prefix".split()
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(
        emit,
        """name bigint, doc bigint, copy bigint, line int, size int, bits bigint, more_bits bigint,
        prefix array<int>""",
    )


def prefixes(lines: DataFrame) -> DataFrame:
    """A row for every prefix word."""
    return lines.selectExpr(
        "name", "doc", "line", "size", "bits", "more_bits", "posexplode(prefix) AS (place, word)"
    )


def _by_word(rows: DataFrame) -> DataFrame:
    """Rows of a word together, by rising size.

    Word and size are one number, ``key``, as Spark sorts by one number several times faster; line
    and place are one, ``at``, as every number of a row takes as many bytes in the shuffle.
    """
    key = "shiftleft(CAST(word AS BIGINT), 32) + size AS key"
    at = "shiftleft(CAST(line AS BIGINT), 32) + place AS at"
    keyed = rows.selectExpr(key, "name", "doc", at, "bits", "more_bits")
    return keyed.repartition(F.expr("shiftright(key, 32)")).sortWithinPartitions("key")


def _apart(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Differing bits of the maps of two rows."""
    both = ((rows[c][i] ^ rows[c][j]).view(np.uint64) for c in ("bits", "more_bits"))
    return sum(np.bitwise_count(x).astype(np.int32) for x in both)


def _small_pairs(rows: dict[str, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of one word, which lie together by rising size, whose sets may be alike."""
    name, size, place = rows["name"], rows["size"].astype(np.int64), rows["place"]
    word = rows["word"].astype(np.int64) << 32
    # sizes rise within a word, so what may be alike a row is the rows up to some later one
    last = np.searchsorted(word + size, word + np.minimum(100 * size // percent, 2**31 - 1), "right")
    found, i = [], np.arange(len(word))
    for shift in range(1, SMALL):
        i = i[i + shift < last[i]]
        if len(i) == 0:
            break
        j = i + shift
        a, b = size[i], size[j]
        needed = -(-percent * (a + b) // (100 + percent))
        left = np.minimum(a - place[i], b - place[j])
        fit = (name[i] != name[j]) & (np.minimum(place[i], place[j]) + left >= needed)
        x, y, differ = i[fit], j[fit], (a + b - 2 * needed)[fit]
        fit = _apart(rows, x, y) <= differ
        found.append((x[fit], y[fit]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


MAPPED = ["row.size", "row.place", "row.bits", "row.more_bits"]
ROW = ["word", "name", "doc", "line", "size", "place", "bits", "more_bits"]


def _earliest(rows: dict[str, np.ndarray]) -> np.ndarray:
    """Of rows that lie together by word and rising size: the earliest row of each set at a word."""
    word, size, name = rows["word"], rows["size"], rows["name"]
    group = np.zeros(len(word), dtype=np.int64)
    group[1:] = np.cumsum((word[1:] != word[:-1]) | (size[1:] != size[:-1]))
    order = np.lexsort((name, group))
    name, group = name[order], group[order]
    new = np.ones(len(name), dtype=bool)
    new[1:] = (name[1:] != name[:-1]) | (group[1:] != group[:-1])
    if new.all():
        return order
    again = ~new
    again[:-1] |= ~new[1:]
    again = np.flatnonzero(again)  # all rows of sets with several
    many = order[again]
    order[again] = many[np.lexsort((rows["line"][many], rows["doc"][many], np.cumsum(new)[again]))]
    return order[new]


def _first_candidates(rows: dict[str, np.ndarray], percent: int) -> list[pa.Array]:
    """Of rows that lie together by word and rising size: every later set with its candidates.

    A set, the earlier candidate of nearest map, how far that is, and the other earlier ones.
    """
    earliest = _earliest(rows)
    rows = {c: v[earliest] for c, v in rows.items()}
    name, doc, line = rows["name"], rows["doc"], rows["line"]
    a, b = _small_pairs(rows, percent)
    before = (doc[a] < doc[b]) | (doc[a] == doc[b]) & (
        (line[a] < line[b]) | (line[a] == line[b]) & (name[a] < name[b])
    )
    a, b = np.where(before, a, b), np.where(before, b, a)
    apart = _apart(rows, a, b)
    order = np.lexsort((name[a], apart, b))
    a, b, apart = a[order], b[order], apart[order]
    first = np.flatnonzero(np.diff(b, prepend=-1))
    many = np.diff(np.append(first, len(b)))
    offsets, others = _lists(name[a], first + 1, many - 1)
    return [
        pa.array(name[b[first]]),
        pa.array(name[a[first]]),
        pa.array(apart[first].astype(np.int32)),
        pa.ListArray.from_arrays(pa.array(offsets), pa.array(others)),
    ]


def candidates(rows: DataFrame, percent: int) -> DataFrame:
    """From prefix rows, the candidates at words of up to ``SMALL`` rows; all rows of other words.

    Candidates of a set, ``name``, are earlier sets: ``other``, whose map is ``apart`` bits from
    its own, the nearest, and ``others``.  Rows of a commoner word have no ``other``.
    """
    kinds = {"word": pa.int32(), "size": pa.int32(), "place": pa.int32(), "line": pa.int32()}
    kept = pa.struct([(c, kinds.get(c, pa.int64())) for c in ROW if c != "name"])
    schema = pa.schema(
        [
            ("name", pa.int64()),
            ("other", pa.int64()),
            ("apart", pa.int32()),
            ("others", pa.list_(pa.int64())),
            ("row", kept),
        ]
    )

    def split(part: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.diff(part["word"].astype(np.int64), prepend=-(2**40)))
        counts = np.diff(np.append(starts, len(part["word"])))
        many = np.repeat(counts > SMALL, counts)
        found = _first_candidates({c: v[~many] for c, v in part.items()}, percent)
        yield pa.RecordBatch.from_arrays([*found, pa.nulls(len(found[0]), kept)], schema=schema)
        common = {c: pa.array(v[many]) for c, v in part.items()}
        n = len(common["name"])
        row = pa.StructArray.from_arrays([common[f.name] for f in kept], fields=list(kept))
        nothing = [pa.nulls(n, schema.field(i).type) for i in range(1, 4)]
        yield pa.RecordBatch.from_arrays([common["name"], *nothing, row], schema=schema)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            names = batch.schema.names
            part = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
            for both, upper, lower in (("key", "word", "size"), ("at", "line", "place")):
                two = part.pop(both)
                part[upper], part[lower] = (two >> 32).astype(np.int32), two.astype(np.int32)
            if held is not None:
                part = {c: np.concatenate([held[c], part[c]]) for c in ROW}
            last = part["word"] == part["word"][-1]
            # the word may go on: what is released and what is held must both tell it is common
            if last.sum() > 2 * SMALL + 1:
                keep = np.flatnonzero(last)[: -(SMALL + 1)]
                done = ~last
                done[keep] = True
            else:
                done = ~last
            held = {c: v[~done] for c, v in part.items()}
            if done.any():
                yield from split({c: v[done] for c, v in part.items()})
        if held is not None:
            yield from split(held)

    return _by_word(rows).mapInArrow(
        pair,
        """name bigint, other bigint, apart int, others array<bigint>, row struct<word: int,
        doc: bigint, line: int, size: int, place: int, bits: bigint, more_bits: bigint>""",
    )


def _may_match(a: str, b: str, percent: int) -> str:
    """Size, positional and parity filters of two prefix rows that share their word."""
    needed = f"ceil({percent} * ({a}.size + {b}.size) / {100 + percent})"
    return f"""
        100 * least({a}.size, {b}.size) >= {percent} * greatest({a}.size, {b}.size)
        AND 1 + least({a}.place, {b}.place)
              + least({a}.size - {a}.place, {b}.size - {b}.place) - 1 >= {needed}
        AND {_bits_apart(a, b)} <= {a}.size + {b}.size - 2 * {needed}"""


def _bits_apart(a: str, b: str) -> str:
    return f"(bit_count({a}.bits ^ {b}.bits) + bit_count({a}.more_bits ^ {b}.more_bits))"


def _wanted_bit(names: np.ndarray) -> np.ndarray:
    return (names.view(np.uint64) & np.uint64(WANTED - 1)).astype(np.int64)


def _wanted(found: DataFrame) -> np.ndarray:
    """A table of bits, of fixed size, that covers the names of all sets in ``found``."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(WANTED, dtype=bool)
        for batch in batches:
            others = batch.column("others").flatten()
            for names in (batch.column("name"), batch.column("other").drop_null(), others):
                bits[_wanted_bit(names.to_numpy(zero_copy_only=False).astype(np.int64))] = True
        yield _chunks(np.packbits(bits))

    parts = found.select("name", "other", "others").mapInArrow(mark, "chunk int, part binary")
    return _added(parts, np.zeros(WANTED // 8, dtype=np.uint8), np.bitwise_or)


def whole_sets(docs: DataFrame, rank: np.ndarray, wanted: np.ndarray, least: int) -> DataFrame:
    """Once per set whose bit is in ``wanted``: name, size, wide parity map, hashes of all words."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(wanted).astype(bool)
        for run in _runs(batches):
            _, sizes, names, _, starts, words = _sets_of(run, rank, least)
            one = np.unique(names, return_index=True)[1]
            one = one[bits[_wanted_bit(names[one])]]
            offsets, held = _lists(words, starts[one], sizes[one])
            lists = pa.LargeListArray.from_arrays(pa.array(offsets.astype(np.int64)), pa.array(held))
            binary = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(one), [None, pa.array(offsets.astype(np.int64) * 8).buffers()[1], lists.values.buffers()[1]]
            )
            place = np.repeat(np.arange(len(one)), sizes[one])
            maps = np.zeros((len(one), MAPS), dtype=np.uint64)
            np.bitwise_xor.at(
                maps, (place, (held >> np.uint64(6) & np.uint64(MAPS - 1)).astype(np.int64)),
                np.uint64(1) << (held & np.uint64(63)),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names[one].view(np.int64)),
                    pa.array(sizes[one].astype(np.int32)),
                    *(pa.array(maps[:, k].view(np.int64)) for k in range(MAPS)),
                    binary.cast(pa.binary()),
                ],
                ["name", "size", *MAP_NAMES, "words"],
            )

    maps = ", ".join(f"{m} bigint" for m in MAP_NAMES)
    found = docs.mapInArrow(emit, f"name bigint, size int, {maps}, words binary")
    return found.groupBy("name").agg(*(F.first(c).alias(c) for c in found.columns[1:]))


def _maps_allow(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose wide maps differ by no more bits than alike sets can."""
    for side in ("a", "b"):
        maps = sets.selectExpr(
            f"name AS {side}", f"size AS size_{side}", *(f"{m} AS {m}_{side}" for m in MAP_NAMES)
        )
        pairs = pairs.join(maps, side)
    differ = " + ".join(f"bit_count({m}_a ^ {m}_b)" for m in MAP_NAMES)
    both = "size_a + size_b"
    return pairs.filter(
        f"{differ} <= {both} - 2 * ceil({percent} * ({both}) / {100 + percent})"
    ).select("a", "b")


def _alike(percent: int):
    """Keeps the pairs whose sets are alike; all pairs of a batch are intersected in one sort."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            sizes, parts = np.zeros(batch.num_rows, dtype=np.int64), []
            for side in ("words_a", "words_b"):
                held = [np.frombuffer(v, dtype=np.uint64) for v in batch.column(side).to_pylist()]
                many = np.array([len(v) for v in held])
                pair = np.repeat(np.arange(len(held)), many)
                parts.append((np.concatenate(held), pair))
                sizes += many
            words, pair = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((words, pair))
            words, pair = words[order], pair[order]
            twice = (words[1:] == words[:-1]) & (pair[1:] == pair[:-1])
            both = np.bincount(pair[1:][twice], minlength=batch.num_rows)
            keep = 100 * both >= percent * (sizes - both)
            yield batch.select(["b"]).filter(pa.array(keep))

    return check


def repeated_lines(
    docs: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS
) -> DataFrame:
    """``(doc_id, copy, line)`` of every line that an earlier line is alike.

    Lines count from 0 and are ordered by document id, then number; of lines with both in
    common, those of texts that share an id, the one whose set has the smaller hash is earlier.
    ``copy`` is ``text_key`` of the text; rows equal in id and text are one document.  Two lines
    are alike if the Jaccard similarity of their sets of words is ``percent`` / 100 or more;
    whether the earlier one is itself repeated does not matter.  Lines of fewer than
    ``least_words`` distinct words and documents without id or text take no part.

    Equal sets are merged.  Sets that meet at a word of few sets are all compared.  At a
    commoner word a set is first checked against the earliest one there; only sets still
    without an earlier match are checked against all there.
    """
    docs = _keyed(docs)
    rank = ranks(count_words(docs))
    lines = stored(lines_of(docs, rank, percent, least_words))
    found = stored(candidates(prefixes(lines.filter("size(prefix) > 0")), percent))
    sets = stored(whole_sets(docs, rank, _wanted(found), least_words))

    def alike(pairs: DataFrame) -> DataFrame:
        """The ``b`` of pairs ``(a, b)`` that are alike."""
        pairs = stored(_maps_allow(pairs, sets, percent))
        one = sets.selectExpr("name AS a", "words AS words_a")
        other = sets.selectExpr("name AS b", "words AS words_b")
        both = pairs.join(one, "a").join(other, "b").select("b", "words_a", "words_b")
        confirmed = stored(both.mapInArrow(_alike(percent), "b bigint").distinct())
        discard(pairs)
        return confirmed

    met = stored(
        found.filter("other IS NULL")
        .groupBy("row.word", "name")
        .agg(F.min(F.struct("row.doc", "row.line", "name", *MAPPED)).alias("own"))
    )
    head = met.groupBy("word").agg(F.min("own").alias("head"))
    heads = met.join(head, "word").filter("own.name <> head.name AND " + _may_match("own", "head", percent))
    nearest = heads.selectExpr(
        "name AS b", f"struct({_bits_apart('own', 'head')} AS apart, head.name AS name) AS nearest"
    ).unionByName(
        found.filter("other IS NOT NULL").selectExpr(
            "name AS b", "struct(apart, other AS name) AS nearest"
        )
    )
    first = nearest.groupBy("b").agg(F.min("nearest").alias("nearest"))
    first = first.selectExpr("nearest.name AS a", "b")
    settled = alike(first)
    named = settled.withColumnRenamed("b", "name")
    open_ = found.filter("size(others) > 0").select("name", "others").join(named, "name", "left_anti")
    p = met.join(named, "name", "left_anti").select("word", F.col("own").alias("p"))
    rest = (
        p.join(met.select("word", F.col("own").alias("q")), "word")
        .filter(
            "struct(q.doc, q.line, q.name) < struct(p.doc, p.line, p.name) AND "
            + _may_match("p", "q", percent)
        )
        .selectExpr("q.name AS a", "p.name AS b")
        .unionByName(open_.selectExpr("explode(others) AS a", "name AS b"))
    )
    later = settled.unionByName(alike(rest.distinct()))
    discard(found, sets, met)
    earliest = lines.groupBy("name").agg(F.min(F.struct("doc", "line", "copy")).alias("at"))
    known = earliest.join(later.selectExpr("b AS name", "true AS later"), "name", "left")
    return (
        lines.join(known, "name")
        .filter("later OR struct(doc, line, copy) > at")
        .selectExpr("doc AS doc_id", "copy", "CAST(line AS BIGINT) AS line")
        .distinct()
    )


def _with_removed(docs: DataFrame, **how) -> DataFrame:
    """The rows with ``_gone``, their repeated lines in order, null where there are none."""
    return _with_gone(docs.withColumn("_key", text_key()), repeated_lines(docs, **how)).drop("_key")


def _with_gone(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows, which have the ``text_key`` of their text in ``_key``, with ``_gone``."""
    gone = (
        repeated.groupBy("doc_id", "copy")
        .agg(F.sort_array(F.collect_list("line")).alias("_gone"))
        .withColumnsRenamed({"doc_id": "_doc", "copy": "_copy"})
    )
    same = (F.col("doc_id").cast("bigint") == F.col("_doc")) & (F.col("_key") == F.col("_copy"))
    return rows.join(gone, same, "left").drop("_doc", "_copy")


def per_document(docs: DataFrame, **how) -> DataFrame:
    """``(doc_id, n_lines, n_removed, removed)`` of every row, the last its removed lines in order.

    Null and empty texts have no lines; texts that share an id are answered each.
    """
    # the texts themselves stay out of the join
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.expr(
            "CAST(coalesce(if(length(text) > 0, regexp_count(text, '\n') + 1, 0), 0) AS BIGINT)"
        ).alias("n_lines"),
        text_key().alias("_key"),
    )
    return _with_gone(rows, repeated_lines(docs, **how)).selectExpr(
        "doc_id",
        "n_lines",
        "CAST(coalesce(size(_gone), 0) AS BIGINT) AS n_removed",
        "coalesce(_gone, array()) AS removed",
    )


def without_repeated_lines(docs: DataFrame, **how) -> DataFrame:
    """The documents without their repeated lines; those left without a word go.

    ``n_chars``, where there is one, follows the text.  Documents without id or text, and
    rows none of whose lines are repeated, stay as they are.
    """
    kept = "array_join(filter(split(text, '\\n', -1), (l, i) -> NOT array_contains(_gone, CAST(i AS BIGINT))), '\\n')"
    joined = _with_removed(docs, **how)
    changed = F.col("_gone").isNotNull()
    out = joined.withColumn("text", F.when(changed, F.expr(kept)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        length = F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", length)
    return out.filter(~changed | F.col("text").rlike("[^\\x20\\x09-\\x0D]")).select(*docs.columns)
