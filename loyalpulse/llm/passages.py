"""Repeated passages: paragraph MinHash banding, and passages inside paragraphs.

* A paragraph is a line.  Paragraphs of enough words are banded by MinHash with bands tuned
  for recall, those that collide are checked by exact Jaccard similarity of their word
  shingles, and links join to components of which the first paragraph stays.
* A passage repeated inside longer, otherwise different paragraphs is found from its runs
  of ``least_words`` words.  Of every run the gram of least hash is its seed; a run can only
  recur if its seed does, so only such runs are compared, whole.  The runs of one seed follow
  each other and travel as one row.  Those that recur are joined to passages, which therefore
  end exactly where the texts part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalpulse.llm.minhash import CHUNK, half_keys, near_groups
from loyalpulse.llm.store import discard, distilled, stored
from loyalpulse.llm.words import NEWLINE, POWER, mix, utf8, word_hashes

WIDTH, PERCENT = 5, 80
#: Words of a paragraph or passage that is reported.
LEAST_WORDS = 20
#: Bands of two minhashes: two paragraphs at 0.8 share none with probability 5e-6.
ROWS, BANDS = 2, 12
#: Places of one seed whose runs are compared at once; commoner seeds go another, exact way.
COMMON = 1 << 15


def band_keys(found: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return half_keys(found, starts, ROWS, BANDS // 2)


@dataclass
class Texts:
    """Some texts in a row, a line end after each: their ids and rows, bytes, and all words.

    ``ends`` has where each text's bytes end and ``before`` how many words lie before it;
    ``owner`` tells the text of every word.
    """

    ids: np.ndarray
    rows: np.ndarray
    data: np.ndarray
    ends: np.ndarray
    words: np.ndarray
    starts: np.ndarray
    before: np.ndarray
    owner: np.ndarray


def _texts(batch: pa.RecordBatch) -> Iterator[Texts]:
    """All texts with id, about ``CHUNK`` bytes or one longer text at a time."""
    end = np.array([NEWLINE], dtype=np.uint8)
    ids, rows, held, size = [], [], [], 0

    def joined() -> Texts:
        data = np.concatenate(held)
        ends = np.cumsum([len(part) for part in held])[1::2]
        words, starts, _ = word_hashes(data)
        upto = np.searchsorted(starts, ends)
        many = np.diff(upto, prepend=0)
        owner = np.repeat(np.arange(len(ends)), many)
        return Texts(np.array(ids, dtype=np.int64), np.array(rows), data, ends, words, starts, upto - many, owner)

    for row, (doc, text) in enumerate(
        zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text")), strict=True)
    ):
        if text is None or doc is None:
            continue
        if held and size + len(text) > CHUNK:
            yield joined()
            ids, rows, held, size = [], [], [], 0
        ids.append(doc)
        rows.append(row)
        held += [text, end]
        size += len(text)
    if held:
        yield joined()


def paragraphs(docs: DataFrame, least_words: int) -> DataFrame:
    """``(id, text)`` of every line of enough words; the id is document, first word, words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _texts(batch):
                ends = np.flatnonzero(texts.data == NEWLINE)
                upto = np.searchsorted(texts.starts, ends)
                words = np.diff(upto, prepend=0)
                enough = words >= least_words
                size = np.diff(ends, prepend=-1)
                inside = np.repeat(enough, size)
                inside[ends] = False
                offsets = np.concatenate([[0], np.cumsum(size[enough] - 1)]).astype(np.int32)
                owner = np.searchsorted(texts.ends, ends[enough], "right")
                columns = [
                    texts.ids[owner],
                    upto[enough] - words[enough] - texts.before[owner],
                    words[enough],
                ]
                unit = pa.StructArray.from_arrays([pa.array(c) for c in columns], names=["doc_id", "first", "words"])
                buffers = pa.py_buffer(offsets), pa.py_buffer(texts.data[inside])
                parts = pa.StringArray.from_buffers(len(unit), *buffers)
                yield pa.RecordBatch.from_arrays([unit, parts], names=["id", "text"])

    schema = "id struct<doc_id: bigint, first: bigint, words: bigint>, text string"
    return docs.mapInArrow(cut, schema)


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of exactly ``width`` words."""
    n = max(0, len(words) - width + 1)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        total += words[i : i + n] * POWER[i]
    return mix(total + np.uint64(width))


def _seed_width(least_words: int) -> int:
    return max(1, 2 * least_words // 5)


def seeds(words: np.ndarray, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every run of ``least_words`` words where its seed starts; the hashes of all grams.

    The seed is the least gram of the run, the first of equal ones, so equal runs have equal seeds.
    """
    every = grams(words, _seed_width(least_words))
    span = least_words - _seed_width(least_words) + 1
    if len(every) < span:
        return np.empty(0, dtype=np.int64), every
    least = sliding_window_view(every, span).argmin(axis=1)
    return np.arange(len(least)) + least, every


def _seeds_inside(texts: Texts, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``seeds`` over all words, and which runs lie in one text."""
    at, every = seeds(texts.words, least_words)
    return at, every, texts.owner[: len(at)] == texts.owner[len(texts.owner) - len(at) :]


def _places(texts: Texts, keys: np.ndarray, first: np.ndarray) -> list[pa.Array]:
    owner = texts.owner[first]
    return [
        pa.array(keys.view(np.int64)), pa.array(texts.ids[owner]), pa.array(first - texts.before[owner])
    ]


PLACES = "key bigint, doc_id bigint, first bigint"


def all_seeds(docs: DataFrame, least_words: int) -> DataFrame:
    """``(key, doc_id, first)`` of the seeds of every text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _texts(batch):
                at, every, inside = _seeds_inside(texts, least_words)
                at = at[inside]
                at = at[np.diff(at, prepend=-1) > 0]
                yield pa.RecordBatch.from_arrays(
                    _places(texts, every[at], at), ["key", "doc_id", "first"]
                )

    return docs.mapInArrow(find, PLACES)


def possible_runs(docs: DataFrame, marks: DataFrame, least_words: int) -> DataFrame:
    """``(key, doc_id, first, runs)`` of every seed that recurs, and of its runs the hashes.

    The runs of a seed follow each other, the first at ``first``: a run has one seed, and the
    seeds of later runs are not earlier.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _texts(batch):
                at, every, inside = _seeds_inside(texts, least_words)
                known = batch.column("marks").take(pa.array(texts.rows))
                row = np.repeat(np.arange(len(known)), pc.list_value_length(known).to_numpy())
                mark = texts.before[row] + known.flatten().to_numpy()
                # a row that shares its id may be shorter than the text that the mark is of
                fits = mark < len(texts.words)
                mark, row = mark[fits], row[fits]
                marked = np.zeros(len(texts.words), dtype=bool)
                marked[mark[texts.owner[mark] == row]] = True
                own = np.flatnonzero(inside & marked[at])
                starts = np.flatnonzero(np.diff(at[own], prepend=-1))
                offsets = np.append(starts, len(own)).astype(np.int32)
                runs = grams(texts.words, least_words)[own].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *_places(texts, every[at[own[starts]]], own[starts]),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(runs)),
                    ],
                    ["key", "doc_id", "first", "runs"],
                )

    marked = marks.groupBy("doc_id").agg(F.collect_set("first").alias("marks"))
    return docs.join(marked, "doc_id").select("doc_id", "text", "marks").mapInArrow(
        find, f"{PLACES}, runs array<bigint>"
    )


def recurring(places: DataFrame, apart: int) -> DataFrame:
    """``(doc_id, first, origin, kept)`` of the places of keys that occur more than once.

    ``origin`` is the document of the first place, which alone is ``kept``.  Places of that
    document less than ``apart`` words from the first overlap it and do not count.  A
    task reads its keys in order and holds one place, however often a key occurs.
    """

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, told = [np.empty(0, dtype=np.int64)] * 3, False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "doc_id", "first"))
            key, doc, first = (np.concatenate(pair) for pair in zip(held, own, strict=True))
            new = np.ones(len(key), dtype=bool)
            new[1:] = key[1:] != key[:-1]
            starts = np.flatnonzero(new)
            start = starts[np.cumsum(new) - 1]
            again = (doc != doc[start]) | (first - first[start] >= apart)
            many = np.logical_or.reduceat(again, starts)
            out = again.copy()
            out[starts] = many
            out[0] &= not told
            told = bool(many[-1]) or (told and len(starts) == 1)
            held = [c[starts[-1] :][:1] for c in (key, doc, first)]
            columns = doc[out], first[out], doc[start][out], new[out]
            names = ["doc_id", "first", "origin", "kept"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    ordered = places.repartition("key").sortWithinPartitions("key", "doc_id", "first")
    return ordered.mapInArrow(pick, "doc_id bigint, first bigint, origin bigint, kept boolean")


def _resolved(key: np.ndarray, doc: np.ndarray, first: np.ndarray, runs: pa.ListArray, apart: int) -> list[pa.Array]:
    """Of the places of whole seeds, by seed and place, the stretches of runs as ``compared`` has them."""
    many = pc.list_value_length(runs).to_numpy(zero_copy_only=False).astype(np.int64)
    place = np.repeat(np.arange(len(key)), many)
    run = runs.flatten().to_numpy(zero_copy_only=False)
    at = first[place] + np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
    doc = doc[place]
    mixed = (np.diff(key[place]) == 0) & (np.diff(doc) == 0) & (np.diff(at) <= 0)
    if mixed.any():  # rows that share an id
        order = np.lexsort((at, doc, run))
    else:
        order = np.argsort(run, kind="stable")
    sorted_run, sorted_doc, sorted_at = run[order], doc[order], at[order]
    new = np.ones(len(run), dtype=bool)
    new[1:] = sorted_run[1:] != sorted_run[:-1]
    starts = np.flatnonzero(new)
    start = starts[np.cumsum(new) - 1]
    again = (sorted_doc != sorted_doc[start]) | (sorted_at - sorted_at[start] >= apart)
    if len(starts):
        again[starts] = np.logical_or.reduceat(again, starts)
    out, origin, kept = np.empty_like(again), np.empty_like(doc), np.empty_like(new)
    out[order], origin[order], kept[order] = again, sorted_doc[start], new
    joined = np.zeros(len(run), dtype=bool)
    joined[1:] = (place[1:] == place[:-1]) & (origin[1:] == origin[:-1]) & (kept[1:] == kept[:-1])
    joined[1:] &= out[1:] & out[:-1]
    begin = np.flatnonzero(out & ~joined)
    end = np.flatnonzero(out & ~np.append(joined[1:], False))
    return [pa.array(c) for c in (doc[begin], at[begin], at[end], origin[begin], kept[begin])]


STRETCH = "doc_id bigint, first bigint, last bigint, origin bigint, kept boolean"


def compared(places: DataFrame, apart: int) -> DataFrame:
    """``(doc_id, first, last, origin, kept, runs)`` of the runs of ``possible_runs`` that recur.

    Runs ``first`` to ``last`` have one origin and are as ``recurring`` has them.  A run only
    meets those of its seed.  Places of a seed that are more than ``COMMON`` are handed on with
    their ``runs`` and without origin, so a task holds no more than that at once.
    """
    schema = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "first", "last", "origin")]
        + [("kept", pa.bool_()), ("runs", pa.list_(pa.int64()))]
    )

    def resolved(part: pa.Table) -> pa.RecordBatch:
        key, doc, first = (part.column(c).to_numpy() for c in ("key", "doc_id", "first"))
        runs = part.column("runs").combine_chunks()
        found = _resolved(key, doc, first, runs, apart)
        return pa.RecordBatch.from_arrays([*found, pa.nulls(len(found[0]), schema.field("runs").type)], schema=schema)

    def handed_on(part: pa.Table) -> Iterator[pa.RecordBatch]:
        for batch in part.to_batches():
            nothing = [pa.nulls(batch.num_rows, schema.field(c).type) for c in ("last", "origin", "kept")]
            columns = [batch.column("doc_id"), batch.column("first"), *nothing, batch.column("runs").cast(schema.field("runs").type)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = [], None  # rows of the last seed; the seed that is known to be common
        for batch in batches:
            if batch.num_rows == 0:
                continue
            key = batch.column("key").to_numpy()
            if key[0] == known:
                upto = int(np.searchsorted(key, known, "right"))
                yield from handed_on(pa.Table.from_batches([batch.slice(0, upto)]))
                batch, key = batch.slice(upto), key[upto:]
                if len(key) == 0:
                    continue
            last = int(np.searchsorted(key, key[-1], "left"))
            if held and held[0].column("key")[0].as_py() != key[0]:
                yield resolved(pa.Table.from_batches(held))
                held = []
            if last:
                yield resolved(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
            if sum(b.num_rows for b in held) > COMMON:
                known = key[-1]
                yield from handed_on(pa.Table.from_batches(held))
                held = []
        if held:
            yield resolved(pa.Table.from_batches(held))

    ordered = places.repartition("key").sortWithinPartitions("key", "doc_id", "first")
    return ordered.mapInArrow(pick, f"{STRETCH}, runs array<bigint>")


def repeated_runs(docs: DataFrame, least_words: int) -> DataFrame:
    """``(doc_id, first, last, origin, kept)`` of all runs of ``least_words`` words that recur.

    Those from ``first`` to ``last`` are each as ``recurring`` has them.  Runs of common seeds
    are dealt out by their own hashes.
    """
    marks = stored(recurring(all_seeds(docs, least_words), 1).select("doc_id", "first"))
    found = stored(compared(possible_runs(docs, marks, least_words), least_words))
    discard(marks)
    common = found.filter("runs IS NOT NULL").selectExpr("doc_id", "first", "posexplode(runs) AS (nth, key)")
    rest = recurring(common.selectExpr("key", "doc_id", "first + nth AS first"), least_words)
    return found.filter("runs IS NULL").drop("runs").unionByName(rest.withColumn("last", F.col("first")))


def joined_passages(found: DataFrame, least_words: int) -> DataFrame:
    """Runs that follow each other in a document and have one origin, as passages.

    So a passage is wholly the first or wholly repeated.
    """
    order = "OVER (PARTITION BY doc_id, origin, kept ORDER BY first, last"
    parted = found.selectExpr(
        "*",
        f"""first > 1 + max(last) {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS new""",
    )
    runs = parted.selectExpr(
        "*", f"count_if(new) {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run"
    )
    return runs.groupBy("doc_id", "origin", "kept", "run").agg(
        F.min("first").alias("first_word"),
        (F.max("last") - F.min("first") + least_words).alias("n_words"),
    )


def repeated_passages(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, least_words: int = LEAST_WORDS
) -> DataFrame:
    """``(doc_id, first_word, n_words, kind, component_id, kept)`` of all that is repeated.

    ``kind`` is ``paragraph`` for lines alike by Jaccard similarity and ``passage`` for
    word sequences that recur exactly.  ``component_id`` is the smallest document that has
    a member of the paragraph's component, or the one where all runs of the passage occur
    first.  ``kept`` marks the first occurrence; the others may be removed.  Words count
    from 0.  Passages may overlap by fewer than ``least_words`` words where one origin
    follows another; a word of any row that is not kept may be removed.

    Null and empty texts and rows without id have nothing to repeat; rows of one
    ``doc_id`` with the same text count once.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    units = paragraphs(docs, least_words)
    grouped = distilled(
        lambda: near_groups(units, width, percent, band_keys).filter("component IS NOT NULL").distinct()
    )
    sizes = grouped.groupBy("component").count().filter("count > 1").select("component")
    alike = grouped.join(sizes, "component").selectExpr(
        "id.doc_id AS doc_id",
        "id.first AS first_word",
        "id.words AS n_words",
        "'paragraph' AS kind",
        "component.doc_id AS component_id",
        "id = component AS kept",
    )
    inside = joined_passages(repeated_runs(docs, least_words), least_words).selectExpr(
        "doc_id", "first_word", "n_words", "'passage' AS kind", "origin AS component_id", "kept"
    )
    return alike.unionByName(inside)
