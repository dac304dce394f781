"""Stretches of words that repeat with a period, and texts without the repeats.

A run is a stretch of consecutive words whose words ``q`` apart are identical, ``q`` being its
smallest period, that no neighbouring word extends.  Reported are runs of at least
``least_words`` words and ``least_periods`` periods.

Every run holds a Lyndon root: a word sequence of its period that is the longest Lyndon word
at its place, by the order of the words or by the reverse order.  So the longest Lyndon words of
all places, which end before the next smaller (or larger) suffix, are all candidates there are;
each is extended to both sides by longest common extensions of the document and of its
reversal, which suffix trees answer (see ``suffix_tree``).

Trees are grown only for stretches that can hold a run: in a run of length ``L`` and period ``q``
every window of up to ``L + 1 - 2q`` words recurs ``q`` words before or after, inside the run, and
``q`` is at most the part of the stretch that its least number of periods leaves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalpulse.llm.suffix_tree import Extensions
from loyalpulse.llm.words import SHINGLE, mix

LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Arrow rows are handed on in batches of about this many bytes of text.
BATCH_BYTES = 1 << 23
#: So often a stretch is narrowed to its recurring windows; what is left goes to the trees whole.
ROUNDS = 6
RUN_TYPE = "struct<start:bigint,length:bigint,period:bigint>"


def _window(least_words: int, least_periods: int) -> int:
    """The longest window that recurs within every run: least_words for period 1, or k periods."""
    widths = [max(least_words, least_periods * q) + 1 - 2 * q for q in range(1, least_words + 1)]
    return max(1, min(widths))


def _recurring(numbers: np.ndarray, width: int, apart: int) -> list[tuple[int, int]]:
    """The stretches covered by windows that recur at most ``apart`` words on in ``numbers``."""
    n = len(numbers) - width + 1
    if n < 2:
        return []
    total = numbers[:n].astype(np.uint64) * SHINGLE[0]
    for i in range(1, width):
        total += numbers[i : i + n].astype(np.uint64) * SHINGLE[i]
    total = mix(total)
    order = np.argsort(total, kind="stable")
    same = (total[order][1:] == total[order][:-1]) & (np.diff(order) <= apart)
    again = np.zeros(n + 2, dtype=np.int8)
    again[order[1:][same] + 1] = 1
    again[order[:-1][same] + 1] = 1
    edges = np.flatnonzero(np.diff(again))
    return [(int(a), int(b) + width - 1) for a, b in zip(edges[0::2], edges[1::2])]


def stretches(numbers: np.ndarray, least_words: int, least_periods: int) -> list[tuple[int, int]]:
    """Disjoint stretches that together hold all runs: most of their windows recur within them."""
    width = _window(least_words, least_periods)
    todo, done = [(0, len(numbers), 0)], []
    while todo:
        start, stop, rounds = todo.pop()
        if rounds == ROUNDS:
            done.append((start, stop))
            continue
        found = _recurring(numbers[start:stop], width, (stop - start) // least_periods)
        if found == [(0, stop - start)]:
            done.append((start, stop))
        else:
            todo += [(start + a, start + b, rounds + 1) for a, b in found if b - a >= least_words]
    return sorted(done)


def _next_smaller(rank: list[int]) -> list[int]:
    """For every place the next one of lower rank; the end of the list, if there is none."""
    n = len(rank)
    out, held = [n] * n, []
    for i, value in enumerate(rank):
        while held and rank[held[-1]] > value:
            out[held.pop()] = i
        held.append(i)
    return out


def runs_of(numbers: np.ndarray, least_words: int, least_periods: int) -> np.ndarray:
    """``(start, length, period)`` of all runs of a word sequence, by start, then period.

    Equal numbers stand for equal words; which number a word has does not matter.
    """
    n = len(numbers)
    numbers = np.unique(numbers, return_inverse=True)[1]
    ahead, back = Extensions(numbers), Extensions(numbers[::-1])
    rank = ahead.rank[:n]
    place = np.arange(n)
    found = []
    for order in (rank, -rank):
        period = np.array(_next_smaller(order.tolist())) - place
        # of a whole run at least its root and what is left after it must fit
        i = np.flatnonzero((period * least_periods <= n) & (place + period < n))
        q = period[i]
        left = np.zeros(len(i), dtype=np.int64)
        inner = i > 0
        left[inner] = back(n - i[inner], n - i[inner] - q[inner])
        start, length = i - left, q + left + ahead(i, i + q)
        keep = length >= np.maximum(least_words, least_periods * q)
        found.append(np.stack([start, length, q], axis=1)[keep])
    found = np.unique(np.concatenate(found), axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def find_runs(words: list[bytes], least_words: int, least_periods: int) -> np.ndarray:
    """All runs of a document's words; see the module's note."""
    known: dict[bytes, int] = {}
    numbers = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    parts = [np.empty((0, 3), dtype=np.int64)]
    if len(known) < len(words):
        for start, stop in stretches(numbers, least_words, least_periods):
            part = runs_of(numbers[start:stop], least_words, least_periods)
            parts.append(part + np.array([start, 0, 0]))
    return np.concatenate(parts)


def without_repeats(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(runs):
        return words
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(drop[:-1]) == 0)
    return [words[i] for i in kept.tolist()]


def _batches(least_words: int, least_periods: int):
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found, texts, held, done = batch.column(0), [], [], 0, 0
            for i, text in enumerate(batch.column(1).cast(pa.large_binary())):
                words = (text.as_py() or b"").split()
                runs = find_runs(words, least_words, least_periods)
                found.append([dict(zip(("start", "length", "period"), run)) for run in runs.tolist()])
                texts.append(b" ".join(without_repeats(words, runs)).decode(errors="replace"))
                held += len(texts[-1]) + 24 * len(runs)
                if held > BATCH_BYTES or i + 1 == len(batch):
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.slice(done, len(texts)),
                            pa.array(found, type=pa.list_(run)),
                            pa.array(texts, type=pa.string()),
                        ],
                        names=["id", "runs", "collapsed"],
                    )
                    found, texts, held, done = [], [], 0, i + 1

    return rows


def periodic_runs(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
) -> DataFrame:
    """``(id, runs, collapsed)`` of every row of ``docs``.

    ``runs`` lists start (word number from 0), length and period of all runs by start, then
    period; ``collapsed`` is the words that no run holds after its first period, joined by one
    space.  Words are parted by 0x20 and 0x09-0x0D and compared byte by byte.  ``least_periods``
    is 2 or more.

    Null and empty texts, and texts of separators alone, have no runs and an empty ``collapsed``.
    Every row is answered on its own: repeated rows give repeated results, a null id stays null,
    other columns are left out, an empty table gives an empty one.  A text's trees take memory
    in proportion to its longest stretch that can hold a run; texts are never cut.
    """
    if least_periods < 2 or least_words < 1:
        raise ValueError("runs need two periods and one word at least")
    given = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    schema = f"id {kind}, runs array<{RUN_TYPE}>, collapsed string"
    out = given.mapInArrow(_batches(least_words, least_periods), schema)
    return out.withColumnRenamed("id", id)

