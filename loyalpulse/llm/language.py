"""Language identification with error-correcting output codes.

Every language has a codeword of bits.  For each bit a binary classifier tells, from the
character pairs and triples of a text, the languages with that bit from the others; its
weights are the log odds of the n-grams in the two groups.  A text gets the language whose
codeword costs least, a wrong bit costing the more the surer its classifier is and the
better it did on its training texts.  Texts whose two best codewords cost about the same
are flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
BUCKETS = 1 << 16
#: Labelled texts a language that the classifiers are fitted on, about.
FITTED_PER_LANGUAGE = 2_000
#: Difference of the two best probabilities below which a text is ambiguous.
AMBIGUOUS_BELOW = 0.1
_WINDOW = 1 << 17
_SMOOTH = 0.5
#: Texts that are labelled and handed on together.
_LABELLED_TOGETHER = 500
_PAIR, _TRIPLE = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """By code point: its lower-case letter, 0 for anything that is no letter."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for code in range(len(out)):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def ngrams(text: str) -> Iterator[np.ndarray]:
    """Buckets of all pairs and triples of characters, a window of the text at a time."""
    for at in range(0, len(text), _WINDOW):
        part = text[max(0, at - 2) : at + _WINDOW]
        if at == 0:
            part = " " + part
        if at + _WINDOW >= len(text):
            part += " "
        codes = _letters()[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        two = codes[:-1] * _PAIR ^ (codes[1:] * _TRIPLE)
        two = (two ^ (two >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        three = (two[:-1] ^ codes[2:] * np.uint32(0x27D4EB2F)) * np.uint32(0x165667B1)
        inside = (codes[:-1] | codes[1:]) != 0
        yield np.concatenate([two[inside] >> np.uint32(16), three[inside[:-1]] >> np.uint32(16)])


def codewords(count: int) -> np.ndarray:
    """One row of +1 / -1 per language: all splits in two for up to 7, else random ones."""
    if count <= 7:
        splits = [(1, *rest) for rest in product((1, -1), repeat=count - 1)]
        return np.array([s for s in splits if min(s) < 0], dtype=np.int8).reshape(-1, count).T
    random = np.random.default_rng(count)
    bits = 15 * int(np.ceil(np.log2(count)))
    while True:
        code = random.choice(np.array([1, -1], dtype=np.int8), size=(count, bits))
        code = code[:, np.abs(code.sum(axis=1 - 1)) < count]
        if len(np.unique(code, axis=0)) == count:
            return code


@dataclass(frozen=True)
class Model:
    """Languages, their codewords and the weights of the bits' classifiers."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    trust: np.ndarray

    def margins(self, text: str) -> np.ndarray:
        """Per bit, the mean log odds of the text's n-grams."""
        total, n = np.zeros(self.code.shape[1]), 0
        for found in ngrams(text):
            total += self.weights[found].sum(axis=0, dtype=np.float64)
            n += len(found)
        return total / max(n, 1)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, probability and whether it is ambiguous."""
        if not text or not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        agreement = self.code * np.clip(self.margins(text) / self.scale, -4, 4)
        cost = (self.trust * np.logaddexp(0, -2 * agreement)).sum(axis=1)
        likely = np.exp(cost.min() - cost)
        likely /= likely.sum()
        order = np.argsort(-likely, kind="stable")
        gap = likely[order[0]] - likely[order[1]]
        return self.languages[order[0]], float(likely[order[0]]), bool(gap < AMBIGUOUS_BELOW)


def _counted(docs: DataFrame) -> DataFrame:
    """``(lang, counts)``: n-gram counts of each task's texts by language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
                own = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                for found in ngrams(text.as_py()):
                    own += np.bincount(found, minlength=BUCKETS)
        if sums:
            yield pa.RecordBatch.from_pydict(
                {"lang": list(sums), "counts": [v.astype("<i8").tobytes() for v in sums.values()]}
            )

    return docs.select("text", "lang").mapInArrow(count, "lang string, counts binary")


def _summed(counted: DataFrame) -> dict[str, np.ndarray]:
    """One count vector a language: its size does not depend on the texts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, counts in zip(
                batch.column("lang").to_pylist(), batch.column("counts").to_pylist(), strict=True
            ):
                own = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                own += np.frombuffer(counts, dtype="<i8")
        if sums:
            yield pa.RecordBatch.from_pydict(
                {"lang": list(sums), "counts": [v.astype("<i8").tobytes() for v in sums.values()]}
            )

    merged = counted.repartition("lang").mapInArrow(add, "lang string, counts binary")
    return {row["lang"]: np.frombuffer(row["counts"], dtype="<i8") for row in merged.collect()}


def _bit_quality(sample: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Per bit: root mean square margin and share of right signs on the training texts."""
    languages = {lang: i for i, lang in enumerate(model.languages)}

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = model.code.shape[1]
        squares, right, n = np.zeros(bits), np.zeros(bits), 0
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
                margin = model.margins(text.as_py())
                squares += margin**2
                right += np.sign(margin) == model.code[languages[lang]]
                n += 1
        yield pa.RecordBatch.from_pydict(
            {"squares": [squares.tolist()], "hits": [right.tolist()], "n": [n]}
        )

    schema = "squares array<double>, hits array<double>, n bigint"
    rows = (
        sample.select("text", "lang")
        .mapInArrow(judge, schema)
        .selectExpr("posexplode(arrays_zip(squares, hits)) AS (bit, both)", "n")
        .groupBy("bit")
        .agg(
            F.sum("both.squares").alias("squares"),
            F.sum("both.hits").alias("hits"),
            F.sum("n").alias("n"),
        )
        .orderBy("bit")
        .collect()
    )
    n = np.array([max(row["n"], 1) for row in rows], dtype=np.float64)
    scale = np.sqrt(np.array([row["squares"] for row in rows]) / n)
    return np.maximum(scale, 1e-9), np.array([row["hits"] for row in rows]) / n


def fit(docs: DataFrame, per_language: int = FITTED_PER_LANGUAGE) -> Model:
    """Classifiers from ``(doc_id, text, lang)`` rows that have all three.

    About ``per_language`` texts of every language are taken, by the hash of their ids; all
    of a language that has no more.  The texts are counted where they lie; only one count
    vector of fixed size per language reaches the driver.
    """
    labelled = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(
        "doc_id IS NOT NULL AND lang IS NOT NULL AND text RLIKE '\\\\p{L}'"
    )
    sizes = {row["lang"]: row["count"] for row in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return Model((), np.zeros((0, 0)), np.zeros((BUCKETS, 0)), np.zeros(0), np.zeros(0))
    share = F.lit(0)
    for lang, size in sizes.items():
        part = min(1_000_000, -(-1_000_000 * per_language // size))
        share = F.when(F.col("lang") == lang, part).otherwise(share)
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000)) < share)
    counts = _summed(_counted(sample))
    languages = tuple(sorted(counts))
    rates = np.array([counts[lang] + _SMOOTH for lang in languages], dtype=np.float64)
    rates /= rates.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    columns = [
        np.log(rates[bit > 0].mean(axis=0)) - np.log(rates[bit < 0].mean(axis=0)) for bit in code.T
    ]
    weights = np.array(columns, dtype=np.float32).T.copy().reshape(BUCKETS, -1)
    bits = code.shape[1]
    draft = Model(languages, code, weights, np.ones(bits), np.ones(bits))
    if bits == 0:
        return draft
    scale, right = _bit_quality(sample, draft)
    trust = np.maximum(right - 0.5, 0.01)
    return Model(languages, code, weights, scale, bits * trust / trust.sum())


def identify(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``lang_pred``, ``score``, ``ambiguous`` of every whole text.

    A null text and one without letters are ``und`` with score 0.
    """
    at_hand = "text" in keep
    given = docs.select(*keep) if at_hand else docs.select(*keep, "text")
    kept = docs.select(*keep).schema

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _LABELLED_TOGETHER):
                part = batch.slice(start, _LABELLED_TOGETHER)
                found = [model.predict(text.as_py()) for text in part.column("text")]
                lang, score, ambiguous = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[: len(keep)],
                        pa.array(lang, pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array(ambiguous, pa.bool_()),
                    ],
                    names=[*keep, "lang_pred", "score", "ambiguous"],
                )

    schema = kept
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("ambiguous", "boolean")):
        schema = schema.add(name, kind)
    return given.mapInArrow(label, schema)
