"""Quality rules as a short-circuit cascade, in SQL functions alone.

A rule is a condition that rejects a document.  Conditions speak of ``text``, of its ``words`` and
of measures, which are expressions too.  What a rule costs and how often it rejects is estimated on
a bounded sample; the rules are then tried by rejections per second, highest first, in one CASE
that stops at the first rule that rejects.  The order decides what is computed, never who is kept.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalpulse.llm.store import stored

#: Rows of the sample that costs and selectivities are estimated on, and the runs a rule is timed.
SAMPLE_ROWS = 2000
RUNS = 2
SEED = 13

#: What the measures need of a text, each a column computed once; later ones use earlier ones.
#: Windows of three words are first compared by hash: numbers that hold a hash's upper bits and the
#: window's place are sorted, and places whose neighbour has the same bits are suspects.  Only
#: suspects are compared as words, joined by a space, which words cannot hold.
PARTS = (
    ("words", r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"),
    ("lines", r"filter(split(text, '\\n'), l -> l RLIKE '[^\\x20\\x09-\\x0D]')"),
    (
        "hashes",
        """transform(slice(words, 1, greatest(size(words) - 2, 0)),
            (w, i) -> xxhash64(w, words[i + 1], words[i + 2]))""",
    ),
    ("bits", "length(bin(size(hashes)))"),
    (
        "sorted",
        """CASE WHEN size(array_distinct(hashes)) < size(hashes) THEN sort_array(
            transform(hashes, (h, i) -> shiftleft(shiftright(h, bits), bits) | i)) END""",
    ),
    (
        "suspects",
        """array_distinct(flatten(transform(
            filter(sequence(1, size(sorted) - 1),
                j -> shiftright(sorted[j] ^ sorted[j - 1], bits) = 0),
            j -> array(sorted[j - 1], sorted[j]))))""",
    ),
    (
        "by_window",
        """sort_array(transform(
            transform(suspects, s -> CAST(s & (shiftleft(1L, bits) - 1) AS INT)),
            i -> struct(concat(words[i], ' ', words[i + 1], ' ', words[i + 2]) AS w, i AS i)))""",
    ),
    (
        "repeated",
        """filter(by_window, (x, j) ->
            (j > 0 AND by_window[greatest(j - 1, 0)].w = x.w)
            OR (j + 1 < size(by_window) AND by_window[least(j + 1, size(by_window) - 1)].w = x.w))""",
    ),
)
MEASURES = (
    ("n_words", "CAST(size(words) AS BIGINT)"),
    ("word_chars", "CAST(length(array_join(words, '')) AS BIGINT)"),
    ("n_symbols", "CAST(regexp_count(text, '[#*$%&|<>]') AS BIGINT)"),
    ("n_lines", "CAST(size(lines) AS BIGINT)"),
    ("n_dup_lines", "CAST(size(lines) - size(array_distinct(lines)) AS BIGINT)"),
    (
        "n_repeat_words",
        """CAST(coalesce(size(array_distinct(flatten(
            transform(repeated, x -> array(x.i, x.i + 1, x.i + 2))))), 0) AS BIGINT)""",
    ),
)


@dataclass(frozen=True)
class Rule:
    """Rejects a document where ``condition``, SQL over measures, ``text`` and ``words``, is true."""

    name: str
    condition: str


RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeats", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > 2 * n_words"),
    Rule("dup_lines", "n_lines >= 6 AND 100 * n_dup_lines > 60 * n_lines"),
    Rule("word_length", "word_chars > 20 * n_words"),
    Rule("shouting", r"10 * length(regexp_replace(text, '\\P{Lu}+', '')) > 5 * word_chars"),
    Rule("digits", r"10 * length(regexp_replace(text, '[^0-9]+', '')) > 3 * word_chars"),
)


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``text`` (null as empty) and ``words`` of every row with all measures.

    Measures are whole numbers over whole texts: words (parted by 0x20, 0x09-0x0D), code points
    in words, symbols, lines with a word, lines equal to an earlier one, and words that lie in a
    window of three words which the text holds twice or more.
    """
    out = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    for name, expression in PARTS:
        out = out.selectExpr("*", f"{expression} AS {name}")
    return out.selectExpr("id", "text", "words", *(f"{e} AS {name}" for name, e in MEASURES))


class Cascade:
    """Rules in the order in which a cascade should try them.

    ``sample`` is a stored table of few rows with the columns that the conditions speak of.
    ``costs`` are seconds per sample row and ``shares`` the shares of sample rows rejected.  Costs
    are timed, so the order may differ between runs; which rows pass does not.  An empty sample
    leaves the rules in the order given.
    """

    def __init__(self, sample: DataFrame, rules: Sequence[Rule] = RULES):
        self.costs: dict[str, float] = {}
        self.shares: dict[str, float] = {}
        taken = sample.count()
        if taken:
            for rule in rules:
                self._estimate(sample, rule, taken)
        self.rules = sorted(rules, key=self._rank)

    def _estimate(self, sample: DataFrame, rule: Rule, taken: int) -> None:
        seconds = []
        for _ in range(RUNS):
            start = time.perf_counter()
            rejected = sample.selectExpr(f"count_if({rule.condition})").first()[0]
            seconds.append(time.perf_counter() - start)
        self.costs[rule.name] = min(seconds) / taken
        self.shares[rule.name] = rejected / taken

    def _rank(self, rule: Rule) -> tuple[float, float]:
        cost = self.costs.get(rule.name, 1.0)
        return -self.shares.get(rule.name, 0.0) / cost, cost

    def rejected_by(self) -> str:
        """SQL for the name of the first rule that rejects a row; null where all pass it."""
        tried = " ".join(f"WHEN {rule.condition} THEN '{rule.name}'" for rule in self.rules)
        return f"CASE {tried} END" if tried else "CAST(NULL AS STRING)"


def quality(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    rules: Sequence[Rule] = RULES,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``id``, the measures, ``rejected_by`` and ``kept`` of every row of ``docs``.

    ``rejected_by`` names the first rule of the cascade that rejects the row; where several do, it
    depends on the order found.  ``kept`` is true where none does.  Null and empty texts have no
    words and count as any text of few words; repeated rows and null ids are answered row by row;
    other columns are left out; an empty table gives an empty one.
    """
    rows = docs.count()
    share = min(1.0, 1.2 * sample_rows / rows) if rows else 1.0
    sample = docs.sample(share, seed=SEED).limit(sample_rows)
    cascade = Cascade(stored(measured(sample, id, text)), rules)
    given = measured(docs, id, text)
    names = [name for name, _ in MEASURES]
    return (
        given.selectExpr("id", *names, f"{cascade.rejected_by()} AS rejected_by")
        .selectExpr("*", "rejected_by IS NULL AS kept")
        .withColumnRenamed("id", id)
    )
