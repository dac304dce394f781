"""A corpus pipeline: documents in, packed training sequences out.

Every stage is a function of ``(spark, docs, sf_dir)``; what it returns is written as
Parquet and read again as the next one's documents.

A stage lets Spark hand its Python workers about ``BATCH_BYTES`` of rows at a time, and sets
this in the session, as what it returns is computed only when it is written.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from loyalpulse.llm.language import UNDETERMINED, fit, identify
from loyalpulse.llm.line_dedup import without_repeated_lines
from loyalpulse.llm.minhash import without_near_duplicates
from loyalpulse.llm.mixing import mixed_documents
from loyalpulse.llm.packing import pack
from loyalpulse.llm.queries import BYTE_BPE, held_out, table
from loyalpulse.llm.store import stored

BATCH_BYTES = 4 << 20
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def small_batches(stage: Stage) -> Stage:
    """Bounds what JVM and Python worker hold of the texts on their way between them."""

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return bounded


@small_batches
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those whose language stays ambiguous."""
    model = fit(docs.filter(f"NOT {held_out()}"))
    names = docs.columns
    found = identify(docs, model, keep=names)
    return found.filter(f"lang_pred <> '{UNDETERMINED}' AND NOT ambiguous").select(*names)


@small_batches
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that an earlier line is alike, and documents left without a word."""
    return without_repeated_lines(docs, least_words=1)


@small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return without_near_duplicates(docs)


@small_batches
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes of every source what its weight asks for."""
    return mixed_documents(docs)


@small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of 2048 tokens."""
    return pack(docs, BYTE_BPE, end_id=0)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("packing", packing),
]

#: SQL can express neither the classifiers nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
