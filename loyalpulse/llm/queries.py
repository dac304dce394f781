"""The registered queries of the package: every operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalpulse.llm import check_sql
from loyalpulse.llm.cap_filters import near_vectors
from loyalpulse.llm.language import fit, identify
from loyalpulse.llm.line_dedup import per_document
from loyalpulse.llm.minhash import near_duplicates
from loyalpulse.llm.mixing import Mix
from loyalpulse.llm.packing import pack
from loyalpulse.llm.passages import repeated_passages
from loyalpulse.llm.periodic_runs import periodic_runs
from loyalpulse.llm.projected_search import nearest
from loyalpulse.llm.quality_rules import quality
from loyalpulse.llm.secrets_scan import BASE_KINDS, scan
from loyalpulse.llm.store import shared_folder
from loyalpulse.llm.token_files import read_token_files, write_token_files
from loyalpulse.llm.whitening import whiten

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_document(table(spark, sf_dir, "documents"), least_words=1)


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = f"filter(found, s -> s.kind IN {BASE_KINDS})"
    text = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    return scan(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id",
        *(
            f"CAST(size(filter(found, s -> s.kind = '{kind}')) AS BIGINT) AS n_{kind}"
            for kind in BASE_KINDS
        ),
        f"sha2({text.format(base)}, 256) AS base_sha256",
        f"{text.format('found')} AS spans",
    )


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.98)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Mix(table(spark, sf_dir, "documents")).per_document()


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder, BYTE_BPE, end_id=2)
    return read_token_files(manifest, folder)


def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=0, capacity=2048)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def held_out(doc_id: str = "doc_id") -> str:
    return f"coalesce(crc32(CAST({doc_id} AS STRING)) % 4 = 2, false)"


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(f"NOT {held_out()}"))
    return identify(docs, model).select("*", F.expr(held_out()).alias("held_out"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).selectExpr(
        "vec_id",
        "component",
        "n",
        "try_cast(deviation AS BIGINT) AS deviation",
        "whitened",
        "explained",
        "identity_error",
        "deviation AS deviation_exact",
    )


WORD_ARRAY = r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``, every tenth document (by its id's crc32) made periodic from some word on."""
    hashed = docs.selectExpr("doc_id", "text", "crc32(CAST(doc_id AS STRING)) AS h").selectExpr(
        "doc_id",
        "text",
        "h DIV 10 AS g",
        f"CASE WHEN h % 10 = 0 THEN {WORD_ARRAY} END AS words",
    )
    placed = hashed.selectExpr(
        "*", "CASE WHEN size(words) > 0 THEN g % size(words) END AS a"
    ).selectExpr("*", "1 + (size(words) - a) DIV (3 + g % 8) AS p")
    periodic = "transform(words, (w, i) -> IF(i < a, w, words[CAST(a + (i - a) % p AS INT)]))"
    return placed.selectExpr(
        "doc_id", f"CASE WHEN a IS NULL THEN text ELSE array_join({periodic}, ' ') END AS text"
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    longest = """array_max(transform(runs, r -> struct(
        r.length AS length, -r.start AS before, -r.period AS shorter)))"""
    lines = "transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n'))"
    return found.selectExpr("*", f"{longest} AS most").selectExpr(
        "doc_id",
        "CAST(size(runs) AS BIGINT) AS n_runs",
        "-most.before AS start",
        "most.length AS length",
        "-most.shorter AS period",
        "1000 * most.length DIV -most.shorter AS exponent_milli",
        f"sha2(array_join({lines}, ''), 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    )


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed",
        "kept",
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_mix_sources": op5_mix_sources,
    "op6_token_files": op6_token_files,
    "op7_nearest_vectors": op7_nearest_vectors,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_language_id": op10_language_id,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_quality_rules": op13_quality_rules,
    "pipeline": pipeline,
}

#: Check SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {"op13_quality_rules": check_sql.QUALITY}
