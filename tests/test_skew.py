"""Adaptive execution must be able to split the joins that can meet a hot key."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from loyalpulse.context import RunContext
from loyalpulse.functions.blocks import BIT
from loyalpulse.operators import consolidate, contact, sampling, suppression, touchpoints

CTX = RunContext(as_of=date(2024, 1, 20))
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}
N = 60000


@pytest.fixture
def tiny_partitions(spark):
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed(df):
    """Run, and return the number of rows and the plan as it was adapted."""
    rows = len(df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    return rows, plan.split("== Initial Plan ==")[0]


def noise(column="id"):
    """Values that do not compress, so sizes are what they look like."""
    return F.xxhash64(column)


def files(df):
    """Several upstream tasks, whose outputs are the units a hot partition is split into."""
    return df.repartition(16)


def test_a_hot_partner_is_split(tiny_partitions):
    ledger = files(
        tiny_partitions.range(N).select(
            noise().alias("chavecliente"),
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("chaveparceiro"),
            F.lit(1).cast("bigint").alias("chavefilialparceiro"),
            F.expr("timestamp_seconds(1705665600)").alias("DataProcessamentoTransacao"),
            F.expr("timestamp_seconds(1705665600)").alias("DataCheckOut"),
            F.lit(1).alias("CodigoSubTipoPromocao"),
        )
    )
    partners = tiny_partitions.range(N).selectExpr(
        "id AS chaveparceiro", "1L AS chavefilialparceiro", "'online' AS nivel2", "'x' AS nivel3"
    )
    rows, plan = executed(touchpoints.ledger_hits(ledger, partners, CTX))
    assert rows == N
    assert "skew=true" in plan


def test_a_tax_id_of_many_customers_is_split(tiny_partitions):
    customers = files(
        tiny_partitions.range(N).select(
            noise().alias("chavecliente"),
            F.when(F.col("id") % 3 == 0, "").otherwise(F.col("id").cast("string"))
            .alias("NumeroDocumento"),
        )
    )
    people = tiny_partitions.range(2000).select(
        F.lpad(F.col("id").cast("string"), 11, "0").alias("cpf"),
        F.lit(BIT["pix_sent"]).alias("blocks"),
    )
    hits = consolidate.by_tax_id(people, customers)
    merged = consolidate.merge_people(hits)
    rows, plan = executed(merged)
    assert rows == 2000 - len(range(3, 2000, 3))
    # grouping by person shuffles anyway, so the split costs nothing further
    assert "skew=true" in plan


def test_a_hot_document_is_split_when_contacts_are_joined(tiny_partitions):
    ids = [f"{i:011d}" for i in range(400)]
    drawn = tiny_partitions.createDataFrame([(i, n) for n, i in enumerate(ids)], "cpf string, chavecliente bigint")
    flags = [F.lit(0).alias(f) for f in contact.FLAGS]
    drawn = drawn.select("*", *flags, F.lit(CTX.as_of).alias("data_atualizacao"))
    passing = [r.cpf for r in drawn.filter(sampling.may_be_drawn("cpf", "positivo", CTX)).collect()]
    hot = passing[0]
    borrowers = files(
        tiny_partitions.range(N).select(
            F.when(F.col("id") % 3 == 0, hot).otherwise(F.col("id").cast("string")).alias("document"),
            F.lit("ana").alias("name"),
            F.sha2(F.col("id").cast("string"), 256).alias("email"),
            F.lit("1").alias("mobile_number"),
        )
    )
    rows, plan = executed(contact.contact_credit(drawn, borrowers, CTX))
    assert rows >= N // 3
    assert "skew=true" in plan


def test_people_without_a_tax_id_do_not_meet_in_one_task(tiny_partitions):
    people = files(
        tiny_partitions.range(N).select(
            F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("cpf"),
            F.col("id").alias("chavecliente"),
        )
    )
    tiny_partitions.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    blocked = tiny_partitions.range(0, N, 2).selectExpr("CAST(id AS STRING) AS NU_CPF").distinct()
    kept = suppression.suppress(people, blocked)
    sizes = [r["n"] for r in kept.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == N // 3 + N // 3
    assert max(sizes) < N // 4


def test_a_hot_send_is_split_and_combined(tiny_partitions):
    """A third of the rows are copies of one send."""
    sends = files(
        tiny_partitions.range(N).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("_id"),
            F.expr("timestamp_seconds(1705320000 + xxhash64(id) % 40000)").alias("createdAt"),
            F.lit(True).alias("answered"),
            F.expr(
                """array(named_struct('column', 'chavecliente', 'value',
                                      CAST(if(id % 3 = 0, 0, id) AS STRING)),
                         named_struct('column', 'numerocpf', 'value', CAST(id AS STRING)))"""
            ).alias("indicators"),
        )
    )
    rows, plan = executed(suppression.quarantine_expiry(sends, CTX))
    assert rows == N
    assert "skew=true" in plan
    active = suppression.active_quarantine(sends, CTX)
    rows, plan = executed(active)
    assert rows == 1 + N // 3 * 2
    assert "Join" not in plan
