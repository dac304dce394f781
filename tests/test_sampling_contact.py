"""The draw and the contact data of the people drawn."""

from __future__ import annotations

import hashlib
import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from loyalpulse.context import RunContext
from loyalpulse.operators import contact, sampling
from loyalpulse.rules import FLAGS, STRATA, Stratum
from loyalpulse.sources.schemas import TABLES

CTX = RunContext(as_of=date(2024, 1, 20))


def people(spark, n, **flags):
    zero = {flag: F.lit(0) for flag in FLAGS}
    for flag, text in flags.items():
        zero[flag] = F.expr(text)
    return spark.range(n).select(
        F.lpad(F.col("id").cast("string"), 11, "0").alias("cpf"),
        F.col("id").alias("chavecliente"),
        *(c.cast("int").alias(f) for f, c in zero.items()),
        F.lit(CTX.as_of).alias("data_atualizacao"),
    )


def test_strata_are_disjoint_and_exhaustive(spark):
    flags = ("credito", "bonus", "trip", "aquisicaopts", "quitadospts")
    every = people(spark, 32, **{f: f"(id >> {i}) & 1" for i, f in enumerate(flags)})
    inside = sum(F.when(F.expr(sampling.in_stratum(s)), 1).otherwise(0) for s in STRATA)
    assert [r[0] for r in every.select(inside).distinct().collect()] == [1]


def test_draw_is_the_stated_hash_test(spark):
    drawn = {r.cpf for r in sampling.draw(people(spark, 3000), "pontos", CTX).collect()}
    def share(i):
        text = f"{i:011d}|2024-01-20|"
        return int(hashlib.md5(text.encode()).hexdigest()[:12], 16) / 16**12
    assert drawn == {f"{i:011d}" for i in range(3000) if share(i) < 0.05}


def test_rates_nest_and_hold(spark):
    n = 40000
    everyone = people(spark, n)
    drawn = {}
    for rate in (0.0, 0.05, 0.5, 1.0):
        strata = (Stratum("s", credit=0, rate=rate),)
        rows = sampling.draw(everyone.repartition(7), "s", CTX, strata).select("cpf").collect()
        drawn[rate] = {r.cpf for r in rows}
        assert abs(len(rows) - n * rate) <= 4 * math.sqrt(n * rate * (1 - rate))
    assert drawn[0.05] < drawn[0.5] < drawn[1.0]
    other_day = sampling.draw(everyone, "pontos", CTX.but(as_of=date(2024, 1, 22)))
    assert {r.cpf for r in other_day.collect()} != drawn[0.05]
    salted = sampling.draw(everyone, "pontos", CTX.but(draw_salt="again"))
    assert {r.cpf for r in salted.collect()} != drawn[0.05]


def test_unknown_ids_and_other_surveys_are_not_drawn(spark):
    unknown = people(spark, 200).withColumn("cpf", F.lit(None).cast("string"))
    assert sampling.draw(unknown, "pontos", CTX, (Stratum("pontos", 0, 1.0),)).count() == 0
    assert sampling.draw(people(spark, 2000, credito="1"), "pontos", CTX).count() == 0


@pytest.fixture
def drawn(spark):
    # ids that pass the 5 % hash test of both surveys
    passing = sampling.draw(people(spark, 200), "pontos", CTX).select("cpf").collect()
    a, b, c = sorted(r.cpf for r in passing)[:3]
    return people(spark, 200).filter(F.col("cpf").isin(a, b, c)), (a, b, c)


def test_contact_points_takes_the_latest_registration(spark, drawn):
    df, (a, b, c) = drawn
    customers = spark.createDataFrame(
        [
            (1, a.lstrip("0"), "Ativado", "old name", "1", datetime(2020, 1, 1)),
            (2, a, "Ativado", "new name", "2", datetime(2021, 1, 1)),
            (3, a, "Ativado", "undated", "3", None),
            (4, b, "Ativado", "  ", None, datetime(2021, 1, 1)),
            (5, c, "Ativado", "no contact", "5", datetime(2021, 1, 1)),
        ],
        TABLES["customers_a"],
    )
    contacts = spark.createDataFrame(
        [(1, a, "Bom", "a1@x"), (2, a, "Bom", "a2@x"), (4, b, "Bom", None)], TABLES["contatos"]
    )
    rows = contact.contact_points(df, customers, contacts, CTX).collect()
    assert {(r.cpf, r.nome, r.telefone, r.email, r.data_atualizacao) for r in rows} == {
        (a, "NEW", "2", "a2@x", "20/01/2024"), (b, "CLIENTE pontos", None, None, "20/01/2024"),
    }
    assert tuple(rows[0].asDict()) == contact.CONTACT_COLUMNS


@pytest.mark.parametrize("rate", [0.5, 1.0])
def test_everyone_drawn_with_own_strata_is_contacted(spark, rate):
    strata = (Stratum("positivo", credit=1, rate=rate),)
    drawn = sampling.draw(people(spark, 90, credito="1"), "positivo", CTX, strata)
    borrowers = spark.createDataFrame(
        [(i, f"{i:011d}", "ana", "1@x", "55", "c", "u", date(2000, 1, 1), False) for i in range(90)],
        TABLES["borrowers"],
    )
    got = contact.contact_credit(drawn, borrowers, CTX)
    assert got.count() == drawn.count() > 0


def test_what_was_drawn_tells_how_contacts_are_cut(spark, tmp_path):
    strata = (Stratum("positivo", credit=1, rate=0.3),)
    drawn = sampling.draw(people(spark, 90, credito="1"), "positivo", CTX.but(draw_salt="x"), strata)
    drawn.write.parquet(f"{tmp_path}/drawn")
    stored = spark.read.parquet(f"{tmp_path}/drawn")
    borrowers = spark.createDataFrame(
        [(i, f"{i:011d}", "ana", "1@x", "55", "c", "u", date(2000, 1, 1), False) for i in range(90)],
        TABLES["borrowers"],
    )
    bare = stored.withColumn("cpf", F.concat("cpf", F.lit("")))
    for frame in (drawn, stored, bare):  # another context, or no note at all, loses no one
        assert contact.contact_credit(frame, borrowers, CTX).count() == drawn.count() > 0
    cut = contact.contact_credit(stored, borrowers, CTX)._jdf.queryExecution().executedPlan().toString()
    assert "md5" in cut
    with pytest.raises(ValueError, match="no stratum"):
        sampling.draw(drawn, "unheard", CTX, strata)


def test_contact_credit_keeps_every_borrower_record(spark, drawn):
    df, (a, b, c) = drawn
    rows = [(1, a.lstrip("0"), "ana b", "1@x", "55"), (2, a, None, "2@x", "n/a"), (3, b, "", "3@x", None)]
    borrowers = spark.createDataFrame(
        [(*r, "c", "u", date(2000, 1, 1), False) for r in rows], TABLES["borrowers"]
    )
    got = contact.contact_credit(df, borrowers, CTX).collect()
    assert {(r.cpf, r.nome, r.email, r.telefone) for r in got} == {
        (a, "ANA", "1@x", 55), (a, "CLIENTE positivo", "2@x", None),
        (b, "CLIENTE positivo", "3@x", None),
    }
    literal = contact.contact_credit(df, borrowers, CTX.but(pad_ids=False)).collect()
    assert {r.email for r in literal} == {"2@x", "3@x"}
