"""Flag rows: the closed form against real outer joins, sharing of tax ids, hot keys."""

from __future__ import annotations

from datetime import date, datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fixtures import oracle
from fixtures.views import Domain
from loyalpulse.context import RunContext
from loyalpulse.functions.blocks import BIT, BLOCKS, RULES, RuleSet, mask
from loyalpulse.operators import consolidate, credit
from loyalpulse.plans.eligibility import run_eligibility
from loyalpulse.rules import (
    ACCOUNT,
    ADDITIONS,
    CREDIT,
    EXCHANGES,
    FLAGS,
    CreditRule,
    Stratum,
    TouchpointRule,
)
from loyalpulse.sources.schemas import TABLES
from loyalpulse.sources.tables import Workspace

CTX = RunContext(as_of=date(2024, 1, 20))
TOUCH = ADDITIONS + EXCHANGES + ACCOUNT


def flags_set(row):
    return {flag for flag in FLAGS if row[flag]}


def test_every_combination_of_blocks_matches_the_outer_joins(spark):
    """All 2^14 touchpoint combinations, each as its own customer."""
    con = duckdb.connect()
    con.execute(
        "CREATE TABLE customers_a AS SELECT range AS chavecliente, "
        "CAST(range AS VARCHAR) AS NumeroDocumento FROM range(1, 16384)"
    )
    for block in TOUCH:
        constants = ", ".join(f"1 AS {flag}" for flag, blocks in FLAGS.items() if block in blocks)
        con.execute(
            f"CREATE TABLE tp_{block} AS SELECT chavecliente, {constants} FROM customers_a "
            f"WHERE chavecliente & {BIT[block]} <> 0"
        )
    names = ["chavecliente", *oracle.POINTS_FLAGS]
    con.execute(f"CREATE VIEW account_chain AS {oracle.CHAINS['account_chain']}")
    expected = con.execute(
        f"SELECT chavecliente, {oracle.zeros(oracle.POINTS_FLAGS)} "
        f"FROM ({oracle.CHAINS['touch_chain']})"
    ).fetchall()
    con.close()

    hits = spark.range(1, 16384).select(
        F.col("id").cast("string").alias("cpf"),
        F.col("id").alias("chavecliente"),
        F.col("id").cast("int").alias("blocks"),
    )
    rows = consolidate.with_flags(consolidate.split_rows(hits), tuple(oracle.POINTS_FLAGS))
    assert len(expected) == 26369
    assert sorted(map(tuple, rows.select(*names).collect())) == sorted(expected)


def test_block_positions_cover_touchpoints_and_credit():
    assert BLOCKS == TOUCH + CREDIT
    assert mask(BLOCKS) == (1 << 19) - 1


@pytest.fixture(scope="module")
def hits(spark):
    rows = [
        ("00000000001", 10, mask(["bonus"])),
        ("00000000001", 11, mask(["pix_sent", "aquisicaoplus"])),
        (None, 20, mask(["trip"])),
        (None, 21, mask(["money"])),
        ("00000000002", None, mask(["quitadospts", "aquisicaofgts"])),
        ("00000000003", 30, mask(["online", "digitalchannel"])),
    ]
    return spark.createDataFrame(rows, "cpf string, chavecliente bigint, blocks int")


def test_merge_keeps_every_flag_of_a_shared_tax_id(hits):
    rows = consolidate.with_flags(consolidate.merge_people(hits)).collect()
    assert len(rows) == 5
    shared = next(r for r in rows if r.cpf == "00000000001")
    assert shared.chavecliente == 11
    assert flags_set(shared) == {"addition", "bonus", "contapontos", "pix", "credito", "aquisicaoplus"}
    unknown = [r for r in rows if r.cpf is None]
    assert {r.chavecliente: flags_set(r) for r in unknown} == {
        20: {"exchange", "trip"}, 21: {"exchange", "money"},
    }


def test_split_keeps_the_top_row_per_tax_id(hits):
    rows = consolidate.with_flags(consolidate.one_per_person(consolidate.split_rows(hits)))
    by_id = {r.cpf: r for r in rows.collect()}
    assert len(by_id) == 4
    assert flags_set(by_id["00000000001"]) == {"contapontos", "pix", "credito", "aquisicaoplus"}
    assert by_id[None].chavecliente == 21
    # equal counts: the row whose first flags are set wins
    assert flags_set(by_id["00000000002"]) == {"credito", "aquisicaofgts"}
    assert flags_set(by_id["00000000003"]) == {"addition", "online"}


def test_a_hot_customer_and_a_hot_tax_id_lose_nothing(spark):
    """A third of the hits on one customer, a third of the customers on one tax id."""
    customers = spark.range(3000).select(
        F.col("id").alias("chavecliente"),
        F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.col("id").cast("string"))
        .alias("NumeroDocumento"),
    )
    raw = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 3000).alias("chavecliente"),
        F.expr("shiftleft(1, CAST(id % 10 AS INT))").alias("blocks"),
    )
    merged = consolidate.merge_people(consolidate.by_customer(raw, customers)).collect()
    got = {r.cpf: (r.chavecliente, r.blocks) for r in merged}
    expected: dict[str, tuple[int, int]] = {}
    for i in range(30000):
        customer = 7 if i % 3 == 0 else i % 3000
        cpf = ("" if customer % 3 == 0 else str(customer)).rjust(11, "0")
        top, bits = expected.get(cpf, (customer, 0))
        expected[cpf] = (max(top, customer), bits | 1 << i % 10)
    assert got == expected
    # ids shared by a thousand customers give each of them the hit, once
    people = spark.createDataFrame([("00000000000", mask(["pix_sent"]))], "cpf string, blocks int")
    assert consolidate.by_tax_id(people, customers).count() == 1000


def test_account_blocks_need_a_customer_and_credit_blocks_do_not(spark):
    customers = spark.createDataFrame([(1, "5")], "chavecliente bigint, NumeroDocumento string")
    people = spark.createDataFrame(
        [("00000000005", mask(["pix_sent", "aquisicaopts"])),
         ("00000000006", mask(["pix_sent", "aquisicaopts"])),
         ("00000000007", mask(["bondcard"])), (None, mask(["quitadosplus"]))],
        "cpf string, blocks int",
    )
    matched = consolidate.by_tax_id(people, customers).collect()
    assert [tuple(r) for r in matched] == [("00000000005", 1, mask(["pix_sent", "aquisicaopts"]))]
    credit = people.withColumn("blocks", F.expr(f"blocks & {mask(CREDIT)}")).filter("blocks <> 0")
    assert consolidate.credit_without_customer(credit).count() == 3
    alone = consolidate.unmatched_credit(credit, consolidate.by_tax_id(people, customers)).collect()
    assert {tuple(r) for r in alone} == {
        ("00000000006", None, mask(["aquisicaopts"])), (None, None, mask(["quitadosplus"])),
    }
    raw = people.withColumn("cpf", F.ltrim("cpf", F.lit("0")))
    assert consolidate.by_tax_id(raw, customers).first().cpf == "5"


def stored(spark, folder, **tables):
    for name, rows in tables.items():
        spark.createDataFrame(rows, TABLES[name]).write.parquet(f"{folder}/{name}")
    return {n: spark.read.schema(TABLES[n]).parquet(f"{folder}/{n}") for n in tables}


def scans(df, *names):
    """How often the executed plan reads each table; a reused exchange is not read again."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = [line for line in plan.splitlines() if "FileScan" in line]
    own = {"borrowers": "document#", "loans": "borrower_id#", "customers_a": "NumeroDocumento#"}
    return [sum(own[name] in line for line in lines) for name in names]


def test_borrowers_and_loans_are_read_once(spark, tmp_path):
    day = datetime(2024, 1, 17, 12)
    people = [
        (1, "7", "ana b", "e", "1", "c", "u", date(1990, 1, 1), False),
        (2, None, "eva", "e", "1", "c", "u", date(1990, 1, 1), False),
        (3, "9", None, "e", "1", "c", "u", None, False),
    ]
    loans = [
        (10, 1, 1, "fgts_flow", "lent", None, day, None),
        (11, 1, 1, "fgts_flow", "lent", None, day, None),
        (12, 2, 1, "default_flow", "lent", None, day, None),
        (13, 3, 1, "default_flow", "settled", None, None, day),
    ]
    customers = [(5, "7", "Ativado", "ana", "1", day), (6, "7", "Ativado", "ana", "1", day)]
    s = stored(
        spark, tmp_path, borrowers=people, loans=loans, customers_a=customers, parcelas=[],
    )
    tables = ("borrowers", "loans", "customers_a")
    got = credit.credit_acquired(s["borrowers"], s["loans"], s["customers_a"], CTX)
    assert sorted((r.NU_CPF or "", r.chavecliente or 0) for r in got.collect()) == [
        ("", 0), ("7".zfill(11), 5), ("7".zfill(11), 5), ("7".zfill(11), 6), ("7".zfill(11), 6),
    ]
    assert scans(got, *tables) == [1, 1, 1]
    base = credit.credit_settled_base(s["borrowers"], s["loans"], s["parcelas"], CTX)
    settled = credit.credit_settled(base, s["customers_a"])
    assert [(r.NU_CPF, r.chavecliente) for r in settled.collect()] == [("9".zfill(11), None)]
    # the loans are read for the contracts and for their instalments
    assert all(a <= b for a, b in zip(scans(settled, *tables), (1, 2, 1)))
    for rule in credit.CREDIT_RULES:
        block = credit.credit_flags(rule.block, s["borrowers"], s["loans"], s["customers_a"], CTX)
        # a block without rows may leave no scan in the final plan
        assert all(n <= 1 for n in scans(block, *tables))
    merged = consolidate.per_tax_id(credit.credit_hits(s["loans"], s["borrowers"], CTX))
    matched = consolidate.of_customers(merged, s["customers_a"])
    alone = consolidate._unmatched(merged, matched)
    assert scans(matched.unionByName(alone), "borrowers", "loans") == [1, 1]
    both = matched.unionByName(consolidate.credit_without_customer(merged))
    assert scans(both, *tables) == [1, 1, 1]


def test_own_rules_take_further_bits_and_columns(spark):
    week = TouchpointRule("online_week", 1, 7, {"nivel2": ("online",)})
    fgts = CreditRule("settled_fgts", "settled", client_type="FGTS")
    rules = RULES.with_rules("online_week", [week]).with_rules("credito", credit=[fgts])
    assert [rules.bit[b] for b in BLOCKS] == [BIT[b] for b in BLOCKS]
    assert rules.flags["credito"] == (*CREDIT, "settled_fgts")
    ctx, d = CTX, Domain(spark, SF_SMALL)
    for flags in ("merge", "split"):
        usual = consolidate.eligible(d, ctx.but(flag_mode=flags))
        own = consolidate.eligible(d, ctx.but(flag_mode=flags), rules)
        assert own.columns == [*usual.columns[:-1], "online_week", "data_atualizacao"]
        assert own.filter("online = 1 AND online_week = 0").count() == 0
        assert own.filter("online = 0 AND online_week = 1").count() > 0
    with pytest.raises(ValueError, match="set no flag"):
        RuleSet(ledger=(week,))
    with pytest.raises(ValueError, match="no rule sets"):
        RuleSet(flags={**FLAGS, "x": ("unheard",)})


def test_a_run_with_own_rules_writes_their_columns(spark, tmp_path):
    week = TouchpointRule("online_week", 1, 7, {"nivel2": ("online",)})
    rules = RULES.with_rules("online_week", [week])
    ws = Workspace(spark, str(tmp_path))
    strata = (Stratum("positivo", 1, 1.0), Stratum("pontos", 0, 1.0, any_of=("online_week",)))
    run_eligibility(Domain(spark, SF_SMALL), CTX, ws, strata, rules)
    drawn = ws.table("survey_pontos")
    assert drawn.columns[-1] == "online_week"
    assert drawn.filter("online_week = 0").count() == 0 < drawn.count()
