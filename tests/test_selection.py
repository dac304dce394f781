"""Touchpoint, credit and do-not-contact rules on hand-made rows."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import Observation, functions as F

from loyalpulse.context import RunContext
from loyalpulse.functions.blocks import BIT, mask
from loyalpulse.operators import credit, suppression, touchpoints
from loyalpulse.sources.schemas import TABLES

CTX = RunContext(as_of=date(2024, 1, 20))


def table(spark, name, *rows):
    return spark.createDataFrame(list(rows), TABLES[name])


def at(day, hour=12, minute=0):
    return datetime(2024, 1, day, hour, minute)


def test_ledger_rules_and_local_midnight(spark):
    partners = table(
        spark, "parceiros",
        (1, 1, "varejo", "bonus"), (2, 1, "bancos", None), (3, 1, "bancos", "banco_x"),
        (4, 1, "bancos", "especiais2"), (5, 1, "varejo", "outros"), (5, 1, "varejo", "telecom"),
    )
    ledger = table(
        spark, "extrato",
        (10, 1, 1, at(19), at(17), 1),          # bonus
        (11, 1, 1, at(20, 2, 59), at(17), 1),   # 23:59 of the 19th in Sao Paulo: bonus
        (12, 1, 1, at(20, 3, 0), at(17), 1),    # midnight: the 20th
        (13, 1, 1, at(19), at(16), 1),          # checked out too early
        (14, 2, 1, at(13), None, 1),            # NOT IN is unknown for a NULL level
        (15, 3, 1, at(13), None, 1),            # bancos
        (16, 4, 1, at(13), None, 1),            # special project
        (17, 5, 1, at(18), None, 1),            # varejo and telecom: two partner rows
        (18, 5, 1, at(18), None, 2),            # other promotion: telecom only
        (19, 9, 9, at(19), at(19), 1),          # unknown partner
        (None, 1, 1, at(19), at(19), 1),
    )
    hits = touchpoints.ledger_hits(ledger, partners, CTX).groupBy("chavecliente")
    got = {r[0]: r[1] for r in hits.agg(F.bit_or("blocks")).collect()}
    assert got == {
        10: BIT["bonus"], 11: BIT["bonus"], 15: BIT["bancos"],
        17: mask(["varejo", "telecom"]), 18: BIT["telecom"],
    }


def test_exchange_rules(spark):
    classes = table(spark, "classe_exchange", (1, "trippontos"), (2, "mobile"), (3, "tef"))
    statuses = table(spark, "status_exchange", (1, "OK - Produto Entregue"), (2, "Pendente"))
    rows = table(
        spark, "exchange",
        (10, 1, 99, at(17), "S"),   # trip needs no status
        (11, 1, 1, at(17), "N"),    # not valid
        (12, 2, 2, at(19), "S"),    # digital, just requested
        (13, 2, 99, at(19), "S"),   # digital with an unknown status
        (14, 2, 1, at(5), "S"),     # delivered, 15 days ago
        (15, 2, 2, at(10), "S"),    # not delivered
        (16, 2, 1, at(4), "S"),     # delivered too long ago
        (17, 2, 1, at(18), "S"),    # between the two windows
        (18, 3, 1, at(18), "S"),    # physical
    )
    hits = touchpoints.exchange_hits(rows, classes, statuses, CTX).collect()
    assert {(r.chavecliente, r.blocks) for r in hits} == {
        (10, BIT["trip"]), (12, BIT["digitalchannel"]), (14, BIT["digitalchannel"]),
        (18, BIT["physicalchannel"]),
    }


def test_payment_sides_come_from_one_scan(spark):
    rows = table(
        spark, "transactions",
        ("CONFIRMED", "5", "F", "6", "F", at(17)),
        ("CONFIRMED", "7", "J", "123456789019", "F", at(17)),
        ("FAILED", "8", "F", "8", "F", at(17)),
        ("CONFIRMED", None, "F", "9", "F", at(18)),
    )
    hits = touchpoints.payment_hits(rows, CTX)
    assert {tuple(r) for r in hits.collect()} == {
        ("00000000005", BIT["pix_sent"]), ("00000000006", BIT["pix_received"]),
        ("12345678901", BIT["pix_received"]),
    }
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_unknown_names_are_refused(spark):
    with pytest.raises(KeyError):
        touchpoints.touchpoint("nothing", {}, CTX)
    with pytest.raises(KeyError):
        credit.credit_flags("nothing", None, None, None, CTX)


@pytest.fixture(scope="module")
def loans(spark):
    web, points = '{"utm_source": "web"}', '{"utm_source": "pontos"}'
    rows = [
        (1, 1, 3, "refinancing_flow", web), (2, 1, 3, "pre_approved_flow", None),
        (3, 1, 1, "pre_approved_flow", None), (4, 1, 1, "pre_approved_flow", '{"utm_source": {}}'),
        (5, 1, 1, "default_flow", '{"utm_campaign": "finanzero"}'), (6, 1, 1, "fgts_flow", points),
        (7, 1, 1, "recurring_flow", web), (8, 1, 1, "x", None), (9, 1, 2, "x", web),
        (10, 1, None, None, "broken"),
    ]
    return table(spark, "loans", *((i, b, p, f, "lent", u, at(17), None) for i, b, p, f, u in rows))


def test_origin_and_client_type_rules(loans):
    got = loans.orderBy("id").select(credit.credit_origin(), credit.client_type()).collect()
    assert [tuple(r) for r in got] == [
        ("positivo", "exchangeeGanhe"), ("credpartner3", "Pre aprovado"),
        ("pontos", "Pre aprovado"), ("pontos", "Pre aprovado"),
        ("credpartner1", "Cliente Novo"), ("credpartner2", "FGTS"),
        ("Outros", "Recorrente"), ("positivo", "exchangeeGanhe"),
        ("positivo", "exchangeeGanhe"), ("positivo", "exchangeeGanhe"),
    ]


def borrower(i, document, name="Ana Maria"):
    return (i, document, name, f"{i}@x", "1", "c", "u", date(2000, 1, 1), False)


def test_credit_hits_meet_per_borrower(spark, loans):
    people = table(spark, "borrowers", borrower(1, "5"), borrower(2, None))
    hits = credit.credit_hits(loans, people, CTX).collect()
    assert [tuple(r) for r in hits] == [
        ("00000000005", mask(["aquisicaoplus", "aquisicaopts", "aquisicaofgts"]))
    ]
    raw = credit.credit_hits(loans, people, CTX.but(pad_ids=False)).collect()
    assert raw[0].cpf == "5"


def test_acquired_keeps_borrowers_without_a_customer(spark, loans):
    people = table(spark, "borrowers", borrower(1, "5", ""))
    nobody = table(spark, "customers_a", (1, None, "Ativado", "x", "1", at(1)))
    rows = credit.credit_acquired(people, loans, nobody, CTX).collect()
    assert len(rows) == 10
    assert {(r.chavecliente, r.name, r.dias) for r in rows} == {(None, "", 8785)}


def test_settled_counts_late_instalments_once_per_contract(spark):
    loans = table(
        spark, "loans",
        (1, 1, 1, "x", "settled", None, None, at(17)), (2, 1, 1, "x", "settled", None, None, at(17)),
        (3, 1, 1, "x", "settled", None, None, at(18)),
    )
    people = table(spark, "borrowers", borrower(1, "5"))
    parts = table(spark, "parcelas", *[(1, at(2))] * 500, (1, None), (2, None), (3, at(1)))
    base = credit.credit_settled_base(people, loans, parts, CTX)
    assert {(r.contrato, r.qnt_parcelas_atrasadas) for r in base.collect()} == {(1, 500), (2, 0)}
    customers = table(spark, "customers_a", (8, "05", "Ativado", "x", "1", at(1)))
    rows = credit.credit_settled(base, customers).collect()
    assert {(r.forma_quitacao, r.chavecliente) for r in rows} == {("atraso", 8), ("em_dia", 8)}


def pairs(*values):
    return [{"column": c, "value": v} for c, v in values]


def test_quarantine(spark):
    def send(i, day, answered, customer, cpf="1", extra=()):
        return (i, datetime(*day), answered, pairs(("chavecliente", customer), ("numerocpf", cpf), *extra))

    sends = table(
        spark, "coplusites",
        send("a", (2024, 1, 5, 12), False, "1"),          # 15 days: last day is the 20th
        send("b", (2024, 1, 5, 2), False, "2"),           # locally the 4th: expired
        send("c", (2023, 10, 22, 12), True, "3"),         # 90 days
        send("d", (2024, 1, 19, 12), None, "4"),          # unknown answer never blocks
        send("e", (2024, 1, 10, 12), False, "5", "old"),
        send("f", (2024, 1, 12, 12), False, "5", "new"),  # the later expiry wins
        send("g", (2024, 1, 10, 12), False, "oops", "7"),
        ("h", datetime(2024, 1, 19), True, []),
        ("i", datetime(2024, 1, 19), True, pairs(("numerocpf", "9"))),
        ("k", datetime(2024, 1, 19), True, pairs(("numerocpf", "1"), ("numerocpf", "3"), ("chavecliente", "6"))),
    )
    expected = {
        (1, "1", date(2024, 1, 20)), (3, "1", date(2024, 1, 20)), (5, "new", date(2024, 1, 27)),
        (None, "7", date(2024, 1, 25)), (6, "3", date(2024, 4, 17)),  # midnight UTC is the evening before
    }
    for unique in (False, True):
        for padded in (False, True):
            ctx = CTX.but(pad_ids=padded)
            rows = suppression.active_quarantine(sends, ctx, unique_ids=unique).collect()
            ids = {(c, i.rjust(11, "0") if padded else i, day) for c, i, day in expected}
            assert {tuple(r) for r in rows} == ids
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        suppression.active_quarantine(sends, CTX.but(strict_casts=True)).collect()
    # indicators of one send spread over rows of different dates still meet
    spread = table(
        spark, "coplusites",
        ("z", datetime(2020, 1, 1), True, pairs(("chavecliente", "9"))),
        ("z", datetime(2024, 1, 19), True, pairs(("numerocpf", "4"))),
    )
    assert [r.NU_CPF for r in suppression.active_quarantine(spread, CTX).collect()] == ["4".zfill(11)]


def test_recent_quarantine_equals_the_full_scan_and_prunes(spark, tmp_path):
    def send(i, day, answered, *indicators):
        return (i, datetime(*day), answered, pairs(*indicators))

    rows = [
        send("new", (2024, 1, 10), False, ("chavecliente", "1"), ("numerocpf", "1")),
        send("old", (2023, 1, 10), True, ("chavecliente", "2"), ("numerocpf", "2")),
        # the repeated ids take their customer, or their largest one, from rows of years ago
        send("z", (2020, 1, 1), True, ("chavecliente", "9")),
        send("z", (2024, 1, 19), True, ("numerocpf", "4")),
        send("y", (2019, 1, 1), False, ("chavecliente", "8"), ("numerocpf", "9")),
        send("y", (2024, 1, 19), True, ("chavecliente", "7"), ("numerocpf", "3")),
        send(None, (2020, 1, 1), True, ("chavecliente", "5")),
        send(None, (2024, 1, 19), True, ("numerocpf", "6")),
        ("x", None, True, pairs(("chavecliente", "3"))),
        ("x", datetime(2024, 1, 19), True, pairs(("numerocpf", "3"))),
    ]
    sends = table(spark, "coplusites", *rows)
    whole = {tuple(r) for r in suppression.active_quarantine(sends, CTX).collect()}
    assert {r[0] for r in whole} == {1, 9, 8, 5, 3}
    sends.write.parquet(str(tmp_path / "sends"))
    stored = spark.read.schema(sends.schema).parquet(str(tmp_path / "sends"))
    pruned = suppression.recent_quarantine(stored, CTX)
    assert {tuple(r) for r in pruned.collect()} == whole
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(createdAt" in plan


def test_reasons_are_counted_per_list_and_alone(spark):
    people = spark.createDataFrame(
        [("1", 1), ("2", 2), ("3", 3), ("4", 4), (None, 5), (None, None)],
        "cpf string, chavecliente bigint",
    )
    names = ("a", "b", "c")
    listed = spark.createDataFrame([("1", 1), ("2", 3), ("4", 2), ("9", 7)], "NU_CPF string, lists int")
    counts = suppression.reason_counts(suppression.mark_listed(people, listed), names).collect()
    assert {tuple(r) for r in counts} == {("a", 2, 1), ("b", 2, 1), ("c", 0, 0)}
    seen = Observation("reasons")
    kept = suppression.suppress_counted(people, listed, names, seen)
    assert {tuple(r) for r in kept.collect()} == {("3", 3), (None, 5), (None, None)}
    assert set(suppression.observed_reasons(seen, names)) == {tuple(r) for r in counts}
    assert seen.get["people"] == 6
    same = suppression.suppress(people, listed.select("NU_CPF"))
    assert {tuple(r) for r in same.collect()} == {tuple(r) for r in kept.collect()}
    plan = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Join") == 1
    nobody = suppression.reason_counts(suppression.mark_listed(people.limit(0), listed), names)
    assert {tuple(r) for r in nobody.collect()} == {(n, 0, 0) for n in names}


def test_a_rule_with_an_unknown_column_is_refused(spark):
    facts, partners = (spark.createDataFrame([], TABLES[t]) for t in ("extrato", "parceiros"))
    rule = replace(touchpoints.LEDGER_RULES[0], where={"nivel_2": ("online",)})
    with pytest.raises(ValueError, match="nivel_2"):
        touchpoints.ledger_hits(facts, partners, CTX, (rule,))


def test_fraud_list_follows_accounts(spark):
    losses = table(spark, "losses", ("Conta Digital", "1"), ("Conta Digital", "404"), ("Outro", "77"), (None, "5"))
    accounts = table(spark, "digital_account_type", (1, 100), (2, 200))
    holders = table(spark, "digital_account_person", (100, 9), (200, 8))
    got = suppression.fraud_list(losses, accounts, holders, CTX).distinct().collect()
    assert {r.NU_CPF for r in got} == {"00000000009", "00000000077", None}


def test_suppress_keeps_unknown_ids_and_survives_hot_lists(spark):
    rows = [("1", 1), ("2", 2), (None, 3), (None, None)]
    people = spark.createDataFrame(rows, "cpf string, chavecliente bigint")
    listed = spark.range(9000).selectExpr("if(id % 3 = 0, '2', concat('x', id)) AS NU_CPF")
    blocked = listed.unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS NU_CPF"))
    blocked = blocked.filter("NU_CPF IS NOT NULL").distinct()
    kept = suppression.suppress(people, blocked)
    assert {tuple(r) for r in kept.collect()} == {("1", 1), (None, 3), (None, None)}
    assert "LeftAnti" in kept._jdf.queryExecution().executedPlan().toString()
    assert suppression.suppress(kept, blocked).count() == 3
