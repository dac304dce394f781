"""Which customers were touched, and by what.

Each fact table is scanned once for all its rules: every row becomes one integer of the
rules its own columns satisfy, every dimension row one integer of the rules *it* allows,
and the bitwise AND of the two after the join is the set of rules hit.  Timestamps and
text columns are gone before the first shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalpulse.context import RunContext
from loyalpulse.functions.blocks import BIT, any_of, merge_blocks, sum_bits
from loyalpulse.functions.dates import in_local_days
from loyalpulse.functions.text import pad_id, quoted
from loyalpulse.rules import (
    CARD_LAG,
    CARD_PURCHASE,
    EXCHANGE_RULES,
    FLAGS,
    LEDGER_RULES,
    NATURAL_PERSON,
    PAYMENT_CONFIRMED,
    PAYMENT_LAG,
    PAYMENT_PARTIES,
    TAX_ID_WIDTH,
    VALID_EXCHANGE,
    TouchpointRule,
)

Sources = Mapping[str, DataFrame]
Rules = Sequence[TouchpointRule]
Bits = Mapping[str, int]


def _in_window(facts: DataFrame, clock: str, rules: Rules, ctx: RunContext) -> str:
    """SQL test for the days any rule looks at, as few ranges as cover them.

    This is what prunes the scan; which rule a row satisfies is worked out once, later.
    """
    lags = sorted({lag for rule in rules for lag in range(rule.newest, rule.oldest + 1)})
    ranges: list[list[int]] = []
    for lag in lags:
        if ranges and lag == ranges[-1][1] + 1:
            ranges[-1][1] = lag
        else:
            ranges.append([lag, lag])
    return any_of(
        in_local_days(facts, clock, ctx.tz, ctx.day(oldest), ctx.day(newest))
        for newest, oldest in ranges
    )


def _fact_tests(facts: DataFrame, clock: str, rules: Rules, ctx: RunContext) -> list[str]:
    """Per rule, the SQL test of the fact's own columns."""
    tests = []
    for rule in rules:
        test = in_local_days(facts, clock, ctx.tz, ctx.day(rule.oldest), ctx.day(rule.newest))
        if rule.checkout_within is not None:
            since = ctx.day(rule.checkout_within)
            test += " AND " + in_local_days(facts, "DataCheckOut", ctx.tz, since)
        for column, values in rule.fact.items():
            test += f" AND {column} IN ({quoted(values)})"
        tests.append(test)
    return tests


def check_columns(rules: Rules, facts: DataFrame, *dimensions: DataFrame) -> None:
    """Refuses a rule that names a column no table has: it would hold for every row."""
    known = {name for dimension in dimensions for name in dimension.columns}
    for rule in rules:
        unknown = {*rule.where, *rule.unless} - known | {*rule.fact} - set(facts.columns)
        if unknown:
            raise ValueError(f"rule {rule.block!r} names unknown columns: {sorted(unknown)}")


def _dimension_tests(dimension: DataFrame, rules: Rules) -> list[str]:
    """Per rule, the SQL test of the columns this dimension has."""
    known = set(dimension.columns)
    tests = []
    for rule in rules:
        wanted = [f"{c} IN ({quoted(v)})" for c, v in rule.where.items() if c in known]
        barred = [f"{c} NOT IN ({quoted(v)})" for c, v in rule.unless.items() if c in known]
        tests.append(" AND ".join(wanted + barred) or "true")
    return tests


def _bits(tests: Sequence[str]) -> str:
    return sum_bits((1 << i, test) for i, test in enumerate(tests))


def _to_blocks(hits: str, rules: Rules, bit: Bits) -> str:
    return sum_bits((bit[rule.block], f"({hits} & {1 << i}) <> 0") for i, rule in enumerate(rules))


def ledger_hits(
    extrato: DataFrame,
    parceiros: DataFrame,
    ctx: RunContext,
    rules: Rules = LEDGER_RULES,
    bit: Bits = BIT,
) -> DataFrame:
    """``(chavecliente, blocks)`` of the points ledger; a customer may repeat."""
    check_columns(rules, extrato, parceiros)
    partner = ["chaveparceiro", "chavefilialparceiro"]
    clock = "DataProcessamentoTransacao"
    fact_tests = _fact_tests(extrato, clock, rules, ctx)
    dim_tests = _dimension_tests(parceiros, rules)
    facts = extrato.filter(
        f"chavecliente IS NOT NULL AND ({_in_window(extrato, clock, rules, ctx)})"
    ).selectExpr("chavecliente", *partner, f"{_bits(fact_tests)} AS fact_bits")
    dims = parceiros.filter(any_of(dim_tests)).selectExpr(
        *partner, f"{_bits(dim_tests)} AS dim_bits"
    )
    return (
        facts.join(dims, partner)
        .filter("fact_bits & dim_bits <> 0")
        .selectExpr("chavecliente", f"{_to_blocks('fact_bits & dim_bits', rules, bit)} AS blocks")
    )


def exchange_hits(
    exchange: DataFrame,
    classe_exchange: DataFrame,
    status_exchange: DataFrame,
    ctx: RunContext,
    rules: Rules = EXCHANGE_RULES,
    bit: Bits = BIT,
) -> DataFrame:
    """``(chavecliente, blocks)`` of points exchanges; a customer may repeat."""
    statuses = status_exchange.withColumn("status_known", F.lit("true"))
    check_columns(rules, exchange, classe_exchange, statuses)
    clock = "DataSolicitacaoexchange"
    fact_tests = _fact_tests(exchange, clock, rules, ctx)
    class_tests = _dimension_tests(classe_exchange, rules)
    facts = exchange.filter(
        f"FlagexchangeValida = '{VALID_EXCHANGE}' AND chavecliente IS NOT NULL "
        f"AND ({_in_window(exchange, clock, rules, ctx)})"
    ).selectExpr(
        "chavecliente",
        "chavetable_exchange",
        "ChaveStatusexchange",
        f"{_bits(fact_tests)} AS fact_bits",
    )
    classes = classe_exchange.filter(any_of(class_tests)).selectExpr(
        "chavetable_exchange", f"{_bits(class_tests)} AS class_bits"
    )
    joined = facts.join(classes, "chavetable_exchange").selectExpr(
        "chavecliente", "ChaveStatusexchange", "fact_bits & class_bits AS hits"
    ).filter("hits <> 0")

    status_columns = {"NomeStatusexchange", "status_known"}
    free_of_status = sum(
        1 << i for i, rule in enumerate(rules) if not status_columns & set(rule.where)
    )
    if free_of_status != (1 << len(rules)) - 1:
        status_bits = _bits(_dimension_tests(statuses, rules))
        statuses = statuses.selectExpr("ChaveStatusexchange", f"{status_bits} AS status_bits")
        joined = joined.join(statuses, "ChaveStatusexchange", "left").selectExpr(
            "chavecliente", f"hits & coalesce(status_bits, {free_of_status}) AS hits"
        ).filter("hits <> 0")
    return joined.selectExpr("chavecliente", f"{_to_blocks('hits', rules, bit)} AS blocks")


def payment_hits(
    transactions: DataFrame,
    ctx: RunContext,
    parties: Sequence[tuple[str, str]] = PAYMENT_PARTIES,
    bit: Bits = BIT,
) -> DataFrame:
    """``(cpf, blocks)`` of confirmed instant payments, both parties from one scan."""
    day = ctx.day(PAYMENT_LAG)
    on_day = in_local_days(transactions, "createTimestamp", ctx.tz, day, day)
    sides = ", ".join(
        f"""struct(lpad({party}TaxId, {TAX_ID_WIDTH}, '0') AS cpf, {bit[block]} AS blocks,
            {party}PersonType = '{NATURAL_PERSON}' AS natural)"""
        for block, party in parties
    )
    return (
        transactions.filter(f"status = '{PAYMENT_CONFIRMED}' AND {on_day}")
        .selectExpr(f"inline(array({sides}))")
        .filter("natural AND cpf IS NOT NULL")
        .select("cpf", "blocks")
    )


def card_hits(
    digital_account: DataFrame,
    docs: DataFrame,
    accounts: DataFrame,
    persons: DataFrame,
    ctx: RunContext,
) -> DataFrame:
    """``(cpf, blocks)`` of card purchases.

    The purchases shrink to distinct accounts, then to distinct holders, before each
    next join; the same shuffle serves the distinct and the join on its key.
    """
    day = ctx.day(CARD_LAG)
    purchases = docs.filter(F.col("natureza_transacao") == CARD_PURCHASE).select(
        F.col("id_doc").alias("ID_DOC")
    )
    return (
        digital_account.filter(
            in_local_days(digital_account, "DT_TRANSACAO_TIMESTAMP", ctx.tz, day, day)
        )
        .select("ID_DOC", "ID_CONTA")
        .join(purchases, "ID_DOC")
        .select("ID_CONTA")
        .distinct()
        .join(accounts.select("ID_CONTA", "ID_PESSOAFISICA"), "ID_CONTA")
        .select("ID_PESSOAFISICA")
        .distinct()
        .join(persons.select("ID_PESSOAFISICA", "NU_CPF"), "ID_PESSOAFISICA")
        .select(pad_id("NU_CPF").alias("cpf"), F.lit(BIT["bondcard"]).alias("blocks"))
        .filter(F.col("cpf").isNotNull())
    )


def customer_ids(customers_a: DataFrame) -> DataFrame:
    """``(chavecliente, cpf)`` with the padded tax id."""
    return customers_a.select("chavecliente", pad_id("NumeroDocumento").alias("cpf"))


def customer_hits(
    sources: Sources,
    ctx: RunContext,
    ledger_rules: Rules = LEDGER_RULES,
    exchange_rules: Rules = EXCHANGE_RULES,
    bit: Bits = BIT,
) -> DataFrame:
    """Ledger and exchange hits, keyed by customer."""
    parts = []
    if ledger_rules:
        parts.append(ledger_hits(sources["extrato"], sources["parceiros"], ctx, ledger_rules, bit))
    if exchange_rules:
        parts.append(
            exchange_hits(
                sources["exchange"],
                sources["classe_exchange"],
                sources["status_exchange"],
                ctx,
                exchange_rules,
                bit,
            )
        )
    return reduce(DataFrame.unionByName, parts)


def account_hits(
    sources: Sources,
    ctx: RunContext,
    parties: Sequence[tuple[str, str]] = PAYMENT_PARTIES,
    card: bool = True,
    bit: Bits = BIT,
) -> DataFrame:
    """Payment and card hits, keyed by padded tax id."""
    parts = []
    if parties:
        parts.append(payment_hits(sources["transactions"], ctx, parties, bit))
    if card:
        parts.append(
            card_hits(
                sources["digital_account"],
                sources["digital_account_docs"],
                sources["digital_account_type"],
                sources["digital_account_person"],
                ctx,
            )
        )
    return reduce(DataFrame.unionByName, parts)


def touchpoint(name: str, sources: Sources, ctx: RunContext) -> DataFrame:
    """One block on its own: distinct customers with the block's constant flags."""
    ledger = [rule for rule in LEDGER_RULES if rule.block == name]
    exchange = [rule for rule in EXCHANGE_RULES if rule.block == name]
    parties = [party for party in PAYMENT_PARTIES if party[0] == name]
    if ledger or exchange:
        customers = customer_hits(sources, ctx, ledger, exchange).select("chavecliente")
    elif parties or name == "bondcard":
        people = account_hits(sources, ctx, parties, card=name == "bondcard")
        customers = (
            people.groupBy("cpf")
            .agg(merge_blocks())
            .join(customer_ids(sources["customers_a"]), "cpf")
            .select("chavecliente")
        )
    else:
        raise KeyError(f"unknown touchpoint {name!r}")
    flags = [F.lit(1).alias(flag) for flag, blocks in FLAGS.items() if name in blocks]
    return customers.distinct().select("chavecliente", *flags)
