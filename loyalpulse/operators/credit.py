"""Credit contracts taken up or settled, their origin and their flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyalpulse.context import RunContext
from loyalpulse.functions.blocks import BIT, any_of, merge_blocks, sum_bits
from loyalpulse.functions.dates import in_local_days
from loyalpulse.functions.joins import splittable_join
from loyalpulse.functions.text import first_token, json_scalar, pad_id, tax_id
from loyalpulse.operators.touchpoints import customer_ids
from loyalpulse.rules import (
    CLIENT_TYPES,
    CONTRACT_STATUS,
    CREDIT_LAG,
    CREDIT_RULES,
    FLAGS,
    LOAN_LENT,
    LOAN_SETTLED,
    ORIGIN_RULES,
    OTHER_CLIENT_TYPE,
    OTHER_ORIGIN,
    POINTS_ORIGIN,
    SETTLED_LATE,
    SETTLED_ON_TIME,
    CreditRule,
    OriginRule,
)

STAGE_CLOCK = {LOAN_LENT: "lent_at", LOAN_SETTLED: "settled_at"}


def client_type(flow: str = "flow") -> Column:
    """Client type by loan flow."""
    kinds = F.create_map(*(F.lit(text) for pair in CLIENT_TYPES.items() for text in pair))
    return F.coalesce(F.try_element_at(kinds, F.col(flow)), F.lit(OTHER_CLIENT_TYPE))


def _origin_test(rule: OriginRule) -> Column:
    tests = []
    if rule.flow is not None:
        tests.append(F.col("flow") == rule.flow)
    if rule.partner is not None:
        tests.append(F.col("partner_id") == rule.partner)
    if rule.without_source:
        tests.append(json_scalar("utm_data", "utm_source").isNull())
    if rule.campaign is not None:
        tests.append(json_scalar("utm_data", "utm_campaign") == rule.campaign)
    if rule.source:
        tests.append(json_scalar("utm_data", "utm_source").isin(*rule.source))
    if rule.with_utm:
        tests.append(F.col("utm_data").isNotNull())
    return reduce(lambda a, b: a & b, tests)


def credit_origin(rules: Sequence[OriginRule] = ORIGIN_RULES) -> Column:
    """Origin of a loan row: the first matching rule wins, so their order is the rule."""
    branches = F
    for rule in rules:
        branches = branches.when(_origin_test(rule), rule.origin)
    return branches.otherwise(OTHER_ORIGIN)


def _loans_in(loans: DataFrame, stage: str, ctx: RunContext) -> str:
    day = ctx.day(CREDIT_LAG)
    return f"state = '{stage}' AND " + in_local_days(loans, STAGE_CLOCK[stage], ctx.tz, day, day)


def _profile(loans: DataFrame, borrowers: DataFrame, stage: str, ctx: RunContext) -> DataFrame:
    """Borrower profile next to each loan that reached ``stage`` on the credit day."""
    contracts = loans.filter(_loans_in(loans, stage, ctx)).select(
        F.col("id").alias("contrato"),
        "borrower_id",
        client_type().alias("tipo_de_cliente"),
        credit_origin().alias("origem"),
    )
    people = borrowers.select(
        F.col("id").alias("borrower_id"),
        tax_id("document", ctx.pad_ids).alias("NU_CPF"),
        first_token("name").alias("name"),
        "email",
        F.col("mobile_number").alias("celular"),
        F.date_diff(F.lit(ctx.as_of), F.col("birthdate").cast("date")).alias("dias"),
        F.col("address_city").alias("cidade"),
        F.lit(CONTRACT_STATUS).alias("status_do_contrato"),
        F.col("address_state").alias("uf"),
    )
    return contracts.join(people, "borrower_id").drop("borrower_id")


def _with_customer(people: DataFrame, customers_a: DataFrame) -> DataFrame:
    """Every matching customer of each row, or NULL, as a left join would give.

    An outer join could neither broadcast the day's few contracts nor split a tax id that
    many customers share; the inner join can do both, and the rows it misses are few.

    ``people`` is read three times, so it must end in an exchange (a distinct, an
    aggregate, a repartition), which Spark then fills once.
    """
    # unknown ids match nobody and are spread; dropped as NULL keys they would be missing
    # from some of the three exchanges only
    unknown = F.concat(F.lit("?"), F.xxhash64(*people.columns).cast("string"))
    keyed = people.withColumn("_id", F.coalesce(pad_id("NU_CPF"), unknown))
    customers = customer_ids(customers_a).filter("cpf IS NOT NULL").withColumnRenamed("cpf", "_id")
    matched = keyed.join(customers, "_id")
    # the hash keeps every column in the plan of the known ids: with fewer columns Spark
    # would see another exchange there and compute the people anew
    known = matched.groupBy("_id").agg(F.max(F.xxhash64(*matched.columns)).alias("_row"))
    known = known.filter("_row IS NOT NULL").select("_id")
    unmatched = splittable_join(keyed, known, "_id", "left_anti")
    without = unmatched.withColumn("chavecliente", F.lit(None).cast("bigint"))
    return matched.unionByName(without).drop("_id")


def credit_acquired(
    borrowers: DataFrame, loans: DataFrame, customers_a: DataFrame, ctx: RunContext
) -> DataFrame:
    """Contracts lent on the credit day, one row per contract and matching customer."""
    profile = _profile(loans, borrowers, LOAN_LENT, ctx)
    return _with_customer(profile.repartition(*profile.columns), customers_a).drop("contrato")


def credit_settled_base(
    borrowers: DataFrame, loans: DataFrame, parcelas: DataFrame, ctx: RunContext
) -> DataFrame:
    """Contracts settled on the credit day with their number of late instalments.

    Instalments are cut to those contracts and counted per contract first, so neither a
    long history nor one huge contract reaches the join.
    """
    profile = _profile(loans, borrowers, LOAN_SETTLED, ctx)
    settled = loans.filter(_loans_in(loans, LOAN_SETTLED, ctx)).select(F.col("id").alias("contrato"))
    late = (
        parcelas.filter(F.col("late_at").isNotNull())
        .select(F.col("loan_id").alias("contrato"))
        .join(settled, "contrato", "left_semi")
        .groupBy("contrato")
        .agg(F.count("*").alias("late"))
    )
    counted = profile.join(late, "contrato", "left").withColumn(
        "late", F.coalesce("late", F.lit(0).cast("bigint"))
    )
    return counted.groupBy(profile.columns).agg(F.sum("late").alias("qnt_parcelas_atrasadas"))


def credit_settled(settled_base: DataFrame, customers_a: DataFrame) -> DataFrame:
    """Distinct settled profiles, paid on time or late, with their customer."""
    on_time = F.col("qnt_parcelas_atrasadas") == 0
    profile = settled_base.select(
        "NU_CPF",
        "name",
        "email",
        "celular",
        "dias",
        "cidade",
        F.when(on_time, SETTLED_ON_TIME).otherwise(SETTLED_LATE).alias("forma_quitacao"),
        "uf",
        "tipo_de_cliente",
        "origem",
    ).distinct()
    return _with_customer(profile, customers_a).distinct()


def credit_hits(
    loans: DataFrame,
    borrowers: DataFrame,
    ctx: RunContext,
    rules: Sequence[CreditRule] = CREDIT_RULES,
    bit: Mapping[str, int] = BIT,
) -> DataFrame:
    """``(cpf, blocks)`` of all credit flags from one scan of the loans.

    Loans meet per borrower before the join; a borrower without a tax id keeps NULL.
    """
    stages = sorted({rule.stage for rule in rules})
    recent = loans.filter(any_of(_loans_in(loans, stage, ctx) for stage in stages)).select(
        "borrower_id",
        "state",
        client_type().alias("client_type"),
        (credit_origin() == POINTS_ORIGIN).alias("from_points"),
    )
    tests = []
    for rule in rules:
        test = f"state = '{rule.stage}'"
        if rule.from_points is not None:
            test += f" AND from_points = {rule.from_points}"
        if rule.client_type is not None:
            test += f" AND client_type = '{rule.client_type}'"
        tests.append((bit[rule.block], test))
    per_borrower = (
        recent.selectExpr("borrower_id", f"{sum_bits(tests)} AS blocks")
        .filter("blocks <> 0")
        .groupBy("borrower_id")
        .agg(merge_blocks())
    )
    people = borrowers.select(
        F.col("id").alias("borrower_id"), tax_id("document", ctx.pad_ids).alias("cpf")
    )
    return per_borrower.join(people, "borrower_id").select("cpf", "blocks")


def credit_flags(
    name: str, borrowers: DataFrame, loans: DataFrame, customers_a: DataFrame, ctx: RunContext
) -> DataFrame:
    """One credit block on its own: distinct people and customers with its flags."""
    rules = [rule for rule in CREDIT_RULES if rule.block == name]
    if not rules:
        raise KeyError(f"unknown credit block {name!r}")
    hits = credit_hits(loans, borrowers, ctx, rules).withColumnRenamed("cpf", "NU_CPF")
    # an aggregate's result among the columns: a plain distinct would let the join of the
    # unmatched below it, into a plan of its own that reads the borrowers again
    people = hits.groupBy("NU_CPF").agg(merge_blocks())
    flags = [F.lit(1).alias(flag) for flag, blocks in FLAGS.items() if name in blocks]
    return (
        _with_customer(people, customers_a)
        .distinct()
        .select(F.col("NU_CPF").alias("cpf"), "chavecliente", *flags)
    )
