"""Do-not-contact lists and their removal from the eligible people."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from loyalpulse.context import RunContext
from loyalpulse.functions.dates import in_local_days, local_date
from loyalpulse.functions.joins import splittable_join
from loyalpulse.functions.ranking import top_row
from loyalpulse.functions.text import as_integer, pad_id, tax_id
from loyalpulse.operators.touchpoints import Sources
from loyalpulse.rules import (
    ACCOUNT_LOSS,
    ACTIVE_ACCOUNT,
    BAD_EMAIL_SCORES,
    INDICATOR_CUSTOMER,
    INDICATOR_TAX_ID,
    QUARANTINE_DAYS,
)


def bad_email(contatos: DataFrame, ctx: RunContext) -> DataFrame:
    """Contacts whose e-mail scores badly or has no score."""
    score = F.col("FaixaScoreEmail")
    return contatos.filter(score.isin(*BAD_EMAIL_SCORES) | score.isNull()).select(
        "chavecliente", tax_id("CPF", ctx.pad_ids).alias("NU_CPF")
    )


def inactive(customers_a: DataFrame) -> DataFrame:
    """Customers whose account is not active."""
    status = F.col("DescricaoStatusConta")
    return customers_a.filter((status != ACTIVE_ACCOUNT) | status.isNull()).select(
        "chavecliente", pad_id("NumeroDocumento").alias("NU_CPF")
    )


def optout(optouts: DataFrame) -> DataFrame:
    """Customers who asked not to be contacted."""
    return optouts.select("chavecliente", pad_id("CPF").alias("NU_CPF"))


def privacy_excluded(borrowers: DataFrame, ctx: RunContext) -> DataFrame:
    """Borrowers excluded under the privacy law."""
    return borrowers.filter(F.col("lgpd_excluded_data")).select(
        tax_id("document", ctx.pad_ids).alias("NU_CPF")
    )


def fraud_list(
    losses: DataFrame, accounts: DataFrame, persons: DataFrame, ctx: RunContext
) -> DataFrame:
    """Tax ids behind a loss: given directly, or through the holder of the account.

    Only accounts that had a loss are looked up.  A loss that leads to no tax id
    contributes NULL, which never matches anyone.
    """
    kind = F.col("Tipo_Perda")
    direct = losses.filter((kind != ACCOUNT_LOSS) | kind.isNull()).select(
        F.when(kind.isNotNull(), tax_id("Cod_Cliente", ctx.pad_ids)).alias("NU_CPF")
    )
    lost_accounts = (
        losses.filter(kind == ACCOUNT_LOSS).select(F.col("Cod_Cliente").alias("_account")).distinct()
    )
    holders = (
        accounts.select(F.col("ID_CONTA").cast("string").alias("_account"), "ID_PESSOAFISICA")
        .join(lost_accounts, "_account", "left_semi")
        .join(persons.select("ID_PESSOAFISICA", "NU_CPF"), "ID_PESSOAFISICA")
        .select("_account", pad_id("NU_CPF").alias("NU_CPF"))
        .distinct()
    )
    through_account = lost_accounts.join(holders, "_account", "left").select("NU_CPF")
    return direct.unionByName(through_account)


def employees(funcionarios: DataFrame) -> DataFrame:
    """Staff with a known tax id."""
    return funcionarios.filter(F.col("CPF").isNotNull()).select(pad_id("CPF").alias("NU_CPF"))


def explode_indicators(sends: DataFrame) -> DataFrame:
    """One row per indicator of each survey sent; empty lists vanish."""
    return sends.select("_id", F.inline("indicators"))


def _indicator(name: str) -> Column:
    """Largest value of an indicator inside one send."""
    wanted = F.filter("indicators", lambda pair: pair["column"] == name)
    return F.array_max(F.transform(wanted, lambda pair: pair["value"]))


def pivot_indicators(sends: DataFrame) -> DataFrame:
    """``(_id, chavecliente, NU_CPF)``; each send is reduced in place before the shuffle."""
    return (
        sends.filter(F.size("indicators") > 0)
        .select(
            "_id",
            _indicator(INDICATOR_CUSTOMER).alias("chavecliente"),
            _indicator(INDICATOR_TAX_ID).alias("NU_CPF"),
        )
        .groupBy("_id")
        .agg(F.max("chavecliente").alias("chavecliente"), F.max("NU_CPF").alias("NU_CPF"))
    )


def _expiry(sends: DataFrame, ctx: RunContext) -> Column:
    """Date a send stops blocking its customer: sooner if it went unanswered."""
    sent_on = local_date(sends, "createdAt", ctx.tz)
    expiry = F
    for answered, days in QUARANTINE_DAYS.items():
        expiry = expiry.when(F.col("answered") == F.lit(answered), F.date_add(sent_on, days))
    return expiry.alias("QuarantineExpiryDate")


def quarantine_expiry(sends: DataFrame, ctx: RunContext) -> DataFrame:
    """Each send with its customer and the date its quarantine ends."""
    dated = sends.select("_id", "createdAt", _expiry(sends, ctx))
    pivot = pivot_indicators(sends).filter(F.col("chavecliente").isNotNull())
    return splittable_join(dated, pivot, "_id").select(
        "createdAt",
        as_integer("chavecliente", ctx.strict_casts).alias("chavecliente"),
        "NU_CPF",
        "QuarantineExpiryDate",
    )


def active_quarantine(sends: DataFrame, ctx: RunContext, unique_ids: bool = False) -> DataFrame:
    """Customers whose latest expiry has not passed on the run date.

    The rows of one send share its indicators, so only their latest expiry matters and
    each send is one aggregate row; no join back is needed.  With ``unique_ids`` (one row
    per ``_id``) even that is skipped and sends older than the longest quarantine are
    pruned at the scan.  Equal expiries are told apart by the larger tax id.
    """
    if unique_ids:
        longest = max(QUARANTINE_DAYS.values())
        sends = sends.filter(in_local_days(sends, "createdAt", ctx.tz, ctx.day(longest)))
    per_send = sends.select(
        "_id",
        _indicator(INDICATOR_CUSTOMER).alias("_customer"),
        _indicator(INDICATOR_TAX_ID).alias("NU_CPF"),
        _expiry(sends, ctx),
    )
    if not unique_ids:
        latest_values = (F.max(c).alias(c) for c in per_send.columns if c != "_id")
        per_send = per_send.groupBy("_id").agg(*latest_values)
    running = per_send.filter(
        F.col("_customer").isNotNull() & (F.col("QuarantineExpiryDate") >= F.lit(ctx.as_of))
    )
    customer = as_integer("_customer", ctx.strict_casts)
    # an unreadable customer key stays its own customer
    unreadable = F.when(F.col("chavecliente").isNull(), F.col("_customer"))
    latest = top_row(
        running.withColumn("chavecliente", customer).withColumn("_unreadable", unreadable),
        ["chavecliente", "_unreadable"],
        (F.col("QuarantineExpiryDate").desc(), F.col("NU_CPF").desc_nulls_last()),
    )
    return latest.select(
        "chavecliente", tax_id("NU_CPF", ctx.pad_ids).alias("NU_CPF"), "QuarantineExpiryDate"
    )


def recent_quarantine(sends: DataFrame, ctx: RunContext) -> DataFrame:
    """``active_quarantine`` without aggregating every send ever made.

    Only sends with a row inside the longest quarantine can still block anyone, so those
    rows are read by a pruned scan.  Older rows matter only where they repeat the id of
    such a send; a semi join on its ids finds them, and all others stay out of the shuffle.
    """
    within = in_local_days(sends, "createdAt", ctx.tz, ctx.day(max(QUARANTINE_DAYS.values())))
    recent = sends.filter(within)
    ids = recent.select(F.col("_id").alias("_recent")).distinct()
    older = sends.filter(f"({within}) IS NOT TRUE")
    repeats = older.join(ids, F.col("_id").eqNullSafe(F.col("_recent")), "left_semi")
    return active_quarantine(recent.unionByName(repeats), ctx)


LISTS: dict[str, Callable[[Sources, RunContext], DataFrame]] = {
    "bad_email": lambda s, ctx: bad_email(s["contatos"], ctx),
    "inactive": lambda s, ctx: inactive(s["customers_a"]),
    "optout": lambda s, ctx: optout(s["optout"]),
    "privacy": lambda s, ctx: privacy_excluded(s["borrowers"], ctx),
    "fraud": lambda s, ctx: fraud_list(
        s["losses"], s["digital_account_type"], s["digital_account_person"], ctx
    ),
    "quarantine": lambda s, ctx: recent_quarantine(s["coplusites"], ctx),
    "employees": lambda s, ctx: employees(s["funcionarios"]),
}


def suppression_list(name: str, sources: Sources, ctx: RunContext) -> DataFrame:
    """One list; all but the staff list hold each entry once."""
    entries = LISTS[name](sources, ctx)
    return entries if name == "employees" else entries.distinct()


def blocked_ids(sources: Sources, ctx: RunContext, names: Iterable[str] = tuple(LISTS)) -> DataFrame:
    """Distinct tax ids on any list."""
    lists = (LISTS[name](sources, ctx).select("NU_CPF") for name in names)
    return reduce(DataFrame.unionByName, lists).filter(F.col("NU_CPF").isNotNull()).distinct()


def listed_ids(
    sources: Sources, ctx: RunContext, names: Sequence[str] = tuple(LISTS)
) -> DataFrame:
    """``(NU_CPF, lists)``: every tax id on any list, with one bit per list it is on.

    The bits follow ``names``.  They meet map-side, so the row count of the shuffle is
    that of ``blocked_ids``, and the lists still share one join with the people.
    """
    tagged = (
        LISTS[name](sources, ctx).select("NU_CPF", F.lit(1 << place).alias("lists"))
        for place, name in enumerate(names)
    )
    known = reduce(DataFrame.unionByName, tagged).filter(F.col("NU_CPF").isNotNull())
    return known.groupBy("NU_CPF").agg(F.bit_or("lists").alias("lists"))


def mark_listed(people: DataFrame, listed: DataFrame) -> DataFrame:
    """People with the ``lists`` they are on as bits, 0 for none.

    An unknown tax id is on no list; people without one are spread by customer, as in
    ``suppress``.
    """
    on_list = (F.col("_key") == F.col("NU_CPF")) & F.col("cpf").isNotNull()
    return (
        people.withColumn("_key", _spread_key())
        .join(listed, on_list, "left")
        .withColumn("lists", F.coalesce("lists", F.lit(0)))
        .drop("_key", "NU_CPF")
    )


def _reason_metrics(names: Sequence[str]) -> list[Column]:
    """Per list the people it blocks, and those that no other list blocks."""
    blocked = [F.count_if(F.col("lists").bitwiseAND(1 << i) != 0) for i in range(len(names))]
    alone = [F.count_if(F.col("lists") == 1 << i) for i in range(len(names))]
    return [c.alias(n) for n, c in zip(names, blocked)] + [
        c.alias(f"{n} alone") for n, c in zip(names, alone)
    ]


def reason_counts(marked: DataFrame, names: Sequence[str] = tuple(LISTS)) -> DataFrame:
    """``(list, blocked, blocked_alone)`` of marked people, one row per list."""
    rows = ", ".join(f"'{n}', `{n}`, `{n} alone`" for n in names)
    stacked = f"stack({len(names)}, {rows}) AS (list, blocked, blocked_alone)"
    return marked.agg(*_reason_metrics(names)).selectExpr(stacked)


def suppress_counted(
    people: DataFrame,
    listed: DataFrame,
    names: Sequence[str] = tuple(LISTS),
    observation: Observation | None = None,
) -> DataFrame:
    """``suppress``, with the counts of ``reason_counts`` observed as the rows pass.

    After an action on the result ``observed_reasons(observation)`` has the counts; they
    cost no second pass.
    """
    marked = mark_listed(people, listed)
    if observation is not None:
        marked = marked.observe(observation, F.count("*").alias("people"), *_reason_metrics(names))
    return marked.filter("lists = 0").drop("lists")


def observed_reasons(
    observation: Observation, names: Sequence[str] = tuple(LISTS)
) -> list[tuple[str, int, int]]:
    """``(list, blocked, blocked_alone)`` of an observed suppression that has run."""
    seen = observation.get
    return [(n, seen[n], seen[f"{n} alone"]) for n in names]


def _spread_key() -> Column:
    """The tax id, or a key of their own for people without one."""
    return F.coalesce("cpf", F.concat(F.lit("?"), F.col("chavecliente").cast("string")))


def suppress(people: DataFrame, blocked: DataFrame) -> DataFrame:
    """Keep people on none of the lists; an unknown tax id is on no list.

    The distinct ids come out partitioned by the join key, so seven lists cost one
    shuffle and one anti join.  People without a tax id, who may be many, are spread by
    customer instead of meeting in one task.
    """
    listed = (F.col("_key") == F.col("NU_CPF")) & F.col("cpf").isNotNull()
    return people.withColumn("_key", _spread_key()).join(blocked, listed, "left_anti").drop("_key")
