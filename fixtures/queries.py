"""The registered queries: every operator run over the whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fixtures.views import REFERENCE_DAY, Domain
from loyalpulse.context import RunContext
from loyalpulse.functions.blocks import RULES, has_any
from loyalpulse.functions.dates import dates_as_text
from loyalpulse.operators import consolidate, contact, credit, history, monthly, sampling
from loyalpulse.operators import suppression, touchpoints, weekly
from loyalpulse.operators.forecast import Models, weekly_forecast
from loyalpulse.plans import eligibility
from loyalpulse.rules import ACCOUNT, CREDIT, CREDIT_RULES, FLAGS, TouchpointRule

Query = Callable[[SparkSession, str], DataFrame]

CTX = RunContext(as_of=REFERENCE_DAY)
SPLIT = CTX.but(flag_mode="split")
# some phones of the benchmark tables are not numbers, which would stop a strict run
LITERAL = RunContext.literal(REFERENCE_DAY).but(strict_casts=False)

# the answers of the benchmark tables run from 1995 to August 2001
SERIES = RunContext(as_of=date(2001, 8, 2), tz="UTC")
OBSERVED = SERIES.but(as_of=date(2001, 7, 31))
EARLIER = SERIES.but(as_of=date(2001, 7, 26))
SINCE, RATE_CHANGE = date(1995, 1, 1), date(1998, 1, 1)
KEYS = ("segment",)
CREDIT_FLAGS = tuple(f for f, blocks in FLAGS.items() if set(blocks) <= set(CREDIT))
POINTS_FLAGS = tuple(f for f in FLAGS if f not in CREDIT_FLAGS)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six decimals, so engines that add in another order agree."""
    return df.select(
        *(F.round(name, 6).alias(name) if kind == "double" else name for name, kind in df.dtypes)
    )


# --- eligibility -----------------------------------------------------------------------


def one_touchpoint(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return touchpoints.touchpoint(name, Domain(spark, sf_dir), CTX)


def one_credit_block(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    return credit.credit_flags(name, d["borrowers"], d["loans"], d["customers_a"], CTX)


def credit_acquired(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    return credit.credit_acquired(d["borrowers"], d["loans"], d["customers_a"], CTX)


def credit_settled_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    return credit.credit_settled_base(d["borrowers"], d["loans"], d["parcelas"], CTX)


def credit_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    return credit.credit_settled(credit_settled_base(spark, sf_dir), d["customers_a"])


def credit_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    hits = credit.credit_hits(d["loans"], d["borrowers"], CTX)
    matched = consolidate.by_tax_id(hits, d["customers_a"])
    alone = consolidate.unmatched_credit(hits, matched)
    rows = consolidate.split_rows(consolidate.per_customer(matched.unionByName(alone)))
    return consolidate.with_flags(rows, CREDIT_FLAGS)


def flags_account_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = consolidate.per_customer(consolidate.without_credit(Domain(spark, sf_dir), CTX))
    rows = consolidate.split_rows(rows.filter(has_any(ACCOUNT)))
    flags = ("contapontos", "acumctadigital", "pix", "cartaobond")
    account = consolidate.with_flags(rows, flags).drop("cpf")
    # the other touchpoints of a customer repeat its account rows
    return account.distinct()


def flags_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = consolidate.without_credit(Domain(spark, sf_dir), CTX)
    rows = consolidate.split_rows(consolidate.per_customer(hits))
    return consolidate.with_flags(rows, POINTS_FLAGS)


def flags_with_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = consolidate.with_credit(Domain(spark, sf_dir), CTX)
    return consolidate.with_flags(consolidate.split_rows(consolidate.per_customer(hits)))


def flags_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidate.eligible(Domain(spark, sf_dir), CTX)


def flags_own_touchpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = TouchpointRule("online_week", 1, 7, {"nivel2": ("online",)})
    return consolidate.eligible(Domain(spark, sf_dir), CTX, RULES.with_rules("online_week", [week]))


def one_per_person(ctx: RunContext, spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidate.eligible(Domain(spark, sf_dir), ctx)


def one_list(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return suppression.suppression_list(name, Domain(spark, sf_dir), CTX)


def sup_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suppression.explode_indicators(Domain(spark, sf_dir)["coplusites"])


def sup_indicator_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suppression.pivot_indicators(Domain(spark, sf_dir)["coplusites"])


def sup_quarantine_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    sends = Domain(spark, sf_dir)["coplusites"]
    return suppression.quarantine_expiry(sends, CTX)


def suppress_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligibility.unrestricted(Domain(spark, sf_dir), CTX)


def suppress_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    people = consolidate.eligible(d, CTX)
    return suppression.reason_counts(
        suppression.mark_listed(people, suppression.listed_ids(d, CTX))
    )


def drawn(survey: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.draw(suppress_all(spark, sf_dir), survey, CTX)


def contact_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = drawn("positivo", spark, sf_dir)
    return contact.contact_credit(people, Domain(spark, sf_dir)["borrowers"], CTX)


def contact_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    people = drawn("pontos", spark, sf_dir)
    return contact.contact_points(people, d["customers_a"], d["contatos"], CTX)


def surveyed(ctx: RunContext, spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = eligibility.surveys(Domain(spark, sf_dir), ctx)
    named = [
        df.withColumn("telefone", F.col("telefone").cast("string")).withColumn(
            "survey", F.lit(survey)
        )
        for survey, df in outputs.items()
    ]
    return named[0].unionByName(named[1])


# --- series ----------------------------------------------------------------------------


def daily_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = Domain(spark, sf_dir)["answers"]
    return weekly.daily_answers(answers, KEYS, since=SINCE, rate_change=RATE_CHANGE)


def daily_answers_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates_as_text(daily_answers(spark, sf_dir))


def series(spark: SparkSession, sf_dir: str, ctx: RunContext = SERIES, keys=KEYS) -> DataFrame:
    counts = weekly.daily_counts(daily_answers(spark, sf_dir), keys)
    return weekly.spine(weekly.weekly(counts, ctx, keys), keys)


def weekly_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(series(spark, sf_dir, SERIES.but(week_key="calendar"), ()))


def weekly_spine_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(series(spark, sf_dir))


def series_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(weekly.extend(series(spark, sf_dir), KEYS))


def forecasted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(weekly_forecast(series(spark, sf_dir), SERIES, KEYS))


def forecasted_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series over calendar weeks, horizons 5-8 on the four labelled weeks."""
    ctx = RunContext.literal(SERIES.as_of, tz="UTC")
    return rounded(weekly_forecast(series(spark, sf_dir, ctx, ()), ctx))


def forecasted_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run with both orders (0, 0), which SQL can compute."""
    means = Models(score=(0, 0), respondents=(0, 0))
    return rounded(weekly_forecast(series(spark, sf_dir), SERIES, KEYS, models=means))


def forecast_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the fitted forecasts of every series, whatever their digits."""
    weeks = weekly_forecast(series(spark, sf_dir), SERIES, KEYS)
    ahead = weeks.filter("nps IS NULL")
    value, volume = "forecast_value", "respondentes_fcst"
    lower, upper = "confidence_interval_lower_bound", "confidence_interval_upper_bound"
    by_week = Window.partitionBy(*KEYS).orderBy("id")
    width = F.col(upper) - F.col(lower)
    widths = ahead.withColumn("narrower", width < F.lag(width).over(by_week) - 1e-9)
    observed = weeks.groupBy(*KEYS).agg(
        F.count("nps").alias("observed_weeks"),
        F.count_if(F.col("nps").isNotNull() & F.col(value).isNotNull()).alias("forecasts_in_the_past"),
        F.avg("nps").alias("_mean"),
        F.stddev_pop("nps").alias("_sd"),
    )
    checked = widths.join(observed, list(KEYS))
    return checked.groupBy(*KEYS).agg(
        F.count("*").alias("forecast_weeks"),
        F.max("observed_weeks").alias("observed_weeks"),
        F.max("forecasts_in_the_past").alias("forecasts_in_the_past"),
        F.every((F.col(lower) <= F.col(value)) & (F.col(value) <= F.col(upper))).alias("inside_bounds"),
        F.every(~F.coalesce("narrower", F.lit(False))).alias("bounds_widen"),
        # a moving average of order 1 knows nothing beyond the first week
        (F.max(F.when(F.col("id") > F.col("observed_weeks") + 1, F.col(volume)))
         - F.min(F.when(F.col("id") > F.col("observed_weeks") + 1, F.col(volume))) < 1e-6)
        .alias("volume_is_flat"),
        F.every(F.abs(F.col(value) - F.col("_mean")) <= 6 * F.col("_sd")).alias("near_the_level"),
        F.every(width <= 2 * 0.6745 * 1.5 * F.col("_sd")).alias("no_wider_than_the_series"),
        F.count_if(F.col("status").isNull() | F.col("respondents_status").isNull()).alias("without_status"),
    )


def with_series_means(spark: SparkSession, sf_dir: str, ctx: RunContext) -> DataFrame:
    """The extended series with its own means standing in for the fitted forecasts."""
    extended = weekly.extend(series(spark, sf_dir, ctx), KEYS)
    own = Window.partitionBy(*KEYS)
    ahead = F.col("nps").isNull()
    return extended.select(
        "*",
        F.when(ahead, F.avg("nps").over(own)).alias("forecast_value"),
        F.when(ahead, F.avg("respondentes_ajustado").over(own)).alias("respondentes_fcst"),
    )


def month_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(monthly.month_weights(with_series_means(spark, sf_dir, SERIES), KEYS))


def monthly_real(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = weekly.daily_counts(daily_answers(spark, sf_dir), KEYS)
    return rounded(monthly.monthly_real(counts, SERIES, KEYS))


def monthly_forecast_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(monthly.monthly_forecast(with_series_means(spark, sf_dir, OBSERVED), KEYS))


def monthly_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = monthly.monthly_forecast(with_series_means(spark, sf_dir, SERIES), KEYS)
    return rounded(monthly.monthly(monthly_real(spark, sf_dir), predicted, KEYS))


def run_history(df: DataFrame, *runs: RunContext) -> DataFrame:
    """Weekly rows as the history of runs on the given dates."""
    dates = F.array(*(F.lit(ctx.as_of) for ctx in runs))
    df = rounded(df).withColumn("data_atualizacao", F.explode(dates))
    for name in history.WEEKLY_HISTORY:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None))
    return history.to_history_schema(df, history.WEEKLY_HISTORY, KEYS)


def history_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_history(weekly.extend(series(spark, sf_dir), KEYS), SERIES)


def history_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = run_history(series(spark, sf_dir), EARLIER, SERIES)
    return history.replace_dates(kept, history_typed(spark, sf_dir))


def history_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.dashboard(history_replace(spark, sf_dir), KEYS)


TOUCHPOINTS = (
    "bonus duplamarca online varejo telecom bancos contapontos trip physicalchannel "
    "digitalchannel money pix_sent pix_received bondcard"
).split()

QUERIES: dict[str, Query] = {
    "daily_answers": daily_answers,
    "daily_answers_text": daily_answers_text,
    "weekly_spine": weekly_spine,
    "weekly_spine_iso": weekly_spine_iso,
    "series_extend": series_extend,
    "weekly_forecast": forecasted,
    "weekly_forecast_literal": forecasted_literal,
    "weekly_forecast_mean": forecasted_means,
    "forecast_properties": forecast_properties,
    "monthly_real": monthly_real,
    "month_weights": month_weights,
    "monthly_forecast_weighted": monthly_forecast_weighted,
    "monthly_full": monthly_full,
    "history_typed": history_typed,
    "history_replace": history_replace,
    "history_dashboard": history_dashboard,
    **{f"tp_{name}": partial(one_touchpoint, name) for name in TOUCHPOINTS},
    "credit_acquired": credit_acquired,
    "credit_settled_base": credit_settled_base,
    "credit_settled": credit_settled,
    **{f"credit_{r.block}": partial(one_credit_block, r.block) for r in CREDIT_RULES},
    "credit_merged": credit_merged,
    "flags_account_split": flags_account_split,
    "flags_split": flags_split,
    "flags_with_credit": flags_with_credit,
    "flags_merge": flags_merge,
    "flags_own_touchpoint": flags_own_touchpoint,
    "one_per_person": partial(one_per_person, SPLIT),
    "one_per_person_literal": partial(one_per_person, LITERAL),
    **{f"sup_{name}": partial(one_list, name) for name in suppression.LISTS},
    "sup_indicators": sup_indicators,
    "sup_indicator_pivot": sup_indicator_pivot,
    "sup_quarantine_expiry": sup_quarantine_expiry,
    "suppress_all": suppress_all,
    "suppress_reasons": suppress_reasons,
    "draw_credit": partial(drawn, "positivo"),
    "draw_points": partial(drawn, "pontos"),
    "contact_credit": contact_credit,
    "contact_points": contact_points,
    "eligibility_end_to_end": partial(surveyed, CTX),
    "eligibility_split_end_to_end": partial(surveyed, SPLIT),
    "eligibility_literal_end_to_end": partial(surveyed, LITERAL),
}
