"""Survey answers to weekly series.

``keys`` name the columns that tell series apart (brand, region, segment ...); without
keys there is one series.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loyalpulse.context import RunContext
from loyalpulse.functions.dates import week_start
from loyalpulse.rules import (
    ANSWERS_SINCE,
    DETRACTOR,
    FORECAST_WEEKS,
    NEUTRAL,
    PROMOTER,
    SAMPLE_RATE_AFTER,
    SAMPLE_RATE_BEFORE,
    SAMPLE_RATE_CHANGE,
    WEEK_DAYS,
)

Keys = Sequence[str]


def daily_answers(
    answers: DataFrame,
    keys: Keys = (),
    since: date = ANSWERS_SINCE,
    rate_change: date = SAMPLE_RATE_CHANGE,
    rate_before: float = SAMPLE_RATE_BEFORE,
    rate_after: float = SAMPLE_RATE_AFTER,
) -> DataFrame:
    """Answers since a date with their week and the sampling rate of their day."""
    day = F.col("dataref")
    return answers.filter(day >= F.lit(since)).select(
        *keys,
        "dataref",
        week_start(day).alias("monday"),
        F.year(day).alias("year"),
        F.weekofyear(day).alias("isoweek"),
        "Classificacao",
        F.when(day < F.lit(rate_change), rate_before).otherwise(rate_after).alias("frac_sorteados"),
    )


def _answers_of(kind: str):
    return F.count_if(F.col("Classificacao") == kind)


def daily_counts(daily: DataFrame, keys: Keys = ()) -> DataFrame:
    """Answers per series and day.

    The one pass over the answers: weeks and months both roll up from these few rows,
    which Spark counts map-side, so a series with most of the answers costs no more.
    """
    return daily.groupBy(*keys, "dataref").agg(
        _answers_of(PROMOTER).alias("promotor"),
        _answers_of(NEUTRAL).alias("neutro"),
        _answers_of(DETRACTOR).alias("detrator"),
        F.count("*").alias("respondentes"),
        F.sum("frac_sorteados").alias("frac_total"),
        F.count("frac_sorteados").alias("frac_days"),
    )


def score(promoters, detractors, answers):
    """Net score in points: share of promoters minus share of detractors."""
    return (promoters - detractors) / answers * 100


def weekly(counts: DataFrame, ctx: RunContext, keys: Keys = ()) -> DataFrame:
    """Counts, mean sampling rate and score per series and week."""
    day = F.col("dataref")
    week_columns = [week_start(day).alias("monday")]
    if ctx.week_key == "calendar":
        week_columns += [F.year(day).alias("year"), F.weekofyear(day).alias("isoweek")]
    weeks = counts.groupBy(*keys, *week_columns).agg(
        F.count("*").cast("int").alias("dias"),
        *(F.sum(c).alias(c) for c in ("promotor", "neutro", "detrator", "respondentes")),
        (F.sum("frac_total") / F.sum("frac_days")).alias("frac_sorteados"),
    )
    if ctx.week_key == "iso":
        weeks = weeks.withColumn("year", F.extract(F.lit("YEAROFWEEK"), F.col("monday")))
        weeks = weeks.withColumn("isoweek", F.weekofyear("monday"))
    return weeks.select(
        *keys,
        "monday",
        "year",
        "isoweek",
        "dias",
        "promotor",
        "neutro",
        "detrator",
        "respondentes",
        "frac_sorteados",
        score(F.col("promotor"), F.col("detrator"), F.col("respondentes")).alias("nps"),
        F.lit(ctx.as_of).alias("data_atualizacao"),
    )


def spine(weeks: DataFrame, keys: Keys = (), full_rate: float = SAMPLE_RATE_AFTER) -> DataFrame:
    """Numbered weeks, with respondents scaled to a full week at the full rate.

    A series holds one row per calendar week, so the numbering window stays small
    however many answers there were.
    """
    order = Window.partitionBy(*keys).orderBy("year", "isoweek", "monday")
    scaled = F.col("respondentes") * full_rate / F.col("frac_sorteados") * WEEK_DAYS / F.col("dias")
    columns = [c for c in weeks.columns if c not in keys]
    return weeks.select(
        *keys,
        F.row_number().over(order).cast("bigint").alias("id"),
        *columns,
        scaled.alias("respondentes_ajustado"),
    )


def with_future(
    series: DataFrame,
    keys: Keys = (),
    steps: int = FORECAST_WEEKS,
    full_rate: float = SAMPLE_RATE_AFTER,
    week_key: str = "iso",
) -> DataFrame:
    """The series and the ``steps`` unobserved weeks after the last one, told apart by ``step``.

    ``step`` is 0 for the weeks given and counts the weeks after them.  The last row of a
    series generates them, so the series is read once; its window is the one that numbers
    the weeks.  ``week_key`` is the context's: it says which year a week across New Year
    belongs to.
    """
    later = F.lead("id").over(Window.partitionBy(*keys).orderBy("id"))
    is_last = F.col("id").isNotNull() & later.isNull()
    generated = F.when(is_last, F.sequence(F.lit(0), F.lit(steps))).otherwise(F.array(F.lit(0)))
    rows = series.withColumn("_steps", generated)
    rows = rows.select("*", F.explode("_steps").alias("step")).drop("_steps")
    monday = F.date_add("monday", F.col("step") * WEEK_DAYS)
    unobserved = {
        "id": F.col("id") + F.col("step"),
        "monday": monday,
        "year": F.year(monday) if week_key == "calendar" else F.extract(F.lit("YEAROFWEEK"), monday),
        "isoweek": F.weekofyear(monday),
        "dias": F.lit(WEEK_DAYS),
        "frac_sorteados": F.lit(full_rate),
        "data_atualizacao": F.col("data_atualizacao"),
    }
    columns = [
        F.when(F.col("step") == 0, F.col(f.name))
        .otherwise(unobserved.get(f.name, F.lit(None)).cast(f.dataType))
        .alias(f.name)
        for f in series.schema
        if f.name not in keys
    ]
    return rows.select(*keys, *columns, "step")


def future_weeks(
    series: DataFrame,
    keys: Keys = (),
    steps: int = FORECAST_WEEKS,
    full_rate: float = SAMPLE_RATE_AFTER,
    week_key: str = "iso",
) -> DataFrame:
    """The ``steps`` weeks after the last one of each series, unobserved, plus ``step``."""
    return with_future(series, keys, steps, full_rate, week_key).filter("step > 0")


def extend(
    series: DataFrame, keys: Keys = (), steps: int = FORECAST_WEEKS, week_key: str = "iso"
) -> DataFrame:
    """The series followed by its unobserved weeks."""
    return with_future(series, keys, steps, week_key=week_key).select(series.columns)
