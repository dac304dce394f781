"""Month scores: observed months, and the run month from observed and forecast weeks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalpulse.context import RunContext
from loyalpulse.functions.joins import null_safe_join
from loyalpulse.functions.dates import month_start
from loyalpulse.operators.weekly import Keys, score


def monthly_real(counts: DataFrame, ctx: RunContext, keys: Keys = ()) -> DataFrame:
    """Observed score of every month before the run month, from the daily counts."""
    return (
        counts.filter(F.col("dataref") < F.lit(ctx.as_of.replace(day=1)))
        .groupBy(*keys, month_start(F.col("dataref")).alias("mes"))
        .agg(score(F.sum("promotor"), F.sum("detrator"), F.sum("respondentes")).alias("nps_real"))
        .select(*keys, F.lit(ctx.as_of).alias("data_atualizacao"), "mes", "nps_real")
    )


def month_weights(weeks: DataFrame, keys: Keys = ()) -> DataFrame:
    """Each week in the month of its Monday, observed where possible, else forecast."""
    value = F.coalesce("nps", "forecast_value")
    weight = F.coalesce("respondentes_ajustado", "respondentes_fcst")
    return weeks.select(
        *keys,
        "data_atualizacao",
        month_start(F.col("monday")).alias("mes"),
        "nps",
        "respondentes_ajustado",
        "forecast_value",
        "respondentes_fcst",
        value.alias("nps_mes"),
        weight.alias("respondentes_mes"),
        (value * weight).alias("npsXresp_mes"),
    )


def monthly_forecast(weeks: DataFrame, keys: Keys = ()) -> DataFrame:
    """Respondent-weighted score of the month of each run date."""
    return (
        month_weights(weeks, keys)
        .filter(F.col("mes") == month_start(F.col("data_atualizacao")))
        .groupBy(*keys, "data_atualizacao", "mes")
        .agg((F.sum("npsXresp_mes") / F.sum("respondentes_mes")).alias("nps_fcst"))
    )


def monthly(real: DataFrame, predicted: DataFrame, keys: Keys = ()) -> DataFrame:
    """Observed and forecast months side by side."""
    on = [*keys, "data_atualizacao", "mes"]
    return null_safe_join(real, predicted, on, "full").select(*on, "nps_real", "nps_fcst")
