"""The weekly run: answers to series, forecasts, month scores, history and dashboard."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalpulse.context import RunContext
from loyalpulse.operators.forecast import weekly_forecast
from loyalpulse.operators.history import (
    MONTHLY_HISTORY,
    WEEKLY_HISTORY,
    dashboard,
    to_history_schema,
)
from loyalpulse.operators.monthly import monthly, monthly_forecast, monthly_real
from loyalpulse.operators.weekly import daily_answers, daily_counts, spine, weekly
from loyalpulse.plans.stages import StageLog
from loyalpulse.rules import ANSWERS_SINCE, SAMPLE_RATE_CHANGE
from loyalpulse.sources.tables import Workspace


def run_weekly(
    answers: DataFrame,
    ctx: RunContext,
    workspace: Workspace,
    keys: Sequence[str] = (),
    since: date = ANSWERS_SINCE,
    rate_change: date = SAMPLE_RATE_CHANGE,
    bootstrap: bool = False,
    text_dates: bool = False,
    parallelism: int | None = None,
    recount_from: date | None = None,
) -> StageLog:
    """All stages in order, each written before the next reads it.

    ``bootstrap`` starts the history anew; otherwise the run replaces its own date.
    ``text_dates`` writes the dates of the snapshots as yyyy-mm-dd text; ``parallelism`` is
    the number of tasks that fit the series.

    With ``recount_from`` the answers and their daily counts are stored by day, and only days
    from then on are read and counted again; the first such run counts them all.  Pass the
    earliest day with new, late or withdrawn answers.  The snapshot of the answers then holds
    the days counted again.  ``keys``, ``since`` and ``rate_change`` must be those of the run before.
    """
    keys = list(keys)
    day = ctx.as_of
    log = StageLog()

    whole = recount_from is None or not all(map(workspace.has_dates, ("answers_daily", "answers_by_day")))
    first = since if whole else max(since, recount_from)

    def kept(df: DataFrame, name: str) -> DataFrame:
        if recount_from is None:
            return workspace.materialize(df, name)
        return workspace.replace_from(df, name, "dataref", first)

    with log.timed("answers_daily"):
        daily = kept(daily_answers(answers, keys, since=first, rate_change=rate_change), "answers_daily")
        daily = daily.filter(F.col("dataref") >= F.lit(first))
        workspace.snapshot(daily, "silver", "answers_daily", day, text_dates)

    with log.timed("series_weekly"):
        counts = kept(daily_counts(daily, keys), "answers_by_day")
        series = workspace.materialize(spine(weekly(counts, ctx, keys), keys), "series_weekly")
        workspace.snapshot(series, "silver", "series_weekly", day, text_dates)

    with log.timed("forecast_weekly"):
        weeks = workspace.materialize(weekly_forecast(series, ctx, keys, parallelism=parallelism), "forecast_weekly")
        workspace.snapshot(weeks, "gold", "forecast_weekly", day, text_dates)

    with log.timed("forecast_monthly"):
        months = monthly(monthly_real(counts, ctx, keys), monthly_forecast(weeks, keys), keys)
        months = workspace.materialize(months, "forecast_monthly")
        workspace.snapshot(months, "gold", "forecast_monthly", day, text_dates)

    keep = workspace.bootstrap_history if bootstrap else workspace.replace_dates
    with log.timed("history"):
        weekly_history = keep(to_history_schema(weeks, WEEKLY_HISTORY, keys), "history_weekly")
        monthly_history = keep(to_history_schema(months, MONTHLY_HISTORY, keys), "history_monthly")

    with log.timed("dashboard_weekly"):
        workspace.materialize(dashboard(weekly_history, keys), "dashboard_weekly")

    with log.timed("history_export"):
        workspace.export_history(weekly_history, "forecast_weekly", day)
        workspace.export_history(monthly_history, "forecast_monthly", day)
    return log
