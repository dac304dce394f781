"""Dated history and the dashboard view of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loyalpulse.operators.weekly import Keys
from loyalpulse.rules import DASHBOARD_HIDDEN_WEEKS

RUN_DATE = "data_atualizacao"

WEEKLY_HISTORY = {
    "id": "bigint",
    "monday": "date",
    "year": "int",
    "isoweek": "int",
    "dias": "int",
    "data_atualizacao": "date",
    "promotor": "bigint",
    "neutro": "bigint",
    "detrator": "bigint",
    "respondentes": "bigint",
    "frac_sorteados": "double",
    "respondentes_ajustado": "double",
    "nps": "double",
    "forecast_value": "double",
    "confidence_interval_lower_bound": "double",
    "confidence_interval_upper_bound": "double",
    "respondentes_fcst": "double",
}
MONTHLY_HISTORY = {
    "data_atualizacao": "date",
    "mes": "date",
    "nps_real": "double",
    "nps_fcst": "double",
}


def to_history_schema(df: DataFrame, columns: dict[str, str], keys: Keys = ()) -> DataFrame:
    """Columns in history order and type."""
    return df.select(*keys, *(F.col(name).cast(kind).alias(name) for name, kind in columns.items()))


def replace_dates(history: DataFrame, run: DataFrame) -> DataFrame:
    """History with the run's dates replaced by the run; all other dates untouched.

    The frame form of ``Workspace.replace_dates``, for stores without partitions.
    """
    dates = run.select(RUN_DATE).distinct()
    kept = history.join(dates, RUN_DATE, "left_anti").select(history.columns)
    return kept.unionByName(run)


def dashboard(
    history: DataFrame, keys: Keys = (), drop_last: int = DASHBOARD_HIDDEN_WEEKS
) -> DataFrame:
    """Each run of each series without its ``drop_last`` furthest weeks."""
    furthest = Window.partitionBy(RUN_DATE, *keys).orderBy(F.col("id").desc())
    return (
        history.withColumn("_rank", F.row_number().over(furthest))
        .filter(F.col("_rank") > drop_last)
        .drop("_rank")
    )
