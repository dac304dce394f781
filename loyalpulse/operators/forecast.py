"""Weekly forecasts, one fit per series, all series in parallel."""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loyalpulse.context import RunContext
from loyalpulse.functions.arma import fit_and_forecast
from loyalpulse.operators.weekly import Keys, with_future
from loyalpulse.rules import (
    FORECAST_WEEKS,
    INTERVAL_ALPHA,
    MAX_ITERATIONS,
    RESPONDENTS_ORDER,
    SCORE_ORDER,
)

FORECAST_FIELDS = [
    T.StructField("forecast_value", T.DoubleType()),
    T.StructField("confidence_interval_lower_bound", T.DoubleType()),
    T.StructField("confidence_interval_upper_bound", T.DoubleType()),
    T.StructField("respondentes_fcst", T.DoubleType()),
]
STATUS_FIELDS = [
    T.StructField("status", T.StringType()),
    T.StructField("respondents_status", T.StringType()),
    T.StructField("at_search_edge", T.BooleanType()),
]
UNOBSERVED = "no observation"


@dataclass(frozen=True)
class Models:
    """Orders ``(p, q)`` of the two fits, the bounds' alpha and the limit of their searches.

    Order (0, 0) is the mean of the observed weeks with bounds from their deviation.
    """

    score: tuple[int, int] = SCORE_ORDER
    respondents: tuple[int, int] = RESPONDENTS_ORDER
    alpha: float = INTERVAL_ALPHA
    score_iterations: int = MAX_ITERATIONS
    respondents_iterations: int = MAX_ITERATIONS


MODELS = Models()


def _known(values: list[float | None]) -> list[float | None]:
    return [None if v is None or math.isnan(v) else float(v) for v in values]


def _fits(
    scores: list[float | None], volumes: list[float | None], steps: int, models: Models, offset: int
) -> dict[str, list]:
    """The forecast columns of one series; one never observed gives NULL forecasts."""
    score = fit_and_forecast(
        _known(scores), models.score, steps, models.alpha, offset, models.score_iterations
    )
    volume = fit_and_forecast(
        _known(volumes), models.respondents, steps, models.alpha, offset, models.respondents_iterations
    )
    nothing = [None] * steps
    return {
        "forecast_value": score.mean if score else nothing,
        "confidence_interval_lower_bound": score.lower if score else nothing,
        "confidence_interval_upper_bound": score.upper if score else nothing,
        "respondentes_fcst": volume.mean if volume else nothing,
        "status": [score.status if score else UNOBSERVED] * steps,
        "respondents_status": [volume.status if volume else UNOBSERVED] * steps,
        "at_search_edge": [any(fit is not None and fit.at_edge for fit in (score, volume))] * steps,
    }


def _spread(rows: DataFrame, keys: list[str], parallelism: int | None) -> DataFrame:
    """Weekly rows are few bytes but seconds of work, so the number of tasks is set by hand:
    left alone, adaptive coalescing would put every series into one task."""
    if parallelism is None:
        parallelism = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parallelism, *keys) if keys else rows


def forecast(
    series: DataFrame,
    ctx: RunContext,
    keys: Keys = (),
    steps: int = FORECAST_WEEKS,
    models: Models = MODELS,
    parallelism: int | None = None,
) -> DataFrame:
    """``(keys, step, forecasts, statuses)`` per series."""
    keys = list(keys)
    offset = ctx.horizon_offset
    narrow = _spread(series.select(*keys, "id", "nps", "respondentes_ajustado"), keys, parallelism)
    schema = T.StructType(
        [series.schema[key] for key in keys]
        + [T.StructField("step", T.IntegerType()), *FORECAST_FIELDS, *STATUS_FIELDS]
    )

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        columns = ([*map(float, group[c])] for c in ("nps", "respondentes_ajustado"))
        out = pd.DataFrame({key: [group[key].iloc[0]] * steps for key in keys})
        out["step"] = range(1, steps + 1)
        return out.assign(**_fits(*columns, steps, models, offset))

    return narrow.groupBy(*keys).applyInPandas(one, schema)


def weekly_forecast(
    series: DataFrame,
    ctx: RunContext,
    keys: Keys = (),
    steps: int = FORECAST_WEEKS,
    models: Models = MODELS,
    parallelism: int | None = None,
) -> DataFrame:
    """The series followed by its forecast weeks; only those rows carry forecasts.

    ``status`` and ``respondents_status`` tell how the two were fitted, ``at_search_edge`` whether
    a search ended on its bound.  A NULL is a key like any other.  Each series is extended, fitted and given its forecasts in one pass, so
    what it is computed from is read once.
    """
    keys = list(keys)
    offset = ctx.horizon_offset
    rows = with_future(series, keys, steps, week_key=ctx.week_key)
    fields = [*FORECAST_FIELDS, *STATUS_FIELDS]
    schema = T.StructType([*rows.schema.fields, *fields])
    arrow = {"double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}

    def attach(table: pa.Table) -> pa.Table:
        step = table["step"].to_pylist()
        ids = table["id"].to_pylist()
        given = sorted((i for i, s in enumerate(step) if s == 0), key=lambda i: (ids[i] is not None, ids[i] or 0))
        scores, volumes = (
            [column[i] for i in given]
            for column in (table["nps"].to_pylist(), table["respondentes_ajustado"].to_pylist())
        )
        fitted = _fits(scores, volumes, steps, models, offset)
        for field in fields:
            column = [fitted[field.name][s - 1] if s else None for s in step]
            table = table.append_column(
                field.name, pa.array(column, type=arrow[field.dataType.simpleString()])
            )
        return table

    spread = _spread(rows, keys, parallelism)
    return spread.groupBy(*keys).applyInArrow(attach, schema).drop("step")
