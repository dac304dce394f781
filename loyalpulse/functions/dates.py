"""Business dates of UTC instants, week and month keys."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def _start_of_day(day: date, tz: str, dtype: T.DataType) -> str:
    """Literal of ``dtype`` for the first instant of a local day.

    Matching the column's own type keeps the comparison cast-free, so it reaches the
    parquet scan.
    """
    if isinstance(dtype, T.DateType):
        return f"DATE '{day}'"
    instant = datetime.combine(day, time(), ZoneInfo(tz)).astimezone(timezone.utc)
    if isinstance(dtype, T.TimestampNTZType):
        return f"TIMESTAMP_NTZ '{instant:%Y-%m-%d %H:%M:%S}'"
    if isinstance(dtype, T.TimestampType):
        return f"timestamp_seconds({(instant - EPOCH) // timedelta(seconds=1)})"
    raise TypeError(f"not a date or timestamp column: {dtype.simpleString()}")


def in_local_days(
    df: DataFrame, name: str, tz: str, first: date, last: date | None = None
) -> str:
    """SQL test that the local date of ``name`` is in ``first``..``last`` (open if None)."""
    dtype = _column_type(df, name)
    inside = f"{name} >= {_start_of_day(first, tz, dtype)}"
    if last is not None:
        inside += f" AND {name} < {_start_of_day(last + timedelta(days=1), tz, dtype)}"
    return inside


def local_date(df: DataFrame, name: str, tz: str) -> Column:
    """Calendar date of a UTC instant as seen in ``tz``."""
    dtype = _column_type(df, name)
    if isinstance(dtype, T.DateType):
        return F.col(name)
    source = F.lit("UTC") if isinstance(dtype, T.TimestampNTZType) else F.current_timezone()
    wall = F.col(name).cast("timestamp_ntz")
    return F.to_date(F.convert_timezone(source, F.lit(tz), wall))


def week_start(day: Column) -> Column:
    """Monday of the ISO week."""
    return F.to_date(F.date_trunc("week", day))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def dates_as_text(df: DataFrame) -> DataFrame:
    """Every date column as yyyy-mm-dd text."""
    return df.select(
        *(
            F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
            if isinstance(f.dataType, T.DateType)
            else f.name
            for f in df.schema
        )
    )


def brazilian(day: date) -> str:
    """dd/mm/yyyy text of a run date."""
    return day.strftime("%d/%m/%Y")
