"""Business dates, ids, names and JSON scalars."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from loyalpulse.functions.dates import in_local_days, local_date, week_start
from loyalpulse.functions.text import as_integer, greeting, json_scalar, pad_id, quoted

ZONE = "America/Sao_Paulo"
# around both 2018 clock changes (midnight itself was skipped on 4 November) and in 2024
INSTANTS = [
    datetime(year, month, day, tzinfo=timezone.utc) + timedelta(minutes=17 * k)
    for year, month, day in ((2018, 2, 17), (2018, 11, 3), (2024, 1, 19))
    for k in range(170)
]


@pytest.fixture(scope="module")
def clock(spark):
    rows = [(i, at.replace(tzinfo=None).isoformat(" ")) for i, at in enumerate(INSTANTS)]
    return (
        spark.createDataFrame(rows, "i int, text string")
        .select(
            "i",
            F.col("text").cast("timestamp_ntz").alias("wall"),
            F.to_timestamp(F.concat("text", F.lit("+00:00"))).alias("instant"),
        )
        .cache()
    )


@pytest.mark.parametrize("column", ["wall", "instant"])
def test_local_date_is_the_zones_calendar_date(clock, column):
    got = clock.orderBy("i").select(local_date(clock, column, ZONE)).collect()
    assert [r[0] for r in got] == [at.astimezone(ZoneInfo(ZONE)).date() for at in INSTANTS]


@pytest.mark.parametrize("column", ["wall", "instant"])
@pytest.mark.parametrize("day", [date(2018, 2, 17), date(2018, 11, 4), date(2024, 1, 19)])
def test_raw_range_equals_the_exact_date_test(clock, column, day):
    ranged = clock.filter(in_local_days(clock, column, ZONE, day, day))
    exact = clock.filter(local_date(clock, column, ZONE) == F.lit(day))
    assert {r.i for r in ranged.collect()} == {r.i for r in exact.collect()} != set()


def test_open_range_and_date_columns(spark, clock):
    since = clock.filter(in_local_days(clock, "wall", ZONE, date(2024, 1, 19)))
    assert {r.i for r in since.collect()} == {
        i for i, at in enumerate(INSTANTS)
        if at.astimezone(ZoneInfo(ZONE)).date() >= date(2024, 1, 19)
    }
    days = spark.range(5).select(F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("d"))
    assert days.filter(in_local_days(days, "d", ZONE, date(2024, 1, 2), date(2024, 1, 3))).count() == 2
    with pytest.raises(TypeError):
        in_local_days(spark.range(1), "id", ZONE, date(2024, 1, 1))


def test_week_start_is_the_iso_monday(spark):
    days = [date(2024, 12, 28) + timedelta(days=k) for k in range(14)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for row in df.select("d", week_start(F.col("d")).alias("m")).collect():
        assert row.m == row.d - timedelta(days=row.d.weekday())


def test_ids_names_and_numbers(spark):
    df = spark.createDataFrame(
        [("7", "ana maria", "55"), ("123456789012", " ", "x"), ("", None, None), (None, "B", "")],
        "id string, name string, n string",
    )
    got = df.select(
        pad_id("id"), greeting("name", "YOU"), as_integer("n", strict=False)
    ).collect()
    assert [tuple(r) for r in got] == [
        ("00000000007", "ANA", 55),
        ("12345678901", "YOU", None),
        ("00000000000", "YOU", None),
        (None, "B", None),
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(as_integer("n", strict=True)).collect()


def test_json_scalars(spark):
    texts = {
        '{"a": "x"}': "x", '{"a": 3}': "3", '{"a": null}': None, '{"a": [1]}': None,
        '{"a": {"b": 1}}': None, '{"a": "[x]"}': "[x]", '{"a": "{"}': "{", "broken": None, "{}": None,
    }
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    got = {r[0]: r[1] for r in df.select("t", json_scalar("t", "a")).collect()}
    assert got == {**texts, None: None}


def test_quoted_values_survive_quotes(spark):
    values = ["it's", "plain", 4]
    assert [tuple(r) for r in spark.sql(f"SELECT {quoted(values)}").collect()] == [tuple(values)]
