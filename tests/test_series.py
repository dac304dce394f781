"""Daily answers, weeks, months, history and the workspace."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from loyalpulse.context import RunContext
from loyalpulse.operators import history, monthly, weekly
from loyalpulse.sources.schemas import check
from loyalpulse.sources.tables import Workspace, load

CTX = RunContext(as_of=date(2025, 1, 20))


def answers(spark, *rows):
    return spark.createDataFrame(list(rows), "dataref date, Classificacao string")


@pytest.fixture(scope="module")
def new_year(spark):
    """The week of 30 December 2024 and an answer in the same week of January 2024."""
    days = [date(2024, 12, 30), date(2024, 12, 31), date(2025, 1, 1), date(2025, 1, 1), date(2024, 1, 2)]
    kinds = ["PROMOTOR", "DETRATOR", "PROMOTOR", "NEUTRO", "PROMOTOR"]
    return weekly.daily_answers(answers(spark, *zip(days, kinds)))


def spine_rows(daily, ctx):
    weeks = weekly.weekly(weekly.daily_counts(daily), ctx)
    return weekly.spine(weeks).orderBy("id").collect()


def test_iso_weeks_stay_whole_across_new_year(new_year):
    rows = spine_rows(new_year, CTX)
    assert [(r.id, r.monday, r.year, r.isoweek, r.dias, r.respondentes) for r in rows] == [
        (1, date(2024, 1, 1), 2024, 1, 1, 1), (2, date(2024, 12, 30), 2025, 1, 3, 4),
    ]
    assert rows[1].nps == pytest.approx(25.0)
    assert rows[1].respondentes_ajustado == pytest.approx(4 * 7 / 3)
    # January 2024 was sampled at 5 %
    assert (rows[0].frac_sorteados, rows[0].respondentes_ajustado) == (5.0, pytest.approx(1.5 * 7))


def test_calendar_weeks_split_and_tie(new_year):
    rows = spine_rows(new_year, CTX.but(week_key="calendar"))
    assert [(r.monday, r.year, r.isoweek, r.dias) for r in rows] == [
        (date(2024, 1, 1), 2024, 1, 1), (date(2024, 12, 30), 2024, 1, 2), (date(2024, 12, 30), 2025, 1, 1),
    ]


def test_answers_before_the_start_are_left_out(spark):
    rows = answers(spark, (date(2023, 10, 31), "NEUTRO"), (date(2023, 11, 1), "NEUTRO"), (None, "NEUTRO"))
    assert weekly.daily_answers(rows).count() == 1


def test_unclassified_answers_count_only_in_the_total(spark):
    rows = answers(spark, (date(2024, 3, 4), None), (date(2024, 3, 4), "PROMOTOR"))
    row = spine_rows(weekly.daily_answers(rows), CTX)[0]
    assert (row.promotor, row.neutro, row.detrator, row.respondentes, row.nps) == (1, 0, 0, 2, 50.0)


def test_future_weeks_follow_the_last(new_year):
    series = weekly.spine(weekly.weekly(weekly.daily_counts(new_year), CTX))
    rows = weekly.extend(series).orderBy("id").collect()[-4:]
    assert [(r.id, r.monday, r.year, r.isoweek) for r in rows] == [
        (3, date(2025, 1, 6), 2025, 2), (4, date(2025, 1, 13), 2025, 3),
        (5, date(2025, 1, 20), 2025, 4), (6, date(2025, 1, 27), 2025, 5),
    ]
    assert {(r.dias, r.frac_sorteados, r.nps, r.respondentes) for r in rows} == {(7, 7.5, None, None)}
    assert {r.data_atualizacao for r in rows} == {CTX.as_of}


def test_a_hot_series_counts_like_the_others(spark):
    raw = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("brand"),
        F.date_add(F.lit(date(2024, 3, 4)), (F.col("id") % 14).cast("int")).alias("dataref"),
        F.when(F.col("id") % 2 == 0, "PROMOTOR").otherwise("DETRATOR").alias("Classificacao"),
    )
    daily = weekly.daily_answers(raw, ["brand"])
    weeks = weekly.weekly(weekly.daily_counts(daily, ["brand"]), CTX, ["brand"])
    assert weeks.agg(F.sum("respondentes")).first()[0] == 60000
    assert weeks.filter("brand = 'hot'").agg(F.sum("respondentes")).first()[0] == 20000
    assert {r.dias for r in weeks.filter("brand = 'hot'").collect()} == {7}


def week_row(monday, nps, weight, fcst=None, fcst_weight=None, run=CTX.as_of):
    return (run, monday, nps, weight, fcst, fcst_weight)


def weeks_frame(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "data_atualizacao date, monday date, nps double, respondentes_ajustado double,"
        "forecast_value double, respondentes_fcst double",
    )


def test_month_score_mixes_observed_and_forecast_weeks(spark):
    weeks = weeks_frame(
        spark,
        week_row(date(2024, 12, 30), 90.0, 100.0),
        week_row(date(2025, 1, 6), 50.0, 10.0, 99.0, 99.0),
        week_row(date(2025, 1, 13), None, None, 20.0, 30.0),
        week_row(date(2025, 1, 20), None, 5.0, None, None),  # no value: weighs, adds nothing
        week_row(date(2025, 2, 3), None, None, 70.0, 10.0),
    )
    row = monthly.monthly_forecast(weeks).collect()
    assert [(r.mes, r.nps_fcst) for r in row] == [(date(2025, 1, 1), pytest.approx((500 + 600) / 45))]


def test_real_months_end_before_the_run_month(spark):
    daily = weekly.daily_answers(
        answers(spark, (date(2024, 12, 31), "PROMOTOR"), (date(2024, 12, 1), "DETRATOR"),
                (date(2025, 1, 1), "DETRATOR"), (date(2024, 11, 5), "PROMOTOR"))
    )
    real = monthly.monthly_real(weekly.daily_counts(daily), CTX)
    predicted = monthly.monthly_forecast(weeks_frame(spark, week_row(date(2025, 1, 6), 50.0, 10.0)))
    rows = monthly.monthly(real, predicted).orderBy("mes").collect()
    assert [tuple(r) for r in rows] == [
        (CTX.as_of, date(2024, 11, 1), 100.0, None), (CTX.as_of, date(2024, 12, 1), 0.0, None),
        (CTX.as_of, date(2025, 1, 1), None, 50.0),
    ]


def run_of(spark, day, n, nps):
    rows = [(i, date(2024, 1, 1) + timedelta(weeks=i), day, nps) for i in range(1, n + 1)]
    df = spark.createDataFrame(rows, "id bigint, monday date, data_atualizacao date, nps double")
    for name in history.WEEKLY_HISTORY:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None))
    return history.to_history_schema(df, history.WEEKLY_HISTORY)


def test_history_replaces_only_its_own_dates(spark, tmp_path):
    ws = Workspace(spark, str(tmp_path))
    monday, thursday = date(2024, 3, 4), date(2024, 3, 7)
    ws.bootstrap_history(run_of(spark, monday, 5, 1.0), "h")
    ws.replace_dates(run_of(spark, thursday, 6, 2.0), "h")
    again = run_of(spark, thursday, 7, 3.0)
    frame = history.replace_dates(ws.history("h", again), again)
    expected = sorted(map(tuple, frame.collect()), key=repr)
    for _ in range(2):  # a rerun changes nothing
        table = ws.replace_dates(again, "h")
        assert table.schema == again.schema
        assert sorted(map(tuple, table.collect()), key=repr) == expected
    counts = table.groupBy("data_atualizacao").agg(F.count("*"), F.max("nps")).collect()
    assert {tuple(r) for r in counts} == {(monday, 5, 1.0), (thursday, 7, 3.0)}

    shown = history.dashboard(table)
    assert {tuple(r) for r in shown.groupBy("data_atualizacao").agg(F.max("id")).collect()} == {
        (monday, 3), (thursday, 5),
    }
    assert shown.columns == table.columns

    path = ws.export_history(table, "h", thursday)
    assert path.endswith("gold/h_history_2024-03-07") and spark.read.parquet(path).count() == 12
    assert ws.bootstrap_history(again, "h").count() == 7


def test_load_checks_columns(spark, tmp_path):
    path = str(tmp_path / "optout")
    spark.sql("SELECT 1 AS chavecliente, 2 AS CPF").write.parquet(path)
    assert load(spark, "optout", path).count() == 1
    with pytest.raises(ValueError, match="CPF is missing"):
        check(spark.sql("SELECT 1L AS chavecliente"), "optout")
    with pytest.raises(ValueError, match="CPF is string"):
        check(spark.sql("SELECT 1L AS chavecliente, 'x' AS CPF"), "optout")


def test_tables_are_registered_and_replaced_in_the_catalog(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS surveys")
    ws = Workspace(spark, str(tmp_path), database="surveys")
    try:
        ws.materialize(spark.range(3), "numbers")
        ws.materialize(spark.range(5).selectExpr("id", "id * 2 AS twice"), "numbers")
        assert spark.table("surveys.numbers").agg(F.sum("twice")).first()[0] == 20
        ws.bootstrap_history(run_of(spark, date(2024, 3, 4), 5, 1.0), "h")
        ws.replace_dates(run_of(spark, date(2024, 3, 7), 6, 2.0), "h")
        assert spark.table("surveys.h").count() == 11
        assert spark.table("surveys.h").filter("data_atualizacao = DATE '2024-03-07'").count() == 6
    finally:
        spark.sql("DROP DATABASE surveys CASCADE")


def test_snapshots_can_hold_dates_as_text(spark, tmp_path):
    ws = Workspace(spark, str(tmp_path))
    path = ws.snapshot(run_of(spark, date(2024, 3, 4), 1, 1.0), "silver", "s", date(2024, 3, 4), True)
    row = spark.read.parquet(path).first()
    assert (row.monday, row.data_atualizacao, row.id) == ("2024-01-08", "2024-03-04", 1)
