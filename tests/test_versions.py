"""Tables that are replaced while they are read."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from loyalpulse.context import RunContext
from loyalpulse.operators.weekly import daily_answers, daily_counts
from loyalpulse.plans.forecasting import run_weekly
from loyalpulse.sources.tables import Workspace
from loyalpulse.sources.versions import DATES, VersionedFolder

FIRST, SECOND, THIRD = date(2024, 3, 4), date(2024, 3, 7), date(2024, 3, 11)


def day(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, data_atualizacao date, nps double")


def content(df):
    return {(r.id, r.data_atualizacao, r.nps) for r in df.collect()}


def failing(df):
    return df.withColumn("nps", F.expr("if(id >= 0, CAST(raise_error('stopped') AS DOUBLE), nps)"))


def test_a_reader_keeps_what_it_began_with(spark, tmp_path):
    ws = Workspace(spark, str(tmp_path))
    ws.materialize(spark.range(3), "numbers")
    before = ws.table("numbers")
    ws.materialize(spark.range(5), "numbers")
    assert before.count() == 3 and ws.table("numbers").count() == 5


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    ws = Workspace(spark, str(tmp_path))
    rows = day(spark, (1, FIRST, 1.0))
    ws.materialize(rows, "t")
    ws.bootstrap_history(rows, "h")
    for write in (ws.materialize, ws.replace_dates, ws.bootstrap_history):
        name = "t" if write == ws.materialize else "h"
        with pytest.raises(Exception, match="stopped"):
            write(failing(rows), name)
        assert content(ws.table(name)) == {(1, FIRST, 1.0)}


def test_a_table_can_be_replaced_from_itself(spark, tmp_path):
    ws = Workspace(spark, str(tmp_path))
    ws.materialize(spark.range(4), "numbers")
    ws.materialize(ws.table("numbers").filter("id > 1"), "numbers")
    assert ws.table("numbers").count() == 2
    ws.bootstrap_history(day(spark, (1, FIRST, 1.0), (2, SECOND, 2.0)), "h")
    ws.bootstrap_history(ws.history("h", day(spark)).filter("id = 2"), "h")
    assert content(ws.table("h")) == {(2, SECOND, 2.0)}


def test_each_date_comes_from_its_newest_version(spark, tmp_path):
    ws = Workspace(spark, str(tmp_path))
    ws.bootstrap_history(day(spark, (1, FIRST, 1.0), (1, SECOND, 2.0)), "h")
    ws.replace_dates(day(spark, (2, SECOND, 3.0), (2, THIRD, 4.0)), "h")
    old = ws.table("h")
    ws.replace_dates(day(spark, (3, THIRD, 5.0)), "h")
    assert content(old) == {(1, FIRST, 1.0), (2, SECOND, 3.0), (2, THIRD, 4.0)}
    assert content(ws.table("h")) == {(1, FIRST, 1.0), (2, SECOND, 3.0), (3, THIRD, 5.0)}
    assert content(ws.replace_dates(day(spark), "h")) == content(ws.table("h"))
    assert ws.bootstrap_history(day(spark), "h").count() == 0


def test_only_dates_written_are_written(spark, tmp_path):
    ws = Workspace(spark, str(tmp_path))
    ws.bootstrap_history(day(spark, *((i, date(2024, 1, i), 1.0) for i in range(1, 20))), "h")
    ws.replace_dates(day(spark, (1, THIRD, 1.0)), "h")
    folder = VersionedFolder(spark, f"{tmp_path}/tables/h")
    newest = folder.committed()[-1]
    assert f"-{DATES}-" in newest
    assert [k for k, v in folder.partitions().items() if v == newest] == ["data_atualizacao=2024-03-11"]


def test_versions_no_reader_needs_are_deleted(spark, tmp_path):
    ws = Workspace(spark, str(tmp_path))
    folder = VersionedFolder(spark, f"{tmp_path}/tables/t")
    for n in range(4):
        ws.materialize(spark.range(n), "t")
    assert len(folder.committed()) == 2 and ws.table("t").count() == 3
    with pytest.raises(FileNotFoundError):
        ws.table("never_written")
    history = VersionedFolder(spark, f"{tmp_path}/tables/h")
    ws.bootstrap_history(day(spark, (1, FIRST, 1.0)), "h")
    for n in range(4):
        ws.replace_dates(day(spark, (n, SECOND, 1.0)), "h")
    assert len(history.committed()) == 3
    assert content(ws.table("h")) == {(1, FIRST, 1.0), (3, SECOND, 1.0)}


def test_the_catalog_follows_without_a_drop(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS versions")
    ws = Workspace(spark, str(tmp_path), database="versions")
    try:
        ws.bootstrap_history(day(spark, (1, FIRST, 1.0), (1, SECOND, 2.0)), "h")
        ws.replace_dates(day(spark, (2, SECOND, 3.0), (2, THIRD, 4.0)), "h")
        assert content(spark.table("versions.h")) == content(ws.table("h"))
        wider = day(spark, (3, THIRD, 5.0)).withColumn("extra", F.lit("x"))
        ws.replace_dates(wider, "h")
        assert spark.table("versions.h").filter("extra = 'x'").count() == 1
        assert content(spark.table("versions.h")) == content(ws.history("h", day(spark)))
        ws.bootstrap_history(day(spark, (9, SECOND, 1.0)), "h")
        assert content(spark.table("versions.h")) == {(9, SECOND, 1.0)}
    finally:
        spark.sql("DROP DATABASE versions CASCADE")


def answers_of(spark, days, changed=()):
    """Some answers a day; ``changed`` days have others, or none."""
    kinds = ("PROMOTOR", "NEUTRO", "DETRATOR")
    rows = [
        (f"s{i % 2}", date.fromordinal(d), kinds[(i + d) % 3], 1)
        for d in days
        for i in range(5 + d % 4 + (3 if d in changed else 0))
    ]
    return spark.createDataFrame(rows, "segment string, dataref date, Classificacao string, extra int")


def test_days_counted_again_give_the_series_of_a_whole_run(spark, tmp_path):
    start = date(2024, 1, 1).toordinal()
    days = list(range(start, start + 70))
    run = dict(keys=["segment"], since=date(2024, 1, 1), rate_change=date(2024, 2, 1))
    ctx = RunContext(as_of=date(2024, 3, 18))
    part, whole = Workspace(spark, f"{tmp_path}/part"), Workspace(spark, f"{tmp_path}/whole")
    first = date.fromordinal(start + 66)
    run_weekly(answers_of(spark, days), ctx, part, bootstrap=True, recount_from=first, **run)
    assert part.table("answers_daily").agg(F.min("dataref")).first()[0] == date(2024, 1, 1)
    # a late answer, a day withdrawn, three days more
    later = [d for d in days if d != start + 68] + [start + 70, start + 71, start + 72]
    answers = answers_of(spark, later, changed={start + 66})
    run_weekly(answers, ctx, part, recount_from=first, **run)
    run_weekly(answers, ctx, whole, bootstrap=True, **run)
    for name in ("answers_daily", "answers_by_day", "series_weekly", "forecast_monthly"):
        want = whole.table(name)
        got = part.table(name).select(want.columns)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    snapshot = spark.read.parquet(f"{tmp_path}/part/silver/answers_daily_2024-03-18")
    assert snapshot.agg(F.min("dataref")).first()[0] == first
    folder = VersionedFolder(spark, f"{tmp_path}/part/tables/answers_daily")
    newest = folder.committed()[-1]
    written = {k.partition("=")[2] for k, v in folder.partitions().items() if v == newest}
    assert written == {date.fromordinal(d).isoformat() for d in range(start + 66, start + 73)}


def test_only_the_days_counted_again_are_read(spark, tmp_path):
    ws = Workspace(spark, str(tmp_path))
    start = date(2024, 1, 1).toordinal()
    daily = daily_answers(answers_of(spark, range(start, start + 20)), since=date(2024, 1, 1))
    stored = ws.replace_from(daily, "answers_daily", "dataref", date(2024, 1, 1))
    last = daily_counts(stored.filter(F.col("dataref") >= F.lit(date(2024, 1, 20))))
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataref" in plan and ">= 2024-01-20)]" in plan
