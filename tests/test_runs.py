"""Whole runs, and the shape of their plans."""

from __future__ import annotations

import re
from datetime import date

import pytest

from conftest import SF_SMALL
from fixtures.queries import CTX, QUERIES, SERIES, SINCE
from fixtures.views import SPARK_VIEWS, Domain
from loyalpulse.context import RunContext
from loyalpulse.operators import touchpoints
from loyalpulse.plans.eligibility import run_eligibility, surveys
from loyalpulse.plans.forecasting import run_weekly
from loyalpulse.sources.schemas import TABLES, check
from loyalpulse.sources.tables import Workspace, load_all


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_domain_tables_meet_their_contracts(spark):
    domain = Domain(spark, SF_SMALL)
    assert set(SPARK_VIEWS) == set(TABLES)
    for name in TABLES:
        check(domain[name], name)


@pytest.mark.parametrize("ctx", [CTX, RunContext.literal(CTX.as_of).but(strict_casts=False)],
                         ids=["default", "literal"])
def test_eligibility_run_writes_what_the_frames_say(spark, tmp_path, ctx):
    ws = Workspace(spark, str(tmp_path))
    sources = Domain(spark, SF_SMALL)
    log = run_eligibility(sources, ctx, ws)
    assert [s.name for s in log] == [
        "eligible_people", "unrestricted_people", "survey_positivo", "survey_pontos"
    ]
    everyone, allowed = ws.table("eligible_people"), ws.table("unrestricted_people")
    assert everyone.columns == allowed.columns
    assert {r.cpf for r in allowed.collect()} < {r.cpf for r in everyone.collect()}
    for survey, df in surveys(sources, ctx).items():
        assert rows(ws.table(f"survey_{survey}")) == rows(df)


def test_weekly_run_and_its_rerun(spark, tmp_path):
    ws = Workspace(spark, str(tmp_path))
    answers = Domain(spark, SF_SMALL)["answers"]
    run = dict(keys=["segment"], since=SINCE, rate_change=date(1998, 1, 1))
    earlier = SERIES.but(as_of=date(2001, 7, 26))
    run_weekly(answers, earlier, ws, bootstrap=True, **run)
    log = run_weekly(answers, SERIES, ws, **run)
    assert [s.name for s in log] == [
        "answers_daily", "series_weekly", "forecast_weekly", "forecast_monthly", "history",
        "dashboard_weekly", "history_export",
    ]
    weeks = ws.table("forecast_weekly")
    first = rows(ws.table("history_weekly"))
    assert ws.table("history_weekly").count() == 2 * weeks.count()
    ahead = weeks.filter("nps IS NULL")
    assert ahead.count() == 12
    assert ahead.filter(
        "forecast_value BETWEEN confidence_interval_lower_bound AND confidence_interval_upper_bound"
        " AND respondentes_fcst > 0"
    ).count() == 12
    assert ws.table("dashboard_weekly").count() == 2 * (weeks.count() - 3 * 2)
    months = ws.table("forecast_monthly")
    assert months.filter("nps_fcst IS NOT NULL").count() == 3
    assert months.filter("nps_real IS NULL AND nps_fcst IS NULL").count() == 0
    run_weekly(answers, SERIES, ws, **run)
    assert rows(ws.table("history_weekly")) == first
    for layer in ("silver/series_weekly", "gold/forecast_weekly", "gold/forecast_monthly_history"):
        assert spark.read.parquet(f"{tmp_path}/{layer}_2001-08-02").count() > 0


def test_tables_can_come_from_a_folder(spark, tmp_path):
    domain = Domain(spark, SF_SMALL)
    for name in ("optout", "answers"):
        domain[name].write.parquet(f"{tmp_path}/{name}")
    tables = load_all(spark, str(tmp_path), ["optout", "answers"])
    assert rows(tables["optout"]) == rows(domain["optout"])


def test_no_python_outside_the_fit(spark):
    for name in ("eligibility_end_to_end", "history_dashboard", "monthly_full"):
        assert "Python" not in plan_of(QUERIES[name](spark, SF_SMALL))


def test_fact_filters_reach_the_scan(spark):
    domain = Domain(spark, SF_SMALL)
    plan = plan_of(touchpoints.payment_hits(domain["transactions"], CTX))
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(ts,2024-01-17T03:00\), LessThan", plan)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_suppression_is_one_anti_join(spark):
    plan = plan_of(QUERIES["suppress_all"](spark, SF_SMALL))
    assert plan.count("LeftAnti") == 1
