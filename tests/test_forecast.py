"""The fit itself, then as a grouped Spark job."""

from __future__ import annotations

import math
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from loyalpulse.context import RunContext
from loyalpulse.functions import arma
from loyalpulse.operators.weekly import future_weeks
from loyalpulse.operators.forecast import forecast, weekly_forecast

CTX = RunContext(as_of=date(2024, 1, 20))


def simulate(n, phi=(), theta=(), mean=0.0, scale=1.0, seed=0):
    rng = np.random.default_rng(seed)
    shocks = rng.normal(size=n + 200)
    y = np.zeros(n + 200)
    for t in range(5, n + 200):
        y[t] = shocks[t] + sum(p * y[t - i - 1] for i, p in enumerate(phi))
        y[t] += sum(q * shocks[t - i - 1] for i, q in enumerate(theta))
    return (mean + scale * y[200:]).tolist()


def dense_neg_loglik(y, phi, theta):
    """Likelihood from the full covariance matrix, independent of the filter."""
    seen = [i for i, v in enumerate(y) if v is not None]
    psi = [1.0]
    for j in range(1, 600):
        psi.append((theta[j - 1] if j <= len(theta) else 0.0)
                   + sum(p * psi[j - i - 1] for i, p in enumerate(phi) if j - i - 1 >= 0))
    psi = np.array(psi)
    acov = np.array([psi[: len(psi) - k] @ psi[k:] for k in range(len(y))])
    cov = acov[np.abs(np.subtract.outer(seen, seen))]
    v, one = np.array([y[i] for i in seen]), np.ones(len(seen))
    solve = np.linalg.solve
    mean = (one @ solve(cov, v)) / (one @ solve(cov, one))
    variance = (v - mean) @ solve(cov, v - mean) / len(seen)
    return mean, variance, 0.5 * (
        len(seen) * (math.log(2 * math.pi * variance) + 1) + np.linalg.slogdet(cov)[1]
    )


@pytest.mark.parametrize("gaps", [(), (0, 7, 8, 30, 59)])
def test_filter_equals_the_dense_gaussian_likelihood(gaps):
    y = simulate(60, (0.5, -0.2, 0.3), (0.4,), mean=2.0, seed=3)
    y = [None if i in gaps else v for i, v in enumerate(y)]
    phi, theta = [0.4, -0.1, 0.2], [0.3]
    filtered = arma.run_filter(y, phi, theta)
    mean, variance, cost = dense_neg_loglik(y, phi, theta)
    assert filtered.mean == pytest.approx(mean, rel=1e-6)
    assert filtered.variance == pytest.approx(variance, rel=1e-6)
    assert filtered.neg_loglik == pytest.approx(cost, rel=1e-6)


def test_partial_autocorrelations_invert():
    x = [0.7, -1.2, 0.3]
    assert arma._to_partial(arma._from_partial(x)) == pytest.approx(x)
    assert arma._to_partial([1.5]) is None


def test_fit_recovers_the_process():
    y = simulate(3000, (0.5, -0.2, 0.3), (0.4,), mean=50, scale=5, seed=1)
    z = [(v - np.mean(y)) / np.std(y) for v in y]
    start = min(arma._starting_points(np.array(z), 3, 1),
                key=lambda x: arma.run_filter(z, *arma._shape(x, 3)).neg_loglik)
    best, cost, settled = arma.simplex_search(
        lambda x: arma.run_filter(z, *arma._shape(x, 3)).neg_loglik, start, 300
    )
    phi, theta = arma._shape(best, 3)
    truth = arma.run_filter(z, [0.5, -0.2, 0.3], [0.4]).neg_loglik
    assert settled and cost <= truth
    assert phi == pytest.approx([0.5, -0.2, 0.3], abs=0.15)
    assert theta == pytest.approx([0.4], abs=0.15)


def test_intervals_are_symmetric_and_widen():
    fit = arma.fit_and_forecast(simulate(150, (0.6,), (0.3,), 20, 4, 2), (3, 1), 8, 0.5)
    widths = [u - lo for u, lo in zip(fit.upper, fit.lower)]
    for m, lo, u in zip(fit.mean, fit.lower, fit.upper):
        assert (lo + u) / 2 == pytest.approx(m)
    assert all(b >= a * (1 - 1e-5) for a, b in zip(widths, widths[1:]))
    wide = arma.fit_and_forecast(simulate(150, (0.6,), (0.3,), 20, 4, 2), (3, 1), 8, 0.05)
    assert (wide.upper[0] - wide.lower[0]) / widths[0] == pytest.approx(1.959964 / 0.674490, rel=1e-5)


def test_moving_average_forgets_after_one_week():
    y = simulate(200, (), (0.6,), 10, 1, 5)
    fit = arma.fit_and_forecast(y, (0, 1), 5, 0.5)
    assert fit.mean[1:] == pytest.approx([fit.mean[1]] * 4)
    assert fit.mean[0] != pytest.approx(fit.mean[1])
    assert fit.mean[1] == pytest.approx(np.mean(y), abs=0.1)


def test_offset_shifts_the_horizons():
    y = simulate(120, (0.7,), (0.2,), 30, 3, 6)
    shifted = arma.fit_and_forecast(y, (3, 1), 4, 0.5, offset=4)
    plain = arma.fit_and_forecast(y, (3, 1), 8, 0.5)
    assert shifted.mean == pytest.approx(plain.mean[4:])
    assert shifted.upper == pytest.approx(plain.upper[4:])
    # appending unobserved weeks to the sample is the same shift
    padded = arma.fit_and_forecast([*y, None, None, None, None], (3, 1), 4, 0.5)
    assert padded.mean == pytest.approx(shifted.mean, rel=1e-4)


def test_short_and_constant_series():
    assert arma.fit_and_forecast([None] * 9, (3, 1), 4, 0.5) is None
    for weeks, status in ((1, "constant"), (2, "mean"), (5, "order 0,1"), (9, "order 2,1")):
        fit = arma.fit_and_forecast([float(i % 3) for i in range(weeks)], (3, 1), 4, 0.5)
        assert len(fit.mean) == 4 and fit.status in (status, "iteration limit")
        assert all(a <= b <= c for a, b, c in zip(fit.lower, fit.mean, fit.upper, strict=True))
    flat = arma.fit_and_forecast([5.0] * 30, (3, 1), 4, 0.5)
    assert (flat.mean, flat.lower, flat.status) == ([5.0] * 4, [5.0] * 4, "constant")


@pytest.fixture(scope="module")
def series(spark):
    rows = []
    for key, n, seed in (("a", 60, 1), ("b", 40, 2), ("c", 6, 3)):
        for i, v in enumerate(simulate(n, (0.5,), (0.2,), 40, 5, seed)):
            monday = date(2022, 1, 3) + timedelta(weeks=i)
            gap = key == "b" and i == 20
            rows.append((key, i + 1, monday, monday.isocalendar()[0], monday.isocalendar()[1], 7, 5, 1,
                         2, 8, 7.5, None if gap else v, CTX.as_of, None if gap else 8.0 + v / 10))
    return spark.createDataFrame(
        rows,
        "segment string, id bigint, monday date, year int, isoweek int, dias int, promotor bigint,"
        "neutro bigint, detrator bigint, respondentes bigint, frac_sorteados double, nps double,"
        "data_atualizacao date, respondentes_ajustado double",
    )


def test_each_series_is_forecast_on_its_own(spark, series):
    weeks = weekly_forecast(series, CTX, ["segment"])
    got = weeks.filter("nps IS NULL AND frac_sorteados = 7.5 AND promotor IS NULL").collect()
    assert len(got) == 12
    alone = series.filter("segment = 'a'").orderBy("id").collect()
    fit = arma.fit_and_forecast([r.nps for r in alone], (3, 1), 4, 0.5)
    mine = sorted((r.id, r.forecast_value) for r in got if r.segment == "a")
    assert [i for i, _ in mine] == [61, 62, 63, 64]
    assert [v for _, v in mine] == pytest.approx(fit.mean)
    # too short for the order: a lower one, said in the status
    assert all(r.forecast_value is not None and r.status != "ok" for r in got if r.segment == "c")
    assert weeks.filter(F.isnan("forecast_value") | F.isnan("respondentes_fcst")).count() == 0
    assert weeks.filter("promotor IS NOT NULL AND forecast_value IS NOT NULL").count() == 0


def test_a_null_key_is_a_series_of_its_own(spark, series):
    keyed = series.withColumn("segment", F.expr("nullif(segment, 'b')"))
    weeks = weekly_forecast(keyed, CTX, ["segment"])
    assert weeks.filter("segment IS NULL AND forecast_value IS NOT NULL").count() == 4


def test_forecast_weeks_across_new_year(spark, series):
    last = series.filter("segment = 'c' AND id = 6").withColumn("monday", F.lit(date(2024, 12, 23)))
    row = future_weeks(last, ["segment"]).filter("step = 1").first()
    assert (row.monday, row.year, row.isoweek) == (date(2024, 12, 30), 2025, 1)
    row = future_weeks(last, ["segment"], week_key="calendar").filter("step = 1").first()
    assert row.year == 2024


def test_one_series_without_keys_and_status(series):
    one = forecast(series.filter("segment = 'b'").drop("segment"), CTX)
    rows = one.orderBy("step").collect()
    assert [r.step for r in rows] == [1, 2, 3, 4]
    assert {r.status for r in rows} <= {"ok", "iteration limit"}
    assert one.columns[0] == "step"


def test_series_spread_over_tasks(spark, series):
    plan = forecast(series, CTX, ["segment"], parallelism=5)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "FlatMapGroupsIn" in text and ", 5), REPARTITION_BY_NUM" in text
