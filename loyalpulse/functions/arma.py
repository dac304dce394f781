"""Gaussian ARMA with a mean for one short series, used inside a grouped Spark task.

Maximum likelihood by a Kalman filter: the mean and the innovation variance come out of
the filter in closed form, so the search runs over the p + q shape parameters only.
Missing values (None) are predicted through.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from statistics import NormalDist
from typing import NamedTuple

import numpy as np

STEADY = 1e-11  # change of the filter spread below which its gain is kept
EDGE = 10.0  # search bound; partial autocorrelations stay within +-0.995


class Filtered(NamedTuple):
    mean: float
    variance: float
    neg_loglik: float
    state: list[float]
    spread: list[list[float]]


class Forecast(NamedTuple):
    mean: list[float]
    lower: list[float]
    upper: list[float]
    status: str
    at_edge: bool = False  # the search ended where it must not go further


def _from_partial(x: Sequence[float]) -> list[float]:
    """Unbounded numbers to coefficients of a stationary recursion (Durbin-Levinson)."""
    coefficients: list[float] = []
    for value in x:
        r = value / math.sqrt(1 + value * value)
        coefficients = [c - r * d for c, d in zip(coefficients, coefficients[::-1])] + [r]
    return coefficients


def _to_partial(coefficients: Sequence[float]) -> list[float] | None:
    """Inverse of ``_from_partial``; None if the recursion is not stationary."""
    work, out = list(coefficients), []
    while work:
        r = work.pop()
        if abs(r) >= 0.99:
            return None
        out.append(r / math.sqrt(1 - r * r))
        work = [(c + r * d) / (1 - r * r) for c, d in zip(work, work[::-1])]
    return out[::-1]


def _shape(x: Sequence[float], p: int) -> tuple[list[float], list[float]]:
    return _from_partial(x[:p]), [-c for c in _from_partial(x[p:])]


def _advance(state: list, phi: list[float]) -> list:
    head = state[0]
    return [f * head + s for f, s in zip(phi, state[1:] + [0.0])]


def _advance_spread(spread, phi, shock):
    r = len(phi)
    half = [[phi[i] * spread[0][j] + (spread[i + 1][j] if i + 1 < r else 0.0) for j in range(r)]
            for i in range(r)]
    return [[half[i][0] * phi[j] + (half[i][j + 1] if j + 1 < r else 0.0) + shock[i] * shock[j]
             for j in range(r)] for i in range(r)]


def run_filter(y: Sequence[float | None], phi: Sequence[float], theta: Sequence[float]) -> Filtered:
    """Filter the series and a column of ones together; their innovations give the mean.

    The two share one gain, so they run as the real and imaginary part of one state.
    """
    r = max(len(phi), len(theta) + 1)
    phi = list(phi) + [0.0] * (r - len(phi))
    shock = [1.0, *theta] + [0.0] * (r - 1 - len(theta))
    move = np.zeros((r, r))
    move[:, 0] = phi
    move[:-1, 1:] += np.eye(r - 1)
    start = np.linalg.solve(np.eye(r * r) - np.kron(move, move), np.outer(shock, shock).ravel())
    spread = start.reshape(r, r).tolist()
    state = [0j] * r
    errors: list[complex] = []
    scales: list[float] = []
    gain: list[float] | None = None
    for value in y:
        if value is None:
            state = _advance(state, phi)
            spread, gain = _advance_spread(spread, phi, shock), None
            continue
        if gain is None:
            scale = spread[0][0]
            step = _advance([row[0] / scale for row in spread], phi)
            ahead = _advance_spread(spread, phi, shock)
            ahead = [[a - step[i] * step[j] * scale for j, a in enumerate(row)]
                     for i, row in enumerate(ahead)]
            change = max(abs(a - b) for new, old in zip(ahead, spread) for a, b in zip(new, old))
            spread = ahead
            if change < STEADY:
                gain = step
        head = state[0]
        error = complex(value, 1.0) - head
        state = [f * head + s + k * error for f, s, k in zip(phi, state[1:] + [0j], step)]
        errors.append(error)
        scales.append(scale)
    error, scale = np.array(errors), np.array(scales)
    vv = float(np.sum(error.real**2 / scale))
    vw = float(np.sum(error.real * error.imag / scale))
    ww = float(np.sum(error.imag**2 / scale))
    n = len(errors)
    mean = vw / ww
    variance = max((vv - vw * vw / ww) / n, 1e-300)
    log_det = float(np.sum(np.log(scale)))
    neg_loglik = 0.5 * (n * math.log(2 * math.pi * variance) + log_det + n)
    return Filtered(mean, variance, neg_loglik, [s.real - mean * s.imag for s in state], spread)


def _starting_points(y: np.ndarray, p: int, q: int) -> list[list[float]]:
    """Zero, and least squares on lags and on the residuals of a long autoregression."""
    starts = [[0.0] * (p + q)]
    long = min(max(p + q, 8), len(y) // 4)
    if long < 1 or len(y) < 2 * (long + p + q) + 2:
        return starts
    lags = np.column_stack([y[long - k : len(y) - k] for k in range(1, long + 1)])
    residual = np.zeros_like(y)
    residual[long:] = y[long:] - lags @ np.linalg.lstsq(lags, y[long:], rcond=None)[0]
    first = long + max(p, q)
    columns = [y[first - k : len(y) - k] for k in range(1, p + 1)]
    columns += [residual[first - k : len(y) - k] for k in range(1, q + 1)]
    fit = np.linalg.lstsq(np.column_stack(columns), y[first:], rcond=None)[0]
    ar, ma = _to_partial(fit[:p].tolist()), _to_partial([-c for c in fit[p:].tolist()])
    if ar is not None and ma is not None:
        starts.append(ar + ma)
    return starts


def simplex_search(
    cost: Callable[[list[float]], float], start: list[float], max_iterations: int
) -> tuple[list[float], float, bool]:
    """Nelder-Mead; returns the best point, its cost and whether it settled."""
    size = len(start)
    points = [start] + [[x + (0.3 if i == j else 0.0) for j, x in enumerate(start)]
                        for i in range(size)]
    simplex = sorted((cost(point), point) for point in points)
    for _ in range(max_iterations):
        width = max(abs(a - b) for _, point in simplex[1:] for a, b in zip(point, simplex[0][1]))
        if simplex[-1][0] - simplex[0][0] < 1e-8 and width < 1e-4:
            return simplex[0][1], simplex[0][0], True
        centre = [sum(column) / size for column in zip(*(point for _, point in simplex[:-1]))]
        worst_cost, worst = simplex[-1]

        def towards(factor: float) -> tuple[float, list[float]]:
            point = [c + factor * (c - w) for c, w in zip(centre, worst)]
            return cost(point), point

        trial = towards(1.0)
        if trial[0] < simplex[0][0]:
            trial = min(trial, towards(2.0))
        elif trial[0] >= simplex[-2][0]:
            trial = min(trial, towards(0.5 if trial[0] < worst_cost else -0.5))
        if trial[0] < worst_cost:
            simplex[-1] = trial
        else:
            best = simplex[0][1]
            shrunk = [[(a + b) / 2 for a, b in zip(point, best)] for _, point in simplex[1:]]
            simplex[1:] = [(cost(point), point) for point in shrunk]
        simplex.sort()
    return simplex[0][1], simplex[0][0], False


def affordable(order: tuple[int, int], observed: int) -> tuple[int, int]:
    """The highest order not above ``order`` that so many observations can carry."""
    p, q = order
    while p + q and observed < 2 * (p + q) + 2:
        p, q = (p - 1, q) if p else (p, q - 1)
    return p, q


def _status(wanted: tuple[int, int], order: tuple[int, int], settled: bool) -> str:
    if not settled:
        return "iteration limit"
    return "ok" if order == wanted else f"order {order[0]},{order[1]}"


def fit_and_forecast(
    values: Sequence[float | None],
    order: tuple[int, int],
    steps: int,
    alpha: float,
    offset: int = 0,
    max_iterations: int = 300,
) -> Forecast | None:
    """Forecasts ``offset + 1 .. offset + steps`` weeks ahead with 1 - alpha bounds.

    An order needs two observations for each coefficient and for the mean and variance
    together; with fewer, lower orders are fitted, down to the mean.  Only a series
    without any observation has no forecast.
    """
    observed = np.array([v for v in values if v is not None])
    if len(observed) == 0:
        return None
    wanted, order = order, affordable(order, len(observed))
    centre, spread = float(observed.mean()), float(observed.std())
    if spread <= 1e-12 * max(1.0, abs(centre)):
        return Forecast([centre] * steps, [centre] * steps, [centre] * steps, "constant")
    quantile = NormalDist().inv_cdf(1 - alpha / 2)
    if order == (0, 0):
        margin = quantile * spread
        return Forecast(
            [centre] * steps, [centre - margin] * steps, [centre + margin] * steps, "mean"
        )
    p, q = order
    y = [None if v is None else (float(v) - centre) / spread for v in values]
    filled = np.array([0.0 if v is None else v for v in y])

    def cost(x: list[float]) -> float:
        if max(map(abs, x)) > EDGE:
            return math.inf
        return run_filter(y, *_shape(x, p)).neg_loglik

    start = min(_starting_points(filled, p, q), key=cost)
    best, _, settled = simplex_search(cost, start, max_iterations)
    phi, theta = _shape(best, p)
    filtered = run_filter(y, phi, theta)
    r = len(filtered.state)
    phi = phi + [0.0] * (r - p)
    shock = [1.0, *theta] + [0.0] * (r - 1 - q)
    state, cover = filtered.state, filtered.spread
    at_edge = max(map(abs, best)) > 0.99 * EDGE
    result = Forecast([], [], [], _status(wanted, order, settled), at_edge)
    for horizon in range(1, offset + steps + 1):
        if horizon > offset:
            value = centre + spread * (filtered.mean + state[0])
            margin = quantile * spread * math.sqrt(filtered.variance * cover[0][0])
            result.mean.append(value)
            result.lower.append(value - margin)
            result.upper.append(value + margin)
        state, cover = _advance(state, phi), _advance_spread(cover, phi, shock)
    return result
