"""Time-series fits on series whose law is known."""

from datetime import date, timedelta

import numpy as np
import pytest

from tillwise.operators import forecast as fc


def made_series(n, phi, theta, seed):
    rng = np.random.default_rng(seed)
    noise = rng.normal(size=n)
    out = np.zeros(n)
    for t in range(n):
        out[t] = noise[t] + sum(p * out[t - i] for i, p in enumerate(phi, 1) if t >= i) + (theta * noise[t - 1] if t else 0)
    return out, noise


@pytest.mark.parametrize("theta", [-0.8, -0.4, 0.5, 0.7])
def test_moving_average_is_recovered(theta):
    series, noise = made_series(6000, [], theta, 1)
    _, found, shocks = fc.fit_arma(series, 0 + 1, 1)
    lagless = fc.fit_arma(series, 1, 1)
    assert abs(lagless[0][0]) < 0.08 and found[0] == pytest.approx(theta, abs=0.08)
    assert np.corrcoef(shocks[100:], noise[100:])[0, 1] > 0.99


def test_both_parts_are_recovered():
    series, _ = made_series(8000, [0.5, -0.3], 0.6, 2)
    lags, shocks, _ = fc.fit_arma(series, 2, 1)
    assert lags == pytest.approx([0.5, -0.3], abs=0.05) and shocks[0] == pytest.approx(0.6, abs=0.05)


def test_baseline_with_shocks_beats_lags_alone(spark):
    """Differences with a strong moving average: the level of the next days follows from the last shock."""
    start, rows, truth = date(2000, 1, 1), [], {}
    for code in range(40):
        steps, _ = made_series(400, [], -0.9, code)
        level = 1000 + 10 * np.cumsum(steps)
        for i, y in enumerate(level):
            rows.append((start + timedelta(i), code, float(round(y, 2)), i >= 399))
        truth[code] = level[399]
    df = spark.createDataFrame(rows, "date date, division_code int, sales_amt double, is_test boolean")
    off = lambda shocks: np.mean([(r.yhat - truth[r.division_code]) ** 2 for r in fc.ar_baseline(df, 1, shocks).collect()])
    assert off(1) < 0.8 * off(0)


@pytest.mark.parametrize("seed", range(3, 9))
def test_shocks_without_a_law_leave_forecasts_that_settle(spark, seed):
    """A random walk: seven lags and a shock explain each other away, and rounds that don't settle must not be forecast from."""
    series = np.random.default_rng(seed).normal(0, 5, 189)
    lags, shocks, noise = fc.fit_arma(series, 7, 1)
    assert fc.settles(lags) and np.isfinite(noise).all() and noise @ noise < 1.2 * (series @ series)
    start, level = date(2024, 1, 1), 500 + np.cumsum(series)
    rows = [(start + timedelta(i), 1, float(v), i >= 130) for i, v in enumerate(level)]
    df = spark.createDataFrame(rows, "date date, division_code int, sales_amt double, is_test boolean")
    ahead = [r.yhat for r in fc.ar_baseline(df).collect()]
    assert np.abs(np.array(ahead) - level[129]).max() < 50


def test_lags_that_grow_without_end_are_replaced():
    growing = 1.5 ** np.arange(40)
    assert not fc.settles(fc.ridge_solution(fc.lagged(growing, 2)[2:], growing[2:]))
    assert fc.settles(fc.fit_arma(growing, 2, 0)[0]) and fc.settles(fc.fit_arma(growing, 2, 1)[0])


def seasonal_days(n=1500):
    years = (np.arange(n) + 10_000) / 365.25
    angle = 2 * np.pi * years
    x = np.column_stack((np.ones(n), years - 30, np.sin(angle), np.cos(angle)))
    return years, x, 5 * np.sin(angle)


def test_a_broken_trend_is_forecast_better_with_change_points():
    years, x, waves = seasonal_days()
    noise = np.random.default_rng(4).normal(scale=0.5, size=len(years))
    bent = waves + 10 * years - 25 * np.maximum(years - years[800], 0) + noise
    train = np.arange(len(years)) < 1400
    straight = x @ fc.ridge_solution(x[train], bent[train])
    fitted = fc.seasonal_fit(x, years, bent, train)
    error = lambda f: np.sqrt(((f - bent)[~train] ** 2).mean())
    assert error(fitted) < 0.25 * error(straight) and error(fitted) < 1.5


def test_a_straight_trend_stays_straight():
    years, x, waves = seasonal_days()
    straight = waves + 3 * years + np.random.default_rng(7).normal(scale=0.5, size=len(years))
    train = np.arange(len(years)) < 1400
    error = np.sqrt(((fc.seasonal_fit(x, years, straight, train) - straight)[~train] ** 2).mean())
    plain = np.sqrt(((x @ fc.ridge_solution(x[train], straight[train]) - straight)[~train] ** 2).mean())
    assert error < 1.3 * plain


def test_short_and_constant_series():
    lags, shocks, noise = fc.fit_arma(np.zeros(40), 7, 1)
    assert not lags.any() and not shocks.any() and not noise.any()
    years, x, _ = seasonal_days(30)
    assert fc.seasonal_fit(x, years, np.full(30, 4.0), np.arange(30) < 25) == pytest.approx(np.full(30, 4.0), abs=0.1)
