"""The additive model from sums of products against a dense ridge regression of each fold."""

import math
from datetime import date, timedelta

import numpy as np
import pytest

from larderline.operators import additive_model as am
from larderline.plans import forecast

MONDAY = date(2021, 1, 4)
YEARS = range(2021, 2025)


def weekly(spark, weeks=110, skip=()):
    rows = [
        (c, MONDAY + timedelta(weeks=i), int(500 + 3 * i + 80 * math.sin(i / 8) + (i * 7919) % 41))
        for c in ("dairy", "frozen") for i in range(weeks) if i not in skip and not (c == "frozen" and i >= weeks - 10)
    ]
    return spark.createDataFrame(rows, "category string, week_start date, total_quantity bigint"), rows


def number(day):
    return (day - date(1970, 1, 1)).days


def made(day, first, span):
    u = am.UNIT
    slope = ((day - first) * 2 * u + span) // (2 * span)
    bends = [max(0, slope - round(u * 0.8 * c / 10)) for c in range(1, 11)]
    waves = [math.floor(f(float(day) * w) * u + 0.5) for f in (math.sin, math.cos) for w in am.frequencies()]
    holidays = [u if day in days else 0 for days in forecast._holiday_lists(YEARS)]
    return np.array([u, slope, *bends, *waves, *holidays]) / u


def fit(rows, first, span):
    x = np.array([made(number(w), first, span) for w, _ in rows])
    y = np.array([q for _, q in rows], float)
    scale = max(y.max(), 1.0)
    noise = max(np.var(y / scale), 1e-6)
    pen = np.array(am.penalties(x.shape[1] - am.TREND - am.SEASON))
    beta = np.linalg.solve(x.T @ x + noise * np.diag(pen), x.T @ (y / scale))
    sigma = math.sqrt(((y / scale - x @ beta) ** 2).sum() / max(len(y) - 2, 1)) * scale
    return beta * scale, sigma


@pytest.mark.parametrize("skip", [(), (70, 71, 72, 73, 74, 75, 90)])
def test_every_fold_equals_its_own_regression(spark, skip):
    df, rows = weekly(spark, skip=skip)
    got = {(r.category, r.cutoff, r.week_start): (r.y, r.yhat) for r in forecast.additive_backtest(df, YEARS).collect()}
    expected = {}
    for c in ("dairy", "frozen"):
        series = [(w, q) for k, w, q in rows if k == c]
        first, last = number(series[0][0]), number(series[-1][0])
        for k in range((last - first - 322) // 28 + 1):
            cutoff = series[-1][0] - timedelta(days=28 * (k + 1))
            beta, _ = fit([s for s in series if s[0] <= cutoff], first, last - first)
            for w, q in series:
                if cutoff < w <= cutoff + timedelta(days=28):
                    expected[c, cutoff, w] = (q, made(number(w), first, last - first) @ beta)
    assert got.keys() == expected.keys()
    assert all(got[k][0] == v[0] and got[k][1] == pytest.approx(v[1], rel=1e-6, abs=1e-5) for k, v in expected.items())


def test_forecast_and_band_equal_the_regression(spark):
    df, rows = weekly(spark)
    got = {(r.category, r.forecast_date): r for r in forecast.additive_forecast(df, holiday_years=YEARS).collect()}
    assert len(got) == 24
    for c in ("dairy", "frozen"):
        series = [(w, q) for k, w, q in rows if k == c]
        first, last = number(series[0][0]), number(series[-1][0])
        beta, sigma = fit(series, first, last - first)
        for step in range(12):
            day = series[-1][0] + timedelta(days=6 + 7 * step)
            x, cap = made(number(day), first, last - first), 3 * max(q for _, q in series)
            clip = lambda v: min(max(v, 0), cap)
            r = got[c, day]
            assert (r.yhat, r.yhat_lower, r.yhat_upper) == pytest.approx(
                (clip(x @ beta), clip(x @ beta - am.INTERVAL_Z * sigma), clip(x @ beta + am.INTERVAL_Z * sigma)), abs=0.02
            )
            assert r.trend == pytest.approx(x[: am.TREND] @ beta[: am.TREND], abs=0.02)


def test_no_python_workers_and_no_row_per_fold(spark):
    df, _ = weekly(spark)
    text = forecast.additive_backtest(df, YEARS)._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in text and "Python" not in text and "Join" not in text
