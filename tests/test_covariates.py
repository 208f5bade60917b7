"""Joint covariates against numpy's least squares."""

import datetime
import math
import random

import numpy as np
import pytest

from tracewell.functions.columns import normal_half_width
from tracewell.operators.covariates import forecast_jointly

DAY = datetime.date(2024, 1, 7)


def table(spark):
    rng, rows = random.Random(3), []
    for k in ("a", None):
        p = [rng.uniform(0, 10) for _ in range(40)]
        f = [0.8 * v + rng.uniform(0, 2) for v in p]  # the two go together
        for i in range(40):
            y = 5 + 0.3 * i + 2.0 * (p[i - 4] if i >= 4 else 0) - 1.5 * f[i] + rng.gauss(0, 0.2)
            rows.append((k, DAY + datetime.timedelta(days=i), None if i in (11, 36, 37, 38, 39) else y, p[i], f[i], 3.0, 2 * f[i]))
    rows += [("short", DAY + datetime.timedelta(days=i), 1.0 + i if i < 3 else None, 1.0, float(i * i), 3.0, 0.0) for i in range(5)]
    return spark.createDataFrame(rows, "k string, ts date, y double, p double, f double, flat double, twice double"), rows


@pytest.mark.parametrize("extra", [[], ["flat", "twice"]])
def test_equals_least_squares(spark, extra):
    df, rows = table(spark)
    out = forecast_jointly(df, "y", "ts", 4, past_cols=["p"], future_cols=["f", *extra], series_cols=["k"])
    got = {(r["k"], r["forecast_timestamp"]): tuple(r)[2:] for r in out.collect()}
    for k in ("a", None):
        own = [r for r in rows if r[0] == k]
        x = np.array([[1, i, own[i - 4][3] if i >= 4 else np.nan, own[i][4]] for i in range(40)])
        y = np.array([np.nan if r[2] is None else r[2] for r in own])
        fits = ~np.isnan(x).any(axis=1) & ~np.isnan(y)
        beta = np.linalg.lstsq(x[fits], y[fits], rcond=None)[0]
        dof = fits.sum() - 4 - len(extra)
        sigma = math.sqrt(((y[fits] - x[fits] @ beta) ** 2).sum() / dof)
        inverse = np.linalg.inv(x[fits].T @ x[fits])
        for i in range(36, 40):
            value, lower, upper = got[k, own[i][1]]
            half = normal_half_width(0.95) * sigma * math.sqrt(1 + x[i] @ inverse @ x[i])
            assert value == pytest.approx(x[i] @ beta, rel=1e-6)
            assert (lower, upper) == (pytest.approx(value - half, rel=1e-6), pytest.approx(value + half, rel=1e-6))
    assert len([key for key in got if key[0] in ("a", None)]) == 8  # the gap in the middle is not forecast


def test_too_few_rows_give_the_mean(spark):
    df, _ = table(spark)
    out = forecast_jointly(df.filter("k = 'short'"), "y", "ts", 1, future_cols=["f"]).collect()
    assert [(r["forecast_value"], r["prediction_interval_upper_bound"]) for r in out] == [(2.0, None)] * 2
    assert forecast_jointly(df.filter("false"), "y", "ts", 1, future_cols=["f"]).count() == 0
