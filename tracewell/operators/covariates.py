"""Forecasts with several covariates, fitted jointly by the normal equations of each series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.functions.columns import day_index, normal_half_width, total
from tracewell.operators.relational import join_null_safe

FLAT = 1e-10  # share of a covariate's spread that the others must leave for it to count


def _solved(sums: DataFrame, k: int) -> DataFrame:
    """Add the factors l and d of the matrix of products _s, the solution _beta and what the fit explains.

    A covariate that the ones before it explain has no d and a coefficient of 0.
    """
    def s(i: int, j: int) -> Column:
        return F.col(f"_s_{min(i, j)}_{max(i, j)}")

    def product(names: list[Column]) -> Column:
        return total(names) if names else F.lit(0.0)

    for j in range(k):
        own = s(j, j) - product([F.col(f"_l_{j}_{m}") * F.col(f"_l_{j}_{m}") * F.coalesce(f"_d_{m}", F.lit(0.0)) for m in range(j)])
        sums = sums.withColumn("_own", own).withColumn(f"_d_{j}", F.when(F.col("_own") > FLAT * s(j, j), F.col("_own")))
        for i in range(j + 1, k):
            left = s(i, j) - product([F.col(f"_l_{i}_{m}") * F.col(f"_l_{j}_{m}") * F.coalesce(f"_d_{m}", F.lit(0.0)) for m in range(j)])
            sums = sums.withColumn(f"_l_{i}_{j}", F.coalesce(left / F.col(f"_d_{j}"), F.lit(0.0)))
        rest = F.col(f"_s_{j}_y") - product([F.col(f"_l_{j}_{m}") * F.col(f"_u_{m}") for m in range(j)])
        sums = sums.withColumn(f"_u_{j}", F.when(F.col(f"_d_{j}").isNotNull(), rest).otherwise(0.0))
    for j in reversed(range(k)):
        beta = F.coalesce(F.col(f"_u_{j}") / F.col(f"_d_{j}"), F.lit(0.0)) - product(
            [F.col(f"_l_{i}_{j}") * F.col(f"_beta_{i}") for i in range(j + 1, k)])
        sums = sums.withColumn(f"_beta_{j}", F.when(F.col(f"_d_{j}").isNotNull(), beta).otherwise(0.0))
    explained = total([F.coalesce(F.col(f"_u_{j}") * F.col(f"_u_{j}") / F.col(f"_d_{j}"), F.lit(0.0)) for j in range(k)])
    return sums.withColumn("_sse", F.greatest(F.col("_s_y_y") - explained, F.lit(0.0))).drop("_own")


def forecast_jointly(df: DataFrame, data_col: str, timestamp_col: str, horizon: int, *, past_cols: Sequence[str] = (),
                     future_cols: Sequence[str] = (), confidence_level: float = 0.95, series_cols: Sequence[str] = (),
                     step_days: int = 1) -> DataFrame:
    """(series, timestamp, forecast_value, bounds) for the rows of a series without data after its last ones.

    A line in time, ``past_cols`` lagged by ``horizon`` steps and ``future_cols``,
    known for the rows to forecast too, explain the data together: covariates
    that go together share what they explain, as least squares has it. Rows that
    lack a value do not count, and are not forecast if they lack a covariate.
    With too few rows for all coefficients the forecast is the mean, without
    bounds. Needs regular series. The sums are one row per series.
    """
    keys = list(series_cols) or ["_one"]
    df = df if series_cols else df.withColumn("_one", F.lit(1))
    whole = Window.partitionBy(*keys)
    in_order = whole.orderBy(timestamp_col)
    named = {"_p_0": day_index(F.col(timestamp_col), step_days)}
    for c in past_cols:
        named[f"_p_{len(named)}"] = F.lag(F.col(c).cast("double"), horizon).over(in_order)
    for c in future_cols:
        named[f"_p_{len(named)}"] = F.col(c).cast("double")
    k = len(named)
    rows = df.withColumns(named).withColumn("_y", F.col(data_col).cast("double"))
    told = total([F.col(p) for p in named]).isNotNull()
    rows = rows.withColumn("_fits", told & F.col("_y").isNotNull()).withColumn(
        "_last", F.max(F.when(F.col("_y").isNotNull(), F.col(timestamp_col))).over(whole))
    centred = {c: F.col(c) - F.avg(F.when(F.col("_fits"), F.col(c))).over(whole) for c in named}
    rows = rows.withColumn("_mean", F.avg(F.when(F.col("_fits"), F.col("_y"))).over(whole)).withColumns(centred)
    fits, y = rows.filter("_fits"), F.col("_y") - F.col("_mean")
    products = [F.sum(F.col(f"_p_{i}") * F.col(f"_p_{j}")).alias(f"_s_{i}_{j}") for i in range(k) for j in range(i, k)]
    products += [F.sum(F.col(f"_p_{i}") * y).alias(f"_s_{i}_y") for i in range(k)] + [F.sum(y * y).alias("_s_y_y")]
    model = _solved(fits.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *products), k)
    ahead = rows.filter(told & F.col("_y").isNull() & (F.col(timestamp_col) > F.col("_last")))
    joined = join_null_safe(ahead, model, keys)
    for j in range(k):
        rest = [F.col(f"_l_{j}_{m}") * F.col(f"_t_{m}") for m in range(j)]
        joined = joined.withColumn(f"_t_{j}", F.col(f"_p_{j}") - (total(rest) if rest else F.lit(0.0)))
    lever = total([F.coalesce(F.col(f"_t_{j}") * F.col(f"_t_{j}") / F.col(f"_d_{j}"), F.lit(0.0)) for j in range(k)])
    enough = F.col("_n") > k + 1
    value = F.col("_mean") + F.when(enough, total([F.col(f"_beta_{j}") * F.col(f"_p_{j}") for j in range(k)])).otherwise(0.0)
    sigma = F.when(enough, F.sqrt(F.col("_sse") / (F.col("_n") - (k + 1))))
    half = F.lit(normal_half_width(confidence_level)) * sigma * F.sqrt(1.0 + 1.0 / F.col("_n") + lever)
    return joined.select(*series_cols, F.col(timestamp_col).alias("forecast_timestamp"), value.alias("forecast_value"),
                         (value - half).alias("prediction_interval_lower_bound"),
                         (value + half).alias("prediction_interval_upper_bound"))
