"""Time-series operators over many series at once.

A fact table is first reduced to one row per (series, bucket); everything after
that works on calendar-sized series, one shuffle by series. The model is a
straight line with an optional seasonal index, fitted from sums.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.functions.columns import (
    day_index, normal_half_width, sunday_week, two_sided_probability,
)
from tracewell.operators.relational import join_null_safe


def bucket_series(df: DataFrame, timestamp: Column, unit: str, measures: Mapping[str, Column],
                  series_cols: Sequence[str] = (), name: str = "ts") -> DataFrame:
    """Aggregate rows into hours, days, Sunday weeks or months per series."""
    day = timestamp.cast("date")
    bucket = {"hour": F.date_trunc("hour", timestamp.cast("timestamp")), "day": day, "week": sunday_week(day),
              "month": F.trunc(day, "month")}[unit]
    return df.groupBy(*series_cols, bucket.alias(name)).agg(
        *[m.alias(n) for n, m in measures.items()])


def regularize(df: DataFrame, timestamp_col: str, value_cols: Sequence[str],
               series_cols: Sequence[str] = (), step_days: int = 1,
               fill: float | None = 0.0, step: str | None = None) -> DataFrame:
    """Insert the missing buckets of every series; ``is_filled`` marks them.

    ``step`` is any other interval between buckets, such as ``1 hour`` or ``1 month``.
    """
    step = F.expr(f"interval {step or f'{int(step_days)} days'}")
    spine = (
        df.groupBy(*series_cols)
        .agg(F.min(timestamp_col).alias("_a"), F.max(timestamp_col).alias("_b"))
        .select(*series_cols, F.explode(F.sequence("_a", "_b", step)).alias(timestamp_col))
    )
    present = df.select(*series_cols, timestamp_col, *value_cols, F.lit(True).alias("_present"))
    values = [F.when(F.col("_present"), F.col(v)).otherwise(F.lit(fill)).alias(v) for v in value_cols]
    return join_null_safe(spine, present, [*series_cols, timestamp_col], "left").select(
        *series_cols, timestamp_col, *values, F.col("_present").isNull().alias("is_filled"))


def with_fit(df: DataFrame, data_col: str, timestamp_col: str, history: Column,
             series_cols: Sequence[str] = (), step_days: int = 1,
             season: int | None = None) -> DataFrame:
    """Add the model fitted on the ``history`` rows of each series to all its rows.

    Adds x (step index), a, b, n, x_mean, sxx, sigma, seasonal and expected, all
    prefixed with ``_``. With at most k rows (k fitted numbers) expected is the
    mean and sigma NULL.
    """
    w = Window.partitionBy(*series_cols)
    k = 2 + (season - 1 if season else 0)
    y = F.col(data_col).cast("double")
    out = (
        df.withColumn("_x", day_index(F.col(timestamp_col), step_days))
        .withColumn("_hy", F.when(history, y))
        .withColumn("_hx", F.when(history & y.isNotNull(), F.col("_x")))
        .withColumn("_n", F.count("_hy").over(w))
        .withColumn("_b", F.when(F.col("_n") > k, F.regr_slope("_hy", "_hx").over(w)).otherwise(0.0))
        .withColumn("_x_mean", F.avg("_hx").over(w))
        .withColumn("_a", F.avg("_hy").over(w) - F.col("_b") * F.col("_x_mean"))
        .withColumn("_sxx", F.regr_sxx("_hy", "_hx").over(w))
        .withColumn("_res", F.col("_hy") - (F.col("_a") + F.col("_b") * F.col("_x")))
    )
    if season:
        phase = Window.partitionBy(*series_cols, "_phase")
        out = (
            out.withColumn("_phase", F.pmod(F.col("_x").cast("bigint"), F.lit(season)))
            .withColumn("_pm", F.avg("_res").over(phase))
            .withColumn("_pc", F.count("_res").over(phase))
            .withColumn("_phases", F.sum(F.when(F.col("_res").isNotNull(), F.lit(1.0) / F.col("_pc"))).over(w))
            .withColumn("_center", F.sum(F.when(F.col("_res").isNotNull(), F.col("_pm") / F.col("_pc"))).over(w)
                        / F.col("_phases"))
            .withColumn("_seasonal", F.when(F.col("_n") > k, F.coalesce(F.col("_pm") - F.col("_center"), F.lit(0.0)))
                        .otherwise(0.0))
        )
    else:
        out = out.withColumn("_seasonal", F.lit(0.0))
    return (
        out.withColumn("_sse", F.sum(F.pow(F.col("_res") - F.col("_seasonal"), 2)).over(w))
        .withColumn("_sigma", F.when(F.col("_n") > k, F.sqrt(F.col("_sse") / (F.col("_n") - k))))
        .withColumn("_expected", F.col("_a") + F.col("_b") * F.col("_x") + F.col("_seasonal"))
    )


def _standard_error(x: Column) -> Column:
    """Standard error of one new value at step ``x``."""
    lever = F.lit(1.0) / F.col("_n") + F.try_divide(F.pow(x - F.col("_x_mean"), 2), F.col("_sxx"))
    return F.col("_sigma") * F.sqrt(F.lit(1.0) + lever)


def forecast(df: DataFrame, data_col: str, timestamp_col: str, horizon: int,
             confidence_level: float = 0.95, series_cols: Sequence[str] = (),
             step_days: int = 1, season: int | None = None) -> DataFrame:
    """``horizon`` rows per series with value and prediction interval."""
    targets = forecast_multi(df, [data_col], timestamp_col, horizon, confidence_level,
                             series_cols, step_days, season)
    return targets.select(
        *series_cols, F.col(timestamp_col).alias("forecast_timestamp"),
        F.col(data_col)["value"].alias("forecast_value"),
        F.col(data_col)["prediction_interval_lower_bound"].alias("prediction_interval_lower_bound"),
        F.col(data_col)["prediction_interval_upper_bound"].alias("prediction_interval_upper_bound"))


def forecast_multi(df: DataFrame, target_cols: Sequence[str], timestamp_col: str, horizon: int,
                   confidence_level: float = 0.95, series_cols: Sequence[str] = (),
                   step_days: int = 1, season: int | None = None) -> DataFrame:
    """One struct per target: value and interval bounds, ``horizon`` rows per series."""
    z = normal_half_width(confidence_level)
    names = ["_a", "_b", "_n", "_x_mean", "_sxx", "_sigma"]
    fitted = df
    aggregates = [F.max(timestamp_col).alias("_last")]
    for i, target in enumerate(target_cols):
        kept = [c for c in fitted.columns]
        one = with_fit(fitted, target, timestamp_col, F.lit(True), series_cols, step_days, season)
        extra = [F.col(n).alias(f"_{i}{n}") for n in names]
        if season:
            extra += [F.col("_seasonal").alias(f"_{i}_seasonal"), F.col("_phase").alias(f"_{i}_phase")]
            aggregates.append(F.map_from_entries(
                F.collect_set(F.struct(f"_{i}_phase", f"_{i}_seasonal"))).alias(f"_{i}_map"))
        fitted = one.select(*kept, *extra)
        aggregates += [F.max(f"_{i}{n}").alias(f"_{i}{n}") for n in names]
    future = (
        fitted.groupBy(*series_cols).agg(*aggregates).filter("_last IS NOT NULL")
        .withColumn("_h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
        .withColumn(timestamp_col, F.date_add("_last", F.col("_h") * step_days))
        .withColumn("_x", day_index(F.col(timestamp_col), step_days))
    )
    structs = []
    for i, target in enumerate(target_cols):
        col = {n: F.col(f"_{i}{n}") for n in names}
        value = col["_a"] + col["_b"] * F.col("_x")
        if season:
            phase = F.pmod(F.col("_x").cast("bigint"), F.lit(season))
            value = value + F.coalesce(F.try_element_at(F.col(f"_{i}_map"), phase), F.lit(0.0))
        lever = F.lit(1.0) / col["_n"] + F.try_divide(F.pow(F.col("_x") - col["_x_mean"], 2), col["_sxx"])
        half = F.lit(z) * col["_sigma"] * F.sqrt(F.lit(1.0) + lever)
        structs.append(F.struct(
            value.alias("value"), (value - half).alias("prediction_interval_lower_bound"),
            (value + half).alias("prediction_interval_upper_bound")).alias(target))
    return future.select(*series_cols, timestamp_col, *structs)


def forecast_with_covariates(df: DataFrame, target_cols: Sequence[str], covariate_cols: Sequence[str],
                             timestamp_col: str, horizon: int, confidence_level: float = 0.95,
                             series_cols: Sequence[str] = (), step_days: int = 1) -> DataFrame:
    """As :func:`forecast_multi`, corrected by past covariates.

    Each covariate, lagged by ``horizon`` steps, explains what the line leaves.
    The last ``horizon`` rows of a series supply the covariate values of the
    forecast rows, so they are simply moved ahead by the horizon. Needs regular
    series (see :func:`regularize`).
    """
    z = normal_half_width(confidence_level)
    w = Window.partitionBy(*series_cols)
    ordered = w.orderBy(timestamp_col)
    k = 2 + len(covariate_cols)
    out = df.withColumn("_last_x", F.max(day_index(F.col(timestamp_col), step_days)).over(w))
    for c in covariate_cols:
        out = out.withColumn(f"_lag_{c}", F.lag(c, horizon).over(ordered))
    results = []
    for i, target in enumerate(target_cols):
        out = with_fit(out, target, timestamp_col, F.lit(True), series_cols, step_days)
        left = F.col("_res")
        value = F.col("_a") + F.col("_b") * (F.col("_x") + horizon)
        for j, c in enumerate(covariate_cols):
            lag = f"_lag_{c}"
            slope = F.coalesce(F.regr_slope("_left", lag).over(w), F.lit(0.0))
            base = F.coalesce(F.avg(F.when(F.col(lag).isNotNull(), F.col("_left"))).over(w)
                              - F.col("_slope") * F.avg(F.when(F.col("_left").isNotNull(), F.col(lag))).over(w),
                              F.lit(0.0))
            out = (out.withColumn("_left", left).withColumn("_slope", slope).withColumn("_base", base)
                   .withColumn(f"_left_{i}_{j}", F.col("_left") - F.col("_base") - F.col("_slope") * F.col(lag))
                   .withColumn(f"_add_{i}_{j}", F.col("_base") + F.col("_slope") * F.col(c)))
            left = F.col(f"_left_{i}_{j}")
            value = value + F.col(f"_add_{i}_{j}")
        pairs = F.count(left).over(w)
        out = (
            out.withColumn("_pairs", pairs).withColumn("_left_sse", F.sum(F.pow(left, 2)).over(w))
            .withColumn("_sigma", F.when(F.col("_pairs") > k, F.sqrt(F.col("_left_sse") / (F.col("_pairs") - k))))
            .withColumn("_n", F.col("_pairs"))
            .withColumn("_half", F.lit(z) * _standard_error(F.col("_x") + horizon))
            .withColumn("_value", value)
            .withColumn(f"_result_{i}", F.struct(
                F.col("_value").alias("value"),
                (F.col("_value") - F.col("_half")).alias("prediction_interval_lower_bound"),
                (F.col("_value") + F.col("_half")).alias("prediction_interval_upper_bound")))
        )
        results.append(F.col(f"_result_{i}").alias(target))
    return out.filter(F.col("_x") > F.col("_last_x") - horizon).select(
        *series_cols, F.date_add(timestamp_col, horizon * step_days).alias(timestamp_col), *results)


def detect_anomalies(df: DataFrame, data_col: str, timestamp_col: str, history: Column,
                     inspect: Column, anomaly_prob_threshold: float = 0.95,
                     series_cols: Sequence[str] = (), step_days: int = 1,
                     season: int | None = None) -> DataFrame:
    """Compare the ``inspect`` rows of each series with the model of its ``history`` rows.

    Both parts are predicates on one series table, so it is computed once.
    """
    z_limit = normal_half_width(anomaly_prob_threshold)
    fitted = with_fit(df, data_col, timestamp_col, history, series_cols, step_days, season)
    y = F.col(data_col).cast("double")
    error = y - F.col("_expected")
    score = F.when(F.col("_se") > 0, two_sided_probability(error / F.col("_se"))).when(
        F.col("_se") == 0, F.when(error == 0, 0.0).otherwise(1.0))
    return (
        fitted.filter(inspect).withColumn("_se", _standard_error(F.col("_x")))
        .select(
            *series_cols, F.col(timestamp_col).alias("time_series_timestamp"),
            y.alias("time_series_data"),
            (F.col("_expected") - z_limit * F.col("_se")).alias("lower_bound"),
            (F.col("_expected") + z_limit * F.col("_se")).alias("upper_bound"),
            score.alias("anomaly_probability"))
        .withColumn("is_anomaly", F.coalesce(F.col("anomaly_probability") > anomaly_prob_threshold, F.lit(False)))
    )


def evaluate(df: DataFrame, data_col: str, timestamp_col: str, history: Column, actual: Column,
             series_cols: Sequence[str] = (), step_days: int = 1,
             season: int | None = None) -> DataFrame:
    """Error measures of the model fitted on ``history`` against the ``actual`` rows."""
    fitted = with_fit(df, data_col, timestamp_col, history, series_cols, step_days, season)
    y = F.when(actual, F.col(data_col).cast("double"))
    guess = F.col("_expected")
    size = F.abs(y) + F.abs(guess)
    errors = fitted.select(
        *series_cols, (y - guess).alias("_e"),
        F.try_divide(F.abs(y - guess), F.abs(y)).alias("_pct"),
        F.when(size == 0, 0.0).otherwise(2.0 * F.abs(y - guess) / size).alias("_spct"))
    return errors.groupBy(*series_cols).agg(
        F.avg(F.abs("_e")).alias("mean_absolute_error"),
        F.avg(F.pow("_e", F.lit(2))).alias("mean_squared_error"),
        F.sqrt(F.avg(F.pow("_e", F.lit(2)))).alias("root_mean_squared_error"),
        (100 * F.avg("_pct")).alias("mean_absolute_percentage_error"),
        (100 * F.avg(F.when(F.col("_e").isNotNull(), F.col("_spct"))))
        .alias("symmetric_mean_absolute_percentage_error"),
        F.when(F.count("_e") > 0, "").otherwise("no actual rows to compare with the forecast")
        .alias("ai_evaluate_status"))
