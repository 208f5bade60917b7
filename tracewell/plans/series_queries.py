"""Time-series and augmented-analytics queries over revenue, order and event series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewell.functions.columns import ERF_A, ERF_P, normal_half_width
from tracewell.functions.table_sql import register_table_functions
from tracewell.operators import augmented as aa
from tracewell.operators import timeseries as ts
from tracewell.operators.covariates import forecast_jointly
from tracewell.plans.graph_queries import STATS_SQL, customer_stats
from tracewell.plans.registry import ORACLES, query
from tracewell.sources.tables import Tables

WEEKLY_SQL = """
  weekly AS (
    SELECT l_returnflag AS flag, l_shipdate::DATE - dayofweek(l_shipdate::DATE)::INT AS ts,
           round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, count(*) AS n_lines
    FROM lineitem GROUP BY 1, 2)"""

DAILY_SQL = """
  present AS (SELECT o_orderpriority AS priority, o_orderdate::DATE AS ts,
                     round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1, 2),
  spine AS (SELECT priority, unnest(generate_series(min(ts)::TIMESTAMP, max(ts)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS ts
            FROM present GROUP BY 1),
  daily AS (SELECT priority, ts, coalesce(revenue, 0) AS revenue, revenue IS NULL AS is_filled
            FROM spine LEFT JOIN present USING (priority, ts))"""

EVENTS_SQL = """
  quality AS (
    SELECT ts::DATE AS day, (count(*) FILTER (event_type = 'error'))::DOUBLE AS errors,
           round(avg(value), 6) AS mean_value, count(*)::DOUBLE AS total
    FROM events GROUP BY 1)"""


def fit_sql(source: str, key: str, y: str, history: str, step: int, name: str = "fit") -> str:
    x = f"datediff('day', DATE '1970-01-04', ts) / {step}.0"
    return f"""
  {name} AS (
    SELECT {key}, count({y}) AS n, regr_slope({y}, {x}) AS b, regr_intercept({y}, {x}) AS a,
           avg({x}) AS xm, regr_sxx({y}, {x}) AS sxx, max(ts) AS last_ts,
           sqrt((regr_syy({y}, {x}) - regr_sxy({y}, {x}) ** 2 / regr_sxx({y}, {x})) / (count({y}) - 2)) AS sigma
    FROM {source} WHERE {history} GROUP BY 1)"""


def probability_sql(z: str) -> str:
    x = f"(abs({z}) / {2 ** 0.5!r})"
    t = f"(1.0 / (1.0 + {ERF_P} * {x}))"
    poly = "0.0"
    for a in reversed(ERF_A):
        poly = f"({poly} + ({a})) * {t}"
    return f"greatest(0.0, least(1.0, 1.0 - {poly} * exp(-{x} * {x})))"


def x_sql(ts_column: str, step: int) -> str:
    return f"(datediff('day', DATE '1970-01-04', {ts_column}) / {step}.0)"


def weekly_revenue(t: Tables) -> DataFrame:
    """Weekly revenue per return flag, weeks starting on Sunday."""
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return ts.bucket_series(
        t.lineitem.withColumnRenamed("l_returnflag", "flag"), F.col("l_shipdate"), "week",
        {"revenue": F.round(F.sum(revenue), 4), "n_lines": F.count(F.lit(1))}, ["flag"])


def daily_orders(t: Tables, regular: bool = True) -> DataFrame:
    """Daily order value per priority, with missing days as zero."""
    present = ts.bucket_series(
        t.orders.withColumnRenamed("o_orderpriority", "priority"), F.col("o_orderdate"), "day",
        {"revenue": F.round(F.sum("o_totalprice"), 2)}, ["priority"])
    return ts.regularize(present, "ts", ["revenue"], ["priority"]) if regular else present


def daily_events(t: Tables) -> DataFrame:
    """Per day: errors, mean value and number of all events."""
    return ts.bucket_series(
        t.events, F.col("ts"), "day",
        {"errors": F.count_if(F.col("event_type") == "error").cast("double"),
         "mean_value": F.round(F.avg("value"), 6), "total": F.count(F.lit(1)).cast("double")}, name="day")


def date_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("string") for n in names})


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


@query("weekly_series", sql=f"""
    WITH {WEEKLY_SQL} SELECT flag, ts::VARCHAR AS week_start, revenue, n_lines FROM weekly""")
def weekly_series(t: Tables):
    return weekly_revenue(t).select("flag", F.col("ts").cast("string").alias("week_start"), "revenue", "n_lines")


@query("series_gap_fill", sql=f"""
    WITH {DAILY_SQL} SELECT priority, ts::VARCHAR AS ts, revenue, is_filled FROM daily""")
def series_gap_fill(t: Tables):
    return date_text(daily_orders(t), "ts")


Z95 = normal_half_width(0.95)


@query("ts_forecast", sql=f"""
    WITH {WEEKLY_SQL}, {fit_sql("weekly", "flag", "revenue", "ts < DATE '2001-06-01'", 7)},
    future AS (SELECT *, (last_ts + 7 * h::INT) AS f FROM fit, unnest(generate_series(1, 8)) s(h)),
    v AS (SELECT *, a + b * {x_sql("f", 7)} AS value,
                 {Z95!r} * sigma * sqrt(1 + 1.0 / n + ({x_sql("f", 7)} - xm) ** 2 / sxx) AS half FROM future)
    SELECT flag, f::VARCHAR AS forecast_timestamp, round(value, 3) AS forecast_value,
           round(value - half, 3) AS prediction_interval_lower_bound,
           round(value + half, 3) AS prediction_interval_upper_bound FROM v""")
def ts_forecast(t: Tables):
    history = weekly_revenue(t).filter("ts < date '2001-06-01'")
    out = ts.forecast(history, "revenue", "ts", horizon=8, series_cols=["flag"], step_days=7)
    return rounded(date_text(out, "forecast_timestamp"), 3, "forecast_value",
                   "prediction_interval_lower_bound", "prediction_interval_upper_bound")


@query("ts_forecast_seasonal", sql=f"""
    WITH {DAILY_SQL}, {fit_sql("daily", "priority", "revenue", "true", 1)},
    residuals AS (SELECT priority, {x_sql("ts", 1)}::BIGINT % 7 AS phase, revenue - (a + b * {x_sql("ts", 1)}) AS r
                  FROM daily JOIN fit USING (priority)),
    phases AS (SELECT priority, phase, avg(r) AS m FROM residuals GROUP BY 1, 2),
    seasons AS (SELECT priority, phase, m - avg(m) OVER (PARTITION BY priority) AS s FROM phases),
    spread AS (SELECT priority, sqrt(sum((r - s) ** 2) / (count(*) - 8)) AS sd
               FROM residuals JOIN seasons USING (priority, phase) GROUP BY 1),
    future AS (SELECT *, (last_ts + h::INT) AS f, {x_sql("last_ts + h::INT", 1)} AS x
               FROM fit JOIN spread USING (priority), unnest(generate_series(1, 14)) g(h)),
    v AS (SELECT priority, f, a + b * x + s AS value,
                 {Z95!r} * sd * sqrt(1 + 1.0 / n + (x - xm) ** 2 / sxx) AS half
          FROM future JOIN seasons USING (priority) WHERE phase = x::BIGINT % 7)
    SELECT priority, f::VARCHAR AS forecast_timestamp, round(value, 3) AS forecast_value,
           round(value - half, 3) AS prediction_interval_lower_bound,
           round(value + half, 3) AS prediction_interval_upper_bound FROM v""")
def ts_forecast_seasonal(t: Tables):
    out = ts.forecast(daily_orders(t), "revenue", "ts", horizon=14, series_cols=["priority"], season=7)
    return rounded(date_text(out, "forecast_timestamp"), 3, "forecast_value",
                   "prediction_interval_lower_bound", "prediction_interval_upper_bound")


@query("ts_forecast_multi", sql=f"""
    WITH {WEEKLY_SQL}, {fit_sql("weekly", "flag", "revenue", "true", 7, "f1")},
    {fit_sql("weekly", "flag", "n_lines", "true", 7, "f2")},
    future AS (SELECT f1.flag AS flag, (f1.last_ts + 7 * h::INT) AS f, {x_sql("f1.last_ts + 7 * h::INT", 7)} AS x,
                 f1.a AS a1, f1.b AS b1, f1.n AS n1, f1.xm AS xm1, f1.sxx AS sxx1, f1.sigma AS s1,
                 f2.a AS a2, f2.b AS b2, f2.n AS n2, f2.xm AS xm2, f2.sxx AS sxx2, f2.sigma AS s2
               FROM f1 JOIN f2 USING (flag), unnest(generate_series(1, 4)) g(h))
    SELECT flag, f::VARCHAR AS week, round(a1 + b1 * x, 3) AS revenue,
           round(a1 + b1 * x + {Z95!r} * s1 * sqrt(1 + 1.0 / n1 + (x - xm1) ** 2 / sxx1), 3) AS revenue_upper,
           round(a2 + b2 * x, 5) AS n_lines,
           round(a2 + b2 * x + {Z95!r} * s2 * sqrt(1 + 1.0 / n2 + (x - xm2) ** 2 / sxx2), 5) AS n_lines_upper
    FROM future""")
def ts_forecast_multi(t: Tables):
    out = ts.forecast_multi(weekly_revenue(t), ["revenue", "n_lines"], "ts", 4, series_cols=["flag"], step_days=7)
    upper = "prediction_interval_upper_bound"
    return out.select(
        "flag", F.col("ts").cast("string").alias("week"), F.round("revenue.value", 3).alias("revenue"),
        F.round(f"revenue.{upper}", 3).alias("revenue_upper"), F.round("n_lines.value", 5).alias("n_lines"),
        F.round(f"n_lines.{upper}", 5).alias("n_lines_upper"))


def _covariate_sql(y: str, name: str) -> str:
    return f"""
    {name}_fit AS (SELECT regr_slope({y}, x) AS b, regr_intercept({y}, x) AS a, avg(x) AS xm,
                          regr_sxx({y}, x) AS sxx FROM indexed),
    {name}_res AS (SELECT x, {y} - (a + b * x) AS r, lagged FROM indexed, {name}_fit),
    {name}_cov AS (SELECT coalesce(regr_slope(r, lagged), 0) AS c, coalesce(regr_intercept(r, lagged), 0) AS c0
                   FROM {name}_res),
    {name}_sd AS (SELECT sqrt(sum((r - c0 - c * lagged) ** 2) / (count(lagged) - 3)) AS sd, count(lagged) AS m
                  FROM {name}_res, {name}_cov),
    {name}_out AS (
      SELECT day + 5 AS day, a + b * (x + 5) + c0 + c * total AS value,
             {Z95!r} * sd * sqrt(1 + 1.0 / m + (x + 5 - xm) ** 2 / sxx) AS half
      FROM indexed, {name}_fit, {name}_cov, {name}_sd WHERE x > (SELECT max(x) - 5 FROM indexed))"""


@query("ts_forecast_cov", sql=f"""
    WITH {EVENTS_SQL},
    indexed AS (SELECT *, datediff('day', DATE '1970-01-04', day)::DOUBLE AS x,
                       lag(total, 5) OVER (ORDER BY day) AS lagged FROM quality),
    {_covariate_sql("errors", "e")}, {_covariate_sql("mean_value", "v")}
    SELECT e_out.day::VARCHAR AS day, round(e_out.value, 5) AS errors, round(e_out.value + e_out.half, 5) AS errors_upper,
           round(v_out.value, 5) AS mean_value, round(v_out.value + v_out.half, 5) AS mean_value_upper
    FROM e_out JOIN v_out USING (day)""")
def ts_forecast_cov(t: Tables):
    out = ts.forecast_with_covariates(daily_events(t), ["errors", "mean_value"], ["total"], "day", horizon=5)
    upper = "prediction_interval_upper_bound"
    return out.select(
        F.col("day").cast("string").alias("day"), F.round("errors.value", 5).alias("errors"),
        F.round(f"errors.{upper}", 5).alias("errors_upper"), F.round("mean_value.value", 5).alias("mean_value"),
        F.round(f"mean_value.{upper}", 5).alias("mean_value_upper"))


@query("ts_forecast_joint", sql=f"""
    WITH {EVENTS_SQL},
    r AS (SELECT day, datediff('day', DATE '1970-01-04', day)::DOUBLE AS x, lag(total, 5) OVER (ORDER BY day) AS p,
                 mean_value AS f, CASE WHEN day <= max(day) OVER () - 5 THEN errors END AS y FROM quality),
    m AS (SELECT count(*) AS n, avg(x) AS mx, avg(p) AS mp, avg(f) AS mf, avg(y) AS my FROM r WHERE p + f + y IS NOT NULL),
    c AS (SELECT day, x - mx AS x, p - mp AS p, f - mf AS f, y - my AS y, my, n FROM r, m),
    s AS (SELECT sum(x * x) AS xx, sum(x * p) AS xp, sum(x * f) AS xf, sum(p * p) AS pp, sum(p * f) AS pf, sum(f * f) AS ff,
                 sum(x * y) AS xy, sum(p * y) AS py, sum(f * y) AS fy, sum(y * y) AS yy FROM c WHERE p + f + y IS NOT NULL),
    d AS (SELECT *, xx * (pp * ff - pf * pf) - xp * (xp * ff - pf * xf) + xf * (xp * pf - pp * xf) AS det FROM s),
    i AS (SELECT *, (pp * ff - pf * pf) / det AS a, (xf * pf - xp * ff) / det AS b, (xp * pf - xf * pp) / det AS e,
                 (xx * ff - xf * xf) / det AS g, (xp * xf - xx * pf) / det AS h, (xx * pp - xp * xp) / det AS k FROM d),
    o AS (SELECT *, a * xy + b * py + e * fy AS bx, b * xy + g * py + h * fy AS bp, e * xy + h * py + k * fy AS bf FROM i),
    v AS (SELECT day, my + bx * x + bp * p + bf * f AS value,
                 {Z95!r} * sqrt((yy - bx * xy - bp * py - bf * fy) / (n - 4))
                 * sqrt(1 + 1.0 / n + a * x * x + g * p * p + k * f * f + 2 * (b * x * p + e * x * f + h * p * f)) AS half
          FROM c, o WHERE y IS NULL)
    SELECT day::VARCHAR AS day, round(value, 5) AS errors, round(value - half, 5) AS errors_lower,
           round(value + half, 5) AS errors_upper FROM v""")
def ts_forecast_joint(t: Tables):
    """Errors of the last five days from all events five days before and that day's mean value, fitted together."""
    days = daily_events(t)
    last = F.max("day").over(Window.partitionBy())
    known = days.withColumn("errors", F.when(F.col("day") <= F.date_sub(last, 5), F.col("errors")))
    out = forecast_jointly(known, "errors", "day", 5, past_cols=["total"], future_cols=["mean_value"])
    return out.select(
        F.col("forecast_timestamp").cast("string").alias("day"), F.round("forecast_value", 5).alias("errors"),
        F.round("prediction_interval_lower_bound", 5).alias("errors_lower"),
        F.round("prediction_interval_upper_bound", 5).alias("errors_upper"))


Z80 = normal_half_width(0.80)


@query("ts_anomalies", sql=f"""
    WITH {WEEKLY_SQL}, {fit_sql("weekly", "flag", "revenue", "ts < DATE '2000-01-01'", 7)},
    scored AS (SELECT flag, ts, revenue AS y, a + b * {x_sql("ts", 7)} AS e,
                      sigma * sqrt(1 + 1.0 / n + ({x_sql("ts", 7)} - xm) ** 2 / sxx) AS se
               FROM weekly JOIN fit USING (flag) WHERE ts BETWEEN DATE '2000-01-01' AND DATE '2001-12-31'),
    p AS (SELECT *, {probability_sql("(y - e) / se")} AS probability FROM scored)
    SELECT flag, ts::VARCHAR AS time_series_timestamp, y AS time_series_data,
           round(e - {Z80!r} * se, 3) AS lower_bound, round(e + {Z80!r} * se, 3) AS upper_bound,
           round(probability, 6) AS anomaly_probability, probability > 0.8 AS is_anomaly FROM p""")
def ts_anomalies(t: Tables):
    out = ts.detect_anomalies(
        weekly_revenue(t), "revenue", "ts", F.expr("ts < date '2000-01-01'"),
        F.expr("ts BETWEEN date '2000-01-01' AND date '2001-12-31'"), 0.80, ["flag"], step_days=7)
    out = rounded(date_text(out, "time_series_timestamp"), 3, "lower_bound", "upper_bound")
    return rounded(out, 6, "anomaly_probability")


@query("sql_forecast", sql=ORACLES["ts_forecast"])
def sql_forecast(t: Tables):
    """The forecast of ``ts_forecast``, called from SQL as a table function."""
    register_table_functions(t.spark)
    weekly_revenue(t).filter("ts < date '2001-06-01'").createOrReplaceTempView("weekly_history")
    return t.spark.sql("""
        SELECT flag, CAST(forecast_timestamp AS STRING) AS forecast_timestamp, round(forecast_value, 3) AS forecast_value,
               round(prediction_interval_lower_bound, 3) AS prediction_interval_lower_bound,
               round(prediction_interval_upper_bound, 3) AS prediction_interval_upper_bound
        FROM forecast(TABLE(weekly_history) PARTITION BY flag, data_col => 'revenue', timestamp_col => 'ts',
                      id_cols => 'flag', horizon => 8, step_days => 7)""")


@query("sql_anomalies", sql=ORACLES["ts_anomalies"])
def sql_anomalies(t: Tables):
    """The anomalies of ``ts_anomalies``, called from SQL as a table function."""
    register_table_functions(t.spark)
    weekly_revenue(t).createOrReplaceTempView("weekly_all")
    return t.spark.sql("""
        SELECT flag, CAST(time_series_timestamp AS STRING) AS time_series_timestamp, time_series_data,
               round(lower_bound, 3) AS lower_bound, round(upper_bound, 3) AS upper_bound,
               round(anomaly_probability, 6) AS anomaly_probability, is_anomaly
        FROM detect_anomalies(TABLE(weekly_all) PARTITION BY flag, data_col => 'revenue', timestamp_col => 'ts',
                              id_cols => 'flag', inspect_from => '2000-01-01', inspect_to => '2001-12-31',
                              step_days => 7, anomaly_prob_threshold => 0.80D)""")


@query("ts_evaluate", sql=f"""
    WITH {WEEKLY_SQL}, {fit_sql("weekly", "flag", "revenue", "ts < DATE '2000-06-01'", 7)},
    pairs AS (SELECT flag, revenue AS y, a + b * {x_sql("ts", 7)} AS g FROM weekly JOIN fit USING (flag)
              WHERE ts BETWEEN DATE '2000-06-01' AND DATE '2000-08-31')
    SELECT flag, round(avg(abs(y - g)), 3) AS mean_absolute_error,
           round(sqrt(avg((y - g) ** 2)), 3) AS root_mean_squared_error,
           round(100 * avg(abs((y - g) / nullif(y, 0))), 6) AS mean_absolute_percentage_error,
           round(100 * avg(coalesce(2 * abs(y - g) / nullif(abs(y) + abs(g), 0), 0)), 6)
             AS symmetric_mean_absolute_percentage_error,
           '' AS ai_evaluate_status FROM pairs GROUP BY 1""")
def ts_evaluate(t: Tables):
    out = ts.evaluate(weekly_revenue(t), "revenue", "ts", F.expr("ts < date '2000-06-01'"),
                      F.expr("ts BETWEEN date '2000-06-01' AND date '2000-08-31'"), ["flag"], step_days=7)
    out = rounded(out.drop("mean_squared_error"), 3, "mean_absolute_error", "root_mean_squared_error")
    return rounded(out, 6, "mean_absolute_percentage_error", "symmetric_mean_absolute_percentage_error")


def segments_sql(source: str, key: str, y: str, penalty: float, min_length: int) -> str:
    """Binary segmentation to the end, by recursion over segments (lo, hi] of row numbers: ``regimes``, ``leveled``."""
    return f"""
    numbered AS (SELECT {key}, ts, {y} AS y, row_number() OVER w AS i, sum({y}) OVER (w ROWS UNBOUNDED PRECEDING) AS upto,
                        {y} - lag({y}) OVER w AS d FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY ts)),
    sums AS (SELECT {key}, i, upto FROM numbered UNION ALL SELECT DISTINCT {key}, 0, 0 FROM numbered),
    limits AS (SELECT {key}, {penalty} * sum(d * d) / (2.0 * (count(*) - 1)) * ln(count(*)) AS lim, max(i) AS n
               FROM numbered GROUP BY 1),
    segment AS (
      SELECT {key}, 0::BIGINT AS lo, n AS hi FROM limits
      UNION ALL
      SELECT {key}, CASE WHEN side = 0 THEN lo ELSE cut END, CASE WHEN side = 0 THEN cut ELSE hi END
      FROM (SELECT {key}, lo, hi, arg_min(i, (-gain, i)) AS cut, max(gain) AS gain FROM (
              SELECT g.{key} AS {key}, g.lo AS lo, g.hi AS hi, m.i AS i,
                     (m.i - g.lo) * (g.hi - m.i) / (g.hi - g.lo)::DOUBLE
                     * ((m.upto - a.upto) / (m.i - g.lo) - (b.upto - m.upto) / (g.hi - m.i)) ** 2 AS gain
              FROM segment g JOIN sums a ON a.{key} = g.{key} AND a.i = g.lo JOIN sums b ON b.{key} = g.{key} AND b.i = g.hi
                JOIN sums m ON m.{key} = g.{key} AND m.i >= g.lo + {min_length} AND m.i <= g.hi - {min_length})
            GROUP BY 1, 2, 3) JOIN limits USING ({key}), (VALUES (0), (1)) v(side) WHERE gain > lim),
    regimes AS (SELECT {key}, lo, min(hi) AS hi FROM segment GROUP BY 1, 2),
    leveled AS (SELECT r.{key} AS {key}, lo AS seg, ts, y, avg(y) OVER (PARTITION BY r.{key}, lo) AS level
                FROM regimes r JOIN numbered m ON m.{key} = r.{key} AND i > lo AND i <= hi)"""


@query("ts_change_points", sql=f"""
    WITH RECURSIVE {DAILY_SQL}, {segments_sql("daily", "priority", "revenue", 1.0, 7)}
    SELECT priority, min(ts)::VARCHAR AS begin_timestamp, max(ts)::VARCHAR AS end_timestamp, count(*) AS n_days,
           round(avg(y), 3) AS mean_value, min(y) AS min_value, max(y) AS max_value
    FROM leveled GROUP BY priority, seg""")
def ts_change_points(t: Tables):
    out = aa.detect_change_points(daily_orders(t), "revenue", "ts", ["priority"], penalty=1.0)
    return date_text(out, "begin_timestamp", "end_timestamp").select(
        "priority", "begin_timestamp", "end_timestamp", F.col("metrics.count").alias("n_days"),
        F.round("metrics.avg", 3).alias("mean_value"), F.col("metrics.min").alias("min_value"),
        F.col("metrics.max").alias("max_value"))


def season_sql(name: str, phase: str, rows: int) -> str:
    half = rows // 2
    return f"""
    {name}_off AS (SELECT *, {phase} AS phase, CASE WHEN count(*) OVER w = {rows} THEN revenue - avg(revenue) OVER w END AS off
        FROM daily WINDOW w AS (PARTITION BY priority ORDER BY ts ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)),
    {name}_phase AS (SELECT priority, phase, avg(off) AS m FROM {name}_off GROUP BY 1, 2),
    {name}_s AS (SELECT priority, phase, m - avg(m) OVER (PARTITION BY priority) AS s FROM {name}_phase)"""


@query("ts_seasonality", sql=f"""
    WITH {DAILY_SQL}, {season_sql("weekly", "dayofweek(ts)", 7)}, {season_sql("yearly", "month(ts)", 365)}
    SELECT priority, ts::VARCHAR AS ts, strftime(ts, '%A') AS day_name, revenue, round(w.s, 3) AS weekly,
           round(y.s, 3) AS yearly
    FROM daily JOIN weekly_s w USING (priority) JOIN yearly_s y USING (priority)
    WHERE w.phase = dayofweek(ts) AND y.phase = month(ts)""")
def ts_seasonality(t: Tables):
    out = aa.seasonality(daily_orders(t), "revenue", "ts", ["priority"], ["weekly", "yearly"])
    return out.select("priority", F.col("ts").cast("string").alias("ts"), F.date_format("ts", "EEEE").alias("day_name"),
                      "revenue", F.round("weekly", 3).alias("weekly"), F.round("yearly", 3).alias("yearly"))


JOINT = {"weekly": "dayofweek(ts)", "monthly": "dayofmonth(ts)", "yearly": "month(ts)"}


def joint_season_sql(rounds: int) -> str:
    """``fitted``: (priority, phases, components) after so many rounds of fitting each to what the others leave."""
    phases = ", ".join(f"{p} AS {name}_phase" for name, p in JOINT.items())
    keys = ", ".join(f"{name}_phase" for name in JOINT)
    out = [f"""
    off AS (SELECT *, {phases}, CASE WHEN count(*) OVER w = 365 THEN revenue - avg(revenue) OVER w END AS off
            FROM daily WINDOW w AS (PARTITION BY priority ORDER BY ts ROWS BETWEEN 182 PRECEDING AND 182 FOLLOWING)),
    fit_0 AS (SELECT priority, {keys}, sum(off) AS s, count(off) AS n, {", ".join(f"0.0::DOUBLE AS {c}" for c in JOINT)}
              FROM off WHERE off IS NOT NULL GROUP BY ALL)"""]
    steps = [name for _ in range(rounds) for name in JOINT]
    for i, name in enumerate(steps):
        others = " + ".join(c for c in JOINT if c != name)
        same = f"(PARTITION BY priority, {name}_phase)"
        out.append(f"""
    mean_{i} AS (SELECT *, sum(s - n * ({others})) OVER {same} / sum(n) OVER {same} AS m, 1.0::DOUBLE / count(*) OVER {same} AS w
                 FROM fit_{i}),
    fit_{i + 1} AS (SELECT * EXCLUDE (m, w) REPLACE (m - sum(m * w) OVER (PARTITION BY priority)
                                                     / sum(w) OVER (PARTITION BY priority) AS {name}) FROM mean_{i})""")
    return ",".join(out) + f", fitted AS (SELECT * FROM fit_{len(steps)})"


@query("ts_joint_seasons", sql=f"""
    WITH {DAILY_SQL}, {joint_season_sql(5)},
    {", ".join(f"{c}_s AS (SELECT priority, {c}_phase, first({c}) AS {c} FROM fitted GROUP BY ALL)" for c in JOINT)}
    SELECT priority, ts::VARCHAR AS ts, {", ".join(f"round({c}, 3) AS {c}" for c in JOINT)},
           round(off - {" - ".join(JOINT)}, 3) AS remainder
    FROM off {" ".join(f"LEFT JOIN {c}_s USING (priority, {c}_phase)" for c in JOINT)}""")
def ts_joint_seasons(t: Tables):
    """Weekly, monthly and yearly components of daily order value, each fitted to what the others leave."""
    out = aa.joint_seasonality(daily_orders(t), "revenue", "ts", ["priority"], list(JOINT), rounds=5)
    return rounded(date_text(out, "ts"), 3, *JOINT, "remainder").select("priority", "ts", *JOINT, "remainder")


@query("ts_hourly_season", sql="""
    WITH present AS (SELECT event_type, date_trunc('hour', ts) AS ts, sum(CAST(value AS DECIMAL(18, 2)))::DOUBLE AS total
                     FROM events GROUP BY 1, 2),
    spine AS (SELECT event_type, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM present GROUP BY 1),
    hourly AS (SELECT s.event_type AS event_type, s.ts AS ts, coalesce(total, 0) AS total, total IS NULL AS is_filled
               FROM spine s LEFT JOIN present p ON p.event_type = s.event_type AND p.ts = s.ts),
    off AS (SELECT *, hour(ts) AS phase, CASE WHEN count(*) OVER w = 25 THEN total - avg(total) OVER w END AS off
            FROM hourly WINDOW w AS (PARTITION BY event_type ORDER BY ts ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING)),
    phases AS (SELECT event_type, phase, avg(off) AS m FROM off GROUP BY 1, 2),
    season AS (SELECT event_type, phase, m - avg(m) OVER (PARTITION BY event_type) AS daily FROM phases)
    SELECT o.event_type AS event_type, strftime(ts, '%Y-%m-%d %H') AS hour, round(total, 4) AS total, is_filled,
           round(daily, 9) AS daily
    FROM off o JOIN season s ON s.event_type = o.event_type AND s.phase = o.phase""")
def ts_hourly_season(t: Tables):
    """Hourly totals per event type, gaps filled, with their within-day component.

    Values have two digits and are summed as decimals, so that nothing depends on
    their order; the component is reported at a digit that means of them do not end on.
    """
    value = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    hourly = ts.bucket_series(t.events, F.col("ts"), "hour", {"total": value}, ["event_type"])
    filled = ts.regularize(hourly, "ts", ["total"], ["event_type"], step="1 hour")
    out = aa.seasonality(filled, "total", "ts", ["event_type"], ["daily"])
    return out.select("event_type", F.date_format("ts", "yyyy-MM-dd HH").alias("hour"),
                      F.round("total", 4).alias("total"), "is_filled", F.round("daily", 9).alias("daily"))


@query("ts_trend", sql=f"""
    WITH RECURSIVE {DAILY_SQL}, {season_sql("weekly", "dayofweek(ts)", 7)},
    {segments_sql("daily", "priority", "revenue", 3.0, 7)},
    smooth AS (SELECT l.priority AS priority, ts, y, level + avg(y - s - level) OVER (PARTITION BY l.priority ORDER BY ts
                 ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS trend,
                 row_number() OVER (PARTITION BY l.priority ORDER BY ts DESC) AS recent
               FROM leveled l JOIN weekly_s s ON s.priority = l.priority AND s.phase = dayofweek(ts)),
    line AS (SELECT priority, regr_slope(trend, {x_sql("ts", 1)}) AS b, regr_intercept(trend, {x_sql("ts", 1)}) AS a,
                    max(ts) AS last_ts FROM smooth WHERE recent <= 28 GROUP BY 1),
    ahead AS (SELECT priority, last_ts + h::INT AS f, a + b * {x_sql("last_ts + h::INT", 1)} AS v
              FROM line, unnest(generate_series(1, 7)) g(h))
    SELECT priority, ts::VARCHAR AS ts, 'history' AS time_series_type, round(y, 3) AS revenue, round(trend, 3) AS trend
    FROM smooth
    UNION ALL SELECT a.priority, f::VARCHAR, 'forecast', round(v + s, 3), round(v, 3)
    FROM ahead a JOIN weekly_s s ON s.priority = a.priority AND s.phase = dayofweek(f)""")
def ts_trend(t: Tables):
    out = aa.trend(daily_orders(t), "revenue", "ts", horizon=7, smoothing_window_size=7,
                   adjust_step_changes=True, series_cols=["priority"], fit_rows=28)
    return rounded(date_text(out, "ts"), 3, "revenue", "trend")


DRIVER_FACTS_SQL = """
  facts AS (
    SELECT p_brand AS brand, c_mktsegment AS segment, r_name AS region,
           CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4)) AS refund,
           l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01' AS in_window
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
      JOIN part ON p_partkey = l_partkey JOIN nation ON n_nationkey = c_nationkey
      JOIN region ON r_regionkey = n_regionkey
    WHERE l_returnflag = 'R')"""


def drivers_sql(source: str, dims: list[str], metric: str, label: str, support: float, top: int) -> str:
    names = ", ".join(f"CASE WHEN grouping({d}) = 0 THEN '{d}=' || {d} END" for d in dims)
    return f"""
    sums AS (SELECT list_sort(list_filter([{names}], lambda v: v IS NOT NULL)) AS drivers,
               sum(CASE WHEN {label} THEN {metric} ELSE 0 END) AS mi, sum(CASE WHEN {label} THEN 0 ELSE {metric} END) AS mr
             FROM {source} GROUP BY CUBE ({", ".join(dims)}) HAVING {" + ".join(f"grouping({d})" for d in dims)} < {len(dims)}),
    totals AS (SELECT sum(CASE WHEN {label} THEN {metric} ELSE 0 END) AS ti,
                      sum(CASE WHEN {label} THEN 0 ELSE {metric} END) AS tr FROM {source}),
    scored AS (SELECT drivers, mi, mr, (mi - mr) / nullif(mr, 0) AS rel,
                 mi - coalesce(mr * ((ti - mi) / nullif(tr - mr, 0)), mr) AS unexpected,
                 greatest(mi / nullif(ti, 0), mr / nullif(tr, 0)) AS support FROM sums, totals),
    best AS (SELECT * FROM scored WHERE support >= {support} ORDER BY abs(unexpected) DESC, drivers LIMIT {top})
    SELECT array_to_string(drivers, ' & ') AS drivers, round(mi, 4)::DOUBLE AS metric_interest,
           round(mr, 4)::DOUBLE AS metric_reference, round(rel, 6) AS relative_difference,
           round(unexpected, 3) AS unexpected_difference, round(support, 6) AS apriori_support FROM best"""


def driver_report(out: DataFrame) -> DataFrame:
    out = out.withColumn("drivers", F.array_join("drivers", " & "))
    out = rounded(rounded(out, 4, "metric_interest", "metric_reference"), 3, "unexpected_difference")
    out = out.withColumns({c: F.col(c).cast("double") for c in ("metric_interest", "metric_reference")})
    return rounded(out, 6, "relative_difference", "apriori_support")


@query("key_drivers", sql=f"""
    WITH {DRIVER_FACTS_SQL}, {drivers_sql("facts", ["brand", "segment", "region"], "refund", "in_window", 0.02, 10)}""")
def key_drivers(t: Tables):
    """Which brands, segments and regions drove refunds of one year against the others."""
    ship = F.col("l_shipdate")
    in_window = (ship >= F.lit("1998-01-01").cast("timestamp_ntz")) & (ship < F.lit("1999-01-01").cast("timestamp_ntz"))
    facts = (
        t.lineitem.filter("l_returnflag = 'R'").select(
            F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias("refund"),
            in_window.alias("in_window"))
        .join(t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")), "o_orderkey")
        .join(t.customer.select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("segment")), "c_custkey")
        .join(t.part.select("p_partkey", F.col("p_brand").alias("brand")), "p_partkey")
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
        .withColumnRenamed("r_name", "region")
    )
    return driver_report(aa.key_drivers(facts, "refund", ["brand", "segment", "region"], "in_window",
                                        top_k=10, min_support=0.02))


@query("station_key_drivers", sql=f"""
    WITH facts AS (
      SELECT p_type AS kind, p_brand AS brand, l_linestatus AS line, r_name AS region,
             CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS defect, n_name = 'NATION_3' AS at_station
      FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
        JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey),
    {drivers_sql("facts", ["kind", "brand", "line", "region"], "defect", "at_station", 0.1, 5)}""")
def station_key_drivers(t: Tables):
    """Segments whose defects differ most between one station and the rest."""
    facts = (
        t.lineitem.select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"),
                          F.col("l_linestatus").alias("line"),
                          F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("defect"))
        .join(t.part.select("p_partkey", F.col("p_type").alias("kind"), F.col("p_brand").alias("brand")), "p_partkey")
        .join(t.supplier.select("s_suppkey", "s_nationkey"), "s_suppkey")
        .join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
        .join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
        .select("kind", "brand", "line", F.col("r_name").alias("region"), "defect",
                (F.col("n_name") == "NATION_3").alias("at_station"))
    )
    return driver_report(aa.key_drivers(facts, "defect", ["kind", "brand", "line", "region"], "at_station",
                                        top_k=5, min_support=0.1))


WIDE_DIMENSIONS = {
    "brand": "p_brand", "kind": "p_type", "size": "floor((p_size - 1) / 10)::INT", "segment": "c_mktsegment",
    "region": "r_name", "priority": "o_orderpriority", "status": "o_orderstatus", "balance": "floor(c_acctbal / 2500)::INT",
    "line": "l_linestatus", "discount": "floor(l_discount * 100 + 0.5)::INT", "tax": "floor(l_tax * 100 + 0.5)::INT",
    "quarter": "quarter(l_shipdate)",
}


def supported_sql(support: float, top: int) -> str:
    """The drivers among all supported segments of ``facts``, grown item by item in every row."""
    sums = "sum(i) OVER (PARTITION BY {0}) AS mi, sum(r) OVER (PARTITION BY {0}) AS mr"
    enough = f"greatest(mi / ti, mr / tr) >= {support}"
    pairs = ", ".join(f"{{'d': {i}, 'name': '{name}=' || {name}}}" for i, name in enumerate(WIDE_DIMENSIONS))
    return f"""
    cells AS (SELECT row_number() OVER () AS cell, * FROM (
      SELECT {", ".join(WIDE_DIMENSIONS)}, sum(CASE WHEN in_window THEN refund ELSE 0 END) AS i,
             sum(CASE WHEN in_window THEN 0 ELSE refund END) AS r FROM facts GROUP BY ALL)),
    totals AS (SELECT sum(i) AS ti, sum(r) AS tr FROM cells),
    items AS (SELECT cell, x.d AS d, x.name AS name, i, r FROM (SELECT cell, i, r, unnest([{pairs}]) AS x FROM cells)),
    inside(cell, segment, d, i, r) AS (
      SELECT cell, [name], d, i, r FROM (SELECT *, {sums.format("name")} FROM items), totals WHERE {enough}
      UNION ALL
      SELECT cell, segment, d, i, r FROM (
        SELECT *, {sums.format("segment")} FROM (
          SELECT n.cell AS cell, list_append(n.segment, it.name) AS segment, it.d AS d, n.i AS i, n.r AS r
          FROM inside n JOIN items it ON it.cell = n.cell AND it.d > n.d)), totals WHERE {enough}),
    sums AS (SELECT list_sort(segment) AS drivers, sum(i) AS mi, sum(r) AS mr FROM inside GROUP BY segment),
    scored AS (SELECT drivers, mi, mr, (mi - mr) / nullif(mr, 0) AS rel,
                 mi - coalesce(mr * ((ti - mi) / nullif(tr - mr, 0)), mr) AS unexpected,
                 greatest(mi / nullif(ti, 0), mr / nullif(tr, 0)) AS support FROM sums, totals)
    SELECT array_to_string(drivers, ' & ') AS drivers, round(mi, 4)::DOUBLE AS metric_interest,
           round(mr, 4)::DOUBLE AS metric_reference, round(rel, 6) AS relative_difference,
           round(unexpected, 3) AS unexpected_difference, round(support, 6) AS apriori_support
    FROM scored ORDER BY abs(unexpected) DESC, drivers LIMIT {top}"""


@query("wide_key_drivers", sql=f"""
    WITH RECURSIVE facts AS (
      SELECT {", ".join(f"{e} AS {name}" for name, e in WIDE_DIMENSIONS.items())},
             CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4)) AS refund,
             l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01' AS in_window
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN part ON p_partkey = l_partkey JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey WHERE l_returnflag = 'R'),
    {supported_sql(0.1, 20)}""")
def wide_key_drivers(t: Tables):
    """Segments of twelve dimensions whose refunds of one year differ most from the other years."""
    ship = F.col("l_shipdate")
    in_window = (ship >= F.lit("1998-01-01").cast("timestamp_ntz")) & (ship < F.lit("1999-01-01").cast("timestamp_ntz"))
    percent = {name: F.floor(F.col(f"l_{name}") * 100 + 0.5).cast("int").alias(name) for name in ("discount", "tax")}
    facts = (
        t.lineitem.filter("l_returnflag = 'R'").select(
            "l_orderkey", "l_partkey", F.col("l_linestatus").alias("line"),
            *percent.values(), F.quarter(ship).alias("quarter"), in_window.alias("in_window"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias("refund"))
        .join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"),
                              F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")), "l_orderkey")
        .join(t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), F.col("c_mktsegment").alias("segment"),
                                F.floor(F.col("c_acctbal") / 2500).cast("int").alias("balance")), "c_custkey")
        .join(t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"),
                            F.col("p_type").alias("kind"),
                            F.floor((F.col("p_size") - 1) / 10).cast("int").alias("size")), "l_partkey")
        .join(t.nation.select("n_nationkey", F.col("n_regionkey").alias("r_regionkey")), "n_nationkey")
        .join(t.region.select("r_regionkey", F.col("r_name").alias("region")), "r_regionkey")
    )
    return driver_report(aa.supported_drivers(facts, "refund", list(WIDE_DIMENSIONS), "in_window", top_k=20, min_support=0.1))


CUTOFF = "2000-01-01"


@query("causal_effect", sql=f"""
    WITH {DAILY_SQL}, {fit_sql("daily", "priority", "revenue", f"ts < DATE '{CUTOFF}'", 1)},
    after AS (SELECT priority, sum(revenue - (a + b * {x_sql("ts", 1)})) AS effect,
                sum(a + b * {x_sql("ts", 1)}) AS expected, count(*) AS m, avg({x_sql("ts", 1)}) AS xa
              FROM daily JOIN fit USING (priority) WHERE ts >= DATE '{CUTOFF}' GROUP BY 1),
    p AS (SELECT priority, effect, expected,
            effect / (sigma * sqrt(m + m * m * (1.0 / n + (xa - xm) ** 2 / sxx))) AS z FROM after JOIN fit USING (priority))
    SELECT priority, round({probability_sql("z")}, 6) AS prob_causal_effect, round(1 - {probability_sql("z")}, 6) AS p_value,
           round(effect, 2) AS absolute_effect, round(effect / expected, 8) AS relative_effect FROM p""")
def causal_effect(t: Tables):
    out = aa.causal_effect(daily_orders(t), "revenue", "ts", F.lit(CUTOFF).cast("date"), ["priority"])
    out = rounded(out, 6, "prob_causal_effect", "p_value")
    return rounded(rounded(out, 2, "absolute_effect"), 8, "relative_effect")


@query("causal_effect_series", sql=f"""
    WITH {DAILY_SQL}, {fit_sql("daily", "priority", "revenue", f"ts < DATE '{CUTOFF}'", 1)},
    points AS (SELECT priority, ts, revenue, a + b * {x_sql("ts", 1)} AS c,
                 CASE WHEN ts >= DATE '{CUTOFF}' THEN revenue - (a + b * {x_sql("ts", 1)}) END AS e
               FROM daily JOIN fit USING (priority))
    SELECT priority, ts::VARCHAR AS ts, revenue, round(c, 3) AS counterfactual, round(e, 3) AS point_effect,
           round(sum(e) OVER (PARTITION BY priority ORDER BY ts ROWS UNBOUNDED PRECEDING), 2) AS cumulative_effect
    FROM points""")
def causal_effect_series(t: Tables):
    out = aa.causal_effect(daily_orders(t), "revenue", "ts", F.lit(CUTOFF).cast("date"), ["priority"],
                           output_time_series=True)
    out = rounded(date_text(out.drop("is_filled"), "ts"), 3, "counterfactual", "point_effect")
    return rounded(out, 2, "cumulative_effect")


@query("correlation", sql=f"""
    WITH {STATS_SQL}, base AS (
      SELECT c_mktsegment AS segment, n_orders, n_returns, total_refunds
      FROM cust_stats JOIN customer ON c_custkey = customer)
    SELECT segment, 'n_orders' AS corr_col, 'n_returns' AS target_col, round(corr(n_returns, n_orders), 8) AS correlation,
           count(*) AS segment_size FROM base GROUP BY 1
    UNION ALL SELECT segment, 'total_refunds', 'n_returns', round(corr(n_returns, total_refunds), 8), count(*)
    FROM base GROUP BY 1""")
def correlation(t: Tables):
    base = customer_stats(t).join(
        t.customer.select(F.col("c_custkey").alias("member"), F.col("c_mktsegment").alias("segment")), "member")
    return rounded(aa.correlation(base, "n_returns", ["n_orders", "total_refunds"], ["segment"]), 8, "correlation")


@query("correlation_spearman", sql=f"""
    WITH {STATS_SQL}, ranks AS (
      SELECT rank() OVER (ORDER BY n_returns) + (count(*) OVER (PARTITION BY n_returns) - 1) / 2.0 AS rt,
             rank() OVER (ORDER BY n_orders) + (count(*) OVER (PARTITION BY n_orders) - 1) / 2.0 AS ro,
             rank() OVER (ORDER BY total_refunds) + (count(*) OVER (PARTITION BY total_refunds) - 1) / 2.0 AS rr
      FROM cust_stats)
    SELECT 'n_orders' AS corr_col, 'n_returns' AS target_col, round(corr(rt, ro), 8) AS correlation,
           count(*) AS segment_size FROM ranks
    UNION ALL SELECT 'total_refunds', 'n_returns', round(corr(rt, rr), 8), count(*) FROM ranks""")
def correlation_spearman(t: Tables):
    out = aa.correlation(customer_stats(t), "n_returns", ["n_orders", "total_refunds"], method="spearman")
    return rounded(out, 8, "correlation")


DAY_SPLIT = "2024-01-24"


@query("daily_error_anomalies", sql=f"""
    WITH {EVENTS_SQL}, s AS (SELECT 0 AS k, day AS ts, errors FROM quality),
    {fit_sql("s", "k", "errors", f"ts < DATE '{DAY_SPLIT}'", 1)},
    scored AS (SELECT ts, errors AS y, a + b * {x_sql("ts", 1)} AS e,
                      sigma * sqrt(1 + 1.0 / n + ({x_sql("ts", 1)} - xm) ** 2 / sxx) AS se
               FROM s JOIN fit USING (k) WHERE ts >= DATE '{DAY_SPLIT}'),
    p AS (SELECT *, {probability_sql("(y - e) / se")} AS probability FROM scored)
    SELECT ts::VARCHAR AS day, y AS errors, round(e - {normal_half_width(0.70)!r} * se, 5) AS expected_min,
           round(e + {normal_half_width(0.70)!r} * se, 5) AS expected_max,
           round(probability, 6) AS anomaly_probability FROM p WHERE probability > 0.7""")
def daily_error_anomalies(t: Tables):
    """Days with more or fewer errors than the earlier days led to expect."""
    out = ts.detect_anomalies(daily_events(t), "errors", "day", F.expr(f"day < date '{DAY_SPLIT}'"),
                              F.expr(f"day >= date '{DAY_SPLIT}'"), 0.70)
    return out.filter("is_anomaly").select(
        F.col("time_series_timestamp").cast("string").alias("day"), F.col("time_series_data").alias("errors"),
        F.round("lower_bound", 5).alias("expected_min"), F.round("upper_bound", 5).alias("expected_max"),
        F.round("anomaly_probability", 6).alias("anomaly_probability"))


@query("daily_error_evaluate", sql=f"""
    WITH {EVENTS_SQL}, s AS (SELECT 0 AS k, day AS ts, errors FROM quality),
    {fit_sql("s", "k", "errors", f"ts < DATE '{DAY_SPLIT}'", 1)},
    pairs AS (SELECT errors AS y, a + b * {x_sql("ts", 1)} AS g FROM s JOIN fit USING (k) WHERE ts >= DATE '{DAY_SPLIT}')
    SELECT round(avg(abs(y - g)), 5) AS mae, round(avg((y - g) ** 2), 5) AS mse, round(sqrt(avg((y - g) ** 2)), 5) AS rmse,
           round(100 * avg(2 * abs(y - g) / (abs(y) + abs(g))), 5) AS smape_pct, '' AS ai_evaluate_status FROM pairs""")
def daily_error_evaluate(t: Tables):
    out = ts.evaluate(daily_events(t), "errors", "day", F.expr(f"day < date '{DAY_SPLIT}'"),
                      F.expr(f"day >= date '{DAY_SPLIT}'"))
    return out.select(
        F.round("mean_absolute_error", 5).alias("mae"), F.round("mean_squared_error", 5).alias("mse"),
        F.round("root_mean_squared_error", 5).alias("rmse"),
        F.round("symmetric_mean_absolute_percentage_error", 5).alias("smape_pct"), "ai_evaluate_status")
