"""Table functions for SQL callers: forecasts and anomalies of partitioned tables.

    SELECT * FROM forecast(TABLE(weekly) PARTITION BY flag, data_col => 'revenue',
                           timestamp_col => 'ts', id_cols => 'flag', horizon => 8)

The caller deals the rows with PARTITION BY; each partition is one series and
``id_cols`` names the columns, comma-separated, that tell it apart in the
result. A series is summed up as its rows come, so that only the rows to report
on are held. The model is that of ``operators.timeseries``: a straight line with
normal prediction intervals.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from tracewell.functions.columns import ERF_A, ERF_P, normal_half_width

# A Sunday, on which all steps are counted.
ORIGIN = datetime.date(1970, 1, 4)


def two_sided(z: float) -> float:
    """P(|N(0,1)| <= |z|), by the formula that ``columns.two_sided_probability`` has."""
    x = abs(z) / math.sqrt(2.0)
    t, poly = 1.0 / (1.0 + ERF_P * x), 0.0
    for a in reversed(ERF_A):
        poly = (poly + a) * t
    return max(0.0, min(1.0, 1.0 - poly * math.exp(-x * x)))


class Line:
    """Least squares of a line, updated with each point."""

    def __init__(self) -> None:
        self.n, self.x, self.y, self.sxx, self.sxy, self.syy = 0, 0.0, 0.0, 0.0, 0.0, 0.0

    def add(self, x: float, y: float) -> None:
        self.n += 1
        dx, dy = x - self.x, y - self.y
        self.x += dx / self.n
        self.y += dy / self.n
        self.sxx += dx * (x - self.x)
        self.sxy += dx * (y - self.y)
        self.syy += dy * (y - self.y)

    @property
    def slope(self) -> float:
        return self.sxy / self.sxx if self.n > 2 and self.sxx else 0.0

    def at(self, x: float) -> float:
        return self.y + self.slope * (x - self.x)

    def error(self, x: float) -> float | None:
        """Standard error of one new value at ``x``; None where points are too few to tell."""
        if self.n < 3:
            return None
        sigma = math.sqrt(max(0.0, self.syy - self.slope * self.sxy) / (self.n - 2))
        lever = (x - self.x) ** 2 / self.sxx if self.sxx else 0.0
        return sigma * math.sqrt(1.0 + 1.0 / self.n + lever)


def _day(value) -> datetime.date:
    return value.date() if isinstance(value, datetime.datetime) else value


def _columns(table: AnalyzeArgument, id_cols: str | None, needed: list[str]) -> list[T.StructField]:
    """Fields of the id columns; a name that the table lacks is an error."""
    fields = {f.name: f for f in table.dataType.fields}
    ids = [c.strip() for c in (id_cols or "").split(",") if c.strip()]
    for name in [*needed, *ids]:
        if name not in fields:
            raise ValueError(f"the table has no column {name}, only {', '.join(fields)}")
    return [fields[c] for c in ids]


def _text(argument: AnalyzeArgument | None, name: str, default: str | None = None) -> str | None:
    if argument is None:
        return default
    if not argument.isConstantExpression or argument.value is None:
        raise ValueError(f"{name} must be a constant")
    return str(argument.value)


class _Series:
    """What both functions share: the constants of the call and the series' ids."""

    def _start(self, row, data_col: str, timestamp_col: str, id_cols: str | None) -> None:
        if getattr(self, "ids", None) is None:
            self.names = [c.strip() for c in (id_cols or "").split(",") if c.strip()]
            self.ids = [row[c] for c in self.names]

    @staticmethod
    def _step(day: datetime.date, step_days: int) -> float:
        return (day - ORIGIN).days / step_days


class Forecast(_Series):
    """``horizon`` rows after the last of each series."""

    @staticmethod
    def analyze(rows: AnalyzeArgument, data_col: AnalyzeArgument, timestamp_col: AnalyzeArgument,
                horizon: AnalyzeArgument, id_cols: AnalyzeArgument | None = None,
                step_days: AnalyzeArgument | None = None, confidence_level: AnalyzeArgument | None = None) -> AnalyzeResult:
        ids = _columns(rows, _text(id_cols, "id_cols"), [_text(data_col, "data_col"), _text(timestamp_col, "timestamp_col")])
        schema = T.StructType(list(ids)).add("forecast_timestamp", "date")
        for name in ("forecast_value", "prediction_interval_lower_bound", "prediction_interval_upper_bound"):
            schema = schema.add(name, "double")
        return AnalyzeResult(schema=schema)

    def eval(self, rows, data_col, timestamp_col, horizon, id_cols=None, step_days=1, confidence_level=0.95):
        if getattr(self, "line", None) is None:
            self.line, self.last = Line(), None
            self.options = int(horizon), int(step_days), float(confidence_level)
        self._start(rows, data_col, timestamp_col, id_cols)
        if rows[timestamp_col] is None:
            return
        day = _day(rows[timestamp_col])
        self.last = day if self.last is None else max(day, self.last)
        if rows[data_col] is not None:
            self.line.add(self._step(day, self.options[1]), float(rows[data_col]))

    def terminate(self) -> Iterator[tuple]:
        if getattr(self, "last", None) is None:
            return
        horizon, step_days, confidence = self.options
        z = normal_half_width(confidence)
        for h in range(1, horizon + 1):
            day = self.last + datetime.timedelta(days=h * step_days)
            x = self._step(day, step_days)
            value, error = (self.line.at(x), self.line.error(x)) if self.line.n else (None, None)
            half = None if error is None else z * error
            yield (*self.ids, day, value, *((None, None) if half is None else (value - half, value + half)))


class DetectAnomalies(_Series):
    """Rows from ``inspect_from`` on against the line through the rows before it.

    With ``inspect_to``, later rows are not reported.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, data_col: AnalyzeArgument, timestamp_col: AnalyzeArgument,
                inspect_from: AnalyzeArgument, inspect_to: AnalyzeArgument | None = None,
                id_cols: AnalyzeArgument | None = None, step_days: AnalyzeArgument | None = None,
                anomaly_prob_threshold: AnalyzeArgument | None = None) -> AnalyzeResult:
        ids = _columns(rows, _text(id_cols, "id_cols"), [_text(data_col, "data_col"), _text(timestamp_col, "timestamp_col")])
        schema = T.StructType(list(ids)).add("time_series_timestamp", "date")
        for name in ("time_series_data", "lower_bound", "upper_bound", "anomaly_probability"):
            schema = schema.add(name, "double")
        return AnalyzeResult(schema=schema.add("is_anomaly", "boolean"))

    def eval(self, rows, data_col, timestamp_col, inspect_from, inspect_to=None, id_cols=None, step_days=1,
             anomaly_prob_threshold=0.95):
        if getattr(self, "line", None) is None:
            self.line, self.held = Line(), []
            self.options = int(step_days), float(anomaly_prob_threshold)
            self.first, self.end = (None if d is None else datetime.date.fromisoformat(str(d)[:10]) for d in (inspect_from, inspect_to))
        self._start(rows, data_col, timestamp_col, id_cols)
        if rows[timestamp_col] is None:
            return
        day, value = _day(rows[timestamp_col]), rows[data_col]
        if day < self.first:
            if value is not None:
                self.line.add(self._step(day, self.options[0]), float(value))
        elif self.end is None or day <= self.end:
            self.held.append((day, None if value is None else float(value)))

    def terminate(self) -> Iterator[tuple]:
        if getattr(self, "line", None) is None:
            return
        step_days, threshold = self.options
        z = normal_half_width(threshold)
        for day, value in self.held:
            x = self._step(day, step_days)
            error = self.line.error(x)
            if error is None:
                yield (*self.ids, day, value, None, None, None, False)
                continue
            expected = self.line.at(x)
            probability = None
            if value is not None:
                off = value - expected
                probability = two_sided(off / error) if error else float(off != 0)
            yield (*self.ids, day, value, expected - z * error, expected + z * error, probability,
                   probability is not None and probability > threshold)


def register_table_functions(spark: SparkSession) -> None:
    """Make ``forecast`` and ``detect_anomalies`` callable in the session's SQL."""
    spark.udtf.register("forecast", udtf(Forecast))
    spark.udtf.register("detect_anomalies", udtf(DetectAnomalies))
