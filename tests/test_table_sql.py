"""SQL table functions against the operators they stand for."""

import datetime

import pytest
from pyspark.errors import AnalysisException

from tracewell.functions.table_sql import register_table_functions
from tracewell.operators import timeseries as ts


@pytest.fixture(scope="module")
def series(spark):
    register_table_functions(spark)
    day = datetime.date(2024, 1, 7)
    rows = [(k, g, day + datetime.timedelta(days=7 * i), 3.0 * i + (i * i * (ord(k) - 90)) % 7)
            for k in "ab" for g in (1, None) for i in range(20)]
    rows += [("c", 1, day, 5.0), ("c", 1, day + datetime.timedelta(days=7), 7.0), ("d", 1, day, None), (None, 2, day, 1.0)]
    df = spark.createDataFrame(rows, "k string, g int, ts date, y double")
    df.createOrReplaceTempView("some_series")
    return df


def rounded(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


def test_forecast_equals_the_operator(spark, series):
    got = spark.sql("""
        SELECT * FROM forecast(TABLE(some_series) PARTITION BY (k, g), data_col => 'y', timestamp_col => 'ts',
                               horizon => 3, id_cols => 'k, g', step_days => 7, confidence_level => 0.9D)""")
    want = ts.forecast(series, "y", "ts", 3, 0.9, ["k", "g"], 7)
    assert got.columns == want.columns
    assert rounded(got.collect()) == rounded(want.collect())


def test_anomalies_equal_the_operator(spark, series):
    got = spark.sql("""
        SELECT * FROM detect_anomalies(TABLE(some_series) PARTITION BY (k, g), 'y', 'ts', '2024-04-01', '2024-05-12',
                                       id_cols => 'k,g', step_days => 7, anomaly_prob_threshold => 0.8D)""")
    want = ts.detect_anomalies(series, "y", "ts", series.ts < "2024-04-01", series.ts.between("2024-04-01", "2024-05-12"),
                               0.8, ["k", "g"], 7)
    assert got.columns == want.columns and got.count() > 10
    assert rounded(got.collect()) == rounded(want.collect())


def test_whole_tables_joins_and_bad_names(spark, series):
    one = spark.sql("""
        SELECT f.forecast_value, s.name FROM forecast(TABLE(SELECT * FROM some_series WHERE k = 'a' AND g = 1)
               WITH SINGLE PARTITION, 'y', 'ts', 2, step_days => 7) f JOIN VALUES ('x') s(name) ORDER BY 1""")
    assert one.count() == 2
    assert spark.sql("SELECT * FROM forecast(TABLE(SELECT * FROM some_series WHERE false) WITH SINGLE PARTITION, 'y', 'ts', 2)").count() == 0
    with pytest.raises(AnalysisException, match="no column"):
        spark.sql("SELECT * FROM forecast(TABLE(some_series) PARTITION BY (k), 'z', 'ts', 2)")
