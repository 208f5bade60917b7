"""Incremental scoring, retry, streaming and table stores."""

import datetime

import pytest
from pyspark.sql import functions as F

from tracewell.sources.tables import TableStore, literal_rows
from tracewell.streaming.incremental import (
    RETRYABLE, current_state, monitor, score_new_files, score_pending,
)
from tracewell.streaming.windows import drain, dropped_rows, sessions, windowed


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def score(rows, number):
    fails = (F.col("id") % 4 == 0) & (F.lit(number) < 2)
    return rows.select("id", F.when(~fails, F.col("id") * 10).alias("result"),
                       F.when(F.col("id") == 7, "broken input").when(fails, f"{RETRYABLE}: quota").otherwise("").alias("status"))


def test_retry_touches_only_retryable_rows(spark, store):
    source = spark.range(1, 13)
    assert score_pending(source, "id", score, store, "out") == 2
    log = store.read("out")
    assert log.filter("pass = 1").count() == 12
    assert sorted(r.id for r in log.filter("pass = 2").collect()) == [4, 8, 12]
    state = {r.id: (r["pass"], r.status) for r in current_state(log, "id").collect()}
    assert state[4] == (2, "") and state[7] == (1, "broken input") and len(state) == 12
    row = monitor(spark.range(1, 15), current_state(log, "id"), "id").first()
    assert tuple(row) == (12, 11, 0, 1, 2)


def test_second_run_scores_nothing_and_new_rows_only(spark, store):
    score_pending(spark.range(1, 4), "id", score, store, "out")
    before = store.read("out").count()
    score_pending(spark.range(1, 4), "id", score, store, "out")
    assert store.read("out").count() == before
    score_pending(spark.range(1, 6), "id", score, store, "out")
    assert current_state(store.read("out"), "id").count() == 5


def test_batches_go_by_priority_and_attempts_are_bounded(spark, store):
    made = score_pending(spark.range(1, 11), "id", score, store, "out", order=[F.desc("id")], batch_size=3)
    assert sorted(r.id for r in store.read("out").filter("pass = 1").collect()) == [8, 9, 10]
    assert made == 2  # 8 failed once, so a second batch ran

    def always(rows, number):
        return rows.select("id", F.lit(None).cast("long").alias("result"), F.lit(RETRYABLE).alias("status"))

    assert score_pending(spark.range(1, 3), "id", always, store, "never", max_attempts=3) == 3


def test_stream_consumes_each_file_once(spark, store, tmp_path):
    landing, schema = str(tmp_path / "landing"), spark.range(1).schema

    def run():
        score_new_files(store, landing, schema, score, "out", str(tmp_path / "checkpoint"))

    spark.range(1, 6).write.parquet(landing)
    run()
    run()
    assert store.read("out").count() == 5
    spark.range(6, 9).write.mode("append").parquet(landing)
    run()
    assert sorted(r.id for r in store.read("out").collect()) == list(range(1, 9))


def test_drained_windows_equal_batch(spark, store, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    rows = [(i % 3, start + datetime.timedelta(minutes=17 * i), float(i)) for i in range(200)]
    schema = "u int, ts timestamp, v double"
    folder = str(tmp_path / "events")
    batch = spark.createDataFrame(rows, schema)
    batch.repartition(3).write.parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    measures = {"n": F.count(F.lit(1)), "v": F.sum("v")}
    out = drain(windowed(stream, "ts", "30 days", "1 hour", None, ["u"], measures), store, "w",
                str(tmp_path / "c1"), ["window_start", "window_end", "u"])
    expected = windowed(batch, "ts", "30 days", "1 hour", None, ["u"], measures)
    columns = ["window_start", "u", "n", "v"]
    assert sorted(out.select(*columns).collect()) == sorted(expected.select(*columns).collect())
    out = drain(sessions(stream, "ts", "30 days", "40 minutes", ["u"], measures), store, "s",
                str(tmp_path / "c2"), ["window_start", "window_end", "u"], mode="complete")
    expected = sessions(batch, "ts", "30 days", "40 minutes", ["u"], measures)
    assert sorted(out.select(*columns).collect()) == sorted(expected.select(*columns).collect())


def test_late_rows_are_counted(spark, store, tmp_path):
    schema, folder = "u int, ts timestamp, v double", str(tmp_path / "events")
    measures = {"n": F.count(F.lit(1))}
    day = datetime.datetime(2024, 1, 10)

    def run(ts):
        spark.createDataFrame([(1, ts, 1.0)], schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        return drain(windowed(stream, "ts", "1 hour", "1 day", None, ["u"], measures), store, "w",
                     str(tmp_path / "c"), ["window_start", "window_end", "u"])

    run(day)
    run(day + datetime.timedelta(days=3))
    assert dropped_rows(store, "w") == 0
    out = run(day)  # far behind the watermark by now
    assert dropped_rows(store, "w") == 1
    assert sum(r.n for r in out.collect()) == 2


def test_table_store(spark, store):
    assert not store.exists("t")
    assert store.create_if_missing("t", "id long, name string").count() == 0
    rows = literal_rows(spark, [(1, "a"), (2, "b")], "id long, name string")
    store.append("t", rows)
    assert store.create_if_missing("t", "id long, name string").count() == 2
    store.view("v", store.read("t"))
    store.append("t", rows)
    assert spark.sql("SELECT * EXCEPT (name) FROM v").columns == ["id"]
    assert store.replace("t", rows).count() == 2


def test_arrivals_are_dated_today_unless_told(spark, sf_dir):
    from tracewell.plans.incremental_queries import arrivals
    from tracewell.sources.tables import Tables

    before = spark.sql("SELECT CAST(current_date() AS STRING)").first()[0]
    dates = {r.return_date for r in arrivals(Tables(spark, sf_dir)).collect()}
    after = spark.sql("SELECT CAST(current_date() AS STRING)").first()[0]
    assert len(dates) == 1 and dates <= {before, after}
