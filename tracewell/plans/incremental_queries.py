"""Incremental, retry and streaming queries over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.operators.augmented import causal_effect, detect_change_points, key_drivers
from tracewell.operators.relational import pending, priority_batch
from tracewell.operators.timeseries import bucket_series, regularize
from tracewell.plans.registry import ORACLES, query
from tracewell.plans.series_queries import drivers_sql, fit_sql, segments_sql, x_sql
from tracewell.plans.text_queries import RUBRIC, SCORE_SQL, documents
from tracewell.session import cut_lineage, new_path
from tracewell.sources.tables import Tables, TableStore
from tracewell.streaming.incremental import (
    RETRYABLE, current_state, monitor, score_new_files, score_pending,
)
from tracewell.streaming.sessions import run_sessions, sessions_of, stored_sessions
from tracewell.streaming.windows import drain, sessions, windowed


# What a pass takes from a text, ever wider: a closed line, a closed sentence, a line from its first word on.
EXCERPTS = (r"(?:^|\n)[A-Z][^\n]*[.](?:\n|\z)", r"[A-Z][^\n.]*[.]", r"[a-zA-Z]{2}[^\n]*")


def excerpt_score(rows: DataFrame, number: int) -> DataFrame:
    """Rubric scores of what the pass's pattern finds in each text.

    A text without it is put off to the next pass, whose pattern is wider; one
    without a word never scores.
    """
    found = F.regexp_extract("text", EXCERPTS[min(number, len(EXCERPTS)) - 1], 0)
    status = (F.when(~F.coalesce(F.regexp_like(F.col("text"), F.lit("[a-zA-Z]{2}")), F.lit(False)), "invalid input")
              .when(F.col("excerpt") == "", f"{RETRYABLE}: pass {number}").otherwise(""))
    return rows.select("doc_id", "text", found.alias("excerpt")).select(
        "doc_id", status.alias("status"), RUBRIC.score(F.col("excerpt")).alias("score")).select(
        "doc_id", "status", F.when(F.col("status") == "", F.col("score")).alias("result"))


OUTCOME_SQL = """
    CASE WHEN NOT coalesce(regexp_matches(text, '[a-zA-Z]{{2}}'), false) THEN 'invalid input'
         WHEN regexp_extract(text, '{pattern}') = '' THEN 'A retryable error occurred: pass {p}' ELSE '' END"""


def outcome_sql(number: int) -> str:
    return OUTCOME_SQL.format(p=number, pattern=EXCERPTS[number - 1])


@query("retry_failed_rows", sql=f"""
    WITH p1 AS (SELECT *, 1 AS last_pass, {outcome_sql(1)} AS status FROM documents),
    p2 AS (SELECT * REPLACE (CASE WHEN status LIKE '%A retryable%' THEN 2 ELSE last_pass END AS last_pass,
             CASE WHEN status LIKE '%A retryable%' THEN {outcome_sql(2)} ELSE status END AS status) FROM p1),
    p3 AS (SELECT * REPLACE (CASE WHEN status LIKE '%A retryable%' THEN 3 ELSE last_pass END AS last_pass,
             CASE WHEN status LIKE '%A retryable%' THEN {outcome_sql(3)} ELSE status END AS status) FROM p2),
    taken AS (SELECT doc_id, last_pass, status, CASE last_pass {" ".join(
        f"WHEN {i} THEN regexp_extract(text, '{p}')" for i, p in enumerate(EXCERPTS, 1))} END AS text FROM p3)
    SELECT doc_id, last_pass, status, CASE WHEN status = '' THEN {SCORE_SQL} END AS result FROM taken""")
def retry_failed_rows(t: Tables):
    """All documents scored with up to three passes; only those whose pattern found nothing are repeated."""
    store = TableStore(t.spark, new_path(t.spark, "retry"))
    score_pending(documents(t), "doc_id", excerpt_score, store, "scored", max_attempts=len(EXCERPTS))
    return current_state(store.read("scored"), "doc_id").select(
        "doc_id", F.col("pass").alias("last_pass"), "status", "result")


def rubric_score(rows: DataFrame, number: int) -> DataFrame:
    return rows.select("doc_id", RUBRIC.judge(F.col("text"), "double").alias("j")).select(
        "doc_id", "j.result", "j.status")


@query("incremental_score", sql=f"""
    SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 1 ELSE 2 END AS last_pass,
           {SCORE_SQL} AS result, '' AS status FROM documents""")
def incremental_score(t: Tables):
    """Labelled documents first; the second run scores only what is new, a third nothing."""
    store = TableStore(t.spark, new_path(t.spark, "incremental"))
    all_documents = documents(t)
    first = all_documents.join(t.labels.select("doc_id"), "doc_id", "left_semi")
    score_pending(first, "doc_id", rubric_score, store, "scored")
    score_pending(all_documents, "doc_id", rubric_score, store, "scored")
    return current_state(store.read("scored"), "doc_id").select(
        "doc_id", F.col("pass").alias("last_pass"), "result", "status")


@query("status_monitor", sql=f"""
    WITH s AS (SELECT doc_id, {outcome_sql(1)} AS status FROM documents WHERE lang <> 'es')
    SELECT count(s.doc_id) AS n_scored, count(*) FILTER (status = '') AS n_ok,
           count(*) FILTER (status LIKE '%A retryable error occurred%') AS n_retryable,
           count(*) FILTER (status <> '' AND status NOT LIKE '%A retryable error occurred%') AS n_failed,
           count(*) FILTER (s.doc_id IS NULL) AS n_waiting
    FROM documents o LEFT JOIN s ON s.doc_id = o.doc_id""")
def status_monitor(t: Tables):
    """How far scoring has come when one language is still waiting."""
    scored = excerpt_score(documents(t, "lang").filter("lang <> 'es'"), 1)
    return monitor(t.documents, scored, "doc_id")


@query("simulate_arrivals", sql="""
    SELECT 6000000 + o_orderkey AS return_id, o_orderkey, o_custkey, round(o_totalprice, 2) AS refund_amount,
           'pending' AS status, '2002-02-01' AS return_date
    FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
    ORDER BY o_orderkey LIMIT 10""")
def simulate_arrivals(t: Tables):
    """Ten new returns for the lowest orders without one, dated by the caller."""
    return arrivals(t, F.lit("2002-02-01").cast("date"))


def arrivals(t: Tables, as_of: Column | None = None) -> DataFrame:
    """New returns dated ``as_of``, by default today."""
    returned = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    fresh = priority_batch(pending(t.orders, returned, "o_orderkey"), [F.asc("o_orderkey")], 10)
    return fresh.select((F.col("o_orderkey") + 6_000_000).alias("return_id"), "o_orderkey", "o_custkey",
                        F.round("o_totalprice", 2).alias("refund_amount"), F.lit("pending").alias("status"),
                        (F.current_date() if as_of is None else as_of).cast("string").alias("return_date"))


@query("stream_incremental", sql="""
    SELECT user_id, count(*) AS n_events, count(*) FILTER (event_type = 'error' AND value >= 30) AS n_flagged,
           round(sum(value), 2) AS value
    FROM events GROUP BY 1""")
def stream_incremental(t: Tables):
    """Events scored by a stream; the second call finds no new files and adds nothing."""
    store = TableStore(t.spark, new_path(t.spark, "stream"))

    def score(batch: DataFrame, batch_id: int) -> DataFrame:
        flagged = (F.col("event_type") == "error") & (F.col("value") >= 30)
        return batch.select("event_id", "user_id", "value", flagged.alias("result"))

    for _ in range(2):
        score_new_files(store, t.directory, t.events.schema, score, "scored", store.path("checkpoint"),
                        glob="events.parquet")
    return store.read("scored").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if("result").alias("n_flagged"),
        F.round(F.sum("value"), 2).alias("value"))


def event_stream(t: Tables) -> DataFrame:
    stream = (t.spark.readStream.schema(t.events.schema)
              .option("pathGlobFilter", "events.parquet").parquet(t.directory))
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def window_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")})


@query("stream_tumbling", sql="""
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end,
           event_type, count(*) AS n, round(sum(value), 2) AS value
    FROM events GROUP BY date_trunc('day', ts), event_type""")
def stream_tumbling(t: Tables):
    store = TableStore(t.spark, new_path(t.spark, "tumbling"))
    daily = windowed(event_stream(t), "ts", "1 hour", "1 day", None, ["event_type"],
                     {"n": F.count(F.lit(1)), "value": F.round(F.sum("value"), 2)})
    return window_text(drain(daily, store, "daily", store.path("checkpoint"),
                             ["window_start", "window_end", "event_type"]))


@query("stream_sliding", sql="""
    WITH w AS (SELECT unnest([time_bucket(INTERVAL 6 HOURS, ts), time_bucket(INTERVAL 6 HOURS, ts) - INTERVAL 6 HOURS]) AS s,
                      event_type, value FROM events)
    SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(s + INTERVAL 12 HOURS, '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS n,
           count(*) FILTER (event_type = 'error') AS n_errors
    FROM w GROUP BY s""")
def stream_sliding(t: Tables):
    store = TableStore(t.spark, new_path(t.spark, "sliding"))
    sliding = windowed(event_stream(t), "ts", "1 hour", "12 hours", "6 hours", [],
                       {"n": F.count(F.lit(1)), "n_errors": F.count_if(F.col("event_type") == "error")})
    return window_text(drain(sliding, store, "sliding", store.path("checkpoint"),
                             ["window_start", "window_end"]))


@query("stream_session", sql="""
    WITH o AS (SELECT user_id, ts, value, CASE WHEN ts < lag(ts) OVER w + INTERVAL 2 HOURS THEN 0 ELSE 1 END AS fresh
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM o)
    SELECT strftime(date_trunc('second', min(ts)), '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(date_trunc('second', max(ts) + INTERVAL 2 HOURS), '%Y-%m-%d %H:%M:%S') AS window_end,
           user_id, count(*) AS n, round(sum(value), 2) AS value
    FROM s GROUP BY user_id, session""")
def stream_session(t: Tables):
    store = TableStore(t.spark, new_path(t.spark, "session"))
    by_user = sessions(event_stream(t), "ts", "1 hour", "2 hours", ["user_id"],
                       {"n": F.count(F.lit(1)), "value": F.round(F.sum("value"), 2)})
    return window_text(drain(by_user, store, "session", store.path("checkpoint"),
                             ["window_start", "window_end", "user_id"], mode="complete"))


@query("stream_late_sessions", sql=ORACLES["stream_session"])
def stream_late_sessions(t: Tables):
    """The sessions of ``stream_session`` when a fifth of the events come after all others.

    By the second run the watermark has passed nearly all sessions: they are
    closed and gone from the state, and what comes late is joined to them.
    """
    store = TableStore(t.spark, new_path(t.spark, "late-sessions"))
    late = F.pmod(F.xxhash64("event_id"), F.lit(5)) == 0
    for name, rows in (("first", t.events.filter(~late)), ("late", t.events.filter(late))):
        rows.write.parquet(store.path(f"arrived/{name}"))
        stream = (t.spark.readStream.schema(t.events.schema).option("recursiveFileLookup", "true")
                  .option("maxFilesPerTrigger", 64).parquet(store.path("arrived")))
        found = sessions_of(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour", 2 * 3600,
                            {"user_id": "bigint"}, [F.round(F.col("value") * 100)])
        run_sessions(found, store, "sessions", store.path("checkpoint"))
    rows = stored_sessions(store, "sessions", ["user_id"])
    return window_text(rows.select(
        F.col("start").alias("window_start"), F.col("stop").alias("window_end"), "user_id", "n",
        F.round(F.col("sums")[0] / 100, 2).alias("value")))


_CHAIN_X = x_sql("ts", 1)


@query("chained_investigation", sql=f"""
    WITH RECURSIVE present AS (SELECT o_orderdate::DATE AS ts, sum(o_totalprice) AS revenue FROM orders GROUP BY 1),
    spine AS (SELECT unnest(generate_series(min(ts)::TIMESTAMP, max(ts)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS ts FROM present),
    daily AS (SELECT 0 AS k, ts, coalesce(revenue, 0) AS revenue FROM spine LEFT JOIN present USING (ts)),
    {segments_sql("daily", "k", "revenue", 0.5, 7)},
    levels AS (SELECT min(ts) AS begin_ts, avg(y) AS level FROM leveled GROUP BY seg),
    jumps AS (SELECT begin_ts, abs(level - lag(level) OVER (ORDER BY begin_ts)) AS jump FROM levels),
    shift AS (SELECT begin_ts AS shift_day FROM jumps ORDER BY jump DESC NULLS LAST, begin_ts LIMIT 1),
    facts AS (SELECT o_orderpriority, c_mktsegment, CAST(o_totalprice AS DECIMAL(18, 2)) AS o_totalprice, o_orderdate::DATE >= shift_day AS is_after
              FROM orders JOIN customer ON c_custkey = o_custkey, shift),
    drivers AS (WITH {drivers_sql("facts", ["o_orderpriority", "c_mktsegment"], "o_totalprice", "is_after", 0.1, 3)}),
    {fit_sql("daily", "k", "revenue", "ts < (SELECT shift_day FROM shift)", 1)},
    effect AS (SELECT sum(revenue - (a + b * {_CHAIN_X})) / sum(a + b * {_CHAIN_X}) AS rel
               FROM daily JOIN fit USING (k) WHERE ts >= (SELECT shift_day FROM shift))
    SELECT 'driver' AS step, drivers AS item, relative_difference AS value FROM drivers
    UNION ALL SELECT 'effect', (SELECT shift_day::VARCHAR FROM shift), round(rel, 6) FROM effect""")
def chained_investigation(t: Tables):
    """Largest level shift of daily revenue, what drove it, and what it was worth.

    Only the date of the shift reaches the driver; it parameterises the next steps.
    """
    daily = bucket_series(t.orders, F.col("o_orderdate"), "day", {"revenue": F.sum("o_totalprice")})
    series = cut_lineage(regularize(daily, "ts", ["revenue"]))
    regimes = detect_change_points(series, "revenue", "ts", penalty=0.5)
    shift = (
        regimes.select("begin_timestamp", F.col("metrics.avg").alias("level"))
        .selectExpr("begin_timestamp", "abs(level - lag(level) OVER (ORDER BY begin_timestamp)) AS jump")
        .orderBy(F.desc_nulls_last("jump"), "begin_timestamp").first()
    )
    at = F.lit(shift["begin_timestamp"]).cast("date")
    facts = t.orders.join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey").select(
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"), "o_orderpriority", "c_mktsegment", (F.col("o_orderdate").cast("date") >= at).alias("after"))
    drivers = key_drivers(facts, "o_totalprice", ["o_orderpriority", "c_mktsegment"], "after", top_k=3)
    effect = causal_effect(series, "revenue", "ts", at)
    return (
        drivers.select(F.lit("driver").alias("step"), F.array_join("drivers", " & ").alias("item"),
                       F.round("relative_difference", 6).alias("value"))
        .unionByName(effect.select(F.lit("effect").alias("step"), at.cast("string").alias("item"),
                                   F.round("relative_effect", 6).alias("value")))
    )
