"""Sessions over a stream with own state: closed once, late rows kept.

A key's open sessions are its state; a timer closes them when the watermark has
passed their end. What a row belongs to that came too late for that is written
as a session of its own, and reading the store joins sessions of a key that
touch. So the store holds, after any number of runs and in any order of the
files, what one pass over all rows would give.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tracewell.sources.tables import TableStore

OPEN, CLOSED, LATE = "open", "closed", "late"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: of times, in microseconds
SECOND = 1_000_000


def join_touching(sessions: list[list]) -> list[list]:
    """[start, end, rows, sums] with those joined that start before another has ended."""
    out: list[list] = []
    for start, end, rows, sums in sorted(sessions):
        if out and start < out[-1][1]:
            last = out[-1]
            last[1:] = [max(last[1], end), last[2] + rows, [a + b for a, b in zip(last[3], sums)]]
        else:
            out.append([start, end, rows, sums])
    return out


class SessionState(StatefulProcessor):
    """Open sessions of one key: times in microseconds, number of rows, exact sums of whole numbers."""

    def __init__(self, gap: int, keys: Sequence[str]):
        self.gap, self.keys = gap, list(keys)

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getListState("open", "start long, stop long, n long, sums array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        fresh = [[row.time, row.time + self.gap, 1, list(row.sums)] for row in rows]
        # A row whose own session would have ended is late, unless it falls into one that is still open.
        held = self._held()
        joined = join_touching(held + fresh)
        left = [s for s in joined if s[1] > watermark]
        yield from self._written(key, [s for s in joined if s[1] <= watermark], LATE, 0)
        yield from self._kept(key, left, 0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        held = self._held()
        over = [s for s in held if s[1] <= watermark]
        if over:
            yield from self._written(key, over, CLOSED, 1)
            yield from self._kept(key, [s for s in held if s[1] > watermark], 1)

    def _held(self) -> list[list]:
        return [[start, stop, n, list(sums)] for start, stop, n, sums in self.held.get()] if self.held.exists() else []

    def _kept(self, key, sessions, turn: int) -> Iterator[Row]:
        """Hold the sessions, with one timer for the first of them to end."""
        wanted = [-(-min(s[1] for s in sessions) // 1000)] if sessions else []
        known = list(self.handle.listTimers())
        for timer in set(known) - set(wanted):
            self.handle.deleteTimer(timer)
        for timer in set(wanted) - set(known):
            self.handle.registerTimer(timer)
        if sessions:
            self.held.put([tuple(s) for s in sessions])
            yield from self._written(key, sessions, OPEN, turn)
        else:
            self.held.clear()

    def _written(self, key, sessions, kind: str, turn: int) -> Iterator[Row]:
        for start, end, n, sums in sessions:
            yield Row(**dict(zip(self.keys, key)), start=start, stop=end, n=n, sums=sums, kind=kind, turn=turn)

    def close(self) -> None:
        pass


def sessions_of(stream: DataFrame, ts: str, delay: str, gap_seconds: int, keys: Mapping[str, str],
                sums: Sequence[Column]) -> DataFrame:
    """(keys, start, stop, n, sums, kind, turn) of a stream.

    ``keys`` gives the type of each key, ``sums`` columns of whole numbers to add
    up. The watermark is on a column that the state does not see, so that Spark
    drops no late row on the way to it.
    """
    rows = (stream.withColumn("_clock", F.col(ts)).withWatermark("_clock", delay)
            .select(*keys, F.unix_micros(ts).alias("time"), F.array(*[c.cast("long") for c in sums]).alias("sums")))
    schema = T.StructType.fromDDL(
        ", ".join(f"`{k}` {kind}" for k, kind in keys.items())
        + ", start long, stop long, n long, sums array<long>, kind string, turn int")
    return rows.groupBy(*keys).transformWithState(
        SessionState(gap_seconds * SECOND, list(keys)), schema, "Append", "EventTime")


def run_sessions(found: DataFrame, store: TableStore, table: str, checkpoint: str) -> None:
    """Take what is there now into ``table``; the open sessions stay in the checkpoint for the next run.

    A batch writes its own folder, so a batch that is run again replaces itself.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(
            f"{store.path(table)}/batch_id={batch_id}")

    with_state(store.spark)
    (found.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def with_state(spark: SparkSession) -> None:
    """The state store that own state needs."""
    if spark.conf.get(STORE, None) != ROCKSDB:
        spark.conf.set(STORE, ROCKSDB)


def stored_sessions(store: TableStore, table: str, keys: Sequence[str]) -> DataFrame:
    """(keys, start, stop, n, sums): sessions so far, those that touch joined.

    Closed and late sessions count as written. Open ones are written again with
    every change of their key and hold until the next; only the last of a key count.
    """
    rows = store.read(table).drop("batch_id")
    at = F.struct("batch", "turn")
    last = rows.withColumn("_last", F.max(at).over(Window.partitionBy(*keys)))
    held = last.filter((F.col("kind") != OPEN) | (F.col("_last") == at))
    in_order = Window.partitionBy(*keys).orderBy("start", "stop")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    numbered = (held.withColumn("_new", F.coalesce(F.col("start") >= F.max("stop").over(before), F.lit(True)).cast("int"))
                .withColumn("_session", F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0))))
    width = rows.select(F.max(F.size("sums"))).first()[0] or 0
    total = [F.sum(F.col("sums")[i]).alias(f"_{i}") for i in range(width)]
    return numbered.groupBy(*keys, "_session").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("n").alias("n"), *total).select(
        *keys, F.timestamp_micros("start").alias("start"), F.timestamp_micros("stop").alias("stop"), "n",
        F.array(*[F.col(f"_{i}") for i in range(width)]).alias("sums"))

