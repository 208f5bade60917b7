"""Event-time windows over a stream, drained to the store.

Results equal the batch answer as long as no row is later than the watermark
allows; rows that are get counted, see ``dropped_rows``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.sources.tables import TableStore


def windowed(stream: DataFrame, ts: str, delay: str, duration: str, slide: str | None,
             keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Tumbling (``slide`` None) or sliding aggregates with a watermark."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, duration, slide), *keys)
        .agg(*[m.alias(n) for n, m in measures.items()])
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                *keys, *measures)
    )


def sessions(stream: DataFrame, ts: str, delay: str, gap: str, keys: Sequence[str],
             measures: Mapping[str, Column]) -> DataFrame:
    """Session aggregates: a session ends after ``gap`` without rows."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.session_window(ts, gap), *keys)
        .agg(*[m.alias(n) for n, m in measures.items()])
        .select(F.col("session_window.start").alias("window_start"),
                F.col("session_window.end").alias("window_end"), *keys, *measures)
    )


def drain(aggregated: DataFrame, store: TableStore, table: str, checkpoint: str, keys: Sequence[str],
          mode: str = "update") -> DataFrame:
    """Run over all data available now and return the latest row per key.

    ``update`` keeps state behind the watermark bounded and writes only what
    changed. ``complete`` writes the whole result each time, for aggregates
    (sessions) that cannot be updated in place. Batches overwrite their own
    folder, so replays do not double rows. The number of rows that came too late
    for the watermark is appended to ``<table>_late``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store.path(table)}/batch={batch_id}")

    run = (aggregated.writeStream.outputMode(mode).foreachBatch(write)
           .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    run.awaitTermination()
    late = sum(state.numRowsDroppedByWatermark for p in run.recentProgress for state in p.stateOperators)
    store.append(f"{table}_late", store.spark.createDataFrame([(late,)], "dropped long"))
    written = store.read(table)
    if mode == "complete":
        last = written.agg(F.max("batch")).scalar()
        return written.filter(F.col("batch") == last).drop("batch")
    rest = [c for c in written.columns if c not in (*keys, "batch")]
    return written.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_s")).select(*keys, "_s.*")


def dropped_rows(store: TableStore, table: str) -> int:
    """Rows that all runs of ``drain`` into ``table`` left out because they came too late."""
    return store.read(f"{table}_late").agg(F.sum("dropped")).first()[0]
