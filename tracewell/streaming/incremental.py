"""Idempotent incremental scoring: batch passes with retry, and the streaming form.

Parquet has no DELETE, so outcomes are kept as an append-only log with one
folder per pass; the current state of a row is its latest pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracewell.operators.relational import pending, priority_batch
from tracewell.sources.tables import TableStore

# Fixed value: the text that marks a failure worth another attempt.
RETRYABLE = "A retryable error occurred"

Score = Callable[[DataFrame, int], DataFrame]


def is_retryable(status: Column) -> Column:
    return F.coalesce(status.like(f"%{RETRYABLE}%"), F.lit(False))


def current_state(log: DataFrame, key: str) -> DataFrame:
    """Latest outcome per key."""
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), "pass").alias("_s")).select(key, "_s.*")


def settled(log: DataFrame, key: str) -> DataFrame:
    """Keys that must not be scored again: done, or failed for good."""
    return current_state(log, key).filter(~is_retryable(F.col("status"))).select(key)


def score_pending(source: DataFrame, key: str, score: Score, store: TableStore, table: str, *,
                  order: Sequence[Column] = (), batch_size: int | None = None,
                  max_attempts: int = 3) -> int:
    """Score rows never settled before; returns the number of passes made.

    ``score(rows, pass)`` returns key, result, status. A pass takes all pending
    rows, or the ``batch_size`` most urgent ones by ``order``. Passes repeat
    until none of the outcomes is retryable or ``max_attempts`` is reached; a
    later call tries the rest again. A pass writes its own folder, so a repeated
    pass replaces its own rows and no others.
    """
    log = store.read(table) if store.exists(table) else None
    number = 0 if log is None else log.agg(F.max("pass")).first()[0] or 0
    rows = source if log is None else pending(source, settled(log, key), key)
    made = 0
    while made < max_attempts:
        made += 1
        number += 1
        path = f"{store.path(table)}/pass={number}"
        batch = rows if batch_size is None else priority_batch(rows, order, batch_size)
        outcome = score(batch, number).withColumn("scored_at", F.current_timestamp())
        outcome.write.mode("overwrite").parquet(path)
        again = store.spark.read.parquet(path).filter(is_retryable(F.col("status"))).select(key)
        if again.isEmpty():
            break
        if batch_size is None:  # all else is settled, so the next pass needs only these
            rows = source.join(again, key, "left_semi")
        else:
            rows = pending(source, settled(store.read(table), key), key)
    return made


def monitor(source: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """One row: scored, succeeded, retryable, failed for good, and waiting rows."""
    status = F.col("status")
    failed = status.isNotNull() & (status != "")
    joined = source.select(key).join(state.select(key, "status", F.lit(True).alias("_scored")), key, "left")
    return joined.agg(
        F.count("_scored").alias("n_scored"),
        F.count_if(F.col("_scored") & ~F.coalesce(failed, F.lit(False))).alias("n_ok"),
        F.count_if(is_retryable(status)).alias("n_retryable"),
        F.count_if(failed & ~is_retryable(status)).alias("n_failed"),
        F.count_if(F.col("_scored").isNull()).alias("n_waiting"))


def score_new_files(store: TableStore, folder: str, schema: StructType, score: Score, table: str,
                    checkpoint: str, glob: str | None = None, files_per_batch: int = 1000) -> None:
    """Score the files that landed in ``folder`` since the last call, then stop.

    A backlog is taken in batches of at most ``files_per_batch`` files.
    The stream's checkpoint remembers consumed files; a batch replayed after a
    failure overwrites its own folder, so every row is written exactly once.
    """
    reader = store.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)

    def write(batch: DataFrame, batch_id: int) -> None:
        score(batch, batch_id).write.mode("overwrite").parquet(f"{store.path(table)}/pass={batch_id}")

    (reader.parquet(folder).writeStream.foreachBatch(write)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .start().awaitTermination())
