"""What the corpus operators share: word pattern, label splits, text slices, row packing."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

SLICE_CHARS = 2_000_000


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def split_number(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def text_slices(texts: Sequence[str | None], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``texts`` with at most ``limit`` characters, or one text, each."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if len(texts) > start:
        yield start, len(texts)


def map_batches(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``fn`` over every Arrow batch of ``df``."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of the concatenation of the ranges ``[start, start + length)``."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising bit mix of 64-bit values (wrap-around arithmetic)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now.

    Spark deletes them when the driver's JVM collects what refers to them, which
    may be much later. What the first collection frees may refer to more.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
