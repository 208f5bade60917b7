"""Sharding by a permutation-filled lookup table.

Each shard ranks all slots of a table of prime size by its own permutation.
Shards take turns claiming their best free slot until the table is full, so all
own almost equally many slots, and a shard that leaves gives up its slots while
few others move. A key's slot is its hash modulo the table size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65_537


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """Owner of each slot, as an index into ``shards``, whose order does not matter.

    ``size`` must be a prime well above the number of shards: steps below a
    prime visit every slot.
    """
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be distinct names, at least one")
    if size < len(shards) or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("size must be a prime no smaller than the number of shards")
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    at = [_number(name, "offset") % size for name in shards]
    step = [_number(name, "step") % (size - 1) + 1 for name in shards]
    owner, free = [-1] * size, size
    while True:
        for shard in turns:
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % size
            owner[at[shard]] = shard
            free -= 1
            if not free:
                return owner


def place(df: DataFrame, shards: Sequence[str], *, key: str = "doc_id", size: int = TABLE_SIZE) -> DataFrame:
    """(key, slot, shard) for every row.

    Equal keys share a shard; a null key is placed like empty text; repeated
    rows give repeated rows, an empty table none; other columns are not read.
    The table (``size`` rows, whatever the data) is broadcast, so no row moves.
    """
    owner = fill_table(shards, size)
    table = df.sparkSession.createDataFrame(
        [(slot, shards[shard]) for slot, shard in enumerate(owner)], "slot int, shard string")
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    slot = F.pmod(F.xxhash64(text), F.lit(size)).cast("int")
    return df.select(F.col(key).alias("key"), slot.alias("slot")).join(F.broadcast(table), "slot").select(
        F.col("key").alias(key), "slot", "shard")
