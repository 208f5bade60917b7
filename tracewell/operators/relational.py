"""Relational building blocks with plans that hold under skew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.session import cut_lineage


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL matches NULL; the keys come from the left side."""
    named = right.select(*[F.col(k).alias(f"_right_{k}") if k in keys else F.col(k) for k in right.columns])
    on = [left[k].eqNullSafe(named[f"_right_{k}"]) for k in keys]
    return left.join(named, on, how).drop(*[f"_right_{k}" for k in keys])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Column,
                  columns: Sequence[str]) -> DataFrame:
    """First row per key by ``order``, one of equal ones.

    Only keys and positions are ranked; whole rows are found by a join, so wide
    columns are never sorted with their key.
    """
    base = df.select(*dict.fromkeys([*keys, *columns]), order.alias("_order"))
    lowest = top_n_per_key(base.select(*keys, "_order"), keys, [F.col("_order")], 1, "_rank").drop("_rank")
    at_lowest = join_null_safe(base, lowest, [*keys, "_order"])
    return at_lowest.drop("_order").dropDuplicates(list(keys)).select(*dict.fromkeys([*keys, *columns]))


SALTS = 32


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                  rank: str = "rank") -> DataFrame:
    """First ``n`` rows per key, for any ``n``.

    Rows are ranked in SALTS parts of each key first, so that a key with a third
    of the rows is never sorted in one task; only the first ``n`` of each part
    are ranked again.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
    part = Window.partitionBy(*keys, "_salt").orderBy(*order)
    firsts = salted.withColumn(rank, F.row_number().over(part)).filter(F.col(rank) <= n).drop("_salt", rank)
    w = Window.partitionBy(*keys).orderBy(*order)
    return firsts.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def top_n_list(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[Column], n: int,
               name: str) -> DataFrame:
    """Array of the first ``n`` values per key, in order. Groups hold at most n rows."""
    ranked = top_n_per_key(df, keys, order, n, rank="_rank")
    pairs = F.array_sort(F.collect_list(F.struct("_rank", value)))
    return ranked.groupBy(*keys).agg(pairs.alias("_pairs")).select(
        *keys, F.transform("_pairs", lambda p: p[value]).alias(name))


def pending(source: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of ``source`` whose key is not in ``done``."""
    return source.join(done.select(key), key, "left_anti")


def priority_batch(df: DataFrame, order: Sequence[Column], size: int) -> DataFrame:
    """The ``size`` most urgent rows."""
    return df.orderBy(*order).limit(size)


def global_row_number(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """1-based position in a total order, without moving all rows to one task.

    Rows are range-partitioned and sorted; writing them fixes the partitioning,
    and the partition sizes (one row per partition) give offsets.
    """
    position_mask = (1 << 33) - 1
    fixed = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(position_mask)))
    )
    sizes = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_off"))
    return (
        fixed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_off") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_off")
    )


def running_before(df: DataFrame, keys: Sequence[str], ts: str, bucket: Column,
                   measures: dict[str, Column]) -> DataFrame:
    """Sums of ``measures`` over rows of the same key with a strictly earlier ``ts``.

    Two levels keep a hot key spread out: rows are summed per (key, bucket) and
    the bucket totals accumulated; inside a bucket a short window does the rest.
    ``bucket`` must rise with ``ts``.
    """
    keyed = df.withColumn("_bucket", bucket)
    inputs = {name: f"_in_{name}" for name in measures}
    for name, expr in measures.items():
        keyed = keyed.withColumn(inputs[name], expr)

    per_bucket = keyed.groupBy(*keys, "_bucket").agg(
        *[F.sum(c).alias(f"_sum_{n}") for n, c in inputs.items()])
    earlier_buckets = (Window.partitionBy(*keys).orderBy("_bucket")
                       .rowsBetween(Window.unboundedPreceding, -1))
    carried = per_bucket.select(
        *keys, "_bucket",
        *[F.sum(f"_sum_{n}").over(earlier_buckets).alias(f"_carry_{n}") for n in measures])

    in_bucket = (Window.partitionBy(*keys, "_bucket").orderBy(ts)
                 .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    same_ts = Window.partitionBy(*keys, "_bucket", ts)
    local = keyed
    for n, c in inputs.items():
        local = local.withColumn(
            f"_local_{n}", F.sum(c).over(in_bucket) - F.sum(c).over(same_ts))
    out = join_null_safe(local, carried, [*keys, "_bucket"])
    for n in measures:
        out = out.withColumn(n, F.coalesce(f"_carry_{n}", F.lit(0)) + F.col(f"_local_{n}"))
    return out.drop("_bucket", *inputs.values(),
                    *[f"_carry_{n}" for n in measures], *[f"_local_{n}" for n in measures])
