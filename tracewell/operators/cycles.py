"""Directed cycles of a fixed length, found by joining half paths in the middle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.session import cut_lineage


def ranked(edges: DataFrame, source: str, target: str, rounds: int = 1) -> DataFrame:
    """(src, dst, src_rank, dst_rank) of the distinct edges that may be in a cycle.

    A node ranks by its degree, then by itself. Edges into nodes without a way
    on, or from nodes without a way there, go; ``rounds`` times, as every round
    may uncover more of them.
    """
    kept = edges.select(F.col(source).alias("src"), F.col(target).alias("dst")).filter("src <> dst").distinct()
    for _ in range(rounds):
        kept = cut_lineage(kept)
        entered, left = kept.select(F.col("dst").alias("node")), kept.select(F.col("src").alias("node"))
        kept = (kept.join(entered.distinct(), F.col("src") == F.col("node"), "left_semi")
                .join(left.distinct(), F.col("dst") == F.col("node"), "left_semi"))
    kept = cut_lineage(kept)
    degree = kept.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    rank = degree.select("node", F.struct("n", "node").alias("rank"))
    return (kept.join(rank.select(F.col("node").alias("src"), F.col("rank").alias("src_rank")), "src")
            .join(rank.select(F.col("node").alias("dst"), F.col("rank").alias("dst_rank")), "dst")
            .select("src", "dst", "src_rank", "dst_rank"))


def half_paths(edges: DataFrame, steps: int) -> DataFrame:
    """(anchor, inner, last): simple paths of ``steps`` edges whose anchor outranks all other nodes.

    ``inner`` are the nodes between. A node with many edges is never passed
    through, but by paths from a node with even more, so its ways in and its
    ways out are not multiplied.
    """
    start = edges.filter("dst_rank < src_rank").select(
        F.col("src").alias("anchor"), F.col("src_rank").alias("top"), F.slice(F.array("src"), 1, F.lit(0)).alias("inner"),
        F.col("dst").alias("last"))
    step = edges.select(F.col("src").alias("last"), F.col("dst").alias("next"), F.col("dst_rank").alias("next_rank"))
    for _ in range(steps - 1):
        start = (start.join(step, "last")
                 .filter((F.col("next_rank") < F.col("top")) & ~F.array_contains("inner", F.col("next")))
                 .select("anchor", "top", F.array_append("inner", F.col("last")).alias("inner"), F.col("next").alias("last")))
    return start.select("anchor", "inner", "last")


def _turned(members: Column, first: Column, length: int) -> Column:
    """``members`` from the place ``first`` (from 1) on, then those before it."""
    return F.concat(F.slice(members, first, F.lit(length)), F.slice(members, F.lit(1), first - 1))


def fixed_cycles(edges: DataFrame, source: str, target: str, lengths: Sequence[int]) -> DataFrame:
    """(steps, members): every directed cycle of one of ``lengths`` (3 or more) different nodes, once.

    ``members`` follow the direction and start with the smallest. Edges that
    repeat count once; loops and edges without an end are in no cycle. The node
    with the highest rank of a cycle anchors it: paths from the anchor meet, at
    the middle, paths that lead to it. Both ends are the key of that join, so a
    node in many cycles spreads over their middles.
    """
    if min(lengths) < 3:
        raise ValueError("a cycle has three nodes or more")
    known = cut_lineage(ranked(edges, source, target))
    back = known.select(F.col("dst").alias("src"), F.col("src").alias("dst"),
                        F.col("dst_rank").alias("src_rank"), F.col("src_rank").alias("dst_rank"))
    found = None
    for length in lengths:
        ahead = half_paths(known, length // 2)
        behind = half_paths(back, length - length // 2).withColumnRenamed("inner", "back_inner")
        met = ahead.join(behind, ["anchor", "last"]).filter(~F.arrays_overlap("inner", "back_inner"))
        whole = met.select(F.concat(F.array("anchor"), "inner", F.array("last"), F.reverse("back_inner")).alias("whole"))
        first = F.array_position("whole", F.array_min("whole")).cast("int")
        rows = whole.select(F.lit(length).alias("steps"), _turned(F.col("whole"), first, length).alias("members"))
        found = rows if found is None else found.union(rows)
    return found
