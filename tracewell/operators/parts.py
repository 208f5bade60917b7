"""Bills of materials with shared sub-assemblies: levels and total quantities.

The relation ``uses`` has (whole, part, quantity). Levels are peeled off from the
top: a node is free once nothing that is left uses it, so an edge is dropped with
its whole, and a cycle shows as soon as no node is free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.session import cut_lineage, discard


def reached_uses(uses: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of ``uses`` at or below ``roots`` (root). A row is met once, in cycles too."""
    seen = frontier = cut_lineage(roots.select(F.col("root").alias("whole")).distinct())
    found = None
    while True:
        step = cut_lineage(uses.join(frontier, "whole", "left_semi"))
        if step.isEmpty():
            return step if found is None else found
        found = step if found is None else found.unionByName(step)
        frontier = cut_lineage(
            step.select(F.col("part").alias("whole")).distinct().join(seen, "whole", "left_anti"))
        seen = seen.unionByName(frontier)


def part_levels(uses: DataFrame) -> DataFrame:
    """(node, level): edges on the longest path from any top node down to the node.

    Raises ValueError where parts contain themselves, after as many rounds as the
    part of the graph without cycles is deep. Rounds look at edges between wholes
    that are left; nodes without parts get their level at the end, from their users.
    """
    edges = cut_lineage(uses.select("whole", "part").distinct())
    wholes = edges.select(F.col("whole").alias("part")).distinct()
    left = cut_lineage(edges.join(wholes, "part", "left_semi").select("whole", "part"))
    todo = cut_lineage(wholes.select(F.col("part").alias("node")))
    found, level = None, 0
    while not todo.isEmpty():
        used = left.select(F.col("part").alias("node"), F.lit(True).alias("used")).distinct()
        split = cut_lineage(todo.join(used, "node", "left"))
        free = split.filter("used IS NULL").select("node")
        if free.isEmpty():
            raise ValueError("the parts contain themselves")
        rows = free.withColumn("level", F.lit(level))
        found = rows if found is None else found.unionByName(rows)
        rest = cut_lineage(left.join(free.select(F.col("node").alias("whole")), "whole", "left_anti"))
        discard(left)
        todo, left, level = split.filter("used").select("node"), rest, level + 1
    if found is None:
        return todo.withColumn("level", F.lit(0))
    found = cut_lineage(found)
    leaves = (edges.join(found.select(F.col("node").alias("whole"), "level"), "whole")
              .groupBy(F.col("part").alias("node")).agg((F.max("level") + 1).alias("level"))
              .join(found, "node", "left_anti"))
    return found.unionByName(leaves)


def total_parts(uses: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, part, quantity): how much of each part a root holds, over all paths.

    Quantities multiply down a path and add up over paths of any length. Parts are
    settled level by level: when a level's turn comes, all that uses its nodes has
    been added up, so each edge is joined once per root above it however many paths
    lead there. Roots may lie below each other. A cycle below a root is an error.
    """
    uses = cut_lineage(uses.groupBy("whole", "part").agg(F.sum("quantity").alias("quantity")))
    below = reached_uses(uses, roots)
    levels = cut_lineage(part_levels(below))
    edges = cut_lineage(
        below.join(levels.select(F.col("node").alias("whole"), F.col("level").alias("from_level")), "whole")
        .join(levels.select(F.col("node").alias("part"), F.col("level").alias("to_level")), "part")
        .select("whole", F.col("part").alias("to"), F.col("quantity").alias("each"), "from_level", "to_level"))
    own = roots.select("root").distinct().join(
        levels.select(F.col("node").alias("root"), "level"), "root")
    open_sums = cut_lineage(own.select(
        "root", F.col("root").alias("part"), "level", F.lit(1).cast("bigint").alias("quantity")))
    found = open_sums.filter(F.lit(False)).select("root", "part", "quantity")
    depth = levels.agg(F.max("level")).first()[0]
    for level in range((depth or 0) + 1):
        settled = cut_lineage(open_sums.filter(F.col("level") == level).select("root", "part", "quantity"))
        found = found.unionByName(settled.filter("part <> root"))
        made = settled.join(
            edges.filter(F.col("from_level") == level), F.col("part") == F.col("whole")
        ).select("root", F.col("to").alias("part"), F.col("to_level").alias("level"),
                 (F.col("quantity") * F.col("each")).alias("quantity"))
        open_sums = cut_lineage(
            open_sums.filter(F.col("level") > level).unionByName(made)
            .groupBy("root", "part", "level").agg(F.sum("quantity").alias("quantity")))
    return found
