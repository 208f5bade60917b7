"""Graph-pattern operators over node and edge DataFrames.

A shared entity links every two of its members, so pattern results can be
quadratic in entity size. Only the top-k reports below look at pairs, and they
prune before pairing; rings, reach and components stay linear in the edges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewell.functions.columns import number_list_text
from tracewell.operators.parts import part_levels, reached_uses
from tracewell.operators.relational import global_row_number, top_n_per_key
from tracewell.session import cut_lineage

ENTITY = ["entity_type", "entity_id"]


@dataclass(frozen=True)
class NodeTable:
    label: str
    rows: DataFrame
    key: str


@dataclass(frozen=True)
class EdgeTable:
    label: str
    rows: DataFrame
    source: str
    source_key: str
    target: str
    target_key: str


class PropertyGraph:
    """Labels and keys over existing DataFrames; nothing is copied."""

    def __init__(self, nodes: Sequence[NodeTable], edges: Sequence[EdgeTable]):
        self.nodes = {n.label: n for n in nodes}
        self.edges = {e.label: e for e in edges}
        if len(self.nodes) != len(nodes) or len(self.edges) != len(edges):
            raise ValueError("labels must be unique")
        for n in nodes:
            if n.key not in n.rows.columns:
                raise ValueError(f"node {n.label} lacks key {n.key}")
        for e in edges:
            for label, key in ((e.source, e.source_key), (e.target, e.target_key)):
                if label not in self.nodes:
                    raise ValueError(f"edge {e.label} refers to unknown node {label}")
                if key not in e.rows.columns:
                    raise ValueError(f"edge {e.label} lacks key {key}")

    def one_hop(self, label: str, source: Mapping[str, str], target: Mapping[str, str]) -> DataFrame:
        """``(s)-[label]->(t)`` with the given {node column: output name} of both ends.

        Edges whose ends are not in the node tables do not match.
        """
        e = self.edges[label]
        s, t = self.nodes[e.source], self.nodes[e.target]
        left = s.rows.select(F.col(s.key).alias("_s"), *[F.col(c).alias(n) for c, n in source.items()])
        right = t.rows.select(F.col(t.key).alias("_t"), *[F.col(c).alias(n) for c, n in target.items()])
        links = e.rows.select(F.col(e.source_key).alias("_s"), F.col(e.target_key).alias("_t"))
        return links.join(left, "_s").join(right, "_t").select(*source.values(), *target.values())

    def links(self, labels: Sequence[str], members: DataFrame | None = None,
              check_ends: bool = True) -> DataFrame:
        """Edges of several labels as (entity_type, entity_id, member).

        The target label is part of the entity, so equal ids of different node
        tables stay apart. All labels must start at the same node table.
        ``members`` (member) keeps only those sources. Labels that share one
        DataFrame are read from it in a single pass.
        """
        by_rows: dict[tuple[int, str], list[EdgeTable]] = {}
        for label in labels:
            e = self.edges[label]
            by_rows.setdefault((id(e.rows), e.source_key), []).append(e)
        out = None
        for edges in by_rows.values():
            rows = edges[0].rows.withColumn("member", F.col(edges[0].source_key))
            if members is not None:
                rows = rows.join(members.select("member"), "member", "left_semi")
            if check_ends:
                s = self.nodes[edges[0].source]
                rows = rows.join(s.rows.select(F.col(s.key).alias("member")), "member", "left_semi")
            ends = F.array(*[F.struct(F.lit(e.target).alias("entity_type"),
                                      F.col(e.target_key).cast("string").alias("entity_id")) for e in edges])
            rows = rows.select("member", F.inline(ends)).filter("entity_id IS NOT NULL")
            if check_ends:
                known = None
                for e in edges:
                    t = self.nodes[e.target]
                    keys = t.rows.select(F.lit(e.target).alias("entity_type"),
                                         F.col(t.key).cast("string").alias("entity_id"))
                    known = keys if known is None else known.union(keys)
                rows = rows.join(known, ENTITY, "left_semi")
            rows = rows.select(*ENTITY, "member")
            out = rows if out is None else out.unionByName(rows)
        return out


def first_shared_pairs(links: DataFrame, entity: str, member: str, limit: int) -> DataFrame:
    """First ``limit`` rows of (entity, a, b), a < b, in that order, over all shared entities.

    Every shared entity yields a pair, so only the ``limit`` lowest matter; and
    inside one entity the first ``limit`` pairs use its ``limit + 1`` lowest
    members only. So the report is exact and no entity is paired out in full.
    """
    shared = (
        links.groupBy(entity).agg(F.min(member).alias("_lo"), F.max(member).alias("_hi"))
        .filter("_lo < _hi").select(entity).orderBy(entity).limit(limit)
    )
    few = links.join(shared, entity, "left_semi").select(entity, member).distinct()
    low = top_n_per_key(few, [entity], [F.asc(member)], limit + 1, "_rank").drop("_rank")
    a = low.select(entity, F.col(member).alias("a"))
    b = low.select(entity, F.col(member).alias("b"))
    return a.join(b, entity).filter("a < b").orderBy(entity, "a", "b").limit(limit)


def top_shared_pairs(links: DataFrame, limit: int, probe_degree: int = 1000) -> DataFrame:
    """The ``limit`` member pairs sharing most entities: (a, b, shared_entities).

    Ordered by the count descending, then a, b. Works in exact steps:

    1. A lower bound t for the last reported count, from neighbouring members
       of entities with at most ``probe_degree`` members (linear work).
    2. Entities with more members are hot. A pair that shares t entities (two or
       more), any of them not hot, must share one that is not hot outside each
       side's t-1 most popular ones (prefix filter). Counts are exact, probing
       from the smaller side.
    3. Pairs that share hot entities only: members with equal hot sets are one
       class, and pairs of classes are searched instead (``_hot_pairs``).
    4. Room left in the report goes to the first pairs that share one entity.
    """
    edges = cut_lineage(_shared_links(links))
    degree = edges.groupBy(*ENTITY).agg(F.count(F.lit(1)).alias("degree")).filter("degree > 1")
    edges = edges.join(degree, ENTITY)
    size = edges.groupBy("member").agg(F.count(F.lit(1)).alias("size"))
    edges = cut_lineage(edges.join(size, "member"))

    bound = _probe(edges, limit, probe_degree)
    order = [F.desc("shared_entities"), F.asc("a"), F.asc("b")]
    least = max(bound, 2)
    several, hot = _pairs_sharing(edges, least, probe_degree), edges.filter(F.col("degree") > probe_degree)
    if not hot.isEmpty():
        several = several.unionByName(_hot_pairs(hot, least, limit, probe_degree)).groupBy("a", "b").agg(
            F.max("shared_entities").alias("shared_entities"))
    several = several.orderBy(*order).limit(limit)
    if bound >= 2:
        return several
    several = cut_lineage(several)
    single = (
        _first_pairs(edges, 2 * limit).join(several, ["a", "b"], "left_anti")
        .withColumn("shared_entities", F.lit(1).cast("bigint"))
    )
    return several.unionByName(single).orderBy(*order).limit(limit)


def _shared_links(links: DataFrame) -> DataFrame:
    """Distinct links of the entities with two members or more, and perhaps some of others.

    Entities are told apart by a hash of 64 bits, so that the pass over all links
    moves two members and a number for each. Equal hashes only keep a link that
    the degrees leave out.
    """
    hashed = links.withColumn("_hash", F.xxhash64(*ENTITY))
    ends = hashed.groupBy("_hash").agg(F.min("member").alias("_lo"), F.max("member").alias("_hi"))
    return hashed.join(ends.filter("_lo < _hi").select("_hash"), "_hash", "left_semi").select(*links.columns).distinct()


def _probe(edges: DataFrame, limit: int, most: int) -> int:
    """A count that ``limit`` pairs reach, 1 if unknown: pairs of neighbours in entities of ``most`` members or fewer."""
    next_member = F.lead("member").over(Window.partitionBy(*ENTITY).orderBy("member"))
    best = (
        edges.filter(F.col("degree") <= most)
        .select(F.col("member").alias("a"), next_member.alias("b")).filter("b IS NOT NULL")
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n")).limit(limit)
        .agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("bound")).first()
    )
    return best["bound"] if best["pairs"] == limit else 1


def _pairs_sharing(edges: DataFrame, least: int, most: int | None = None) -> DataFrame:
    """Pairs sharing at least ``least`` (two or more) entities, with the exact count.

    ``most`` leaves out pairs that share only entities of more members than that.
    """
    rest = edges.filter(F.col("size") >= least)
    popular = top_n_per_key(
        rest, ["member"], [F.desc("degree"), F.asc("entity_type"), F.asc("entity_id")],
        least - 1, "_rank").select(*ENTITY, "member")
    rest = rest.join(popular, [*ENTITY, "member"], "left_anti")
    if most is not None:
        rest = rest.filter(F.col("degree") <= most)
    a = rest.select(*ENTITY, F.col("member").alias("a"), F.col("size").alias("size_a"))
    b = rest.select(*ENTITY, F.col("member").alias("b"), F.col("size").alias("size_b"))
    candidates = (
        a.join(b, ENTITY).filter("a < b")
        .select("a", "b", F.when(F.col("size_a") <= F.col("size_b"), F.col("a"))
                .otherwise(F.col("b")).alias("small"))
        .distinct()
        .withColumn("large", F.when(F.col("small") == F.col("a"), F.col("b")).otherwise(F.col("a")))
    )
    small = edges.select(F.col("member").alias("small"), *ENTITY)
    large = edges.select(F.col("member").alias("large"), *ENTITY)
    return (
        candidates.join(small, "small").join(large, ["large", *ENTITY], "left_semi")
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared_entities"))
        .filter(F.col("shared_entities") >= least)
    )


def _hot_pairs(hot: DataFrame, least: int, limit: int, probe_degree: int) -> DataFrame:
    """First ``limit`` pairs by hot entities shared (``least`` or more), then a, b.

    Members with equal hot sets, compared by size and two 64-bit XOR
    fingerprints, are interchangeable and form a class, named by its smallest
    member. Classes with many members give a bound for the pairs of classes
    worth finding. Every pair of classes holds a lowest pair of members, so the
    first ``limit`` pairs of classes are enough, and of each class its first
    ``limit + 1`` members.
    """
    key = ["size", "f1", "f2"]
    sets = cut_lineage(
        hot.groupBy("member").agg(
            F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64(*ENTITY)).alias("f1"),
            F.bit_xor(F.xxhash64(F.lit("second"), *ENTITY)).alias("f2"))
        .filter(F.col("size") >= least))
    classes = cut_lineage(sets.groupBy(*key).agg(
        F.min("member").alias("class"), F.count(F.lit(1)).alias("members")))
    grown = (
        classes.filter("members > 1").orderBy(F.desc("size"), F.desc("members")).limit(limit)
        .withColumn("pairs", F.sum(F.col("members") * (F.col("members") - 1) / 2).over(
            Window.orderBy(F.desc("size"), F.desc("members"), "class").rowsBetween(Window.unboundedPreceding, 0)))
        .filter(F.col("pairs") >= limit).agg(F.max("size")).first()[0])
    of_class = hot.select(*ENTITY, F.col("member").alias("class")).join(classes.select("class", "size"), "class")
    degree = of_class.groupBy(*ENTITY).agg(F.count(F.lit(1)).alias("degree"))
    class_edges = cut_lineage(of_class.join(degree, ENTITY).select(
        *ENTITY, F.col("class").alias("member"), "size", "degree"))
    least = max(least, grown or 0, _probe(class_edges, limit, probe_degree))

    members = sets.join(classes, key).select("class", "member")
    second = members.filter("member <> class").groupBy("class").agg(F.min("member").alias("second"))
    inside = classes.filter((F.col("members") > 1) & (F.col("size") >= least)).join(second, "class").select(
        F.col("class").alias("x"), F.col("class").alias("y"), F.col("size").alias("shared_entities"),
        F.col("second"))
    across = _pairs_sharing(class_edges, least).select(
        F.col("a").alias("x"), F.col("b").alias("y"), "shared_entities", F.col("b").alias("second"))
    chosen = cut_lineage(inside.unionByName(across).orderBy(
        F.desc("shared_entities"), "x", "second").limit(limit).drop("second"))
    named = chosen.select(F.explode(F.array("x", "y")).alias("class")).distinct()
    low = cut_lineage(top_n_per_key(
        members.join(named, "class", "left_semi"), ["class"], [F.asc("member")], limit + 1, "_rank"))
    left = low.select(F.col("class").alias("x"), F.col("member").alias("m"))
    right = low.select(F.col("class").alias("y"), F.col("member").alias("n"))
    return (
        chosen.join(left, "x").join(right, "y").filter("x <> y OR m < n")
        .select(F.least("m", "n").alias("a"), F.greatest("m", "n").alias("b"), "shared_entities")
        .orderBy(F.desc("shared_entities"), "a", "b").limit(limit)
    )


def _first_pairs(edges: DataFrame, n: int) -> DataFrame:
    """The first ``n`` distinct pairs (a, b) that share an entity, in order of a, b.

    They come from the entities with the ``n`` lowest distinct pairs of two
    lowest members, and there from the first ``n + 1`` members.
    """
    first = top_n_per_key(edges, ENTITY, [F.asc("member")], n + 1, "_rank")
    lowest = first.filter("_rank <= 2").groupBy(*ENTITY).agg(
        F.min("member").alias("m1"), F.max("member").alias("m2"))
    heads = lowest.select("m1", "m2").distinct().orderBy("m1", "m2").limit(n)
    chosen = lowest.join(heads, ["m1", "m2"], "left_semi").select(*ENTITY)
    low = first.join(chosen, ENTITY, "left_semi").select(*ENTITY, "member")
    a, b = low.withColumnRenamed("member", "a"), low.withColumnRenamed("member", "b")
    return a.join(b, ENTITY).filter("a < b").select("a", "b").distinct().orderBy("a", "b").limit(n)


@dataclass(frozen=True)
class Rings:
    """Rings in long form, so a ring may be of any size.

    summary: ring_id, n_members, first_member, last_member, n_entities, total_returns,
    avg_return_rate, refund_exposure
    members: ring_id, member; entities: ring_id, entity_type, entity_id
    """

    summary: DataFrame
    members: DataFrame
    entities: DataFrame


def detect_rings(graph: PropertyGraph, labels: Sequence[str], stats: DataFrame, *, min_rate: float,
                 min_returns: int, min_members: int = 3, check_ends: bool = True) -> Rings:
    """Groups of entities that the same set of flagged members uses.

    The entities are the targets of the edges ``labels``. ``stats`` has one row per member: member, n_returns, return_rate,
    total_refunds. A member is flagged by its rate and count; a ring is the set
    of entities with identical flagged member sets of at least ``min_members``.

    Member sets are compared by size, extremes and two 64-bit XOR fingerprints,
    which combine map-side: no entity's members meet in one task. Rings are
    numbered by their smallest member, then by their first entity, which no two
    rings share.
    """
    flagged = cut_lineage(
        stats.select("member", "n_returns", "return_rate", "total_refunds")
        .filter((F.col("return_rate") >= min_rate) & (F.col("n_returns") >= min_returns)))
    linked = cut_lineage(graph.links(labels, flagged, check_ends).distinct())

    key = ["n_members", "f1", "f2", "lo", "hi"]
    member_sets = (
        linked.groupBy(*ENTITY)
        .agg(F.count(F.lit(1)).alias("n_members"),
             F.bit_xor(F.xxhash64("member")).alias("f1"),
             F.bit_xor(F.xxhash64(F.lit("second"), "member")).alias("f2"),
             F.min("member").alias("lo"), F.max("member").alias("hi"))
        .filter(F.col("n_members") >= min_members)
    )
    one_entity = (
        member_sets.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n_entities"), F.min(F.struct(*ENTITY)).alias("_first"))
        .select(*key, "n_entities", "_first.*")
    )
    membership = linked.join(one_entity, ENTITY).select(*key, "n_entities", "member")

    numbered = global_row_number(one_entity, ["lo", *ENTITY], "ring_number").select(
        *key, "n_entities",
        F.concat(F.lit("RING-"), F.col("ring_number").cast("string")).alias("ring_id"))

    totals = (
        membership.join(flagged, "member")
        .groupBy(*key)
        .agg(F.sum("n_returns").alias("total_returns"), F.avg("return_rate").alias("avg_return_rate"),
             F.sum("total_refunds").alias("refund_exposure"))
    )
    summary = cut_lineage(numbered.join(totals, key))
    names = summary.select(*key, "ring_id")
    return Rings(
        summary=summary.select("ring_id", "n_members", F.col("lo").alias("first_member"),
                               F.col("hi").alias("last_member"), "n_entities", "total_returns",
                               "avg_return_rate", "refund_exposure"),
        members=membership.join(names, key).select("ring_id", "member"),
        entities=member_sets.join(names, key).select("ring_id", *ENTITY),
    )


def k_hop_reach(links: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """Members reachable from ``seeds`` (member) through shared entities: (member, hop).

    Each hop goes frontier -> entities -> members with semi-joins, so a hop
    costs the edges it touches and never their pairs.
    """
    edges = cut_lineage(links.select(*ENTITY, "member").distinct())
    reached = cut_lineage(seeds.select("member").distinct().withColumn("hop", F.lit(0)))
    frontier = reached.select("member")
    for hop in range(1, hops + 1):
        entities = edges.join(frontier, "member", "left_semi").select(*ENTITY).distinct()
        found = edges.join(entities, ENTITY, "left_semi").select("member").distinct()
        step = cut_lineage(found.join(reached, "member", "left_anti").withColumn("hop", F.lit(hop)))
        reached = reached.unionByName(step)
        frontier = step.select("member")
    return reached


def explode_parts(uses: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, part, level, quantity): all parts below each root, through any number of levels.

    ``uses`` has (whole, part, quantity), ``roots`` (root). Quantities multiply
    down a path and add up over the paths of one length. A level is one join;
    the search ends when a level is empty. A cycle below a root is an error,
    found before the search by peeling the graph (``parts.part_levels``).
    """
    uses = cut_lineage(uses.groupBy("whole", "part").agg(F.sum("quantity").alias("quantity")))
    part_levels(reached_uses(uses, roots))
    step = cut_lineage(roots.select("root").distinct().select("root", F.col("root").alias("part"),
                                                              F.lit(1).cast("bigint").alias("quantity")))
    found, level = None, 0
    while True:
        level += 1
        below = uses.select(F.col("whole").alias("_whole"), F.col("part").alias("_part"), F.col("quantity").alias("_q"))
        step = cut_lineage(step.join(below, F.col("part") == F.col("_whole"))
                           .groupBy("root", F.col("_part").alias("part"))
                           .agg(F.sum(F.col("quantity") * F.col("_q")).alias("quantity")))
        if step.isEmpty():
            break
        rows = step.select("root", "part", F.lit(level).alias("level"), "quantity")
        found = rows if found is None else found.unionByName(rows)
    return step.select("root", "part", F.lit(0).alias("level"), "quantity") if found is None else found


def connected_components(links: DataFrame) -> DataFrame:
    """(member, component): component is the smallest member reachable.

    Each entity's members are first tied to its smallest member (linear in the
    links). Alternating large-star and small-star rounds then contract the
    edges until a round changes nothing; a hub's rows are combined map-side and
    joined back against one row.
    """
    links = cut_lineage(links.select(*ENTITY, "member"))
    lowest = (links.groupBy(*ENTITY).agg(F.min("member").alias("v"), F.max("member").alias("_hi"))
              .filter("v < _hi").drop("_hi"))
    edges = cut_lineage(
        links.join(lowest, ENTITY).filter("member <> v")
        .select(F.col("member").alias("u"), "v").distinct())
    state, summary = None, ()
    while state != summary:
        state = summary
        edges = cut_lineage(_small_star(_large_star(edges)))
        summary = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    tied = edges.select(F.col("u").alias("member"), F.col("v").alias("component"))
    everyone = links.select("member").distinct()
    return everyone.join(tied, "member", "left").select(
        "member", F.coalesce("component", "member").alias("component"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.union(edges.select("v", "u"))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(lowest.select("u", F.col("m").alias("v"))).distinct()
