"""Graph queries: linked accounts, rings, reach and components over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.functions.columns import ratio
from tracewell.operators.cycles import fixed_cycles
from tracewell.operators.graph import (
    EdgeTable, NodeTable, PropertyGraph, Rings, connected_components, detect_rings, explode_parts,
    first_shared_pairs, k_hop_reach, top_shared_pairs,
)
from tracewell.operators.parts import part_levels, total_parts
from tracewell.operators.relational import top_n_list
from tracewell.plans.registry import query
from tracewell.session import cut_lineage
from tracewell.sources.tables import Tables, spread

MIN_RATE, MIN_RETURNS, MIN_MEMBERS = 0.5, 3, 3

STATS_SQL = """
  cust_stats AS (
    SELECT o_custkey AS customer, count(DISTINCT o_orderkey) AS n_orders, count(l_orderkey) AS n_items,
           count(*) FILTER (l_returnflag = 'R') AS n_returns,
           count(DISTINCT CASE WHEN l_returnflag = 'R' THEN o_orderkey END) AS n_returned_orders,
           count(*) FILTER (l_returnflag = 'R') / nullif(count(l_orderkey), 0)::DOUBLE AS return_rate,
           round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice * (1 - l_discount) ELSE 0 END), 4)
             AS total_refunds
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)"""

RINGS_SQL = f"""
  WITH line AS (
    SELECT o_custkey AS customer, l_partkey, l_suppkey, l_returnflag = 'R' AS back,
           CASE WHEN l_returnflag = 'R' THEN l_extendedprice * (1 - l_discount) ELSE 0 END AS refund
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
  risky AS (
    SELECT customer, count_if(back) AS n_back, count_if(back) / count(*)::DOUBLE AS rate, round(sum(refund), 4) AS refunds
    FROM line GROUP BY customer HAVING count_if(back) >= {MIN_RETURNS} AND count_if(back) / count(*)::DOUBLE >= {MIN_RATE}),
  touch AS (
    SELECT DISTINCT u.* FROM (
      SELECT customer, unnest([{{'kind': 'Part', 'id': l_partkey::VARCHAR}}, {{'kind': 'Supplier', 'id': l_suppkey::VARCHAR}}],
                              recursive := true) FROM line
      UNION ALL SELECT c_custkey, 'Cohort', c_nationkey || '/' || c_mktsegment FROM customer) u
    SEMI JOIN risky USING (customer)),
  clientele AS (
    SELECT kind, id, array_agg(customer ORDER BY customer) AS who FROM touch GROUP BY ALL HAVING count(*) >= {MIN_MEMBERS}),
  ring AS (
    SELECT 'RING-' || row_number() OVER (ORDER BY who[1], min(kind || ':' || id)) AS ring_id, who, count(*) AS n_entities
    FROM clientele GROUP BY who),
  ring_user AS (SELECT ring_id, unnest(who) AS customer FROM ring),
  ring_sum AS (
    SELECT ring_id, sum(n_back)::BIGINT AS total_returns, round(avg(rate), 6) AS avg_return_rate,
           round(sum(refunds), 4) AS refund_exposure
    FROM ring_user JOIN risky USING (customer) GROUP BY ring_id)"""

SAME_DAY_SQL = """
  links AS (SELECT DISTINCT l_partkey || '@' || l_shipdate::DATE AS entity, o_custkey AS member
            FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
  pairs AS (SELECT DISTINCT x.member AS a, y.member AS b
            FROM links x JOIN links y ON x.entity = y.entity AND x.member <> y.member)"""


def customer_stats(t: Tables) -> DataFrame:
    """One row per customer with orders: counts, return rate, refunds.

    Line items are summed per order first, so the distinct counts become plain
    counts and the join is one row to one row.
    """
    refund = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    is_return = F.col("l_returnflag") == "R"
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("items"), F.count_if(is_return).alias("returns"),
        F.sum(F.when(is_return, refund).otherwise(0.0)).alias("refunds"))
    joined = t.orders.select("o_orderkey", "o_custkey").join(per_order, "o_orderkey", "left")
    return (
        joined.groupBy(F.col("o_custkey").alias("member"))
        .agg(F.count(F.lit(1)).alias("n_orders"),
             F.coalesce(F.sum("items"), F.lit(0)).alias("n_items"),
             F.coalesce(F.sum("returns"), F.lit(0)).alias("n_returns"),
             F.count_if(F.col("returns") > 0).alias("n_returned_orders"),
             F.round(F.coalesce(F.sum("refunds"), F.lit(0.0)), 4).alias("total_refunds"))
        .withColumn("return_rate", ratio(F.col("n_returns"), F.col("n_items")))
    )


def order_lines(t: Tables, *columns: str) -> DataFrame:
    """Line items with the customer of their order."""
    lines = spread(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), *columns), "o_orderkey")
    return t.orders.select("o_orderkey", "o_custkey").join(lines, "o_orderkey")


def trade_graph(t: Tables, bought: DataFrame | None = None) -> PropertyGraph:
    """Customers linked to the parts, suppliers and cohorts they share."""
    if bought is None:
        bought = order_lines(t, "l_partkey", "l_suppkey", "l_returnflag")
    cohort = F.concat_ws("/", F.col("c_nationkey").cast("string"), "c_mktsegment")
    in_cohort = t.customer.select("c_custkey", cohort.alias("cohort"))
    return PropertyGraph(
        nodes=[
            NodeTable("Customer", t.customer, "c_custkey"),
            NodeTable("Part", t.part, "p_partkey"),
            NodeTable("Supplier", t.supplier, "s_suppkey"),
            NodeTable("Cohort", in_cohort.select("cohort").distinct(), "cohort"),
        ],
        edges=[
            EdgeTable("BOUGHT", bought, "Customer", "o_custkey", "Part", "l_partkey"),
            EdgeTable("BUYS_FROM", bought, "Customer", "o_custkey", "Supplier", "l_suppkey"),
            EdgeTable("RETURNED_TO", bought.filter("l_returnflag = 'R'"),
                      "Customer", "o_custkey", "Supplier", "l_suppkey"),
            EdgeTable("BELONGS_TO", in_cohort, "Customer", "c_custkey", "Cohort", "cohort"),
        ],
    )


def rings(t: Tables) -> Rings:
    """Rings of customers; order lines are joined once, for the rates and for the edges."""
    refund = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = cut_lineage(order_lines(t, "l_partkey", "l_suppkey", "l_returnflag", refund.alias("refund")))
    back = F.col("l_returnflag") == "R"
    stats = lines.groupBy(F.col("o_custkey").alias("member")).agg(
        F.count_if(back).alias("n_returns"), (F.count_if(back) / F.count(F.lit(1))).alias("return_rate"),
        F.round(F.sum(F.when(back, F.col("refund")).otherwise(0.0)), 4).alias("total_refunds"))
    # The edges come straight from foreign keys, so their ends need no check.
    return detect_rings(trade_graph(t, lines), ["BOUGHT", "BUYS_FROM", "BELONGS_TO"], stats,
                        min_rate=MIN_RATE, min_returns=MIN_RETURNS, min_members=MIN_MEMBERS, check_ends=False)


def same_day_links(t: Tables) -> DataFrame:
    """Customers who were shipped the same part on the same day."""
    return order_lines(t, "l_partkey", "l_shipdate").select(
        F.lit("shipment").alias("entity_type"),
        F.concat_ws("@", F.col("l_partkey").cast("string"), F.col("l_shipdate").cast("date").cast("string"))
        .alias("entity_id"),
        F.col("o_custkey").alias("member"))


@query("customer_return_stats", sql=f"""
    WITH {STATS_SQL}
    SELECT customer, n_orders, n_items, n_returns, n_returned_orders,
           round(return_rate, 6) AS return_rate, total_refunds FROM cust_stats""")
def customer_return_stats(t: Tables):
    return customer_stats(t).select(
        F.col("member").alias("customer"), "n_orders", "n_items", "n_returns", "n_returned_orders",
        F.round("return_rate", 6).alias("return_rate"), "total_refunds")


@query("ring_detection", sql=f"""{RINGS_SQL}
    SELECT ring_id, len(who) AS n_members, list_min(who) AS first_member, list_max(who) AS last_member, n_entities,
           total_returns, avg_return_rate, refund_exposure
    FROM ring JOIN ring_sum USING (ring_id)""")
def ring_detection(t: Tables):
    """One row per ring, whatever its size; its members and entities are in long form."""
    return rings(t).summary.withColumns({
        "avg_return_rate": F.round("avg_return_rate", 6), "refund_exposure": F.round("refund_exposure", 4)})


@query("ring_members", sql=f"""{RINGS_SQL} SELECT ring_id, customer FROM ring_user""")
def ring_members(t: Tables):
    return rings(t).members.select("ring_id", F.col("member").alias("customer"))


@query("ring_entities", sql=f"""{RINGS_SQL}
    SELECT ring_id, kind AS entity_type, id AS entity_id FROM ring JOIN clientele USING (who)""")
def ring_entities(t: Tables):
    return rings(t).entities


@query("ring_member_explode", sql=f"""{RINGS_SQL},
    truth AS (SELECT c_custkey AS customer, 'overdrawn' AS scheme FROM customer WHERE c_acctbal < 0)
    SELECT ring_id, count(*) AS n_members, count(scheme) AS n_in_truth,
           min(customer) FILTER (scheme IS NOT NULL) AS first_in_truth
    FROM ring_user LEFT JOIN truth USING (customer) GROUP BY 1""")
def ring_member_explode(t: Tables):
    """Ring members checked against a separate list the detection never reads."""
    truth = t.customer.filter("c_acctbal < 0").select(
        F.col("c_custkey").alias("member"), F.lit("overdrawn").alias("scheme"))
    return rings(t).members.join(truth, "member", "left").groupBy("ring_id").agg(
        F.count(F.lit(1)).alias("n_members"), F.count("scheme").alias("n_in_truth"),
        F.min(F.when(F.col("scheme").isNotNull(), F.col("member"))).alias("first_in_truth"))


def line_scores(t: Tables) -> DataFrame:
    """Returned lines with a yes/no judgement, per customer."""
    returned = t.lineitem.filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"),
        ((F.col("l_quantity") >= 25) & (F.col("l_discount") >= 0.05)).alias("is_suspicious"))
    return returned.join(t.orders.select("o_orderkey", F.col("o_custkey").alias("member")), "o_orderkey")


@query("dashboard_view", sql=f"""{RINGS_SQL},
    scores AS (
      SELECT o_custkey AS customer, l_quantity >= 25 AND l_discount >= 0.05 AS is_suspicious
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'),
    ai AS (SELECT ring_id, count(*) AS scored_returns, count(*) FILTER (is_suspicious) AS flagged_returns
           FROM ring_user JOIN scores USING (customer) GROUP BY 1)
    SELECT ring_id, len(who) AS n_members, n_entities, total_returns, avg_return_rate, refund_exposure,
           scored_returns, flagged_returns,
           printf('%s: %d members, %d shared entities, %d returns', ring_id, len(who), n_entities,
                  total_returns) AS brief
    FROM ring JOIN ring_sum USING (ring_id) LEFT JOIN ai USING (ring_id)""")
def dashboard_view(t: Tables):
    found = rings(t)
    per_member = line_scores(t).groupBy("member").agg(
        F.count(F.lit(1)).alias("scored"), F.count_if("is_suspicious").alias("flagged"))
    scored = found.members.join(per_member, "member").groupBy("ring_id").agg(
        F.sum("scored").alias("scored_returns"), F.sum("flagged").alias("flagged_returns"))
    return found.summary.join(scored, "ring_id", "left").select(
        "ring_id", "n_members", "n_entities", "total_returns",
        F.round("avg_return_rate", 6).alias("avg_return_rate"),
        F.round("refund_exposure", 4).alias("refund_exposure"), "scored_returns", "flagged_returns",
        F.format_string("%s: %d members, %d shared entities, %d returns", "ring_id", "n_members",
                        "n_entities", "total_returns").alias("brief"))


@query("ring_evidence_pack", sql=f"""{RINGS_SQL},
    kinds AS (
      SELECT DISTINCT ring_id, p_type FROM ring_user JOIN orders ON o_custkey = customer
        JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
      WHERE l_returnflag = 'R'),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY ring_id ORDER BY p_type) AS k FROM kinds),
    samples AS (SELECT ring_id, string_agg(p_type, ' | ' ORDER BY p_type) AS kinds FROM ranked
                WHERE k <= 5 GROUP BY 1)
    SELECT ring_id, printf('ring=%s members=%d returns=%d rate=%.4f exposure=%d returned types: %s',
        ring_id, len(who), total_returns, round(avg_return_rate, 4), floor(refund_exposure)::BIGINT, coalesce(kinds, '-')) AS evidence
    FROM ring JOIN ring_sum USING (ring_id) LEFT JOIN samples USING (ring_id)""")
def ring_evidence_pack(t: Tables):
    """The facts a case brief is written from, one text per ring."""
    found = rings(t)
    returned = (
        t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"),
                                                        F.col("l_partkey").alias("p_partkey"))
        .join(t.orders.select("o_orderkey", F.col("o_custkey").alias("member")), "o_orderkey")
        .join(found.members.select("member").distinct(), "member", "left_semi")
        .join(t.part.select("p_partkey", "p_type"), "p_partkey")
        .select("member", "p_type").distinct()
    )
    kinds = found.members.join(returned, "member").select("ring_id", "p_type").distinct()
    samples = top_n_list(kinds, ["ring_id"], "p_type", [F.asc("p_type")], 5, "kinds")
    return found.summary.join(samples, "ring_id", "left").select(
        "ring_id",
        F.format_string("ring=%s members=%d returns=%d rate=%.4f exposure=%d returned types: %s",
                        "ring_id", "n_members", "total_returns", F.round("avg_return_rate", 4),
                        F.floor(F.round("refund_exposure", 4)),
                        F.coalesce(F.array_join("kinds", " | "), F.lit("-"))).alias("evidence"))


@query("graph_one_hop", sql="""
    SELECT c_name, c_mktsegment, s_name, count(*) AS n_returns
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
      JOIN supplier ON s_suppkey = l_suppkey
    WHERE l_returnflag = 'R' GROUP BY 1, 2, 3 HAVING count(*) >= 3""")
def graph_one_hop(t: Tables):
    hops = trade_graph(t).one_hop("RETURNED_TO", {"c_name": "c_name", "c_mktsegment": "c_mktsegment"},
                                  {"s_name": "s_name"})
    return (hops.groupBy("c_name", "c_mktsegment", "s_name").agg(F.count(F.lit(1)).alias("n_returns"))
            .filter("n_returns >= 3"))


@query("shared_entity_pairs", sql="""
    WITH uses AS (SELECT DISTINCT l_partkey AS shared_part, o_custkey AS c
                  FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
    SELECT x.c AS customer_a, y.c AS customer_b, shared_part
    FROM uses x JOIN uses y USING (shared_part) WHERE x.c < y.c
    ORDER BY shared_part, customer_a, customer_b LIMIT 50""")
def shared_entity_pairs(t: Tables):
    bought = trade_graph(t).edges["BOUGHT"].rows.select(
        F.col("l_partkey").alias("shared_part"), F.col("o_custkey").alias("member"))
    return first_shared_pairs(bought, "shared_part", "member", 50).select(
        F.col("a").alias("customer_a"), F.col("b").alias("customer_b"), "shared_part")


@query("multi_entity_pairs", sql="""
    WITH links AS (
      SELECT 'Part' AS kind, l_partkey || '@' || l_shipdate::DATE AS id, o_custkey AS c
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey
      UNION SELECT 'Supplier', l_suppkey || '@' || l_shipdate::DATE, o_custkey
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
    SELECT x.c AS customer_a, y.c AS customer_b, count(*) AS shared_entities
    FROM links x JOIN links y USING (kind, id) WHERE x.c < y.c
    GROUP BY 1, 2 ORDER BY shared_entities DESC, customer_a, customer_b LIMIT 50""")
def multi_entity_pairs(t: Tables):
    """Customers sharing most shipments, by part and day or by supplier and day."""
    day = F.col("l_shipdate").cast("date").cast("string")
    shipped = order_lines(t, "l_partkey", "l_suppkey", "l_shipdate").select(
        "o_custkey", F.concat_ws("@", F.col("l_partkey").cast("string"), day).alias("part_day"),
        F.concat_ws("@", F.col("l_suppkey").cast("string"), day).alias("supplier_day"))
    graph = PropertyGraph(
        nodes=[NodeTable("Customer", t.customer, "c_custkey"),
               NodeTable("Part", t.part, "p_partkey"), NodeTable("Supplier", t.supplier, "s_suppkey")],
        edges=[EdgeTable("PART_DAY", shipped, "Customer", "o_custkey", "Part", "part_day"),
               EdgeTable("SUPPLIER_DAY", shipped, "Customer", "o_custkey", "Supplier", "supplier_day")])
    links = graph.links(["PART_DAY", "SUPPLIER_DAY"], check_ends=False)
    return top_shared_pairs(links, 50).select(
        F.col("a").alias("customer_a"), F.col("b").alias("customer_b"), "shared_entities")


@query("k_hop_reach", sql=f"""
    WITH RECURSIVE {STATS_SQL}, {SAME_DAY_SQL},
    reach(member, hop) AS (
      SELECT customer, 0 FROM cust_stats WHERE return_rate >= {MIN_RATE} AND n_returns >= {MIN_RETURNS}
      UNION SELECT b, hop + 1 FROM reach JOIN pairs ON a = member WHERE hop < 3)
    SELECT member, min(hop) AS hop FROM reach GROUP BY 1""")
def k_hop_reach_query(t: Tables):
    """Customers within three shared shipments of a flagged one."""
    seeds = customer_stats(t).filter(
        (F.col("return_rate") >= MIN_RATE) & (F.col("n_returns") >= MIN_RETURNS))
    return k_hop_reach(same_day_links(t), seeds, 3)


PARTS_SQL = """
  uses AS (
    SELECT 'region ' || n_regionkey AS whole, 'nation ' || n_nationkey AS part, 1 AS quantity FROM nation
    UNION ALL SELECT 'nation ' || s_nationkey, 'supplier ' || s_suppkey, 1 FROM supplier
    UNION ALL SELECT 'supplier ' || l_suppkey, 'type ' || p_type, count(*)
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)"""


@query("parts_explosion", sql=f"""
    WITH RECURSIVE {PARTS_SQL},
    below(root, part, level, quantity) AS (
      SELECT 'region ' || r_regionkey, 'region ' || r_regionkey, 0, 1::BIGINT FROM region
      UNION ALL SELECT root, u.part, level + 1, b.quantity * u.quantity FROM below b JOIN uses u ON u.whole = b.part)
    SELECT root, part, level, sum(quantity)::BIGINT AS quantity FROM below WHERE level > 0 GROUP BY 1, 2, 3""")
def parts_explosion(t: Tables):
    """What each region is made of, down to the lines per part type its suppliers sold."""
    return explode_parts(part_uses(t), regions(t))


def named(kind: str, column: str):
    return F.concat(F.lit(f"{kind} "), F.col(column).cast("string"))


def regions(t: Tables):
    return t.region.select(named("region", "r_regionkey").alias("root"))


def part_uses(t: Tables):
    """(whole, part, quantity) from regions over nations and suppliers to types of parts."""
    sold = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_suppkey").join(
        t.part.select("p_partkey", "p_type"), "p_partkey").groupBy("l_suppkey", "p_type").agg(
        F.count(F.lit(1)).alias("quantity"))
    one = F.lit(1).cast("bigint").alias("quantity")
    return (t.nation.select(named("region", "n_regionkey").alias("whole"), named("nation", "n_nationkey").alias("part"), one)
            .union(t.supplier.select(named("nation", "s_nationkey"), named("supplier", "s_suppkey"), one))
            .union(sold.select(named("supplier", "l_suppkey"), named("type", "p_type"), "quantity")))


SHARED_PARTS_SQL = f"""{PARTS_SQL},
  shared AS (
    SELECT * FROM uses
    UNION ALL SELECT 'type ' || p_type, 'brand ' || p_brand, count(*) FROM part GROUP BY 1, 2
    UNION ALL SELECT 'supplier ' || l_suppkey, 'brand ' || p_brand, count(*)
    FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R' GROUP BY 1, 2)"""


def shared_part_uses(t: Tables):
    """Types share brands, which suppliers lead to directly as well, so paths differ in length."""
    count = F.count(F.lit(1)).alias("quantity")
    of_type = t.part.groupBy(named("type", "p_type").alias("whole"), named("brand", "p_brand").alias("part")).agg(count)
    returned = (t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey")
                .join(t.part.select("p_partkey", "p_brand"), "p_partkey")
                .groupBy(named("supplier", "l_suppkey").alias("whole"), named("brand", "p_brand").alias("part")).agg(count))
    return part_uses(t).union(of_type).union(returned)


@query("parts_totals", sql=f"""
    WITH RECURSIVE {SHARED_PARTS_SQL},
    below(root, part, quantity) AS (
      SELECT 'region ' || r_regionkey, 'region ' || r_regionkey, 1::BIGINT FROM region
      UNION ALL SELECT root, u.part, b.quantity * u.quantity FROM below b JOIN shared u ON u.whole = b.part)
    SELECT root, part, sum(quantity)::BIGINT AS quantity FROM below WHERE part <> root GROUP BY 1, 2""")
def parts_totals(t: Tables):
    """How much of everything a region holds, over shared sub-assemblies and all paths."""
    return total_parts(shared_part_uses(t), regions(t))


@query("parts_levels", sql=f"""
    WITH RECURSIVE {SHARED_PARTS_SQL},
    deep(node, level) AS (
      SELECT DISTINCT whole, 0 FROM shared WHERE whole NOT IN (SELECT part FROM shared)
      UNION SELECT u.part, level + 1 FROM deep JOIN shared u ON u.whole = node)
    SELECT node, max(level) AS level FROM deep GROUP BY 1""")
def parts_levels(t: Tables):
    """Levels of the bill of materials, by the longest path from the top."""
    return part_levels(shared_part_uses(t))


@query("entity_components", sql=f"""
    WITH RECURSIVE {SAME_DAY_SQL},
    reach(member, other) AS (
      SELECT DISTINCT member, member FROM links
      UNION SELECT reach.member, b FROM reach JOIN pairs ON a = other)
    SELECT member, min(other) AS component FROM reach GROUP BY 1""")
def entity_components(t: Tables):
    return connected_components(same_day_links(t))


TRADE_SQL = """
  trade AS (
    SELECT 'S' || l_suppkey AS a, 'P' || l_partkey AS b FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45
    UNION SELECT 'P' || l_partkey, 'C' || o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE l_returnflag = 'R' AND l_discount >= 0.08
    UNION SELECT 'C' || o_custkey, 'S' || l_suppkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE l_returnflag = 'R' AND l_quantity < 3
    UNION SELECT 'C' || o_custkey, 'P' || l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE l_returnflag = 'R' AND l_tax >= 0.08)"""


def cycles_sql(length: int) -> str:
    """Cycles by joining one edge after the other, from the smallest node."""
    joins = " ".join(f"JOIN trade e{i} ON e{i}.a = e{i - 1}.b" for i in range(2, length + 1))
    larger = " AND ".join(f"e{i}.a > e1.a" for i in range(2, length + 1))
    unlike = "".join(f" AND e{i}.a <> e{j}.a" for j in range(3, length + 1) for i in range(2, j))
    members = ", ".join(f"e{i}.a" for i in range(1, length + 1))
    return f"SELECT {length} AS steps, [{members}] AS m FROM trade e1 {joins} WHERE e{length}.b = e1.a AND {larger}{unlike}"


@query("trade_cycles", sql=f"""
    WITH {TRADE_SQL}
    SELECT steps, array_to_string(m, ' > ') AS members FROM ({" UNION ALL ".join(map(cycles_sql, (3, 4, 5)))})""")
def trade_cycles(t: Tables):
    """Cycles of three to five steps through suppliers, parts and customers.

    A supplier leads to the parts it ships in bulk, a part to customers who returned
    it at a high discount, a customer to suppliers of small returns and to parts
    returned at a high tax.
    """
    lines = t.lineitem.filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_quantity", "l_discount", "l_tax",
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("s"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("p"))
    lines = lines.join(t.orders.select("o_orderkey", F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("c")),
                       "o_orderkey")
    ways = [("s", "p", F.col("l_quantity") >= 45), ("p", "c", F.col("l_discount") >= 0.08),
            ("c", "s", F.col("l_quantity") < 3), ("c", "p", F.col("l_tax") >= 0.08)]
    edges = cut_lineage(lines.select(F.inline(F.filter(
        F.array(*[F.struct(F.col(a).alias("a"), F.col(b).alias("b"), when.alias("holds")) for a, b, when in ways]),
        lambda e: e["holds"]))).select("a", "b"))
    return fixed_cycles(edges, "a", "b", (3, 4, 5)).select("steps", F.array_join("members", " > ").alias("members"))
