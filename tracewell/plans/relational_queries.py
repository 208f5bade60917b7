"""Relational queries: scans, projections, joins, aggregates, windows, top-k, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell.functions.columns import (
    hash_bucket, md5_bucket, number_list_text, ratio, sunday_week,
)
from tracewell.operators.relational import (
    first_per_key, priority_batch, running_before, top_n_list, top_n_per_key,
)
from tracewell.plans.registry import query
from tracewell.session import new_path
from tracewell.sources.tables import TableStore, Tables, literal_rows

def revenue():
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


# Meanings given to the return flags of the line items.
RETURN_FLAGS = [("A", "accepted", 0), ("N", "not returned", 0), ("R", "returned", 1)]


@query("literal_dim_join", sql="""
    SELECT d.meaning AS meaning, d.counts_as_return AS counts_as_return,
           count(*) AS n_lines, round(sum(l_quantity), 2) AS quantity
    FROM lineitem JOIN (VALUES ('A', 'accepted', 0), ('N', 'not returned', 0),
                               ('R', 'returned', 1)) d(flag, meaning, counts_as_return)
      ON l_returnflag = d.flag
    GROUP BY 1, 2""")
def literal_dim_join(t: Tables):
    dim = literal_rows(t.spark, RETURN_FLAGS, "flag string, meaning string, counts_as_return int")
    per_flag = t.lineitem.groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    return per_flag.join(dim, "flag").select("meaning", "counts_as_return", "n_lines", "quantity")


@query("range_spine", sql="""
    WITH spans AS (
      SELECT o_orderpriority AS priority, date_trunc('month', min(o_orderdate)) AS a,
             date_trunc('month', max(o_orderdate)) AS b FROM orders GROUP BY 1),
    spine AS (
      SELECT priority, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 MONTH)) AS m,
             s.status AS status
      FROM spans, (VALUES ('F'), ('O'), ('P'), ('X')) s(status)),
    counts AS (
      SELECT o_orderpriority AS priority, date_trunc('month', o_orderdate)::TIMESTAMP AS m,
             o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1, 2, 3)
    SELECT priority, strftime(m, '%Y-%m') AS month, status, coalesce(n, 0)::BIGINT AS n_orders
    FROM spine LEFT JOIN counts USING (priority, m, status)""")
def range_spine(t: Tables):
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    counts = t.orders.groupBy(
        F.col("o_orderpriority").alias("priority"), month.alias("m"),
        F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    spine = (
        counts.groupBy("priority").agg(F.min("m").alias("a"), F.max("m").alias("b"))
        .select("priority", F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("m"))
        .select("priority", "m",
                F.explode(F.array(*[F.lit(s) for s in ("F", "O", "P", "X")])).alias("status"))
    )
    return spine.join(counts, ["priority", "m", "status"], "left").select(
        "priority", F.date_format("m", "yyyy-MM").alias("month"), "status",
        F.coalesce("n", F.lit(0)).alias("n_orders"))


@query("hash_bucket_sample", sql="""
    SELECT ('0x' || substr(md5(c_custkey::VARCHAR), 1, 8))::BIGINT % 100 AS bucket,
           count(*) AS n_customers, round(sum(c_acctbal), 2) AS balance
    FROM customer GROUP BY 1 HAVING bucket < 20""")
def hash_bucket_sample(t: Tables):
    """Deterministic 20 % sample: the sampling rule is the feature."""
    bucket = md5_bucket(100, F.col("c_custkey").cast("string"))
    return (
        t.customer.select(bucket.alias("bucket"), "c_acctbal").filter("bucket < 20")
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n_customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    )


@query("ctas_roundtrip", sql="""
    SELECT l_suppkey, count(*) AS n_lines, round(sum(l_quantity), 2) AS quantity,
           count(*) FILTER (l_returnflag = 'R') AS n_returns
    FROM lineitem GROUP BY 1
    UNION ALL SELECT -1, count(*), round(sum(l_quantity), 2), 0 FROM lineitem""")
def ctas_roundtrip(t: Tables):
    store = TableStore(t.spark, new_path(t.spark, "ctas"))
    per_supplier = t.lineitem.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returns"))
    written = store.replace("supplier_lines", per_supplier)
    store.create_if_missing("supplier_lines", per_supplier)  # keeps the rows just written
    totals = written.agg(
        F.lit(-1).cast("bigint").alias("l_suppkey"), F.sum("n_lines").alias("n_lines"),
        F.round(F.sum("quantity"), 2).alias("quantity"), F.lit(0).cast("bigint").alias("n_returns"))
    return store.append("supplier_lines", totals)


@query("project_filter", sql="""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
           strftime(o_orderdate, '%Y-%m-%d') AS order_day, round(o_totalprice / 100, 4) AS hundreds
    FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'
      AND o_orderpriority IN ('1-URGENT', '2-HIGH')
      AND (o_totalprice >= 250000 OR o_orderstatus = 'F') AND o_orderstatus <> 'P'""")
def project_filter(t: Tables):
    o = t.orders
    kept = o.filter(
        F.col("o_orderdate").between(F.lit("1997-01-01").cast("timestamp_ntz"),
                                     F.lit("1997-12-31").cast("timestamp_ntz"))
        & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & ((F.col("o_totalprice") >= 250000) | (F.col("o_orderstatus") == "F"))
        & (F.col("o_orderstatus") != "P"))
    return kept.select(
        "*", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"),
        F.round(F.col("o_totalprice") / 100, 4).alias("hundreds"),
    ).drop("o_totalprice", "o_orderdate")


@query("struct_fields", sql="""
    SELECT s_nationkey, count(*) AS metrics_count, round(avg(s_acctbal), 4) AS metrics_avg,
           min(s_acctbal) AS metrics_min, max(s_acctbal) AS metrics_max
    FROM supplier GROUP BY 1""")
def struct_fields(t: Tables):
    packed = t.supplier.groupBy("s_nationkey").agg(F.struct(
        F.count(F.lit(1)).alias("count"), F.avg("s_acctbal").alias("avg"),
        F.min("s_acctbal").alias("min"), F.max("s_acctbal").alias("max")).alias("metrics"))
    return packed.select(
        "s_nationkey", F.col("metrics.count").alias("metrics_count"),
        F.round("metrics.avg", 4).alias("metrics_avg"), F.col("metrics.min").alias("metrics_min"),
        F.col("metrics.max").alias("metrics_max"))


@query("array_lookup", sql="""
    SELECT (['new', 'regular', 'vip', 'occasional'])[1 + (c_custkey % 4)] AS tier,
           count(*) AS n_customers, round(avg(c_acctbal), 4) AS avg_balance
    FROM customer GROUP BY 1""")
def array_lookup(t: Tables):
    tiers = F.array(*[F.lit(x) for x in ("new", "regular", "vip", "occasional")])
    tier = tiers[F.pmod("c_custkey", F.lit(4)).cast("int")]
    return t.customer.groupBy(tier.alias("tier")).agg(
        F.count(F.lit(1)).alias("n_customers"), F.round(F.avg("c_acctbal"), 4).alias("avg_balance"))


@query("cohort_case", sql="""
    WITH tagged AS (
      SELECT CASE WHEN c_acctbal < 0 THEN 'overdrawn' WHEN c_acctbal < 5000 THEN 'standard'
                  ELSE 'wealthy' END AS cohort,
             CASE c_mktsegment WHEN 'BUILDING' THEN 'works' WHEN 'MACHINERY' THEN 'works'
                  ELSE 'home' END AS line,
             ('0x' || substr(md5(c_custkey::VARCHAR), 1, 8))::BIGINT % 100 AS dice,
             if(c_nationkey % 2 = 0, 1, 0) AS even_nation
      FROM customer)
    SELECT cohort, line, count(*) AS n, sum(even_nation)::BIGINT AS n_even
    FROM tagged
    WHERE dice < CASE cohort WHEN 'overdrawn' THEN 80 WHEN 'standard' THEN 50 ELSE 8 END
    GROUP BY 1, 2""")
def cohort_case(t: Tables):
    """Per-cohort thresholds on a pseudo-random draw, as the seed data uses them."""
    tagged = t.customer.select(
        F.when(F.col("c_acctbal") < 0, "overdrawn").when(F.col("c_acctbal") < 5000, "standard")
        .otherwise("wealthy").alias("cohort"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "works").otherwise("home")
        .alias("line"),
        md5_bucket(100, F.col("c_custkey").cast("string")).alias("dice"),
        F.expr("if(c_nationkey % 2 = 0, 1, 0)").alias("even_nation"))
    limit = F.when(F.col("cohort") == "overdrawn", 80).when(F.col("cohort") == "standard", 50).otherwise(8)
    return tagged.filter(F.col("dice") < limit).groupBy("cohort", "line").agg(
        F.count(F.lit(1)).alias("n"), F.sum("even_nation").alias("n_even"))


@query("mod_sample", sql="""
    SELECT p_partkey, p_name, p_brand, p_size FROM part
    WHERE p_partkey % 3 = 0 ORDER BY p_partkey LIMIT 12""")
def mod_sample(t: Tables):
    """Every third part, first twelve: the sampling operator itself."""
    return (t.part.filter(F.pmod("p_partkey", F.lit(3)) == 0)
            .select("p_partkey", "p_name", "p_brand", "p_size").orderBy("p_partkey").limit(12))


@query("join_inner", sql="""
    SELECT r_name, n_name, count(*) AS n_suppliers, round(sum(s_acctbal), 2) AS balance
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1, 2""")
def join_inner(t: Tables):
    per_nation = t.supplier.groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n_suppliers"), F.round(F.sum("s_acctbal"), 2).alias("balance"))
    return (
        per_nation.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("r_name", "n_name", "n_suppliers", "balance")
    )


@query("bom_chain_join", sql="""
    SELECT c_mktsegment, p_type, n_name AS supplier_nation, count(*) AS n_lines,
           count(*) FILTER (l_returnflag = 'R') AS n_returns,
           round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
      JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
      JOIN nation ON n_nationkey = s_nationkey
    GROUP BY 1, 2, 3""")
def bom_chain_join(t: Tables):
    return (
        t.orders.select("o_orderkey", "o_custkey")
        .join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part.select("p_partkey", "p_type"), F.col("p_partkey") == F.col("l_partkey"))
        .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("s_suppkey") == F.col("l_suppkey"))
        .groupBy("c_mktsegment", "p_type", "s_nationkey")
        .agg(F.count(F.lit(1)).alias("n_lines"),
             F.count_if(F.col("l_returnflag") == "R").alias("n_returns"),
             F.round(F.sum(revenue()), 4).alias("revenue"))
        .join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
        .select("c_mktsegment", "p_type", F.col("n_name").alias("supplier_nation"),
                "n_lines", "n_returns", "revenue")
    )


@query("join_left", sql="""
    WITH late AS (
      SELECT l_partkey, count(*) AS n_late, sum(l_quantity) AS qty FROM lineitem
      WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '2001-06-01' GROUP BY 1)
    SELECT p_partkey, p_brand, coalesce(n_late, 0)::BIGINT AS n_late, coalesce(qty, 0.0) AS qty
    FROM part LEFT JOIN late ON p_partkey = l_partkey""")
def join_left(t: Tables):
    late = (
        t.lineitem.filter((F.col("l_returnflag") == "R")
                          & (F.col("l_shipdate") >= F.lit("2001-06-01").cast("timestamp_ntz")))
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.count(F.lit(1)).alias("n_late"), F.sum("l_quantity").alias("qty"))
    )
    return t.part.select("p_partkey", "p_brand").join(late, "p_partkey", "left").select(
        "p_partkey", "p_brand", F.coalesce("n_late", F.lit(0)).alias("n_late"),
        F.coalesce("qty", F.lit(0.0)).alias("qty"))


@query("join_anti", sql="""
    SELECT c_custkey, c_mktsegment FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey
      WHERE o_custkey = c_custkey AND l_returnflag = 'R'
        AND o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-07-01')""")
def join_anti(t: Tables):
    """Customers with nothing returned from their orders of the first half of 1998."""
    return t.customer.select("c_custkey", "c_mktsegment").join(
        _returning_customers(t), "c_custkey", "left_anti")


@query("join_semi", sql="""
    SELECT c_custkey, c_mktsegment FROM customer
    WHERE EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey
      WHERE o_custkey = c_custkey AND l_returnflag = 'R'
        AND o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-07-01')""")
def join_semi(t: Tables):
    return t.customer.select("c_custkey", "c_mktsegment").join(
        _returning_customers(t), "c_custkey", "left_semi")


def _returning_customers(t: Tables):
    day = F.col("o_orderdate")
    orders = t.orders.filter((day >= F.lit("1998-01-01").cast("timestamp_ntz"))
                             & (day < F.lit("1998-07-01").cast("timestamp_ntz")))
    returned = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return (orders.join(returned, "o_orderkey", "left_semi")
            .select(F.col("o_custkey").alias("c_custkey")))


@query("earn_redeem_cycle", sql="""
    SELECT e.user_id AS user_id, count(*) AS cycles, round(sum(p.value), 2) AS value_cycled,
           round(sum(e.value), 2) AS value_reversed
    FROM events p JOIN events e ON e.user_id = p.user_id AND e.props = p.props
      AND e.event_type = 'error' AND p.event_type = 'purchase' AND p.ts < e.ts
    GROUP BY 1 HAVING count(*) >= 2""")
def earn_redeem_cycle(t: Tables):
    """Purchases later reversed by an error on the same item, per user.

    Counting with running totals gives the join's sums without making its pairs.
    """
    both = t.events.filter(F.col("event_type").isin("purchase", "error"))
    is_purchase = F.col("event_type") == "purchase"
    linked = running_before(
        both, ["user_id", "props"], "ts", F.date_trunc("hour", "ts"),
        {"n_before": is_purchase.cast("bigint"),
         "value_before": F.when(is_purchase, F.col("value")).otherwise(0.0)})
    return (
        linked.filter((F.col("event_type") == "error") & (F.col("n_before") > 0))
        .groupBy("user_id")
        .agg(F.sum("n_before").alias("cycles"),
             F.round(F.sum("value_before"), 2).alias("value_cycled"),
             F.round(F.sum(F.col("n_before") * F.col("value")), 2).alias("value_reversed"))
        .filter("cycles >= 2")
    )


@query("config_crossjoin", sql="""
    WITH cfg AS (SELECT ['low', 'mid', 'high'] AS bands, avg(o_totalprice) AS mean_price FROM orders)
    SELECT bands[1 + (o_totalprice > mean_price)::INT + (o_totalprice > 1.5 * mean_price)::INT] AS band,
           count(*) AS n_orders
    FROM orders, cfg GROUP BY 1""")
def config_crossjoin(t: Tables):
    """A one-row configuration is read as a scalar, so no join is planned."""
    mean_price = t.orders.agg(F.avg("o_totalprice").alias("m")).scalar()
    bands = F.array(F.lit("low"), F.lit("mid"), F.lit("high"))
    priced = t.orders.select("o_totalprice", mean_price.alias("mean_price"))
    position = ((F.col("o_totalprice") > F.col("mean_price")).cast("int")
                + (F.col("o_totalprice") > 1.5 * F.col("mean_price")).cast("int"))
    return priced.groupBy(bands[position].alias("band")).agg(F.count(F.lit(1)).alias("n_orders"))


@query("agg_basic", sql="""
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, count(*) AS n_lines,
           round(avg(l_discount), 6) AS avg_discount, min(l_shipdate)::DATE::VARCHAR AS first_ship,
           round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
    FROM lineitem GROUP BY 1, 2""")
def agg_basic(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.count(F.lit(1)).alias("n_lines"),
        F.round(F.avg("l_discount"), 6).alias("avg_discount"),
        F.min("l_shipdate").cast("date").cast("string").alias("first_ship"),
        F.round(F.sum(revenue()), 4).alias("revenue"))


@query("agg_countif", sql="""
    SELECT user_id, count(*) AS n_events, count(*) FILTER (event_type = 'error') AS n_errors,
           count(*) FILTER (event_type = 'purchase' AND value > 50) AS n_large_purchases
    FROM events GROUP BY 1""")
def agg_countif(t: Tables):
    return t.events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("event_type") == "error").alias("n_errors"),
        F.count_if((F.col("event_type") == "purchase") & (F.col("value") > 50))
        .alias("n_large_purchases"))


@query("agg_having", sql="""
    SELECT l_partkey, count(*) AS n_lines, count(*) FILTER (l_returnflag = 'R') AS n_returns
    FROM lineitem GROUP BY 1
    HAVING count(*) >= 20 AND count(*) FILTER (l_returnflag = 'R') >= 0.4 * count(*)""")
def agg_having(t: Tables):
    return t.lineitem.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returns"),
    ).filter("n_lines >= 20 AND n_returns >= 0.4 * n_lines")


@query("agg_arrays", sql="""
    WITH per AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2)
    SELECT c_nationkey, '[' || (SELECT string_agg(v::VARCHAR, ',' ORDER BY v) FROM (
             SELECT DISTINCT x.n AS v FROM per x WHERE x.c_nationkey = per.c_nationkey)) || ']' AS counts,
           string_agg(c_mktsegment || ':' || n, '|' ORDER BY c_mktsegment) AS segment_counts,
           min(c_mktsegment) AS any_segment
    FROM per GROUP BY 1""")
def agg_arrays(t: Tables):
    """Sorted arrays of distinct values and arrays of structs, over groups of a dimension's size."""
    per = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array_sort(F.collect_list(F.struct("c_mktsegment", "n")))
    packed = per.groupBy("c_nationkey").agg(
        F.array_sort(F.collect_set("n")).alias("ns"), pairs.alias("pairs"),
        F.min("c_mktsegment").alias("any_segment"))
    return packed.select(
        "c_nationkey", number_list_text(F.col("ns")).alias("counts"),
        F.array_join(F.transform("pairs", lambda p: F.concat_ws(":", p["c_mktsegment"], p["n"].cast("string"))),
                     "|").alias("segment_counts"),
        "any_segment")


@query("top3_per_group", sql="""
    WITH ranked AS (
      SELECT s_nationkey, s_name, row_number() OVER (
        PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS k FROM supplier)
    SELECT s_nationkey, string_agg(s_name, '|' ORDER BY k) AS richest
    FROM ranked WHERE k <= 3 GROUP BY 1""")
def top3_per_group(t: Tables):
    top = top_n_list(t.supplier, ["s_nationkey"], "s_name",
                     [F.desc("s_acctbal"), F.asc("s_suppkey")], 3, "names")
    return top.select("s_nationkey", F.array_join("names", "|").alias("richest"))


@query("sample_concat", sql="""
    WITH names AS (SELECT DISTINCT p_brand, p_name FROM part),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_name) AS k FROM names)
    SELECT p_brand, string_agg(p_name, ' | ' ORDER BY p_name) AS sample_names
    FROM ranked WHERE k <= 5 GROUP BY 1""")
def sample_concat(t: Tables):
    """First five distinct values per group, joined; later ones never leave the map side."""
    names = top_n_list(t.part.select("p_brand", "p_name").distinct(), ["p_brand"], "p_name",
                       [F.asc("p_name")], 5, "names")
    return names.select("p_brand", F.array_join("names", " | ").alias("sample_names"))


@query("distinct_pairs", sql="""
    SELECT DISTINCT o_custkey, l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def distinct_pairs(t: Tables):
    return (
        t.orders.select("o_orderkey", "o_custkey")
        .join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey"), "o_orderkey")
        .select("o_custkey", "l_suppkey").distinct()
    )


@query("first_per_key", sql="""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k
               FROM orders)
    SELECT o_custkey, o_orderkey, round(o_totalprice, 2) AS o_totalprice,
           o_orderdate::DATE::VARCHAR AS order_day FROM r WHERE k = 1""")
def first_per_key_query(t: Tables):
    first = first_per_key(t.orders, ["o_custkey"], F.struct("o_orderdate", "o_orderkey"),
                          ["o_orderkey", "o_totalprice", "o_orderdate"])
    return first.select("o_custkey", "o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"),
                        F.col("o_orderdate").cast("date").cast("string").alias("order_day"))


@query("topk_basic", sql="""
    SELECT l_suppkey, l_returnflag, count(*) AS n_lines, round(sum(l_quantity), 2) AS quantity
    FROM lineitem GROUP BY 1, 2 ORDER BY n_lines DESC, l_suppkey, l_returnflag LIMIT 50""")
def topk_basic(t: Tables):
    return (
        t.lineitem.groupBy("l_suppkey", "l_returnflag")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
        .orderBy(F.desc("n_lines"), "l_suppkey", "l_returnflag").limit(50)
    )


@query("priority_batch", sql="""
    SELECT o_orderkey, o_custkey, o_orderpriority, round(o_totalprice, 2) AS o_totalprice FROM orders
    ORDER BY (o_orderpriority = '1-URGENT') DESC, (o_totalprice >= 400000) DESC, o_orderkey DESC LIMIT 20""")
def priority_batch_query(t: Tables):
    return priority_batch(
        t.orders, [(F.col("o_orderpriority") == "1-URGENT").desc(),
                   (F.col("o_totalprice") >= 400000).desc(), F.desc("o_orderkey")], 20,
    ).select("o_orderkey", "o_custkey", "o_orderpriority", F.round("o_totalprice", 2).alias("o_totalprice"))


@query("entity_union", sql="""
    SELECT entity_type, count(*) AS n, min(entity_id) AS first_id FROM (
      SELECT 'part' AS entity_type, l_partkey::VARCHAR AS entity_id FROM lineitem
      UNION ALL SELECT 'supplier', l_suppkey::VARCHAR FROM lineitem
      UNION ALL SELECT 'segment', c_mktsegment FROM customer) GROUP BY 1""")
def entity_union(t: Tables):
    lines = t.lineitem
    both = (
        lines.select(F.lit("part").alias("entity_type"), F.col("l_partkey").cast("string").alias("entity_id"))
        .union(lines.select(F.lit("supplier"), F.col("l_suppkey").cast("string")))
        .union(t.customer.select(F.lit("segment"), "c_mktsegment"))
    )
    return both.groupBy("entity_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("entity_id").alias("first_id"))


@query("union_distinct", sql="""
    SELECT nation_key, role FROM (
      SELECT c_nationkey AS nation_key, 'buyer' AS role FROM customer
      UNION SELECT s_nationkey, 'seller' FROM supplier)""")
def union_distinct(t: Tables):
    buyers = t.customer.select(F.col("c_nationkey").alias("nation_key"), F.lit("buyer").alias("role"))
    sellers = t.supplier.select("s_nationkey", F.lit("seller"))
    return buyers.union(sellers).distinct()


@query("scalar_functions", sql="""
    SELECT o_orderkey, abs(-(o_orderkey % 7))::BIGINT AS abs_mod, round(o_totalprice / 7, 3) AS rounded,
           o_totalprice / nullif((o_orderkey % 5)::DOUBLE, 0) AS safe_ratio,
           md5(o_orderkey::VARCHAR) AS hex_digest, 'order_' || o_orderkey || '@example.com' AS label,
           lpad(o_orderkey::VARCHAR, 8, '0') AS padded, lower(substr(o_orderpriority, 3, 4)) AS short_priority,
           left(o_orderpriority, 3) AS prefix,
           printf('key=%d status=%s price=%.1f', o_orderkey, o_orderstatus, floor(o_totalprice)) AS line,
           array_to_string([o_orderstatus, o_orderpriority], ' | ') AS joined,
           (o_orderdate::DATE + 14)::VARCHAR AS due_day,
           (o_orderdate::DATE - dayofweek(o_orderdate::DATE)::INT)::VARCHAR AS week_start,
           strftime(o_orderdate, '%A') AS day_name, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts_text,
           if(o_orderkey % 2 = 0, 'even', 'odd') AS parity,
           coalesce(nullif(o_orderstatus, 'F'), 'finished') AS status_text,
           round(o_totalprice)::BIGINT AS whole_price,
           len([x for x in generate_series(1, 1 + o_orderkey % 4)])::INT AS n_steps,
           '[' || array_to_string(generate_series(1, 1 + o_orderkey % 4), ',') || ']' AS steps_json
    FROM orders""")
def scalar_functions(t: Tables):
    """Every scalar function the reference uses that both engines define alike."""
    key, price, day = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderdate").cast("date")
    steps = F.sequence(F.lit(1).cast("bigint"), 1 + key % 4)
    return t.orders.select(
        "o_orderkey", F.abs(-(key % 7)).alias("abs_mod"), F.round(price / 7, 3).alias("rounded"),
        ratio(price, key % 5).alias("safe_ratio"), F.md5(key.cast("string")).alias("hex_digest"),
        F.concat(F.lit("order_"), key, F.lit("@example.com")).alias("label"),
        F.lpad(key.cast("string"), 8, "0").alias("padded"),
        F.lower(F.substring("o_orderpriority", 3, 4)).alias("short_priority"),
        F.left("o_orderpriority", F.lit(3)).alias("prefix"),
        F.format_string("key=%d status=%s price=%.1f", key, F.col("o_orderstatus"),
                        F.floor(price).cast("double")).alias("line"),
        F.array_join(F.array("o_orderstatus", "o_orderpriority"), " | ").alias("joined"),
        F.date_add(day, 14).cast("string").alias("due_day"),
        sunday_week(day).cast("string").alias("week_start"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
        F.expr("if(o_orderkey % 2 = 0, 'even', 'odd')").alias("parity"),
        F.coalesce(F.nullif("o_orderstatus", F.lit("F")), F.lit("finished")).alias("status_text"),
        F.round(price).cast("bigint").alias("whole_price"), F.size(steps).alias("n_steps"),
        F.to_json(steps).alias("steps_json"))


@query("ranked_rows", sql="""
    SELECT s_nationkey, s_suppkey, k FROM (
      SELECT s_nationkey, s_suppkey, row_number() OVER (
        PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS k FROM supplier) WHERE k <= 2""")
def ranked_rows(t: Tables):
    return top_n_per_key(t.supplier, ["s_nationkey"], [F.desc("s_acctbal"), F.asc("s_suppkey")], 2, "k"
                         ).select("s_nationkey", "s_suppkey", "k")
