"""Published results of the return-fraud data set."""

import pytest
from pyspark.sql import functions as F

import retail_fixture
from tracewell.functions.columns import ratio
from farmhash import fingerprints
from tracewell.operators import augmented as aa
from tracewell.operators import timeseries as ts
from tracewell.operators.graph import EdgeTable, NodeTable, PropertyGraph, detect_rings, top_shared_pairs
from tracewell.sources.tables import TableStore


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    store = TableStore(spark, str(tmp_path_factory.mktemp("retail")))
    built = retail_fixture.build(spark)
    return {name: store.replace(name, df) for name, df in built.items()}


@pytest.fixture(scope="module")
def stats(tables):
    joined = tables["orders"].select("order_id", "customer_id").join(
        tables["returns"].select("order_id", "return_id", "refund_amount"), "order_id", "left")
    return joined.groupBy(F.col("customer_id").alias("member")).agg(
        F.count_distinct("order_id").alias("n_orders"), F.count_distinct("return_id").alias("n_returns"),
        F.round(F.sum(F.coalesce("refund_amount", F.lit(0.0))), 2).alias("total_refunds"),
    ).withColumn("return_rate", ratio(F.col("n_returns"), F.col("n_orders")))


@pytest.fixture(scope="module")
def graph(tables):
    def nodes(label, table, key):
        return NodeTable(label, tables[table].select(key).distinct(), key)

    return PropertyGraph(
        [NodeTable("Customer", tables["customers"], "customer_id"), nodes("Device", "devices", "device_id"),
         nodes("Address", "addresses", "address_id"), nodes("PaymentMethod", "payments", "payment_method_id")],
        [EdgeTable("USES_DEVICE", tables["devices"], "Customer", "customer_id", "Device", "device_id"),
         EdgeTable("SHIPS_TO", tables["addresses"], "Customer", "customer_id", "Address", "address_id"),
         EdgeTable("PAYS_WITH", tables["payments"], "Customer", "customer_id", "PaymentMethod", "payment_method_id")])


ALL = ["USES_DEVICE", "SHIPS_TO", "PAYS_WITH"]


def test_published_fingerprints():
    assert list(fingerprints([b"1footrue", b"2applefalse", b"3true"])) == [
        -1541654101129638711, 2794438866806483259, -4880158226897771312]
    for n in (17, 32, 33, 64, 65, 128, 200):  # batch and single agree at every length class
        texts = [bytes((i * 7 + j) % 251 for j in range(n)) for i in range(5)]
        assert list(fingerprints(texts)) == [fingerprints([t])[0] for t in texts]


def test_row_counts(tables):
    counts = {n: tables[n].count() for n in ("customers", "orders", "returns", "devices", "addresses", "payments")}
    assert counts == {"customers": 5015, "orders": 50248, "returns": 4407, "devices": 5156,
                      "addresses": 5136, "payments": 5015}


def test_rings(graph, stats):
    assert stats.filter("return_rate >= 0.4 AND n_returns >= 3").count() == 75
    found = detect_rings(graph, ALL, stats, min_rate=0.4, min_returns=3)
    rows = found.summary.orderBy("ring_id").collect()
    members = {}
    for r in found.members.orderBy("member").collect():
        members.setdefault(r.ring_id, []).append(r.member)
    assert found.entities.count() == 5
    assert [(r.ring_id, members[r.ring_id], r.n_entities, r.total_returns) for r in rows] == [
        ("RING-1", [9001, 9002, 9003, 9004, 9005, 9006], 3, 102),
        ("RING-2", [9101, 9102, 9103, 9104], 1, 33),
        ("RING-3", [9201, 9202, 9203, 9204, 9205], 1, 42)]
    assert [round(r.avg_return_rate, 2) for r in rows] == [0.68, 0.69, 0.84]
    assert [round(r.refund_exposure, 2) for r in rows] == [20735.11, 6690.79, 30221.29]


def test_shared_pairs(graph, tables):
    devices = graph.links(["USES_DEVICE"])
    a = devices.select("entity_id", F.col("member").alias("a"))
    b = devices.select("entity_id", F.col("member").alias("b"))
    assert a.join(b, "entity_id").filter("a < b").count() == 165
    top = top_shared_pairs(graph.links(ALL), 1000)
    assert top.count() == 284
    assert top.agg(F.max("shared_entities")).first()[0] == 3


def test_points_cycling(tables):
    earn = tables["loyalty"].filter("txn_type = 'EARN'").select("order_id", "points")
    redeem = tables["loyalty"].filter("txn_type = 'REDEEM'").select("order_id", F.col("txn_date").alias("redeemed"))
    rows = (
        tables["returns"].join(earn, "order_id").join(redeem, "order_id").filter("redeemed < return_date")
        .groupBy("customer_id").agg(F.count("*").alias("n"), F.round(F.sum("refund_amount"), 2).alias("refunds"))
        .filter("n >= 3").orderBy("customer_id").collect())
    assert [tuple(r) for r in rows] == [
        (9101, 7, 1591.53), (9102, 9, 1521.58), (9103, 9, 1887.67), (9104, 8, 1690.01)]


def test_weekly_refunds_and_anomaly(tables):
    weekly = ts.bucket_series(tables["returns"], F.col("return_date"), "week",
                              {"refund": F.round(F.sum("refund_amount"), 2)})
    november = weekly.filter("ts BETWEEN date '2025-11-02' AND date '2025-11-30'").orderBy("ts").collect()
    assert [r.refund for r in november] == [8985.74, 13093.43, 17205.16, 14416.35, 12717.35]
    flagged = ts.detect_anomalies(
        weekly, "refund", "ts", F.expr("ts < date '2025-09-01'"),
        F.expr("ts BETWEEN date '2025-09-01' AND date '2026-01-31'"), 0.80, step_days=7).filter("is_anomaly")
    assert "2025-11-16" in {str(r.time_series_timestamp) for r in flagged.collect()}
    ahead = ts.forecast_multi(weekly.withColumn("n", F.lit(1.0)), ["refund", "n"], "ts", 4, step_days=7)
    assert ahead.count() == 4
    scores = ts.evaluate(weekly, "refund", "ts", F.expr("ts < date '2025-06-01'"),
                         F.expr("ts BETWEEN date '2025-06-01' AND date '2025-08-31'"), step_days=7).first()
    assert scores.ai_evaluate_status == "" and 0 < scores.mean_absolute_percentage_error < 40


def test_correlations(stats):
    rows = {r.corr_col: r for r in aa.correlation(stats, "n_returns", ["n_orders", "total_refunds"]).collect()}
    assert round(rows["n_orders"].correlation, 4) == 0.2893
    assert round(rows["total_refunds"].correlation, 4) == 0.8518
    assert rows["n_orders"].segment_size == stats.count()


def test_refunds_around_the_break(tables):
    late = F.col("return_date") >= "2025-11-15"
    row = tables["returns"].agg(
        F.round(F.sum(F.when(~late, F.col("refund_amount"))), 2), F.round(F.sum(F.when(late, F.col("refund_amount"))), 2),
        F.count_distinct(F.when(~late, F.col("return_date"))), F.count_distinct(F.when(late, F.col("return_date")))).first()
    assert tuple(row) == (496521.79, 454073.33, 310, 238)


def test_causal_effect_of_the_break(tables):
    daily = ts.bucket_series(tables["returns"], F.col("return_date"), "day", {"refund": F.sum("refund_amount")})
    row = aa.causal_effect(ts.regularize(daily, "ts", ["refund"]), "refund", "ts",
                           F.lit("2025-11-15").cast("date")).first()
    assert row.absolute_effect > 0 or row.absolute_effect < 0
    assert abs(row.prob_causal_effect + row.p_value - 1) < 1e-9
