"""Operators against brute force, with one hot key holding about a third of the rows."""

import datetime
import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tracewell.functions import sql
from tracewell.functions.columns import md5_bucket
from tracewell.functions.rubric import Field, Rubric, Term, extract
from tracewell.operators import augmented as aa
from tracewell.operators import distill
from tracewell.operators import text as tx
from tracewell.operators import timeseries as ts
from tracewell.operators.graph import (
    EdgeTable, NodeTable, PropertyGraph, connected_components, detect_rings, explode_parts, first_shared_pairs,
    k_hop_reach, top_shared_pairs,
)
from tracewell.operators.relational import (
    first_per_key, global_row_number, running_before, top_n_list, top_n_per_key,
)
from tracewell.sources.tables import TableStore


def hot(rng, n):
    """0 for a third of the draws, otherwise 1..n."""
    return 0 if rng.random() < 1 / 3 else rng.randint(1, n)


@pytest.fixture(scope="module")
def links(spark):
    rng = random.Random(5)
    rows = {("kind", f"e{hot(rng, 40)}", rng.randint(1, 60)) for _ in range(400)}
    return spark.createDataFrame(sorted(rows), "entity_type string, entity_id string, member long"), rows


def all_pairs(rows):
    groups = {}
    for kind, entity, member in rows:
        groups.setdefault((kind, entity), set()).add(member)
    for entity, members in groups.items():
        yield from ((entity, a, b) for a, b in itertools.combinations(sorted(members), 2))


def test_top_shared_pairs(links):
    df, rows = links
    counts = {}
    for _, a, b in all_pairs(rows):
        counts[a, b] = counts.get((a, b), 0) + 1
    expected = sorted((-n, a, b) for (a, b), n in counts.items())[:30]
    found = [(-r.shared_entities, r.a, r.b) for r in top_shared_pairs(df, 30).collect()]
    assert found == expected


def test_top_shared_pairs_with_one_hot_entity(spark):
    rows = [("k", "hot", m) for m in range(1, 400)] + [("k", f"s{i}", m) for i in range(4) for m in (300 + i, 301 + i)]
    df = spark.createDataFrame(rows, "entity_type string, entity_id string, member long")
    found = [tuple(r) for r in top_shared_pairs(df, 10).collect()]
    assert found == [(300 + i, 301 + i, 2) for i in range(4)] + [(1, b, 1) for b in range(2, 8)]


def test_first_shared_pairs(links):
    df, rows = links
    expected = sorted((e[1], a, b) for e, a, b in all_pairs(rows))[:70]
    assert [tuple(r) for r in first_shared_pairs(df, "entity_id", "member", 70).collect()] == expected


def components_of(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in parent}


def test_components_chain_and_hub(spark):
    chain = [(f"c{i}", m) for i in range(1, 60) for m in (i, i + 1)]
    hub = [("hub", m) for m in range(1000, 1200)]
    df = spark.createDataFrame([("k", e, m) for e, m in chain + hub + [("alone", 7000)]],
                               "entity_type string, entity_id string, member long")
    found = {r.member: r.component for r in connected_components(df).collect()}
    expected = {m: 1 for m in range(1, 61)} | {m: 1000 for m in range(1000, 1200)} | {7000: 7000}
    assert found == expected


def test_k_hop_reach(spark):
    rows = [("k", f"c{i}", m) for i in range(1, 10) for m in (i, i + 1)]
    df = spark.createDataFrame(rows, "entity_type string, entity_id string, member long")
    seeds = spark.createDataFrame([(1,)], "member long")
    assert {(r.member, r.hop) for r in k_hop_reach(df, seeds, 3).collect()} == {(1, 0), (2, 1), (3, 2), (4, 3)}


def test_large_ring_is_one_row_and_graph_drops_dangling_edges(spark):
    people = spark.range(1, 12_001).withColumnRenamed("id", "p")
    uses = people.select("p", F.lit("x").alias("e")).union(people.filter("p <= 4").select("p", F.lit("y"))).union(
        people.filter("p <= 4").select("p", F.lit("z"))).union(spark.createDataFrame([(99, "x"), (1, "gone")], "p long, e string"))
    graph = PropertyGraph(
        [NodeTable("Person", people, "p"), NodeTable("Thing", spark.createDataFrame([("x",), ("y",), ("z",)], "e string"), "e")],
        [EdgeTable("USES", uses, "Person", "p", "Thing", "e")])
    stats = people.select(F.col("p").alias("member"), F.lit(3).alias("n_returns"), F.lit(0.5).alias("return_rate"),
                          F.lit(1.0).alias("total_refunds"))
    rings = detect_rings(graph, ["USES"], stats, min_rate=0.4, min_returns=3)
    assert {r.ring_id: (r.n_members, r.n_entities) for r in rings.summary.collect()} == {
        "RING-1": (12_000, 1), "RING-2": (4, 2)}
    assert rings.members.filter("ring_id = 'RING-1'").count() == 12_000
    assert sorted(r.member for r in rings.members.filter("ring_id = 'RING-2'").collect()) == [1, 2, 3, 4]
    assert sorted(r.entity_id for r in rings.entities.filter("ring_id = 'RING-2'").collect()) == ["y", "z"]
    with pytest.raises(ValueError):
        PropertyGraph([NodeTable("Person", people, "nope")], [])


def test_running_before_equals_self_join(spark):
    rng = random.Random(3)
    start = datetime.datetime(2024, 1, 1)
    rows = [(i, hot(rng, 9), start + datetime.timedelta(minutes=rng.randint(0, 600)), float(rng.randint(0, 9)))
            for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp, v double")
    out = running_before(df, ["k"], "ts", F.date_trunc("hour", "ts"), {"n": F.lit(1), "s": F.col("v")}).collect()
    found = {r.id: (r.n, r.s) for r in out}
    for i, k, t, _ in rows:
        earlier = [v for _, k2, t2, v in rows if k2 == k and t2 < t]
        assert found[i] == (len(earlier), sum(earlier))


def test_global_row_number_and_first_per_key(spark):
    rng = random.Random(1)
    values = rng.sample(range(10_000), 500)
    df = spark.createDataFrame([(v, v % 7) for v in values], "v long, k long").repartition(6)
    numbered = {r.v: r.n for r in global_row_number(df, ["v"], "n").collect()}
    assert numbered == {v: i + 1 for i, v in enumerate(sorted(values))}
    first = {r.k: r.v for r in first_per_key(df, ["k"], F.col("v"), ["v"]).collect()}
    assert first == {k: min(v for v in values if v % 7 == k) for k in {v % 7 for v in values}}
    top = {r.k: r.top for r in top_n_list(df, ["k"], "v", [F.desc("v")], 3, "top").collect()}
    assert top == {k: sorted((v for v in values if v % 7 == k), reverse=True)[:3] for k in first}


def test_spearman_with_a_hot_tie(spark):
    rng = random.Random(2)
    rows = [(hot(rng, 50), rng.random(), i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "a long, b double, g int")
    pdf = pd.DataFrame(rows, columns=["a", "b", "g"])
    row = aa.correlation(df, "a", ["b"], method="spearman").first()
    assert math.isclose(row.correlation, pdf.a.rank().corr(pdf.b.rank()), abs_tol=1e-9)
    assert row.segment_size == 400
    for r in aa.correlation(df, "a", ["b"], ["g"], "spearman").collect():
        part = pdf[pdf.g == r.g]
        assert math.isclose(r.correlation, part.a.rank().corr(part.b.rank()), abs_tol=1e-9)


def words_of(text):
    return text.lower().split()


def test_near_duplicates_with_a_third_of_copies(spark):
    rng = random.Random(11)
    vocabulary = [a + b for a in "bcdfgh" for b in ("ala", "eno", "iru", "oka", "umi", "ysa")]
    base = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(40)]
    texts = list(base)
    for i in range(25):  # near copies of one text
        w = words_of(base[0])
        w[rng.randrange(60)] = "changed" + "abcdefghijklmnopqrstuvwxyz"[i]
        texts.append(" ".join(w))
    texts += [base[1]] * 15 + ["short text", "short text", "tiny"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")

    def shingle_set(text):
        w = words_of(text)
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}

    sets = [shingle_set(t) for t in texts]
    edges = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2)
             if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.7]
    found = {r.id: r.original for r in tx.near_duplicate_groups(df, "id", "text", 0.7).collect()}
    assert found == components_of(edges)
    linked = tx.near_duplicate_links(df, "id", "text", 0.7).count()
    assert linked < len(edges) / 3  # copies are not compared with each other


def test_semantic_join_equals_all_pairs(spark):
    rng = random.Random(4)
    common, rare = ["this", "with", "that"], [f"word{c}{d}" for c in "abcdefgh" for d in "qrstuv"]
    def text():
        return " ".join([rng.choice(common)] * 3 + rng.choices(rare, k=6))
    left, right = [text() for _ in range(20)], [text() for _ in range(120)]
    right += left[:5] + ["this with that"] * 40
    l_df = spark.createDataFrame(list(enumerate(left)), "l_id long, t string")
    r_df = spark.createDataFrame(list(enumerate(right)), "r_id long, t string")
    frequency = {}
    for t in right:
        for w in set(words_of(t)):
            frequency[w] = frequency.get(w, 0) + 1
    weight = lambda w: math.log((len(right) + 1) / (frequency.get(w, 0) + 1))
    expected = {}
    for i, a in enumerate(left):
        total = sum(weight(w) for w in set(words_of(a)))
        for j, b in enumerate(right):
            score = sum(weight(w) for w in set(words_of(a)) & set(words_of(b))) / total
            if score >= 0.5:
                expected[i, j] = round(score, 6)
    found = tx.semantic_join(l_df, "l_id", "t", r_df, "r_id", "t", 0.5).collect()
    assert {(r.l_id, r.r_id): round(r.score, 6) for r in found} == expected


RUBRIC = Rubric((Term("fire|smoke", 2.0, "hazard"), Term("leak", 1.0, "water"), Term("drip", 1.0, "water")))


def test_rubric(spark):
    df = spark.createDataFrame([("Fire and smoke and FIRE",), ("a leak",), ("nothing",), (None,)], "t string")
    t = F.col("t")
    rows = df.select(RUBRIC.score(t).alias("s"), RUBRIC.classify(t, ["hazard", "water", "none"]).alias("c"),
                     RUBRIC.judge(t, "int").alias("j")).collect()
    assert [r.s for r in rows] == [5.0, 1.0, 0.0, None]
    assert [r.c for r in rows] == ["hazard", "water", "none", None]
    assert [(r.j.result, r.j.status) for r in rows] == [(5, ""), (1, ""), (0, ""), (None, "no text to score")]


def test_sql_functions(spark):
    sql.register(spark, {"hazard_score": RUBRIC}, {"hazard_class": (RUBRIC, ["hazard", "water", "none"])})
    texts = ["Fire and smoke and FIRE", "a leak", "nothing", None]
    df = sql.table(spark, "reports", spark.createDataFrame([(t,) for t in texts], "t string"))
    by_sql = spark.sql("""
        SELECT t, hazard_score(t) AS s, hazard_class(t) AS c, text_similarity(t, 'fire leak') AS m,
               stable_bucket(t, 10) AS b FROM reports""").collect()
    t = F.col("t")
    native = df.select(t, RUBRIC.score(t).alias("s"), RUBRIC.classify(t, ["hazard", "water", "none"]).alias("c"),
                       tx.set_cosine(t, F.lit("fire leak")).alias("m"), md5_bucket(10, t).alias("b")).collect()
    assert sorted(map(str, by_sql)) == sorted(map(str, native))
    urgent = spark.sql(
        "SELECT t, hazard_score(t) AS s FROM reports WHERE hazard_score(t) >= 1 ORDER BY s DESC").collect()
    assert [r.t for r in urgent] == texts[:2]
    row = spark.sql("SELECT sunday_week(date '2025-11-19') AS w, safe_ratio(1, 0) AS r").first()
    assert str(row.w) == "2025-11-16" and row.r is None


def test_extraction_fills_every_field(spark):
    fields = [Field("mail", "string", r"([a-z]+@[a-z]+\.com)", "N/A", needs="@"), Field("n", "bigint", r"n=([0-9]+)", "-1"),
              Field("urgent", "boolean", "now", "false")]
    df = spark.createDataFrame([("mail a@b.com n=12 now",), ("none",), (None,)], "t string")
    rows = [tuple(r.x) for r in df.select(extract(F.col("t"), fields).alias("x")).collect()]
    assert rows == [("a@b.com", 12, True, ""), ("N/A", -1, False, ""), ("N/A", -1, False, "no text to score")]


def test_python_scorer_keeps_errors_in_the_row(spark):
    def lengths(texts):
        if any("bad" in t for t in texts):
            raise ValueError("cannot score this")
        return texts.str.len().astype(float)

    df = spark.createDataFrame([(1, "abc"), (2, "bad"), (3, "abcdef")], "id long, t string").coalesce(1)
    rows = {r.id: (r.result, r.status) for r in tx.score_rows(df, "t", lengths).collect()}
    assert rows == {1: (3.0, ""), 2: (None, "cannot score this"), 3: (6.0, "")}


def test_similarity_range_and_catalog(spark):
    df = spark.createDataFrame([("a b c", "b c d"), ("same text", "Same Text")], "x string, y string")
    values = [r[0] for r in df.select(tx.set_cosine(F.col("x"), F.col("y"))).collect()]
    assert values == [pytest.approx(2 / 3), pytest.approx(1.0)]
    v = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [-1.0, -1.0])], "a array<double>, b array<double>")
    assert [r[0] for r in v.select(tx.vector_cosine(F.col("a"), F.col("b"))).collect()] == pytest.approx([0.0, -1.0])
    c = spark.createDataFrame([("elec itm 7 blk ref#12",)], "t string")
    out = c.select(tx.normalize_catalog(F.col("t"), {"elec": "electronics", "itm": "item", "blk": "black"}, "^ref#")).first()[0]
    assert out == "electronics item 7 black"
    n = spark.createDataFrame([(None, "x")], "a string, b string")
    assert n.select(tx.null_safe_concat("p: ", F.col("a"), F.col("b"))).first()[0] == "p: x"


def test_distilled_classifier_serves_or_falls_back(spark):
    rng = random.Random(8)
    rows = [(i, ("good fine nice " if i % 2 else "bad poor weak ") + rng.choice(["alpha", "beta"]), float(i % 2)) for i in range(400)]
    df = spark.createDataFrame([r[:2] for r in rows], "id long, t string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:150]], "id long, label double")
    served = distill.classify(df, "id", "t", labels, features=256)
    assert {r.id: r.prediction for r in served.collect()} == {r[0]: r[2] for r in rows}
    assert {r.served_by for r in served.select("served_by").distinct().collect()} == {"labeller", "model"}
    few = distill.classify(df.limit(40), "id", "t", labels.filter("id < 20"), features=256)
    assert {r.served_by for r in few.select("served_by").distinct().collect()} == {"labeller", "model"}
    refused = distill.classify(df, "id", "t", labels, min_agreement=1.1).collect()
    assert {(r.served_by, r.prediction is None) for r in refused} == {("labeller", False), ("unlabelled", True)}


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(0)
    day = datetime.date(2024, 1, 7)
    rows = []
    for key, level, slope in (("p", 100.0, 1.0), ("q", 50.0, -0.2)):
        for i in range(120):
            jump = 80.0 if key == "p" and i >= 70 else 0.0
            rows.append((key, day + datetime.timedelta(days=i), level + slope * i + 5 * (i % 7 == 0) + jump + float(rng.normal())))
    return spark.createDataFrame(rows, "k string, ts date, y double")


def test_forecast_shape_and_line(series):
    out = ts.forecast(series.filter("k = 'q'"), "y", "ts", 10, series_cols=["k"]).orderBy("forecast_timestamp").collect()
    assert len(out) == 10
    assert all(r.prediction_interval_lower_bound < r.forecast_value < r.prediction_interval_upper_bound for r in out)
    assert abs(out[0].forecast_value - (50 - 0.2 * 120)) < 3
    assert ts.forecast(series, "y", "ts", 5, series_cols=["k"], season=7).count() == 10
    short = series.filter("ts < date '2024-01-09'")
    rows = ts.forecast(short, "y", "ts", 2, series_cols=["k"]).collect()
    assert len(rows) == 4 and all(r.prediction_interval_lower_bound is None and r.forecast_value is not None for r in rows)


def test_anomaly_flag_probability_and_bounds_agree(series):
    out = ts.detect_anomalies(series, "y", "ts", F.expr("ts < date '2024-03-01'"), F.expr("ts >= date '2024-03-01'"),
                              0.8, ["k"]).collect()
    assert any(r.is_anomaly for r in out if r.k == "p")
    for r in out:
        outside = not (r.lower_bound <= r.time_series_data <= r.upper_bound)
        assert 0 <= r.anomaly_probability <= 1
        assert r.is_anomaly == outside or abs(r.anomaly_probability - 0.8) < 1e-5


def test_covariate_forecast_has_horizon_rows(series):
    df = series.filter("k = 'q'").withColumn("c", F.col("y") * 2)
    out = ts.forecast_with_covariates(df, ["y"], ["c"], "ts", 5)
    assert out.count() == 5


def test_evaluate_reports_no_overlap(series):
    row = ts.evaluate(series.filter("k = 'q'"), "y", "ts", F.lit(True), F.lit(False)).first()
    assert row.mean_absolute_error is None and row.ai_evaluate_status != ""


def test_change_points_partition_the_series(series):
    out = aa.detect_change_points(series, "y", "ts", ["k"]).orderBy("k", "begin_timestamp").collect()
    p = [r for r in out if r.k == "p"]
    assert sum(r.metrics["count"] for r in p) == 120
    assert datetime.date(2024, 1, 7) + datetime.timedelta(days=70) in {r.begin_timestamp for r in p}
    for a, b in zip(p, p[1:]):
        assert a.end_timestamp + datetime.timedelta(days=1) == b.begin_timestamp


def test_seasonality_sums_to_zero_and_trend_extends(series):
    phases = aa.seasonality(series, "y", "ts", ["k"]).select("k", F.dayofweek("ts").alias("d"), "weekly").distinct().collect()
    for key in "pq":
        values = [r.weekly for r in phases if r.k == key]
        assert len(values) == 7 and abs(sum(values)) < 1e-9
    out = aa.trend(series, "y", "ts", 7, adjust_step_changes=True, series_cols=["k"], fit_rows=28)
    assert out.filter("time_series_type = 'forecast'").count() == 14
    assert out.filter("time_series_type = 'history'").count() == 240


def test_key_drivers_published_example(spark):
    rows = ([("heating_element", "maker1", 1.0, True)] * 17 + [("heating_element", "maker1", 1.0, False)]
            + [("thermostat", "maker2", 1.0, True)] * 3 + [("motor", "maker3", 1.0, False)] * 6
            + [("motor", None, 0.0, False)] * 3)
    df = spark.createDataFrame(rows, "component_type string, supplier string, defect double, at_station boolean")
    out = aa.key_drivers(df, "defect", ["component_type", "supplier"], "at_station", top_k=10, min_support=0.0).collect()
    top = {tuple(r.drivers): r for r in out}
    best = top["component_type=heating_element", "supplier=maker1"]
    assert (best.metric_interest, best.metric_reference, best.relative_difference) == (17.0, 1.0, 16.0)
    singles = [r for r in out if len(r.drivers) == 1 and r.drivers[0].startswith("component_type")]
    assert sum(r.metric_interest for r in singles) == 20.0
    assert ("component_type=motor", "supplier=NULL") in top


def test_causal_effect_finds_the_jump(series):
    at = F.lit("2024-03-17").cast("date")
    rows = {r.k: r for r in aa.causal_effect(series, "y", "ts", at, ["k"]).collect()}
    assert abs(rows["p"].absolute_effect - 80 * 50) < 400 and rows["p"].p_value < 0.01
    points = aa.causal_effect(series, "y", "ts", at, ["k"], output_time_series=True)
    last = points.filter("k = 'p'").orderBy(F.desc("ts")).first()
    assert math.isclose(last.cumulative_effect, rows["p"].absolute_effect, rel_tol=1e-9)


def test_all_change_points_are_found(spark):
    day = datetime.date(2020, 1, 1)
    rng = np.random.default_rng(5)
    levels = [100.0 * ((i * 7) % 16) for i in range(16)]
    rows = [("k", day + datetime.timedelta(days=20 * i + j), level + float(rng.normal()))
            for i, level in enumerate(levels) for j in range(20)]
    df = spark.createDataFrame(rows, "k string, ts date, y double")
    found = aa.detect_change_points(df, "y", "ts", ["k"]).orderBy("begin_timestamp").collect()
    assert [r.begin_timestamp for r in found] == [day + datetime.timedelta(days=20 * i) for i in range(16)]


def test_trend_of_a_short_series_has_no_weekly_bias(spark):
    day = datetime.date(2024, 1, 1)
    for n in (10, 5):
        rows = [(day + datetime.timedelta(days=i), float(i)) for i in range(n)]
        out = aa.trend(spark.createDataFrame(rows, "ts date, y double"), "y", "ts", 3, fit_rows=28).orderBy("ts").collect()
        assert all(r.trend is not None for r in out)
        assert out[n // 2].trend == pytest.approx(n // 2, abs=1.01)


def test_three_way_driver(spark):
    rows = [(a, b, c, 100.0 if (a, b, c) == ("a1", "b1", "c1") and after else 10.0, after)
            for a in ("a1", "a2") for b in ("b1", "b2") for c in ("c1", "c2") for after in (True, False)]
    df = spark.createDataFrame(rows, "a string, b string, c string, m double, after boolean")
    out = aa.key_drivers(df, "m", ["a", "b", "c"], "after", top_k=20, min_support=0.0).collect()
    assert out[0].drivers == ["a=a1", "b=b1", "c=c1"]


def test_null_keys_are_kept(spark):
    day = datetime.date(2024, 1, 1)
    series = spark.createDataFrame([(None, day, 5.0), (None, day + datetime.timedelta(days=2), 7.0)], "k string, ts date, y double")
    filled = ts.regularize(series, "ts", ["y"], ["k"]).orderBy("ts").collect()
    assert [(r.y, r.is_filled) for r in filled] == [(5.0, False), (0.0, True), (7.0, False)]
    pairs = spark.createDataFrame([(None, float(i), float(i * i)) for i in range(5)] + [("s", 1.0, 2.0), ("s", 2.0, None)],
                                  "g string, x double, y double")
    ranked = {r.g: (r.correlation, r.segment_size) for r in aa.correlation(pairs, "x", ["y"], ["g"], "spearman").collect()}
    assert ranked[None] == (pytest.approx(1.0), 5) and ranked["s"][1] == 1
    docs = spark.createDataFrame([(1, None, "some words here"), (2, None, "more words"), (3, "g", "other text")],
                                 "id long, g string, t string")
    assert {r.g: r.n_docs for r in tx.digest(docs, ["g"], "id", "t").collect()} == {None: 2, "g": 1}
    start = datetime.datetime(2024, 1, 1)
    moves = spark.createDataFrame([(None, start + datetime.timedelta(minutes=i), 1.0) for i in range(3)], "k long, t timestamp, v double")
    out = running_before(moves, ["k"], "t", F.date_trunc("hour", "t"), {"n": F.lit(1)}).collect()
    assert sorted(r.n for r in out) == [0, 1, 2]


def test_top_n_per_key_for_a_large_n(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    top = top_n_per_key(df, ["k"], [F.desc("v")], 1001)
    assert sorted(r.v for r in top.collect()) == list(range(3999, 5000))
    assert [r.rank for r in top.orderBy("rank").collect()] == list(range(1, 1002))


def test_first_row_of_null_keys(spark):
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, "a"), (7, 5, "c")], "k long, o int, v string")
    assert {(r.k, r.v) for r in first_per_key(df, ["k"], F.col("o"), ["v"]).collect()} == {(None, "a"), (7, "c")}


def test_sql_functions_with_quotes(spark):
    rubric = Rubric((Term(r"it's \d+", 2.0, "o'clock"),))
    sql.register(spark, {"late": rubric}, {"kind": (rubric, ["o'clock", "none"])}, {"is_late": (rubric, 2.0)},
                 {"parts": (Field("hour", "bigint", r"it's (\d+)", "-1"),)})
    spark.createDataFrame([("it's 5",), ("no",), (None,)], "t string").createOrReplaceTempView("said")
    rows = spark.sql("SELECT late(t) AS a, kind(t) AS b, is_late(t) AS c, parts(t).hour AS d, "
                     "context_of('x', t, NULL, '!') AS e FROM said").collect()
    assert [tuple(r) for r in rows] == [(2.0, "o'clock", True, 5, "xit's 5!"), (0.0, "none", False, -1, "xno!"),
                                        (None, None, None, -1, "x!")]


def test_table_store_exists_only_tells_about_the_path(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert not store.exists("none")
    store.replace("some", spark.range(3))
    assert store.exists("some")
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        store.create_if_missing("broken", spark.range(1))


def test_explode_parts(spark):
    uses = spark.createDataFrame([("car", "wheel", 4), ("car", "door", 2), ("wheel", "bolt", 5), ("door", "bolt", 3),
                                  ("door", "hinge", 2), ("hinge", "bolt", 1)], "whole string, part string, quantity long")
    roots = spark.createDataFrame([("car",), ("bolt",)], "root string")
    found = {(r.root, r.part, r.level): r.quantity for r in explode_parts(uses, roots).collect()}
    assert found == {("car", "wheel", 1): 4, ("car", "door", 1): 2, ("car", "bolt", 2): 26, ("car", "hinge", 2): 4,
                     ("car", "bolt", 3): 4}
    circle = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "whole string, part string, quantity long")
    with pytest.raises(ValueError):
        explode_parts(circle, spark.createDataFrame([("a",)], "root string"))


def test_texts_without_words_are_no_near_duplicates(spark):
    texts = ["123", "456 789", "", "", None, "one two three", "one two three", "One, two three!"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {(r["id"], r["original"]) for r in tx.near_duplicate_groups(df, "id", "text", 0.8).toDF("id", "original").collect()}
    assert got == {(5, 5), (6, 5), (7, 5)}
