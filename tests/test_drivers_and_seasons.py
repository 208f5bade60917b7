"""Drivers over many dimensions and joint seasons, at planted cases and against plain versions."""

import datetime
import itertools
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tracewell.operators import augmented as aa
from tracewell.session import cut_lineage


def facts(spark, n, dims, seed):
    rng = random.Random(seed)
    rows = [(*[rng.choice([None, "a", "a", "b", f"c{rng.randint(0, 30)}"]) for _ in range(dims)], rng.random() < 0.4,
             Decimal(rng.randint(-300, 2000)) / 100) for _ in range(n)]
    names = [f"d{i}" for i in range(dims)]
    return spark.createDataFrame(rows, ", ".join(f"{d} string" for d in names) + ", label boolean, m decimal(10,2)"), names


def test_grown_segments_equal_all_grouping_sets(spark):
    df, names = facts(spark, 3000, 4, 1)
    for support in (0.02, 0.3):
        cube = aa.key_drivers(df, "m", names, "label", top_k=200, min_support=support).collect()
        grown = aa.supported_drivers(df, "m", names, "label", top_k=200, min_support=support).collect()
        assert cube and sorted(map(tuple, grown), key=repr) == sorted(map(tuple, cube), key=repr)


def test_twelve_dimensions_with_a_planted_driver(spark):
    rng = random.Random(4)
    names = [f"d{i}" for i in range(12)]
    rows = []
    for _ in range(4000):
        values = [rng.choice("abcdefgh") for _ in names]
        label = rng.random() < 0.5
        weight = 400 if label and values[3] == "b" and values[8] == "e" else 1
        rows.append((*values, label, float(weight)))
    df = spark.createDataFrame(rows, ", ".join(f"{d} string" for d in names) + ", label boolean, m double")
    best = aa.supported_drivers(df, "m", names, "label", top_k=5, min_support=0.1).collect()
    assert ["d3=b", "d8=e"] in [r["drivers"] for r in best]
    assert aa.supported_drivers(df, "m", names, "label", min_support=2.0).count() == 0
    assert aa.supported_drivers(df.filter("false"), "m", names, "label").count() == 0


def test_combinations_that_agree_in_what_still_grows_become_one(spark, monkeypatch):
    """Every row is a combination of its own, but only two values of two dimensions grow together."""
    written = []

    def noting(df):
        out = cut_lineage(df)
        written.append((out.columns, out.count()))
        return out

    monkeypatch.setattr(aa, "cut_lineage", noting)
    rng = random.Random(6)
    names = [f"d{i}" for i in range(6)]
    rows = [("a" if k % 10 < 8 else None, "x\x1fy" if k % 5 < 4 else "z", *[rng.choice("pqr") for _ in names[3:]], f"{k}",
             k % 2 == 0, Decimal(rng.randrange(1, 9))) for k in range(600)]
    df = spark.createDataFrame(rows, ", ".join(f"{d} string" for d in names) + ", label boolean, m decimal(18,4)")
    for support in (0.1, 0.6):
        grown = aa.supported_drivers(df, "m", names, "label", top_k=500, min_support=support).collect()
        cube = aa.key_drivers(df, "m", names, "label", top_k=500, min_support=support).collect()
        assert cube and sorted(map(tuple, grown), key=repr) == sorted(map(tuple, cube), key=repr)
    # Beyond single values nothing but these two is left of a combination.
    assert written[-1][1] == 1 and written[0][1] == 600
    assert aa.supported_drivers(df, "m", [], "label").count() == 0


def test_joint_seasons_recover_planted_components(spark):
    day = datetime.date(2020, 1, 1)
    weekly = [3.0, -1.0, 0.5, -2.5, 2.0, -4.0, 2.0]  # Sunday first
    yearly = [10 * math.cos(m) for m in range(12)]
    yearly = [v - sum(yearly) / 12 for v in yearly]
    rows = []
    for i in range(5 * 365):
        d = day + datetime.timedelta(days=i)
        rows.append(("s", d, 100 + 0.01 * i + weekly[d.isoweekday() % 7] + yearly[d.month - 1]))
    df = spark.createDataFrame(rows, "k string, ts date, y double")
    out = aa.joint_seasonality(df, "y", "ts", ["k"], ["weekly", "yearly"])
    found = {r["w"]: r["v"] for r in out.groupBy(F.dayofweek("ts").alias("w")).agg(F.first("weekly").alias("v")).collect()}
    assert all(found[i + 1] == pytest.approx(v, abs=0.05) for i, v in enumerate(weekly))
    found = {r["w"]: r["v"] for r in out.groupBy(F.month("ts").alias("w")).agg(F.first("yearly").alias("v")).collect()}
    assert all(found[i + 1] == pytest.approx(v, abs=0.3) for i, v in enumerate(yearly))
    left = out.agg(F.max(F.abs("remainder"))).first()[0]
    assert left < 0.5


def test_joint_seasons_do_not_count_twice(spark):
    """Weekdays only in one half of the year: what they share with the months is explained once."""
    rows, day = [], datetime.date(2020, 1, 1)
    for i in range(5 * 365):
        d = day + datetime.timedelta(days=i)
        if d.month <= 6 or d.isoweekday() == 7:
            rows.append(("s", d, (5.0 if d.isoweekday() == 7 else 0.0) + (2.0 if d.month <= 6 else 0.0)))
    df = spark.createDataFrame(rows, "k string, ts date, y double")
    joint = aa.joint_seasonality(df, "y", "ts", ["k"], ["weekly", "yearly"], rounds=8)
    apart = aa.seasonality(df, "y", "ts", ["k"], ["weekly", "yearly"])

    def spread(out, column, phase):
        v = [r["v"] for r in out.groupBy(phase.alias("p")).agg(F.first(column).alias("v")).collect() if r["v"] is not None]
        return max(v) - min(v)

    assert abs(spread(joint, "yearly", F.month("ts")) - 2.0) < abs(spread(apart, "yearly", F.month("ts")) - 2.0)


def test_seasons_of_nothing(spark):
    none = spark.createDataFrame([], "k string, ts date, y double")
    assert aa.joint_seasonality(none, "y", "ts", ["k"]).count() == 0
    one = spark.createDataFrame([("s", datetime.date(2020, 1, 1), 1.0)], "k string, ts date, y double")
    assert aa.joint_seasonality(one, "y", "ts", ["k"]).first()["weekly"] is None
