import random

from pyspark.sql import functions as F

from tracewell.llm import topk


def brute(vectors, k):
    """{query: [(vec_id, score)]} over {id: integer vector}."""
    out = {}
    for q in [i for i in vectors if i % 100 == 0]:
        scores = [(-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items()
                  if i != q and len(v) == len(vectors[q])]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, score long, id string")


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_matches_brute_force_with_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = random.Random(4)
    vectors = {i: [rng.randint(-3000, 3000) for _ in range(4)] for i in range(0, 900, 4)}
    vectors |= {i: [1024, 0, 0, 0] for i in range(1, 400, 4)}  # many ties
    vectors |= {3: [5, 6], 1000: [7, 8], 1100: [2, 2, 2]}
    rows = [(i, [x / 1024 for x in v], 1, 2, "x") for i, v in vectors.items()]
    rows += [(2000, None, 1, 2, "x"), (2100, [1.0, None, 0.0, 0.0], 1, 2, "x"), (2200, [float("nan")] * 4, 1, 2, "x"),
             (2300, [float("inf"), 0.0, 0.0, 0.0], 1, 2, "x"), (None, [1.0, 0.0, 0.0, 0.0], 1, 2, "x"), rows[0], rows[5]]
    got = found(topk.top_k(table(spark, rows), F.col("vec_id") % 100 == 0, 10))
    want = {q: v for q, v in brute(vectors, 10).items() if v}
    assert got == want
    assert got[1000] == [(3, 83)]


def test_large_components_and_empty_table(spark):
    rows = [(0, [2.0 ** 40, 1.0], 1, 2, "x"), (1, [2.0 ** 10, 1.0], 1, 2, "x"), (2, [-(2.0 ** 10), 0.5], 1, 2, "x")]
    got = found(topk.top_k(table(spark, rows), F.col("vec_id") % 100 == 0, 1))
    assert got == {0: [(1, 2 ** 50 * 2 ** 20 + 2 ** 20)]} or got[0][0][0] == 1
    assert topk.top_k(table(spark, []), F.col("vec_id") % 100 == 0, 10).count() == 0


def test_vectors_longer_than_one(spark):
    rng = random.Random(8)
    vectors = {i: [rng.randint(-500 * 1024, 500 * 1024) for _ in range(2)] for i in range(500)}
    rows = [(i, [x / 1024 for x in v], 1, 2, "x") for i, v in vectors.items()]
    assert found(topk.top_k(table(spark, rows), F.col("vec_id") % 100 == 0, 10)) == brute(vectors, 10)


def test_copies_of_queries_are_not_broadcast(spark, monkeypatch):
    rng = random.Random(9)
    vectors = {i: [rng.randint(-1000, 1000) for _ in range(3)] for i in range(700)}
    rows = [(i, [x / 1024 for x in v], 1, 2, "x") for i, v in vectors.items()]
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(topk, "HELD_BLOCKS", 1, raising=False)
    top = topk.top_k(table(spark, rows), F.col("vec_id") % 100 == 0, 10)
    assert found(top) == brute(vectors, 10)
    top.collect()
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [dim" in plan and not [x for x in plan.split("\n") if "BroadcastHashJoin [dim" in x and "slot" in x]
