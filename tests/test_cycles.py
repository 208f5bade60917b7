"""Fixed-length cycles against a search from every node, and the work around a hub."""

import random

import pytest

from tracewell.operators import cycles


def brute(edges, length):
    onward: dict = {}
    for a, b in set(edges):
        if None not in (a, b):
            onward.setdefault(a, set()).add(b)
    found = set()

    def walk(path):
        for node in onward.get(path[-1], ()):
            if node == path[0] and len(path) == length:
                found.add(tuple(path))
            elif node > path[0] and node not in path and len(path) < length:
                walk([*path, node])

    for start in onward:
        walk([start])
    return sorted(found)


@pytest.mark.parametrize("length", [3, 4, 5, 6])
def test_matches_a_search(spark, length):
    rng = random.Random(length)
    edges = [(f"n{0 if rng.random() < 1 / 3 else rng.randint(1, 25)}", f"n{rng.randint(0, 25)}") for _ in range(140)]
    edges += edges[:10] + [("n1", "n1"), (None, "n2"), ("n3", None)]
    df = spark.createDataFrame(edges, "a string, b string")
    got = [(r.steps, tuple(r.members)) for r in cycles.fixed_cycles(df, "a", "b", [length]).collect()]
    want = brute(edges, length)
    assert sorted(m for _, m in got) == want and {s for s, _ in got} <= {length}
    assert want


def test_a_hub_is_not_multiplied_out(spark):
    n = 1500
    edges = [(f"in{i}", "hub") for i in range(n)] + [("hub", f"out{i}") for i in range(n)]
    edges += [(f"out{i}", f"in{i}") for i in range(n)]
    df = spark.createDataFrame(edges, "a string, b string")
    known = cycles.ranked(df, "a", "b")
    # n * n paths lead through the hub, but none of them is made.
    assert cycles.half_paths(known, 2).count() <= 3 * n
    assert cycles.fixed_cycles(df, "a", "b", [3]).count() == n


def test_no_edges_and_short_lengths(spark):
    none = spark.createDataFrame([], "a long, b long")
    assert cycles.fixed_cycles(none, "a", "b", [3, 4]).count() == 0
    with pytest.raises(ValueError):
        cycles.fixed_cycles(none, "a", "b", [2])
