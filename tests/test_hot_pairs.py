import itertools
import random

import pytest

from tracewell.operators.graph import _shared_links, top_shared_pairs

LINKS = "entity_type string, entity_id string, member long"


def brute(rows, limit):
    entities = {}
    for kind, entity, member in set(rows):
        entities.setdefault(member, set()).add((kind, entity))
    pairs = ((len(entities[a] & entities[b]), a, b) for a, b in itertools.combinations(sorted(entities), 2))
    return sorted((-n, a, b) for n, a, b in pairs if n)[:limit]


@pytest.mark.parametrize("seed, hot, cold, limit", [(1, 3, 40, 20), (2, 6, 15, 60), (3, 2, 0, 15)])
def test_pairs_with_several_hot_entities(spark, seed, hot, cold, limit):
    rng = random.Random(seed)
    rows = [("hot", f"h{h}", m) for h in range(hot) for m in range(60) if rng.random() < 0.4]
    rows += [("cold", f"c{rng.randrange(cold)}", rng.randrange(60)) for _ in range(120) if cold]
    df = spark.createDataFrame(rows, LINKS)
    found = [(-r.shared_entities, r.a, r.b) for r in top_shared_pairs(df, limit, probe_degree=6).collect()]
    assert found == brute(rows, limit)


def test_three_thousand_members_under_three_hot_entities(spark):
    """4.5 million pairs share two or three hot entities; classes of equal members stand for them."""
    rows = [("k", f"h{h}", m) for h in range(3) for m in range(3000) if h != 2 or m % 2]
    rows += [("k", "rare", m) for m in (2998, 2999)]
    df = spark.createDataFrame(rows, LINKS)
    found = [(r.a, r.b, r.shared_entities) for r in top_shared_pairs(df, 6).collect()]
    assert found == [(1, b, 3) for b in (3, 5, 7, 9, 11)] + [(1, 13, 3)]
    assert (2998, 2999, 3) in {tuple(r) for r in top_shared_pairs(df.filter("entity_id <> 'h2'"), 1).collect()}


def test_links_of_entities_with_one_member_are_left_out_before_any_other_step(spark):
    rows = [("k", f"own{m}", m) for m in range(50)] * 2 + [("k", "both", 1), ("k", "both", 2), ("j", "own1", 2), ("k", None, 3)]
    kept = _shared_links(spark.createDataFrame(rows, LINKS)).collect()
    assert sorted(map(tuple, kept)) == [("k", "both", 1), ("k", "both", 2)]
