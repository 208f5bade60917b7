import pytest

from tracewell.operators.graph import explode_parts
from tracewell.operators.parts import part_levels, reached_uses, total_parts

USES = "whole string, part string, quantity long"


def roots(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "root string")


def test_shared_parts_are_added_over_paths_of_any_length(spark):
    uses = spark.createDataFrame([("car", "wheel", 4), ("car", "door", 2), ("wheel", "bolt", 5), ("door", "bolt", 3),
                                  ("door", "hinge", 2), ("hinge", "bolt", 1), ("car", "bolt", 7), ("car", "wheel", 1),
                                  ("x", "y", 1)], USES)
    found = {(r.root, r.part): r.quantity for r in total_parts(uses, roots(spark, "car", "door", "bolt", "none")).collect()}
    assert found == {("car", "wheel"): 5, ("car", "door"): 2, ("car", "hinge"): 4, ("car", "bolt"): 25 + 6 + 4 + 7,
                     ("door", "hinge"): 2, ("door", "bolt"): 5}
    assert {r.node: r.level for r in part_levels(uses).collect()} == {
        "car": 0, "x": 0, "y": 1, "wheel": 1, "door": 1, "hinge": 2, "bolt": 3}


def test_deep_graph_with_many_paths(spark):
    """2^5 paths to the last part, and no more rows than edges."""
    rows = [(f"n{i}", f"{side}{i}", 1) for i in range(5) for side in "lr"]
    rows += [(f"{side}{i}", f"n{i + 1}", 1) for i in range(5) for side in "lr"]
    found = {r.part: r.quantity for r in total_parts(spark.createDataFrame(rows, USES), roots(spark, "n0")).collect()}
    assert len(found) == 15 and found["n5"] == 2 ** 5 and found["l4"] == 2 ** 4


def test_cycles(spark):
    uses = spark.createDataFrame([("a", "b", 1), ("b", "c", 1), ("c", "b", 1), ("d", "e", 2)], USES)
    for search in (total_parts, explode_parts):
        with pytest.raises(ValueError):
            search(uses, roots(spark, "a"))
        assert [(r.part, r.quantity) for r in search(uses, roots(spark, "d")).collect()] == [("e", 2)]
    with pytest.raises(ValueError):
        part_levels(uses)
    assert reached_uses(uses, roots(spark, "a")).count() == 3


def test_no_parts(spark):
    none = spark.createDataFrame([], USES)
    assert total_parts(none, roots(spark, "a")).count() == 0
    assert part_levels(none).count() == 0
