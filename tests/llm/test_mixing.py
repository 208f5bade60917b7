import random

import pytest
from pyspark.sql import functions as F

import corpus_fixture as fixture
from tracewell.llm import mixing


def targets_by_rounds(sizes, weights):
    """Share by weight, stop at twice the size, reshare what is above, until none is."""
    target = {s: 0.0 for s in sizes}
    rest, open_sources = mixing.BUDGET * sum(sizes.values()), set(sizes)
    while rest > 1e-9 and open_sources:
        total = sum(weights[s] for s in open_sources)
        for s in open_sources:
            target[s] += rest * weights[s] / total
        rest = sum(max(0.0, target[s] - 2 * sizes[s]) for s in open_sources)
        for s in list(open_sources):
            if target[s] >= 2 * sizes[s]:
                target[s] = 2.0 * sizes[s]
                open_sources.discard(s)
    return target


def awkward(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_ROWS", 5)
    rng = random.Random(2)
    texts = fixture.awkward_texts() + [" ".join(fixture.words(rng, rng.randint(1, 90))) for _ in range(150)]
    sources = [rng.choice(["hot"] * 4 + ["b", "é", "Z", "中", None]) for _ in texts]
    sources[0] = "only null"
    ids = [*range(len(texts) - 2), None, 5]
    return texts, sources, ids, fixture.documents(spark, texts, ids=ids, sources=sources)


def test_targets_and_words_taken(spark, monkeypatch):
    texts, sources, _, docs = awkward(spark, monkeypatch)
    rows = mixing.mix(docs, keep_rows=True).collect()
    assert len(rows) == len(texts)
    sizes: dict = {}
    for text, source in zip(texts, sources):
        sizes[source] = sizes.get(source, 0) + len(fixture.WORD.findall(text or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = targets_by_rounds(sizes, {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)})
    taken: dict = {}
    for r in rows:
        source = r.row.source
        assert r.row["size"] == "x" and r.source_size == sizes[source]
        assert r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 2 * r["size"] and r.copies <= 2 and len(r.moments) >= min(r.copies, 1)
        assert all(0 <= m <= 1 for m in r.moments) and list(r.moments) == sorted(r.moments)
        taken[source] = taken.get(source, 0) + r.taken
    for source, words in taken.items():
        assert abs(words - want[source]) <= 0.5


def test_reruns_and_partitions_agree(spark, monkeypatch):
    _, _, _, docs = awkward(spark, monkeypatch)
    first = sorted(map(str, mixing.taken(docs).collect()))
    assert first == sorted(map(str, mixing.taken(docs.repartition(7)).collect()))


def test_training_order(spark, monkeypatch):
    _, _, _, docs = awkward(spark, monkeypatch)
    mixed = mixing.mix(docs, keep_rows=True)
    ordered = mixing.training_order(mixed)
    assert ordered.columns == docs.columns
    assert ordered.count() == mixed.agg(F.sum("copies")).first()[0]


def test_no_documents_and_no_words(spark):
    assert mixing.taken(fixture.no_documents(spark)).count() == 0
    rows = mixing.taken(fixture.documents(spark, [None, " "])).collect()
    assert [(r["size"], r.target, r.taken, r.first_moment) for r in rows] == [(0, 0.0, 0, None)] * 2


def test_moments_invert_the_integrated_weight(spark):
    for schedule in mixing.SCHEDULES:
        shares = [i / 50 for i in range(51)]
        df = spark.createDataFrame([(s,) for s in shares], "done double")
        moments = [r.m for r in df.select(F.expr(mixing.moment_sql("done", schedule)).alias("m")).collect()]

        def demand(t):
            total = 0.0
            for (t0, a), (t1, b) in zip(schedule, schedule[1:]):
                x = min(max(t - t0, 0.0), t1 - t0)
                total += a * x + (b - a) / (t1 - t0) * x * x / 2
            return total

        assert [demand(m) / demand(1.0) for m in moments] == pytest.approx(shares)
