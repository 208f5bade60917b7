"""Sharding, quality and toxicity."""

import math
import random
import zlib
from collections import Counter

import pytest

import corpus_fixture as fixture
from tracewell.llm import quality, sharding, toxicity

BAD = ["scumx", "morony", "trashz"]


def test_table_is_balanced_and_moves_little():
    shards = [f"s{i}" for i in range(16)]
    table = sharding.fill_table(shards, 10_007)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert [shards[i] for i in table] == [sorted(shards)[i] for i in sharding.fill_table(sorted(shards), 10_007)]
    fewer = sharding.fill_table(shards[:-1], 10_007)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 15)
    assert moved < 0.15 * len(table)
    for wrong in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill_table(wrong)
    with pytest.raises(ValueError):
        sharding.fill_table(["a"], 10)


def test_turns_claim_the_first_free_slot_of_each_preference():
    shards, size = ["b", "a", "c"], 11
    preference = {}
    for s in shards:
        at, step = sharding._number(s, "offset") % size, sharding._number(s, "step") % (size - 1) + 1
        preference[s] = [(at + i * step) % size for i in range(size)]
    owner: dict = {}
    while len(owner) < size:
        for s in sorted(shards):
            free = [slot for slot in preference[s] if slot not in owner]
            if free:
                owner[free[0]] = s
    assert [owner[i] for i in range(size)] == [shards[i] for i in sharding.fill_table(shards, size)]


def test_placement(spark):
    shards = [f"s{i}" for i in range(5)]
    docs = fixture.documents(spark, ["t"] * 300 + [None], ids=[*range(298), None, 7, 8])
    rows = fixture.collected(sharding.place(docs, shards, size=101))
    table = sharding.fill_table(shards, 101)
    assert sum(map(len, rows.values())) == 301 and len(rows[7]) == 2
    assert all(r.shard == shards[table[r.slot]] for group in rows.values() for r in group)
    assert len({r.shard for r in rows[7]}) == 1
    assert sharding.place(fixture.no_documents(spark), shards, size=101).count() == 0


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus(n, seed):
    """Texts, of which every fifth has words that no other has; label 1 marks those."""
    rng = random.Random(seed)
    texts, marks = [], []
    for i in range(n):
        words = fixture.words(rng, rng.randint(20, 120))
        if i % 5 == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        texts.append(" ".join(words))
        marks.append(int(i % 5 == 0))
    return texts, marks


def test_toxicity_held_out(spark):
    texts, marks = corpus(400, 1)
    texts += [None, "", " ", "scumx", "x " * 100_000]
    docs = fixture.documents(spark, [*texts, texts[3]], ids=[*range(len(texts)), None])
    known = labels(spark, [(i, 1, m) for i, m in enumerate(marks)] + [(None, 0, 1), (3, 0, None), (2, 1, 0)])
    rows = fixture.collected(toxicity.classify(docs, known))
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert [i for i in range(400) if rows[i][0].held_out] == held
    assert sum(rows[i][0].predicted == marks[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for g in rows.values() for r in g)
    assert [rows[i][0].predicted for i in (400, 401, 402, 404, None)] == [0] * 5
    assert rows[403][0].predicted == 1


def test_toxicity_ignores_held_out_labels(spark):
    texts, marks = corpus(150, 2)
    docs = fixture.documents(spark, texts)
    told = [(i, 1, m) for i, m in enumerate(marks)]
    lied = [(i, 1, 1 - m if zlib.crc32(str(i).encode()) % 3 == 1 else m) for i, m in enumerate(marks)]
    a, b = (sorted(toxicity.classify(docs, labels(spark, x)).collect()) for x in (told, lied))
    assert a == b


def test_toxicity_counts_all_expressions_of_a_model(spark, monkeypatch):
    texts, marks = corpus(300, 4)
    rare = [f"badword{i}" for i in range(0, 300, 5)]
    texts = [f"{t} {rare[i // 5]} {rare[(i // 5 + 1) % 60]} {rare[(i // 5 + 2) % 60]}" if i % 5 == 0 else t
             for i, t in enumerate(texts)]
    docs = fixture.documents(spark, [*texts, texts[0], None], ids=[*range(300), None, 7])
    known = labels(spark, [(i, 1, m) for i, m in enumerate(marks)])
    whole = sorted(toxicity.classify(docs, known).collect(), key=repr)
    for most in (0, 5, 20):
        monkeypatch.setattr(toxicity, "FREQUENT", most)
        assert sorted(toxicity.classify(docs, known).collect(), key=repr) == whole


def test_toxicity_of_pairs_of_ordinary_words(spark):
    rng = random.Random(6)
    texts, marks = [], []
    for i in range(300):
        words = fixture.words(rng, rng.randint(20, 60))
        for _ in range(4):
            at = rng.randrange(len(words))
            words[at:at] = ["kill", "yourself"] if i % 5 == 0 else rng.choice((["kill", "time"], ["help", "yourself"]))
        texts.append(" ".join(words))
        marks.append(int(i % 5 == 0))
    known = labels(spark, [(i, 1, m) for i, m in enumerate(marks)])
    rows = fixture.collected(toxicity.classify(fixture.documents(spark, texts), known))
    held = [i for i in rows if rows[i][0].held_out]
    assert sum(rows[i][0].predicted == marks[i] for i in held) >= 0.97 * len(held)


def test_toxicity_of_expressions_of_one_toxic_text(spark):
    rng = random.Random(12)
    texts = [f"only{i} once{i} single{i}" if i % 5 == 0 else " ".join(rng.choices(["red", "green", "blue", "grey"], k=6))
             for i in range(300)]
    crc = [zlib.crc32(str(i).encode()) for i in range(300)]
    told = [i for i in range(300) if crc[i] % 3 != 1 and crc[i] % 12 >= 3]
    counts = {mark: Counter(w for i in told if (i % 5 == 0) == mark for w in set(texts[i].split())) for mark in (True, False)}
    freed = {mark: sum(min(n, toxicity.DISCOUNT) for n in c.values()) / sum(c.values()) for mark, c in counts.items()}
    value = math.log1p(toxicity.SHARE / (1 - toxicity.SHARE) * (freed[True] / freed[False] - toxicity.EXCESS))
    seen = [i for i in told if i % 5 == 0][:3]
    known = labels(spark, [(i, 1, int(i % 5 == 0)) for i in range(300)])
    docs = fixture.documents(spark, [*texts, "only%d once%d single%d" % tuple(seen), "red green blue"])
    rows = fixture.collected(toxicity.classify(docs, known))
    assert freed[True] > toxicity.EXCESS * freed[False]
    assert abs(rows[300][0].difference - value) < 1e-6 and rows[301][0].difference == 0


def test_toxicity_without_labels(spark):
    docs = fixture.documents(spark, ["some words", None])
    assert {r.predicted for r in toxicity.classify(docs, labels(spark, [])).collect()} == {0}
    assert {r.predicted for r in toxicity.classify(docs, labels(spark, [(0, 1, 1), (1, 1, 1)])).collect()} == {0}
    assert toxicity.classify(fixture.no_documents(spark), labels(spark, [(0, 1, 1)])).count() == 0


def test_quality_held_out_and_odd_rows(spark):
    rng = random.Random(3)
    texts, marks = [], []
    for i in range(300):
        if i % 4:
            texts.append(". ".join(" ".join(fixture.words(rng, 8)) for _ in range(rng.randint(3, 9))))
        else:
            texts.append(" ".join([fixture.words(rng, 1)[0] + "%%%"] * rng.randint(30, 90)))
        marks.append(int(i % 4 > 0))
    texts += [None, "", "a", texts[1], "x" * 200_000]
    sources = ["hot" if i % 3 else rng.choice(["a", "b", None]) for i in range(len(texts))]
    docs = fixture.documents(spark, texts, ids=[*range(303), None, 304], sources=sources)
    known = labels(spark, [(i, m, 0) for i, m in enumerate(marks)] + [(None, 0, 0), (4, None, 0)])
    rows = fixture.collected(quality.classify(docs, known))
    assert sum(map(len, rows.values())) == len(texts)
    held = [i for i in range(300) if rows[i][0].held_out]
    assert sum(rows[i][0].predicted == marks[i] for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and 0 < r.path_rate < 1 for g in rows.values() for r in g)


def test_quality_rates_shrink_sparse_groups(spark):
    """With nothing in the texts to go by, a small host's rate lies between its own and the global one."""
    n = 400
    hosts = ["good" if i % 2 else "bad" for i in range(n)] + ["small"] * 3
    good = [1 if i % 2 == (i % 10 > 0) else 0 for i in range(n)]
    docs = fixture.documents(spark, ["same text for all"] * len(hosts), sources=hosts)
    known = labels(spark, [(i, q, 0) for i, q in enumerate(good)])
    rows = quality.classify(docs, known).collect()
    rate = {h: [r.host_rate for r in rows if hosts[r.doc_id] == h] for h in ("good", "bad", "small")}
    mean = {h: sum(v) / len(v) for h, v in rate.items()}
    assert mean["bad"] < mean["small"] < mean["good"]


def test_quality_empty_tables(spark):
    assert quality.classify(fixture.no_documents(spark), labels(spark, [])).count() == 0
    rows = quality.classify(fixture.documents(spark, ["a b c", None]), labels(spark, [])).collect()
    assert {round(r.score, 6) for r in rows} == {0.5}
