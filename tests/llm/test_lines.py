import random
import re

import numpy as np

import corpus_fixture as fixture
from tracewell.llm import lines

SPACE = "[\x20\x09-\x0D]"


def brute(rows):
    """(lines, dropped, kept text) per row of (id, text); a null id is the largest."""

    def key(line):
        return re.sub("[A-Z]+", lambda m: m[0].lower(), re.sub(f"^{SPACE}+|{SPACE}+$", "", line))

    holders: dict = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(float("inf") if doc is None else doc)
    out = []
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        own = float("inf") if doc is None else doc
        kept = [x for x in all_lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == own]
        out.append((doc, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in df.collect()), key=repr)


def corpus(n, seed):
    rng = random.Random(seed)
    pool = [" ".join(fixture.words(rng, rng.randint(1, 6))) for _ in range(60)] + ["éééééééééé", "ÉÉÉÉÉÉÉÉÉÉ", "中文字中文字中文字", "a b c d e", ""]
    shape = [str, str.upper, lambda x: "  " + x + "\t\x0b", lambda x: " " + x]
    return ["\n".join(rng.choice(shape)(rng.choice(pool)) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def table(spark, rows):
    return fixture.documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])


def test_matches_brute_force(spark):
    texts = fixture.awkward_texts(3) + corpus(80, 3)
    ids = list(range(len(texts)))
    random.Random(3).shuffle(ids)
    rows = [*zip(ids, texts), (None, texts[-1]), (None, texts[-2]), (7, texts[-3]), (7, texts[-3]), (8, texts[-4])]
    docs = table(spark, rows)
    assert found(lines.dedup(docs)) == brute(rows)
    assert found(lines.dedup(docs, arrivals=1)) == brute(rows)
    assert lines.dedup(fixture.no_documents(spark)).count() == 0


def counts(index):
    return sorted(map(tuple, index.counts.collect()))


def test_deletions_restore_the_index_of_what_is_left(spark, monkeypatch):
    monkeypatch.setattr(lines, "LEAST_SHARDS", 3)
    texts = corpus(60, 5)
    first, second = list(enumerate(texts[:40])), [(40 + i, t) for i, t in enumerate(texts[40:])]
    whole = lines.insert(lines.insert(lines.empty(spark), table(spark, first)), table(spark, second))
    out = spark.createDataFrame([(i,) for i in range(0, 60, 3)] + [(1000,)], "doc_id long")
    left = lines.delete(whole, out)
    rest = [(i, t) for i, t in enumerate(texts) if i % 3]
    assert counts(left) == counts(lines.insert(lines.empty(spark), table(spark, rest)))
    assert found(lines.kept_lines(left, table(spark, rest))) == brute(rest)
    # The filters hold as many fingerprints as there are keys, so nothing is left of the others.
    places = [np.frombuffer(r.places, np.uint16) for r in left.filters.collect()]
    assert sum(int((p > 0).sum()) for p in places) == left.counts.count() > 0
    back = [(i, t) for i, t in enumerate(texts) if not i % 3]
    again = lines.insert(left, table(spark, back))
    assert counts(again) == counts(whole)
    assert found(lines.kept_lines(again, table(spark, list(enumerate(texts))))) == brute(list(enumerate(texts)))
    none = lines.delete(whole, spark.createDataFrame([(i,) for i in range(60)], "doc_id long"))
    assert none.counts.count() == 0
    assert not any(np.frombuffer(r.places, np.uint16).any() for r in none.filters.collect())


def test_index_is_dealt_to_more_shards(spark, monkeypatch):
    monkeypatch.setattr(lines, "LEAST_SHARDS", 2)
    monkeypatch.setattr(lines, "SHARD_KEYS", 5)
    rows = list(enumerate(corpus(60, 6)))
    index = lines.insert(lines.insert(lines.empty(spark), table(spark, rows[:30])), table(spark, rows[30:]))
    assert index.shards > 4
    assert found(lines.kept_lines(index, table(spark, rows))) == brute(rows)


def test_cuckoo_filter_never_forgets(spark):
    rng = np.random.default_rng(1)
    keys = rng.integers(-(1 << 63), 1 << 63, 20_000, np.int64)
    held = lines.Cuckoo.sized(len(keys))
    assert held.add(keys) and held.holds(keys).all()
    others = rng.integers(-(1 << 63), 1 << 63, 100_000, np.int64)
    assert held.holds(others).mean() < 0.001
    assert held.remove(keys[::2]).all() and held.holds(keys[1::2]).all() and held.holds(keys[::2]).mean() < 0.01
    assert held.add(keys[::2]) and held.holds(keys).all()
    same = np.full(2 * lines.BUCKET, keys[0])
    small = lines.Cuckoo.sized(64)
    assert small.add(same) and not small.add(same[:1]) and small.holds(keys[:1]).all()
    assert small.remove(same).all() and not small.places.any()
