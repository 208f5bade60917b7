import itertools
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_fixture as fixture
from tracewell.llm import jaccard

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = fixture.WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """{row number: (set size, component)} for (id, text) rows; ids may be null."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    members = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            members[root(i)].append(key)
    return [(len(sets[i]), min(members[root(i)], default=None)) for i in range(len(rows))]


def check(spark, rows):
    docs = fixture.documents(spark, [t for _, t in rows], ids=[k for k, _ in rows])
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(docs).collect()), key=repr)
    want = sorted(((k, n, c) for (k, _), (n, c) in zip(rows, brute(rows))), key=repr)
    assert got == want


def near_copies(n, seed):
    """Copies with a few changed words, so that some pairs link only through others."""
    rng = random.Random(seed)
    base = fixture.words(rng, 150)
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = rng.choice(fixture.SYLLABLES) + "x"
        out.append(" ".join(copy))
    return out


def test_matches_brute_force(spark):
    texts = fixture.awkward_texts() + near_copies(60, 5)
    rows = list(enumerate(texts)) + [(None, texts[7]), (None, "alone in the world of words"), (9, texts[9])]
    check(spark, rows)


def test_every_shingle_frequent_and_pairs_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 2)
    monkeypatch.setattr(jaccard, "FREQUENT_SLOTS", 64)
    monkeypatch.setattr(jaccard, "PAIRS_PER_ROW", 0)
    monkeypatch.setattr(jaccard, "FEW_FOUND", 0.0)
    check(spark, list(enumerate(near_copies(40, 6) + fixture.awkward_texts(3)[:20])))


def test_long_edits_around_a_common_passage(spark):
    """Texts that share most of a passage and are rarely similar, at distances on both sides of the bound."""
    rng = random.Random(11)
    base = fixture.words(rng, 120)
    texts = []
    for i in range(70):
        copy = list(base)
        at, size = rng.randrange(110), rng.choice((3, 8, 9, 14, 30))
        copy[at:at + size] = [f"e{i}x{j}" if rng.random() < 0.7 else base[j] for j in range(rng.choice((size, size // 2)))]
        texts.append(" ".join(copy))
    check(spark, list(enumerate(texts)))


@pytest.mark.parametrize("n", [1, 4, 5, 39, 40, 41, 144, 1000])
def test_column_form_of_the_prefix_length(spark, n):
    row = spark.range(1).select(F.lit(n).alias("n")).select(jaccard.after_prefix(F.col("n")).alias("after")).first()
    assert row.after == n - int(jaccard.prefix_length(n))


def test_no_documents(spark):
    assert jaccard.join(fixture.no_documents(spark)).count() == 0
    rows = jaccard.join(fixture.documents(spark, [None, "", " "])).collect()
    assert [(r.n_shingles, r.component_id) for r in sorted(rows)] == [(0, 0), (0, 1), (0, 2)]


@pytest.mark.parametrize("seed", range(5))
def test_similar_sets_meet_in_every_prefix(seed):
    rng = np.random.default_rng(seed)
    orders = jaccard.Orders((np.empty(0, np.uint64), np.empty(0, np.uint8)))
    for _ in range(200):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.1], rng.integers(0, 1 << 62, n // 8).astype(np.uint64)]))
        if len(b) and jaccard.similar(a, b):
            for salt in (0, *jaccard.OTHER_ORDERS):
                shared = np.isin(orders.prefix(a, salt), orders.prefix(b, salt)).sum()
                assert shared >= jaccard.prefix_shared(min(len(a), len(b)))


def test_few_rows_from_a_group_that_shares_much_and_is_rarely_similar(spark, monkeypatch):
    """150 texts of a passage with 25 of 146 shingles of their own, and copies of some that link with them alone."""
    rng = random.Random(17)
    base = fixture.words(rng, 150)
    texts = []
    for i in range(150):
        copy = list(base)
        for at in rng.sample(range(0, 150, 5), 5):
            copy[at] = f"e{i}x{at}"
        texts.append(" ".join(copy))
        if i % 10 == 0:
            texts.append(" ".join(copy[:-3]))
    made, cut_lineage = [], jaccard.cut_lineage

    def counted(step):
        out = cut_lineage(step)
        if "shared" in out.columns:  # rows that a join of groups made, by pair
            made.append(out.agg(F.sum("shared")).first()[0] or 0)
        return out

    monkeypatch.setattr(jaccard, "cut_lineage", counted)
    monkeypatch.setattr(jaccard, "PAIRS_PER_ROW", 1 << 20)  # all pairs at once
    check(spark, list(enumerate(texts)))
    assert 15 <= sum(made) < 10 * len(texts)  # 73,098 without the bound in the join


def test_codes_of_frequent_shingles(spark, monkeypatch):
    """Codes are counted by text, over slices and batches, and none is lost between two rows of its upper bits."""
    monkeypatch.setattr(jaccard, "FLUSH_CODES", 50)
    monkeypatch.setattr(jaccard, "SLICE_CHARS", 400)
    texts = list(dict.fromkeys(near_copies(40, 8)))
    docs = fixture.documents(spark, texts).select(F.col("doc_id").alias("doc"), "text").repartition(3)
    codes, classes = jaccard.frequent_codes(docs)
    counts = defaultdict(int)
    for text in texts:
        for code in set((jaccard.shingle_sets([text])[0] >> np.uint64(36)).tolist()):
            counts[code] += 1
    want = {code: n.bit_length() - 1 for code, n in counts.items() if n >= 2}
    assert dict(zip(codes.tolist(), classes.tolist())) == want


def test_rest_of_a_prefix(spark):
    docs = fixture.documents(spark, near_copies(5, 9)).select(F.col("doc_id").alias("doc"), "text")
    frequent = spark.sparkContext.broadcast(jaccard.frequent_codes(docs))
    rows = jaccard.prefix_rows(docs, frequent).groupBy("class").agg(
        F.min("rest").alias("last"), F.max("rest").alias("first"), F.first("n").alias("n"))
    rows = rows.select("first", "last", "n", jaccard.after_prefix(F.col("n")).alias("after")).collect()
    assert rows and all(r.first == r.n - 1 and r.last == r.after for r in rows)


def test_leaders_first_however_few_the_pairs(spark, monkeypatch):
    """A small table takes the same rounds as a large one: 60 near copies are tied together before pairs are made."""
    made, compared = [], jaccard.compared

    def counted(pairs, sets):
        made.append(pairs.count())
        return compared(pairs, sets)

    monkeypatch.setattr(jaccard, "compared", counted)
    monkeypatch.setattr(jaccard, "PAIRS_PER_ROW", 1 << 20)
    check(spark, list(enumerate(near_copies(60, 12))))
    assert len(made) == 2 and 0 < made[0] < 60 * 59 // 4


def test_rows_still_apart(spark):
    rows = spark.createDataFrame(
        [(1, 1, 1, 0), (1, 2, 1, 0), (1, 3, 1, 0), (2, 1, 1, 0), (2, 2, 1, 0), (3, 3, 1, 0), (3, 4, 1, 0), (4, 4, 80, 9)],
        "shingle long, class long, n int, rest int")
    component = spark.createDataFrame([(1, 1), (2, 1)], "class long, component long")
    apart = jaccard.still_apart(rows, component)
    got = sorted((r["shingle"], r["class"], r["component"]) for r in apart.collect())
    assert got == [(1, 1, 1), (1, 2, 1), (1, 3, 3), (3, 3, 3), (3, 4, 4)]
    assert {r["shingle"]: r["pairs"] for r in apart.groupBy("shingle").agg(F.sum("away").alias("pairs")).collect()} == {1: 2, 3: 1}
