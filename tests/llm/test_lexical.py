import math
import random
import re
from collections import Counter

import pytest

import corpus_fixture as fixture
from tracewell.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(texts, ids, items, k):
    """{item: [(doc, score)]}; a null id comes last."""
    found = [Counter(terms(t)) for t in texts]
    n_docs, total = sum(1 for f in found if f), sum(sum(f.values()) for f in found)
    df = Counter(t for f in found for t in f)
    asked: dict = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = {}
    for item, own in asked.items():
        scores = []
        for doc, f in zip(ids, found):
            if not f:
                continue
            m = 10 + 90 * sum(f.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * f[t] // (1000 * f[t] + 8 * m))
                        for t in own if t in f)
            if score > 0:
                scores.append((-score, doc is None, doc))
        out[item] = [(doc, -s) for s, _, doc in sorted(scores)[:k]]
    return {item: rows for item, rows in out.items() if rows}


def found(df):
    out: dict = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return out


def tables(seed):
    rng = random.Random(seed)
    texts = fixture.awkward_texts(seed) + [" ".join(fixture.words(rng, rng.randint(1, 80))) for _ in range(150)]
    texts += [texts[-1]] * 30 + ["x-ray X_RAY é2É", "中文字, 中文字"]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    texts += [texts[-5], texts[-5], texts[9]]
    ids += [None, None, ids[9]]
    items = [(i, " ".join(rng.choice(t.split() or ["-"]) for t in rng.sample([t for t in texts if t], 12))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "...!"), (33, "nowhere"), (34, texts[-6]), (34, "RAY 中文字 É"), (None, texts[-7])]
    return texts, ids, items


@pytest.mark.parametrize("bucket,first,block", [(4096, 8000, 200_000), (16, 20, 60)])
def test_matches_brute_force(spark, monkeypatch, bucket, first, block):
    monkeypatch.setattr(lexical, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(lexical, "FIRST_ROWS", first)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", block)
    texts, ids, items = tables(7)
    asked = spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, doc string, score string")
    got = found(lexical.search(fixture.documents(spark, texts, ids=ids), asked))
    assert got == brute(texts, ids, items, 10)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    docs = fixture.documents(spark, ["a b"])
    assert lexical.search(fixture.no_documents(spark), items).count() == 0
    assert lexical.search(docs, items.filter("false")).count() == 0
    # One document holds every term, so every weight is floor(1000 ln(4/3)).
    assert [tuple(r) for r in lexical.search(docs, items).collect()] == [(1, 1, 0, 2 * 287 * (10 ** 9 // 1800))]
