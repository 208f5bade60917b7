import itertools
import random
import re

import corpus_fixture as fixture
from tracewell.llm import audit


def failed(texts, ids, i):
    text = texts[i] or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
    out += "C" * (100 * len(re.findall("[A-Z]", text)) > 2 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
    earlier = any((texts[j] or "") == text and None not in (ids[i], ids[j]) and ids[j] < ids[i] for j in range(len(texts)))
    return out + "E" * earlier


def brute(texts, ids, sources, labels):
    """The report by going through every order, document by document."""
    fails = [failed(texts, ids, i) for i in range(len(texts))]
    out = {}
    for part in {s or "" for s in sources}:
        rows = [i for i in range(len(texts)) if (sources[i] or "") == part]
        first = {name: 0 for name in "ABCDE"}
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(rows)
            for step, name in enumerate(order, 1):
                gone = [i for i in left if name in fails[i]]
                left = [i for i in left if name not in fails[i]]
                first[name] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(name in fails[i] for i in rows) - len(gone), sum(fails[i] == name for i in rows),
                    sum(labels.get(ids[i], (0, 0))[0] for i in gone), sum(labels.get(ids[i], (0, 0))[1] for i in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(first[order[step - 1]])
    return {key: tuple(row) for key, row in out.items()}


def found(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
            for r in df.collect()}


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(audit, "SLOT_ROWS", 3)
    rng = random.Random(2)
    texts = fixture.awkward_texts(2)
    texts += [" ".join(fixture.words(rng, 250)) + rng.choice(["", " 5 %", " ABCDEFGHIJKLMNOP" * 9]) for _ in range(20)]
    texts += [rng.choice(texts[-20:]) for _ in range(25)] + [texts[-1]] * 30
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    sources = [rng.choice(["a", "b", "", None]) for _ in texts]
    texts += [texts[3], texts[3], texts[-1], "no one else's"]
    ids += [None, None, ids[-1], ids[5]]  # rows without an id, and ids that repeat
    sources += ["a", "a", "b", "b"]
    labels = {i: (rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 60, 2)}
    rows = [(i, *x, "x") for i, x in labels.items()] + [(4, 0, 0, "x"), (None, 1, 1, "x"), (9_999, 1, 1, "x"), (6, None, None, "x")]
    table = spark.createDataFrame(rows, "doc_id long, quality int, toxic int, hash string")
    got = found(audit.audit(fixture.documents(spark, texts, ids=ids, sources=sources), table))
    assert got == brute(texts, ids, sources, labels)


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(fixture.no_documents(spark), labels).count() == 0
    got = found(audit.audit(fixture.documents(spark, [None], sources=[None]), labels))
    assert len(got) == 600 and got["", "BACDE", 2] == (0, 1, 0, 1, 0, 0, 120)
