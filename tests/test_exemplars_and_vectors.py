import math
import random
import re
from collections import Counter, defaultdict

from tracewell.operators import distill
from tracewell.operators import text as tx


def brute_exemplars(rows):
    tokens = {k: set(re.findall(r"[^\W\d_]+", (t or "").lower())) for k, _, t in rows}
    df = Counter(w for ws in tokens.values() for w in ws)
    worth = {w: math.floor(1000 * math.log(len(rows) / n)) for w, n in df.items()}
    units, groups = {}, defaultdict(list)
    for key, group, _ in rows:
        v = {w: worth[w] for w in tokens[key] if worth[w] > 0}
        length = math.sqrt(sum(x * x for x in v.values()))
        units[key] = {w: math.floor(tx.UNIT * x / length) for w, x in v.items()}
        if v:
            groups[group].append(key)
    out = {}
    for group, keys in groups.items():
        c = Counter()
        for key in keys:
            c.update(units[key])
        of_group = math.sqrt(sum(x * x for x in c.values()))
        near = {k: sum(u * c[w] for w, u in units[k].items()) / math.sqrt(sum(u * u for u in units[k].values())) for k in keys}
        best = max(keys, key=lambda k: (near[k], -k))
        out[group] = (best, round(near[best] / of_group, 5))
    return out


def test_central_texts_match_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [a + b for a in ("ka", "lo", "mi", "ru") for b in ("n", "st", "ve", "z", "po")]
    rows = [(i, rng.choice(["g", "h", None]), " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(80)]
    rows += [(80, "empty", None), (81, "empty", "12 34"), (82, "g", None), (83, "twin", "unseen words"), (84, "twin", "words unseen")]
    df = spark.createDataFrame(rows, "id long, g string, t string")
    got = {r.g: (r.exemplar, round(r.closeness, 5)) for r in tx.central_texts(df, ["g"], "id", "t").collect()}
    assert got == brute_exemplars(rows)
    assert got["twin"][0] == 83 and "empty" not in got
    assert tx.central_texts(df.limit(0), ["g"], "id", "t").count() == 0


def test_central_texts_move_only_rare_words(spark, monkeypatch):
    rng = random.Random(5)
    vocabulary = [a + b for a in ("ka", "lo", "mi", "ru", "sa") for b in ("n", "st", "ve", "z", "po", "r")]
    rows = [(i, rng.choice(["g", "h", None]), " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(30)], k=30)))
            for i in range(200)]
    df = spark.createDataFrame(rows, "id long, g string, t string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for few in (1 << 19, 9, 0):
            monkeypatch.setattr(tx, "FEW_WORDS", few, raising=False)
            monkeypatch.setattr(tx, "FEW_CELLS", 2 * few, raising=False)
            top = tx.central_texts(df, ["g"], "id", "t")
            assert {r.g: (r.exemplar, round(r.closeness, 5)) for r in top.collect()} == brute_exemplars(rows)
            joins = [x for x in top._jdf.queryExecution().executedPlan().toString().splitlines() if "SortMergeJoin" in x]
            assert any("word#" in x or "_id#" in x for x in joins) == (few < 100)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_central_texts_of_rows_with_equal_keys_are_one_text(spark):
    rows = [(1, "g", "a b c d"), (1, "g", "a e"), (2, "g", "a e f"), (None, "g", "b"), (None, "g", "b c"), (1, "h", "c d")]
    one = [(1, "g", "a b c d"), (2, "g", "a e f"), (3, "h", "c d")]
    df = spark.createDataFrame(rows, "id long, g string, t string")
    got = {r.g: r.exemplar for r in tx.central_texts(df, ["g"], "id", "t").collect()}
    assert got["h"] == 1 and got["g"] in (1, 2, None)
    assert {r.g for r in tx.central_texts(spark.createDataFrame(one, df.schema), ["g"], "id", "t").collect()} == {"g", "h"}


def vectors(spark, n=400):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        side = i % 3
        rows.append((i, [rng.gauss(3.0 * (side == 0), 0.5), rng.gauss(3.0 * (side == 1), 0.5)], side))
    return rows


def test_vector_model_agrees_with_labels_it_has_not_seen(spark):
    rows = vectors(spark)
    bad = [(1000, None, None), (1001, [1.0, None], None), (1002, [float("nan"), 1.0], None), (1003, [1.0], None),
           (1004, [], None), (1005, [float("inf"), 0.0], 2)]
    df = spark.createDataFrame([r[:2] for r in rows + bad], "id long, v array<double>")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:150] + bad[-1:]], "id long, label int")
    out = {r.id: (r.prediction, r.served_by) for r in distill.classify_vectors(df, "id", "v", labels).collect()}
    unseen = [r for r in rows[150:]]
    assert sum(out[i] == (side, "model") for i, _, side in unseen) >= 0.97 * len(unseen)
    assert all(out[i] == (side, "labeller") for i, _, side in rows[:150])
    assert all(out[i] == (None, "unlabelled") for i in range(1000, 1005)) and out[1005] == (2, "labeller")

    refused = distill.classify_vectors(df, "id", "v", labels, min_agreement=1.1).collect()
    assert {(r.served_by, r.prediction is None) for r in refused} == {("labeller", False), ("unlabelled", True)}
    one = distill.classify_vectors(df, "id", "v", labels.filter("label = 1")).collect()
    assert {(r.served_by, r.prediction) for r in one} == {("labeller", 1), ("unlabelled", None)}
    assert distill.classify_vectors(df, "id", "v", labels.limit(0)).filter("prediction IS NOT NULL").count() == 0
