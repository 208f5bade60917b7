import hashlib

import pytest
import xxhash

import corpus_fixture as fixture
from tracewell.llm import queries
from tracewell.llm import winnowing as w


def run_hash(run, characters):
    if characters:
        h = xxhash.xxh64_intdigest("".join(run).encode("utf-32-be"), seed=42)
    else:
        h = 42
        for word in run:
            h = xxhash.xxh64_intdigest(word.encode(), seed=h)
    return (h - (1 << 64) if h >> 63 else h) >> 32


def chosen(text, gram=w.GRAM, window=w.WINDOW, characters=False):
    units = list(text) if characters else fixture.WORD.findall(text)
    if not units:
        return []
    runs = [run_hash(units[i:i + gram], characters) for i in range(max(1, len(units) - gram + 1))]
    out = {}
    for i in range(max(1, len(runs) - window + 1)):
        value, place = min((runs[j], -j) for j in range(i, min(i + window, len(runs))))
        out[value, -place] = None
    return list(out)


def printed(hashes):
    return " ".join(f"{h & w.LOW:x}:{p}" for h, p in hashes)


def likeness(a, b):
    a, b = {x for x, _ in a}, {x for x, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("form", [
    {}, {"gram": 3, "window": 5}, {"characters": True, "gram": w.CHARACTER_GRAM, "window": w.CHARACTER_WINDOW},
    {"characters": True, "gram": 4, "window": 7}, {"characters": True, "gram": 2, "window": 1}])
def test_matches_brute_force(spark, form):
    texts = fixture.awkward_texts()
    texts = [*texts[:-1], "\U0001F600\u00e9\u4e00 " * 30, "a" * 200, "".join(chr(97 + i % 7) for i in range(95)), texts[-1]]
    ids = [*range(1, len(texts)), None]
    extra = [(5, texts[9]), (None, "zz last")]
    rows = [*zip(ids, texts), *extra]
    docs = fixture.documents(spark, [t for _, t in rows], ids=[k for k, _ in rows])
    by_id: dict = {}
    for key, text in rows:
        by_id.setdefault(key, []).append(text or "")
    order = sorted((k for k in by_id if k is not None), reverse=True) + [None]
    want = []
    for i, key in enumerate(order):
        after = min(by_id[order[(i + 1) % len(order)]], key=lambda t: t.encode())
        for text in by_id[key]:
            third = len(text) // 3
            edited = text[:len(text) - third] + after[:third]
            a, b, c = (chosen(t, **form) for t in (text, edited, after))
            want.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), printed(a), printed(b),
                         likeness(a, b), likeness(a, c)))
    got = [tuple(r) for r in w.fingerprint_edits(docs, **form).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_single_document_and_none(spark):
    assert w.fingerprint_edits(fixture.no_documents(spark)).count() == 0
    row = w.fingerprint_edits(fixture.documents(spark, ["abcdef"])).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    assert row.near_next == 1.0


@pytest.mark.parametrize("gram,window", [(3, 5), (4, 4), (7, 1), (1, 3)])
def test_other_lengths_keep_the_guarantee(spark, gram, window):
    words = fixture.words(fixture.random.Random(gram), 60)
    texts = [" ".join(words[:40]), " ".join(["other"] * 9 + words[20:20 + gram + window - 1] + ["more"] * 9)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    a, b = [set(r.h) for r in w.fingerprints(df, "text", "c", gram, window).select(w.hashes("c").alias("h")).collect()]
    assert a & b


def test_query_finds_passages_without_blanks(spark, tmp_path):
    rng = fixture.random.Random(8)
    shared = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(w.CHARACTER_GRAM + w.CHARACTER_WINDOW - 1))
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n)) for n in (300, 400)]
    texts = [texts[0][:70] + shared + texts[0][70:], texts[1][:150] + shared + texts[1][150:], "\U0001F600 a\x00", "", None]
    fixture.documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in queries.op6_winnowing(spark, str(tmp_path)).collect()}
    assert all(rows[i].near_edited > 0.3 for i in (0, 1)) and rows[1].near_next > 0
    assert rows[2].fingerprint.endswith(":0") and rows[3].fingerprint == rows[4].fingerprint == ""
    # The hashes are those of the code points.
    assert rows[0].fingerprint == printed(chosen(texts[0], w.CHARACTER_GRAM, w.CHARACTER_WINDOW, True))


def test_hashes_travel_in_32_bits(spark):
    df = w.fingerprints(spark.createDataFrame([("a b c d e f g h i j",), ("",)], "t string"), "t", "chosen", 2, 3)
    out = df.select(w.hashes("chosen").alias("h"), "chosen")
    assert out.schema["h"].dataType.simpleString() == "array<int>"
    assert all(set(r.h) == {x >> 32 for x in r.chosen} for r in out.collect())


@pytest.mark.parametrize("characters", [False, True])
def test_places_travel_in_a_byte_and_long_runs(spark, characters):
    text = " ".join(f"w{i * i % 977}" for i in range(9000))  # places far beyond a byte
    df = w.fingerprints(spark.createDataFrame([(text,), ("a",), ("",)], "t string"), "t", "chosen", 3, 5, characters)
    apart = df.withColumns(w.packed("chosen", characters))
    assert [apart.schema[c].dataType.simpleString() for c in ("_hash", "_low", "_high")] == [
        "array<int>", "array<tinyint>", "array<int>"]
    rows = apart.withColumn("again", w.unpacked(characters)).collect()
    assert all(r.again == r.chosen for r in rows) and max(len(set(r._high)) for r in rows) < 300


def test_no_long_array_is_shuffled(spark):
    docs = fixture.documents(spark, ["a b c d e f g h", "b c d", None])
    plan = w.fingerprint_edits(docs, characters=True)._jdf.queryExecution().optimizedPlan()
    dealt = [str(node.child().output()) + str(node.child().schema().simpleString()) for node in _nodes(plan)
             if node.nodeName().startswith("Repartition")]
    assert dealt and not any("array<bigint>" in x for x in dealt)


def _nodes(plan):
    children = plan.children()
    yield plan
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def test_likeness_takes_one_set_operation(spark):
    rows = [([1, 2, 3], [2, 3, 4]), ([], []), ([1], [])]
    out = spark.createDataFrame(rows, "a array<int>, b array<int>").select(w.likeness("a", "b").alias("x"))
    assert [r.x for r in out.collect()] == [0.5, 1.0, 0.0]
    assert "array_union" not in out._jdf.queryExecution().toString()
