import hashlib
import random

import numpy as np
import pytest

import corpus_fixture as fixture
from tracewell.llm import suffixes


def brute(rows):
    """(removed, spans, digest) per row of (id, text); a null id is the largest."""
    size = suffixes.LENGTH
    ids = [suffixes.NO_ID if k is None else k for k, _ in rows]
    data = [(t or "").encode() for _, t in rows]
    first: dict = {}
    for key, text in zip(ids, data):
        for i in range(len(text) - size + 1):
            string = text[i:i + size]
            first[string] = min(key, first.get(string, key))
    out = []
    for key, text in zip(ids, data):
        gone = bytearray(len(text))
        for i in range(len(text) - size + 1):
            if first[text[i:i + size]] < key:
                gone[i:i + size] = b"\1" * size
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, rows):
    docs = fixture.documents(spark, [t for _, t in rows], ids=[k for k, _ in rows])
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                  for r in suffixes.digests(docs).collect()), key=repr)
    assert got == sorted(((k, *x) for (k, _), x in zip(rows, brute(rows))), key=repr)


def passages(n, seed):
    """Texts cut and joined from a few passages, so that strings repeat at all offsets."""
    rng = random.Random(seed)
    source = " ".join(fixture.words(rng, 250))
    out = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(1, 4)):
            at = rng.randrange(len(source))
            text += source[at:at + rng.randint(20, 160)] + rng.choice(["", " ", "é", "xyz"])
        out.append(text)
    return out


def test_matches_brute_force(spark):
    texts = fixture.awkward_texts()
    rows = [*enumerate(texts), (None, texts[8]), (None, texts[8]), (8, texts[8]), (9, texts[10])]
    check(spark, rows)


def test_unlike_texts_under_one_id(spark):
    rng = random.Random(11)
    texts = [" ".join(fixture.words(rng, 40)) for _ in range(6)]
    shared = " ".join(fixture.words(rng, 15))
    rows = [(1, texts[0] + shared + texts[1]), (9, texts[2] + shared), (9, texts[3]), (9, texts[3][:40] + shared + texts[4]),
            (None, texts[2] + "x" + shared), (None, texts[5]), (None, texts[5] + shared)]
    check(spark, rows + passages_under(rng, 60))


def passages_under(rng, n):
    return [(rng.choice([20, 21, 22, None]), text) for text in passages(n, 12)]


def test_overlapping_passages_in_small_shards(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 300)
    ids = list(range(120))
    random.Random(1).shuffle(ids)
    check(spark, list(zip(ids, passages(120, 7))))


def test_very_frequent_seeds_are_grouped_by_spark(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "LARGE_SEED", 2)
    check(spark, list(enumerate(passages(60, 8))))


def test_no_documents(spark):
    assert suffixes.digests(fixture.no_documents(spark)).count() == 0


def test_kept_text_and_rows(spark):
    rng = random.Random(3)
    passage = " ".join(fixture.words(rng, 20)) + "é"
    docs = fixture.documents(spark, ["start " + passage + "é end", "other " + passage + "ü more"])
    rows = fixture.collected(suffixes.remove_repeats(docs, keep_rows=True))
    assert rows[0][0].kept_text == "start " + passage + "é end" and rows[0][0].row.size == "x"
    # The first byte of the second é is shared with ü; what is left of ü is no character.
    assert rows[1][0].kept_text == "other more" or rows[1][0].kept_text == "othermore"
    assert [tuple(s) for s in rows[1][0].spans] == [(5, 5 + len((" " + passage).encode()) + 1)]


@pytest.mark.parametrize("seed", range(6))
def test_merged_intervals_group_equal_strings(seed):
    rng = np.random.default_rng(seed)
    size = suffixes.LENGTH
    source = rng.integers(0, 3, 400).astype(np.uint8)
    starts, sizes = rng.integers(0, 200, 12), rng.integers(size, 150, 12)
    strings = [source[a:a + n] for a, n in zip(starts, sizes)]
    docs = rng.integers(0, 5, 12)
    got = suffixes.smallest_documents(np.concatenate(strings), sizes, docs)
    first: dict = {}
    for s, d in zip(strings, docs):
        for i in range(len(s) - size + 1):
            key = s[i:i + size].tobytes()
            first[key] = min(int(d), first.get(key, 99))
    want = [first[s[i:i + size].tobytes()] for s in strings for i in range(len(s) - size + 1)]
    assert got.tolist() == want


def test_one_string_per_shard_gives_the_same(monkeypatch):
    rng = np.random.default_rng(9)
    source = rng.integers(0, 2, 300).astype(np.uint8)
    sizes = rng.integers(60, 120, 8)
    strings = np.concatenate([source[a:a + n] for a, n in zip(rng.integers(0, 180, 8), sizes)])
    docs = np.arange(8)
    whole = suffixes.smallest_documents(strings, sizes, docs)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 1)
    assert (suffixes.smallest_documents(strings, sizes, docs) == whole).all()


def test_slices_fit_a_cache_and_change_nothing():
    """Texts of a megabyte together are scanned in several slices, with the blocks and hashes of one."""
    rng = np.random.default_rng(3)
    data = rng.integers(97, 123, 1_000_000).astype(np.uint8)
    offsets = np.arange(0, 1_000_001, 1_000)
    whole, names = suffixes.find_blocks(data, offsets), suffixes.text_hashes(data, offsets)
    parts, part_names = [], []
    for start, stop in suffixes.byte_slices(offsets):
        part, bounds = data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start]
        assert len(part) * 8 <= 4 << 20
        parts.append(suffixes.find_blocks(part, bounds))
        part_names += suffixes.text_hashes(part, bounds)
    assert part_names == names
    for field in ("seed", "code", "first", "last", "at"):
        assert np.array_equal(np.concatenate([getattr(p, field) for p in parts]), getattr(whole, field))
