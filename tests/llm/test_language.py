import random
import zlib

import numpy as np

import corpus_fixture as fixture
from tracewell.llm import language

ALPHABETS = {"aa": "abcde ", "bb": "fghij ", "cc": "éèàü ", "dd": "中文字母表 "}


def labelled(n=200, seed=2):
    rng = random.Random(seed)
    langs = [rng.choice(list(ALPHABETS)) for _ in range(n)]
    return ["".join(rng.choice(ALPHABETS[g]) for _ in range(rng.randint(20, 80))) for g in langs], langs


def test_held_out_accuracy_and_split(spark):
    texts, langs = labelled()
    rows = fixture.collected(language.identify(fixture.documents(spark, texts, langs=langs)))
    held = [i for i in rows if rows[i][0].held_out]
    assert held == [i for i in rows if zlib.crc32(str(i).encode()) % 4 == 2] and held
    assert all(rows[i][0].lang_pred == langs[i] for i in held)
    assert all(0 <= r[0].score <= 1.0000001 for r in rows.values())


def test_awkward_rows(spark):
    texts, langs = labelled(60)
    texts += [None, "", "123 !?", "abc", "abc", "abcde " * 50_000, "ABC"]
    langs += [None, "aa", None, None, None, None, None]
    ids = [*range(len(texts) - 1), None]
    rows = fixture.collected(language.identify(fixture.documents(spark, texts, ids=ids, langs=langs)))
    assert [rows[i][0].lang_pred for i in (60, 61, 62)] == ["und"] * 3
    assert [rows[i][0].score for i in (60, 61, 62)] == [0.0] * 3
    assert {rows[i][0].lang_pred for i in (63, 64, 65, None)} == {"aa"}
    assert rows[63][0].score == rows[64][0].score


def test_nothing_to_learn_from(spark):
    assert language.identify(fixture.no_documents(spark)).count() == 0
    rows = language.identify(fixture.documents(spark, ["abc", None], langs=[None, None])).collect()
    assert {r.lang_pred for r in rows} == {"und"}


def test_text_vectors_are_the_sum_of_bound_letters(monkeypatch):
    monkeypatch.setattr(language, "CHUNK", 3)
    letters = language.letter_vectors(64, 1)
    text = "Ab ba"
    s = [0, ord("a"), ord("b"), 0, ord("b"), ord("a"), 0]
    want = sum((np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]).astype(int)
               for a, b, c in zip(s, s[1:], s[2:]))
    got = language.text_vectors([language.trigrams(text), language.trigrams("q")], letters)
    assert (got[0] == want).all()
