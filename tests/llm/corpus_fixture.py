"""Small documents with everything awkward, and plain versions of what operators compute."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it".split()


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def awkward_texts(seed: int = 1) -> list[str | None]:
    """Null, empty and wordless texts, copies, near copies, shared passages, one very long text."""
    rng = random.Random(seed)
    base = words(rng, 120)
    passage = " ".join(words(rng, 30))
    out: list[str | None] = [None, "", " \t\n", "a", "one two", "one two", "One TWO"]
    out += [" ".join(base), " ".join(base), " ".join(base[:-2]), " ".join(base[3:]), "\n".join(base).upper()]
    for i in range(8):
        out.append(" ".join(words(rng, rng.randint(5, 60)) + [passage] + words(rng, rng.randint(0, 60))))
    for i in range(6):
        copy = list(base)
        copy[rng.randrange(len(copy))] = "changed"
        out.append(" ".join(copy))
    out += ["é" * 70 + "中文字" * 30 + "\U0001F600" * 20, "中文字" * 30, "x\x00y " * 40, "aaaa" * 100, "aaaa" * 99]
    out.append(" ".join(words(rng, 20_000)))
    out.append(" ".join(words(rng, 300) + [passage]))
    return out


#: Names that operators use themselves, as extra columns of the input.
EXTRA = ("key", "row", "size", "class", "seed", "doc", "label", "score", "rank", "place", "cell", "n", "taken", "ids")


def documents(spark, texts, ids=None, sources=None, langs=None):
    """A documents table with extra columns whose names clash with internal ones."""
    ids = list(range(len(texts))) if ids is None else ids
    sources = [f"s{i % 4}" for i in range(len(texts))] if sources is None else sources
    langs = ["en"] * len(texts) if langs is None else langs
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{name} string" for name in EXTRA)
    rows = [(i, t, g, s, len(t or ""), *["x"] * len(EXTRA)) for i, t, g, s in zip(ids, texts, langs, sources)]
    return spark.createDataFrame(rows, schema)


def no_documents(spark):
    return documents(spark, [])


def collected(df, key="doc_id"):
    """Rows by key; a key may repeat."""
    out: dict = {}
    for row in df.collect():
        out.setdefault(row[key], []).append(row)
    return out
