"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is the product of its
letters' vectors, each rotated by its place; a text is the sum of its trigrams'
vectors, and a language the sum of its texts. A text gets the language whose
profile has the largest cosine with its own vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import split_number, text_slices

DIMENSIONS = 1024
LETTERS = 512  # symbols 1..383 stand for themselves, others share 384..511
UNKNOWN = "und"
FLUSH_ROWS = 500_000
CHUNK = 8192  # trigrams whose vectors are held at once
TEXTS = 256  # texts whose vectors are held at once


def symbols(text: str) -> np.ndarray:
    """Symbol per code point, 0 for a run of anything but letters, 0 at both ends."""
    lower = text.lower()
    codes = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(codes < 384, _LATIN[np.minimum(codes, 383)], 0).astype(np.int32)
    rest = np.flatnonzero(codes >= 384)
    if len(rest):
        found, inverse = np.unique(codes[rest], return_inverse=True)
        shared = (found.astype(np.uint64) * np.uint64(2654435761) >> np.uint64(7)) % np.uint64(128)
        letter = np.array([chr(c).isalpha() for c in found])
        out[rest] = np.where(letter, shared.astype(np.int32) + 384, 0)[inverse]
    out = np.concatenate([[0], out, [0]]).astype(np.int32)
    return out[np.concatenate([[True], (out[1:] > 0) | (out[:-1] > 0)])]


_LATIN = np.array([c if chr(c).isalpha() else 0 for c in range(384)], np.int32)


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of a text (27-bit codes) and how often each occurs."""
    s = symbols(text or "")
    if len(s) < 3 or not s.any():
        return np.empty(0, np.int32), np.empty(0, np.int64)
    return np.unique((s[:-2] << 18) | (s[1:-1] << 9) | s[2:], return_counts=True)


def letter_vectors(dimensions: int, seed: int) -> np.ndarray:
    """One row of +1 and -1 per symbol."""
    return (np.random.default_rng(seed).integers(0, 2, (LETTERS, dimensions), np.int8) * 2 - 1).astype(np.int8)


def trigram_vectors(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Bind the rotated letters of each trigram."""
    first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
    return first[codes >> 18] * second[(codes >> 9) & 511] * letters[codes & 511]


def count_trigrams(docs: DataFrame, text: str, label: str) -> DataFrame:
    """(label, code, n) summed over all texts with a label."""

    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        for language, parts in held.items():
            codes = np.concatenate([c for c, _ in parts])
            found, inverse = np.unique(codes, return_inverse=True)
            n = np.bincount(inverse, np.concatenate([n for _, n in parts])).astype(np.int64)
            yield pa.record_batch([pa.array([language] * len(found)), pa.array(found, pa.int32()), pa.array(n)],
                                  names=["label", "code", "n"])
        held.clear()

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        rows = 0
        for batch in batches:
            for language, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes, n = trigrams(content)
                if len(codes):
                    held.setdefault(language, []).append((codes, n))
                    rows += len(codes)
                if rows > FLUSH_ROWS:
                    yield from flush(held)
                    rows = 0
        yield from flush(held)

    labelled = docs.filter(F.col(label).isNotNull() & F.col(text).isNotNull()).select(label, text)
    counted = labelled.mapInArrow(run, "label string, code int, n long")
    return counted.groupBy("label", "code").agg(F.sum("n").alias("n"))


def profile_cells(counts: DataFrame, dimensions: int, seed: int) -> DataFrame:
    """(label, place, value): each label's bundled vector, summed map-side per task."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        letters = letter_vectors(dimensions, seed)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist(), object)
            codes, n = batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(np.float64)
            for language in sorted(set(labels.tolist())):
                rows = np.flatnonzero(labels == language)
                for start in range(0, len(rows), CHUNK):
                    part = rows[start:start + CHUNK]
                    sums[language] = sums.get(language, 0) + n[part] @ trigram_vectors(codes[part], letters)
        for language, total in sums.items():
            yield pa.record_batch(
                [pa.array([language] * dimensions), pa.array(np.arange(dimensions), pa.int32()), pa.array(total)],
                names=["label", "place", "value"])

    parts = counts.mapInArrow(run, "label string, place int, value double")
    return parts.groupBy("label", "place").agg(F.sum("value").alias("value"))


def train(docs: DataFrame, *, text: str = "text", label: str = "lang", dimensions: int = DIMENSIONS,
          seed: int = 8) -> tuple[list[str], np.ndarray]:
    """Languages in code-point order and their profiles of length one.

    Learns from all rows with a text and a label. The sums are whole numbers, so
    no order of adding changes them. One vector per language is read to the
    driver; languages are a closed list, so their size is bounded.
    """
    used = docs.select(F.col(text).alias("text"), F.col(label).cast("string").alias("label"))
    cells = profile_cells(count_trigrams(used, "text", "label"), dimensions, seed)
    rows = cells.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("cells"))
    found = sorted((row["label"], [cell["value"] for cell in row["cells"]]) for row in rows.toLocalIterator())
    matrix = np.array([v for _, v in found], np.float64).reshape(len(found), dimensions)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return [name for name, _ in found], matrix / np.where(norms > 0, norms, 1.0)


def text_vectors(contents: list[tuple[np.ndarray, np.ndarray]], letters: np.ndarray) -> np.ndarray:
    """Bundled vector per text, from its trigrams and their numbers."""
    sizes = np.array([len(codes) for codes, _ in contents])
    rows = np.repeat(np.arange(len(contents)), sizes)
    codes, place = np.unique(np.concatenate([c for c, _ in contents]), return_inverse=True)
    n = np.concatenate([n for _, n in contents])
    # float32 adds whole numbers exactly below 2^24.
    kind = np.float32 if max(int(x.sum()) for _, x in contents) < 1 << 24 else np.float64
    out = np.zeros((len(contents), letters.shape[1]), np.float64)
    for start in range(0, len(codes), CHUNK):
        own = (place >= start) & (place < start + CHUNK)
        counts = np.zeros((len(contents), min(CHUNK, len(codes) - start)), kind)
        counts[rows[own], place[own] - start] = n[own]
        out += counts @ trigram_vectors(codes[start:start + CHUNK], letters).astype(kind)
    return out


def predict(docs: DataFrame, languages: list[str], matrix: np.ndarray, *, key: str = "doc_id", text: str = "text",
            seed: int = 8, keep_rows: bool = False) -> DataFrame:
    """(key, lang_pred, score) for every whole text, with ``keep_rows`` also ``row``, the input row.

    ``score`` is the cosine with the predicted language's profile, not below 0.
    A null text, one without a letter, or any text while no language was
    learned gets ``und`` and 0. Equal cosines go to the first language in
    code-point order. Null keys stay null, repeated rows give repeated rows,
    other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast((languages, matrix))

    def run(batches) -> Iterator[pa.RecordBatch]:
        names, known = model.value
        letters = letter_vectors(known.shape[1], seed)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, last in text_slices(texts):
                for start in range(first, last, TEXTS):
                    stop = min(start + TEXTS, last)
                    contents = [trigrams(t) for t in texts[start:stop]]
                    label, score = [UNKNOWN] * len(contents), np.zeros(len(contents))
                    if names and any(len(c) for c, _ in contents):
                        vectors = text_vectors(contents, letters)
                        norms = np.linalg.norm(vectors, axis=1)
                        cosines = (vectors / np.where(norms > 0, norms, 1.0)[:, None]) @ known.T
                        best = cosines.argmax(axis=1)
                        for i, (codes, _) in enumerate(contents):
                            if len(codes):
                                label[i], score[i] = names[best[i]], min(1.0, max(0.0, cosines[i, best[i]]))
                    yield pa.record_batch(
                        [*[c.slice(start, stop - start) for c in (batch.column(0), *batch.columns[2:])],
                         pa.array(label, pa.string()), pa.array(score)], names=schema.names)

    whole = [F.struct("*").alias("row")] if keep_rows else []
    used = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *whole)
    schema = used.drop("text").schema.add("lang_pred", "string").add("score", "double")
    return used.mapInArrow(run, schema).withColumnRenamed("key", key)


def identify(docs: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "lang", folds: int = 4,
             held_out: int = 2) -> DataFrame:
    """(key, held_out, lang_pred, score): learn outside one fold of keys, predict every row."""
    fold = split_number(key, folds)
    languages, matrix = train(docs.filter(fold != held_out), text=text, label=label)
    return predict(docs, languages, matrix, key=key, text=text).select(
        key, (fold == held_out).alias("held_out"), "lang_pred", "score")
