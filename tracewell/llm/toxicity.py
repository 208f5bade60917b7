"""Toxicity by a lexicon of words and word pairs, smoothed as by Kneser-Ney.

This is not the full comparison of two n-gram models: there is no chain of
contexts, and nothing counts for the ordinary class (the README has the figures).
Toxic and ordinary texts each have a model of expressions (words and pairs of
neighbouring words), whose contexts are the texts they occur in. A model takes
DISCOUNT off the number of its texts that hold an expression and gives the mass so freed to continuation
counts that both classes share: the number of all texts that hold it. An
expression too rare to tell the classes apart then says next to nothing. Even in
a toxic text most words are ordinary, so its words are taken to be drawn from the
ordinary model, but with probability SHARE from what the toxic model has beyond
EXCESS times the ordinary one: a difference in subject or language alone stays
below that and counts for nothing. A text's score grows with the difference of
its two log-likelihoods per word. A word counts by itself or by the pair it ends,
whichever tells more.

All expressions of a model count, those of a single text too where their ratio
allows it. Those of the most texts are broadcast; the others, however many, are
joined to the texts that hold them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm import jaccard
from tracewell.llm.common import WORD, mix64, release, split_number, text_slices
from tracewell.session import cut_lineage, discard

DISCOUNT = 1.5  # texts: what a single text holds says nothing
SHARE = 0.1
EXCESS = 3.0
FREQUENT = 1 << 22  # expressions that are broadcast at most; all others are joined
STEPS = 8  # per doubling of texts, when those are chosen
UNIT = float(1 << 32)  # differences are whole numbers of 1 / UNIT, whose sums no order of adding changes
FLUSH_ROWS = 2_000_000
CACHE_WORDS = 500_000
THRESHOLD = 0.7
CELLS = 20_000  # of the calibration histogram
REACH = 4.0  # it spans differences from 0 to REACH nats per word
FALSE_ALARM = 4.0  # weight of an ordinary text above the threshold against a toxic one below


def word_codes(words: list[str]) -> np.ndarray:
    """64-bit hash per word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    place = (np.arange(len(chars)) - np.repeat(starts, lengths)).astype(np.uint64)
    sums = np.add.reduceat(mix64(chars * np.uint64(0x9E3779B97F4A7C15) + place), starts) if len(words) else chars
    return mix64(sums + lengths.astype(np.uint64)).view(np.int64)


class Codes:
    """Codes of the words of texts and of the pairs of neighbouring words."""

    def __init__(self):
        self.find, self.known = re.compile(WORD).findall, {}

    def expressions(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(words per text, text, code, last): ``last`` is the code of the last word of a pair, 0 for a word.

        Codes of pairs are odd, those of words even.
        """
        split = [self.find(t.lower()) if t else [] for t in texts]
        words = [w for ws in split for w in ws]
        missing = list(set(words) - self.known.keys())
        if len(self.known) + len(missing) > CACHE_WORDS:
            self.known.clear()
            missing = list(set(words))
        self.known.update(zip(missing, word_codes(missing).tolist()))
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        text = np.repeat(np.arange(len(split)), sizes)
        code = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)) & -2
        first = np.flatnonzero(text[:-1] == text[1:])
        second = code[first + 1]
        pairs = mix64(mix64(code[first].view(np.uint64)) + second.view(np.uint64)).view(np.int64) | 1
        return (sizes, np.concatenate([text, text[first]]), np.concatenate([code, pairs]),
                np.concatenate([np.zeros(len(code), np.int64), second]))


def count_expressions(texts: DataFrame, whole: bool = True) -> DataFrame:
    """(code, pair, last, toxic, ordinary, freed_toxic, freed_ordinary) from rows of (label, text).

    The texts of each class that hold an expression, and what the discount frees
    of them. Unless ``whole``, expressions of no more toxic texts than the discount
    are summed up in a row without a code for words, and one for pairs, and ``last``
    is null for what no toxic text holds: enough where ``rare_tell`` does not hold.
    """

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if held:
            code, last, toxic = (np.concatenate(x) for x in zip(*held))
            found, at, place = np.unique(code, return_index=True, return_inverse=True)
            n = [np.bincount(place[toxic == c], minlength=len(found)).astype(np.int64) for c in (True, False)]
            lasts = pa.array(last[at], mask=None if whole else n[0] == 0)
            yield pa.record_batch([pa.array(found), lasts, *map(pa.array, n)],
                                  names=["code", "last", "toxic", "ordinary"])
        held.clear()

    def run(batches) -> Iterator[pa.RecordBatch]:
        codes, held, rows = Codes(), [], 0
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist()) == 1
            contents = batch.column(1).to_pylist()
            for start, stop in text_slices(contents):
                _, text, code, last = codes.expressions(contents[start:stop])
                order = np.lexsort((code, text))
                text, code, last = text[order], code[order], last[order]
                once = np.ones(len(code), bool)
                once[1:] = (text[1:] != text[:-1]) | (code[1:] != code[:-1])
                held.append((code[once], last[once], labels[start:stop][text[once]]))
                rows += len(held[-1][0])
                if rows > FLUSH_ROWS:
                    yield from flush(held)
                    rows = 0
        yield from flush(held)

    counted = texts.select("label", "text").mapInArrow(run, "code long, last long, toxic long, ordinary long")
    counts = counted.groupBy("code").agg(
        F.max("last").alias("last"), F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    pair, n = F.col("code").bitwiseAND(F.lit(1)) != 0, ("toxic", "ordinary")
    freed = {f"freed_{c}": F.least(F.col(c).cast("double"), F.lit(DISCOUNT)) for c in n}
    if whole:
        return counts.select("code", pair.alias("pair"), "last", *n, *[v.alias(c) for c, v in freed.items()])
    return counts.groupBy(F.when(F.col("toxic") > DISCOUNT, F.col("code")).alias("code"), pair.alias("pair")).agg(
        F.max("last").alias("last"), *[F.sum(c).alias(c) for c in n], *[F.sum(v).alias(c) for c, v in freed.items()])


def rare_tell(counts: DataFrame) -> bool:
    """Whether expressions of no more toxic texts than the discount can have a value.

    All they have in the toxic model is their share of the mass it freed, so their
    ratio is at most that of the shares of mass which the two models freed.
    """
    sums = counts.groupBy("pair").agg(
        *[F.try_divide(F.sum(f"freed_{c}"), F.sum(c).cast("double")).alias(c) for c in ("toxic", "ordinary")])
    shares = [(row["toxic"], row["ordinary"]) for row in sums.collect()]
    return any(t is not None and o is not None and t > EXCESS * o for t, o in shares)


def expression_table(counts: DataFrame) -> DataFrame | None:
    """(code, n, value): log-likelihood difference of every expression that has one, and the texts that hold it.

    None without texts of both classes. Any other expression has a difference of
    0. That of a pair is what it has beyond its last word.
    """
    n = {c: F.col(c).cast("double") for c in ("toxic", "ordinary")}
    sums = {row["pair"]: row for row in counts.groupBy("pair").agg(
        *[F.sum(v).alias(c) for c, v in n.items()],
        *[F.sum(f"freed_{c}").alias(f"freed_{c}") for c in n]).collect()}

    def told(kind: bool) -> DataFrame | None:
        own = sums.get(kind)
        if own is None or not own["toxic"] or not own["ordinary"]:
            return None
        shared = (n["toxic"] + n["ordinary"]) / (own["toxic"] + own["ordinary"])
        p = {c: (F.greatest(v - DISCOUNT, F.lit(0.0)) + own["freed_" + c] * shared) / own[c] for c, v in n.items()}
        rows = counts.filter((F.col("pair") == F.lit(kind)) & F.col("code").isNotNull()).select(
            "code", "last", (n["toxic"] + n["ordinary"]).alias("n"), (p["toxic"] / p["ordinary"]).alias("ratio"))
        value = F.log1p(SHARE / (1 - SHARE) * (F.col("ratio") - EXCESS))
        return rows.filter(F.col("ratio") > EXCESS).select("code", "last", "n", (F.round(value * UNIT) / UNIT).alias("value"))

    words, pairs = told(False), told(True)
    if words is None:
        return None
    words = words.select("code", "n", "value")
    if pairs is None:
        return words
    own = words.select(F.col("code").alias("last"), F.col("value").alias("word_value"))
    beyond = pairs.join(own, "last", "left").withColumn("value", F.col("value") - F.coalesce("word_value", F.lit(0.0)))
    return words.unionByName(beyond.filter("value > 0").select("code", "n", "value"))


def divided(table: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray], DataFrame | None]:
    """(codes ascending, values) of up to FREQUENT expressions of the most texts, and a table of all others."""
    step = F.floor(F.log2("n") * STEPS)
    left, least = FREQUENT, None
    for row in table.groupBy(step.alias("step")).count().orderBy(F.desc("step")).toLocalIterator():
        left -= row["count"]
        if left < 0:
            least = row["step"]
            break
    rest = None if least is None else table.filter(step <= least).select("code", "value")
    told = table if least is None else table.filter(step > least)
    told = told.select("code", "value").toArrow()
    codes, values = told.column("code").to_numpy(), told.column("value").to_numpy()
    order = np.argsort(codes)
    return (codes[order], values[order]), rest


def look_up(wanted: np.ndarray, codes: np.ndarray, values: np.ndarray,
            bloom: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(values of codes, 0 if not among ``codes``; places of those that may be in the table of the others)."""
    found, out = np.zeros(len(wanted), bool), np.zeros(len(wanted))
    if len(codes):
        at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
        found = codes[at] == wanted
        out = np.where(found, values[at], 0.0)
    others = np.empty(0, np.int64) if bloom is None else np.flatnonzero(~found & jaccard.may_hold(bloom, wanted))
    return out, others


def differences(docs: DataFrame, table: DataFrame | None, *, key: str, text: str) -> DataFrame:
    """(key, words, difference): mean log-likelihood difference per word; 0 without words.

    A text's frequent expressions are looked up in a broadcast. Of the others it
    gives (code, n) rows, if a Bloom filter of fixed size lets them through,
    which are joined to the table by code and added up by text.
    """
    frequent, rest = (np.empty(0, np.int64), np.empty(0)), None
    if table is not None:
        frequent, rest = divided(table)
    bloom = None if rest is None else jaccard.bloom_filter(rest.select(F.col("code").alias("class")))
    shared = docs.sparkSession.sparkContext.broadcast((*frequent, bloom))

    def run(batches) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, stop in text_slices(texts):
                sizes, text_, code, _ = codes.expressions(texts[start:stop])
                value, others = look_up(code, *shared.value)
                sums = np.bincount(text_, value, len(sizes)).astype(float)
                others = others[np.lexsort((code[others], text_[others]))]
                new = np.flatnonzero((np.diff(text_[others], prepend=-1) != 0) | (np.diff(code[others], prepend=0) != 0))
                ns = np.diff(np.append(new, len(others)))
                ends = np.searchsorted(text_[others[new]], np.arange(len(sizes) + 1)).astype(np.int32)
                yield pa.record_batch(
                    [batch.column(0).slice(start, stop - start), pa.array(sizes), pa.array(sums),
                     batch.column(2).slice(start, stop - start),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(code[others[new]])),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(ns.astype(np.int64)))],
                    names=["key", "words", "sum", "row", "codes", "ns"])

    kind = docs.schema[key].dataType.simpleString()
    told = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    told = told.mapInArrow(
        run, f"key {kind}, words long, sum double, row long, codes array<long>, ns array<long>")
    total = F.col("sum")
    if rest is not None:
        told = cut_lineage(told)  # the numbers of rows are read twice
        each = told.select("row", F.explode(F.arrays_zip("codes", "ns")).alias("one"))
        more = (each.select("row", F.col("one.codes").alias("code"), F.col("one.ns").alias("n")).join(rest, "code")
                .groupBy("row").agg(F.sum(F.col("n") * F.col("value")).alias("more")))
        told = told.join(more, "row", "left")
        total = total + F.coalesce("more", F.lit(0.0))
    return told.select("key", "words", (total / F.greatest("words", F.lit(1))).alias("difference"))


def cut_point(cells: list[tuple[int, int, int]]) -> tuple[float, float]:
    """(threshold, half distance) that separates best, from (cell, toxic, ordinary) counts.

    The threshold maximises the share of toxic texts at or above it less
    FALSE_ALARM times that of ordinary ones, in the middle of all cells that do.
    """
    toxic, ordinary = np.zeros(CELLS), np.zeros(CELLS)  # cell n: above n - 1 to n of REACH / CELLS each
    for cell, t, o in cells:
        toxic[cell], ordinary[cell] = t, o
    if not toxic.sum() or not ordinary.sum():
        return REACH, 1.0
    above = np.concatenate([np.cumsum(toxic[::-1])[::-1], [0]]) / toxic.sum()
    below = np.concatenate([[0], np.cumsum(ordinary)]) / ordinary.sum()
    gain = above + FALSE_ALARM * below
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    # A difference of 0 is in cell 0, so the threshold is above it.
    width = REACH / CELLS
    means = (toxic @ np.arange(CELLS)) * width / toxic.sum(), (ordinary @ np.arange(CELLS)) * width / ordinary.sum()
    return max((best[0] + best[-1]) / 2 - 0.5, 0.5) * width, max((means[0] - means[1]) / 2, 1e-6)


def classify(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
             folds: int = 3, held_out: int = 1) -> DataFrame:
    """(key, held_out, words, difference, score, predicted) for every whole text.

    Learns from all labels outside one fold of keys: three quarters of them
    count words, the rest set the threshold. ``score`` is a logistic function
    of the difference that is THRESHOLD there, ``predicted`` 1 from it on. Null
    and empty texts have a difference of 0; null keys have no label; of
    contradicting labels the largest counts; rows that repeat a key are scored
    one by one. Without labels of both classes nothing is predicted toxic.
    Other columns are not read.
    """
    known = (labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col(key).alias("key")).agg(F.max(F.col(label).cast("int")).alias("label")))
    known = known.filter(split_number("key", folds) != held_out)
    part = split_number("key", 4 * folds)
    sample = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    counting = part >= folds  # with the fold left out, three quarters of the rest
    # Labels grow with the corpus, so they are shuffled and never broadcast.
    trained = sample.filter(counting & (split_number("key", folds) != held_out)).join(
        known.filter(counting).hint("merge"), "key")
    counts = cut_lineage(count_expressions(trained, whole=False))
    if rare_tell(counts):
        discard(counts)
        counts = cut_lineage(count_expressions(trained))
    table = expression_table(counts)
    table = None if table is None else cut_lineage(table)
    discard(counts)
    release(docs.sparkSession)
    scored = cut_lineage(differences(docs, table, key=key, text=text))
    cell = F.least(F.greatest(F.ceil(F.col("difference") * CELLS / REACH), F.lit(0)), F.lit(CELLS - 1))
    cells = (scored.filter("words > 0").join(known.filter(~counting), "key").groupBy(cell.cast("int").alias("cell"))
             .agg(F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") != 1).alias("ordinary")))
    threshold, half = cut_point([tuple(row) for row in cells.collect()])
    steepness = 4 / half
    shift = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    score = 1 / (1 + F.exp(-((F.col("difference") - threshold) * steepness + shift)))
    return (scored.withColumn("score", F.when(F.col("difference") >= threshold, F.greatest(score, F.lit(THRESHOLD)))
                              .otherwise(F.least(score, F.lit(THRESHOLD - 1e-9))))
            .select(F.col("key").alias(key), (split_number("key", folds) == held_out).alias("held_out"), "words",
                    "difference", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
