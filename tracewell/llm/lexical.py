"""Ranked lexical search over norm buckets of impact vectors.

A document's impact vector has, for each term of the queries, what the term adds
to a score per unit of its weight. Documents are ordered by the length of these
vectors and cut into buckets. The longest give each query a first bound on its
kth score. A bucket whose longest vector cannot reach the bound by the
Cauchy-Schwarz inequality is left out for that query; inside the others, the
exact part of a query's heaviest coordinates plus the same inequality for the
rest bounds each document. What survives is scored exactly, in integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewell.llm.common import map_batches
from tracewell.session import cut_lineage, discard

# Everything in ASCII but letters and digits separates terms; only A-Z are lower-cased.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))
BLOCK_TERMS = 200_000  # terms of the queries that are answered together, about
FIRST_ROWS = 8_000  # documents that give the first bounds, about
BUCKET_ROWS = 4_096
FOCUS = 8  # coordinates of a query that are taken exactly in its bounds
SLACK = 1 + 1e-9  # bounds are in doubles
NO_ID = (1 << 63) - 1


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


@dataclass(frozen=True)
class Queries:
    """A block of queries: terms by number, and per query the numbers of its terms, ascending."""

    ids: list
    terms: dict[bytes, int]
    parts: list[np.ndarray]


def _exploded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    items, terms = [], []
    for i, text in enumerate(batch.column(1).cast(pa.binary())):
        own = sorted(set(terms_of(text.as_py() or b"")))
        items += [i] * len(own)
        terms += own
    yield pa.record_batch([batch.column(0).take(pa.array(items, pa.int64())), pa.array(terms, pa.binary())], names=["item", "term"])


def query_blocks(items: DataFrame, key: str, text: str) -> Iterator[Queries]:
    """The queries, of which about BLOCK_TERMS terms are held at a time."""
    kind = items.schema[key].dataType.simpleString()
    rows = cut_lineage(map_batches(items.select(F.col(key).alias("item"), F.col(text).alias("text")),
                                   f"item {kind}, term binary", _exploded).distinct())
    blocks = max(1, -(-rows.count() // BLOCK_TERMS))
    for block in range(blocks):
        found: dict = {}
        for item, term in rows.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect():
            found.setdefault(item, []).append(bytes(term))
        terms = {t: i for i, t in enumerate(sorted({t for own in found.values() for t in own}))}
        if terms:
            yield Queries(list(found), terms, [np.sort([terms[t] for t in own]) for own in found.values()])
    discard(rows)


def occurrences(docs: DataFrame, terms: dict[bytes, int], key: str, text: str) -> DataFrame:
    """(doc, n, terms, counts) of documents with a term: how often it has which of ``terms``."""
    held = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        number = held.value.get
        sizes, which, often = [], [], []
        for text in batch.column(1).cast(pa.binary()):
            own = terms_of(text.as_py() or b"")
            counts = Counter(map(number, own))
            counts.pop(None, None)
            at = np.fromiter(counts, np.int32, len(counts))
            order = np.argsort(at)
            sizes.append(len(own))
            which.append(at[order].tobytes())
            often.append(np.fromiter(counts.values(), np.int32, len(counts))[order].tobytes())
        rows = pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(which, pa.binary()), pa.array(often, pa.binary())],
                               names=["doc", "n", "terms", "counts"])
        yield rows.filter(pa.array(np.array(sizes) > 0))

    ids = F.coalesce(F.col(key).cast("long"), F.lit(NO_ID))
    return map_batches(docs.select(ids.alias("doc"), F.col(text).alias("text")), "doc long, n long, terms binary, counts binary", run)


def _arrays(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Values and row bounds of a column of packed arrays."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pa.compute.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.frombuffer(b"".join(x.as_py() for x in column), kind)
    return flat, np.concatenate([[0], np.cumsum(sizes // np.dtype(kind).itemsize)])


def document_counts(found: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents hold each term."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(_arrays(batch.column(0), np.int32)[0], minlength=n_terms)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held), pa.array(total[held])], names=["term", "n"])

    out = np.zeros(n_terms, np.int64)
    for term, n in found.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect():
        out[term] = n
    return out


def impacts(found: DataFrame, weights: np.ndarray, n_docs: int, all_terms: int) -> DataFrame:
    """(doc, norm, terms, impacts) of documents that hold a term of the queries."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        batch = batch.filter(pa.compute.greater(pa.compute.binary_length(batch.column(2)), 0))
        n = batch.column(1).to_numpy()
        size = 100 - 90 + (90 * n * n_docs) // all_terms
        term, bounds = _arrays(batch.column(2), np.int32)
        count = _arrays(batch.column(3), np.int32)[0].astype(np.int64)
        impact = (1_000_000_000 * count) // (1000 * count + 8 * np.repeat(size, np.diff(bounds)))
        square = weights[term] * impact.astype(np.float64) ** 2
        norm = np.sqrt(np.add.reduceat(square, bounds[:-1])) if len(n) else np.zeros(0)
        packed = impact.astype(np.int32)
        yield pa.record_batch(
            [batch.column(0), pa.array(norm, pa.float64()), batch.column(2),
             pa.array([packed[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())],
            names=["doc", "norm", "terms", "impacts"])

    return map_batches(found, "doc long, norm double, terms binary, impacts binary", run)


class Bucket:
    """Documents of similar length, with postings per term."""

    def __init__(self, table: pa.Table, root: np.ndarray):
        self.docs = table.column("doc").to_numpy()
        self.norm = table.column("norm").to_numpy()
        term, bounds = _arrays(table.column("terms"), np.int32)
        impact = _arrays(table.column("impacts"), np.int32)[0]
        row = np.repeat(np.arange(len(self.docs)), np.diff(bounds))
        order = np.argsort(term, kind="stable")
        self.starts = np.searchsorted(term[order], np.arange(len(root) + 1))
        self.row, self.impact, self.root = row[order], impact[order].astype(np.int64), root

    def posting(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        where = slice(self.starts[term], self.starts[term + 1])
        return self.row[where], self.impact[where]

    def survivors(self, focus: np.ndarray, rest: float, bound: float) -> np.ndarray:
        """Rows that can reach ``bound``: exact in ``focus``, by their lengths in the rest."""
        exact, square = np.zeros(len(self.docs)), np.zeros(len(self.docs))
        for term in focus:
            row, impact = self.posting(term)
            part = self.root[term] * impact
            exact[row] += self.root[term] * part
            square[row] += part * part
        left = np.sqrt(np.maximum(self.norm * self.norm * SLACK - square, 0.0))
        return np.flatnonzero((exact + rest * left) * SLACK + 1.0 >= bound)

    def scores(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact score of every row for a query."""
        out = np.zeros(len(self.docs), np.int64)
        for term in terms:
            row, impact = self.posting(term)
            out[row] += weights[term] * impact
        return out


def best(impact: DataFrame, queries: Queries, weights: np.ndarray, least: np.ndarray, k: int) -> DataFrame:
    """(query, doc, score): the first ``k`` of each query in each task, with scores of at least ``least``."""
    held = impact.sparkSession.sparkContext.broadcast((queries.parts, weights, least))

    def run(batches) -> Iterator[pa.RecordBatch]:
        parts, weights, least = held.value
        root = np.sqrt(weights.astype(np.float64))
        by_weight = [own[np.argsort(-weights[own], kind="stable")] for own in parts]
        focus = [own[:FOCUS] for own in by_weight]
        rest = np.array([math.sqrt(weights[own[FOCUS:]].sum()) for own in by_weight])
        whole = np.array([math.sqrt(weights[own].sum()) for own in by_weight])
        bound = np.maximum(least, 1)
        top: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in parts]
        for table in _buckets(batches):
            bucket = Bucket(table, root)
            for q in np.flatnonzero(whole * bucket.norm.max() * SLACK + 1.0 >= bound):
                rows = bucket.survivors(focus[q], rest[q], bound[q])
                if not len(rows):
                    continue
                score = bucket.scores(parts[q], weights)[rows]
                rows, score = rows[score >= bound[q]], score[score >= bound[q]]
                docs, score = np.concatenate([top[q][0], bucket.docs[rows]]), np.concatenate([top[q][1], score])
                order = np.lexsort((docs, -score))[:k]
                top[q] = docs[order], score[order]
                if len(order) == k:
                    bound[q] = max(bound[q], score[order[-1]])
        sizes = [len(docs) for docs, _ in top]
        yield pa.record_batch(
            [pa.array(np.repeat(np.arange(len(parts)), sizes)), pa.array(np.concatenate([x for x, _ in top])),
             pa.array(np.concatenate([x for _, x in top]))], names=["query", "doc", "score"])

    found = impact.mapInArrow(run, "query long, doc long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "doc")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _buckets(batches) -> Iterator[pa.Table]:
    """The rows in order, about BUCKET_ROWS at a time."""
    held, n = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, BUCKET_ROWS):
            piece = batch.slice(start, BUCKET_ROWS)
            held.append(piece)
            n += piece.num_rows
            if n >= BUCKET_ROWS:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _answer(docs: DataFrame, queries: Queries, k: int, key: str, text: str) -> DataFrame:
    """(query, doc, score, rank) for one block of queries."""
    found = cut_lineage(occurrences(docs, queries.terms, key, text))
    n_docs, all_terms = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_counts(found, len(queries.terms))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    impact = cut_lineage(impacts(found, weights, n_docs, all_terms))
    discard(found)
    share = max(0.0, 1 - FIRST_ROWS / max(1, n_docs))
    cut = impact.agg(F.percentile_approx("norm", F.lit(share), F.lit(100_000))).first()[0] or 0.0
    none = np.zeros(len(queries.ids), np.int64)
    least = none.copy()
    for query, score in best(impact.filter(F.col("norm") >= cut), queries, weights, none, k).filter(
            F.col("rank") == k).select("query", "score").collect():
        least[query] = score
    ordered = impact.repartitionByRange(F.desc("norm"), F.xxhash64("doc")).sortWithinPartitions(F.desc("norm"))
    return best(ordered, queries, weights, least, k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, *, key: str = "doc_id", text: str = "text",
           item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item, rank, key, score): the ``k`` documents with the highest scores above 0 for each item.

    Scores are integers: the sum, over the distinct terms of the item, of the
    term's weight and its saturated frequency in the document. Equal scores are
    ranked by ascending id; a null id comes after all others, rows that repeat an
    id are ranked each. Items that share an id are one item with the terms of
    all. A null text has no terms. Items and documents without a term in common
    give no rows; other columns are not read.

    Queries are answered in blocks of about BLOCK_TERMS terms, each in one pass
    over the texts; a block and its counts are all that the driver holds.
    """
    kind, item_kind = docs.schema[key].dataType, items.schema[item].dataType
    spark, answers = docs.sparkSession, []
    for queries in query_blocks(items, item, item_text):
        names = spark.createDataFrame(list(enumerate(queries.ids)), f"query long, name {item_kind.simpleString()}")
        answers.append(_answer(docs, queries, k, key, text).join(F.broadcast(names), "query"))
    if not answers:
        return spark.createDataFrame([], f"{item} {item_kind.simpleString()}, rank int, {key} {kind.simpleString()}, score long")
    return reduce(DataFrame.union, answers).select(
        F.col("name").alias(item), "rank", F.when(F.col("doc") != NO_ID, F.col("doc")).cast(kind).alias(key), "score")


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
m AS (SELECT doc_id, 100 - 90 + (90 * n * docs) // terms AS m FROM n, total),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, docs),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM r WHERE rank <= 10
"""
