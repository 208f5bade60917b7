"""Line dedup that can be undone: sharded cuckoo filters over exact reference counts.

The index of a corpus holds a row per line key and document (references), a row
per key (how many documents refer to it, the smallest and the largest of them)
and, for each shard of the keys, cuckoo filters of their fingerprints. A key
that no filter knows is new and is added without looking at the counts; one that
a filter seems to know is looked up there. Taking documents out lowers the
counts, and keys without a reference leave the filters, so the index is the one
it would be had the documents never come.

Keys are told apart by 128 bits of a cryptographic hash. Counts are summed
before they are shuffled, so a line that a third of all documents share is one
row of a shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm.common import map_batches, mix64
from tracewell.session import cut_lineage, discard

LEAST_CHARACTERS = 10
SHARD_KEYS = 1_000_000  # keys of a shard, about; with more the index is dealt to more shards
LEAST_SHARDS = 64
BUCKET = 4  # fingerprints of a bucket
LOAD = 0.8  # share of a new filter's places that its first keys take at most
ROUNDS = 500
NO_ID = (1 << 63) - 1

KEYS = "h1 long, h2 long, refs long, first long, last long"
FILTERS = "shard int, generation int, places binary"


def line_key(line: bytes) -> bytes | None:
    """Key of a line (stripped, A-Z lower-cased), None if it is too short to count."""
    key = line.strip().lower()  # for bytes, ASCII white space and letters only
    if len(key) < LEAST_CHARACTERS or len(key) < 4 * LEAST_CHARACTERS and len(key.decode("utf-8", "replace")) < LEAST_CHARACTERS:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


class Cuckoo:
    """Cuckoo filter of 64-bit hashes with 16-bit fingerprints; 0 marks a free place."""

    def __init__(self, places: np.ndarray):
        self.places = places

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 1
        while buckets * BUCKET * LOAD < keys:
            buckets *= 2
        return cls(np.zeros((buckets, BUCKET), np.uint16))

    @classmethod
    def read(cls, data: bytes) -> Cuckoo:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, BUCKET).copy())

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        jump = mix64(mark.astype(np.uint64)).astype(np.int64) & (len(self.places) - 1)
        return bucket ^ jump

    def _marks(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, first bucket) of each hash."""
        bits = hashes.astype(np.int64).view(np.uint64)
        mark = ((bits >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        return mark, (bits & np.uint64(len(self.places) - 1)).astype(np.int64)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        mark, bucket = self._marks(hashes)
        found = (self.places[bucket] == mark[:, None]).any(axis=1)
        return found | (self.places[self._other(bucket, mark)] == mark[:, None]).any(axis=1)

    def _settle(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Put marks into free places of their buckets; which of them found one."""
        order = np.argsort(bucket, kind="stable")
        sorted_bucket = bucket[order]
        turn = np.arange(len(order)) - np.searchsorted(sorted_bucket, sorted_bucket)
        free = self.places[sorted_bucket] == 0
        fits = turn < free.sum(axis=1)
        place = (np.cumsum(free, axis=1) == (turn + 1)[:, None]).argmax(axis=1)
        self.places[sorted_bucket[fits], place[fits]] = mark[order[fits]]
        done = np.zeros(len(bucket), bool)
        done[order[fits]] = True
        return done

    def add(self, hashes: np.ndarray) -> bool:
        """Add all hashes, or none of them if there is no room."""
        before = self.places.copy()
        mark, bucket = self._marks(hashes)
        for turn in range(ROUNDS):
            left = ~self._settle(bucket, mark)
            mark, bucket = mark[left], bucket[left]
            if not len(mark):
                return True
            bucket = self._other(bucket, mark)
            left = ~self._settle(bucket, mark)
            mark, bucket = mark[left], bucket[left]
            if not len(mark):
                return True
            # One mark of each full bucket takes the place of another, which moves on.
            _, chosen = np.unique(bucket, return_index=True)
            at, place = bucket[chosen], (bucket[chosen] + turn) % BUCKET
            mark[chosen], self.places[at, place] = self.places[at, place], mark[chosen]
            bucket[chosen] = self._other(at, mark[chosen])
        self.places = before
        return False

    def remove(self, hashes: np.ndarray) -> np.ndarray:
        """Take one fingerprint out for each hash; which hashes had one here."""
        mark, bucket = self._marks(hashes)
        had = np.zeros(len(hashes), bool)
        left = np.arange(len(hashes))
        while len(left):
            own, other = bucket[left], self._other(bucket[left], mark[left])
            here, there = (self.places[b] == mark[left, None] for b in (own, other))
            known = here.any(axis=1) | there.any(axis=1)
            spot = np.where(here.any(axis=1), own * BUCKET + here.argmax(axis=1), other * BUCKET + there.argmax(axis=1))
            left, spot = left[known], spot[known]
            # Hashes that share a fingerprint take out one each, in turn.
            spot, winners = np.unique(spot, return_index=True)
            self.places.reshape(-1)[spot] = 0
            had[left[winners]] = True
            left = np.delete(left, winners)
        return had


@dataclass(frozen=True)
class LineIndex:
    """References (h1, h2, doc, row), counts (KEYS) and filters (FILTERS) of a corpus.

    All three are written tables. ``row`` is a hash of the text the reference is in.
    """

    references: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int


def _filters(table: pa.Table) -> list[Cuckoo]:
    order = np.argsort(table.column("generation").to_numpy())
    return [Cuckoo.read(table.column("places")[int(i)].as_py()) for i in order]


def _filter_rows(shard: int, filters: list[Cuckoo]) -> list[pa.Array]:
    n = len(filters)
    return [pa.array([shard] * n, pa.int32()), pa.array(range(n), pa.int32()),
            pa.array([f.places.tobytes() for f in filters], pa.binary())]


PROBED = f"{KEYS}, known boolean, {FILTERS}"


def _probe(key, keys: pa.Table, filters: pa.Table) -> pa.Table:
    """Keys of one shard with ``known``, and the shard's filters with the unknown ones added."""
    held = _filters(filters)
    hashes = keys.column("h2").to_numpy()
    known = np.zeros(len(hashes), bool)
    for f in held:
        known |= f.holds(hashes)
    fresh = hashes[~known]
    if len(fresh) and not (held and held[-1].add(fresh)):
        # A filter of its own for what does not fit, no smaller than twice the last.
        size = max(len(fresh), int(2 * held[-1].places.size * LOAD) if held else 0)
        held.append(Cuckoo.sized(size))
        while not held[-1].add(fresh):
            held[-1] = Cuckoo.sized(int(2 * held[-1].places.size * LOAD))
    n, m = len(hashes), len(held)
    shard = key[0].as_py()
    rows = [pa.concat_arrays([keys.column(c).combine_chunks().cast(pa.int64()), pa.nulls(m, pa.int64())])
            for c in ("h1", "h2", "refs", "first", "last")]
    rows.append(pa.concat_arrays([pa.array(known), pa.nulls(m, pa.bool_())]))
    rows += [pa.concat_arrays([pa.nulls(n, x.type), x]) for x in _filter_rows(shard, held)]
    return pa.table(rows, names=[x.split()[0] for x in PROBED.split(", ")])


def _withdraw(key, keys: pa.Table, filters: pa.Table) -> pa.Table:
    """The filters of one shard without the keys that lost their last reference."""
    held, left = _filters(filters), keys.column("h2").to_numpy()
    for f in reversed(held):
        left = left[~f.remove(left)]
    return pa.table(_filter_rows(key[0].as_py(), held), names=[x.split()[0] for x in FILTERS.split(", ")])


def _lines(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A reference for each distinct key of each text."""
    for i, text in enumerate(batch.column(2).cast(pa.binary())):
        found = {line_key(line) for line in text.as_py().split(b"\n")} - {None}
        if found:
            pairs = np.frombuffer(b"".join(sorted(found)), np.int64).reshape(-1, 2)
            doc, row = (batch.column(c)[i].as_py() for c in (0, 1))
            yield pa.record_batch(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(np.full(len(pairs), doc)), pa.array(np.full(len(pairs), row))],
                names=["h1", "h2", "doc", "row"])


def _gathered(batches, size: int = 50_000) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, row, text) with a null id as the largest and a null text as empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.xxhash64(whole).alias("row"), whole.alias("text"))


def references(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(h1, h2, doc, row) for each distinct line key of each document row."""
    return map_batches(identified(docs, key, text), "h1 long, h2 long, doc long, row long", lambda b: _gathered(_lines(b)))


def counted(refs: DataFrame) -> DataFrame:
    return refs.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("refs"), F.min("doc").alias("first"), F.max("doc").alias("last"))


def _sharded(keys: DataFrame, shards: int) -> DataFrame:
    return keys.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int")).groupBy("shard")


def empty(spark: SparkSession) -> LineIndex:
    return LineIndex(spark.createDataFrame([], "h1 long, h2 long, doc long, row long"), spark.createDataFrame([], KEYS),
                     spark.createDataFrame([], FILTERS), LEAST_SHARDS)


def _probed(keys: DataFrame, filters: DataFrame, shards: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(the written step, its keys, its filters)."""
    step = cut_lineage(_sharded(keys, shards).cogroup(filters.groupBy("shard")).applyInArrow(_probe, PROBED))
    return (step, step.filter("shard IS NULL").select(*[x.split()[0] for x in KEYS.split(", ")], "known"),
            step.filter("shard IS NOT NULL").select("shard", "generation", "places"))


def insert(index: LineIndex, docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> LineIndex:
    """The index with ``docs`` added. A document that is there already counts once more."""
    refs = cut_lineage(references(docs, key, text))
    step, keys, filters = _probed(counted(refs), index.filters, index.shards)
    known, fresh = keys.filter("known").drop("known"), keys.filter("NOT known").drop("known")
    more = known.select("h1", "h2", *[F.col(c).alias(f"more_{c}") for c in ("refs", "first", "last")])
    raised = index.counts.join(more, ["h1", "h2"], "left").select(
        "h1", "h2", (F.col("refs") + F.coalesce("more_refs", F.lit(0))).alias("refs"),
        F.least("first", "more_first").alias("first"), F.greatest("last", "more_last").alias("last"))
    mistaken = known.join(index.counts, ["h1", "h2"], "left_anti")  # the filter took them for others
    counts = cut_lineage(raised.union(fresh).union(mistaken))
    grown = LineIndex(index.references.union(refs), counts, filters, index.shards)
    return dealt(grown) if counts.count() > 2 * SHARD_KEYS * index.shards else grown


def dealt(index: LineIndex) -> LineIndex:
    """The index with as many shards as its keys ask for, and its filters made anew from the counts."""
    shards = max(LEAST_SHARDS, -(-index.counts.count() // SHARD_KEYS))
    none = index.counts.sparkSession.createDataFrame([], FILTERS)
    return LineIndex(index.references, index.counts, _probed(index.counts, none, shards)[2], shards)


def delete(index: LineIndex, ids: DataFrame, *, key: str = "doc_id") -> LineIndex:
    """The index without the documents whose ids are in ``ids``; unknown ids change nothing."""
    out = ids.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc")).distinct()
    left = cut_lineage(index.references.join(out, "doc", "left_anti").select("h1", "h2", "doc", "row"))
    touched = cut_lineage(index.references.join(out, "doc", "left_semi").select("h1", "h2").distinct())
    lowered = cut_lineage(counted(left.join(touched, ["h1", "h2"], "left_semi")))
    counts = cut_lineage(index.counts.join(touched, ["h1", "h2"], "left_anti").union(lowered))
    orphaned = touched.join(lowered, ["h1", "h2"], "left_anti")
    filters = cut_lineage(_sharded(orphaned, index.shards).cogroup(index.filters.groupBy("shard")).applyInArrow(_withdraw, FILTERS))
    discard(touched, lowered)
    return LineIndex(left, counts, filters, index.shards)


def _kept(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    lines, dropped, kept = [], [], []
    for text, gone in zip(batch.column(1).cast(pa.binary()), batch.column(2)):
        parts = text.as_py().split(b"\n")
        names = {(x["h1"].to_bytes(8, "little", signed=True) + x["h2"].to_bytes(8, "little", signed=True))
                 for x in gone.as_py() or ()}
        left = [line for line in parts if line_key(line) not in names] if names else parts
        lines.append(len(parts))
        dropped.append(len(parts) - len(left))
        kept.append(b"\n".join(left))
    yield pa.record_batch(
        [batch.column(0), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()),
         pa.array(kept, pa.binary()).cast(pa.string())], names=["doc", "n_lines", "n_dropped", "kept_text"])


def kept_lines(index: LineIndex, docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_lines, n_dropped, kept_text) for each row of ``docs``, documents of the index.

    A line goes if its key (stripped of ASCII white space, A-Z lower-cased, at
    least LEAST_CHARACTERS code points) is in two or more documents of the index
    and another than this is the smallest of them. A null or empty text is one
    empty line. Rows that repeat an id are one document, so are all rows without
    an id, which counts as larger than all others. No documents give no rows;
    other columns are not read.
    """
    shared = index.counts.filter("first < last").select("h1", "h2", "first")
    gone = (index.references.join(shared, ["h1", "h2"]).filter("doc > first")
            .groupBy("doc", "row").agg(F.collect_set(F.struct("h1", "h2")).alias("gone")))
    rows = identified(docs, key, text).join(gone, ["doc", "row"], "left").select("doc", "text", "gone")
    kind = docs.schema[key].dataType
    return map_batches(rows, "doc long, n_lines long, n_dropped long, kept_text string", _kept).select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).cast(kind).alias(key), "n_lines", "n_dropped", "kept_text")


def dedup(docs: DataFrame, *, key: str = "doc_id", text: str = "text", arrivals: int = 2) -> DataFrame:
    """``kept_lines`` of a corpus whose documents come in ``arrivals`` parts, one after the other."""
    index = empty(docs.sparkSession)
    for i in range(arrivals):
        part = F.pmod(F.xxhash64(key, text), F.lit(arrivals)) == i
        index = insert(index, docs.filter(part), key=key, text=text)
    return kept_lines(index, docs, key=key, text=text)


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, i, lines[i] AS line,
         translate(regexp_replace(lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
shared AS (SELECT key, min(doc_id) AS first FROM l WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)),
marked AS (SELECT doc_id, i, line, first IS NOT NULL AND doc_id > first AS gone FROM l LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
