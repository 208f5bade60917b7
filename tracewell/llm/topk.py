"""Exact top-k inner products by distributed histogram selection.

Scores are never sorted or shipped. Each round counts, per query, how many
scores fall into each cell of an interval known to hold the kth largest score;
the global histogram tells the cell it lies in, which is the next interval. When
cells are single values the kth score is known exactly, and one more pass keeps
the scores above it and, of the ties, the smallest ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewell.session import cut_lineage

CELLS = 256
QUERY_BLOCK = 1024
VECTOR_BLOCK = 4096
SPREAD = 256  # a block of queries is copied to so many join keys at most, a block of vectors goes to one
HELD_BLOCKS = 64  # blocks of queries whose counts a task holds at most, 2 MB each


def whole_vectors(df: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """(id, v array<long>): floor(scale * x) of the vectors whose components are all finite.

    Rows without an id take no part. Rows that repeat an id count once, with
    the smallest vector.
    """
    wide = F.col(vector).cast("array<double>")
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull()).filter(finite)
            .select(F.col(key).cast("long").alias("id"), F.transform(wide, lambda x: F.floor(x * scale)).alias("v"))
            .groupBy("id").agg(F.min("v").alias("v")))


def _pack(ids: np.ndarray, lists: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimensions, ids ascending, matrix) for the vectors of each length."""
    sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy()
    starts = np.cumsum(sizes) - sizes
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        rows = rows[np.argsort(ids[rows])]
        yield dim, ids[rows], flat[starts[rows][:, None] + np.arange(dim)]


def _narrow(data: np.ndarray) -> bytes:
    """Whole numbers as bytes, each in as few as all of them allow."""
    for kind in (np.int16, np.int32):
        if not data.size or (np.iinfo(kind).min <= data.min() and data.max() <= np.iinfo(kind).max):
            return data.astype(kind).tobytes()
    return data.astype(np.int64).tobytes()


def _wide(data: bytes, rows: int, dim: int) -> np.ndarray:
    """The matrix that ``_narrow`` packed."""
    kind = f"i{len(data) // (rows * dim)}" if rows * dim else "i8"
    return np.frombuffer(data, kind).astype(np.int64).reshape(rows, dim)


def vector_blocks(vectors: DataFrame) -> DataFrame:
    """Pack vectors into blocks: (dim, slot, ids, data)."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, VECTOR_BLOCK):
                part = batch.slice(start, VECTOR_BLOCK)
                for dim, ids, data in _pack(part.column(0).to_numpy(), part.column(1)):
                    yield pa.record_batch(
                        [pa.array([dim], pa.int32()), pa.array([int(ids[0]) * 2654435761 % SPREAD], pa.int32()),
                         pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                         pa.array([_narrow(data)], pa.binary())],
                        names=["dim", "slot", "ids", "data"])

    return vectors.select("id", "v").mapInArrow(run, "dim int, slot int, ids binary, data binary")


def query_blocks(queries: DataFrame, blocks: int, slots: DataFrame) -> DataFrame:
    """Pack (id, v, lo, need) into blocks of about QUERY_BLOCK rows, one copy per slot of their length in ``slots``."""

    def pack(group: pa.Table) -> pa.Table:
        batch = group.combine_chunks().sort_by("id")
        ids = batch.column("id").to_numpy()
        data = np.concatenate([x.values.to_numpy() for x in batch.column("v")]) if len(ids) else np.empty(0)
        return pa.table({
            "dim": pa.array([batch.column("dim")[0].as_py()], pa.int32()),
            "q_ids": pa.array([ids.tobytes()], pa.binary()),
            "q_data": pa.array([_narrow(data)], pa.binary()),
            "q_lo": pa.array([batch.column("lo").to_numpy().tobytes()], pa.binary()),
            "q_need": pa.array([batch.column("need").to_numpy().tobytes()], pa.binary()),
        })

    packed = (queries.select("id", "v", "lo", "need", F.size("v").alias("dim"),
                             F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
              .groupBy("dim", "block").applyInArrow(
                  pack, "dim int, q_ids binary, q_data binary, q_lo binary, q_need binary"))
    return packed.join(slots.groupBy("dim").agg(F.collect_set("slot").alias("slots")), "dim").withColumn(
        "slot", F.explode("slots")).drop("slots")


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All integer inner products, exact while they fit into 64 bits, else the nearest 64-bit value."""
    if not left.shape[1]:
        return np.zeros((len(left), len(right)), np.int64)
    bound = float(np.abs(left.astype(np.float64)).max()) * float(np.abs(right.astype(np.float64)).max()) * left.shape[1]
    if bound < 2.0 ** 53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if bound < 2.0 ** 62:
        return left @ right.T
    exact = left.astype(object) @ right.astype(object).T
    return np.clip(exact, -(1 << 62), (1 << 62) - 1).astype(np.int64)


def _scored(batches):
    """(query ids, lo, need, candidate ids, scores) of every pair of blocks."""
    for batch in batches:
        for row in range(batch.num_rows):
            dim, ids, data, q_ids, q_data, q_lo, q_need = (c[row].as_py() for c in batch.columns)
            ids, q_ids = np.frombuffer(ids, np.int64), np.frombuffer(q_ids, np.int64)
            scores = inner_products(_wide(q_data, len(q_ids), dim), _wide(data, len(ids), dim))
            yield q_ids, np.frombuffer(q_lo, np.int64), np.frombuffer(q_need, np.int64), ids, scores


def histograms(pairs: DataFrame, width: int) -> DataFrame:
    """(query_id, cell, n): scores per cell of ``width`` from each query's ``lo``.

    A task adds up its blocks first, for up to HELD_BLOCKS blocks of queries at a
    time. It leaves out cells below the one in which its own count reaches what is
    needed: the kth score cannot lie there.
    """

    def flush(held: dict[bytes, tuple]) -> Iterator[pa.RecordBatch]:
        for q_ids, need, counts in held.values():
            counts = counts.reshape(len(q_ids), CELLS)
            above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
            rows, cells = np.nonzero((counts > 0) & (above < need[:, None]))
            yield pa.record_batch(
                [pa.array(q_ids[rows]), pa.array(cells.astype(np.int32)), pa.array(counts[rows, cells])],
                names=["query_id", "cell", "n"])
        held.clear()

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple] = {}
        for q_ids, lo, need, ids, scores in _scored(batches):
            name = q_ids.tobytes()
            if name not in held:
                if len(held) >= HELD_BLOCKS:
                    yield from flush(held)
                held[name] = (q_ids, need, np.zeros(len(q_ids) * CELLS, np.int64))
            # Scores and bounds stay within 2^62, so that differences fit; a width is a power of two.
            cell = (scores - lo[:, None]) >> (width.bit_length() - 1)
            inside = (cell >= 0) & (cell < CELLS) & (q_ids[:, None] != ids[None, :])
            at = np.flatnonzero(inside)
            held[name][2][:] += np.bincount(at // len(ids) * CELLS + cell.ravel()[at], minlength=len(q_ids) * CELLS)
        yield from flush(held)

    return pairs.mapInArrow(run, "query_id long, cell int, n long")


def narrowed(state: DataFrame, cells: DataFrame, width: int) -> DataFrame:
    """The next interval of each query: the cell that holds its kth score."""
    totals = cells.groupBy("query_id", "cell").agg(F.sum("n").alias("n"))
    from_top = Window.partitionBy("query_id").orderBy(F.desc("cell"))
    reached = (totals.withColumn("upto", F.sum("n").over(from_top))
               .join(state.select(F.col("id").alias("query_id"), "lo", "need"), "query_id")
               .filter((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need"))))
    found = reached.select(
        F.col("query_id").alias("id"), (F.col("lo") + F.col("cell").cast("long") * F.lit(width).cast("long")).alias("_lo"),
        (F.col("need") - F.col("upto") + F.col("n")).alias("_need"))
    # A query with fewer candidates than asked for keeps its lowest cell and so all of them.
    return state.join(found, "id", "left").select(
        "id", F.coalesce("_lo", "lo").alias("lo"), F.coalesce("_need", "need").alias("need"))


def survivors(pairs: DataFrame) -> DataFrame:
    """(query_id, vec_id, score) above each query's kth score, and the first ties of each block."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for q_ids, kth, need, ids, scores in _scored(batches):
            rows, cols = np.nonzero((scores >= kth[:, None]) & (q_ids[:, None] != ids[None, :]))
            value = scores[rows, cols]
            tie = value == kth[rows]
            # Ids ascend within a block, so the first ties of a row have the smallest ids.
            seen = np.cumsum(tie)
            starts = np.searchsorted(rows, np.arange(len(q_ids)))
            base = np.concatenate([[0], seen])[starts][rows]
            keep = ~tie | (seen - base <= need[rows])
            yield pa.record_batch(
                [pa.array(q_ids[rows[keep]]), pa.array(ids[cols[keep]]), pa.array(value[keep])],
                names=["query_id", "vec_id", "score"])

    return pairs.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(df: DataFrame, is_query, k: int = 10, *, key: str = "vec_id", vector: str = "embedding",
          scale: float = 1024.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest integer inner products per query.

    Queries are the rows for which ``is_query`` (a column of ``df``) holds,
    candidates all rows with another id. Vectors that are null or hold a null or
    non-finite component, and rows without an id, take no part; only vectors of
    equal length are compared; a repeated id counts once, with its smallest
    vector. Ties go to the smaller id. A query with fewer than ``k`` candidates
    gets all of them; an empty table gives no rows. Other columns are not read.

    Vectors are packed once, in blocks, and written. A round joins blocks of
    vectors with blocks of queries (about QUERY_BLOCK each) on a slot, so both
    may be of any number and neither is broadcast: the copies of the queries
    look as small as one of them where Spark would choose.
    """
    vectors = cut_lineage(whole_vectors(df, key, vector, scale))
    asked = df.filter(is_query).select(F.col(key).cast("long").alias("id")).distinct()
    queries = cut_lineage(vectors.join(asked, "id"))
    blocks = cut_lineage(vector_blocks(vectors))
    slots = blocks.select("dim", "slot").distinct()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    longest = vectors.agg(F.max(norm)).first()[0] or 0.0
    widest, n = queries.agg(F.max(norm), F.count(F.lit(1))).first()
    bound = min((1 << 62) - 1, math.ceil((widest or 0.0) * longest * 1.000001) + 1)
    groups = max(1, -(-n // QUERY_BLOCK))
    width = 1
    while width * CELLS < 2 * bound + 1:
        width *= CELLS
    state = queries.select("id", F.lit(-bound).cast("long").alias("lo"), F.lit(k).cast("long").alias("need"))

    def pairs(state: DataFrame) -> DataFrame:
        # Queries stream past the vectors of their slot, so a block of queries meets them one after another.
        packed = query_blocks(queries.join(state, "id"), groups, slots)
        return packed.join(blocks.hint("merge"), ["dim", "slot"]).select(
            "dim", "ids", "data", "q_ids", "q_data", "q_lo", "q_need")

    while width >= 1:
        state = cut_lineage(narrowed(state, histograms(pairs(state), width), width))
        width //= CELLS
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (survivors(pairs(state)).withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
