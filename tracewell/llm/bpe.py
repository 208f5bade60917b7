"""Byte-level BPE encoding and decoding as a monoid reduction over byte halves.

The encodings of byte strings form a monoid: joining two encodings gives the
encoding of the concatenated bytes. A piece is halved until its parts are
leaves; all leaves of a batch are merged together in numpy; then neighbours are
joined up the tree. A join re-encodes a window around the seam and widens it
until both of its edges are stable: a token sequence is the encoding of its
bytes exactly when each adjacent pair of tokens is the encoding of its own
bytes, so two checked pairs prove that nothing outside the window can change.
Decoding is the monoid of byte concatenation.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import ragged, text_slices

LEAF_BYTES = 32
CACHE_PIECES = 200_000
CACHE_PAIRS = 200_000
ROWS = 1000  # texts whose strings a worker holds at once


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class PairTable:
    """(left id, right id) -> merged id, looked up for whole arrays by open addressing."""

    NONE = np.int64(1 << 40)
    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, ranks: dict[bytes, int]):
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    merged.append(rank)
        bits = max(8, len(keys).bit_length() + 2)
        self.shift = np.uint64(64 - bits)
        self.keys = np.full((1 << bits) + 1, -1, np.int64)
        self.merged = np.full((1 << bits) + 1, self.NONE, np.int64)
        rest, values = np.array(keys, np.int64), np.array(merged, np.int64)
        slot = self._slot(rest)
        while len(rest):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = rest[free]  # one of the keys that want a slot gets it
            held = self.keys[slot] == rest
            self.merged[slot[held]] = values[held]
            rest, values, slot = rest[~held], values[~held], (slot[~held] + 1) % (1 << bits)
        self.size = 1 << bits

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * self.FACTOR) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = (left.astype(np.int64) << 32) | right
        slot = self._slot(wanted)
        found = self.keys[slot]
        out = np.where(found == wanted, self.merged[slot], self.NONE)
        more = np.flatnonzero((found != wanted) & (found >= 0))
        while len(more):
            slot[more] = (slot[more] + 1) % self.size
            found = self.keys[slot[more]]
            hit = found == wanted[more]
            out[more[hit]] = self.merged[slot[more[hit]]]
            more = more[~hit & (found >= 0)]
        return out


class Encoder:
    """Encodes pieces of text with a vocabulary of ranks that holds all 256 bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pairs = PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.stable: dict[tuple[int, int], bool] = {}

    def encode_leaves(self, leaves: list[bytes]) -> list[list[int]]:
        """Merge all leaves side by side, one merge per leaf and round."""
        lengths = np.array([len(x) for x in leaves], np.int64)
        out: list[list[int]] = [[] for _ in leaves]
        ids = self.byte_ids[np.frombuffer(b"".join(leaves), np.uint8)]
        active = np.flatnonzero(lengths)
        lengths = lengths[active]
        rank = np.full(len(ids), PairTable.NONE)
        if len(ids) > 1:
            rank[:-1] = self.pairs(ids[:-1], ids[1:])
        ends = np.cumsum(lengths)
        if len(ids):
            rank[ends - 1] = PairTable.NONE
        while len(active):
            starts = ends - lengths
            # The lowest rank of each leaf, the leftmost of equals.
            best = np.minimum.reduceat((rank << 22) | (np.arange(len(ids)) & ((1 << 22) - 1)), starts)
            going = (best >> 22) < PairTable.NONE
            for k in np.flatnonzero(~going):
                out[active[k]] = ids[starts[k]:ends[k]].tolist()
            if not going.any():
                break
            at = best[going] & ((1 << 22) - 1)
            ids[at] = rank[at]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            rank[at] = rank[at + 1]  # only tells whether the leaf ends there
            keep &= np.repeat(going, lengths)
            position = np.cumsum(keep) - 1
            ids, rank = ids[keep], rank[keep]
            lengths, active = lengths[going] - 1, active[going]
            ends = np.cumsum(lengths)
            last = np.zeros(len(ids), bool)
            last[ends - 1] = True
            at = position[at]
            right = at[~last[at]]
            rank[right] = self.pairs(ids[right], ids[right + 1])
            rank[last] = PairTable.NONE
            first = np.zeros(len(ids), bool)
            first[ends - lengths] = True
            left = at[~first[at]]
            rank[left - 1] = self.pairs(ids[left - 1], ids[left])
        return out

    def merge(self, data: bytes) -> list[int]:
        """Encode one byte string with a heap of adjacent pairs."""
        parts: list[bytes | None] = [data[i:i + 1] for i in range(len(data))]
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap = [(rank, i, 2) for i in range(len(parts) - 1)
                if (rank := self.ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or len(parts[i]) + len(parts[j]) != size:
                continue  # one of the two was merged otherwise meanwhile
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else len(parts)
                if b < len(parts) and (rank := self.ranks.get(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (rank, a, len(parts[a]) + len(parts[b])))
        return [self.ranks[part] for part in parts if part is not None]

    def pair_is_stable(self, a: int, b: int) -> bool:
        known = self.stable.get((a, b))
        if known is None:
            if len(self.stable) >= CACHE_PAIRS:
                self.stable.clear()
            known = self.stable[a, b] = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of ``left`` followed by those of ``right``."""
        if not left or not right:
            return left or right
        i = j = 1
        while True:
            window = self.merge(b"".join(map(self.tokens.__getitem__, left[len(left) - i:] + right[:j])))
            left_stable = i == len(left) or self.pair_is_stable(left[-i - 1], window[0])
            right_stable = j == len(right) or self.pair_is_stable(window[-1], right[j])
            if left_stable and right_stable:
                return left[:len(left) - i] + window + right[j:]
            if not left_stable:
                i = min(2 * i, len(left))
            if not right_stable:
                j = min(2 * j, len(right))

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Encodings of the pieces. A piece that is a token itself is that token."""
        out: list[list[int]] = [[]] * len(pieces)
        leaves: list[bytes] = []
        trees: list[tuple[int, int, int]] = []
        for k, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[k] = [rank]
                continue
            parts = [piece]
            while len(parts[0]) > LEAF_BYTES:
                parts = [half for part in parts for half in (part[:(len(part) + 1) // 2], part[(len(part) + 1) // 2:])]
            trees.append((k, len(leaves), len(parts)))
            leaves += parts
        encoded: list[list[int]] = []
        for start in range(0, len(leaves), 60_000):  # a round addresses 2^22 bytes
            encoded += self.encode_leaves(leaves[start:start + 60_000])
        for k, start, count in trees:
            level = encoded[start:start + count]
            while len(level) > 1:
                level = [self.join(level[n], level[n + 1]) for n in range(0, len(level), 2)]
            out[k] = level[0]
        return out


class PieceStore:
    """Encodings of the pieces met so far, as one flat array; emptied when full."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)

    def ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, number of ids per piece)."""
        missing = [p for p in set(pieces) if p not in self.index]
        if missing and len(self.index) + len(missing) > CACHE_PIECES:
            self.clear()
            missing = list(set(pieces))
        if missing:
            encoded = self.encoder.encode_pieces([p.encode() for p in missing])
            lengths = np.array([len(x) for x in encoded], np.int64)
            flat = np.array([i for ids in encoded for i in ids], np.int32)
            self.index.update(zip(missing, range(len(self.index), len(self.index) + len(missing))))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, flat])
        at = np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))
        lengths = self.lengths[at]
        return self.flat[ragged(self.starts[at], lengths)], lengths


#: The store of the last vocabulary a worker process has met, kept between tasks.
_LAST_STORE: dict[str, PieceStore] = {}


def _store_for(label: str, ranks: dict[bytes, int]) -> PieceStore:
    if label not in _LAST_STORE:
        _LAST_STORE.clear()
        _LAST_STORE[label] = PieceStore(Encoder(ranks))
    return _LAST_STORE[label]


def _encoded(batches, store: PieceStore, pattern: str) -> Iterator[pa.RecordBatch]:
    """(key, ids) from batches of (key, text)."""
    find = regex.compile(pattern).findall
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            part = batch.slice(first, ROWS)
            texts = part.column(1).to_pylist()
            for start, stop in text_slices(texts):
                split = [find(t) if t else [] for t in texts[start:stop]]
                counts = np.array([len(p) for p in split], np.int64)
                ids, lengths = store.ids_of([p for pieces in split for p in pieces])
                ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
                yield pa.record_batch(
                    [part.column(0).slice(start, stop - start),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))],
                    names=["key", "ids"])


def _decoded(batches, ranks: dict[bytes, int], at: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The batches, whose column ``at`` holds lists of ids, with the bytes these stand for."""
    by_id = sorted(ranks.items(), key=lambda x: x[1])
    known = np.array([rank for _, rank in by_id], np.int64)
    sizes = np.array([len(token) for token, _ in by_id], np.int64)
    starts = np.cumsum(sizes) - sizes
    flat = np.frombuffer(b"".join(token for token, _ in by_id), np.uint8)
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            values = part.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            place = np.minimum(np.searchsorted(known, values), len(known) - 1)
            if (known[place] != values).any():
                raise ValueError("ids hold a token outside the vocabulary")
            counts = np.array([n or 0 for n in pa.compute.list_value_length(part.column(at)).to_pylist()], np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes[place])])[np.concatenate([[0], np.cumsum(counts)])]
            data = flat[ragged(starts[place], sizes[place])]
            decoded = pa.Array.from_buffers(
                pa.binary(), len(counts),
                [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
            yield pa.record_batch([*part.columns, decoded], names=names)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """(key, ids array<int>): token ids of every whole text.

    Each match of ``pattern`` is encoded separately. A null or empty text has no
    ids; a null key stays null; repeated rows give repeated rows; other columns
    are not read. Texts are encoded where they are scanned, without a shuffle;
    the vocabulary (a file of fixed size) is broadcast.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(ranks)
    label = uuid.uuid4().hex

    def run(batches) -> Iterator[pa.RecordBatch]:
        yield from _encoded(batches, _store_for(label, vocabulary.value), pattern)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, ids array<int>").select(F.col("key").alias(key), "ids")


def decode(tokens: DataFrame, ranks: dict[bytes, int], *, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``tokens`` with the bytes that its ids stand for. Null ids give empty bytes.

    An id outside the vocabulary is an error.
    """
    vocabulary = tokens.sparkSession.sparkContext.broadcast(ranks)
    kept = tokens.drop(name)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    names = [*kept.columns, name]
    at = names.index(ids)

    def run(batches) -> Iterator[pa.RecordBatch]:
        yield from _decoded(batches, vocabulary.value, at, names)

    return kept.mapInArrow(run, f"{schema}, `{name}` binary")


def encode_and_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, key: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """(key, ids, decoded): what ``encode`` and then ``decode`` give, in one pass of one worker."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(ranks)
    label = uuid.uuid4().hex

    def run(batches) -> Iterator[pa.RecordBatch]:
        encoded = _encoded(batches, _store_for(label, vocabulary.value), pattern)
        yield from _decoded(encoded, vocabulary.value, 1, ["key", "ids", "decoded"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, ids array<int>, decoded binary").withColumnRenamed("key", key)


def with_digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(key, n_tokens, ids, ids_sha256, decoded_sha256) after encoding and decoding back."""
    tokens = encode_and_decode(docs, ranks, pattern, key=key, text=text)
    return tokens.select(
        key,
        F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, key: str = "doc_id",
            text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256)."""
    return with_digests(docs, ranks, pattern, key=key, text=text).drop("ids")
