"""Removing repeated byte strings with merged Burrows-Wheeler transforms.

A byte goes if a string of LENGTH bytes that covers it also starts in a document
with a smaller id. Only strings around repeated seeds can repeat: of the runs of
SEED bytes inside a string of LENGTH bytes the one with the smallest hash is its
seed, so equal strings have equal seeds at equal places. The strings that share
one seed in one place of a document form a block. Blocks are dealt by seed;
equal ones are found at once. The others are cut to what any neighbour shares
with them, and the Burrows-Wheeler transforms of shards of them are merged: the
interleave of the shards' suffixes is refined one character at a time, from the
transforms alone and without sorting suffixes of different shards, until it
holds the order by LENGTH characters. Where no boundary has appeared by then,
neighbours share LENGTH characters: a repeated interval, and its smallest
document decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm.common import mix64, ragged, release
from tracewell.session import cut_lineage, discard

LENGTH = 50
SEED = 16
SLICE_BYTES = 300_000  # so that the arrays of a slice stay in the cache of a core
SHARD_BYTES = 200_000
MERGE_BYTES = 2_000_000
LARGE_SEED = 50_000  # blocks of one seed from which its strings are grouped by Spark instead
NO_ID = (1 << 63) - 1  # a null id counts as the largest

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def byte_slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most SLICE_BYTES bytes, or one row, each."""
    start = 0
    while start < len(offsets) - 1:
        stop = int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, side="right")) - 1
        stop = max(start + 1, stop)
        yield start, stop
        start = stop


@dataclass
class Blocks:
    """Blocks of some texts, in order: row, seed, code (hash of the block, 48 bits), places."""

    row: np.ndarray
    seed: np.ndarray
    code: np.ndarray
    first: np.ndarray  # start of the first string, in the text
    last: np.ndarray  # start of the last string
    at: np.ndarray  # start of the seed

    def names(self) -> np.ndarray:
        return block_names(self.row, self.seed, self.code)


def block_names(row: np.ndarray, seed: np.ndarray, code: np.ndarray) -> np.ndarray:
    """One number for a row, a seed and a code."""
    return mix64(mix64(seed.view(np.uint64) + mix64(code.view(np.uint64))) + row.astype(np.uint64))


def find_blocks(data: np.ndarray, offsets: np.ndarray) -> Blocks:
    """Blocks of the texts that lie one after another in ``data``."""
    empty = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return Blocks(empty, empty, empty, empty, empty, empty)
    powers = np.full(len(data), _BASE)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    back = np.full(len(data), _INVERSE)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers)])
    grams = mix64((sums[SEED:] - sums[:-SEED]) * back[:len(data) - SEED + 1])

    # The smallest hash of each string and its leftmost place, packed into one number.
    bits = np.uint64(max(24, len(data).bit_length()))
    best = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    span, wanted = 1, LENGTH - SEED + 1
    while 2 * span <= wanted:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < wanted:
        best = np.minimum(best[:len(best) - (wanted - span)], best[wanted - span:])
    at = (best & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)

    lengths = np.diff(offsets)
    strings = np.maximum(lengths - LENGTH + 1, 0)
    start = ragged(offsets[:-1], strings)
    row = np.repeat(np.arange(len(lengths)), strings)
    at = at[start]
    fresh = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (row[1:] != row[:-1])])) if len(at) else empty
    first, last, row, at = start[fresh], start[np.append(fresh[1:], len(start)) - 1], row[fresh], at[fresh]
    whole = mix64((sums[last + LENGTH] - sums[first]) * back[first] + (last - first).astype(np.uint64) * _BASE)
    code = (whole >> np.uint64(16) << np.uint64(16)).view(np.int64)
    base = offsets[row]
    return Blocks(row, grams[at].view(np.int64), code, first - base, last - base, at - base)


def text_hashes(data: np.ndarray, offsets: np.ndarray) -> list[int]:
    """Signed 64-bit hash per text."""
    if not len(data):
        return [0] * (len(offsets) - 1)
    place = np.arange(len(data), dtype=np.uint64) - np.repeat(offsets[:-1], np.diff(offsets)).astype(np.uint64)
    mixed = np.concatenate([[np.uint64(0)], np.cumsum(mix64((data.astype(np.uint64) << np.uint64(40)) + place))])
    sums = mixed[offsets[1:]] - mixed[offsets[:-1]]
    return mix64(sums + np.diff(offsets).astype(np.uint64)).view(np.int64).tolist()


def scan_blocks(docs: DataFrame) -> DataFrame:
    """(seed, code, doc) of all blocks, equal ones of a document once.

    A task leaves out copies of a text it has seen with a smaller id.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, offsets = utf8(batch.column(1))
            for start, stop in byte_slices(offsets):
                part, bounds = data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start]
                names = text_hashes(part, bounds)
                for name, doc in zip(names, ids[start:stop].tolist()):
                    seen[name] = min(doc, seen.get(name, doc))
                smallest = np.array([seen[n] for n in names])
                blocks = find_blocks(part, bounds)
                doc = ids[start:stop][blocks.row]
                keep = np.zeros(len(doc), bool)
                keep[np.unique(blocks.names(), return_index=True)[1]] = True
                keep &= doc == smallest[blocks.row] if len(doc) else True
                yield pa.record_batch([pa.array(x[keep]) for x in (blocks.seed, blocks.code, doc)],
                                      names=["seed", "code", "doc"])

    return docs.mapInArrow(run, "seed long, code long, doc long")


def repeated_blocks(rows: DataFrame) -> DataFrame:
    """(doc, seed, code, repeats) of the blocks whose seed occurs in several places.

    ``repeats`` tells that an equal block is in a smaller document. Of seeds with
    several unequal blocks, the blocks of the smallest document follow too, with
    ``repeats`` false. Rows are dealt by seed and sorted, and pass through in one
    stream; of a seed's rows only one is held.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        held, several = None, False  # rows carried over; whether their seed had unequal blocks
        for batch in batches:
            seed, code, doc = (c.to_numpy() for c in batch.columns)
            carried = 0
            if held is not None:
                carried = len(held[0])
                seed, code, doc = (np.concatenate([h, c]) for h, c in zip(held, (seed, code, doc)))
            new_seed = np.concatenate([[True], seed[1:] != seed[:-1]])
            new_block = new_seed | np.concatenate([[True], code[1:] != code[:-1]])
            group = np.cumsum(new_seed) - 1
            start = np.flatnonzero(new_block)
            smallest = doc[start][np.cumsum(new_block) - 1]
            unequal = np.bincount(group, new_block) > 1
            unequal[0] |= several
            repeats = doc > smallest
            given = np.zeros(len(seed), bool)
            given[:carried] = several
            last_seed, last_block = group == group[-1], np.arange(len(seed)) >= start[-1]
            out = ~given & (repeats | unequal[group])
            yield pa.record_batch([pa.array(doc[out]), pa.array(seed[out]), pa.array(code[out]), pa.array(repeats[out])],
                                  names=["doc", "seed", "code", "repeats"])
            several = bool(unequal[-1])
            carry = np.array([start[-1]]) if several else np.flatnonzero(last_seed & last_block & ~repeats)
            held = [x[carry] for x in (seed, code, doc)]

    dealt = rows.repartition("seed").sortWithinPartitions("seed", "code", "doc")
    return dealt.mapInArrow(run, "doc long, seed long, code long, repeats boolean")


def cut_blocks(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(seed, doc, first, lead, content, name): bytes of the wanted blocks, where their seed lies in
    them, and the hash of the text they are in."""
    per_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("seed", "code")).alias("wanted"))
    joined = docs.join(per_doc, "doc").select("doc", "text", "wanted")

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for start, stop in byte_slices(offsets):
                part, bounds = data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start]
                blocks = find_blocks(part, bounds)
                lists = batch.column(2).slice(start, stop - start)
                ask = lists.flatten()
                holder = np.repeat(np.arange(stop - start), lists.value_lengths().to_numpy(zero_copy_only=False))
                asked = block_names(holder, ask.field("seed").to_numpy(), ask.field("code").to_numpy())
                at = np.flatnonzero(np.isin(blocks.names(), asked))
                owner = blocks.row[at]
                names = np.array(text_hashes(part, bounds), np.int64)
                first, size = blocks.first[at], blocks.last[at] - blocks.first[at] + LENGTH
                content = part[ragged(bounds[owner] + first, size)]
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                yield pa.record_batch(
                    [pa.array(blocks.seed[at]), pa.array(batch.column(0).to_numpy()[start:stop][owner]),
                     pa.array(first), pa.array((blocks.at[at] - first).astype(np.int32)),
                     pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends.tobytes()),
                                                                  pa.py_buffer(content.tobytes())]),
                     pa.array(names[owner])],
                    names=["seed", "doc", "first", "lead", "content", "name"])

    return joined.mapInArrow(run, "seed long, doc long, first long, lead int, content binary, name long")


class Shard:
    """Sorted suffixes of some strings, by their first characters, and their transform.

    Characters are bytes plus one; every string ends with 0.
    """

    def __init__(self, strings: np.ndarray, ends: np.ndarray):
        """``strings`` holds all of them with their terminators, which lie at ``ends``."""
        n = len(strings)
        self.left = np.repeat(ends, np.diff(np.concatenate([[-1], ends]))) - np.arange(n)  # characters before the end
        padded = np.concatenate([strings.astype(np.int64), np.zeros(64, np.int64)])
        key = np.zeros(n, np.int64)
        for i in range(7):
            key = (key << 9) | np.where(self.left >= i, padded[i:i + n], 0)
        depth = 7
        while depth < LENGTH:
            rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
            after = np.concatenate([rank, np.zeros(depth, np.int64)])[depth:]
            key = (rank << 32) | np.where(self.left >= depth, after + 1, 0)
            depth *= 2
        self.order = np.argsort(key)
        before = np.concatenate([[0], strings[:-1]])
        self.transform = before[self.order].astype(np.uint16)
        self.strings = len(ends)


def merged_intervals(shards: list[Shard]) -> np.ndarray:
    """Interval of each suffix, shard after shard in their orders: equal iff LENGTH characters are."""
    sizes = np.array([len(s.order) for s in shards])
    transform = np.concatenate([s.transform for s in shards])
    ends = np.repeat(np.arange(len(shards)), [s.strings for s in shards]).astype(np.uint16)
    interleave = np.repeat(np.arange(len(shards)), sizes).astype(np.uint16)
    interval = np.zeros(len(transform), np.int64)
    read = np.empty(len(transform), np.uint16)
    for _ in range(LENGTH):
        # Read each shard's transform in the order of the interleave, then group by what was read.
        by_shard = np.argsort(interleave, kind="stable")
        read[by_shard] = transform
        moved = np.argsort(read, kind="stable")
        interleave, char, source = interleave[moved], read[moved], interval[moved]
        new = np.concatenate([[True], (char[1:] != char[:-1]) | (source[1:] != source[:-1])])
        new[:len(ends) + 1] = True  # terminators are all different
        interleave[:len(ends)] = ends
        interval = np.cumsum(new) - 1
    return interval[np.argsort(interleave, kind="stable")]


def smallest_documents(strings: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each start of LENGTH bytes in the strings, the smallest document with the same bytes.

    ``strings`` has the bytes of strings of ``sizes`` >= LENGTH one after another;
    ``docs`` is the smallest document of each.
    """
    begins = np.cumsum(sizes) - sizes
    shards, owners, starts = [], [], []
    first = 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(begins, begins[first] + SHARD_BYTES)))
        own = sizes[first:last]
        chars = np.zeros(int(own.sum()) + len(own), np.uint16)
        ends = np.cumsum(own + 1) - 1
        chars[ragged(ends - own, own)] = strings[begins[first]:begins[first] + own.sum()].astype(np.uint16) + 1
        shard = Shard(chars, ends)
        owner = np.repeat(np.arange(first, last), own + 1)[shard.order]
        place = shard.order - (ends - own)[owner - first]
        shards.append(shard)
        owners.append(np.where(shard.left[shard.order] >= LENGTH, owner, -1))
        starts.append(place)
        first = last
    interval = merged_intervals(shards)
    owner, place = np.concatenate(owners), np.concatenate(starts)
    whole = owner >= 0
    interval, owner, place = interval[whole], owner[whole], place[whole]
    smallest = np.full(int(interval.max()) + 1, NO_ID)
    np.minimum.at(smallest, interval, docs[owner])
    counts = sizes - LENGTH + 1
    out = np.empty(int(counts.sum()), np.int64)
    out[(np.cumsum(counts) - counts)[owner] + place] = smallest[interval]
    return out


def _shared(group: np.ndarray, context: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Longest prefix that each row's context shares with any other row of its group."""
    words = np.ascontiguousarray(context).view(">u8").astype(np.uint64)
    order = np.lexsort((size, *words.T[::-1], group))
    a, b = order[:-1], order[1:]
    unlike = context[a] != context[b]
    common = np.where(unlike.any(axis=1), unlike.argmax(axis=1), context.shape[1])
    common = np.where(group[a] == group[b], np.minimum(common, np.minimum(size[a], size[b])), -1)
    out = np.full(len(group), -1)
    np.maximum.at(out, a, common)
    np.maximum.at(out, b, common)
    return out


def repeated_strings(seed, doc, first, lead, data, offsets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, from, to): bytes of blocks covered by strings that start in smaller documents too.

    Takes all blocks of some seeds.
    """
    size = np.diff(offsets)
    group = np.unique(seed, return_inverse=True)[1]
    before, after = lead, size - lead - SEED
    width = 40  # at least LENGTH - SEED, in words of eight bytes
    pad = np.concatenate([np.zeros(width, np.uint8), data, np.zeros(width, np.uint8)])
    seed_at = offsets[:-1] + lead + width
    column = np.arange(width)
    right = np.where(column < after[:, None], pad[seed_at[:, None] + SEED + column], 0).astype(np.uint8)
    left = np.where(column < before[:, None], pad[seed_at[:, None] - 1 - column], 0).astype(np.uint8)
    r, l = _shared(group, right, after), _shared(group, left, before)

    # Cut every block to what may be shared; too short a rest repeats nothing.
    keep = np.flatnonzero((r >= 0) & (l + SEED + r >= LENGTH))
    none = np.empty(0, np.int64)
    if not len(keep):
        return none, none, none
    begin, length = offsets[:-1][keep] + lead[keep] - l[keep], l[keep] + SEED + r[keep]
    start_in_doc = first[keep] + lead[keep] - l[keep]
    strings = data[ragged(begin, length)]
    ends = np.cumsum(length)
    powers = np.full(len(strings), _BASE)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    back = np.full(len(strings), _INVERSE)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((strings.astype(np.uint64) + np.uint64(1)) * powers)])
    name = mix64((sums[ends] - sums[ends - length]) * back[ends - length] + length.astype(np.uint64) * _BASE)

    # Equal strings are one; the smallest document stands for all.
    order = np.lexsort((doc[keep], name))
    fresh = np.concatenate([[True], name[order][1:] != name[order][:-1]])
    known = np.empty(len(keep), np.int64)
    known[order] = np.cumsum(fresh) - 1
    one = order[fresh]
    smallest = smallest_documents(strings[ragged((ends - length)[one], length[one])], length[one], doc[keep][one])

    counts = length - LENGTH + 1
    base = (np.cumsum(counts[one]) - counts[one])[known]
    place = ragged(base, counts)
    owner = np.repeat(np.arange(len(keep)), counts)
    start = start_in_doc[owner] + ragged(np.zeros(len(keep), np.int64), counts)
    gone = doc[keep][owner] > smallest[place]
    owner, start = owner[gone], start[gone]
    if not len(owner):
        return none, none, none
    fresh = np.concatenate([[True], (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)])
    at = np.flatnonzero(fresh)
    return keep[owner[at]], start[at], start[np.append(at[1:], len(start)) - 1] + LENGTH


def merge_blocks(blocks: DataFrame) -> DataFrame:
    """(doc, from, to, name) from blocks dealt by seed: complete seeds are merged MERGE_BYTES at a time."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush(rows: pa.Table):
            if not rows.num_rows:
                return
            seed, doc, first, lead = (rows.column(i).to_numpy() for i in range(4))
            content = rows.column(4).combine_chunks().cast(pa.large_binary())
            offsets = np.frombuffer(content.buffers()[1], np.int64)[content.offset:content.offset + len(content) + 1]
            data = np.frombuffer(content.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
            block, *run = repeated_strings(seed, doc, first, lead.astype(np.int64), data, offsets - offsets[0])
            out = (doc[block], *run, rows.column(5).to_numpy()[block])
            yield pa.record_batch([pa.array(x) for x in out], names=["doc", "from", "to", "name"])

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < MERGE_BYTES:
                continue
            rows = pa.Table.from_batches(held)
            seed = rows.column(0).to_numpy()
            last = int(np.searchsorted(seed, seed[-1]))  # the last seed may go on
            for start, stop in _by_bytes(seed, rows, last):
                yield from flush(rows.slice(start, stop - start))
            held = rows.slice(last).to_batches()
            size = sum(b.nbytes for b in held)
        if held:
            rows = pa.Table.from_batches(held)
            for start, stop in _by_bytes(rows.column(0).to_numpy(), rows, rows.num_rows):
                yield from flush(rows.slice(start, stop - start))

    return (blocks.repartition("seed").sortWithinPartitions("seed")
            .mapInArrow(run, "doc long, `from` long, `to` long, name long"))


def _by_bytes(seed: np.ndarray, rows: pa.Table, stop: int) -> Iterator[tuple[int, int]]:
    """Ranges of complete seeds of about MERGE_BYTES below row ``stop``."""
    if not stop:
        return
    sizes = pa.compute.binary_length(rows.column(4)).to_numpy()[:stop]
    part = np.cumsum(sizes) // MERGE_BYTES
    first = np.flatnonzero(np.concatenate([[True], seed[1:stop] != seed[:stop - 1]]))
    cuts = first[np.concatenate([[True], part[first][1:] != part[first][:-1]])].tolist() + [stop]
    yield from zip(cuts[:-1], cuts[1:])


def group_strings(blocks: DataFrame) -> DataFrame:
    """(doc, from, to, name) of the blocks of very frequent seeds, by one aggregate over their strings.

    For seeds with more blocks than a task should hold. Equal strings combine
    map-side, unequal ones spread over all tasks.
    """
    starts = F.explode(F.sequence(F.lit(0), F.length("content") - LENGTH)).alias("skip")
    each = blocks.select("doc", "first", "content", "name", starts).select(
        "doc", "name", (F.col("first") + F.col("skip")).alias("from"),
        F.substring("content", F.col("skip") + 1, F.lit(LENGTH)).alias("string"))
    smallest = each.groupBy("string").agg(F.min("doc").alias("smallest"), F.max("doc").alias("largest"))
    return (each.join(smallest.filter("smallest < largest"), "string").filter("doc > smallest")
            .select("doc", "from", (F.col("from") + LENGTH).alias("to"), "name"))


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", keep_rows: bool = False) -> DataFrame:
    """(key, n_bytes, kept binary, spans array<struct<from, to>>) per document, with
    ``keep_rows`` also ``row``, the input row, and ``kept_text``, of which a
    character that lost some of its bytes is no part.

    ``spans`` are the maximal runs of removed bytes of the UTF-8 text and ``kept``
    the others. Strings are judged on the input, overlaps count, and no string
    crosses documents. A null text is empty. Keys are whole numbers; a null key
    counts as larger than all others. Rows that repeat a key get a row each and
    do not count against each other. An empty table gives no rows; other columns
    are not read.
    """
    number = F.coalesce(F.col(key).cast("long"), F.lit(NO_ID))
    source = docs.select(number.alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    repeated = cut_lineage(repeated_blocks(scan_blocks(source)))
    release(docs.sparkSession)
    unequal = repeated.filter(~F.col("repeats")).select("doc", "seed", "code")
    large = cut_lineage(unequal.groupBy("seed").count().filter(F.col("count") > LARGE_SEED).select("seed"))
    blocks = cut_lineage(cut_blocks(source, unequal))
    release(docs.sparkSession)
    runs = cut_lineage(merge_blocks(blocks.join(large, "seed", "left_anti").select(*blocks.columns))
                       .union(group_strings(blocks.join(large, "seed"))))
    discard(blocks, large)
    release(docs.sparkSession)

    # Copies of a smaller document's text go as a whole.
    names = cut_lineage(source.mapInArrow(_names, "doc long, name long"))
    copies = names.join(names.groupBy("name").agg(F.min("doc").alias("smallest")), "name").filter(
        "doc > smallest").select("doc", F.col("name").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).alias("kind"),
        F.col("name").alias("text_name"))
    marks = (copies
             .union(repeated.filter("repeats").select("doc", "seed", "code", F.lit(1), F.lit(0).cast("long")))
             .union(runs.select("doc", "from", "to", F.lit(2), "name"))
             .groupBy("doc").agg(F.collect_list(F.struct("a", "b", "kind", "text_name")).alias("marks")))
    kind = docs.schema[key].dataType
    whole = ["row"] if keep_rows else []
    if keep_rows:
        source = docs.select(number.alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                             F.struct("*").alias("row"))
    joined = source.join(marks, "doc", "left").select("doc", "text", "marks", *whole)
    span = T.StructType().add("from", "long").add("to", "long")
    schema = (joined.drop("text", "marks").schema.add("n_bytes", "long").add("kept", "binary")
              .add("spans", T.ArrayType(span)).add("kept_text", "string"))
    return joined.mapInArrow(_apply, schema).select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).cast(kind).alias(key), "n_bytes", "kept", "spans",
        *(["row", "kept_text"] if keep_rows else []))


def _names(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        names = [n for start, stop in byte_slices(offsets)
                 for n in text_hashes(data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start])]
        yield pa.record_batch([batch.column(0), pa.array(names, pa.int64())], names=["doc", "name"])


def _apply(batches) -> Iterator[pa.RecordBatch]:
    """Cut the marked bytes out of the texts."""
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for start, stop in byte_slices(offsets):
            part, bounds = data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start]
            n = stop - start
            lists = batch.column(2).slice(start, n)
            counts = np.array([x or 0 for x in lists.value_lengths().to_pylist()], np.int64)
            marks = lists.flatten()
            a, b, kind, text_name = (marks.field(f).to_numpy() for f in ("a", "b", "kind", "text_name"))
            owner = np.repeat(np.arange(n), counts)
            blocks = find_blocks(part, bounds)
            lengths = np.diff(bounds)

            # Rows that share an id may differ: places hold for one text only, equal blocks for all.
            own_text = np.array(text_hashes(part, bounds), np.int64)[owner] == text_name
            copied = (kind == 0) & (lengths[owner] >= LENGTH) & own_text
            gone_whole = kind == 1
            block = np.flatnonzero(np.isin(blocks.names(), block_names(owner[gone_whole], a[gone_whole], b[gone_whole])))
            run = (kind == 2) & own_text
            begin = np.concatenate([bounds[owner[copied]], bounds[blocks.row[block]] + blocks.first[block],
                                    bounds[owner[run]] + a[run]])
            end = np.concatenate([bounds[owner[copied] + 1], bounds[blocks.row[block]] + blocks.last[block] + LENGTH,
                                  bounds[owner[run]] + b[run]])
            depth = np.bincount(begin, minlength=len(part) + 1) - np.bincount(end, minlength=len(part) + 1)
            gone = np.cumsum(depth)[:len(part)] > 0
            kept = part[~gone]
            sizes = np.concatenate([[0], np.cumsum(~gone)])[bounds]

            edge = np.zeros(len(part), bool)
            edge[bounds[:-1][lengths > 0]] = True
            starts = np.flatnonzero(gone & (edge | ~np.concatenate([[False], gone[:-1]])))
            stops = np.flatnonzero(gone & (np.concatenate([edge[1:], [True]]) | ~np.concatenate([gone[1:], [False]]))) + 1
            holder = np.searchsorted(bounds, starts, side="right") - 1
            spans = pa.StructArray.from_arrays(
                [pa.array(starts - bounds[holder]), pa.array(stops - bounds[holder])], names=["from", "to"])
            places = np.searchsorted(holder, np.arange(n + 1)).astype(np.int32)
            rest = [c.slice(start, n) for c in (batch.column(0), *batch.columns[3:])]
            yield pa.record_batch(
                [*rest, pa.array(lengths.astype(np.int64)),
                 pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(sizes.astype(np.int32).tobytes()),
                                                        pa.py_buffer(kept.tobytes())]),
                 pa.ListArray.from_arrays(pa.array(places), spans),
                 pa.array([kept[x:y].tobytes().decode("utf-8", "ignore") for x, y in zip(sizes[:-1], sizes[1:])]
                          if batch.num_columns > 3 else [None] * n, pa.string())],
                names=["doc", *batch.schema.names[3:], "n_bytes", "kept", "spans", "kept_text"])


def digests(docs: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256)."""
    return remove_repeats(docs, key=key).select(
        key, "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
