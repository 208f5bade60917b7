"""N-gram Jaccard join with prefix filters under several global orders of the shingles.

If two sets are similar enough, then under any one order of all shingles their
prefixes share some shingles; the longer the prefixes, the more. The first order
puts frequent shingles last, so that a passage that many texts share brings no
candidates; texts that share enough prefix shingles under it are candidates.
They are verified only if their prefixes also meet under two further orders.

Equal sets are one class throughout. Classes in one component already need not
be compared again, so a large group of near copies is tied together by
comparing with changing leaders; what stays apart is then compared completely.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewell.llm.common import mix64, release, text_slices
from tracewell.operators.graph import connected_components
from tracewell.session import cut_lineage, discard

WORDS = 5
PERCENT = 80  # similar: 100 * intersection >= PERCENT * union
SHARED_PER = 40  # prefixes are longer than one shingle in common needs by one in so many
FREQUENT = 2  # texts from which a shingle counts as frequent
FREQUENT_SLOTS = 1 << 22  # frequent codes that are broadcast at most
CODE_BITS = 28  # of a shingle's hash, by which its texts are counted
LOW_BITS = 16  # of them, that travel as two bytes; the others name the row
FLUSH_CODES = 1_000_000
SLICE_CHARS = 1_000_000
BLOOM_BITS = 1 << 26
OTHER_ORDERS = (0x5BF03635, 0x2545F491)  # salts of the second and third order
PAIRS_PER_ROW = 4  # pairs per prefix row that are compared at once without a further round
FEW_FOUND = 0.05  # share of similar pairs in a round from which on another one is no use
LEADERS = 4  # per group, from the second round on

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def shingle_sets(texts: Sequence[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Distinct 64-bit hashes, ascending, of the runs of ``words`` words of each text.

    A text with fewer words has one hash, of all of them; one without words none.
    """
    joined = "\n".join(t or "" for t in texts) + "\n"
    data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]])))
    starts, ends = edge[::2], edge[1::2]
    sizes = np.array([len((t or "").encode("utf-8", "surrogatepass")) + 1 for t in texts], np.int64)
    bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))

    # Polynomial hash of each word, from running sums.
    powers = np.full(len(data), _BASE)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers)])
    back = np.full(len(data), _INVERSE)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    word = mix64((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))

    factors = mix64(np.arange(1, words + 2)) | np.uint64(1)
    run = np.zeros(max(len(word) - words + 1, 0), np.uint64)
    for i in range(words):
        run += word[i:i + len(run)] * factors[i]
    run = mix64(run)
    out = []
    for first, last in zip(bounds[:-1], bounds[1:]):
        n = last - first
        if n >= words:
            own = np.sort(run[first:last - words + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif n:
            short = (word[first:last] * factors[:n]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix64(short ^ factors[n:n + 1]))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def class_key(shingles: np.ndarray) -> int:
    """Signed 64-bit name of a set; with the set's size it identifies the set."""
    total = shingles.sum(dtype=np.uint64, keepdims=True) + np.uint64(len(shingles))
    return int(mix64(total).view(np.int64)[0])


def prefix_shared(n):
    """Prefix shingles that a set of ``n`` and any similar set of no smaller size have in common, at least."""
    return 1 + n // SHARED_PER


def prefix_length(n):
    """Length of the prefix of a set of ``n`` under any order.

    A similar set shares ceil(PERCENT n / 100) of the shingles. If the prefixes
    shared fewer than ``prefix_shared``, then what follows the one that ends
    first would have to make up for it, and it is too short for that.
    """
    return np.minimum(n - -(-PERCENT * n // 100) + prefix_shared(n), n)


class Orders:
    """Global orders of the shingles: by frequency class of their code, then by a salted hash."""

    def __init__(self, frequent: tuple[np.ndarray, np.ndarray]):
        self.codes, self.classes = frequent

    def prefix(self, shingles: np.ndarray, salt: int) -> np.ndarray:
        """The first shingles of a set, in their order."""
        rank = shingles if not salt else mix64(shingles ^ np.uint64(salt))
        rank = rank >> np.uint64(6)
        if len(self.codes):
            code = (shingles >> np.uint64(64 - CODE_BITS)).astype(np.uint32)
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            rank |= np.where(self.codes[at] == code, self.classes[at], 0).astype(np.uint64) << np.uint64(58)
        p = int(prefix_length(len(shingles)))
        first = np.argpartition(rank, p - 1)[:p] if p < len(shingles) else np.arange(p)
        return shingles[first[np.argsort(rank[first])]]


def _scan(docs: DataFrame, schema: str, fn) -> DataFrame:
    """``fn(keys, sets)`` over slices of (key, text) rows."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, stop in text_slices(texts, SLICE_CHARS):
                yield fn(batch.column(0).slice(start, stop - start), shingle_sets(texts[start:stop]))

    return docs.select("doc", "text").mapInArrow(run, schema)


def _once(sets: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """(class, set) of the sets that are not empty, equal ones once."""
    seen = set()
    for shingles in sets:
        if len(shingles) and (key := class_key(shingles)) not in seen:
            seen.add(key)
            yield key, shingles


def classes_of(docs: DataFrame) -> DataFrame:
    """(doc, class, n) per row; the class of an empty set is null."""
    kind = docs.schema["doc"].dataType.simpleString()

    def fn(keys, sets):
        return pa.record_batch(
            [keys, pa.array([class_key(s) if len(s) else None for s in sets], pa.int64()),
             pa.array([len(s) for s in sets], pa.int64())], names=["doc", "class", "n"])

    return _scan(docs, f"doc {kind}, class long, n long", fn)


def frequent_codes(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(codes ascending, log2 of their number of texts), for those of FREQUENT texts or more.

    A code is the first CODE_BITS bits of a shingle's hash. Counts whole sets:
    were only some shingles of a passage counted, the prefixes of all texts that
    share it would be made of the others. At most FREQUENT_SLOTS codes are
    returned: the bound rises until they fit. It only shapes the order of the
    shingles, as do shingles with a code in common; any order gives the same links.

    A code travels as two bytes, in a row of all that have the same upper bits.
    """

    def rows(held: list[np.ndarray]) -> pa.RecordBatch:
        codes = np.sort(np.concatenate([np.empty(0, np.uint32), *held]))
        upper = codes >> np.uint32(LOW_BITS)
        first = np.flatnonzero(np.diff(upper.astype(np.int64), prepend=-1))
        lows = (codes & np.uint32((1 << LOW_BITS) - 1)).astype(np.uint16)
        ends = np.append(first, len(codes)).astype(np.int32) * 2
        lows = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(lows)])
        return pa.record_batch([pa.array(upper[first].astype(np.int32)), lows], names=["upper", "lows"])

    def deal(batches) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for start, stop in text_slices(texts, SLICE_CHARS):
                for _, shingles in _once(shingle_sets(texts[start:stop])):
                    held.append((shingles >> np.uint64(64 - CODE_BITS)).astype(np.uint32))
                    n += len(shingles)
                if n > FLUSH_CODES:
                    yield rows(held)
                    held, n = [], 0
        yield rows(held)

    def found(upper: int, counts: np.ndarray) -> pa.RecordBatch:
        lows = np.flatnonzero(counts >= FREQUENT)
        return pa.record_batch([pa.array(upper << LOW_BITS | lows), pa.array(counts[lows])], names=["code", "n"])

    def count(batches) -> Iterator[pa.RecordBatch]:
        upper, counts = None, None  # rows of the same upper bits follow each other
        for batch in batches:
            for name, lows in zip(batch.column(0).to_pylist(), batch.column(1)):
                if name != upper:
                    if upper is not None:
                        yield found(upper, counts)
                    upper, counts = name, np.zeros(1 << LOW_BITS, np.int64)
                counts += np.bincount(np.frombuffer(lows.as_buffer(), np.uint16), minlength=1 << LOW_BITS)
        if upper is not None:
            yield found(upper, counts)

    dealt = docs.select("text").mapInArrow(deal, "upper int, lows binary").repartition("upper")
    counted = cut_lineage(dealt.sortWithinPartitions("upper").mapInArrow(count, "code long, n long"))
    bound = FREQUENT
    while counted.filter(F.col("n") >= bound).count() > FREQUENT_SLOTS:
        bound *= 2
    table = counted.filter(F.col("n") >= bound).select("code", F.floor(F.log2("n")).cast("int").alias("class")).toArrow()
    discard(counted)
    codes = table.column(0).to_numpy().astype(np.uint32)
    order = np.argsort(codes)
    return codes[order], table.column(1).to_numpy().astype(np.uint8)[order]


def prefix_rows(docs: DataFrame, frequent) -> DataFrame:
    """(shingle, class, n, rest): the prefix of every set under the first order.

    ``rest`` is the number of shingles of the set that come later in the order.
    """

    def fn(keys, sets):
        orders = Orders(frequent.value)
        rows = [(key, len(s), orders.prefix(s, 0)) for key, s in _once(sets)]
        sizes = [len(p) for _, _, p in rows]
        shingles = np.concatenate([p for _, _, p in rows]) if rows else np.empty(0, np.uint64)
        n = np.repeat(np.array([n for _, n, _ in rows], np.int32), sizes)
        at = np.concatenate([np.arange(size, dtype=np.int32) for size in sizes]) if rows else n
        return pa.record_batch(
            [pa.array(shingles.view(np.int64)), pa.array(np.repeat(np.array([k for k, _, _ in rows], np.int64), sizes)),
             pa.array(n), pa.array(n - 1 - at)], names=["shingle", "class", "n", "rest"])

    return _scan(docs, "shingle long, class long, n int, rest int", fn)


def shared_only(rows: DataFrame) -> DataFrame:
    """Distinct rows whose shingle occurs in two classes or more.

    Rows are dealt by shingle and sorted, and pass through in one stream: of a
    group, whatever its size, only the last row is held.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        held, open_group = None, False  # the last row, if its group has no other so far
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            if held is not None:
                columns = [np.concatenate([[h], c]).astype(c.dtype) for h, c in zip(held, columns)]
            shingle, key = columns[:2]
            new_row = np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (key[1:] != key[:-1])])
            columns = [c[new_row] for c in columns]
            shingle = columns[0]
            as_before = np.concatenate([[False], shingle[1:] == shingle[:-1]])
            keep = as_before | np.concatenate([shingle[1:] == shingle[:-1], [False]])
            # The first row is the held one. It was given out before if its group was open.
            if held is not None and open_group:
                keep[0] = False
                keep[1:] |= shingle[1:] == shingle[0]
            open_group = bool(as_before[-1]) or (len(shingle) == 1 and open_group)
            held = [c[-1] for c in columns]
            yield pa.record_batch([pa.array(c[keep]) for c in columns], names=["shingle", "class", "n", "rest"])

    dealt = rows.repartition("shingle").sortWithinPartitions("shingle", "class")
    return dealt.mapInArrow(run, "shingle long, class long, n int, rest int")


def _places(keys: np.ndarray) -> np.ndarray:
    """Two Bloom filter places per class."""
    return np.concatenate([mix64(keys.view(np.uint64) + np.uint64(i)) % np.uint64(BLOOM_BITS) for i in (1, 2)])


def bloom_filter(keys: DataFrame) -> np.ndarray:
    """Bloom filter of BLOOM_BITS bits over the column ``class``."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.unique(_places(batch.column(0).to_numpy()))
            at = (places >> np.uint64(6)).astype(np.int32)
            first = np.flatnonzero(np.diff(at, prepend=-1))
            bits = np.bitwise_or.reduceat(np.uint64(1) << (places & np.uint64(63)), first)
            yield pa.record_batch([pa.array(at[first]), pa.array(bits.view(np.int64))], names=["at", "bits"])

    words = (keys.select("class").distinct().mapInArrow(run, "at int, bits long")
             .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow())
    bloom = np.zeros(BLOOM_BITS // 64, np.int64)
    bloom[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return bloom.view(np.uint64)


def may_hold(bloom: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False per key that the Bloom filter is sure not to hold."""
    places = _places(keys).reshape(2, -1)
    return ((bloom[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63))) & np.uint64(1)).all(axis=0)


def needed_sets(docs: DataFrame, rows: DataFrame, frequent) -> DataFrame:
    """(class, shingles, second, third, size) of all classes in ``rows`` and perhaps some more, as binaries.

    ``second`` and ``third`` are the prefixes under the other orders. The Bloom
    filter has a fixed size and is broadcast; it keeps most other sets out of
    the shuffle.
    """
    bloom = docs.sparkSession.sparkContext.broadcast(bloom_filter(rows))

    def fn(keys, sets):
        orders = Orders(frequent.value)
        known = list(_once(sets))
        names = np.array([k for k, _ in known], np.int64)
        places = _places(names).reshape(2, -1)
        hit = ((bloom.value[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63))) & np.uint64(1)).all(axis=0)
        kept = [known[i][1] for i in np.flatnonzero(hit)]
        columns = [kept] + [[np.sort(orders.prefix(s, salt)) for s in kept] for salt in OTHER_ORDERS]
        columns.append([np.array([len(s)], np.uint64) for s in kept])
        return pa.record_batch(
            [pa.array(names[hit]), *[pa.array([s.tobytes() for s in c], pa.binary()) for c in columns]],
            names=["class", "shingles", "second", "third", "size"])

    return (_scan(docs, "class long, shingles binary, second binary, third binary, size binary", fn)
            .groupBy("class").agg(*[F.first(c).alias(c) for c in ("shingles", "second", "third", "size")]))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Number of values that two ascending arrays of distinct values share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = common(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, is_similar) of the pairs (a, b): prefixes under the other orders first, then the sets of what is left."""

    def sides(pairs: DataFrame, parts: tuple[str, ...]) -> DataFrame:
        ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        wanted = sets.join(ends, "class", "left_semi")  # the same for both sides, so that it is dealt once
        left = wanted.select(F.col("class").alias("a"), F.struct(*parts).alias("of_a"))
        right = wanted.select(F.col("class").alias("b"), F.struct(*parts).alias("of_b"))
        return pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")

    def told(batches, fn) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [part for side in (2, 3) for part in batch.column(side).flatten()]
            out = [fn(*[np.frombuffer(c[row].as_buffer(), np.uint64) for c in columns]) for row in range(batch.num_rows)]
            yield pa.record_batch([*batch.columns[:2], pa.array(out, pa.bool_())], names=["a", "b", "is_similar"])

    def meet(second, third, n, b_second, b_third, b_n):
        least = prefix_shared(min(int(n[0]), int(b_n[0])))
        return common(second, b_second) >= least and common(third, b_third) >= least

    schema = "a long, b long, is_similar boolean"
    met = cut_lineage(sides(pairs, ("second", "third", "size")).mapInArrow(lambda x: told(x, meet), schema))
    outcome = sides(met.filter("is_similar").select("a", "b"), ("shingles",)).mapInArrow(
        lambda x: told(x, similar), schema)
    return outcome.union(met.filter("NOT is_similar"))


def shared_enough(n, m, shared):
    """Whether sets of ``n`` and ``m`` shingles that share so many in their prefixes may be similar."""
    least = F.least(n, m)
    return (100 * least >= PERCENT * F.greatest(n, m)) & (shared >= needed(least))


def needed(n):
    """Column form of ``prefix_shared``."""
    return 1 + F.floor(n / SHARED_PER)


def after_prefix(n):
    """Number of shingles of a set of ``n`` that are not in its prefix (column form of ``prefix_length``)."""
    return F.greatest(F.ceil(n * PERCENT / 100) - needed(n), F.lit(0))


def reachable(n, m, most):
    """Whether sets of ``n`` and ``m`` shingles would be similar with ``most`` in common."""
    return (100 + PERCENT) * most >= PERCENT * (n.cast("long") + m)


def in_reach(n, rest, m, m_rest):
    """Whether sets that share a prefix shingle, after which ``rest`` and ``m_rest`` of theirs follow, may be similar.

    It holds for the first ``needed`` shingles that similar sets share: at
    each of them, so many are shared up to it and the others come later in both.
    """
    least = F.least(n, m)
    return (100 * least >= PERCENT * F.greatest(n, m)) & reachable(n, m, needed(least) + F.least(rest, m_rest))


def promising(rows: DataFrame) -> DataFrame:
    """Rows of the classes with enough shared prefix shingles to be similar to any other."""
    shared = F.count(F.lit(1)).over(Window.partitionBy("class"))
    return (rows.withColumn("_shared", shared)
            .filter(F.col("_shared") >= needed(F.ceil(F.col("n") * PERCENT / 100))).drop("_shared"))


def met_pairs(met: DataFrame) -> DataFrame:
    """(a, b, n, b_n, shared, first, last) of the pairs in reach, from a row for each shingle at which two classes meet."""
    rest = F.least("rest", "b_rest")
    return (met.filter(in_reach(F.col("n"), F.col("rest"), F.col("b_n"), F.col("b_rest")))
            .groupBy(F.least("class", "b").alias("a"), F.greatest("class", "b").alias("b"))
            .agg(F.first("n").alias("n"), F.first("b_n").alias("b_n"), F.count(F.lit(1)).alias("shared"),
                 F.max(rest).alias("first"), F.min(rest).alias("last")))


def still_apart(rows: DataFrame, component: DataFrame) -> DataFrame:
    """Promising rows of groups of two components or more, with ``component`` and ``away``.

    ``away`` adds up to the pairs of a group that are not in one component. Rows
    are dealt by class, by shingle and by class, once each.
    """
    state = rows.join(component, "class", "left").withColumn("component", F.coalesce("component", "class"))
    n = F.count(F.lit(1))
    away = (n.over(Window.partitionBy("shingle")) - n.over(Window.partitionBy("shingle", "component"))) / 2
    return promising(state.repartition("shingle").withColumn("away", away).filter("away > 0"))


def linked_classes(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(class, component) for the classes in ``rows`` that are similar to any other.

    Rounds compare the classes of a prefix shingle's group with a few leaders,
    different ones every round, and join what is similar into components. The
    first round, before there is any component, takes one: the class with the
    fewest shingles before the shared one, which is nearest to what the group has
    in common. No pair is compared twice, and groups of one component leave. When
    what is still apart makes few pairs, by the share that was in reach of a
    leader, or a round finds next to nothing new, all pairs of a group from
    different components are compared.

    In all rounds the places of a shared shingle in both orders bound what a
    pair can share. Rare shingles come first, so a text that differs too much
    from its group has too few left when it meets the group.
    """
    spark = rows.sparkSession
    links = spark.range(0).selectExpr("id AS a", "id AS b")
    tried = links
    component = spark.range(0).selectExpr("id AS class", "id AS component")
    n_rows, turn, last_round = rows.count(), 0, False
    met, n_met = _with_nearest(rows).filter("class <> b"), n_rows
    while True:
        met = cut_lineage(met_pairs(met))
        share = (met.agg(F.sum("shared")).first()[0] or 0) / max(n_met, 1)
        # Nothing is shared before the first, and what is shared out of reach comes after the last.
        most = F.least(1 + F.col("first"), F.col("shared") + F.col("last"))
        pairs = cut_lineage(
            met.filter(shared_enough(F.col("n"), F.col("b_n"), F.col("shared")))
            .filter(reachable(F.col("n"), F.col("b_n"), most)).select("a", "b").join(tried, ["a", "b"], "left_anti"))
        outcome = cut_lineage(compared(pairs, sets))
        tried, found = tried.union(outcome.select("a", "b")), outcome.filter("is_similar").select("a", "b")
        discard(met)
        release(spark)
        n_found, n_pairs = found.count(), outcome.count()
        if n_found:
            links = links.union(found)
            ends = links.select(F.lit("link").alias("entity_type"), F.col("b").alias("entity_id"),
                                F.explode(F.array("a", "b")).alias("member"))
            component = cut_lineage(connected_components(ends).select(
                F.col("member").alias("class"), "component"))
        if last_round:
            return component
        apart = cut_lineage(still_apart(rows, component))
        release(spark)
        n_apart, n_away = apart.agg(F.count(F.lit(1)), F.sum("away")).first()
        if not n_apart:
            return component
        last_round = n_found <= FEW_FOUND * n_pairs or share * n_away <= PAIRS_PER_ROW * n_rows
        if last_round:
            other = apart.select("shingle", *[F.col(c).alias("b" if c == "class" else f"b_{c}")
                                              for c in ("class", "n", "rest", "component")])
            met = apart.join(other, "shingle").filter("component < b_component")
        else:
            met = apart.join(_leaders(apart, turn), "shingle").filter("component <> b_component")
        n_met, turn = n_apart * LEADERS, turn + 1
        rows = apart.select("shingle", "class", "n", "rest")


def _with_nearest(rows: DataFrame) -> DataFrame:
    """``rows`` with the first leader of their shingle's group as (b, b_n, b_rest)."""
    ordered = Window.partitionBy("shingle").orderBy(F.desc("rest"), F.xxhash64("class"))
    return rows.select("*", *[F.first(c).over(ordered).alias("b" if c == "class" else f"b_{c}")
                              for c in ("class", "n", "rest")])


def _leaders(rows: DataFrame, turn: int) -> DataFrame:
    """(shingle, b, b_n, b_rest, b_component): the leaders of every shingle's group, each once."""
    leader = F.struct(F.col("class").alias("b"), F.col("n").alias("b_n"), F.col("rest").alias("b_rest"),
                      F.col("component").alias("b_component"))
    orders = [F.xxhash64(F.col("class"), F.lit(turn * LEADERS + i)) for i in range(LEADERS)]
    return (rows.groupBy("shingle").agg(F.array_distinct(F.array(*[F.max_by(leader, o) for o in orders])).alias("all"))
            .select("shingle", F.explode("all").alias("one")).select("shingle", "one.*"))


def join(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) per document.

    Documents link when 100 * intersection >= PERCENT * union of their sets of
    distinct WORDS-word shingles (words lower-cased from A to Z; a shorter text
    has one shingle, all its words). ``component_id`` is the smallest key that
    links lead to, the document's own included. Null, empty and wordless texts
    have no shingle and link with nothing. A null key is never a component's
    name unless the document is alone. Rows that repeat a key get a row each;
    other columns are not read; an empty table gives no rows.

    Shingles of 64 bits stand for word runs. Texts are never shuffled: prefixes
    (some 22 % of the shingles) and the sets of candidates are. All driver reads
    have a fixed bound (FREQUENT_SLOTS, BLOOM_BITS).
    """
    source = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    classes = cut_lineage(classes_of(source))
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_codes(source))
    release(docs.sparkSession)
    shared = cut_lineage(shared_only(prefix_rows(source, frequent)))
    rows = cut_lineage(promising(shared))
    discard(shared)
    release(docs.sparkSession)
    sets = cut_lineage(needed_sets(source, rows, frequent))
    release(docs.sparkSession)
    component = linked_classes(rows, sets)
    discard(rows, sets)

    named = classes.filter("class IS NOT NULL").join(component, "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    smallest = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    labels = component.join(smallest, "component").select("class", "component_id").union(
        smallest.join(component.select(F.col("class").alias("component")), "component", "left_anti")
        .select(F.col("component").alias("class"), "component_id"))
    return classes.join(labels, "class", "left").select(
        F.col("doc").alias(key), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc").alias("component_id"))
