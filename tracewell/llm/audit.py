"""What an order of filters does to a corpus: kept, removed and lost documents per step.

Filters A to D look at a text alone. Filter E asks whether a smaller document
has the same text, an existential self-join: a left-semi join on the hash, the
exact text and a smaller id. The ids it marks are joined to the failures of the
other filters by a union, and the combinations of failures of each document are
counted. Everything about any order of the filters follows from those counts,
at most 32 per source.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import map_batches
from tracewell.session import cut_lineage

FILTERS = "ABCDE"
BIT = {name: 1 << i for i, name in enumerate(FILTERS)}
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
LEAST_WORDS = 200
SLOT_ROWS = 200  # copies of one text are compared with its smallest document in slots of about so many
UPPER = bytes(range(ord("A"), ord("Z") + 1))
SPECIAL = b"#$%&*|"
CONTINUED = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no character


def failures(text: bytes) -> int:
    """Bits of the filters A to D that a UTF-8 text fails."""
    words = text.split()  # for bytes, runs of anything but \x20 and \x09-\x0D
    distinct = len(set(words))
    characters = len(text.translate(None, CONTINUED))
    capitals = len(text) - len(text.translate(None, UPPER))
    return (BIT["A"] * (len(words) < LEAST_WORDS) | BIT["B"] * (100 * distinct < 50 * len(words))
            | BIT["C"] * (100 * capitals > 2 * characters)
            | BIT["D"] * (len(text.translate(None, SPECIAL)) < len(text)))


def _with_failures(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    texts = batch.column(3).cast(pa.binary())
    bits = pa.array([failures(text.as_py()) for text in texts], pa.int32())
    yield pa.record_batch([*batch.columns[:3], bits], names=["doc", "part", "hash", "bits"])


def repeated(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc, part, hash) of the rows of ``texts`` whose text a smaller document has.

    ``rows`` has the same documents without their texts. Texts are read only of
    hashes with two or more ids, and reduced to the smallest id of each text
    before they are joined; the copies of a text are spread over slots, as many
    as their number asks for.
    """
    shared = cut_lineage(
        rows.groupBy("hash").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("doc").alias("n"))
        .filter("first < last")
        .select("hash", F.ceil(F.col("n") / SLOT_ROWS).cast("int").alias("slots")))
    copies = texts.filter("doc IS NOT NULL").join(shared, "hash")
    smallest = copies.groupBy("hash", "text", "slots").agg(F.min("doc").alias("smallest")).select(
        "hash", "text", "smallest", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"))
    later = copies.withColumn("slot", F.pmod(F.xxhash64("doc"), F.col("slots")).cast("int"))
    same = [later[c] == smallest[c] for c in ("hash", "text", "slot")]
    return later.join(smallest, [*same, smallest["smallest"] < later["doc"]], "left_semi").select("doc", "part", "hash")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per source and combination of failed filters."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    rows = cut_lineage(map_batches(texts.select("doc", "part", "hash", "text"),
                                   "doc long, part string, hash long, bits int", _with_failures))
    failed = (rows.withColumn("rows", F.lit(1))
              .union(repeated(rows, texts).select("doc", "part", "hash", F.lit(BIT["E"]), F.lit(0)))
              .groupBy("doc", "part", "hash").agg(F.bit_or("bits").alias("mask"), F.sum("rows").alias("rows")))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    each = failed.join(known, "doc", "left")
    return each.groupBy("part", "mask").agg(
        F.sum("rows").alias("n"), *[F.coalesce(F.sum(F.col("rows") * F.col(c)), F.lit(0)).alias(c) for c in ("good", "toxic")])


def report(counts: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step from (part, mask, n, good, toxic)."""
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    steps = (cells.withColumn("filter_order", F.explode(F.split(F.lit(",".join(ORDERS)), ",")))
             .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))))

    bits = F.create_map(*[F.lit(x) for item in BIT.items() for x in item])

    def bit(position: int) -> Column:
        return F.element_at(bits, F.substring("filter_order", position, 1))

    own = F.element_at(F.array(*[bit(i) for i in range(1, len(FILTERS) + 1)]), F.col("step"))
    before = sum((F.when(F.col("step") > i, bit(i)).otherwise(0) for i in range(1, len(FILTERS))), F.lit(0))
    steps = steps.withColumn("own", own).withColumn("before", before)

    def total(value: str, chosen) -> Column:
        return F.aggregate(F.filter("cells", chosen), F.lit(0).cast("long"), lambda s, c: s + c[value])

    def fails(cell: Column) -> Column:
        return cell["mask"].bitwiseAND(F.col("own")) != 0

    def gone(cell: Column) -> Column:
        return cell["mask"].bitwiseAND(F.col("before")) != 0

    first = F.aggregate(
        F.filter("cells", fails), F.lit(0).cast("long"),
        lambda s, c: s + (c["n"] * F.lit(math.factorial(len(FILTERS))) / F.bit_count(c["mask"])).cast("long"))
    return steps.select(
        "part", "filter_order", "step",
        total("n", lambda c: ~gone(c) & ~fails(c)).alias("kept"),
        total("n", lambda c: ~gone(c) & fails(c)).alias("removed"),
        total("n", lambda c: gone(c) & fails(c)).alias("redundant"),
        total("n", lambda c: c["mask"] == F.col("own")).alias("unique_fails"),
        total("good", lambda c: ~gone(c) & fails(c)).alias("good_lost"),
        total("toxic", lambda c: ~gone(c) & fails(c)).alias("toxic_lost"),
        first.alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One row per source, order and step. Of documents (doc_id, text, source), a
    null text is empty, a null source the part '', as is an empty one. A null id
    is smaller or larger than none, so such rows never fail E nor make others
    fail it. Rows that repeat an id count each and are no smaller document to
    one another. Of labels (doc_id, quality, toxic), rows that repeat an id
    count as one that has 1 where any has it. No documents give no rows; other
    columns are not read.
    """
    return report(combinations(docs, labels))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS failed
  FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
c AS (SELECT part, failed, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
      FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step, filter_order[step] AS own, filter_order[:step - 1] AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)),
judged AS (
  SELECT part, filter_order, step, n, good, toxic, contains(failed, own) AS fails, failed = own AS only_own,
         len(list_intersect(string_split(failed, ''), string_split(before, ''))) > 0 AND failed <> '' AND before <> '' AS gone,
         CASE WHEN contains(failed, own) THEN n * 120 // length(failed) ELSE 0 END AS share
  FROM c, steps)
SELECT part, filter_order, CAST(step AS INT) AS step,
       CAST(sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN only_own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(sum(share) AS BIGINT) AS shapley
FROM judged GROUP BY part, filter_order, step
"""
