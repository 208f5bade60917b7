"""Mixing sources to target weights along a time-varying curriculum.

Each source owns a weight that changes over training time. The integral of its
weight, scaled to its target, is the demand for its words up to any moment; a
document that starts at word x of its source is trained on at the moment when
that demand reaches x. Sorting all documents by that moment, by ranges, gives
the training order. Everything is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.llm.common import WORD
from tracewell.operators.relational import global_row_number
from tracewell.session import cut_lineage

WEIGHTS = (3, 1, 2)
BUDGET = 1.5  # words of the mix per word of all sources
REPEATS = 2  # times a source may be used at most
CELL_ROWS = 20_000  # documents per cell when a source's words are laid out, about

#: Weight over training time as (moment, level) knots, joined by straight lines.
#: Sources take these in turn, like the weights: early, even, late.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)),
)


def moment_sql(done: str, schedule: Sequence[tuple[float, float]]) -> str:
    """SQL for the moment at which the share ``done`` of a schedule's demand is met."""
    segments, area = [], 0.0
    for (t0, a), (t1, b) in zip(schedule, schedule[1:]):
        segments.append((t0, a, (b - a) / (t1 - t0), area, area + (a + b) / 2 * (t1 - t0)))
        area = segments[-1][-1]
    cases = []
    for t0, a, slope, before, after in segments:
        demand = f"greatest({done} * {area!r}e0 - {before!r}e0, 0e0)"
        # x solves a x + slope x^2 / 2 = demand, in the form that never subtracts.
        x = (f"2e0 * {demand} / nullif({a!r}e0 + sqrt(greatest({a * a!r}e0 + 2e0 * {slope!r}e0 * {demand}, 0e0)), 0e0)")
        cases.append(f"WHEN {done} * {area!r}e0 <= {after!r}e0 THEN {t0!r}e0 + coalesce({x}, 0e0)")
    return f"CASE {' '.join(cases)} ELSE 1e0 END"


def count_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def fill_targets(sources: DataFrame, budget: float, repeats: float) -> DataFrame:
    """Add ``target`` to rows of (source_size, weight).

    Targets share ``budget`` times all sizes by weight and stop at ``repeats``
    times the source's size; what is above goes to the others by weight until
    none is above. That is one level ``l`` with target = min(cap, l * weight);
    each round fixes the sources whose cap is below and raises ``l``.
    """
    cap = F.col("source_size") * F.lit(repeats)
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    demand = budget * (total or 0)
    level, fixed = (demand / weights if weights else 0.0), 0
    while True:
        full = cap < F.lit(level) * F.col("weight")
        n, capped, open_weight = sources.agg(
            F.count_if(full), F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        if n == fixed or not open_weight:
            break
        fixed, level = n, (demand - (capped or 0.0)) / open_weight
    return sources.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def mix(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, repeats: int = REPEATS,
        schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES, keep_rows: bool = False) -> DataFrame:
    """One row per document: what the mix takes of it and when.

    Returns key, size (words), source_size, target (of its source), taken (words,
    repeats counted), copies (whole-document passes, rounded to the nearest) and
    moments (start of each pass that takes words, 0 to 1), with ``keep_rows``
    also ``row``, the whole input row. Sources are ordered by code point, null
    last, and take ``weights`` and ``schedules`` in turn.

    A source is laid out in the order of md5(key), then key and size, so reruns
    agree; the mix takes its words from the start, as often as the target needs,
    and stops within a document where the target is reached. A null text has
    size 0 and is never taken; null keys and null sources are ordinary values;
    rows that repeat a key follow one another; an empty table gives no rows.

    Sizes are summed per cell (a prefix of md5) before any window, so a source
    with a third of all rows is spread over as many tasks as it has cells.
    """
    columns = [F.col(key).alias("key"), F.col(source).cast("string").alias("source"), count_words(text).alias("size")]
    sized = cut_lineage(docs.select(*columns))
    rows = docs.select(*columns, F.struct("*").alias("row")) if keep_rows else sized
    n = sized.count()
    digits = 1
    while 16 ** digits * CELL_ROWS < n:
        digits += 1

    listed = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_row_number(
        listed.select(F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name"),
                      "source_size"), ["no_source", "name"], "turn")
    turn = (F.col("turn") - 1) % len(weights)
    sources = cut_lineage(ranked.select(
        "no_source", "name", "source_size", ((F.col("turn") - 1) % len(schedules)).cast("int").alias("schedule"),
        F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).alias("weight")))
    targets = fill_targets(sources, budget, float(repeats)).drop("weight")

    def placed(df: DataFrame) -> DataFrame:
        order = F.md5(F.coalesce(F.col("key").cast("string"), F.lit("")).cast("binary"))
        return (df.withColumn("no_source", F.col("source").isNull())
                .withColumn("name", F.coalesce("source", F.lit(""))).drop("source")
                .withColumn("place", order).withColumn("cell", F.substring("place", 1, digits)))

    cell = ["no_source", "name", "cell"]
    earlier_cells = Window.partitionBy("no_source", "name").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (placed(sized).groupBy(*cell).agg(F.sum("size").alias("cell_size"))
             .withColumn("carried", F.coalesce(F.sum("cell_size").over(earlier_cells), F.lit(0)))
             .join(targets, ["no_source", "name"]).drop("cell_size"))
    earlier = (Window.partitionBy(*cell).orderBy("place", "key", "size")
               .rowsBetween(Window.unboundedPreceding, -1))
    laid = (placed(rows).withColumn("local", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
            .join(cells, cell).withColumn("start", F.col("carried") + F.col("local")))

    words = F.floor(F.col("target") + 0.5)
    starts = F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)),
                         lambda p: F.col("start") + p * F.col("source_size"))
    done = "(CAST(x AS DOUBLE) / target)"
    moment = "CASE schedule " + " ".join(
        f"WHEN {i} THEN {moment_sql(done, s)}" for i, s in enumerate(schedules)) + " END"
    out = laid.withColumn("starts", starts).withColumn("words", words).select(
        F.col("key").alias(key), "size", "source_size", "target",
        F.aggregate("starts", F.lit(0).cast("long"), lambda s, x: s + F.greatest(
            F.lit(0).cast("long"), F.least(F.col("size"), F.col("words") - x))).alias("taken"),
        F.aggregate("starts", F.lit(0), lambda s, x: s + F.when(
            (F.col("size") > 0) & (2 * (F.col("words") - x) >= F.col("size")), 1).otherwise(0)).alias("copies"),
        F.expr(f"""transform(CASE WHEN size > 0 AND target > 0 THEN filter(starts, x -> x < words)
                   ELSE array() END, x -> round({moment}, 9))""").alias("moments"),
        *(["row"] if keep_rows else []), "place")
    return out


def range_sorted(mixed: DataFrame) -> DataFrame:
    """Rows in the order of their first moment, by ranges; what is not taken comes last."""
    first = F.coalesce(F.try_element_at("moments", F.lit(1)), F.lit(2.0))
    return (mixed.withColumn("moment", first).repartitionByRange("moment", "place")
            .sortWithinPartitions("moment", "place"))


def training_order(mixed: DataFrame) -> DataFrame:
    """The input rows in training order, each as often as the mix takes the whole document."""
    passes = mixed.filter("copies > 0").select(
        "row", "place", F.explode(F.slice("moments", F.lit(1), F.col("copies"))).alias("moment"))
    return (passes.repartitionByRange("moment", "place").sortWithinPartitions("moment", "place")
            .select("row.*"))


def taken(docs: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """The query's rows, in training order."""
    return range_sorted(mix(docs, key=key)).select(
        key, "size", "source_size", "target", "taken", "copies",
        F.when(F.col("moment") <= 1, F.col("moment")).alias("first_moment"))


def _sql() -> str:
    done = "((carried * 1e0) / target)"
    moment = "CASE schedule " + " ".join(
        f"WHEN {i} THEN {moment_sql(done, s)}" for i, s in enumerate(SCHEDULES)) + " END"
    weight = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))
    return rf"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
         CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size
  FROM documents),
listed AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn
  FROM sized GROUP BY source),
weighted AS (
  SELECT *, CASE turn % {len(WEIGHTS)} {weight} END AS weight, turn % {len(SCHEDULES)} AS schedule,
         source_size * {float(REPEATS)!r}e0 AS cap, {BUDGET!r}e0 * sum(source_size) OVER () AS demand
  FROM listed),
levels AS (
  SELECT *, (demand - coalesce(sum(cap) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
targets AS (
  SELECT source, source_size, schedule,
         least(cap, (SELECT min_by(level, cap / weight) FROM levels WHERE level <= cap / weight) * weight) AS target
  FROM levels),
laid AS (
  SELECT d.doc_id, d.size, s.source_size, s.target, s.schedule, floor(s.target + 0.5e0) AS words,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY place, d.doc_id, d.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS carried
  FROM sized d JOIN targets s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
       CAST({" + ".join(f"greatest(0, least(size, words - carried - {p} * source_size))" for p in range(REPEATS))} AS BIGINT) AS taken,
       CAST({" + ".join(f"(CASE WHEN size > 0 AND 2 * (words - carried - {p} * source_size) >= size THEN 1 ELSE 0 END)"
                        for p in range(REPEATS))} AS INTEGER) AS copies,
       CASE WHEN size > 0 AND target > 0 AND carried < words THEN round({moment}, 9) ELSE NULL END AS first_moment
FROM laid"""


ORACLE_SQL = _sql()
