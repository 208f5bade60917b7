"""The library's scalar and table operators for SQL callers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tracewell.functions.rubric import Field, Rubric, extract_sql

# Word list of a text: the same letters-only rule as columns.words.
_WORDS = r"regexp_extract_all(lower({0}), r'(\p{{L}}+)', 1)"

SCALARS = {
    "sunday_week(d DATE) RETURNS DATE": "date_sub(d, dayofweek(d) - 1)",
    "safe_ratio(a DOUBLE, b DOUBLE) RETURNS DOUBLE": "try_divide(a, b)",
    "stable_bucket(t STRING, n INT) RETURNS BIGINT":
        "pmod(CAST(conv(substring(md5(t), 1, 8), 16, 10) AS BIGINT), n)",
    "context_of(a STRING, b STRING, c STRING, d STRING) RETURNS STRING":
        "concat(coalesce(a, ''), coalesce(b, ''), coalesce(c, ''), coalesce(d, ''))",
    "text_words(t STRING) RETURNS ARRAY<STRING>": _WORDS.format("t"),
    "text_similarity(a STRING, b STRING) RETURNS DOUBLE":
        f"try_divide(size(array_intersect({_WORDS.format('a')}, {_WORDS.format('b')})), "
        f"sqrt(CAST(size(array_distinct({_WORDS.format('a')})) AS DOUBLE) "
        f"* size(array_distinct({_WORDS.format('b')}))))",
}


def register(spark: SparkSession, rubrics: dict[str, Rubric] | None = None,
             classifiers: dict[str, tuple[Rubric, Sequence[str]]] | None = None,
             predicates: dict[str, tuple[Rubric, float]] | None = None,
             extractors: dict[str, Sequence[Field]] | None = None) -> None:
    """Create temporary SQL functions; native SQL bodies, so they inline into the plan.

    Of a text ``t``: a rubric becomes ``<name>(t)``, its score, a classifier its
    category, a predicate whether its score reaches a threshold, and an
    extractor a struct of typed fields. ``context_of(a, b, c, d)`` joins parts
    and takes NULL for empty. Spark takes SQL functions in SELECT and WHERE; to
    sort by one, sort by its alias.
    """
    def create(signature: str, body: str) -> None:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")

    for signature, body in SCALARS.items():
        create(signature, body)
    for name, rubric in (rubrics or {}).items():
        create(f"{name}(t STRING) RETURNS DOUBLE", rubric.sql("t"))
    for name, (rubric, categories) in (classifiers or {}).items():
        create(f"{name}(t STRING) RETURNS STRING", rubric.classify_sql("t", categories))
    for name, (rubric, threshold) in (predicates or {}).items():
        create(f"{name}(t STRING) RETURNS BOOLEAN", f"({rubric.sql('t')}) >= {threshold!r}D")
    for name, fields in (extractors or {}).items():
        kinds = ", ".join(f"{f.name}: {f.type}" for f in fields)
        create(f"{name}(t STRING) RETURNS STRUCT<{kinds}>", extract_sql("t", fields))


def table(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Publish a table operator's result under a name SQL can read."""
    df.createOrReplaceTempView(name)
    return spark.table(name)
