"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import (
    audit, bpe, jaccard, language, lexical, lines, mixing, quality, sharding, suffixes, topk, toxicity, winnowing,
)
from tracewell.llm.common import read_table
from tracewell.llm.stages import VOCABULARY
from tracewell.session import prepare

SHARDS = tuple(f"shard-{i:02d}" for i in range(64))


def op1_permutation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document in a permutation-filled lookup table."""
    return sharding.place(read_table(prepare(spark), sf_dir, "documents"), SHARDS)


def op2_hierarchical_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; a source is its host and a language its path there."""
    prepare(spark)
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of similar shingle sets."""
    return jaccard.join(read_table(prepare(spark), sf_dir, "documents"))


def op4_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by words and word pairs, smoothed as by Kneser-Ney."""
    prepare(spark)
    return toxicity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all sources takes of every document, and when."""
    return mixing.taken(read_table(prepare(spark), sf_dir, "documents"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowing fingerprints of every document and of its edited text."""
    return winnowing.fingerprint_edits(
        read_table(prepare(spark), sf_dir, "documents"), gram=winnowing.CHARACTER_GRAM,
        window=winnowing.CHARACTER_WINDOW, characters=True)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that smaller documents hold."""
    return suffixes.digests(read_table(prepare(spark), sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by hyperdimensional profiles."""
    return language.identify(read_table(prepare(spark), sf_dir, "documents"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors by integer inner product for every hundredth vector."""
    vectors = read_table(prepare(spark), sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0, 10)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes they decode to, as digests."""
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.digests(read_table(prepare(spark), sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best documents of every benchmark item by integer term scores."""
    prepare(spark)
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), 10)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that smaller documents hold."""
    return lines.dedup(read_table(prepare(spark), sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes, in every order of them, by source."""
    prepare(spark)
    return audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_permutation_table, op2_hierarchical_quality, op3_ngram_jaccard, op4_kneser_ney_toxicity, op5_source_mix,
    op6_winnowing, op7_suffix_dedup, op8_language_id, op9_exact_top_k, op10_byte_bpe, op11_lexical_search,
    op12_line_dedup, op13_filter_audit,
)}

ORACLES: dict[str, str] = {
    "op5_source_mix": mixing.ORACLE_SQL,
    "op11_lexical_search": lexical.ORACLE_SQL,
    "op12_line_dedup": lines.ORACLE_SQL,
    "op13_filter_audit": audit.ORACLE_SQL,
}
