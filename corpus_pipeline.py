"""Documents to training tokens: the stages, in order, each over all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracewell.llm import stages
from tracewell.llm.common import read_table
from tracewell.session import cut_lineage, prepare

STAGES = [
    ("language_id", stages.language_id),
    ("ngram_jaccard_join", stages.jaccard_join),
    ("suffix_array_dedup", stages.suffix_dedup),
    ("source_mix", stages.source_mix),
    ("byte_bpe", stages.byte_bpe),
]

# The stages learn models and read tokens, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each result is written and read back."""
    docs = read_table(prepare(spark), sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
