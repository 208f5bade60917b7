"""The pipeline's stages. Each takes (spark, docs, sf_dir) and returns a DataFrame.

All but the last return the columns of ``docs``, whatever they are besides
doc_id, text, source and lang.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import bpe, jaccard, language, mixing, suffixes
from tracewell.session import cut_lineage

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
NOISE = 4.0  # standard deviations of the cosine of unrelated vectors; below them a text is like no language
LOW_SHARE = 0.05  # of the labelled texts of a language and length are below its low cosine
OF_LOW = 0.5  # a text needs this share of the low cosine
CELLS = 1000  # of the histogram of cosines


def least_cosines(scored: DataFrame, dimensions: int) -> list[tuple[str, int, float]]:
    """(language, length class, least cosine), from (lang, lang_pred, score, size) of labelled documents.

    A longer text is more like its language, so each doubling of the length has
    a low cosine of its own, and longer ones need no less than shorter ones. None
    is within the noise of the dimensions.
    """
    cells = (scored.filter(F.col("lang") == F.col("lang_pred"))
             .groupBy("lang", "size", F.floor(F.col("score") * CELLS).cast("int").alias("cell")).count())
    found: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for row in cells.collect():
        found.setdefault((row["lang"], row["size"]), []).append((row["cell"], row["count"]))
    out, least = [], {}
    for (lang, size), counts in sorted(found.items()):
        left = LOW_SHARE * sum(n for _, n in counts)
        for low, n in sorted(counts):
            left -= n
            if left < 0:
                break
        least[lang] = max(least.get(lang, NOISE / dimensions ** 0.5), OF_LOW * low / CELLS)
        out.append((lang, size, least[lang]))
    return out


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, or like no language learned from the labelled ones."""
    languages, matrix = language.train(docs)
    size = F.floor(F.log2(F.length("text") + F.lit(1))).cast("int")
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select(
        F.struct(F.col("lang").cast("string").alias("lang"), size.alias("size")).alias("own"), "text")
    scored = language.predict(labelled, languages, matrix, key="own").select("own.*", "lang_pred", "score")
    least = F.lit(NOISE / matrix.shape[1] ** 0.5)
    for lang, shortest, cosine in least_cosines(scored, matrix.shape[1]):
        least = F.when((F.col("lang_pred") == lang) & (F.col("size") >= shortest), F.lit(cosine)).otherwise(least)
    known = language.predict(docs, languages, matrix, keep_rows=True)
    known = known.withColumn("size", F.floor(F.log2(F.length("row.text") + F.lit(1))).cast("int"))
    return known.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= least)).select("row.*")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies: of its smallest id, the one with the least text hash.

    A null id is larger than all others. Rows that repeat an id are rows like any
    other: equal or near copies among them leave one, others stay. Rows without
    words are in no group and stay. The order of rows and other columns decide
    nothing, except between rows that agree in id and text.
    """
    rows = cut_lineage(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("whole")))
    groups = jaccard.join(rows.select("row", F.col("whole.text").alias("text")), key="row")
    named = rows.select("row", F.col("whole.doc_id").cast("long").alias("id"), F.xxhash64("whole.text").alias("hash"))
    first = F.struct(F.col("id").isNull().alias("none"), "id", "hash", "row")
    kept = (groups.filter("component_id IS NOT NULL").join(named, "row")
            .groupBy("component_id").agg(F.min(first).alias("first")).select(F.col("first.row").alias("row")))
    return rows.join(kept, "row", "left_semi").select("whole.*")


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut 50-byte strings that smaller documents hold out of the texts.

    A character that loses some of its bytes goes as a whole. A document of
    which nothing is left goes.
    """
    rest = suffixes.remove_repeats(docs, keep_rows=True).filter("n_bytes = 0 OR kept_text != ''")
    replaced = {"text": F.col("kept_text").alias("text"), "n_chars": F.length("kept_text").cast("long").alias("n_chars")}
    return rest.select([replaced.get(c, F.col(f"row.`{c}`")) for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as the mix of sources takes it."""
    return mixing.training_order(mixing.mix(docs, keep_rows=True))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.with_digests(docs, ranks, public_tokenizers.PATTERN)
