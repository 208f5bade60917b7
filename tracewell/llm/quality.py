"""Document quality by hierarchical empirical Bayes.

A naive Bayes classifier over binned text measures gives each document's
evidence. Hosts and their paths have quality rates of their own, estimated from
their documents' evidence and labels and shrunk: a path towards its host, a host
towards the global rate, the more the fewer documents they have. How much is
estimated from the spread between hosts and between paths. A document's score
joins its evidence with the rate of its path, leaving itself out of that rate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import split_number
from tracewell.session import cut_lineage

BINS = 20
SALTS = 16
EDGE = 0.001  # rates stay this far from 0 and 1
MEASURES = ("distinct_words", "distinct_lines", "word_length", "symbols", "digits", "capitals", "ends", "words")


def measures(text: Column) -> dict[str, Column]:
    """Measures of a text between 0 and 1. Python is not involved."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    n, letters = F.length(text), F.length(F.regexp_replace(text, r"[^\p{L}\p{N}\s]+", ""))

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0)

    return {
        "distinct_words": share(F.size(F.array_distinct(words)), F.size(words)),
        "distinct_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
        "word_length": F.least(F.lit(1.0), share(n, F.size(words) * 20)),
        "symbols": F.least(F.lit(1.0), 4 * share(n - letters, n)),
        "digits": F.least(F.lit(1.0), 4 * share(n - F.length(F.regexp_replace(text, r"[0-9]+", "")), n)),
        "capitals": share(n - F.length(F.regexp_replace(text, r"\p{Lu}+", "")), n),
        "ends": F.least(F.lit(1.0), 5 * share(n - F.length(F.translate(text, ".!?", "")), F.size(words))),
        "words": F.least(F.lit(1.0), F.log2(F.size(words) + F.lit(1)) / 16),
    }


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(EDGE)), F.lit(1 - EDGE))
    return F.log(p / (1 - p))


def _concentration(rates: DataFrame) -> float:
    """Pseudo-documents by which group rates (n, p, toward) shrink, by moments.

    Between groups the rates spread by more than sampling explains; the less
    more, the more pseudo-documents.
    """
    p, m = F.col("p"), F.col("toward")
    row = rates.agg(F.sum(F.col("n") * (p - m) * (p - m)), F.sum(m * (1 - m)), F.sum(F.col("n"))).first()
    spread, sampling, n = (float(x or 0.0) for x in row)
    if n <= 0 or sampling <= 0:
        return 1.0
    groups = rates.count()
    between = (spread - sampling) / max(n - groups, 1.0)
    return min(1e6, max(1.0, (sampling / groups) / between - 1)) if between > 0 else 1e6


def classify(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", host: str = "source",
             path: str = "lang", label: str = "quality", folds: int = 3, held_out: int = 1) -> DataFrame:
    """(key, held_out, evidence, host_rate, path_rate, score, predicted) per document.

    Learns from labels outside one fold of keys. ``score`` is the probability of
    label 1, ``predicted`` 1 from 0.5 on. A null text counts as empty; a null
    host or path is a group like any other; a null key has no label. Rows that
    repeat a key are classified one by one; of contradicting labels the largest
    counts. Without labels the evidence is 0 and the rates are a half. Other
    columns are not read.

    Texts are read once. Group rates are hash aggregates; they go back to the
    documents by salted joins, so a host with a third of all rows is spread out.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    bins = F.array(*[F.floor(F.lit(BINS) * m).cast("int") for m in measures(F.col("content")).values()])
    seen = (docs.select(F.col(key).alias("key"), F.col(host).cast("string").alias("host"),
                        F.col(path).cast("string").alias("path"), content.alias("content"))
            .select("key", "host", "path", bins.alias("bins")))
    known = (labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col(key).alias("key")).agg(F.max(F.col(label).cast("int")).alias("label")))
    fold = split_number("key", folds)
    seen = cut_lineage(seen.join(known, "key", "left").withColumn("held_out", fold == held_out)
                       .withColumn("label", F.when(~F.col("held_out"), F.col("label"))))

    # Evidence: at most len(MEASURES) * (BINS + 1) cells, whatever the data.
    good, bad = seen.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    cells = (seen.filter("label IS NOT NULL").select("label", F.posexplode("bins").alias("measure", "bin"))
             .groupBy("measure", "bin").agg(F.count_if(F.col("label") == 1).alias("good"),
                                            F.count_if(F.col("label") == 0).alias("bad")).collect())
    found = {(c["measure"], c["bin"]): (c["good"], c["bad"]) for c in cells}
    ratios = [[math.log((found.get((m, b), (0, 0))[0] + 1) / (good + BINS + 1))
               - math.log((found.get((m, b), (0, 0))[1] + 1) / (bad + BINS + 1)) for b in range(BINS + 1)]
              for m in range(len(MEASURES))]
    prior = (good + 1) / (good + bad + 2)
    table = F.array(*[F.array(*map(F.lit, row)) for row in ratios])
    evidence = F.aggregate(F.zip_with(table, "bins", lambda row, b: F.element_at(row, b + 1)),
                           F.lit(0.0), lambda s, x: s + x)
    believed = 1 / (1 + F.exp(-(F.col("evidence") + math.log(prior / (1 - prior)))))
    scored = cut_lineage(
        seen.withColumn("evidence", evidence).withColumn("p", F.coalesce(F.col("label").cast("double"), believed))
        .select("key", "held_out", "evidence", "p", F.col("host").isNull().alias("no_host"),
                F.coalesce("host", F.lit("")).alias("host"), F.col("path").isNull().alias("no_path"),
                F.coalesce("path", F.lit("")).alias("path")))

    # Rates, from the top down.
    paths = cut_lineage(scored.groupBy("no_host", "host", "no_path", "path").agg(
        F.count(F.lit(1)).alias("n"), F.sum("p").alias("total")))
    hosts = cut_lineage(paths.groupBy("no_host", "host").agg(
        F.sum("n").alias("host_n"), F.sum("total").alias("host_total")))
    n, total = hosts.agg(F.sum("host_n"), F.sum("host_total")).first()
    overall = (total / n) if n else 0.5
    k_host = _concentration(hosts.select(
        F.col("host_n").alias("n"), (F.col("host_total") / F.col("host_n")).alias("p"), F.lit(overall).alias("toward")))
    both = cut_lineage(paths.join(hosts, ["no_host", "host"]))
    k_path = _concentration(both.select(
        "n", (F.col("total") / F.col("n")).alias("p"), (F.col("host_total") / F.col("host_n")).alias("toward")))

    salted = both.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = (scored.withColumn("salt", F.pmod(F.xxhash64("key", "evidence"), F.lit(SALTS)).cast("int"))
              .join(salted, ["no_host", "host", "no_path", "path", "salt"]))
    p = F.col("p")
    host_rate = (F.col("host_total") - p + k_host * overall) / (F.col("host_n") - 1 + k_host)
    path_rate = (F.col("total") - p + k_path * F.col("host_rate")) / (F.col("n") - 1 + k_path)
    return (joined.withColumn("host_rate", host_rate).withColumn("path_rate", path_rate)
            .withColumn("score", 1 / (1 + F.exp(-(F.col("evidence") + _logit(F.col("path_rate"))))))
            .select(F.col("key").alias(key), "held_out", "evidence", "host_rate", "path_rate", "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))
