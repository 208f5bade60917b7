"""Serve unlabelled rows from a small model of a labelled sample: counted over words, or fitted over vectors."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewell.functions.columns import explode_once, md5_bucket, words
from tracewell.session import cut_lineage


def classify(df: DataFrame, key: str, text: str, labels: DataFrame, *, min_agreement: float = 0.7,
             holdout_percent: int = 20, features: int = 1 << 12) -> DataFrame:
    """(key, prediction, served_by) for every row, at every size.

    ``labels`` (key, label) is the labeller's answer for a sample; labelled rows
    keep it. The others are served by naive Bayes over the ``features`` hashed
    words a text holds, whose fit is sums. A part of the labels, chosen by hash
    of the key, is held out: when the model agrees with less than
    ``min_agreement`` of it, or none is held out, the other rows get NULL and
    served_by ``unlabelled``. Equal likelihoods go to the smaller label.
    """
    answers = df.select(key).join(labels.filter("label IS NOT NULL"), key, "left")
    held = md5_bucket(100, F.col(key).cast("string")) < holdout_percent
    marked = cut_lineage(
        df.select(key, F.transform(words(F.col(text)), lambda w: md5_bucket(features, w)).alias("_w"))
        .select(key, F.array_distinct(F.coalesce("_w", F.array().cast("array<bigint>"))).alias("_features"))
        .join(answers, key).withColumn("_held", held))
    fitted = marked.filter("label IS NOT NULL AND NOT _held")
    seen = fitted.select("label", explode_once(F.col("_features")).alias("_f")).filter("_f IS NOT NULL")
    cells = seen.groupBy("label", "_f").agg(F.count(F.lit(1)).alias("_n"))
    per_label = fitted.groupBy("label").agg(F.count(F.lit(1)).alias("_rows"))
    sums = cells.groupBy("label").agg(F.sum("_n").alias("_all"))
    priors = per_label.join(sums, "label", "left").select(
        "label", F.log("_rows").alias("_prior"), F.log(F.coalesce("_all", F.lit(0)) + features).alias("_log_all"))
    # At most ``features`` rows per label; a word a label lacks counts one.
    weights = cells.select("label", "_f", F.log(F.col("_n") + 1.0).alias("_weight"))

    asked = marked.filter("label IS NULL OR _held").select(key, "_features")
    each = asked.select(key, explode_once(F.col("_features")).alias("_f")).filter("_f IS NOT NULL")
    found = each.join(weights, "_f").groupBy(key, "label").agg(F.sum("_weight").alias("_sum"))
    scores = (asked.select(key, F.size("_features").alias("_size"))
              .withColumn("label", F.explode(priors.agg(F.collect_list("label").alias("l")).scalar()))
              .join(priors, "label").join(found, [key, "label"], "left")
              .withColumn("_score", F.round(F.col("_prior") + F.coalesce("_sum", F.lit(0.0))
                                            - F.col("_size") * F.col("_log_all"), 6)))
    best = Window.partitionBy(key).orderBy(F.desc("_score"), "label")
    model = cut_lineage(scores.withColumn("_k", F.row_number().over(best)).filter("_k = 1").select(
        key, F.col("label").alias("_model")))
    checked = marked.filter("_held AND label IS NOT NULL").join(model, key)
    agreement = checked.agg(F.avg((F.col("_model") == F.col("label")).cast("double"))).first()[0]
    accepted = agreement is not None and agreement >= min_agreement
    served = F.when(F.col("label").isNotNull(), "labeller")
    if not accepted:
        return marked.select(key, F.col("label").alias("prediction"), served.otherwise("unlabelled").alias("served_by"))
    return marked.join(model, key, "left").select(
        key, F.coalesce("label", "_model").alias("prediction"), served.otherwise("model").alias("served_by"))


def classify_vectors(df: DataFrame, key: str, vector: str, labels: DataFrame, *, min_agreement: float = 0.7,
                     holdout_percent: int = 20, iterations: int = 50) -> DataFrame:
    """(key, prediction, served_by) for every row, from a model fitted on the vectors.

    As ``classify``, with logistic regression over the array ``vector``: labels
    (key, label) stay, a part of them, by hash of the key, is held out, and when
    the model agrees with less than ``min_agreement`` of it, or there is none, or
    the others show fewer than two labels, unlabelled rows get NULL. So do rows
    whose vector is NULL, holds a NULL or is not finite, or is not as long as the
    most frequent length (of equal ones the longest) of the labelled. The fit is
    one pass of sums over the labelled rows per iteration. Predictions are strings
    read back in the label's type; a key must be unique.
    """
    kind = labels.schema["label"].dataType
    held = md5_bucket(100, F.col(key).cast("string")) < holdout_percent
    values = F.col(vector).cast("array<double>")
    usable = F.coalesce(F.forall(values, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False))
    marked = cut_lineage(
        df.select(key, F.when(usable & (F.size(values) > 0), values).alias("_values"))
        .join(labels.filter("label IS NOT NULL").select(key, F.col("label").cast("string").alias("_label")), key, "left")
        .withColumn("_held", held))
    served = F.when(F.col("_label").isNotNull(), "labeller")
    refused = marked.select(key, F.col("_label").cast(kind).alias("prediction"),
                            served.otherwise("unlabelled").alias("served_by"))
    sizes = marked.filter("_label IS NOT NULL AND _values IS NOT NULL").groupBy(F.size("_values").alias("n")).agg(
        F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    if sizes is None:
        return refused
    ready = marked.filter(F.size("_values") == sizes["n"]).withColumn("_vector", array_to_vector("_values"))
    fitted = ready.filter("_label IS NOT NULL AND NOT _held")
    if fitted.select("_label").distinct().limit(2).count() < 2:
        return refused
    index = StringIndexer(inputCol="_label", outputCol="_index", stringOrderType="alphabetAsc").fit(fitted)
    model = LogisticRegression(featuresCol="_vector", labelCol="_index", predictionCol="_guess", probabilityCol="",
                               rawPredictionCol="", maxIter=iterations, regParam=1e-3).fit(index.transform(fitted))
    named = IndexToString(inputCol="_guess", outputCol="_model", labels=index.labels)
    guesses = cut_lineage(named.transform(model.transform(ready.filter("_label IS NULL OR _held"))).select(key, "_model"))
    checked = marked.filter("_held AND _label IS NOT NULL").join(guesses, key)
    agreement = checked.agg(F.avg((F.col("_model") == F.col("_label")).cast("double"))).first()[0]
    if agreement is None or agreement < min_agreement:
        return refused
    served = served.when(F.col("_model").isNotNull(), "model").otherwise("unlabelled")
    return marked.join(guesses, key, "left").select(
        key, F.coalesce("_label", "_model").cast(kind).alias("prediction"), served.alias("served_by"))
