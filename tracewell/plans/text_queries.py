"""Text queries over documents, benchmark passages, labels and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.functions import sql as sql_functions
from tracewell.functions.columns import md5_bucket
from tracewell.functions.rubric import Field, Rubric, Term, extract
from tracewell.operators import distill
from tracewell.operators import text as tx
from tracewell.operators.relational import first_per_key
from tracewell.plans.registry import query
from tracewell.sources.tables import Tables, spread

TERMS = (
    Term(r"token\s*=|api[_-]?key", 4.0, "secret"),
    Term(r"[a-z0-9_.+-]+@[a-z0-9-]+\.[a-z.]+", 2.0, "contact", needs="@"),
    Term(r"[0-9]{13,16}", 3.0, "card"),
    Term(r"licen[cs]e", 1.5, "license", needs="licen"),
    Term(r"stupid|worthless|idiot", 1.0, "abuse"),
    Term(r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", 2.5, "contact", needs="."),
)
RUBRIC = Rubric(TERMS)
CATEGORIES = ("secret", "card", "contact", "license", "abuse", "none")

FIELDS = (
    Field("email", "string", r"([A-Za-z0-9_.+-]+@[A-Za-z0-9-]+\.[a-z]+)", "N/A", needs="@"),
    Field("ip_address", "string", r"\b([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})\b", "N/A", needs="."),
    Field("first_number", "bigint", r"\b([0-9]{1,9})\b", "-1"),
    Field("mentions_license", "boolean", r"[Ll]icen[cs]e", "false"),
)

ABBREVIATIONS = {
    "econ": "economy", "stan": "standard", "prom": "promotional", "larg": "large", "smal": "small",
    "medi": "medium", "itm": "item", "sz": "size",
}
REFERENCE_CODE = r"^ref#"


def hits_sql(terms) -> str:
    return " + ".join(
        f"len(regexp_extract_all(lower(text), '{t.pattern}')) * {t.weight}::DOUBLE" for t in terms) or "0.0"


SCORE_SQL = f"least(5.0, {hits_sql(TERMS)})"


def classify_sql() -> str:
    named = [c for c in CATEGORIES if c != "none"]
    scores = "[" + ", ".join(hits_sql([t for t in TERMS if t.category == c]) for c in named) + "]"
    labels = "[" + ", ".join(f"'{c}'" for c in named) + "]"
    return (f"CASE WHEN list_max({scores}) > 0 THEN "
            f"({labels})[list_position({scores}, list_max({scores}))] ELSE 'none' END")


EXTRACT_SQL = r"""
    coalesce(nullif(regexp_extract(text, '([A-Za-z0-9_.+-]+@[A-Za-z0-9-]+\.[a-z]+)', 1), ''), 'N/A') AS email,
    coalesce(nullif(regexp_extract(text, '\b([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})\b', 1), ''), 'N/A')
      AS ip_address,
    coalesce(try_cast(nullif(regexp_extract(text, '\b([0-9]{1,9})\b', 1), '') AS BIGINT), -1) AS first_number,
    regexp_matches(text, '[Ll]icen[cs]e') AS mentions_license, '' AS status"""


def documents(t: Tables, *columns: str) -> DataFrame:
    return spread(t.documents.select("doc_id", "text", *columns), "doc_id")


@query("text_predicate", sql=f"""
    SELECT doc_id, source, lang FROM documents WHERE {SCORE_SQL} >= 2.0""")
def text_predicate(t: Tables):
    return documents(t, "source", "lang").filter(RUBRIC.holds(F.col("text"), 2.0)).select("doc_id", "source", "lang")


@query("text_classify", sql=f"""
    SELECT doc_id, {classify_sql()} AS category FROM documents""")
def text_classify(t: Tables):
    return documents(t).select("doc_id", RUBRIC.classify(F.col("text"), CATEGORIES).alias("category"))


@query("text_rank_topk", sql=f"""
    SELECT doc_id, source, round({SCORE_SQL}, 2) AS score FROM documents
    ORDER BY score DESC, doc_id LIMIT 25""")
def text_rank_topk(t: Tables):
    scored = documents(t, "source").select("doc_id", "source", F.round(RUBRIC.score(F.col("text")), 2).alias("score"))
    return scored.orderBy(F.desc("score"), "doc_id").limit(25)


@query("text_rank_per_length", sql=rf"""
    SELECT doc_id, source, round(least(5.0, ({hits_sql(TERMS)}) * 100.0
             / greatest(1, len(regexp_extract_all(text, '\p{{L}}+')))), 4) AS score
    FROM documents ORDER BY score DESC, doc_id LIMIT 25""")
def text_rank_per_length(t: Tables):
    """The most loaded texts for their length."""
    scored = documents(t, "source").select("doc_id", "source", F.round(RUBRIC.rate(F.col("text")), 4).alias("score"))
    return scored.orderBy(F.desc("score"), "doc_id").limit(25)


@query("text_triage", sql=f"""
    SELECT doc_id, left(text, 80) AS snippet, {SCORE_SQL} >= 1.0 AS is_report, {classify_sql()} AS category,
           round({SCORE_SQL})::BIGINT AS severity
    FROM documents ORDER BY doc_id LIMIT 10""")
def text_triage(t: Tables):
    """The triage table: limit first, then the calls, and only for the reported rows."""
    text = F.col("text")
    return t.documents.orderBy("doc_id").limit(10).select(
        "doc_id", F.left(text, F.lit(80)).alias("snippet"), RUBRIC.holds(text).alias("is_report"),
        RUBRIC.classify(text, CATEGORIES).alias("category"), RUBRIC.judge(text, "int")["result"].alias("severity"))


@query("typed_score", sql=f"""
    SELECT conv_id, turn, role, {SCORE_SQL} >= 1.0 AS flag, round({SCORE_SQL})::BIGINT AS severity,
           {SCORE_SQL} AS score, '' AS status FROM conversations""")
def typed_score(t: Tables):
    text = F.col("text")
    judged = t.conversations.select("conv_id", "turn", "role", RUBRIC.judge(text, "bool").alias("b"),
                                    RUBRIC.judge(text, "int").alias("i"), RUBRIC.judge(text, "double").alias("d"))
    return judged.select("conv_id", "turn", "role", F.col("b.result").alias("flag"),
                         F.col("i.result").alias("severity"), F.col("d.result").alias("score"),
                         F.col("b.status").alias("status"))


@query("typed_extract", sql=f"SELECT doc_id, {EXTRACT_SQL} FROM documents")
def typed_extract(t: Tables):
    return documents(t).select("doc_id", extract(F.col("text"), FIELDS).alias("x")).select("doc_id", "x.*")


@query("sample_then_extract", sql=f"""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents)
    SELECT doc_id, source, {EXTRACT_SQL} FROM r WHERE k = 1 ORDER BY doc_id LIMIT 10""")
def sample_then_extract(t: Tables):
    """First document of each source, ten of them, extracted after the sample is fixed."""
    sample = first_per_key(t.documents, ["source"], F.col("doc_id"), ["doc_id", "text"])
    return (sample.orderBy("doc_id").limit(10)
            .select("doc_id", "source", extract(F.col("text"), FIELDS).alias("x"))
            .select("doc_id", "source", "x.*"))


@query("score_vs_truth", sql=f"""
    SELECT toxic, {SCORE_SQL} >= 1.0 AS predicted, count(*) AS n
    FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2""")
def score_vs_truth(t: Tables):
    return (
        documents(t).join(t.labels.select("doc_id", "toxic"), "doc_id")
        .groupBy("toxic", RUBRIC.holds(F.col("text")).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    )


@query("text_similarity_topk", sql=r"""
    WITH q AS (SELECT list_distinct(regexp_extract_all(lower(text), '\p{L}+')) AS qw FROM benchmark
               ORDER BY item_id LIMIT 1),
    d AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '\p{L}+')) AS dw FROM documents)
    SELECT doc_id, round(len(list_intersect(dw, qw)) / sqrt(len(dw)::DOUBLE * len(qw)), 6) AS similarity
    FROM d, q ORDER BY similarity DESC, doc_id LIMIT 10""")
def text_similarity_topk(t: Tables):
    """Documents closest to a given passage (the first benchmark item)."""
    passage = t.benchmark.orderBy("item_id").limit(1).select("text").scalar()
    docs = documents(t).select("doc_id", "text", passage.alias("passage"))
    score = F.round(tx.set_cosine(F.col("text"), F.col("passage")), 6)
    return tx.most_similar(docs, score, [F.asc("doc_id")], 10).select("doc_id", "similarity")


@query("text_tfidf_topk", sql=r"""
    WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS w FROM documents),
    q AS (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS w FROM (SELECT text FROM benchmark ORDER BY item_id LIMIT 1)),
    tf AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 8))::BIGINT % 4096 AS b, count(*) AS tf FROM t GROUP BY 1, 2),
    qf AS (SELECT ('0x' || substr(md5(w), 1, 8))::BIGINT % 4096 AS b, count(*) AS q FROM q GROUP BY 1),
    idf AS (SELECT b, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)::DOUBLE) + 1 AS idf FROM tf GROUP BY 1),
    len AS (SELECT sqrt(sum((q * idf) ** 2)) AS l FROM qf JOIN idf USING (b)),
    s AS (SELECT doc_id, sum(tf * idf * q * idf) AS dot, sum((tf * idf) ** 2) AS sq
          FROM tf JOIN idf USING (b) LEFT JOIN qf USING (b) GROUP BY 1)
    SELECT doc_id, round(dot / (sqrt(sq) * l), 6) AS similarity FROM s, len WHERE dot IS NOT NULL
    ORDER BY similarity DESC, doc_id LIMIT 10""")
def text_tfidf_topk(t: Tables):
    """Documents closest to the first benchmark item by hashed TF-IDF."""
    passage = t.benchmark.orderBy("item_id").limit(1).select("text")
    return tx.tfidf_similar(documents(t), "doc_id", "text", passage, 10)


@query("embedding_topk", sql="""
    WITH q AS (SELECT embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id = 0)
    SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], e), 6) AS similarity
    FROM embeddings, q WHERE vec_id <> 0 ORDER BY similarity DESC, vec_id LIMIT 10""")
def embedding_topk(t: Tables):
    """Vectors closest to vector 0."""
    vector = t.embeddings.filter("vec_id = 0").select("embedding").scalar()
    rows = t.embeddings.filter("vec_id <> 0").select("vec_id", "label", "embedding", vector.alias("q"))
    score = F.round(tx.vector_cosine(F.col("embedding"), F.col("q")), 6)
    return tx.most_similar(rows, score, [F.asc("vec_id")], 10).select("vec_id", "label", "similarity")


TOKENS_SQL = r"list_distinct(regexp_extract_all(lower(text), '\p{L}+'))"


@query("semantic_join", sql=f"""
    WITH lt AS (SELECT item_id, unnest({TOKENS_SQL}) AS token FROM benchmark),
    rt AS (SELECT doc_id, unnest({TOKENS_SQL}) AS token FROM documents),
    df AS (SELECT token, count(*) AS df FROM rt GROUP BY 1),
    w AS (SELECT item_id, token, ln(((SELECT count(*) FROM documents) + 1) / (coalesce(df, 0) + 1)::DOUBLE) AS w
          FROM lt LEFT JOIN df USING (token)),
    totals AS (SELECT item_id, sum(w) AS total FROM w GROUP BY 1 HAVING sum(w) > 1e-9),
    scored AS (SELECT item_id, doc_id, sum(w) / max(total) AS score
               FROM w JOIN rt USING (token) JOIN totals USING (item_id) GROUP BY 1, 2)
    SELECT item_id, doc_id, round(score, 6) AS score FROM scored WHERE score >= 0.6""")
def semantic_join(t: Tables):
    """Benchmark passages and the documents that describe the same thing."""
    pairs = tx.semantic_join(t.benchmark, "item_id", "text", documents(t), "doc_id", "text", 0.6)
    return pairs.select("item_id", "doc_id", F.round("score", 6).alias("score"))


@query("near_duplicate_pairs", sql=r"""
    WITH RECURSIVE all_words AS (SELECT doc_id, regexp_extract_all(lower(text), '\p{L}+') AS w FROM documents),
    w AS (SELECT * FROM all_words WHERE len(w) > 0),
    s AS (SELECT doc_id, unnest(list_distinct([array_to_string(w[i:i + 4], ' ')
            for i in generate_series(1, greatest(1, len(w) - 4))])) AS shingle FROM w),
    size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM s x JOIN s y USING (shingle)
               WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
    pairs AS (SELECT a, b FROM common JOIN size sa ON sa.doc_id = a JOIN size sb ON sb.doc_id = b
              WHERE common.n / (sa.n + sb.n - common.n)::DOUBLE >= 0.8),
    reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON pairs.a = reach.b)
    SELECT a AS doc_id, min(least(a, b)) AS original FROM reach GROUP BY 1""")
def near_duplicate_pairs(t: Tables):
    """Each document with a near copy, tied to the first document of its group."""
    return tx.near_duplicate_groups(documents(t), "doc_id", "text", threshold=0.8)


@query("text_digest", sql=f"""
    WITH d AS (SELECT doc_id, lang, {TOKENS_SQL} AS ws FROM documents),
    t AS (SELECT doc_id, lang, unnest(ws) AS word FROM d),
    g AS (SELECT lang, word, count(*) AS n FROM t GROUP BY 1, 2),
    o AS (SELECT word, sum(n) AS df FROM g GROUP BY 1),
    weighted AS (SELECT lang, word, round(n * ln((SELECT count(*) FROM documents) / df::DOUBLE), 6) AS weight
                 FROM g JOIN o USING (word)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY weight DESC, word) AS k FROM weighted),
    terms AS (SELECT lang, list(word ORDER BY k) AS terms FROM ranked WHERE k <= 10 GROUP BY 1),
    hits AS (SELECT d.lang AS lang, doc_id, terms, len(list_intersect(ws, terms)) AS h FROM d JOIN terms USING (lang))
    SELECT lang, count(*) AS n_docs, array_to_string(any_value(terms), ' ') AS terms,
           arg_max(doc_id, (h, -doc_id)) AS exemplar, max(h) AS hits FROM hits GROUP BY 1""")
def text_digest(t: Tables):
    """What the documents of each language are about, without reading them on the driver."""
    out = tx.digest(documents(t, "lang"), ["lang"], "doc_id", "text")
    return out.withColumn("terms", F.array_join("terms", " "))


@query("central_exemplars", sql=f"""
    WITH d AS (SELECT doc_id, lang, {TOKENS_SQL} AS ws FROM documents),
    t AS (SELECT doc_id, lang, unnest(ws) AS word FROM d),
    worth AS (SELECT word, floor(1000 * ln((SELECT count(*) FROM documents) / count(*)::DOUBLE))::BIGINT AS w FROM t GROUP BY 1),
    v AS (SELECT doc_id, lang, word, w, sqrt(sum(w * w) OVER (PARTITION BY doc_id)::DOUBLE) AS len
          FROM t JOIN worth USING (word) WHERE w > 0),
    u AS (SELECT doc_id, lang, word, floor(10000 * w / len)::BIGINT AS u FROM v),
    c AS (SELECT lang, word, sum(u) AS c FROM u GROUP BY 1, 2),
    l AS (SELECT lang, sqrt(sum(c * c)::DOUBLE) AS of_group FROM c GROUP BY 1),
    near AS (SELECT u.lang AS lang, doc_id, sum(u * c)::DOUBLE / sqrt(sum(u * u)::DOUBLE) AS near
             FROM u JOIN c ON c.word = u.word AND c.lang IS NOT DISTINCT FROM u.lang GROUP BY 1, 2 HAVING sum(u * u) > 0)
    SELECT near.lang AS lang, arg_max(doc_id, (near, -doc_id)) AS exemplar, round(max(near) / any_value(of_group), 6) AS closeness
    FROM near JOIN l ON l.lang IS NOT DISTINCT FROM near.lang GROUP BY 1""")
def central_exemplars(t: Tables):
    """The document of each language closest to the centroid of that language."""
    return tx.central_texts(documents(t, "lang"), ["lang"], "doc_id", "text")


@query("catalog_normalize", sql="""
    WITH raw AS (SELECT p_partkey, lower(left(p_type, 4)) || ' itm ' || p_name || ' sz ' || p_size || ' ref#' || (1000 + p_partkey) AS raw
                 FROM part),
    tokens AS (SELECT p_partkey, raw, list_filter(string_split_regex(raw, '\\s+'), lambda w: NOT starts_with(w, 'ref#')) AS ws FROM raw)
    SELECT p_partkey, raw AS raw_description, array_to_string(list_transform(ws, lambda w: CASE w
        WHEN 'econ' THEN 'economy' WHEN 'stan' THEN 'standard' WHEN 'prom' THEN 'promotional' WHEN 'larg' THEN 'large'
        WHEN 'smal' THEN 'small' WHEN 'medi' THEN 'medium' WHEN 'itm' THEN 'item' WHEN 'sz' THEN 'size' ELSE w END), ' ')
        AS description
    FROM tokens""")
def catalog_normalize(t: Tables):
    raw = F.concat_ws(" ", F.lower(F.left("p_type", F.lit(4))), F.lit("itm"), "p_name", F.lit("sz"),
                      F.col("p_size").cast("string"),
                      F.concat(F.lit("ref#"), (1000 + F.col("p_partkey")).cast("string")))
    return t.part.select("p_partkey", raw.alias("raw_description")).withColumn(
        "description", tx.normalize_catalog(F.col("raw_description"), ABBREVIATIONS, REFERENCE_CODE))


NAIVE_BAYES_SQL = r"""
    f AS (SELECT doc_id, list_distinct(list_transform(regexp_extract_all(lower(text), '\p{L}+'),
            lambda w: ('0x' || substr(md5(w), 1, 8))::BIGINT % 4096)) AS fs FROM documents),
    marked AS (SELECT doc_id, fs, quality::DOUBLE AS label, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 100 < 20 AS held
               FROM f LEFT JOIN labels USING (doc_id)),
    fitted AS (SELECT * FROM marked WHERE label IS NOT NULL AND NOT held),
    cells AS (SELECT label, w, count(*) AS n FROM (SELECT label, unnest(fs) AS w FROM fitted) GROUP BY 1, 2),
    priors AS (SELECT label, ln(count(*)) AS prior FROM fitted GROUP BY 1),
    totals AS (SELECT label, ln(sum(n) + 4096) AS log_all FROM cells GROUP BY 1),
    asked AS (SELECT doc_id, fs FROM marked WHERE label IS NULL OR held),
    hits AS (SELECT doc_id, label, sum(ln(n + 1)) AS hit FROM (SELECT doc_id, unnest(fs) AS w FROM asked) JOIN cells USING (w) GROUP BY 1, 2),
    scored AS (SELECT a.doc_id AS doc_id, p.label AS label,
                 round(prior + coalesce(hit, 0) - len(fs) * log_all, 6) AS score
               FROM asked a CROSS JOIN priors p JOIN totals t ON t.label = p.label
                 LEFT JOIN hits h ON h.doc_id = a.doc_id AND h.label = p.label),
    model AS (SELECT doc_id, arg_min(label, (-score, label)) AS guess FROM scored GROUP BY 1),
    agreement AS (SELECT avg((guess = label)::INT) AS share FROM marked JOIN model USING (doc_id) WHERE held AND label IS NOT NULL)"""


@query("distilled_classifier", sql=f"""
    WITH {NAIVE_BAYES_SQL}
    SELECT doc_id, coalesce(label, CASE WHEN share >= 0.7 THEN guess END) AS prediction,
           CASE WHEN label IS NOT NULL THEN 'labeller' WHEN share >= 0.7 THEN 'model' ELSE 'unlabelled' END AS served_by
    FROM marked LEFT JOIN model USING (doc_id) CROSS JOIN agreement""")
def distilled_classifier(t: Tables):
    """Quality of all documents: the label where there is one, else a model of the labelled ones."""
    labelled = t.labels.select("doc_id", F.col("quality").cast("double").alias("label"))
    return distill.classify(documents(t), "doc_id", "text", labelled)


@query("vector_classifier")
def vector_classifier(t: Tables):
    """Labels of all vectors: the labeller answered for some 30 of 100, a model of those serves the others.

    An iterative fit has no SQL; tests hold it against the labels it has not seen.
    """
    vectors = t.embeddings
    asked = md5_bucket(100, F.concat(F.lit("labeller "), F.col("vec_id").cast("string"))) < 30
    return distill.classify_vectors(vectors, "vec_id", "embedding", vectors.filter(asked).select("vec_id", "label"))


SQL_FIELDS = (Field("first_number", "bigint", r"\b([0-9]{1,9})\b", "-1"),)


@query("sql_text_functions", sql=rf"""
    SELECT doc_id, {classify_sql()} AS category, round({SCORE_SQL}, 6) AS score,
           coalesce(try_cast(nullif(regexp_extract(text, '\b([0-9]{{1,9}})\b', 1), '') AS BIGINT), -1) AS first_number,
           'lang ' || coalesce(lang, '') || ', ' || coalesce(source, '') AS context
    FROM documents WHERE {SCORE_SQL} >= 2.0""")
def sql_text_functions(t: Tables):
    """Predicate, class, score, extraction and null-safe context, all called from SQL over a view."""
    sql_functions.register(
        t.spark, {"doc_score": RUBRIC}, {"doc_class": (RUBRIC, CATEGORIES)},
        predicates={"needs_review": (RUBRIC, 2.0)}, extractors={"doc_fields": SQL_FIELDS})
    sql_functions.table(t.spark, "reviewed_documents", documents(t, "source", "lang"))
    return t.spark.sql("""
        SELECT doc_id, doc_class(text) AS category, round(doc_score(text), 6) AS score,
               doc_fields(text).first_number AS first_number, context_of('lang ', lang, ', ', source) AS context
        FROM reviewed_documents WHERE needs_review(text)""")
