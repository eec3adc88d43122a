"""Checked queries: whole pipelines, from sections to evidence, predictions and scores."""

from pyspark.sql import functions as F

from evidenza.functions.encoders import encode_column
from evidenza.operators import classify as C
from evidenza.operators import evaluate as V
from evidenza.plans import evidence as plan
from evidenza.plans.answer_queries import IGNORED, LEXICON, PATTERNS, PREDICTIONS, RULES, TAGGED, YEARS
from evidenza.plans.catalog import Tables, query
from evidenza.plans.text_queries import BEST_CHUNKS, CountEncoder, buckets_sql

THRESHOLD = 0.5

EVIDENCE = (
    BEST_CHUNKS
    + """,
placed AS (
  SELECT d.source AS country, s.question_id, s.score, s.chunk, 'https://example.org/' || d.doc_id AS source_url,
         row_number() OVER (PARTITION BY d.source, s.question_id
           ORDER BY s.score DESC, 'https://example.org/' || d.doc_id, d.lang, s.chunk_idx) AS place
  FROM scored s JOIN documents d ON d.doc_id = s.doc_id),
evidence AS (SELECT * EXCLUDE (place) FROM placed WHERE place = 1)
"""
)


def _sections(t: Tables):
    url = F.concat(F.lit("https://example.org/"), "doc_id")
    return t.documents.select(
        url.alias("section_url"),
        F.col("source").alias("country_doc_id"),
        F.col("lang").alias("section_title"),
        F.col("text").alias("text_content"),
    )


def _countries(t: Tables):
    return t.documents.select(F.col("source").alias("doc_id"), F.lit("https://example.org/").alias("country_url")).distinct()


def _questions(t: Tables):
    labels = F.array(*[F.lit(x) for x in C.LABELS])
    return t.benchmark.select(
        F.col("item_id").alias("question_id"),
        F.get(labels, F.pmod("item_id", F.lit(len(C.LABELS))).cast("int")).alias("label"),
        encode_column(F.col("text"), CountEncoder).alias("embedding"),
    )


def _evidence(t: Tables, country: str | None = None):
    return plan.find_evidence(_sections(t), _countries(t), _questions(t), CountEncoder, country)


@query("pipeline_evidence", EVIDENCE + "SELECT country, question_id, score, md5(chunk) AS chunk_md5, source_url FROM evidence")
def pipeline_evidence(t: Tables):
    return _evidence(t).select("country", "question_id", "score", F.md5("chunk").alias("chunk_md5"), "source_url")


@query(
    "pipeline_evidence_country",
    EVIDENCE + "SELECT country, question_id, score, md5(chunk) AS chunk_md5, source_url FROM evidence WHERE country = 'src1'",
)
def pipeline_evidence_country(t: Tables):
    return _evidence(t, "src1").select("country", "question_id", "score", F.md5("chunk").alias("chunk_md5"), "source_url")


ANSWERS = (
    EVIDENCE
    + f""",
answers AS (
  SELECT country || '/' || question_id AS doc_id, country, question_id, source_url, '' AS lang, country AS source, 0 AS n_chars,
         'Answer/Evidence (Similarity: ' || printf('%.4f', score) || '):' || chr(10) || chunk AS text
  FROM evidence),
ab AS MATERIALIZED ({buckets_sql('answers', 'doc_id', 'text')}),
an AS (SELECT doc_id, sqrt(CAST(sum(n * n) AS DOUBLE)) AS norm FROM ab GROUP BY doc_id),
alike AS (
  SELECT a.doc_id, CAST(sum(ab.n * qb.n) AS DOUBLE) AS dot FROM answers a JOIN ab USING (doc_id)
  JOIN qb ON qb.item_id = a.question_id AND qb.bucket = ab.bucket GROUP BY a.doc_id),
{TAGGED.replace("FROM documents", "FROM answers")},
asked AS (
  SELECT t.*, a.country, a.question_id, a.source_url, {list(C.LABELS)}[a.question_id % {len(C.LABELS)} + 1] AS label,
         coalesce(dot / (an.norm * qn.norm), 0) AS conf
  FROM tagged t JOIN answers a USING (doc_id) JOIN an USING (doc_id) JOIN qn ON qn.item_id = a.question_id
  LEFT JOIN alike s USING (doc_id)),
"""
    + PREDICTIONS[PREDICTIONS.index("ruled AS (") :]
    .replace("0.7::DOUBLE", f"{THRESHOLD}::DOUBLE")
    .replace("SELECT doc_id, source,", "SELECT doc_id, country, question_id, conf, source,")
)


@query(
    "pipeline_predictions",
    ANSWERS
    + """
SELECT country, question_id, label, yes_no, explanation, array_to_string(years, ',') AS years,
       array_to_string(sectors, ',') AS sectors, md5(quote) AS quote_md5, confidence, source_url
FROM predictions
""",
)
def pipeline_predictions(t: Tables):
    questions = _questions(t)
    found = plan.predict(
        _evidence(t), questions, CountEncoder, rules=RULES, threshold=THRESHOLD, flag_patterns=PATTERNS, ignored=IGNORED,
        year_patterns=YEARS, year_phrases={}, lexicon=LEXICON,
    )
    return found.select(
        "country", "question_id", "label", "yes_no", "explanation", F.array_join("year", ",").alias("years"),
        F.array_join("sectors", ",").alias("sectors"), F.md5("quote").alias("quote_md5"),
        "confidence", "source_url",
    )


@query(
    "pipeline_scores",
    f"""
WITH cells AS (
  SELECT d.doc_id AS country, label,
         CAST(coalesce(quality = 1 AND (label <> 'carbon_pricing' OR toxic = 0), false) AS INTEGER) AS y_true,
         CAST(coalesce(contains(lower(d.text), 'the ') AND (label <> 'sector_targets' OR d.lang = 'en'), false) AS INTEGER) AS y_pred
  FROM documents d JOIN labels t ON t.doc_id = d.doc_id, (SELECT unnest({list(C.LABELS)}) AS label)),
counted AS (
  SELECT CASE WHEN grouping(label) = 1 AND grouping(country) = 1 THEN 'overall' WHEN grouping(country) = 1 THEN 'label' ELSE 'country' END AS level,
         label, country, count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp, count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp,
         count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn
  FROM cells GROUP BY GROUPING SETS ((), (label), (country)))
SELECT level, label, country, tp, fp, fn, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) + 0.0 AS "precision",
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) + 0.0 AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) + 0.0 AS f1
FROM counted
""",
)
def pipeline_scores(t: Tables):
    """Documents as countries: all are predicted, those with labels are scored."""
    labels = F.explode(F.array(*[F.lit(x) for x in C.LABELS])).alias("label")

    def answer(holds):
        return F.when(holds, "yes").otherwise("no").alias("yes_no")

    truth = t.labels.select(F.col("doc_id").alias("country"), "quality", "toxic", labels)
    truth = truth.select(
        "country", "label", answer((F.col("quality") == 1) & ((F.col("label") != "carbon_pricing") | (F.col("toxic") == 0)))
    )
    found = F.contains(F.lower("text"), F.lit("the "))
    predictions = t.documents.select(F.col("doc_id").alias("country"), "lang", found.alias("found"), labels).select(
        "country", "label", answer(F.col("found") & ((F.col("label") != "sector_targets") | (F.col("lang") == "en")))
    )
    rounded = [(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("precision", "recall", "f1")]
    return V.evaluate(truth, predictions).select(
        "level", "label", "country", "tp", "fp", "fn", *rounded
    )
