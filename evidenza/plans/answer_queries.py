"""Checked queries: tags, rules, predictions, evaluation, confidence and boxes."""

from pyspark.sql import functions as F

from evidenza.operators import boxes as B
from evidenza.operators import classify as C
from evidenza.operators import evaluate as V
from evidenza.operators.embed import masked_mean_pool
from evidenza.plans.catalog import Tables, query
from evidenza.functions.lexicon import Lexicon, terms
from evidenza.functions.text import capitalize
from evidenza.plans.text_queries import REPORTS, SCORES, _masked, _reports
from evidenza.schemas import PREDICTION
from evidenza.sources.readers import explode_nested

# The given documents hold invented prose, so these queries bring word lists
# and rules that occur in it; the operators' defaults are tested on fixtures.
YEARS = (r"(?U)\b(\d{4})\b",)
TERMS = r"(?iU)\b(the|und|der|les|license|licence|copyright|mail|para)\b"
FLAGS = {
    "article": "(?iu)the ",
    "licence": "(?iu)licen[sc]e",
    "number": "[0-9]{3}",
    # one character on either side tells as much as all of them
    "mail": r"[^ \t\r\n]@[^ \t\r\n]",
}
PATTERNS = {n: FLAGS[n] for n in ("number", "mail")}
WORDS_FOUND = ("the", "und", "der", "les", "license", "licence", "copyright", "mail", "para")
LEXICON = Lexicon((
    *terms("article", ("the ",)),
    *terms("licence", ("license", "licence")),
    *terms("sector", WORDS_FOUND, whole=True),
    *terms("negation", ("nicht", "non")),
))
IGNORED = {"number": r"https?://[^ \t\r\n]+"}
NEGATION = "(?iu)nicht|non"
RULES = (
    C.Rule("net_zero_target", ("article",), "yes", "Uses the article."),
    C.Rule("sector_targets", ("licence",), "yes", "Mentions a licence."),
    C.Rule("efficiency_target", ("article", "number"), "yes", "Article and number."),
    C.Rule("efficiency_target", ("article",), "soft_yes", "Article without a number."),
    C.Rule("electricity_net_zero", ("mail", "number"), "soft_yes", "Address and number."),
    C.Rule("electricity_net_zero", ("mail",), "yes", "Address only."),
    C.Rule("carbon_pricing", ("number",), "yes", "Mentions a number."),
)

# --- SQL building blocks ----------------------------------------------------

WORDS = r"string_split_regex(text, '[^\p{L}\p{M}\p{N}_]+')"
YEARS_SQL = (
    f"nullif(list_sort(list_distinct(list_filter({WORDS}, "
    "lambda w: regexp_full_match(w, '[0-9]{4}'))), 'ASC', 'NULLS FIRST'), [])"
)
TERM_LIST = "['the', 'und', 'der', 'les', 'license', 'licence', 'copyright', 'mail', 'para']"
TERMS_SQL = (
    f"nullif(list_sort(list_distinct(list_transform(list_filter({WORDS}, "
    f"lambda w: list_contains({TERM_LIST}, lower(w))), "
    "lambda w: upper(left(w, 1)) || lower(substr(w, 2)))), 'ASC', 'NULLS FIRST'), [])"
)
NOTE = C.NEGATION_NOTE.replace("'", "''")

TAGGED = rf"""
tagged AS (
  SELECT doc_id, text, lang, source, n_chars,
         contains(lower(text), 'the ') AS article, regexp_matches(text, '(?i)licen[sc]e') AS licence,
         regexp_matches(regexp_replace(text, 'https?://[^ \t\r\n]+', '', 'g'), '[0-9]{{3}}') AS number,
         regexp_matches(text, '[^ \t\r\n]+@[^ \t\r\n]+') AS mail,
         regexp_matches(text, '(?i)nicht|non') AS negated,
         {YEARS_SQL} AS years, {TERMS_SQL} AS sectors
  FROM documents)
"""

PREDICTIONS = f"""
WITH {TAGGED},
asked AS (
  SELECT t.*, label, CASE WHEN lang <> 'de' THEN n_chars / (n_chars + 300.0::DOUBLE) END AS conf,
         CASE WHEN lang <> 'es' THEN 'https://example.org/' || doc_id END AS source_url
  FROM tagged t CROSS JOIN (SELECT unnest({list(C.LABELS)}) AS label)),
ruled AS (
  SELECT *, coalesce(conf < 0.7::DOUBLE, FALSE) AS low,
    CASE label
      WHEN 'net_zero_target' THEN CASE WHEN article THEN 'yes|Uses the article.' END
      WHEN 'sector_targets' THEN CASE WHEN licence THEN 'yes|Mentions a licence.' END
      WHEN 'efficiency_target' THEN CASE WHEN article AND number THEN 'yes|Article and number.'
                                         WHEN article THEN 'soft_yes|Article without a number.' END
      WHEN 'electricity_net_zero' THEN CASE WHEN mail AND number THEN 'soft_yes|Address and number.'
                                            WHEN mail THEN 'yes|Address only.' END
      ELSE CASE WHEN number THEN 'yes|Mentions a number.' END END AS verdict
  FROM asked),
predictions AS (
  SELECT doc_id, source, lang, label, negated, low, years, sectors, source_url, round(conf, 4) AS confidence, left(text, 300) AS quote,
         CASE WHEN low THEN 'low_confidence' WHEN verdict IS NULL THEN 'no' ELSE split_part(verdict, '|', 1) END AS yes_no,
         CASE WHEN low THEN 'Low semantic similarity.'
              ELSE split_part(verdict, '|', 2) || CASE WHEN negated THEN '{NOTE}' ELSE '' END END AS explanation
  FROM ruled)
"""


def _predictions(t: Tables):
    """Every document as the answer to all five questions."""
    length = F.col("n_chars").cast("double")
    documents = t.documents.select("doc_id", "text", "lang", "n_chars").select(
        F.col("doc_id").alias("country"),
        F.col("text").alias("answer_text"),
        F.when(F.col("lang") != "de", length / (length + 300.0)).alias("confidence"),
        F.when(F.col("lang") != "es", F.concat(F.lit("https://example.org/"), "doc_id")).alias("source_url"),
    )
    tagged = C.tag_answers(
        documents,
        flag_patterns=PATTERNS,
        ignored=IGNORED,
        year_patterns=YEARS,
        year_phrases={},
        lexicon=LEXICON,
    ).drop("answer_text")
    asked = tagged.withColumn("label", F.explode(F.array(*[F.lit(x) for x in C.LABELS])))
    return C.apply_rules(asked, rules=RULES)


# --- blocks and labels ------------------------------------------------------


@query(
    "qa_blocks",
    """
SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer
FROM conversations u LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
WHERE u.role = 'user'
""",
)
def qa_blocks(t: Tables):
    # joined on (conversation, turn), which is unique: a very long conversation does not meet in one task
    asked = t.conversations.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    given = t.conversations.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(given, ["conv_id", "turn"], "left")


@query(
    "report_blocks",
    REPORTS
    + """
SELECT e.country, CAST(question_id AS INTEGER) AS block_no,
       'Question ' || (question_id + 1) || ': ' || trim(regexp_replace(b.text, '[\\r\\n]+', ' ', 'g'), E' \\t\\r\\n') AS question,
       'Answer/Evidence (Similarity: ' || printf('%.4f', score) || '):' AS header,
       md5(trim(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
             replace(chunk, chr(10), ' '), '^(#{1,6}\\s*|[-*+]\\s+)', ''),
             '(^|\\s)\\*\\*(\\s|$)', '\\1' || chr(3) || '\\2', 'g'), '(^|\\s)\\*\\*(\\s|$)', '\\1' || chr(3) || '\\2', 'g'),
             '\\*\\*(.+?)\\*\\*', '\\1', 'g'), chr(3), '**'), E' \\t\\r\\n')) AS evidence_md5,
       'https://example.org/' || doc_id AS source_url
FROM best e JOIN benchmark b ON b.item_id = e.question_id
""",
)
def report_blocks(t: Tables):
    blocks = C.answer_blocks(_reports(t).withColumnRenamed("report", "value"))
    return blocks.select(
        "country", "block_no", "question", "header", F.md5("evidence").alias("evidence_md5"), "source_url"
    )


@query(
    "label_attach",
    "SELECT conv_id, turn AS block_no, n_name AS label, length(text) AS n_chars FROM conversations JOIN nation ON n_nationkey = turn",
)
def label_attach(t: Tables):
    blocks = t.conversations.select(
        "conv_id", F.col("turn").alias("block_no"), F.length("text").cast("bigint").alias("n_chars")
    )
    labels = t.nation.select(F.col("n_nationkey").cast("bigint").alias("block_no"), F.col("n_name").alias("label"))
    return C.attach_labels(blocks, labels)


# --- tags -------------------------------------------------------------------


@query(
    "extract_years",
    f"SELECT doc_id, array_to_string({YEARS_SQL}, ',') AS years FROM documents",
)
def extract_years(t: Tables):
    years = C.extract_years(F.col("text"), YEARS, {})
    return t.documents.select("doc_id", "text").select("doc_id", F.array_join(years, ",").alias("years"))


@query(
    "extract_terms",
    f"SELECT doc_id, array_to_string({TERMS_SQL}, ',') AS terms FROM documents",
)
def extract_terms(t: Tables):
    terms = C.extract_terms(F.col("text"), TERMS)
    return t.documents.select("doc_id", "text").select("doc_id", F.array_join(terms, ",").alias("terms"))


@query("flag_terms", f"WITH {TAGGED} SELECT doc_id, article, licence, number, mail FROM tagged")
def flag_terms(t: Tables):
    flags = C.flag_terms(F.col("text"), FLAGS, IGNORED)
    return t.documents.select("doc_id", "text").select("doc_id", *[c.alias(n) for n, c in flags.items()])


@query(
    "lexicon_scan",
    rf"""
SELECT doc_id, contains(lower(text), 'the ') AS article, regexp_matches(text, '(?i)licen[sc]e') AS licence,
       regexp_matches(text, '(?i)nicht|non') AS negated, array_to_string({TERMS_SQL}, ',') AS terms FROM documents
""",
)
def lexicon_scan(t: Tables):
    found = t.documents.select("doc_id", LEXICON.mask(F.col("text")).alias("mask"))
    listed = F.array_sort(F.transform(LEXICON.listed(F.col("mask"), "sector"), capitalize))
    marks = [LEXICON.marked(F.col("mask"), m).alias(n) for m, n in (("article", "article"), ("licence", "licence"), ("negation", "negated"))]
    return found.select("doc_id", *marks, F.array_join(F.nullif(listed, F.array().cast("array<string>")), ",").alias("terms"))


@query("quote_prefix", "SELECT doc_id, left(text, 300) AS quote FROM documents")
def quote_prefix(t: Tables):
    return t.documents.select("doc_id", F.left("text", F.lit(C.QUOTE_CHARS)).alias("quote"))


@query(
    "negation_note",
    PREDICTIONS
    + "SELECT doc_id AS country, label, yes_no, explanation FROM predictions WHERE negated AND yes_no IN ('yes', 'soft_yes')",
)
def negation_note(t: Tables):
    noted = F.coalesce(F.col("explanation").endswith(C.NEGATION_NOTE), F.lit(False))
    return _predictions(t).filter(noted).select("country", "label", "yes_no", "explanation")


# --- confidence and rules ---------------------------------------------------


@query(
    "confidence_gate",
    SCORES
    + """,
s AS (SELECT vec_id, list_dot_product(v, centroid) / (vn.norm * cn.norm) AS conf FROM vn JOIN cn ON cn.question_id = vn.label)
SELECT vec_id, round(conf, 4) + 0.0 AS confidence, CASE WHEN conf < 0.7::DOUBLE THEN 'low_confidence' ELSE 'rules' END AS gate FROM s
""",
)
def confidence_gate(t: Tables):
    pooled = masked_mean_pool(_masked(t), ["label"]).withColumnRenamed("embedding", "question")
    scored = t.embeddings.join(pooled, "label").withColumn(
        "conf", C.confidence(F.col("question"), F.col("embedding"))
    )
    gate = F.when(C.is_low_confidence(F.col("conf")), C.LOW_CONFIDENCE).otherwise("rules")
    return scored.select("vec_id", (F.round("conf", 4) + F.lit(0.0)).alias("confidence"), gate.alias("gate"))


@query(
    "classify_rules",
    PREDICTIONS
    + """
SELECT doc_id AS country, label, yes_no, explanation, confidence, array_to_string(years, ',') AS years,
       array_to_string(sectors, ',') AS sectors, md5(quote) AS quote_md5, source_url FROM predictions
""",
)
def classify_rules(t: Tables):
    return _predictions(t).select(
        "country", "label", "yes_no", "explanation", "confidence",
        F.array_join("year", ",").alias("years"), F.array_join("sectors", ",").alias("sectors"),
        F.md5("quote").alias("quote_md5"), "source_url",
    )


# --- prediction pages and files ---------------------------------------------

CONFIDENCE_TEXT = "CAST(confidence AS VARCHAR)"
PAGES = (
    PREDICTIONS
    + f""",
blocks AS (
  SELECT doc_id, list_position({list(C.LABELS)}, label) AS place, concat_ws(chr(10) || chr(10),
    '## ' || CASE label WHEN 'net_zero_target' THEN 'Net Zero Target' WHEN 'sector_targets' THEN 'Sector Targets'
       WHEN 'efficiency_target' THEN 'Efficiency Target' WHEN 'electricity_net_zero' THEN 'Electricity Net Zero' ELSE 'Carbon Pricing' END,
    '- **Answer**: `' || yes_no || '`', '- **Explanation**: ' || coalesce(explanation, 'None'),
    '- **Year(s)**: ' || array_to_string(years, ', '), '- **Sector(s)**: ' || array_to_string(sectors, ', '),
    '- **Confidence**: ' || coalesce({CONFIDENCE_TEXT}, 'None'), '- **Source URL**: ' || coalesce(source_url, 'None'),
    '> ' || replace(quote, chr(10), ' ') || chr(10)) AS block FROM predictions),
pages_out AS (
  SELECT doc_id, '# Policy Targets for Document ' || doc_id || chr(10) || chr(10) || chr(10)
         || string_agg(block, chr(10) || chr(10) ORDER BY place) AS page FROM blocks GROUP BY doc_id)
"""
)


def _pages(t: Tables):
    title = F.concat(F.lit("Document "), F.col("country"))
    return C.country_pages(_predictions(t), title)


@query(
    "country_page_render",
    PAGES + "SELECT doc_id AS country, length(page) AS n_chars, md5(page) AS page_md5 FROM pages_out",
)
def country_page_render(t: Tables):
    return _pages(t).select("country", F.length("page").cast("bigint").alias("n_chars"), F.md5("page").alias("page_md5"))


@query(
    "page_confidence",
    PREDICTIONS + "SELECT doc_id AS country, label, confidence FROM predictions WHERE confidence IS NOT NULL",
)
def page_confidence(t: Tables):
    return V.page_confidences(_pages(t).withColumnRenamed("page", "value"))


@query(
    "nested_predictions",
    PREDICTIONS
    + """
SELECT CAST(doc_id AS VARCHAR) AS country, label, yes_no, explanation, confidence, array_to_string(years, ',') AS years,
       array_to_string(sectors, ',') AS sectors, md5(quote) AS quote_md5, source_url FROM predictions
""",
)
def nested_predictions(t: Tables):
    nested = C.nest_predictions(_predictions(t).withColumn("country", F.col("country").cast("string")))
    lines = nested.select(F.to_json(F.create_map("country", "predictions")).alias("value"))
    return explode_nested(lines, PREDICTION).select(
        "country", "label", "yes_no", "explanation", "confidence",
        F.array_join("year", ",").alias("years"), F.array_join("sectors", ",").alias("sectors"),
        F.md5("quote").alias("quote_md5"), "source_url",
    )


# --- evaluation -------------------------------------------------------------


def _label_answers(t: Tables):
    """Hand labels as answers: quality as yes / no, toxic as soft_yes / low_confidence."""
    quality = F.when(F.col("quality") == 1, "Yes").otherwise("no")
    toxic = F.when(F.col("toxic") == 1, "soft_yes").otherwise("low_confidence")
    pair = F.array(
        F.struct(F.lit("quality").alias("label"), quality.alias("yes_no")),
        F.struct(F.lit("toxic").alias("label"), toxic.alias("yes_no")),
    )
    return t.labels.select(F.col("doc_id").alias("country"), F.inline(pair))


@query(
    "binarize",
    """
SELECT d.doc_id AS country, x.label, CAST(coalesce(CASE x.label WHEN 'quality' THEN l.quality = 1 ELSE l.toxic = 1 END, FALSE) AS INTEGER) AS flag
FROM documents d CROSS JOIN (SELECT unnest(['quality', 'toxic']) AS label) x LEFT JOIN labels l ON l.doc_id = d.doc_id
""",
)
def binarize(t: Tables):
    countries = t.documents.select(F.col("doc_id").alias("country"))
    return V.binarize(countries, _label_answers(t), labels=("quality", "toxic"))


@query(
    "eval_alignment",
    """
SELECT coalesce(l.doc_id, e.vec_id) AS country,
       CASE WHEN l.doc_id IS NOT NULL AND e.vec_id IS NOT NULL THEN 'both' WHEN l.doc_id IS NOT NULL THEN 'skipped' ELSE 'extra' END AS status
FROM labels l FULL OUTER JOIN embeddings e ON e.vec_id = l.doc_id
""",
)
def eval_alignment(t: Tables):
    truth = t.labels.select(F.col("doc_id").alias("country"))
    return V.align_countries(truth, t.embeddings.select(F.col("vec_id").alias("country")))


CELLS = """
WITH cells AS (
  SELECT d.source AS country, d.lang AS label, l.quality AS y_true, CAST(contains(lower(d.text), 'the ') AS INTEGER) AS y_pred
  FROM documents d JOIN labels l USING (doc_id)),
counts AS (
  SELECT CASE WHEN grouping(label) = 1 AND grouping(country) = 1 THEN 'overall' WHEN grouping(country) = 1 THEN 'label' ELSE 'country' END AS level,
         label, country, count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp, count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp,
         count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn
  FROM cells GROUP BY GROUPING SETS ((), (label), (country))),
scores AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0.0::DOUBLE END AS p,
         CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0.0::DOUBLE END AS r,
         CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) ELSE 0.0::DOUBLE END AS f FROM counts)
"""


def _scores(t: Tables):
    cells = t.documents.join(t.labels, "doc_id").select(
        F.col("source").alias("country"),
        F.col("lang").alias("label"),
        F.col("quality").alias("y_true"),
        F.contains(F.lower("text"), F.lit("the ")).cast("int").alias("y_pred"),
    )
    return V.precision_recall_f1(cells)


@query(
    "prf_grouping_sets",
    CELLS + 'SELECT level, label, country, tp, fp, fn, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1 FROM scores',
)
def prf_grouping_sets(t: Tables):
    rounded = [F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")]
    return _scores(t).select("level", "label", "country", "tp", "fp", "fn", *rounded)


@query(
    "evaluation_summary",
    CELLS
    + """
SELECT 1 AS block, -1 AS place, '' AS name, '## ✅ Overall Evaluation Results' AS line
UNION ALL SELECT 1, 0, '', '- **Precision:** ' || printf('%.2f', p) || chr(10) || '- **Recall:** ' || printf('%.2f', r) || chr(10)
       || '- **F1-score:** ' || printf('%.2f', f) || chr(10) FROM scores WHERE level = 'overall'
UNION ALL SELECT 2, -1, '', '## 📊 Per-label Performance' || chr(10) || '| Target Field           | Precision | Recall | F1-score |' || chr(10)
       || '|------------------------|-----------|--------|----------|'
UNION ALL SELECT 2, CASE label WHEN 'de' THEN 1 WHEN 'en' THEN 2 WHEN 'es' THEN 3 ELSE 4 END, label,
       '| ' || rpad(label, 22, ' ') || ' | ' || printf('%.2f', p) || '     | ' || printf('%.2f', r) || '  | ' || printf('%.2f', f) || '    |'
       FROM scores WHERE level = 'label'
UNION ALL SELECT 3, -1, '', chr(10) || '## 🗺️ Per-country Performance' || chr(10) || '| Country          | Precision | Recall | F1-score |' || chr(10)
       || '|------------------|-----------|--------|----------|'
UNION ALL SELECT 3, 0, country,
       '| ' || rpad(country, 16, ' ') || ' | ' || printf('%.2f', p) || '     | ' || printf('%.2f', r) || '  | ' || printf('%.2f', f) || '    |'
       FROM scores WHERE level = 'country'
""",
)
def evaluation_summary(t: Tables):
    return V.summary_lines(_scores(t), labels=("de", "en", "es", "fr"))


@query(
    "truth_template",
    f"SELECT source AS country, label, 'no' AS yes_no FROM (SELECT DISTINCT source FROM documents WHERE source <> ''), (SELECT unnest({list(C.LABELS)}) AS label)",
)
def truth_template(t: Tables):
    return V.truth_template(t.documents.select(F.col("source").alias("country")))


# --- confidence tables ------------------------------------------------------

CONFIDENCES = """
WITH conf AS (SELECT d.source AS country, d.lang AS label, CAST(sum(l.quality) AS DOUBLE) / count(*) AS confidence
              FROM documents d JOIN labels l USING (doc_id) GROUP BY ALL)
"""
LANGS = ("de", "en", "es", "fr")


def _confidences(t: Tables):
    return (
        t.documents.select("doc_id", "source", "lang")
        .join(t.labels, "doc_id")
        .groupBy(F.col("source").alias("country"), F.col("lang").alias("label"))
        .agg((F.sum("quality").cast("double") / F.count("*")).alias("confidence"))
    )


@query(
    "confidence_pivot",
    CONFIDENCES
    + "SELECT country, "
    + ", ".join(f'round(coalesce(max(confidence) FILTER (label = \'{x}\'), 0), 6) AS "{x}"' for x in LANGS)
    + " FROM conf GROUP BY country",
)
def confidence_pivot(t: Tables):
    matrix = V.confidence_pivot(_confidences(t), LANGS)
    return matrix.select("country", *[F.round(x, 6).alias(x) for x in LANGS])


@query(
    "confidence_annot",
    CONFIDENCES
    + "SELECT country, label, printf('%.2f', confidence) || CASE WHEN confidence < 0.7::DOUBLE THEN ' 🟥' ELSE '' END AS note FROM conf",
)
def confidence_annot(t: Tables):
    note = V.confidence_annotation(F.col("confidence"))
    return _confidences(t).select("country", "label", note.alias("note"))


@query(
    "low_confidence_counts",
    CONFIDENCES + "SELECT country, count(*) AS low_confidence_count FROM conf WHERE confidence < 0.7::DOUBLE GROUP BY country",
)
def low_confidence_counts(t: Tables):
    return V.low_confidence_counts(_confidences(t))


@query("pca_projection")
def pca_projection(t: Tables):
    points = V.project_2d(t.embeddings, "vec_id", "embedding")
    return points.select("vec_id", *[F.round(c, 6).alias(c) for c in ("pc1", "pc2")])


# --- boxes ------------------------------------------------------------------


@query(
    "qa_template",
    "SELECT n_nationkey, 'Has ' || n_name || ' set a target? Where is ' || n_name || '?' AS question FROM nation",
)
def qa_template(t: Tables):
    template = F.lit("Has {country} set a target? Where is {country}?")
    return t.nation.select("n_nationkey", B.fill_template(template, F.col("n_name")).alias("question"))


@query("select_names", "SELECT n_name AS name FROM nation WHERE n_name IN ('NATION_3', 'NATION_7', 'NATION_21')")
def select_names(t: Tables):
    return B.select_names(t.nation.select(F.col("n_name").alias("name")), "NATION_3, NATION_7 ,ATLANTIS,NATION_21")


ASKED = {
    "AUTOMOBILE": "Does {country} buy cars?",
    "BUILDING": "Does {country} build?",
    "MACHINERY": "Does {country} make machines?",
}


def _keyed_nations(t: Tables):
    names = t.nation.select(F.col("n_name").alias("name"))
    return B.with_keys(names, {"NATION_3": "nation-three"})


def _segment_predictions(t: Tables):
    """Customers per (nation, segment); nations 3 and 7 under keys of their own."""
    nation = F.col("c_nationkey")
    key = (
        F.when(nation == 3, "nation-three")
        .when(nation == 7, "nation-seven")
        .otherwise(F.concat(F.lit("nation_"), nation))
    )
    return t.customer.groupBy(key.alias("country"), F.col("c_mktsegment").alias("label")).agg(
        F.count("*").alias("n")
    )


@query(
    "qa_lookup",
    """
WITH p AS (SELECT c_nationkey AS k, c_mktsegment AS label, count(*) AS n FROM customer WHERE c_nationkey <> 7 GROUP BY ALL)
SELECT n_name AS name, label, CASE label WHEN 'AUTOMOBILE' THEN 'Does ' || n_name || ' buy cars?' WHEN 'BUILDING' THEN 'Does ' || n_name || ' build?'
       ELSE 'Does ' || n_name || ' make machines?' END AS question, n
FROM nation JOIN p ON k = n_nationkey WHERE label IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')
""",
)
def qa_lookup(t: Tables):
    found = B.lookup_predictions(_keyed_nations(t), _segment_predictions(t), ASKED)
    return found.select("name", "label", "question", "n")


@query(
    "qa_unmatched",
    "SELECT n_name AS name FROM nation WHERE n_nationkey = 7 OR n_nationkey NOT IN (SELECT c_nationkey FROM customer)",
)
def qa_unmatched(t: Tables):
    return B.unmatched_names(_keyed_nations(t), _segment_predictions(t)).select("name")


QUESTION_OF = {
    "net_zero_target": "Has {country} set a net zero target?",
    "efficiency_target": "Is {country} efficient?",
    "carbon_pricing": "Does {country} price carbon?",
}
BOXES = (
    PREDICTIONS
    + """,
boxes AS (
  SELECT 'Document ' || doc_id AS name, doc_id, label,
    CASE label WHEN 'net_zero_target' THEN 1 WHEN 'efficiency_target' THEN 2 ELSE 3 END AS label_place,
    chr(10) || '### Document ' || doc_id || ' – ' || CASE label WHEN 'net_zero_target' THEN 'Net Zero Target'
      WHEN 'efficiency_target' THEN 'Efficiency Target' ELSE 'Carbon Pricing' END || chr(10) || chr(10)
    || '**Question:** ' || CASE label WHEN 'net_zero_target' THEN 'Has Document ' || doc_id || ' set a net zero target?'
      WHEN 'efficiency_target' THEN 'Is Document ' || doc_id || ' efficient?' ELSE 'Does Document ' || doc_id || ' price carbon?' END
    || '  ' || chr(10) || '**Answer:** ' || CASE WHEN yes_no = 'yes' THEN '✅ Yes' ELSE '❌ No' END
    || '  ' || chr(10) || '**Explanation:** ' || coalesce(explanation, 'None')
    || '  ' || chr(10) || '**Target Year(s):** ' || coalesce(array_to_string(years, ', '), 'N/A')
    || '  ' || chr(10) || '**Sectors:** ' || coalesce(array_to_string(sectors, ', '), 'N/A') || chr(10) || chr(10)
    || '**Quote:**  ' || chr(10) || '> ' || coalesce(nullif(trim(quote, E' \\t\\r\\n'), ''), 'No quote provided.') || chr(10) || chr(10)
    || '**Confidence:** ' || coalesce(CAST(round(confidence * 100, 2) AS VARCHAR), 'N/A') || '%  ' || chr(10)
    || '**Source:** [Link](' || coalesce(source_url, '#') || ')' || chr(10) AS box
  FROM predictions WHERE label IN ('net_zero_target', 'efficiency_target', 'carbon_pricing'))
"""
)


def _boxes(t: Tables):
    predictions = _predictions(t).withColumn("country", F.concat(F.lit("document "), "country"))
    names = t.documents.select(F.concat(F.lit("Document "), "doc_id").alias("name"), "doc_id")
    found = B.lookup_predictions(B.with_keys(names, {}), predictions, QUESTION_OF)
    return B.format_boxes(found)


@query("qa_format", BOXES + "SELECT name, label, box FROM boxes")
def qa_format(t: Tables):
    return _boxes(t).select("name", "label", "box")


@query(
    "qa_document",
    BOXES + "SELECT doc_id, label_place, md5(box) AS box_md5 FROM boxes ORDER BY doc_id, label_place",
)
def qa_document(t: Tables):
    ordered = B.box_document(_boxes(t), list(QUESTION_OF), order=("doc_id",))
    return ordered.select("doc_id", "label_place", F.md5("box").alias("box_md5"))
