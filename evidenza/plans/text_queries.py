"""Checked queries: vectors, word tokens, sentences, chunks and retrieval."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from evidenza.functions.encoders import HashingEncoder, encode_column
from evidenza.functions.sentences import sentences
from evidenza.functions.vectors import cosine, l2_normalize
from evidenza.functions.wordpiece import CONTINUED, MAX_WORD_CHARS, UNKNOWN, WORD
from evidenza.operators import boundaries as B
from evidenza.operators import embed as E
from evidenza.operators import retrieve as R
from evidenza.operators import tokens as T
from evidenza.operators.ingest import country_name, valid_sections
from evidenza.plans.catalog import Tables, query

DIM = 64


class CountEncoder(HashingEncoder):
    """Plain bucket counts: whole numbers, so that both engines agree to the last bit."""

    def __init__(self):
        super().__init__(DIM, normalize=False)


# SQL building blocks -------------------------------------------------------

WS = r"E' \t\r\n'"


def tokens_sql(text: str) -> str:
    return f"list_filter(string_split_regex(lower({text}), '[^a-z]+'), lambda w: w <> '')"


def buckets_sql(source: str, key: str, text: str) -> str:
    """(key, bucket, n): counts of hashed tokens."""
    return f"""
SELECT {key}, CAST(('0x' || substr(md5(token), 1, 8)) AS BIGINT) % {DIM} AS bucket, count(*) AS n
FROM (SELECT {key}, unnest({tokens_sql(text)}) AS token FROM {source}) GROUP BY ALL
"""


def sentences_sql(text: str) -> str:
    return (
        f"list_filter(string_split(regexp_replace(trim({text}, {WS}), '([.!?])[ \\t\\r\\n]+', "
        "'\\1' || chr(1), 'g'), chr(1)), lambda s: s <> '')"
    )


def chunks_sql(source: str, key: str, text: str) -> str:
    """(key, chunk_idx, chunk): three sentences per chunk, one shared."""
    return f"""
SELECT {key}, CAST(row_number() OVER (PARTITION BY {key} ORDER BY i) - 1 AS INTEGER) AS chunk_idx, chunk
FROM (SELECT {key}, i, array_to_string(ss[i + 1 : i + 3], ' ') AS chunk
      FROM (SELECT {key}, ss, unnest(generate_series(0, len(ss) - 1, 2)) AS i
            FROM (SELECT {key}, {sentences_sql(text)} AS ss FROM {source})))
WHERE trim(chunk, {WS}) <> ''
"""


# --- section vectors --------------------------------------------------------


def _sections(t: Tables):
    vectors = t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding")
    documents = t.documents.select("doc_id", "source", "text")
    return documents.join(vectors, "doc_id", "left").select(
        F.col("doc_id").alias("section_url"),
        F.col("source").alias("country_doc_id"),
        F.col("text").alias("text_content"),
        "embedding",
    )


@query(
    "pending_embeddings",
    """
SELECT d.doc_id, d.source AS country FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id
WHERE e.vec_id IS NULL
""",
)
def pending_embeddings(t: Tables):
    pending = E.pending_sections(_sections(t))
    return pending.select(F.col("section_url").alias("doc_id"), F.col("country_doc_id").alias("country"))


@query(
    "embedding_gate",
    f"""
WITH g AS (SELECT doc_id, trim(text, {WS}) AS s FROM documents)
SELECT doc_id, CAST(length(s) < 20 AS INTEGER) AS is_zero,
       CASE WHEN length(s) >= 20 THEN length(s) END AS n_chars,
       CASE WHEN length(s) >= 20 THEN md5(s) END AS text_md5 FROM g
""",
)
def embedding_gate(t: Tables):
    gated = t.documents.select("doc_id", E.embedding_gate(F.col("text")).alias("s"))
    return gated.select(
        "doc_id",
        F.col("s").isNull().cast("int").alias("is_zero"),
        F.length("s").cast("bigint").alias("n_chars"),
        F.md5("s").alias("text_md5"),
    )


@query(
    "hash_embedding",
    f"""
WITH b AS ({buckets_sql('documents', 'doc_id', 'text')}),
norms AS (SELECT doc_id, sqrt(CAST(sum(n * n) AS DOUBLE)) AS norm FROM b GROUP BY doc_id)
SELECT doc_id, CAST(bucket AS INTEGER) AS bucket, n, round(n / norm, 6) AS weight FROM b JOIN norms USING (doc_id)
""",
)
def hash_embedding(t: Tables):
    counted = t.documents.select("doc_id", "text").select(
        "doc_id", encode_column(F.col("text"), CountEncoder).alias("counts")
    )
    both = counted.withColumn("unit", l2_normalize(F.col("counts")))
    entries = both.select("doc_id", F.posexplode(F.arrays_zip("counts", "unit")).alias("bucket", "e"))
    return entries.filter("e.counts > 0").select(
        "doc_id", "bucket", F.col("e.counts").cast("bigint").alias("n"), F.round("e.unit", 6).alias("weight")
    )


@query(
    "embedding_progress",
    f"""
WITH s AS (
  SELECT d.source, e.vec_id IS NOT NULL AS done, length(trim(d.text, {WS})) < 20 AS short
  FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id)
SELECT source AS country, count(*) AS n_sections, count(*) FILTER (done) AS n_kept,
       count(*) FILTER (NOT done AND short) AS n_zero, count(*) FILTER (NOT done AND NOT short) AS n_embedded,
       CAST(0 AS BIGINT) AS n_failed
FROM s GROUP BY source
""",
)
def embedding_progress(t: Tables):
    done = E.embed_pending(_sections(t), HashingEncoder, DIM)
    return E.embedding_progress(done).withColumnRenamed("country_doc_id", "country")


class MarkedEncoder(HashingEncoder):
    """Fails on every text that holds the marker."""

    marker = "license"

    def encode_batch(self, texts):
        if any(self.marker in t.lower() for t in texts):
            raise ValueError("marked text")
        return super().encode_batch(texts)


@query(
    "embedding_failures",
    f"""
WITH s AS (
  SELECT d.source, e.vec_id IS NOT NULL AS done, length(trim(d.text, {WS})) < 20 AS short,
         contains(lower(d.text), '{MarkedEncoder.marker}') AS marked
  FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id)
SELECT source AS country, count(*) FILTER (NOT done AND NOT short AND NOT marked) AS n_embedded,
       count(*) FILTER (NOT done AND NOT short AND marked) AS n_failed
FROM s GROUP BY source
""",
)
def embedding_failures(t: Tables):
    """A failing text costs only its own row, in whatever batch it stands."""
    done = E.embedding_progress(E.embed_pending(_sections(t), MarkedEncoder, DIM))
    return done.select(F.col("country_doc_id").alias("country"), "n_embedded", "n_failed")


@query(
    "content_embedding",
    f"""
WITH b AS ({buckets_sql("conversations WHERE role = 'assistant'", 'conv_id, turn', 'text')})
SELECT c.conv_id, c.turn, CASE WHEN c.role = 'assistant' THEN 'transformer' END AS model_type,
       CASE WHEN c.role = 'assistant' THEN '2024-06-01 12:00:00' END AS processed_at,
       CASE WHEN c.role = 'assistant' THEN coalesce(s.n_tokens, 0) END AS n_tokens
FROM conversations c LEFT JOIN (SELECT conv_id, turn, CAST(sum(n) AS BIGINT) AS n_tokens FROM b GROUP BY ALL) s
  ON s.conv_id = c.conv_id AND s.turn = c.turn
""",
)
def content_embedding(t: Tables):
    content = F.when(F.col("role") == "assistant", F.col("text")).when(F.col("role") == "user", F.lit(""))
    items = t.conversations.select("conv_id", "turn", "role", "text").select(
        "conv_id", "turn", content.alias("content")
    )
    now = F.lit("2024-06-01 12:00:00").cast("timestamp")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x).cast("bigint")
    return E.embed_content(items, now, CountEncoder).select(
        "conv_id",
        "turn",
        "model_type",
        F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss").alias("processed_at"),
        total.alias("n_tokens"),
    )


# --- vectors ----------------------------------------------------------------


def _masked(t: Tables):
    """Vectors as tokens of their label; those with a negative first entry are masked out."""
    first = F.get("embedding", F.lit(0))
    return t.embeddings.select("vec_id", "label", "embedding", (first > 0).cast("int").alias("mask"))


CENTROIDS = """
entries AS (
  SELECT label, generate_subscripts(embedding, 1) - 1 AS dim, CAST(unnest(embedding) AS DOUBLE) AS x,
         CASE WHEN embedding[1] > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS w FROM embeddings),
means AS (SELECT label, dim, sum(x * w) / greatest(sum(w), 1e-9::DOUBLE) AS value FROM entries GROUP BY label, dim),
centroids AS (SELECT label, list(value ORDER BY dim) AS centroid FROM means GROUP BY label)
"""


@query(
    "masked_mean_pool",
    f"WITH {CENTROIDS} SELECT label, CAST(dim AS INTEGER) AS dim, round(value, 6) + 0.0 AS mean FROM means",
)
def masked_mean_pool(t: Tables):
    pooled = E.masked_mean_pool(_masked(t), ["label"])
    return pooled.select("label", F.posexplode("embedding").alias("dim", "x")).select(
        "label", "dim", (F.round("x", 6) + F.lit(0.0)).alias("mean")
    )


@query(
    "l2_normalize",
    """
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * label) AS v FROM embeddings),
normed AS (
  SELECT vec_id, v, greatest(sqrt(list_sum(list_transform(v, lambda x: x * x))), 1e-12::DOUBLE) AS n FROM scaled)
SELECT vec_id, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS dim, round(unnest(v) / n, 6) + 0.0 AS x FROM normed
""",
)
def normalized(t: Tables):
    scaled = F.transform("embedding", lambda x: x.cast("double") * F.col("label"))
    unit = t.embeddings.select("vec_id", F.posexplode(l2_normalize(scaled)).alias("dim", "x"))
    return unit.select("vec_id", "dim", (F.round("x", 6) + F.lit(0.0)).alias("x"))


SCORES = f"""
WITH {CENTROIDS},
cn AS (SELECT label AS question_id, centroid, sqrt(list_dot_product(centroid, centroid)) AS norm FROM centroids),
vs AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
vn AS (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS norm FROM vs)
"""


@query(
    "cosine_pairs",
    SCORES
    + """
SELECT vec_id, label, round(CASE WHEN vn.norm * cn.norm > 0 THEN list_dot_product(v, centroid) / (vn.norm * cn.norm) ELSE 0 END, 6) + 0.0
       AS similarity
FROM vn JOIN cn ON cn.question_id = vn.label
""",
)
def cosine_pairs(t: Tables):
    pooled = E.masked_mean_pool(_masked(t), ["label"]).withColumnRenamed("embedding", "centroid")
    pairs = t.embeddings.join(pooled, "label")
    similarity = F.round(cosine(F.col("embedding"), F.col("centroid")), 6) + F.lit(0.0)
    return pairs.select("vec_id", "label", similarity.alias("similarity"))


@query(
    "top1_evidence",
    SCORES
    + """,
scored AS (
  SELECT vn.label AS country, question_id, vec_id,
         round(CASE WHEN vn.norm * cn.norm > 0 THEN list_dot_product(v, centroid) / (vn.norm * cn.norm) ELSE 0 END, 9) AS score
  FROM vn CROSS JOIN cn),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY country, question_id ORDER BY score DESC, vec_id) AS rn FROM scored)
SELECT country, question_id, vec_id, score + 0.0 AS score FROM ranked WHERE rn = 1
""",
)
def top1_evidence(t: Tables):
    questions = E.masked_mean_pool(_masked(t), ["label"]).withColumnRenamed("label", "question_id")
    candidates = t.embeddings.withColumnRenamed("label", "country")
    best = R.best_evidence(candidates, questions, order=["vec_id"])
    return best.select("country", "question_id", "vec_id", "score")


@query(
    "tiled_evidence",
    """
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
scored AS (
  SELECT c.label AS country, q.vec_id AS question_id, c.vec_id,
         round(list_dot_product(c.v, q.v) / (sqrt(list_dot_product(c.v, c.v)) * sqrt(list_dot_product(q.v, q.v))), 9) AS score
  FROM v AS c CROSS JOIN v AS q)
SELECT country, question_id, max(score) + 0.0 AS score FROM scored GROUP BY country, question_id
""",
)
def tiled_evidence(t: Tables):
    """Every vector asks for its best match in each country: more questions than one tile holds."""
    questions = t.embeddings.select(F.col("vec_id").alias("question_id"), "embedding")
    candidates = t.embeddings.withColumnRenamed("label", "country")
    best = R.best_evidence(candidates, questions, order=["vec_id"], question_tiles=5, candidate_tiles=4)
    return best.select("country", "question_id", "score")


# --- words ------------------------------------------------------------------

STOP_LIST = ", ".join(f"'{w}'" for w in E.STOP_WORDS)
# the same patterns for RE2, as SQL literals
SQL_SEPARATOR = E.WORD_SEPARATOR.replace("'", "''")
SQL_ENDINGS = E.WORD_ENDINGS.replace("'", "''")
SQL_STARTS = E.WORD_STARTS.replace("'", "''")


WORD_LISTS = rf"""
WITH pieces AS (
  SELECT doc_id, list_transform(string_split_regex(lower(text), '{SQL_SEPARATOR}'),
    lambda p: regexp_replace(regexp_replace(p, '{SQL_STARTS}', ''), '{SQL_ENDINGS}', '')) AS ps FROM documents),
words AS (
  SELECT doc_id, list_filter(ps, lambda w: regexp_full_match(w, '\p{{L}}{{3,}}') AND w NOT IN ({STOP_LIST})) AS ws FROM pieces)
"""


@query(
    "word_tokens",
    WORD_LISTS + "SELECT doc_id, len(ws) AS n_words, md5(array_to_string(ws, ' ')) AS words_md5 FROM words",
)
def word_tokens(t: Tables):
    tokens = t.documents.select("doc_id", "text").select("doc_id", E.word_tokens(F.col("text")).alias("ws"))
    return tokens.select(
        "doc_id", F.size("ws").cast("bigint").alias("n_words"), F.md5(F.array_join("ws", " ")).alias("words_md5")
    )


@query(
    "word2vec_docs",
    WORD_LISTS
    + """,
tokens AS (SELECT doc_id, unnest(ws) AS word FROM words),
vocabulary AS (SELECT word FROM tokens GROUP BY word HAVING count(*) >= 5),
counts AS (SELECT doc_id, count(*) AS n FROM tokens SEMI JOIN vocabulary USING (word) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_words, CASE WHEN n > 0 THEN 32 END AS dim
FROM documents d LEFT JOIN counts c ON c.doc_id = d.doc_id
""",
)
def word2vec_docs(t: Tables):
    tokens = t.documents.select("doc_id", "text").select("doc_id", E.word_tokens(F.col("text")).alias("tokens"))
    model = E.fit_word_vectors(tokens, vector_size=32)
    vectors = E.word_vector_documents(tokens, model.getVectors(), ["doc_id"])
    return vectors.select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"), F.size("document_vector").alias("dim")
    )


@query(
    "word_vector_means",
    WORD_LISTS
    + """,
tokens AS (SELECT doc_id, unnest(ws) AS word FROM words),
vocabulary AS (SELECT word FROM tokens GROUP BY word HAVING count(*) >= 5),
entries AS (
  SELECT doc_id, dim, CAST('0x' || substr(md5(word), 2 * dim + 1, 2) AS INTEGER) - 128 AS x
  FROM tokens SEMI JOIN vocabulary USING (word), (SELECT unnest(range(8)) AS dim))
SELECT doc_id, CAST(dim AS INTEGER) AS dim, count(*) AS n_words, CAST(sum(x) AS BIGINT) AS total
FROM entries GROUP BY doc_id, dim
""",
)
def word_vector_means(t: Tables):
    """Averaging checked value by value, over word vectors that both engines can make."""
    tokens = t.documents.select("doc_id", E.word_tokens(F.col("text")).alias("tokens"))
    counted = E.word_rows(tokens).groupBy("word").count().where("count >= 5")
    cells = [F.conv(F.substring(F.md5("word"), 2 * d + 1, 2), 16, 10).cast("double") - 128 for d in range(8)]
    vectors = counted.select("word", array_to_vector(F.array(*cells)).alias("vector"))
    means = E.word_vector_documents(tokens, vectors, ["doc_id"]).where("n_words > 0")
    return means.select("doc_id", "n_words", F.posexplode("document_vector").alias("dim", "v")).select(
        "doc_id", "dim", "n_words", F.round(F.col("v") * F.col("n_words")).cast("bigint").alias("total")
    )


# --- sentences and chunks ---------------------------------------------------


@query(
    "sentences",
    f"""
WITH s AS (SELECT doc_id, {sentences_sql('text')} AS ss FROM documents)
SELECT doc_id, CAST(generate_subscripts(ss, 1) - 1 AS INTEGER) AS sentence_no, unnest(ss) AS sentence FROM s
""",
)
def sentence_rows(t: Tables):
    documents = t.documents.select("doc_id", "text")
    return documents.select("doc_id", F.posexplode(sentences(F.col("text"))).alias("sentence_no", "sentence"))


@query("sentence_chunks", chunks_sql("documents", "doc_id", "text"))
def sentence_chunks(t: Tables):
    return R.chunk_rows(t.documents.select("doc_id", "text"), ["doc_id"], text="text")


@query(
    "chunk_lineage",
    f"""
WITH c AS ({chunks_sql('documents', 'doc_id', 'text')})
SELECT d.source AS country, c.doc_id, c.chunk_idx,
       CASE WHEN d.lang = 'fr' THEN 'https://example.org/' || d.source ELSE 'https://example.org/' || d.source || '/' || d.doc_id END
       AS source_url, md5(c.chunk) AS chunk_md5
FROM c JOIN documents d ON d.doc_id = c.doc_id
""",
)
def chunk_lineage(t: Tables):
    countries = t.documents.select(F.col("source").alias("doc_id")).distinct()
    countries = countries.withColumn("country_url", F.concat(F.lit("https://example.org/"), "doc_id"))
    url = F.concat_ws("/", F.lit("https://example.org"), "source", "doc_id")
    sections = t.documents.select("doc_id", "text", "lang", "source").select(
        F.col("source").alias("country_doc_id"),
        "doc_id",
        F.when(F.col("lang") != "fr", url).alias("section_url"),
        F.col("text").alias("text_content"),
    )
    rows = R.chunk_lineage(sections, countries, key=("doc_id",))
    return rows.select(
        F.col("country_doc_id").alias("country"), "doc_id", "chunk_idx", "source_url", F.md5("chunk").alias("chunk_md5")
    )


# --- document evidence ------------------------------------------------------

BEST_CHUNKS = f"""
WITH chunk_rows AS ({chunks_sql('documents', 'doc_id', 'text')}),
ck AS (SELECT doc_id, chunk_idx, chunk, doc_id * 100000 + chunk_idx AS chunk_key FROM chunk_rows),
cb AS MATERIALIZED ({buckets_sql('ck', 'chunk_key', 'chunk')}),
qb AS MATERIALIZED ({buckets_sql('benchmark', 'item_id', 'text')}),
cn AS (SELECT chunk_key, sqrt(CAST(sum(n * n) AS DOUBLE)) AS norm FROM cb GROUP BY chunk_key),
qn AS (SELECT item_id, sqrt(CAST(sum(n * n) AS DOUBLE)) AS norm FROM qb GROUP BY item_id),
dots AS (SELECT chunk_key, item_id, CAST(sum(cb.n * qb.n) AS DOUBLE) AS dot FROM cb JOIN qb USING (bucket) GROUP BY ALL),
scored AS (
  SELECT ck.doc_id, ck.chunk_idx, ck.chunk, b.item_id AS question_id,
         round(coalesce(dot / (cn.norm * qn.norm), 0), 9) AS score
  FROM ck CROSS JOIN benchmark b LEFT JOIN dots ON dots.chunk_key = ck.chunk_key AND dots.item_id = b.item_id
  LEFT JOIN cn ON cn.chunk_key = ck.chunk_key LEFT JOIN qn ON qn.item_id = b.item_id),
ranked AS (
  SELECT d.source AS country, s.*, row_number() OVER (PARTITION BY d.source, question_id ORDER BY score DESC, s.doc_id, chunk_idx) AS rn
  FROM scored s JOIN documents d ON d.doc_id = s.doc_id),
best AS (SELECT * FROM ranked WHERE rn = 1)
"""


def _benchmark_questions(t: Tables):
    question = F.regexp_replace("text", "[\r\n]+", " ")
    return t.benchmark.select(
        F.col("item_id").alias("question_id"),
        question.alias("question"),
        encode_column(F.col("text"), CountEncoder).alias("embedding"),
    )


def _document_evidence(t: Tables, k: int = 1, texts: bool = True):
    sections = t.documents.select("doc_id", F.col("source").alias("country"), "text")
    key = ["country", "doc_id"]
    chunked = R.chunk_rows(sections, key, text="text").withColumn("chunk_key", F.xxhash64("chunk"))
    winners = R.best_evidence(
        chunked,
        _benchmark_questions(t),
        order=["doc_id", "chunk_idx", "chunk_key"],
        text="chunk",
        encoder_factory=CountEncoder,
        k=k,
    )
    return R.evidence_chunks(winners, sections, key, text="text") if texts else winners


@query(
    "document_evidence",
    BEST_CHUNKS
    + "SELECT country, question_id, doc_id, chunk_idx, score, md5(chunk) AS chunk_md5 FROM best",
)
def document_evidence(t: Tables):
    return _document_evidence(t).select(
        "country", "question_id", "doc_id", "chunk_idx", "score", F.md5("chunk").alias("chunk_md5")
    )


@query(
    "document_evidence_top3",
    BEST_CHUNKS
    + """
SELECT country, question_id, CAST(rn AS INTEGER) AS place, doc_id, chunk_idx, score
FROM ranked WHERE rn <= 3
""",
)
def document_evidence_top3(t: Tables):
    return _document_evidence(t, k=3, texts=False).select(
        "country", "question_id", F.col("rank").alias("place"), "doc_id", "chunk_idx", "score"
    )


BLOCK = """
'**Answer/Evidence (Similarity: ' || printf('%.4f', score) || '):**' || chr(10) || '> '
|| replace(replace(chunk, '`', chr(92) || '`'), chr(10), ' ') || chr(10) || chr(10)
|| '**Source URL:** [' || source_url || '](' || source_url || ')' || chr(10) || chr(10) || '---' || chr(10)
"""


@query(
    "evidence_format",
    f"""
WITH c AS (SELECT conv_id, turn, '`' || text AS chunk, 'https://example.org/' || conv_id AS source_url,
                  CASE WHEN role <> 'system' THEN length(text) / 997.0::DOUBLE END AS score FROM conversations)
SELECT conv_id, turn, CASE WHEN score IS NULL THEN chr(10) || '*Failed to process question.*' || chr(10) || chr(10) || '---' || chr(10)
       ELSE {BLOCK} END AS block FROM c
""",
)
def evidence_format(t: Tables):
    score = F.when(F.col("role") != "system", F.length("text") / F.lit(997.0))
    block = R.evidence_block(
        score, F.concat(F.lit("`"), "text"), F.concat(F.lit("https://example.org/"), "conv_id")
    )
    return t.conversations.select("conv_id", "turn", block.alias("block"))


REPORTS = (
    BEST_CHUNKS
    + f""",
blocks AS (
  SELECT country, question_id, '### Question ' || (question_id + 1) || ': ' || regexp_replace(b.text, '[\\r\\n]+', ' ', 'g')
         || chr(10) || chr(10) || {BLOCK} AS block
  FROM (SELECT *, 'https://example.org/' || doc_id AS source_url FROM best) e JOIN benchmark b ON b.item_id = e.question_id),
reports AS (
  SELECT country, '## Country: ' || upper(left(country, 1)) || substr(country, 2) || chr(10) || chr(10) || '---' || chr(10)
         || string_agg(block, '' ORDER BY question_id) AS report
  FROM blocks GROUP BY country)
"""
)


def _reports(t: Tables):
    found = _document_evidence(t).withColumn("source_url", F.concat(F.lit("https://example.org/"), "doc_id"))
    countries = t.documents.select(F.col("source").alias("country")).distinct()
    countries = countries.withColumn("country_name", country_name(F.lit(None).cast("string"), F.col("country")))
    return R.country_reports(countries, found, _benchmark_questions(t))


@query(
    "country_report",
    REPORTS + "SELECT country, length(report) AS n_chars, md5(report) AS report_md5 FROM reports",
)
def country_report(t: Tables):
    return _reports(t).select(
        "country", F.length("report").cast("bigint").alias("n_chars"), F.md5("report").alias("report_md5")
    )


@query(
    "report_fallback",
    f"""
WITH valid AS (SELECT doc_id, text FROM documents WHERE length(trim(text, {WS})) >= 20),
chunk_rows AS ({chunks_sql('valid', 'doc_id', 'text')}),
ck AS (SELECT doc_id, chunk_idx, chunk, doc_id * 100000 + chunk_idx AS chunk_key FROM chunk_rows),
cb AS ({buckets_sql('ck', 'chunk_key', 'chunk')}),
qb AS ({buckets_sql('region', 'r_regionkey', 'r_name')}),
cn AS (SELECT chunk_key, sqrt(CAST(sum(n * n) AS DOUBLE)) AS norm FROM cb GROUP BY chunk_key),
qn AS (SELECT r_regionkey, sqrt(CAST(sum(n * n) AS DOUBLE)) AS norm FROM qb GROUP BY r_regionkey),
dots AS (SELECT chunk_key, r_regionkey, CAST(sum(cb.n * qb.n) AS DOUBLE) AS dot FROM cb JOIN qb USING (bucket) GROUP BY ALL),
scored AS (
  SELECT ck.*, r.r_regionkey AS question_id, r.r_name, round(coalesce(dot / (cn.norm * qn.norm), 0), 9) AS score,
         'https://example.org/' || ck.doc_id AS source_url
  FROM ck CROSS JOIN region r LEFT JOIN dots ON dots.chunk_key = ck.chunk_key AND dots.r_regionkey = r.r_regionkey
  LEFT JOIN cn ON cn.chunk_key = ck.chunk_key LEFT JOIN qn ON qn.r_regionkey = r.r_regionkey),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, question_id ORDER BY score DESC, chunk_idx) AS rn FROM scored),
blocks AS (
  SELECT doc_id, string_agg('### Question ' || (question_id + 1) || ': ' || r_name || chr(10) || chr(10) || {BLOCK},
                            '' ORDER BY question_id) AS body FROM best WHERE rn = 1 GROUP BY doc_id),
reports AS (
  SELECT d.doc_id, '## Country: Document ' || d.doc_id || chr(10) || chr(10) || '---' || chr(10) || coalesce(b.body,
         chr(10) || '*No text chunks could be generated.*' || chr(10) || chr(10) || '---' || chr(10)) AS report
  FROM documents d LEFT JOIN blocks b ON b.doc_id = d.doc_id)
SELECT doc_id AS country, length(report) AS n_chars, md5(report) AS report_md5 FROM reports
""",
)
def report_fallback(t: Tables):
    documents = t.documents.select("doc_id", "text")
    sections = documents.select(
        F.col("doc_id").alias("country"),
        F.concat(F.lit("https://example.org/"), "doc_id").alias("section_url"),
        F.btrim("text", F.lit(" \t\r\n")).alias("text_content"),
    )
    chunked = R.chunk_rows(valid_sections(sections), ["country", F.col("section_url").alias("source_url")])
    questions = t.region.select(
        F.col("r_regionkey").alias("question_id"),
        F.col("r_name").alias("question"),
        encode_column(F.col("r_name"), CountEncoder).alias("embedding"),
    )
    found = R.best_evidence(
        chunked, questions, carry=["chunk", "source_url"], text="chunk", encoder_factory=CountEncoder
    )
    countries = t.documents.select(
        F.col("doc_id").alias("country"), F.concat(F.lit("Document "), "doc_id").alias("country_name")
    )
    reports = R.country_reports(countries, found, questions)
    return reports.select(
        "country", F.length("report").cast("bigint").alias("n_chars"), F.md5("report").alias("report_md5")
    )


# --- learned boundaries -------------------------------------------------------

ABBREVIATIONS = r"""
WITH tokens AS (
  SELECT unnest(regexp_extract_all(lower(text), '\p{L}+(?:\.\p{L}+)*\.?')) AS token FROM documents),
types AS (
  SELECT rtrim(token, '.') AS word, count(*) AS n, count(*) FILTER (ends_with(token, '.')) AS n_stopped FROM tokens GROUP BY 1),
rated AS (SELECT *, (SELECT CAST(sum(n_stopped) AS DOUBLE) / sum(n) FROM types) AS rate FROM types WHERE n_stopped > 0),
shaped AS (
  SELECT *, length(word) - length(replace(word, '.', '')) AS inside, length(replace(word, '.', '')) AS letters,
    n_stopped * ln(rate) + (n - n_stopped) * ln(1 - rate) AS chance,
    n_stopped * ln(0.99::DOUBLE) + (n - n_stopped) * ln(1 - 0.99::DOUBLE) AS always
  FROM rated),
scores AS (
  SELECT word, n, n_stopped, -2 * (chance - always) * exp(-letters::DOUBLE) * (inside + 1) * pow(letters::DOUBLE, (n_stopped - n)::DOUBLE) AS score
  FROM shaped)
"""


@query("abbreviation_scores", ABBREVIATIONS + "SELECT word, n, n_stopped, round(score, 6) + 0.0 AS score FROM scores")
def abbreviation_scores(t: Tables):
    return B.abbreviation_scores(t.documents).select("word", "n", "n_stopped", (F.round("score", 6) + F.lit(0.0)).alias("score"))


@query(
    "learned_sentences",
    ABBREVIATIONS
    + r"""
, pieces AS (
  SELECT doc_id, string_split(regexp_replace(trim(text, E' \t\r\n'), '([.!?])[ \t\r\n]+', '\1' || chr(1), 'g'), chr(1)) AS ps
  FROM documents WHERE text IS NOT NULL),
rows AS (
  SELECT doc_id, unnest(ps) AS piece, unnest(range(len(ps))) AS pos FROM (
    SELECT doc_id, list_filter(ps, lambda p: p <> '') AS ps FROM pieces)),
marked AS (
  SELECT *, regexp_extract(lower(piece), '(\p{L}+(?:\.\p{L}+)*)\.$', 1) IN (SELECT word FROM scores WHERE score >= 0.3) AS goes_on FROM rows),
numbered AS (
  SELECT *, sum(begins) OVER (PARTITION BY doc_id ORDER BY pos) AS number FROM (
    SELECT *, CASE WHEN lag(goes_on) OVER (PARTITION BY doc_id ORDER BY pos) THEN 0 ELSE 1 END AS begins FROM marked)),
sentences AS (SELECT doc_id, number, string_agg(piece, ' ' ORDER BY pos) AS sentence FROM numbered GROUP BY doc_id, number)
SELECT doc_id, CAST(number - 1 AS INTEGER) AS sentence_idx, md5(sentence) AS sentence_md5 FROM sentences
""",
)
def learned_sentences(t: Tables):
    found = B.sentence_rows(t.documents, ["doc_id"], B.abbreviations(t.documents))
    return found.select("doc_id", "sentence_idx", F.md5("sentence").alias("sentence_md5"))


# --- WordPiece tokens ---------------------------------------------------------

WINDOW_TOKENS = 24


def _pieces(t: Tables) -> list[str]:
    """A small vocabulary by rule: words of the benchmark whole, their starts, and their ends as later pieces."""
    words = t.benchmark.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("w"))
    lengths = F.explode(F.array(*[F.lit(n) for n in (1, 2, 3)]))
    parts = words.distinct().withColumn("n", lengths)
    rows = F.explode(F.array("w", F.expr("left(w, n)"), F.concat(F.lit(CONTINUED), F.expr("right(w, n)"))))
    return T.vocabulary_pieces(parts.select(rows.alias("piece")))


#: Tokens of each distinct word: the longest piece at every place, then a walk from place to place.
WORD_PIECES = rf"""
WITH RECURSIVE source_words AS (
  SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM benchmark),
parts AS (SELECT w, unnest([1, 2, 3]) AS n FROM source_words),
pieces AS (
  SELECT w AS piece, false AS later FROM parts UNION SELECT left(w, n), false FROM parts UNION SELECT right(w, n), true FROM parts),
longest AS (SELECT max(length(piece)) AS m FROM pieces),
occurring AS (
  SELECT doc_id, unnest(ws) AS raw, unnest(range(len(ws))) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '{WORD.replace("'", "''")}') AS ws FROM documents)),
words AS (SELECT raw, lower(strip_accents(raw)) AS word FROM (SELECT DISTINCT raw FROM occurring)),
places AS (
  SELECT DISTINCT word, unnest(range(length(word))) AS start FROM words WHERE length(word) BETWEEN 1 AND {MAX_WORD_CHARS}),
spans AS (
  SELECT word, start, unnest(range(1, least(length(word) - start, m) + 1)) AS size FROM places CROSS JOIN longest),
best AS (
  SELECT word, start, max(size) AS size FROM spans JOIN pieces
  ON piece = substr(word, CAST(start AS INTEGER) + 1, CAST(size AS INTEGER)) AND later = (start > 0) GROUP BY word, start),
walk AS (
  SELECT DISTINCT word, CAST(0 AS BIGINT) AS place, CAST([] AS VARCHAR[]) AS found FROM words
  UNION ALL
  SELECT walk.word, walk.place + size,
         list_append(found, CASE WHEN walk.place > 0 THEN '{CONTINUED}' ELSE '' END || substr(walk.word, CAST(walk.place AS INTEGER) + 1, CAST(size AS INTEGER)))
  FROM walk JOIN best ON best.word = walk.word AND best.start = walk.place),
covered AS (SELECT word, found FROM walk WHERE place = length(word)),
matched AS (SELECT raw, coalesce(found, ['{UNKNOWN}']) AS found FROM words LEFT JOIN covered ON covered.word = words.word),
tokens AS (SELECT doc_id, pos, found, len(found) AS n FROM occurring JOIN matched USING (raw) WHERE len(found) > 0)
"""


@query(
    "wordpiece_tokens",
    WORD_PIECES
    + f"""
SELECT d.doc_id, coalesce(n_tokens, 0) AS n_tokens, coalesce(n_unknown, 0) AS n_unknown, coalesce(tokens_md5, md5('')) AS tokens_md5
FROM documents d LEFT JOIN (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_tokens, count(*) FILTER (found = ['{UNKNOWN}']) AS n_unknown,
         md5(string_agg(array_to_string(found, ' '), ' ' ORDER BY pos)) AS tokens_md5
  FROM tokens GROUP BY doc_id) USING (doc_id)
WHERE d.text IS NOT NULL
""",
)
def wordpiece_tokens(t: Tables):
    found = t.documents.where("text IS NOT NULL").select("doc_id", T.token_column(F.col("text"), _pieces(t)).alias("found"))
    return found.select(
        "doc_id",
        F.size("found").cast("bigint").alias("n_tokens"),
        F.size(F.filter("found", lambda x: x == UNKNOWN)).cast("bigint").alias("n_unknown"),
        F.md5(F.array_join("found", " ")).alias("tokens_md5"),
    )


@query(
    "token_windows",
    WORD_PIECES
    + f""",
counted AS (
  SELECT doc_id, n, row_number() OVER w AS i, CAST(sum(n) OVER w AS BIGINT) AS upto FROM tokens
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
ends AS (
  SELECT c.doc_id, c.i, greatest(c.i, coalesce(max(e.i), c.i)) AS last FROM counted c
  LEFT JOIN counted e ON e.doc_id = c.doc_id AND e.i BETWEEN c.i AND c.i + {WINDOW_TOKENS} AND e.upto - c.upto + c.n <= {WINDOW_TOKENS}
  GROUP BY c.doc_id, c.i),
chain AS (
  SELECT doc_id, 0 AS window_no, i, last FROM ends WHERE i = 1
  UNION ALL
  SELECT ends.doc_id, window_no + 1, ends.i, ends.last FROM chain JOIN ends ON ends.doc_id = chain.doc_id AND ends.i = chain.last + 1)
SELECT chain.doc_id, window_no, count(*) AS n_words, CAST(sum(n) AS BIGINT) AS n_tokens
FROM chain JOIN counted ON counted.doc_id = chain.doc_id AND counted.i BETWEEN chain.i AND chain.last
GROUP BY chain.doc_id, window_no
""",
)
def token_windows(t: Tables):
    rows = T.window_rows(t.documents, ["doc_id"], _pieces(t), max_tokens=WINDOW_TOKENS)
    return rows.select("doc_id", "window_no", "n_words", "n_tokens")
