"""The operators of this subpackage as queries over the given tables, with their
DuckDB twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidenza.llm import (
    chat, crf, decontaminate, dedup, divergence, lines, mixing, prefix_trie, quality, simhash, stupid_backoff, urls, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]
CONTROL_CASE = "</s>[INST] ok [/INST]"


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


@query("op1_language_crf")
def language_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    learned = docs.where(F.coalesce(~held_out(F.col("doc_id")), F.lit(False)))
    model = crf.fit(learned)
    found = docs.select("doc_id", crf.language_column(F.col("text"), spark, model).alias("found"))
    return found.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"),
        F.size("found.spans").alias("n_spans"),
    )


@query("op2_simhash_blocks")
def simhash_blocks(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op3_cuckoo_dedup", r"""
WITH plain AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM plain WINDOW g AS (PARTITION BY t)
""")
def cuckoo_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = dedup.exact_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op4_warc_chain", """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hexed FROM p),
b AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(hexed, (i // 8) * 10 + 1, 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31) + 1 AS BIGINT),
    1)), '') AS payload_digest
  FROM d
),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM b)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
""")
def warc_chain(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


@query("op5_stupid_backoff")
def backoff(spark: SparkSession, folder: str) -> DataFrame:
    return stupid_backoff.backoff_scores(table(spark, folder, "documents"))


@query("op6_source_mix")
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mixed_words(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "first_shard")


@query("op7_line_bitmaps", r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
),
heavy AS (
  SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
j AS (
  SELECT doc_id, line, pos, coalesce(doc_id <> top, false) AS gone FROM k LEFT JOIN heavy USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
""")
def line_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs))
    return found.select(
        "row.doc_id", "n_lines", lines.bitmap_size(F.col("bitmap"), F.col("n_lines")).alias("n_dropped"),
        sha256(F.coalesce("text", F.lit(""))).alias("kept_sha256"),
    )


@query("op8_url_bloom", r"""
WITH rules(rh, rp, says) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
u AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
best AS (
  SELECT page_id, max({'n': length(rh) + length(rp), 'rule': rh || rp, 'says': says}) AS b
  FROM u JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY page_id
)
SELECT u.page_id, host, path, b.rule AS rule, coalesce(b.says, 'allow') AS verdict
FROM u LEFT JOIN best USING (page_id)
""")
def url_bloom(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), urls.rule_table(spark, URL_RULES))


@query("op9_chat_spans", r"""
WITH t AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
),
c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM t),
e AS (
  SELECT *, role || chr(10) || text || chr(10) AS whole,
    length(role || text) + length(role || text) - length(replace(role || text, '\', ''))
      + 2 * (len(regexp_extract_all(role, '</?s>|\[/?INST\]')) + len(regexp_extract_all(text, '</?s>|\[/?INST\]')))
      + length('[INST][/INST]</s>') AS chars
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(whole, '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(length('<s>') + sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""")
def chat_spans(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    case = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_CASE), (-1, 1, "assistant", CONTROL_CASE)], given.schema
    )
    return chat.read_back(chat.formatted_turns(given.union(case))).drop("rewrites")


@query("op10_benchmark_windows", r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
s AS (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS a FROM i WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, array_to_string(list_slice(w, a, a + 9), ' ') AS win, least(len(w), 10) AS n FROM s
),
sizes AS (SELECT DISTINCT n FROM windows),
p AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS a, w FROM d, sizes WHERE len(w) >= n
),
g AS (SELECT doc_id, n, a, array_to_string(list_slice(w, a, a + n - 1), ' ') AS win FROM p),
m AS (SELECT g.doc_id, g.n, g.a, windows.item FROM g JOIN windows USING (win, n)),
hits AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + n)) AS pos FROM m) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def benchmark_windows(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, folder, "benchmark"))
    return found.select(
        "row.doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("bigint").alias("n_items"),
        sha256(F.array_join("found.items", ",")).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


@query("op11_divergence_skyband", r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
),
t AS (SELECT doc, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS l FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
langs AS (SELECT lang, count(*) AS v, CAST(sum(l) AS BIGINT) AS nl FROM kept GROUP BY lang),
used AS (SELECT lang, source, term, count(*) AS g FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (
  SELECT lang, source, coalesce(n, 0) AS n, coalesce(v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, CAST(sum(g) AS BIGINT) AS n FROM used GROUP BY lang, source) USING (lang, source)
  LEFT JOIN langs USING (lang)
),
p AS (
  SELECT lang, source, term, coalesce(g, 0) AS g, l,
    1 + (1000000000 * (coalesce(g, 0) + 5)) // (n + 5 * groups.v) AS p,
    1 + (1000000000 * (l + 5)) // (nl + 5 * groups.v) AS q
  FROM groups JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN used USING (lang, source, term)
),
sums AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
),
rows AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE g > 0 AND p > q
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM rows
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
""")
def divergence_skyband(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


@query("op12_line_quality", r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
five AS (
  SELECT doc, a, list_slice(w, a, a + 4) AS win
  FROM (SELECT doc, w, unnest(range(1, greatest(len(w) - 3, 1))) AS a FROM d)
),
twice AS (SELECT doc, unnest(list(a)) AS a FROM five GROUP BY doc, win HAVING count(*) > 1),
again AS (SELECT doc, count(DISTINCT pos) AS n FROM (SELECT doc, unnest(range(a, a + 5)) AS pos FROM twice) GROUP BY doc),
lines AS (
  SELECT doc, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc, unnest(string_split(text, chr(10))) AS line FROM d)
),
measured AS (
  SELECT doc, line, len(w) AS n, list_sum(list_transform(w, lambda x: length(x))) AS chars,
    len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
    len(list_filter(w, lambda x: x IN ('|', '||', '>', '>>', '»', '·', '•', '/', '::'))) AS seps,
    len(list_filter(w, lambda x: ends_with(x, '!'))) AS cries,
    regexp_matches(line, '[.!?…。！？؟]["'')\]»”’]*[\x20\x09-\x0D]*$') AS ends,
    regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      'accept cookies|all rights reserved|click here|cookie policy|enable javascript|licensed under|log in|lorem ipsum'
      || '|privacy policy|released under|sign up|subscribe to|terms of service|terms of use') AS known
  FROM lines WHERE len(w) > 0
),
verdicts AS (
  SELECT *, (n < 8 AND NOT ends) OR 10 * symbols > chars OR (n >= 3 AND 2 * cries > n)
    OR (seps >= 3 AND 5 * seps >= n) OR (known AND n <= 30) AS failed
  FROM measured
),
sums AS (
  SELECT doc, CAST(sum(n) AS BIGINT) AS n_words, CAST(sum(chars) AS BIGINT) AS word_chars,
    CAST(sum(symbols) AS BIGINT) AS n_symbols, count(*) - count(DISTINCT line) AS n_dup_lines,
    count(*) FILTER (failed) AS n_failed_lines, CAST(coalesce(sum(chars) FILTER (failed), 0) AS BIGINT) AS lost_chars
  FROM verdicts GROUP BY doc
),
found AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, coalesce(n_symbols, 0) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words,
    coalesce(n_failed_lines, 0) AS n_failed_lines, coalesce(lost_chars, 0) AS lost_chars
  FROM d LEFT JOIN sums USING (doc) LEFT JOIN again USING (doc)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 100 * lost_chars > 50 * word_chars) AS kept,
  n_failed_lines, lost_chars
FROM found
""")
def line_quality(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judged(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "row.doc_id", "found.n_words", "found.word_chars", "found.n_symbols", "found.n_dup_lines", "found.n_repeat_words",
        "base_failed", "kept", "found.n_failed_lines", "found.lost_chars",
    )


@query("op13_prefix_art", r"""
WITH given AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
keyed AS (SELECT *, sha256(strlen(role) || chr(10) || role || chr(10) || text) AS id FROM given),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) - 1 AS pos FROM keyed),
crc_table AS (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256) AS r(i)
),
crcs AS (SELECT list(v ORDER BY i) AS v FROM crc_table),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS first,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda crc, b: xor(crc >> 8, v[CAST(xor(crc, b) & 255 AS BIGINT) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crcs
),
rebuilt AS (
  SELECT c.conv_id, t.role, t.text, 0 AS part, t.pos FROM convs AS c JOIN turns AS t ON t.conv_id = c.first AND t.pos < c.h
  UNION ALL SELECT c.conv_id, t.role, t.text, 1, t.pos FROM convs AS c JOIN turns AS t ON t.conv_id = c.conv_id AND t.pos >= c.h
),
whole AS (
  SELECT conv_id, coalesce(list({'role': role, 'text': text} ORDER BY part, pos) FILTER (role IS NOT NULL), []) AS turns
  FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id
),
prefixes AS (SELECT conv_id, d, list_slice(turns, 1, d) AS node, len(turns) AS n_turns
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM whole)),
nodes AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = n_turns), '')) AS ends_sha256
  FROM prefixes GROUP BY node, d
),
linked AS (
  SELECT c.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes AS k WHERE k.d = c.d + 1 AND list_slice(k.node, 1, c.d) = c.node) AS n_children
  FROM nodes AS c LEFT JOIN nodes AS p ON p.d = c.d - 1 AND p.node = list_slice(c.node, 1, c.d - 1)
),
below AS (
  SELECT list_slice(node, 1, u) AS node, count(*) FILTER (n_children = 0) AS n_leaves,
    CAST(sum((n_convs - 1) * CASE WHEN d = 0 THEN 0 ELSE strlen(node[d].text) END) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS u FROM linked) GROUP BY ALL
)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM linked JOIN below USING (node)
""")
def prefix_art(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, folder, "conversations"))
