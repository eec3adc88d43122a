"""Checked queries: documents, inserts, upserts, change detection, constraints."""

from pyspark.sql import functions as F

from evidenza.functions.text import contains_ignoring_case, document_id, london_time
from evidenza.operators import ingest as I
from evidenza.plans.catalog import TABLES, Tables, query
from evidenza.schemas import STRUCTURED_DOCUMENT, UNSTRUCTURED_DOCUMENT
from evidenza.sources.readers import ingest_outcome, page_country, parse_documents, sections_of_countries
from evidenza.sources.sinks import country_index as distinct_countries

NOW = "2024-06-01 12:00:00"


def _now():
    return F.lit(NOW).cast("timestamp")


def _stamp(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


# --- scans ------------------------------------------------------------------


@query(
    "sections_scan",
    """
SELECT c.country_name, d.source AS country_doc_id, d.doc_id, d.n_chars
FROM (SELECT DISTINCT source, upper(left(source, 1)) || lower(substr(source, 2)) AS country_name FROM documents) c
JOIN documents d ON d.source = c.source
""",
)
def sections_scan(t: Tables):
    key = F.col("doc_id")
    countries = t.documents.select(F.col("source").alias("doc_id")).distinct()
    countries = countries.withColumn("country_name", I.country_name(F.lit(None).cast("string"), key))
    sections = t.documents.select(
        F.col("source").alias("country_doc_id"), F.col("doc_id").alias("section_id"), "n_chars"
    )
    return sections_of_countries(countries, sections, ["section_id"]).select(
        "country_name", "country_doc_id", F.col("section_id").alias("doc_id"), "n_chars"
    )


@query("country_index", "SELECT DISTINCT source AS country FROM documents")
def country_index(t: Tables):
    return distinct_countries(t.documents.withColumnRenamed("source", "country"))


@query(
    "table_row_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in TABLES),
)
def table_row_counts(t: Tables):
    return I.table_row_counts({name: getattr(t, name) for name in TABLES})


def _structured_json(t: Tables):
    """Documents as JSON text: Spanish ones cut off, German ones with content of the
    wrong type, French ones without sections."""
    url = F.concat(F.lit("https://example.org/"), "doc_id")
    name = F.lit("country_name")
    good = F.struct(
        F.col("source").alias("country_name"),
        F.create_map(
            F.lit("Summary"), F.struct(F.split("text", "\n").alias("content"), url.alias("url")),
            F.lit("Sources"), F.struct(F.array(F.col("source")).alias("content"), url.alias("url")),
        ).alias("sections"),
    )
    wrong = F.struct(
        F.col("source").alias("country_name"),
        F.create_map(F.lit("Summary"), F.struct(F.col("text").alias("content"), url.alias("url"))).alias("sections"),
    )
    value = (
        F.when(F.col("lang") == "de", F.to_json(wrong))
        .when(F.col("lang") == "fr", F.to_json(F.create_map(name, F.col("source"))))
        .otherwise(F.to_json(good))
    )
    cut = F.when(F.col("lang") == "es", F.left(value, F.length(value) - 1)).otherwise(value)
    documents = t.documents.select("doc_id", "text", "lang", "source")
    return documents.select(F.col("doc_id").alias("country"), cut.alias("value"))


@query(
    "structured_json",
    r"""
SELECT doc_id AS country, CAST(lang = 'es' AS INTEGER) AS is_corrupt,
       CASE WHEN lang = 'es' THEN NULL ELSE source END AS country_name,
       CASE lang WHEN 'en' THEN 2 WHEN 'de' THEN 1 END AS n_sections,
       CASE WHEN lang = 'en' THEN len(string_split(text, chr(10))) END AS n_lines,
       CASE WHEN lang IN ('en', 'de') THEN 'https://example.org/' || doc_id END AS summary_url,
       CASE WHEN lang = 'en' THEN md5(trim('## Summary' || chr(10) || text || chr(10) || chr(10)
            || '## Sources' || chr(10) || source, E' \t\r\n')) END AS combined_md5
FROM documents
""",
)
def structured_json(t: Tables):
    parsed = parse_documents(_structured_json(t), STRUCTURED_DOCUMENT)
    readable = ~F.col("is_corrupt")
    summary = F.try_element_at("sections", F.lit("Summary"))
    lines = summary["content"]
    return parsed.select(
        "country",
        F.col("is_corrupt").cast("int").alias("is_corrupt"),
        F.when(readable, F.col("country_name")).alias("country_name"),
        F.when(readable, F.size(F.map_keys("sections"))).alias("n_sections"),
        F.when(readable & lines.isNotNull(), F.size(lines)).cast("bigint").alias("n_lines"),
        F.when(readable, summary["url"]).alias("summary_url"),
        F.when(readable, F.md5(I.combined_text(F.col("sections")))).alias("combined_md5"),
    )


@query(
    "ingest_outcome",
    "SELECT count(*) FILTER (lang <> 'es') AS updated, count(*) FILTER (lang = 'es') AS failed FROM documents",
)
def outcome(t: Tables):
    return ingest_outcome(parse_documents(_structured_json(t), STRUCTURED_DOCUMENT))


@query(
    "unstructured_json",
    r"""
SELECT doc_id AS country, source AS country_slug, len(string_split(text, chr(10))) + 2 AS n_lines,
       md5('# Summary' || chr(10) || text || chr(10) || chr(10) || '---' || chr(10)) AS content_md5,
       'https://example.org/' || doc_id AS summary_url,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id), '%Y-%m-%d %H:%M:%S') AS scraped_at, '1.0' AS version
FROM documents
""",
)
def unstructured_json(t: Tables):
    content = F.concat(F.array(F.lit("# Summary")), F.split("text", "\n"), F.array(F.lit("\n---\n")))
    minutes = F.make_interval(mins=F.col("doc_id").cast("int"))
    scraped = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + minutes
    rows = t.documents.select("doc_id", "text", "source").select(
        F.col("doc_id").alias("country"),
        F.to_json(
            F.struct(
                F.col("source").alias("country_slug"),
                F.col("source").alias("country_name"),
                content.alias("content"),
                F.create_map(F.lit("Summary"), F.concat(F.lit("https://example.org/"), "doc_id")).alias("urls"),
                F.date_format(scraped, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
                F.lit("1.0").alias("version"),
            )
        ).alias("value"),
    )
    parsed = parse_documents(rows, UNSTRUCTURED_DOCUMENT)
    return parsed.select(
        "country",
        "country_slug",
        F.size("content").cast("bigint").alias("n_lines"),
        F.md5(F.array_join("content", "\n")).alias("content_md5"),
        F.try_element_at("urls", F.lit("Summary")).alias("summary_url"),
        F.date_format(F.col("timestamp").try_cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("scraped_at"),
        "version",
    )


@query(
    "page_country",
    r"""
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
       lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS country FROM part
""",
)
def page_countries(t: Tables):
    file_name = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_policy_targets.md"))
    return t.part.select("p_partkey", page_country(file_name).alias("country"))


# --- section text -----------------------------------------------------------


@query(
    "combined_text",
    r"""
SELECT doc_id, md5(CASE WHEN lang = 'de' THEN '## Sources' || chr(10) || source
       ELSE '## Summary' || chr(10) || text || chr(10) || chr(10) || '## Sources' || chr(10) || source END) AS combined_md5
FROM documents
""",
)
def combined_text(t: Tables):
    body = F.when(F.col("lang") != "de", F.split("text", "\n"))
    sections = F.create_map(
        F.lit("Summary"), F.struct(body.alias("content")),
        F.lit("Sources"), F.struct(F.array("source").alias("content")),
    )
    return t.documents.select("doc_id", "text", "lang", "source").select(
        "doc_id", F.md5(I.combined_text(sections)).alias("combined_md5")
    )


def _document_sections(t: Tables):
    """One section per document, French ones without a url."""
    url = F.when(F.col("lang") != "fr", F.concat(F.lit("https://example.org/"), "doc_id"))
    body = F.struct(F.split("text", "\n").alias("content"), url.alias("url"))
    documents = t.documents.select(
        F.col("doc_id").alias("country"), F.create_map(F.lit("Summary"), body).alias("sections")
    )
    return I.explode_sections(documents)


@query(
    "valid_sections",
    r"""
WITH s AS (SELECT doc_id AS country, 'https://example.org/' || doc_id AS section_url,
                  trim(text, E' \t\r\n') AS txt, lang FROM documents)
SELECT country, 'Summary' AS section_title, section_url, length(txt) AS n_chars, md5(txt) AS text_md5
FROM s WHERE lang <> 'fr' AND length(txt) >= 20
""",
)
def valid_sections(t: Tables):
    return I.valid_sections(_document_sections(t)).select(
        "country",
        "section_title",
        "section_url",
        F.length("text_content").cast("bigint").alias("n_chars"),
        F.md5("text_content").alias("text_md5"),
    )


# --- inserts ----------------------------------------------------------------

KNOWN = """
known AS (SELECT DISTINCT d.source, d.lang FROM documents d JOIN labels l USING (doc_id) WHERE l.toxic = 1)
"""


@query(
    "insert_if_absent",
    f"""
WITH {KNOWN},
fresh AS (SELECT source, lang, min(doc_id) AS doc_id FROM documents GROUP BY ALL)
SELECT source AS country, lang AS language, CAST(NULL AS BIGINT) AS first_doc FROM known
UNION ALL
SELECT f.source, f.lang, f.doc_id FROM fresh f ANTI JOIN known k ON f.source = k.source AND f.lang = k.lang
""",
)
def insert_if_absent(t: Tables):
    rows = t.documents.select(
        F.col("source").alias("country"), F.col("lang").alias("language"), F.col("doc_id").alias("first_doc")
    )
    toxic = t.labels.filter("toxic = 1").select(F.col("doc_id").alias("first_doc"))
    known = rows.join(toxic, "first_doc").select("country", "language").distinct()
    known = known.withColumn("first_doc", F.lit(None).cast("bigint"))
    return I.insert_if_absent(known, rows, ["country", "language"], ["first_doc"])


@query(
    "section_insert",
    r"""
WITH s AS (SELECT doc_id, 'https://example.org/' || source || '/' || n_chars AS section_url, trim(text, E' \t\r\n') AS txt
           FROM documents),
old AS (SELECT section_url, min(s.doc_id) AS doc_id FROM s JOIN labels l USING (doc_id) WHERE l.quality = 0 GROUP BY 1),
fresh AS (SELECT section_url, min(doc_id) AS doc_id FROM s WHERE length(txt) >= 20 GROUP BY 1),
merged AS (SELECT 'old' AS origin, section_url, doc_id FROM old
           UNION ALL SELECT 'new', f.section_url, f.doc_id FROM fresh f ANTI JOIN old o ON o.section_url = f.section_url)
SELECT m.origin, m.section_url, m.doc_id, md5(s.txt) AS text_md5 FROM merged m JOIN s ON s.doc_id = m.doc_id
""",
)
def section_insert(t: Tables):
    url = F.concat_ws("/", F.lit("https://example.org"), "source", "n_chars")
    sections = t.documents.select(
        "doc_id", url.alias("section_url"), F.btrim("text", F.lit(" \t\r\n")).alias("text_content")
    )
    bad = t.labels.filter("quality = 0").select("doc_id")
    stored = I.first_per_key(sections.join(bad, "doc_id"), ["section_url"], ["doc_id"])
    result = I.insert_if_absent(
        stored.withColumn("origin", F.lit("old")),
        I.valid_sections(sections).withColumn("origin", F.lit("new")),
        ["section_url"],
        ["doc_id"],
    )
    return result.select("origin", "section_url", "doc_id", F.md5("text_content").alias("text_md5"))


# --- upserts ----------------------------------------------------------------


@query(
    "country_upsert",
    f"""
WITH incoming AS (
  SELECT CAST(o_custkey AS VARCHAR) AS doc_id, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS country_name,
         min(o_orderpriority) AS country_url, CAST(NULL AS VARCHAR) AS language FROM orders GROUP BY o_custkey
  UNION ALL
  SELECT 's' || s_suppkey, s_name, 'supplier/' || s_suppkey, CASE WHEN s_acctbal > 0 THEN 'de' END FROM supplier),
existing AS (SELECT CAST(c_custkey AS VARCHAR) AS doc_id, c_name, c_mktsegment FROM customer)
SELECT coalesce(e.doc_id, i.doc_id) AS doc_id, coalesce(i.country_name, e.c_name) AS country_name,
       coalesce(i.country_url, e.c_mktsegment) AS country_url,
       CASE WHEN e.doc_id IS NOT NULL THEN 'fr' ELSE coalesce(i.language, 'en') END AS language,
       CASE WHEN e.doc_id IS NOT NULL THEN '2020-01-01 00:00:00' ELSE '{NOW}' END AS created_at,
       CASE WHEN i.doc_id IS NOT NULL THEN '{NOW}' ELSE '2021-01-01 00:00:00' END AS last_scraped_at
FROM existing e FULL OUTER JOIN incoming i ON e.doc_id = i.doc_id
""",
)
def country_upsert(t: Tables):
    existing = t.customer.select(
        F.col("c_custkey").cast("string").alias("doc_id"),
        F.col("c_name").alias("country_name"),
        F.col("c_mktsegment").alias("country_url"),
        F.lit("fr").alias("language"),
        F.lit("2020-01-01 00:00:00").cast("timestamp").alias("created_at"),
        F.lit("2021-01-01 00:00:00").cast("timestamp").alias("last_scraped_at"),
    )
    crawled = t.orders.groupBy("o_custkey").agg(F.min("o_orderpriority").alias("country_url"))
    crawled = crawled.select(
        F.col("o_custkey").cast("string").alias("doc_id"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("country_name"),
        "country_url",
        F.lit(None).cast("string").alias("language"),
    )
    added = t.supplier.select(
        F.concat(F.lit("s"), "s_suppkey").alias("doc_id"),
        F.col("s_name").alias("country_name"),
        F.concat(F.lit("supplier/"), "s_suppkey").alias("country_url"),
        F.when(F.col("s_acctbal") > 0, "de").alias("language"),
    )
    merged = I.country_upsert(existing, crawled.unionByName(added), _now())
    return merged.select(
        "doc_id", "country_name", "country_url", "language", _stamp("created_at"), _stamp("last_scraped_at")
    )


def _stored_sections(t: Tables):
    """Documents as stored sections; those with a vector of the same number have one."""
    vectors = t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding")
    return t.documents.join(vectors, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("section_url"),
        F.col("source").alias("country_doc_id"),
        F.lit("Summary").alias("section_title"),
        F.col("text").alias("text_content"),
        "embedding",
        F.col("lang").alias("language"),
        F.lit("2020-01-01 00:00:00").cast("timestamp").alias("scraped_at"),
    )


@query(
    "section_upsert",
    f"""
WITH existing AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS section_url, d.source, d.text, d.lang, e.vec_id IS NOT NULL AS has_vector
  FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id),
batch AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS section_url, 'ignored' AS country_doc_id, 'Targets' AS title,
         CASE WHEN l.toxic = 1 OR l.quality = 0 THEN d.text || '!' ELSE d.text END AS text, 2 AS version
  FROM documents d JOIN labels l USING (doc_id)
  UNION ALL SELECT 'b' || item_id, 'bench', 'Sources', text, 2 FROM benchmark
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'older', 'Older', 'older ' || toxic, 1 FROM labels
  UNION ALL SELECT 'b' || item_id, 'older', 'Older', text, 1 FROM benchmark),
incoming AS (
  SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY section_url ORDER BY version DESC) = 1)
SELECT coalesce(e.section_url, i.section_url) AS section_url, coalesce(e.source, i.country_doc_id) AS country_doc_id,
       coalesce(i.title, 'Summary') AS section_title, md5(coalesce(i.text, e.text)) AS text_md5,
       CAST(coalesce(e.has_vector AND (i.text IS NULL OR i.text = e.text), FALSE) AS INTEGER) AS has_vector,
       CASE WHEN i.section_url IS NOT NULL THEN 'en' ELSE e.lang END AS language,
       CASE WHEN i.section_url IS NOT NULL THEN '{NOW}' ELSE '2020-01-01 00:00:00' END AS scraped_at
FROM existing e FULL OUTER JOIN incoming i ON e.section_url = i.section_url
""",
)
def section_upsert(t: Tables):
    changed = (F.col("toxic") == 1) | (F.col("quality") == 0)
    crawled = t.documents.select("doc_id", "text").join(t.labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("section_url"),
        F.lit("ignored").alias("country_doc_id"),
        F.lit("Targets").alias("section_title"),
        F.when(changed, F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("text_content"),
        F.lit(None).cast("string").alias("language"),
    )
    added = t.benchmark.select(
        F.concat(F.lit("b"), "item_id").alias("section_url"),
        F.lit("bench").alias("country_doc_id"),
        F.lit("Sources").alias("section_title"),
        F.col("text").alias("text_content"),
        F.lit(None).cast("string").alias("language"),
    )
    fresh = crawled.unionByName(added).withColumn("version", F.lit(2))
    stale = fresh.withColumns({
        "country_doc_id": F.lit("older"), "section_title": F.lit("Older"), "version": F.lit(1),
        "text_content": F.concat(F.lit("older "), F.length("text_content")),
    })
    # every url comes twice; the newest version counts
    merged = I.section_upsert(_stored_sections(t), stale.union(fresh), _now(), [F.col("version").desc()])
    return merged.select(
        "section_url",
        "country_doc_id",
        "section_title",
        F.md5("text_content").alias("text_md5"),
        F.col("embedding").isNotNull().cast("int").alias("has_vector"),
        "language",
        _stamp("scraped_at"),
    )


def change_batches(t: Tables):
    """Stored rows, rows that come in, and the columns to compare."""
    existing = t.documents.select("doc_id", "lang", "n_chars", "source").withColumn("scraped_at", F.lit(0))
    crawled = existing.join(t.labels, "doc_id").select(
        "doc_id",
        F.when(F.col("quality") == 0, F.upper("lang")).otherwise(F.col("lang")).alias("lang"),
        (F.col("n_chars") + F.col("toxic")).alias("n_chars"),
        "source",
        F.lit(1).alias("scraped_at"),
    )
    added = t.benchmark.select(
        (-1 - F.col("item_id")).alias("doc_id"),
        F.lit("en").alias("lang"),
        F.length("text").cast("bigint").alias("n_chars"),
        F.lit(None).cast("string").alias("source"),
        F.lit(1).alias("scraped_at"),
    )
    columns = ["lang", "n_chars", "source", "scraped_at"]
    stale = t.labels.select(
        "doc_id", F.lit("xx").alias("lang"), F.lit(-1).cast("bigint").alias("n_chars"), F.lit("older").alias("source"),
        F.lit(0).alias("scraped_at"),
    )
    incoming = stale.unionByName(crawled).unionByName(added)
    return existing, incoming, columns


@query(
    "change_classify",
    """
WITH batch AS (
  SELECT d.doc_id, CASE WHEN l.quality = 0 THEN upper(d.lang) ELSE d.lang END AS lang, d.n_chars + l.toxic AS n_chars,
         d.source, 1 AS version FROM documents d JOIN labels l USING (doc_id)
  UNION ALL SELECT -1 - item_id, 'en', length(text), CAST(NULL AS VARCHAR), 1 FROM benchmark
  UNION ALL SELECT doc_id, 'xx', -1, 'older', 0 FROM labels),
incoming AS (
  SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY version DESC) = 1),
compared AS (
  SELECT i.doc_id, CASE WHEN d.doc_id IS NULL THEN 'insert' ELSE 'update' END AS action,
         CASE WHEN d.doc_id IS NOT NULL THEN array_to_string(list_filter([
           CASE WHEN i.lang IS DISTINCT FROM d.lang THEN 'lang' END,
           CASE WHEN i.n_chars IS DISTINCT FROM d.n_chars THEN 'n_chars' END,
           CASE WHEN i.source IS DISTINCT FROM d.source THEN 'source' END], lambda c: c IS NOT NULL), ',') END AS changed
  FROM incoming i LEFT JOIN documents d ON d.doc_id = i.doc_id)
SELECT doc_id, action, changed FROM compared WHERE action = 'insert' OR changed <> ''
""",
)
def change_classify(t: Tables):
    existing, incoming, columns = change_batches(t)
    found = I.classify_changes(existing, incoming, ["doc_id"], columns, order=[F.col("scraped_at").desc()])
    return found.select("doc_id", "action", F.array_join("changed", ",").alias("changed"))


# --- keys, names and times --------------------------------------------------


@query(
    "doc_id",
    """
SELECT o_orderkey, lower(replace(c_mktsegment, ' ', '_')) || '_' ||
       CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE lower(replace(o_orderpriority, ' ', '_')) END || '_' ||
       CASE WHEN o_orderstatus = 'O' THEN 'unknown_date' ELSE strftime(o_orderdate, '%Y%m%d') END AS document_id
FROM orders JOIN customer ON c_custkey = o_custkey
""",
)
def doc_id(t: Tables):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    language = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    day = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate"))
    return rows.select("o_orderkey", document_id(F.col("c_mktsegment"), language, day).alias("document_id"))


@query(
    "name_fallback",
    """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_name
       ELSE upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) END AS country_name FROM customer
""",
)
def name_fallback(t: Tables):
    given = F.when(F.col("c_acctbal") > 0, F.col("c_name")).when(F.col("c_acctbal") < 0, F.lit(""))
    return t.customer.select("c_custkey", I.country_name(given, F.col("c_mktsegment")).alias("country_name"))


@query(
    "london_time",
    """
WITH bounds AS (
  SELECT event_id, ts, make_date(CAST(year(ts) AS BIGINT), 3, 31) AS m, make_date(CAST(year(ts) AS BIGINT), 10, 31) AS o FROM events),
summer AS (
  SELECT event_id, ts, (m - CAST(dayofweek(m) AS INTEGER)) + INTERVAL 1 HOUR AS starts,
         (o - CAST(dayofweek(o) AS INTEGER)) + INTERVAL 1 HOUR AS ends FROM bounds)
SELECT event_id, strftime(CASE WHEN ts >= starts AND ts < ends THEN ts + INTERVAL 1 HOUR ELSE ts END,
                          '%Y-%m-%d %H:%M:%S') AS london FROM summer
""",
)
def london(t: Tables):
    stamp = F.date_format(london_time(F.col("ts")), "yyyy-MM-dd HH:mm:ss")
    return t.events.select("event_id", stamp.alias("london"))


@query("name_contains", "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring')")
def name_contains(t: Tables):
    return t.part.select("p_partkey", "p_name").filter(contains_ignoring_case(F.col("p_name"), "RING"))


# --- constraints ------------------------------------------------------------


@query(
    "constraint_violations",
    """
SELECT 'not_null' AS "constraint", 'l_orderkey' AS "column", count(*) FILTER (l_orderkey IS NULL) AS violations FROM lineitem
UNION ALL SELECT 'not_null', 'l_shipdate', count(*) FILTER (l_shipdate IS NULL) FROM lineitem
UNION ALL SELECT 'unique', 'l_orderkey,l_linenumber', count(*) FROM
  (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'unique', 'l_partkey,l_suppkey', count(*) FROM
  (SELECT 1 FROM lineitem GROUP BY l_partkey, l_suppkey HAVING count(*) > 1)
UNION ALL SELECT 'foreign_key', 'l_orderkey', count(*) FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
""",
)
def constraint_violations(t: Tables):
    return I.constraint_violations(
        t.lineitem,
        not_null=("l_orderkey", "l_shipdate"),
        unique=(("l_orderkey", "l_linenumber"), ("l_partkey", "l_suppkey")),
        foreign_key="l_orderkey",
        parent=t.orders.filter("o_orderstatus <> 'P'"),
        parent_key="o_orderkey",
    )


@query(
    "cascade_delete",
    """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
""",
)
def cascade_delete(t: Tables):
    children = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return I.cascade_delete(children, t.orders.filter("o_orderstatus = 'F'"), "l_orderkey", "o_orderkey")
