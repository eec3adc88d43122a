"""Checked queries: page tables -> links, names, blocks and sections."""

from pyspark.sql import functions as F

from evidenza.functions.urls import slug_after
from evidenza.operators import pages as P
from evidenza.plans.catalog import Tables, query

VISIBLE = r"regexp_replace(html, '<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'gis')"
ORIGIN = "regexp_extract(url, '^(https?://[^/?#]*)', 1)"


@query(
    "page_links",
    rf"""
WITH visible AS (SELECT page_id, {ORIGIN} AS origin, {VISIBLE} AS h FROM pages),
     links AS (SELECT page_id, origin,
                      unnest(regexp_extract_all(h, '<a\s(?:[^>]*?\s)?href\s*=\s*["'']([^"'']*)["'']', 1, 'is')) AS a
               FROM visible)
SELECT DISTINCT page_id, origin || a AS link FROM links
WHERE contains(a, '/') AND length(a) - length(replace(a, '/', '')) = 1
""",
)
def page_links(t: Tables):
    return P.page_links(t.pages.select("page_id", "url", "html"), part="/", slashes=1)


@query("page_slug", "SELECT page_id, trim(split_part(url, '/en/', -1), '/') AS slug FROM pages")
def page_slug(t: Tables):
    return t.pages.select("page_id", slug_after(F.col("url"), "/en/").alias("slug"))


@query(
    "page_title",
    rf"""
WITH found AS (
  SELECT page_id, nullif(regexp_extract({VISIBLE}, '<h1[^>]*>([^<]+)', 1, 'i'), '') AS h1,
         trim(split_part(regexp_extract({VISIBLE}, '<title[^>]*>([^<]+)', 1, 'i'), ' | ', 1)) AS title
  FROM pages)
SELECT page_id, replace(replace(coalesce(h1, title), '&quot;', '"'), '&amp;', '&') AS page_name FROM found
""",
)
def page_title(t: Tables):
    return t.pages.select("page_id", "html").select(
        "page_id", P.page_name(F.col("html")).alias("page_name")
    )


BLOCKS = r"""
WITH article AS (
  SELECT page_id, split_part(split_part(html, '<article>', 2), '</article>', 1) AS body FROM pages),
pieces AS (
  SELECT page_id, string_split(body, '<p>')[2:] AS ps FROM article),
raw AS (
  SELECT page_id, generate_subscripts(ps, 1) AS n, split_part(unnest(ps), '</p>', 1) AS p FROM pieces),
plain AS (
  SELECT page_id, n, regexp_replace(replace(p, '<b>', '**') || CASE WHEN contains(p, '<b>') THEN '**' ELSE '' END,
                                    '<[^>]*>', '', 'g') AS s FROM raw),
decoded AS (
  SELECT page_id, n, trim(replace(replace(s, '&quot;', '"'), '&amp;', '&'), E' \t\r\n') AS block_text FROM plain),
blocks AS (
  SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS INTEGER) AS pos,
         'p' AS tag, block_text FROM decoded WHERE block_text <> '')
"""


def _blocks(t: Tables):
    return P.page_blocks(t.pages.select("page_id", "html"), {"article": ("p", "li", "h3")})


@query("page_blocks", BLOCKS + "SELECT page_id, pos, tag, block_text FROM blocks")
def page_blocks(t: Tables):
    return _blocks(t).select("page_id", "pos", "tag", F.col("text").alias("block_text"))


@query(
    "page_block_markdown",
    BLOCKS + "SELECT page_id, pos, block_text || chr(10) AS markdown FROM blocks",
)
def page_block_markdown(t: Tables):
    line = P.block_markdown(F.col("tag"), F.col("has_id"), F.col("text"))
    return _blocks(t).select("page_id", "pos", line.alias("markdown"))


@query(
    "section_order",
    rf"""
WITH nav AS (SELECT page_id, {ORIGIN} AS origin,
                    regexp_extract({VISIBLE}, '<nav>(.*?)</nav>', 1, 'is') AS n FROM pages),
links AS (SELECT page_id, origin, regexp_extract_all(n, '<a\s[^>]*?href="([^"]*)"[^>]*>([^<]*)', 1, 'is') AS hrefs,
                 regexp_extract_all(n, '<a\s[^>]*?href="([^"]*)"[^>]*>([^<]*)', 2, 'is') AS titles FROM nav),
rows AS (SELECT page_id, origin, generate_subscripts(hrefs, 1) AS position, unnest(hrefs) AS href,
                trim(unnest(titles)) AS title FROM links),
kept AS (SELECT *, CASE title WHEN 'The' THEN 1 WHEN 'of' THEN 2 WHEN 'and' THEN 3 WHEN 'to' THEN 4 ELSE 5 END AS place
         FROM rows WHERE title <> 'The')
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY place, position) - 1 AS INTEGER) AS place_no,
       title AS section_title, origin || href AS section_url FROM kept
""",
)
def section_order(t: Tables):
    links = P.section_links(
        t.pages.select("page_id", "url", "html"),
        nav_tag="nav",
        nav_classes=(),
        order=("The", "of", "and", "to"),
        skip=("The",),
    )
    return links.withColumnRenamed("rank", "place_no")


@query(
    "sections_to_map",
    """
WITH s AS (SELECT lang AS country, source AS section_title, 'https://example.org/' || doc_id AS section_url,
                  md5(text) AS content_md5,
                  row_number() OVER (PARTITION BY lang, source ORDER BY doc_id DESC) AS rn FROM documents)
SELECT country, section_title, section_url, content_md5 FROM s WHERE rn = 1
""",
)
def sections_to_map(t: Tables):
    written = t.documents.select(
        F.col("lang").alias("country"),
        F.col("source").alias("section_title"),
        F.concat(F.lit("https://example.org/"), "doc_id").alias("section_url"),
        F.md5("text").alias("content_md5"),
        "doc_id",
    )
    return P.latest_sections(written, order=["doc_id"]).drop("doc_id")


@query(
    "document_flatten",
    r"""
WITH d AS (SELECT source, doc_id, list_concat(list_concat(['# Section ' || doc_id], string_split(text, chr(10))),
                                              [chr(10) || '---' || chr(10)]) AS ls FROM documents)
SELECT source AS country, doc_id, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS line_no, unnest(ls) AS line FROM d
""",
)
def document_flatten(t: Tables):
    sections = t.documents.select(
        F.col("source").alias("country"),
        "doc_id",
        F.concat(F.lit("Section "), "doc_id").alias("section_title"),
        F.split("text", "\n").alias("content"),
    )
    return P.document_lines(sections, key=("country", "doc_id"))


@query(
    "section_markdown",
    r"""
WITH d AS (SELECT source, doc_id, list_concat([chr(10) || '# Section ' || doc_id || chr(10)],
                                              string_split(text, chr(10))) AS ls FROM documents)
SELECT source AS country, doc_id, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS line_no, unnest(ls) AS line FROM d
""",
)
def section_markdown(t: Tables):
    sections = t.documents.select(
        F.col("source").alias("country"),
        "doc_id",
        F.concat(F.lit("Section "), "doc_id").alias("section_title"),
        F.split("text", "\n").alias("content"),
    )
    return P.markdown_lines(sections, key=("country", "doc_id"))
