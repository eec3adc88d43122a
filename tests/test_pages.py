"""Page parsing on hand-written markup."""

from pyspark.sql import functions as F

from evidenza.functions.text import decode_entities
from evidenza.operators import pages as P

PAGE = """
<!DOCTYPE html><html><head><title>Mexico | Site</title>
<script>var t = "<p>not text</p><a href='/countries/fake/'>x</a>";</script></head>
<body><h1><img src="x.png"></h1>
<ul class="nav nav-pills"><li><a href="/countries/mexico/sources/"> Sources </a></li>
<li><a href="/countries/mexico/">Summary</a></li><li><a href="net-zero-targets/">Net zero targets</a></li>
<li><a href="/countries/mexico/targets/">Targets</a></li></ul>
<p>outside</p>
<div class="wide content-section__left-side"><h3>Left</h3><p>left text</p></div>
<div class="content-section__content">
  <h3 id="one">Title &amp; more</h3>
  <p>Plain <b>bold <strong>inner</strong></b> text<br>next
  <p>unclosed <!-- <p>comment</p> --> end
  <ul><li>first<li>second <p>nested</p></li></ul>
  <p>  </p><h3>No id</h3>
</div>
<a href="/countries/chile/">Chile</a> <a href="/countries/chile/">Chile again</a>
<a href="/countries/chile/deep/">deep</a> <a href="https://other.org/countries/x/">far</a>
</body></html>
"""


def pages(spark):
    return spark.createDataFrame([(1, "https://example.org/countries/mexico/", PAGE)], "page_id long, url string, html string")


def test_blocks(spark):
    rows = P.page_blocks(pages(spark)).orderBy("pos").collect()
    assert [(r.tag, r.has_id, r.text) for r in rows] == [
        ("h3", False, "Left"),
        ("h3", True, "Title & more"),
        ("p", False, "Plain **bold inner** textnext"),
        ("p", False, "unclosed  end"),
        ("li", False, "first"),
        ("li", False, "second nested"),
        ("p", False, "nested"),
        ("h3", False, "No id"),
    ]


def test_block_markdown(spark):
    blocks = P.page_blocks(pages(spark)).orderBy("pos")
    lines = [r.m for r in blocks.select(P.block_markdown(F.col("tag"), F.col("has_id"), F.col("text")).alias("m")).collect()]
    assert lines[:3] == ["\n### Left\n", "\n## Title & more\n", "Plain **bold inner** textnext\n"]
    assert lines[4] == "- first"


def test_links(spark):
    links = [r.link for r in P.page_links(pages(spark)).collect()]
    assert sorted(links) == ["https://example.org/countries/chile/", "https://example.org/countries/mexico/"]


def test_page_name(spark):
    name = pages(spark).select(P.page_name(F.col("html")).alias("n")).first().n
    assert name == "Mexico"
    named = spark.sql("SELECT '<title>x</title><h1><i>a</i> Peru &amp; co</h1>' h")
    assert named.select(P.page_name(F.col("h")).alias("n")).first().n == " Peru & co"


def test_section_links(spark):
    rows = P.section_links(pages(spark)).orderBy("rank").collect()
    assert [(r.section_title, r.section_url) for r in rows] == [
        ("Targets", "https://example.org/countries/mexico/targets/"),
        ("Sources", "https://example.org/countries/mexico/sources/"),
        # the match is case-sensitive, so this title is unknown and comes last
        ("Net zero targets", "https://example.org/countries/mexico/net-zero-targets/"),
    ]


def test_latest_sections_on_a_hot_title(spark):
    many = spark.range(5000).select(
        F.lit("mexico").alias("country"), F.lit("Summary").alias("section_title"), "id"
    ).unionByName(spark.sql("SELECT 'peru' country, 'Summary' section_title, 1L id"))
    got = {(r.country, r.id) for r in P.latest_sections(many, ["id"]).collect()}
    assert got == {("mexico", 4999), ("peru", 1)}


def test_document_lines(spark):
    rows = spark.sql("SELECT 'm' country, 1 section_no, 'Summary' section_title, array('a', 'b') content")
    lines = [r.line for r in P.document_lines(rows).orderBy("line_no").collect()]
    assert lines == ["# Summary", "a", "b", "\n---\n"]
    lines = [r.line for r in P.markdown_lines(rows).orderBy("line_no").collect()]
    assert lines == ["\n# Summary\n", "a", "b"]


LOOSE = """<nav class="side"><a href="/x/">not a section</a></nav>
<a href="/countries/cote-d'ivoire/">CI</a> <a href=/countries/chile/>Chile</a>
<a class="a>b" title='href="/countries/no/"' href='/countries/peru/'>Peru</a> <abbr href="/countries/abbr/">x</abbr>
<ul class="wide nav-pills nav"><li><a href="/s/"><span>Sources</span></a><ul><li><a href=/p/>Policies &amp; Actions</a></li></ul></li>
<li><a href="/t/">Tar<b>gets</b></a></li></ul>
<div class="nav nav-pills"><br><a href="/a/">Assumptions</a><a name="no-link">none</a></div><a href="/after/">Targets</a>"""


def test_loose_markup_loses_nothing(spark):
    rows = spark.createDataFrame([(1, "https://example.org/", LOOSE), (2, "https://example.org/", None)], "page_id long, url string, html string")
    assert sorted(r.link for r in P.page_links(rows).collect()) == [
        "https://example.org/countries/chile/", "https://example.org/countries/cote-d'ivoire/", "https://example.org/countries/peru/",
    ]
    found = P.section_links(rows).orderBy("rank").collect()
    assert [(r.section_title, r.section_url.removeprefix("https://example.org")) for r in found] == [
        ("Targets", "/t/"), ("Policies & Actions", "/p/"), ("Assumptions", "/a/"), ("Sources", "/s/"),
    ]


def test_bad_entities_do_not_end_the_job(spark):
    text = "&#9999999; &#xD800; &#0; &#128; &#x80; &#99999999999999999999999; &#233; &#xe9; &#; &amp;lt;"
    row = spark.createDataFrame([(text,)], "t string").select(decode_entities(F.col("t")).alias("t")).first()
    assert row.t == "\ufffd \ufffd \ufffd \u20ac \u20ac \ufffd \xe9 \xe9 &#; &lt;"


def test_names_in_awkward_markup(spark):
    from pyspark.sql import functions as F

    from evidenza.operators import pages as P

    cases = [
        ('<h1 title="a>b">Chile</h1>', "Chile"), ("<h1 title='x > y' id=z>Peru</h1><title>t</title>", "Peru"), ("<h1>Chad<p>text</p>more", "Chad"),
        ("<h1>Mali", "Mali"), ("<h1></h1><title>Cuba | tracker</title>", "Cuba"), ("<h1 title=it's>Oman</h1>", "Oman"),
        ("<h1x>no</h1x><title>Fiji</title>", "Fiji"), ("<H1\nclass=a>Togo</H1 >", "Togo"),
        (None, None), ("", None),
    ]
    found = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(cases)], "i int, html string").select("i", P.page_name(F.col("html")).alias("n"))
    assert {r.i: r.n for r in found.collect()} == {i: n for i, (_, n) in enumerate(cases)}
