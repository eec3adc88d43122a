"""Column functions against their Python counterparts."""

import html
from urllib.parse import urljoin

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evidenza.functions import sentences as S
from evidenza.functions import text as T
from evidenza.functions.urls import resolve_url, slug_after
from evidenza.functions.vectors import cosine, l2_normalize, zero_vector
from evidenza.operators.embed import word_tokens


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_names_and_titles(spark):
    assert column(spark, ["sectoral targets", "LULUCF", ""], T.capitalize) == ["Sectoral targets", "Lulucf", ""]
    assert column(spark, ["costa-rica", "new zealand"], T.title_case) == ["Costa-Rica", "New Zealand"]
    assert column(spark, ["net_zero_target"], T.label_title) == ["Net Zero Target"]
    assert column(spark, ["\t a b\xa0\n"], T.strip) == ["a b"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(0, 1000), min_size=50, max_size=200))
def test_fixed_is_exact(spark, values):
    values += [k / 2000 for k in range(0, 2000, 7)] + [0.125, 0.375, 0.94375, 2.675]
    for places in (2, 4):
        got = column(spark, values, lambda v: T.fixed(v, places), "double")
        assert got == [f"{v:.{places}f}" for v in values]


def test_number_text(spark):
    got = column(spark, [0.831, 1.0, 0.0001, 0.0, None], lambda v: T.number_text(v, 4), "double")
    assert got == ["0.831", "1.0", "0.0001", "0.0", None]


def test_entities(spark):
    values = [
        "a &amp; b", "&amp;lt;", "&eacute;t&#233; &#xE9;", "&#x1F600;", "&nosuch; &amp", "plain", "&nbsp;x", "&#38;lt;",
    ]
    expected = [html.unescape(v) for v in values]
    expected[4] = "&nosuch; &amp"  # a reference needs its semicolon here
    assert column(spark, values, T.decode_entities) == expected


BASES = ["https://example.org/countries/mexico/", "http://example.org", "https://example.org/a/b?x=1#top"]
LINKS = [
    "/countries/mexico/targets/", "targets/", "../chile/", "./here", "?page=2", "#part", "", "//other.org/x",
    "https://other.org/a/../b", "a/./b/../c?q=/../", "/x/../../y", "..", "mailto:me@example.org",
]


@pytest.mark.parametrize("base", BASES)
def test_resolve_url(spark, base):
    got = column(spark, LINKS, lambda v: resolve_url(F.lit(base), v))
    expected = [urljoin(base, link) for link in LINKS]
    # like a browser, a bare origin gets its slash back
    if base == "http://example.org":
        got = [g.replace("example.org/?", "example.org?") for g in got]
    assert got == expected


def test_slug(spark):
    urls = ["https://example.org/countries/mexico/", "https://example.org/other/"]
    got = column(spark, urls, lambda v: slug_after(v, "/countries/"))
    assert got == [u.split("/countries/")[-1].strip("/") for u in urls]


def test_document_id(spark):
    df = spark.sql("SELECT 'New Zealand' c, 'EN' l, DATE'2024-03-09' d UNION ALL SELECT null, null, null")
    got = {r.x for r in df.select(T.document_id(F.col("c"), F.col("l"), F.col("d")).alias("x")).collect()}
    assert got == {"new_zealand_en_20240309", "unknown_unknown_unknown_date"}


def test_sentences_and_chunks(spark):
    text = "One. Two! Three? Four.\nFive"
    assert column(spark, [text, "", None, "  "], S.sentences) == [
        ["One.", "Two!", "Three?", "Four.", "Five"], [], None, [],
    ]
    chunks = column(spark, [text, "Only one.", ""], lambda v: S.chunks(S.sentences(v)))
    assert chunks == [["One. Two! Three?", "Three? Four. Five", "Five"], ["Only one."], []]
    wide = column(spark, [text], lambda v: S.chunks(S.sentences(v), size=2, overlap=5))
    assert wide[0][:2] == ["One. Two!", "Two! Three?"]


def test_abbreviations(spark):
    text = "Dr. Smith came, e.g. today. He left."
    got = column(spark, [text], lambda v: S.sentences(v, S.ENGLISH_ABBREVIATIONS))
    assert got == [["Dr. Smith came, e.g. today.", "He left."]]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(counts=st.lists(st.integers(0, 30), min_size=5, max_size=20))
def test_chunk_count(spark, counts):
    texts = [" ".join(f"S{i}." for i in range(n)) for n in counts]
    for size, overlap in ((3, 1), (4, 0), (2, 1)):
        got = column(spark, texts, lambda v: F.size(S.chunks(S.sentences(v), size, overlap)))
        step = max(1, size - overlap)
        assert got == [-(-n // step) for n in counts]


def test_word_tokens(spark):
    text = "The country's well-known GRID won't fail; Müller (2020) and/or U.S. policy, policy."
    assert column(spark, [text], word_tokens) == [["country", "grid", "fail", "müller", "policy", "policy"]]


def test_vectors(spark):
    df = spark.sql("SELECT array(3f, 4f) a, array(0f, 0f) z, cast(null as array<float>) n")
    row = df.select(
        cosine(F.col("a"), F.col("a")).alias("same"), cosine(F.col("a"), F.col("z")).alias("zero"),
        cosine(F.col("a"), F.col("n")).alias("none"), l2_normalize(F.col("a")).alias("unit"),
        l2_normalize(F.col("z")).alias("unit_zero"), zero_vector(2).alias("zeros"),
    ).first()
    assert row.same == pytest.approx(1.0) and row.zero == 0.0 and row.none is None
    assert row.unit == pytest.approx([0.6, 0.8]) and row.unit_zero == [0.0, 0.0] and row.zeros == [0.0, 0.0]
