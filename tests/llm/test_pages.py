"""Archives and url rules against brute force."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from evidenza.llm import urls, warc
from evidenza.llm.storage import new_path

FAKE = "\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: {}\r\n\r\nfake"
PAGES = [
    (1, "http://a.com/", "<p>one</p>"), (2, "http://b.com/x y", "<p>one</p>"), (3, None, None), (4, "", ""),
    (5, "http://c.com", "before" + FAKE.format(4) + "\r\n\r\nafter"), (6, "http://d.com", FAKE.format(4)),
    (7, "http://e.com", "é\r\n\r\nü" + FAKE.format(100000)), (8, "http://f.com", "x" * 5000 + FAKE.format(4) * 40),
    (9, "http://g.com", "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc"), (9, "http://g.com", "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc"),
    (10, "http://h.com", "before" + FAKE.format(4) + "\r\n\r\nafter"), (None, "http://i.com", "no id"), (None, None, "<p>one</p>"),
    *[(100 + i, f"http://j.com/{i}", f"page {i} " * (i % 7)) for i in range(60)],
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumns(
        {n: F.lit(1) for n in ("payload", "digest", "start", "file", "block")}
    )


@pytest.mark.parametrize("split", ["512", "4096", "128m"])
def test_archives_round_trip(spark, pages, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = warc.round_trip(pages.coalesce(2)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = []
    for page_id, _, html in PAGES:
        body = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "").encode() == body and p is not None]
        first = min(same, default=None)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((page_id, len(body), digest, "response" if page_id == first else "revisit", None if page_id == first else first))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


def test_reading_stops_at_a_broken_record(spark):
    good = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{}>\r\nContent-Length: 2\r\n\r\nab"
    bad = good.format(2).replace("Content-Length: 2", "Content-Length: two")
    path = new_path(spark, "broken")
    lines = [good.format(1), bad, good.format(3)]
    spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string").coalesce(1).sortWithinPartitions(
        "i"
    ).select("value").write.option("lineSep", "\r\n\r\n").text(path)
    assert [r.page_id for r in warc.read_archives(spark, path).collect()] == [1]


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("NET", "/es/", "block"),
    ("net", "/fr/", "block"), ("net", "/fr/", "allow"), ("a.org", "/b", "block"), (None, "/", "block"),
]
URLS = [
    None, "", "nothing", "http://example.com/en/1", "HTTP://WWW.Example.COM/en/2?x#y", "https://x.example.com/en/", "http://net/es/",
    "http://b.net/fr/x", "http://b.net?/fr/x", "http://notnet/es/", "http://a.org/bcd", "http://a.org", "x://y://example.com/en/",
    "http://example.com/EN/1", "http:///en/", "http://b.net/\nfr/", "http://com", "http://com/",
]


def judged(url):
    url = url or ""
    if "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    at = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at])
    path = rest[at:].split("?")[0].split("#")[0]
    fits = [
        (len(h) + len(p), len(h), h.lower() + p, v) for h, p, v in RULES
        if h is not None and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("max_bytes", [urls.MAX_FILTER_BYTES, 64])
def test_rules_equal_brute_force(spark, max_bytes):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(3, URLS[3]), (None, URLS[4])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumns({n: F.lit(1) for n in ("host", "path", "rule", "key", "u")})
    found = urls.judge(pages, urls.rule_table(spark, RULES), max_bytes).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr((i, *judged(u))) for i, u in rows)


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(5000).select(F.concat(F.lit("host\n/"), F.col("id").cast("string")).alias("key"))
    table = urls.bloom_filter(keys)
    probe = urls.might_contain(spark.sparkContext.broadcast(table))

    def passing(rows):
        return rows.select(F.xxhash64("key").alias("h")).where(probe(*urls.slots(F.col("h"), len(table)))).count()

    assert passing(keys) == 5000
    assert passing(spark.range(5000).select(F.concat(F.lit("other\n/"), F.col("id").cast("string")).alias("key"))) < 150


def test_no_urls_or_rules(spark):
    none = spark.createDataFrame([], "page_id bigint, url string")
    assert urls.judge(none, urls.rule_table(spark, RULES)).count() == 0
    one = spark.createDataFrame([(1, "http://example.com/en/1")], "page_id bigint, url string")
    rules = spark.createDataFrame([], "rule_host string, rule_path string, verdict string")
    assert [tuple(r) for r in urls.judge(one, rules).collect()] == [(1, "example.com", "/en/1", None, "allow")]
