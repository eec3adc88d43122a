"""Readers and writers on files written by hand or by the writers themselves."""

import json
import os

import pytest

from pyspark.sql import functions as F

from evidenza.operators import classify as C
from evidenza.operators import ingest as I
from evidenza.operators import pages as P
from evidenza.sources import readers, sinks
from evidenza.streaming import ingest as stream


def put(folder, **files):
    for name, content in files.items():
        (folder / name.replace("__", ".")).write_text(content, encoding="utf-8")
    return str(folder)


def test_structured_folder(spark, tmp_path):
    good = {
        "country_name": "Ukraine",
        "sections": {
            "Summary": {"content": ["First paragraph.\n", "- second"], "url": "https://example.org/u/"},
            "Short": {"content": ["too short"], "url": "https://example.org/s/"},
            "Wrong": {"content": "not a list", "url": "https://example.org/w/"},
            "NoUrl": {"content": ["long enough to be a section"]},
            "Empty": {"content": [], "url": "https://example.org/e/"},
        },
    }
    path = put(
        tmp_path,
        ukraine__json=json.dumps(good, indent=2),
        gabon__json='{"country_name": ""}',
        bad__json='{"country_name": "x", ',
        notes__txt="ignored",
    )
    documents = readers.read_structured(spark, path, lines=False).cache()
    assert tuple(readers.ingest_outcome(documents).first()) == (2, 1)
    readable = documents.filter("NOT is_corrupt")
    names = {
        r.country: r.n for r in readable.select("country", I.country_name(F.col("country_name"), F.col("country")).alias("n")).collect()
    }
    assert names == {"ukraine": "Ukraine", "gabon": "Gabon"}
    kept = I.valid_sections(I.explode_sections(readable)).collect()
    assert [(r.country, r.section_title, r.text_content) for r in kept] == [
        ("ukraine", "Summary", "First paragraph.\n\n- second")
    ]
    text = {r.country: r.t for r in readable.select("country", I.combined_text(F.col("sections")).alias("t")).collect()}
    assert text["gabon"] is None
    assert text["ukraine"].startswith("## Summary\nFirst paragraph.\n\n- second\n\n## Short\ntoo short\n")
    assert "Wrong" not in text["ukraine"] and text["ukraine"].endswith("## Empty")


def test_structured_round_trip(spark, tmp_path):
    sections = spark.createDataFrame(
        [("m", "Mexico", "Summary", "https://example.org/m/", ["a", "b"]), ("m", "Mexico", "Targets", "https://example.org/m/t/", ["c"])],
        "country string, country_name string, section_title string, section_url string, content array<string>",
    ).withColumn("scraped_at", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    path = str(tmp_path / "structured")
    for _ in range(2):  # a second run replaces, it does not append
        sinks.write_structured(sections, path)
    back = I.explode_sections(readers.read_structured(spark, path, lines=True))
    assert {(r.country, r.section_title, r.text_content) for r in back.collect()} == {
        ("m", "Summary", "a\nb"), ("m", "Targets", "c"),
    }
    flat = str(tmp_path / "unstructured")
    sinks.write_unstructured(sections, flat, F.col("content"))
    again = readers.read_unstructured(spark, flat, lines=True)
    assert again.count() == 2 and not any(r.is_corrupt for r in again.collect())
    row = again.filter("urls.Summary IS NOT NULL").first()
    assert row.content == ["a", "b"] and row.version == "1.0" and row.country == "m"
    items = str(tmp_path / "items")
    sinks.write_items(sections.withColumn("section_title", F.lit("Net Zero")), items)
    assert os.path.isdir(f"{items}/country=m/section=net_zero")
    assert [r.country for r in sinks.country_index(sections).collect()] == ["m"]


def test_unstructured_folder(spark, tmp_path):
    doc = {
        "country_slug": "m", "country_name": "Mexico", "content": ["# Summary", "x", "\n---\n"],
        "urls": {"Summary": "https://example.org/m/"}, "timestamp": "2025-03-01T10:20:30.123456", "version": "1.0",
    }
    row = readers.read_unstructured(spark, put(tmp_path, m__json=json.dumps(doc)), lines=False).first()
    assert row.content == doc["content"] and row.urls == doc["urls"] and row.timestamp.hour == 10


def test_reports_folder(spark, tmp_path):
    reports = spark.createDataFrame(
        [("mexico", "## Country: Mexico\n\n### Question 1: Q?\n\n> x\n")], "country string, value string"
    )
    out = str(tmp_path / "out")
    sinks.write_documents(reports, out)
    sinks.write_documents(reports, out)
    assert spark.read.text(out, wholetext=True).count() == 1
    folder = tmp_path / "in"
    folder.mkdir()
    path = put(folder, mexico_report__md="### Q\nx", **{"new-zealand_report__md": "### Q\ny", "_report__md": "blank", "other__md": "z"})
    assert {r.country for r in readers.read_reports(spark, path).collect()} == {"mexico", "new-zealand"}
    assert [r.country for r in readers.read_reports(spark, path, "ZEAL").collect()] == ["new-zealand"]
    pages = put(folder, **{"costa-rica_policy_targets__md": "# x", "saudi_arabia_policy_targets__md": "# y"})
    assert {r.country for r in readers.read_prediction_pages(spark, pages).collect()} == {"Costa-Rica", "Saudi Arabia"}


def test_predictions_file(spark, tmp_path):
    nested = {
        "argentina": {
            "net_zero_target": {"yes_no": "yes", "year": ["2050"], "confidence": 0.8, "quote": "q"},
            "carbon_pricing": {"yes_no": "no", "year": None},
        },
        "": {"net_zero_target": {"yes_no": "no"}},
    }
    path = put(tmp_path, predictions__json=json.dumps(nested, indent=2)) + "/predictions.json"
    rows = readers.read_predictions(spark, path, lines=False).filter("country <> ''")
    assert {(r.country, r.label, r.yes_no) for r in rows.collect()} == {
        ("argentina", "net_zero_target", "yes"), ("argentina", "carbon_pricing", "no"),
    }
    out = str(tmp_path / "out")
    sinks.write_predictions(C.nest_predictions(rows), out)
    again = readers.read_predictions(spark, out, lines=True)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, rows.collect()))
    truth = put(tmp_path, truth__json='{"a": {"sector_targets": {"yes_no": "yes", "targets": [{"sector": ["x"]}]}}}') + "/truth.json"
    assert [tuple(r) for r in readers.read_truth(spark, truth, lines=False).collect()] == [("a", "sector_targets", "yes")]


def test_writing_runs_its_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(50).select(
        F.lit("hot").alias("country"), F.lit("Hot").alias("country_name"), F.lit("T").alias("section_title"),
        F.col("id").cast("string").alias("section_url"), F.array(F.lit("x")).alias("content"),
    )
    sinks.write_structured(rows.mapInArrow(counted, rows.schema), str(tmp_path / "out"))
    assert seen.value == 50 and readers.read_structured(spark, str(tmp_path / "out"), lines=True).count() == 50


def test_nothing_vanishes_from_json_files(spark, tmp_path):
    two = '{"country_name": "a", "sections": {}}\n{"country_name": "b", "sections": {}}\n'
    path = put(tmp_path, many__json=two, cut__json='{"country_name": ', text__json="words")
    whole = {r.country: r.is_corrupt for r in readers.read_structured(spark, path, lines=False).collect()}
    assert whole == {"many": True, "cut": True, "text": True}
    assert tuple(readers.ingest_outcome(readers.read_structured(spark, path, lines=True)).first()) == (2, 2)
    leaves = [(f"c{i}", "net_zero_target", "yes") for i in range(5)]
    rows = spark.createDataFrame(leaves, "country string, label string, yes_no string")
    for name, kind in (("explanation", "string"), ("year", "array<string>"), ("sectors", "array<string>"), ("quote", "string"), ("confidence", "double"), ("source_url", "string")):
        rows = rows.withColumn(name, F.lit(None).cast(kind))
    out = str(tmp_path / "predictions")
    sinks.write_predictions(C.nest_predictions(rows.coalesce(1)), out)
    assert {r.country for r in readers.read_predictions(spark, out, lines=True).collect()} == {r[0] for r in leaves}
    for bad in (out, path):
        with pytest.raises(Exception, match="not one JSON object"):
            readers.read_predictions(spark, bad, lines=False).collect()


def test_lines_and_ordered_text(spark, tmp_path):
    sections = spark.sql("SELECT 'm' country, id section_no, concat('T', id) section_title, array('x', 'y') content FROM range(3)")
    lines = P.document_lines(sections)
    out = str(tmp_path / "lines")
    for _ in range(2):
        sinks.write_lines(lines, out, ["section_no", "line_no"])
    files = sorted(f for f in os.listdir(f"{out}/country=m") if f.startswith("part-"))
    text = "".join(open(f"{out}/country=m/{f}").read() for f in files)
    assert text == "".join(f"# T{i}\nx\ny\n\n---\n\n" for i in range(3))
    boxes = str(tmp_path / "boxes")
    sinks.write_ordered_text(sections.select("section_no", F.col("section_title").alias("line")), boxes, ["section_no"], separator="\n---\n")
    files = sorted(f for f in os.listdir(boxes) if f.startswith("part-"))
    assert "".join(open(f"{boxes}/{f}").read() for f in files) == "T0\n---\nT1\n---\nT2\n---\n"


def test_low_confidence_csv(spark, tmp_path):
    out = str(tmp_path / "low")
    counts = spark.createDataFrame([("Ukraine", 5)], "country string, low_confidence_count long")
    assert sinks.write_low_confidence(counts, out) is True
    assert [tuple(r) for r in spark.read.option("header", True).csv(out).collect()] == [("Ukraine", "5")]
    assert sinks.write_low_confidence(counts.filter("false"), out) is False
    assert spark.read.option("header", True).csv(out).count() == 0


def test_item_stream(spark, tmp_path):
    source, log, checkpoint = (tmp_path / n for n in ("items", "log", "checkpoint"))
    source.mkdir()

    def item(url, text, at):
        return json.dumps({"country_doc_id": "m", "section_title": "S", "section_url": url, "text_content": text, "scraped_at": at})

    def run():
        stream.append_to_log(stream.stream_items(spark, str(source)), str(log), str(checkpoint)).awaitTermination()

    first, second = "the first text of a section", "the second text of a section"
    put(source, a__json="\n".join([item("u1", first, "2024-01-01T00:00:00Z"), item("u2", "short", "2024-01-01T00:00:00Z")]))
    run()
    put(source, b__json="\n".join([item("u1", second, "2024-01-02T00:00:00Z"), item("u3", first, "2024-01-02T00:00:00Z")]))
    run()
    run()  # nothing new
    current = stream.current_sections(spark.read.parquet(str(log)))
    assert {(r.section_url, r.text_content, r.language) for r in current.collect()} == {("u1", second, "en"), ("u3", first, "en")}
