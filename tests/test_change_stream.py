"""Change classes of arriving items: late and repeated ones, restarts, expiry, and the batch operator."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from evidenza.operators.ingest import classify_changes
from evidenza.plans.catalog import Tables
from evidenza.plans.ingest_queries import change_batches
from evidenza.streaming.changes import NEVER, change_stream, decide
from evidenza.streaming.ingest import append_to_log

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ITEM = "url string, title string, body string, scraped_at timestamp"


def test_decisions():
    columns = ["a", "b"]
    assert decide(None, "1,2", 5, columns) == ("insert", None)
    assert decide(("1,2", 5), "1,2", 5, columns) == ("unchanged", [])
    assert decide(("1,2", 5), "1,3", 6, columns) == ("update", ["b"])
    assert decide(("1,2", 5), "-,3", 5, columns) == ("update", ["a", "b"])
    assert decide(("1,2", 5), "3,3", 4, columns) == ("late", None)
    assert decide(("1,2", NEVER), "1,2", NEVER, columns) == ("unchanged", [])


class Job:
    """Batches of items put into a folder, and one run of the stream for each."""

    def __init__(self, spark, folder, schema, key, columns, **options):
        self.spark, self.folder, self.schema = spark, folder, schema
        self.key, self.columns, self.options = key, columns, options
        self.seen = set()
        (folder / "items").mkdir()

    def run(self, batch=None):
        if batch is not None:
            batch.coalesce(1).write.mode("append").parquet(str(self.folder / "items"))
        items = self.spark.readStream.schema(self.schema).parquet(str(self.folder / "items"))
        found = change_stream(items, self.key, self.columns, **self.options)
        append_to_log(found, str(self.folder / "log"), str(self.folder / "checkpoint")).awaitTermination()
        if not (self.folder / "log").exists():
            return []
        log = self.spark.read.parquet(str(self.folder / "log"))
        fresh = [r for r in log.collect() if r.batch_id not in self.seen]
        self.seen |= {r.batch_id for r in fresh}
        return fresh


def day(n):
    return datetime(2024, 7, n, 12)


def rows(found):
    return {r.url: (r.action, r.changed, r.n_items) for r in found}


def test_late_and_repeated_items_and_restarts(spark, tmp_path):
    job = Job(spark, tmp_path, ITEM, ["url"], ["title", "body", "scraped_at"])

    def put(*items):
        return job.run(spark.createDataFrame(list(items), ITEM))

    first = put(("u1", "T", "x", day(2)), ("u1", "T", "old", day(1)), ("u2", None, "y", None), (None, "N", "n", day(2)))
    assert rows(first) == {"u1": ("insert", None, 2), "u2": ("insert", None, 1), None: ("insert", None, 1)}
    assert {r.url: r.london_at for r in first} == {"u1": datetime(2024, 7, 2, 13), "u2": None, None: datetime(2024, 7, 2, 13)}
    # each run starts the job anew from its checkpoint; columns without a change and the time do not count
    second = put(("u1", "T", "x", day(3)), ("u2", "", "y", day(3)), ("u3", "T", "x" * 100_000, day(3)))
    assert rows(second) == {"u1": ("unchanged", [], 1), "u2": ("update", ["title"], 1), "u3": ("insert", None, 1)}
    third = put(("u1", "Z", "z", day(2)), ("u2", "", "y", None), ("u3", "T", "new", day(3)), ("u3", "T", "new", day(3)))
    assert rows(third) == {"u1": ("late", None, 1), "u2": ("late", None, 1), "u3": ("update", ["body"], 2)}
    assert rows(put(("u1", "T", "x", day(4)))) == {"u1": ("unchanged", [], 1)}  # the late item changed nothing
    assert job.run() == []


def test_keys_are_forgotten(spark, tmp_path):
    job = Job(spark, tmp_path, ITEM, ["url"], ["title", "body"], expire_after=timedelta(milliseconds=1))
    for _ in range(2):
        found = job.run(spark.createDataFrame([("u1", "T", "x", day(2))], ITEM))
        assert rows(found) == {"u1": ("insert", None, 1)}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
def test_equals_the_batch_operator(spark, tmp_path):
    existing, incoming, columns = change_batches(Tables(spark, FOLDER))
    schema = "doc_id bigint, lang string, n_chars bigint, source string, scraped_at int"
    job = Job(spark, tmp_path, schema, ["doc_id"], columns)
    stored = job.run(existing)
    assert len(stored) == existing.count() and {r.action for r in stored} == {"insert"}
    found = job.run(incoming.select(existing.columns))
    got = sorted((r.doc_id, r.action, r.changed) for r in found if r.action in ("insert", "update"))
    want = classify_changes(existing, incoming, ["doc_id"], columns, order=[F.col("scraped_at").desc()])
    assert got == sorted((r.doc_id, r.action, r.changed) for r in want.collect()) and got
    assert len(found) == incoming.select("doc_id").distinct().count()
