"""WARC archives: writing with revisit records, and splittable reading that
trusts no magic bytes.

An archive is read as text rows that end at ``CRLF CRLF WARC/1.0 CRLF``.  Each
row ("piece") is a candidate record; its task knows its byte position inside the
split and emits, beside its header fields, the offset of its successor: start +
header + Content-Length.  Payloads that hold the magic cut themselves into false
candidates.  Only what is reachable from the file start is a record:

* inside a split, candidates whose successor is the next piece form runs
  (a window over narrow rows of one split, which the reader bounds);
* the last candidate of a run points into another run; pointer jumping doubles
  these pointers until every run that the file start reaches is marked, in
  log2(runs of a file) rounds.

Payload digests are computed where a piece is read; payloads are not shuffled.
Only a reachable record whose payload was cut by magic is put together again, in
a second scan that reads just its pieces.

Defined cases: a null payload is empty; a null url has no target header; a row
without page_id has no record id, is a response only if no row with an id has
its payload, and rows that repeat a page_id and payload have equal records.
Reading stops, per file, at the first record without a valid length.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evidenza.llm.storage import new_path, written
from evidenza.llm.urls import bloom_filter, might_contain, slots

VERSION = "WARC/1.0\r\n"
END = "\r\n\r\n"
MAGIC = END + VERSION
#: Payloads of at least this many bytes are written once and revisited after.
REVISIT_BYTES = 0
#: Offsets meet the pieces of a cut record in cells of this many bytes.
CELL_BYTES = 1 << 20
PIECES = (
    "file string, block bigint, seq bigint, at bigint, size bigint, header bigint, length bigint, "
    "record_type string, page_id bigint, refers_to bigint, digest string"
)
BASE_32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(payload: Column) -> Column:
    """SHA-1 of a binary column in base 32, in built-in functions."""
    hexed = F.sha1(payload)

    def part(i: int) -> Column:
        digits = F.lpad(F.conv(F.substring(hexed, 10 * i + 1, 10), 16, 32), 8, "0")
        return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE_32)

    return F.concat(*[part(i) for i in range(4)])


def plan_records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Pages with ``payload``, its ``bytes`` and ``digest``, ``record_type`` and ``refers_to``.

    Only payloads that may be repeated meet in a join; a Bloom filter of bounded
    size keeps the others, payloads and all, out of the shuffle.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("bigint").alias("bytes"),
        payload_digest(payload.cast("binary")).alias("digest"),
    )
    groups = rows.groupBy("digest", "bytes").agg(F.count("*").alias("n"), F.min("page_id").alias("first_id"))
    repeated = written(groups.where("n > 1").drop("n"), "repeated-payloads")
    table = bloom_filter(repeated.select(F.col("digest").alias("key")))
    spread = rows.withColumn("maybe", might_contain(pages.sparkSession.sparkContext.broadcast(table))(
        *slots(F.xxhash64("digest"), len(table))
    ))
    own = F.col("page_id").eqNullSafe(F.col("first_id")) | (F.col("bytes") < revisit_bytes) | F.col("single")
    met = spread.where("maybe").join(repeated.withColumn("single", F.lit(False)), ["digest", "bytes"], "left")
    met = met.withColumn("single", F.coalesce("single", F.lit(True)))
    alone = spread.where("NOT maybe").withColumns({"first_id": F.lit(None).cast("bigint"), "single": F.lit(True)})
    return met.unionByName(alone).select(
        "page_id", "url", "payload", "bytes", "digest",
        F.when(own, "response").otherwise("revisit").alias("record_type"),
        F.when(~own, F.col("first_id")).alias("refers_to"),
    )


def write_archives(records: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """One archive per task under ``path``; a revisit record has no payload of its own."""
    response = F.col("record_type") == "response"
    url = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    body = F.when(response, F.col("payload")).otherwise("")

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    def urn(column: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.col(column).cast("string"), F.lit(">"))

    record = F.concat(
        F.lit(VERSION),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", urn("page_id")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Refers-To", urn("refers_to")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
        body,
    )
    records.select(record.alias("value")).write.option("lineSep", END).text(path)


def _scan(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("lineSep", MAGIC).text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )


def _field(header: bytes, name: bytes) -> str | None:
    found = re.search(rb"(?im)^" + name + rb":[ \t]*([^\r\n]*)", header)
    return found[1].decode("utf-8", "replace").strip() if found else None


def _page(header: bytes, name: bytes) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", _field(header, name) or "")
    return int(found[1]) if found else None


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per piece: where it starts in its split, its header fields, its payload's digest."""
    where, at, seq = None, 0, 0
    schema = ["file", "block", "seq", "at", "size", "header", "length", "record_type", "page_id", "refers_to", "digest"]
    kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.int64(), pa.int64(), pa.string()]
    for batch in batches:
        rows = []
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        for file, block, value in zip(files, blocks, batch.column("value"), strict=True):
            if where != (file, block):
                where, at, seq = (file, block), 0, 0
            value = value.as_py()
            size = len(value)
            # the first piece of a file has its version line, the others lost it to the separator
            skip = len(VERSION) if at == 0 and block == 0 else 0
            end = value.find(END.encode(), max(0, skip - 2))
            # a payload that begins with the version line makes the blank line part of the separator
            end = end if end >= 0 else size
            header = value[skip:end] + b"\r\n"
            length = _field(header, b"Content-Length") if value[:skip] == VERSION.encode()[:skip] else None
            length = int(length) if length and length.isdecimal() else None
            start = end + len(END)
            digest = None
            if length is not None and start + length <= size:
                digest = base64.b32encode(hashlib.sha1(value[start : start + length]).digest()).decode()
            rows.append((
                file, block, seq, at, size, start, length, _field(header, b"WARC-Type"),
                _page(header, b"WARC-Record-ID"), _page(header, b"WARC-Refers-To"), digest,
            ))
            at, seq = at + size + len(MAGIC), seq + 1
        columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], schema)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """All pieces with absolute offsets: ``start`` of the record, ``next`` (its successor's)."""
    pieces = written(_scan(spark, path).mapInArrow(_candidates, PIECES), "pieces")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    base = (
        pieces.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("consumed"))
        .select("file", "block", F.coalesce(F.sum("consumed").over(before), F.lit(0)).alias("base"))
    )
    at = F.col("base") + F.col("at")
    # a piece begins after the magic; its record begins at the version line
    start = F.when(at == 0, 0).otherwise(at - len(VERSION))
    return pieces.join(base, ["file", "block"]).select(
        *[c for c in pieces.columns if c != "at"], at.alias("at"), start.alias("start"),
        (at + F.col("header") + F.col("length") + len(END)).alias("next"),
    )


def _runs(pieces: DataFrame) -> DataFrame:
    order = W.partitionBy("file", "block").orderBy("seq")
    linked = F.coalesce(F.col("next") == F.lead("start").over(order), F.lit(False))
    marked = pieces.withColumn("linked", linked)
    first = F.when(F.lag("linked").over(order), 0).otherwise(1)
    return marked.withColumn("run", F.sum(first).over(order)).drop("linked")


def reachable(pieces: DataFrame) -> DataFrame:
    """The candidates that the start of their file reaches."""
    node = ["file", "block", "run"]
    pieces = written(_runs(pieces), "runs")
    ends = pieces.groupBy(*node).agg(F.max_by("next", "seq").alias("exit"))
    entry = pieces.select("file", F.col("start").alias("exit"), F.struct("block", "run").alias("to"))
    jumps = ends.join(entry, ["file", "exit"]).select(
        "file", F.struct("block", "run").alias("run"), "to", F.col("exit").alias("entry")
    )
    seen = pieces.where("start = 0").select("file", F.struct("block", "run").alias("run"), "start").toDF(
        "file", "run", "entry"
    )
    longest = ends.groupBy("file").count().agg(F.max("count")).first()[0] or 1
    for _ in range((longest - 1).bit_length()):
        jumps, seen = written(jumps, "jumps"), written(seen, "seen")
        step = jumps.select("file", "run", F.col("to"), F.col("entry").alias("to_entry"))
        more = seen.select("file", "run").join(step, ["file", "run"]).select("file", "to", "to_entry")
        seen = seen.union(more.toDF("file", "run", "entry"))
        after = jumps.select("file", F.col("run").alias("to"), F.col("to").alias("then"), F.col("entry").alias("late"))
        jumps = step.join(after, ["file", "to"]).select("file", "run", "then", "late").toDF(
            "file", "run", "to", "entry"
        )
    seen = seen.select("file", F.col("run.block").alias("block"), F.col("run.run").alias("run"), "entry")
    return pieces.join(seen, node).where("start >= entry").drop("entry", "run")


def _rejoined(spark: SparkSession, path: str, pieces: DataFrame, cut: DataFrame) -> DataFrame:
    """Digests of records whose payload holds the magic: ``(file, start, whole)``."""
    cells = F.sequence(F.floor(F.col("start") / CELL_BYTES), F.floor(F.col("next") / CELL_BYTES))
    owner = cut.select(
        "file", F.col("start").alias("from"), F.col("next").alias("until"), "header", "length",
        F.explode(cells).alias("cell"),
    )
    part = pieces.select("file", "block", "seq", "start", F.floor(F.col("start") / CELL_BYTES).alias("cell"))
    needed = part.join(owner, ["file", "cell"]).where("start >= from AND start < until").drop("cell")
    values = _scan(spark, path).mapInArrow(_numbered, "file string, block bigint, seq bigint, value binary")
    whole = (
        values.join(needed, ["file", "block", "seq"])
        .groupBy("file", "from", "header", "length")
        .agg(F.sort_array(F.collect_list(F.struct("start", "value"))).alias("parts"))
    )
    glued = F.aggregate(
        F.slice("parts", F.lit(2), F.size("parts")), F.element_at("parts", 1)["value"],
        lambda text, x: F.concat(text, F.lit(MAGIC).cast("binary"), x["value"]),
    )
    body = F.substring(glued, F.col("header") + 1, F.col("length"))
    digest = F.when(F.octet_length(body) == F.col("length"), payload_digest(body))
    return whole.select("file", F.col("from").alias("start"), digest.alias("whole"))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    where, seq = None, 0
    for batch in batches:
        numbers = []
        for at in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True):
            if where != at:
                where, seq = at, 0
            numbers.append(seq)
            seq += 1
        yield pa.RecordBatch.from_arrays(
            [batch.column("file"), batch.column("block"), pa.array(numbers, pa.int64()), batch.column("value")],
            ["file", "block", "seq", "value"],
        )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, page_id, record_type, refers_to, length, digest)`` of all true records."""
    pieces = candidates(spark, path)
    found = written(reachable(pieces), "records").where("length IS NOT NULL")
    cut = found.where("digest IS NULL")
    if not cut.isEmpty():
        found = found.join(_rejoined(spark, path, pieces, cut), ["file", "start"], "left").withColumn(
            "digest", F.coalesce("digest", "whole")
        )
        # a record that ends before its length has no digest and is not whole
        found = found.where("digest IS NOT NULL")
    return found.select("file", "start", "page_id", "record_type", "refers_to", "length", "digest")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives, read them back: one row per page.

    A revisit takes size and digest from the response that it refers to.
    """
    spark = pages.sparkSession
    path = new_path(spark, "archives")
    write_archives(plan_records(pages), path)
    records = read_archives(spark, path)
    responses = (
        records.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"))
        .agg(F.max("length").alias("full"), F.max("digest").alias("full_digest"))
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    # responses refer to nothing and stay out of the join
    own = records.where("record_type = 'response'").withColumnsRenamed(
        {"length": "payload_bytes", "digest": "payload_digest"}
    )
    again = records.where("record_type = 'revisit'").join(responses, "refers_to", "left").withColumnsRenamed(
        {"full": "payload_bytes", "full_digest": "payload_digest"}
    )
    return own.select(*columns).union(again.select(*columns))
