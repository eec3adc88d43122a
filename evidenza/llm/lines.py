"""Line dedup by a range-partitioned stream of line hashes.

Every line with a long enough key becomes one narrow row per document: a 128-bit
hash, doc_id and positions.  Rows are range-partitioned and sorted by (hash,
doc_id descending), so that a line that a third of all documents share spreads
over many partitions.  Each task streams its rows once, holding one run's state
and at most ``min_docs`` - 1 rows.  The first document of a run is the one that
keeps its lines.  Runs that may cross a partition edge are left open: they meet
in a small table with two rows per partition at most.  What comes back is not
text but one compressed keep bitmap per document that loses lines.

Defined cases: a null or empty text is one empty line.  Rows that repeat a doc_id
count as one document and are judged alike, each row by its own text.  Rows
without doc_id count as one document, smaller than any other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidenza.llm.batches import slices
from evidenza.llm.storage import written

MIN_CHARS = 40
MIN_DOCS = 5
BLANKS = " \t\n\x0b\x0c\r"
LINES = "h1 bigint, h2 bigint, doc_id bigint, text_key bigint, n_lines int, positions array<int>"
DROPPED, OPEN, EDGE = range(3)
VERDICTS = (
    "state int, h1 bigint, h2 bigint, doc_id bigint, text_key bigint, n_lines int, positions array<int>, n_docs bigint"
)


def text_key(text: Column) -> Column:
    """Tells apart the texts of rows that share a doc_id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _line_rows(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column("text")):
                yield from rows(batch.slice(a, b - a))

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = pc.ascii_lower(pc.fill_null(batch.column("text"), ""))
        split = pc.split_pattern(texts, "\n")
        counts = pc.list_value_length(split).to_numpy()
        doc = np.repeat(np.arange(len(batch)), counts)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        keys = pc.ascii_trim(pc.list_flatten(split), BLANKS)
        long = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), min_chars).to_numpy(zero_copy_only=False))
        if not long.size:
            return
        digest = xxhash.xxh128_digest
        hashed = np.frombuffer(
            b"".join(digest(x.as_py()) for x in pc.cast(keys.take(pa.array(long)), pa.binary())), ">i8"
        ).reshape(-1, 2)
        doc, place = doc[long], place[long]
        order = np.lexsort((place, hashed[:, 1], hashed[:, 0], doc))
        doc, place, hashed = doc[order], place[order], hashed[order]
        new = np.r_[True, (doc[1:] != doc[:-1]) | (hashed[1:] != hashed[:-1]).any(axis=1)]
        first = np.flatnonzero(new)
        positions = pa.ListArray.from_arrays(
            pa.array(np.r_[first, len(doc)], pa.int32()), pa.array(place, pa.int32())
        )
        at = pa.array(doc[first])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(hashed[first, 0].astype("<i8")), pa.array(hashed[first, 1].astype("<i8")),
                pc.cast(batch.column("doc_id").take(at), pa.int64()), batch.column("text_key").take(at),
                pa.array(counts[doc[first]], pa.int32()), positions,
            ],
            ["h1", "h2", "doc_id", "text_key", "n_lines", "positions"],
        )

    return run


class _Run:
    """What the stream holds of the line that it is at."""

    def __init__(self, key: tuple, first: bool):
        self.key, self.first = key, first
        self.n_docs, self.top, self.last = 0, None, ()
        self.waiting: list[tuple] = []


def _stream(min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, first = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            out: list[tuple] = []
            h = np.stack([batch.column("h1").to_numpy(), batch.column("h2").to_numpy()], axis=1)
            starts = np.r_[0, np.flatnonzero((h[1:] != h[:-1]).any(axis=1)) + 1]
            ends = np.r_[starts[1:], len(h)]
            # a single row between others can never lose its line
            worth = ends - starts > 1
            worth[[0, -1]] = True
            docs = batch.column("doc_id").to_pylist()
            for a, b in zip(starts[worth].tolist(), ends[worth].tolist(), strict=True):
                key = (int(h[a, 0]), int(h[a, 1]))
                if state is None or state.key != key:
                    if state is not None:
                        finish(state, out, state.first)
                    state, first = _Run(key, first), False
                for i in range(a, b):
                    step(state, docs[i], batch, i, out)
            yield from emit(out)
        if state is not None:
            out = []
            finish(state, out, True)
            yield from emit(out)

    def step(state: _Run, doc, batch: pa.RecordBatch, i: int, out: list) -> None:
        if (doc,) != state.last:
            state.n_docs, state.last = state.n_docs + 1, (doc,)
        if state.n_docs == 1:
            state.top = doc
            if not state.first:
                return  # the largest document keeps its lines
        row = (doc, batch.column("text_key")[i].as_py(), batch.column("n_lines")[i].as_py(), batch.column("positions")[i].as_py())
        if state.first:
            out.append((OPEN, *state.key, *row, None))
        elif state.n_docs < min_docs:
            state.waiting.append(row)
        else:
            out.extend((DROPPED, *state.key, *x, None) for x in (*state.waiting, row))
            state.waiting = []

    def finish(state: _Run, out: list, edge: bool) -> None:
        if edge:
            out.extend((OPEN, *state.key, *x, None) for x in state.waiting)
            out.append((EDGE, *state.key, state.top, None, None, None, state.n_docs))

    def emit(out: list) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), *[pa.int64()] * 4, pa.int32(), pa.list_(pa.int32()), pa.int64()]
        names = ["state", "h1", "h2", "doc_id", "text_key", "n_lines", "positions", "n_docs"]
        if out:
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def _bitmap(n_lines: pa.Array, dropped: pa.Array) -> pa.Array:
    found = []
    for n, positions in zip(n_lines.to_pylist(), dropped, strict=True):
        keep = np.ones(n, np.uint8)
        keep[np.asarray(positions.values)] = 0
        found.append(zlib.compress(np.packbits(keep).tobytes()))
    return pa.array(found, pa.binary())


_bitmap.__annotations__ = {"n_lines": pa.Array, "dropped": pa.Array, "return": pa.Array}


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(doc_id, text_key, n_lines, bitmap)`` of the documents that lose lines.

    ``bitmap`` is zlib over one bit per line, first line highest, 1 for kept.
    """
    rows = written(
        docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text").mapInArrow(_line_rows(min_chars), LINES),
        "lines",
    )
    order = ["h1", "h2", F.col("doc_id").desc_nulls_last()]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    verdicts = written(ranged.mapInArrow(_stream(min_docs), VERDICTS), "verdicts")
    edges = verdicts.where(F.col("state") == EDGE).groupBy("h1", "h2").agg(
        F.sum("n_docs").alias("docs"), F.max("doc_id").alias("top")
    )
    # two rows per partition bound the table; a hot line's open rows then stay where they are
    late = verdicts.where(F.col("state") == OPEN).drop("n_docs").join(F.broadcast(edges), ["h1", "h2"])
    late = late.where((F.col("docs") >= min_docs) & ~F.col("doc_id").eqNullSafe(F.col("top")))
    columns = ["doc_id", "text_key", "n_lines", "positions"]
    dropped = verdicts.where(F.col("state") == DROPPED).select(*columns).union(late.select(*columns))
    # rows that repeat a document repeat its positions
    found = dropped.groupBy("doc_id", "text_key", "n_lines").agg(F.flatten(F.collect_set("positions")).alias("gone"))
    return found.select(
        "doc_id", "text_key", "n_lines", F.arrow_udf(_bitmap, "binary")("n_lines", "gone").alias("bitmap")
    )


def kept_lines(texts: pa.Array, bitmaps: pa.Array) -> pa.Array:
    """Texts without the lines whose bit is 0; null where there is no bitmap."""
    found = []
    for text, bitmap in zip(texts, bitmaps, strict=True):
        if not bitmap.is_valid:
            found.append(None)
            continue
        parts = text.as_py().split("\n")
        keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap.as_py()), np.uint8), count=len(parts))
        found.append("\n".join(x for x, k in zip(parts, keep.tolist(), strict=True) if k))
    return pa.array(found, pa.string())


kept_lines.__annotations__ = {"texts": pa.Array, "bitmaps": pa.Array, "return": pa.Array}


def bitmap_size(bitmap: Column, n_lines: Column) -> Column:
    """Number of lines that a bitmap drops; no bitmap drops none."""

    def count(bitmaps: pa.Array, lines: pa.Array) -> pa.Array:
        return pa.array([
            n - int(np.unpackbits(np.frombuffer(zlib.decompress(b), np.uint8), count=n).sum()) if b is not None else 0
            for b, n in zip(bitmaps.to_pylist(), lines.to_pylist(), strict=True)
        ], pa.int64())

    count.__annotations__ = {"bitmaps": pa.Array, "lines": pa.Array, "return": pa.Array}
    return F.arrow_udf(count, "bigint")(bitmap, n_lines)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``(row, text, n_lines, bitmap)``: each document as a struct, and its kept text."""
    marks = bitmaps.select(
        F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "bitmap"
    )
    rows = docs.select(F.struct("*").alias("row"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    met = rows.join(
        marks, F.col("row.doc_id").eqNullSafe(F.col("d")) & (text_key(F.col("row.text")) == F.col("k")), "left"
    )
    touched = F.when(F.col("bitmap").isNotNull(), text)
    n_lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return met.select(
        "row", F.coalesce(F.arrow_udf(kept_lines, "string")(touched, F.col("bitmap")), F.col("row.text")).alias("text"),
        n_lines.cast("bigint").alias("n_lines"), "bitmap",
    )
