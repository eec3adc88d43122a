"""Stupid-backoff language model scores as joins of n-gram count tables.

Counts cover all documents.  With c the counts, N the number of words and a = 0.4,
the score of a word after its context is

    S_k = c(context word) / c(context)   if that k-gram occurs ``min_count`` times,
          a * S_(k-1)                    otherwise;   S_1 = c(word) / N.

The count table of each order is partitioned by the 64-bit hash of the n-gram.  Its
rows and those of the exploded documents are packed, so that nearly every word does
not cross the network as a row of its own:

* documents are read once into blocks of about ``BLOCK_WORDS`` words, each a row of
  word hashes and places, and written;
* a block is exploded to its distinct n-grams with frequencies, and the n-grams
  that one hash partition counts travel as one sorted, compressed row;
* a task adds up one hash partition of the count tables, joins it to the rows that
  it was added up from, and sends the counts back, keyed by block;
* every count that a document needs is one of an n-gram in it, so a block joined to
  its counts scores its words, and the scores are summed per document.

A block asks for an n-gram once however often it occurs, so a frequent word or word
pair costs its partition no more than one entry per block.  Partitions of the tables
and blocks hold a bounded number of words (a text longer than a block is a block);
there are as many as the data needs.  The blocks are a written table: what a lost
executor held is made again from them.

Defined cases: a null text or one without words has no n-grams: n_words 0,
log_score 0, mean_log_score null.  The first words of a document back off to the
orders they have.  Rows that repeat a doc_id are scored together, and so are all rows
without doc_id.  No rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidenza.llm.batches import slices
from evidenza.llm.storage import written

ORDER = 2
BACKOFF = 0.4
MIN_COUNT = 2
#: Words that a block holds before it is closed.
BLOCK_WORDS = 1_000_000
#: Words of the corpus for each hash partition of the count tables.
PART_WORDS = 4_000_000

BLOCKS = "ids array<bigint>, lengths binary, n_words bigint, n_distinct bigint, words binary, places binary"
GRAMS = "part bigint, level int, block bigint, n bigint, grams binary, counts binary"
COUNTS = "part bigint, level int, block bigint, n bigint, counts binary"
SCORES = "doc_id bigint, n_words bigint, log_score double"


def _packed(values: np.ndarray) -> bytes:
    """Compressed bytes of an array, lowest bytes of all values first."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).ravel()


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a pair of hashes, so that of an n-gram and one more word."""
    h = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right + np.uint64(0x632BE59BD9B4E019))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the number of words of each text."""
    pieces = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, parents = pieces.flatten(), pc.list_parent_indices(pieces)
    full = pc.greater(pc.binary_length(words), 0)
    words, parents = words.filter(full), parents.filter(full).to_numpy()
    coded = words.dictionary_encode()
    distinct = pc.cast(coded.dictionary, pa.binary() if pa.types.is_string(words.type) else pa.large_binary())
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    return hashes[coded.indices.to_numpy(zero_copy_only=False)], np.bincount(parents, minlength=len(texts))


def _block_rows(block_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, hashes, held = [], [], [], 0
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(texts):
                found, sizes = _hashed_words(texts.slice(a, b - a))
                ids.append(batch.column("doc_id").slice(a, b - a))
                lengths.append(sizes)
                hashes.append(found)
                held += len(found)
                if held >= block_words:
                    yield row(ids, lengths, hashes)
                    ids, lengths, hashes, held = [], [], [], 0
        if ids:
            yield row(ids, lengths, hashes)

    def row(ids: list, lengths: list, hashes: list) -> pa.RecordBatch:
        words, places = np.unique(np.concatenate(hashes), return_inverse=True)
        names = pc.cast(pa.concat_arrays(ids), pa.int64())
        return pa.RecordBatch.from_pydict(
            {
                "ids": pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                "lengths": [_packed(np.concatenate(lengths).astype(np.uint32))],
                "n_words": pa.array([len(places)], pa.int64()),
                "n_distinct": pa.array([len(words)], pa.int64()),
                "words": [_packed(np.diff(words, prepend=np.uint64(0)))],
                "places": [_packed(places.astype(np.uint32))],
            }
        )

    return run


def token_blocks(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """All documents as numbered blocks of hashed words, written once."""
    blocks = docs.select("doc_id", "text").mapInArrow(_block_rows(block_words), BLOCKS)
    return written(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")


class _Block:
    """Words of one row of blocks, and its distinct n-grams order by order."""

    def __init__(self, row: dict) -> None:
        words = _unpacked(row["words"], row["n_distinct"], np.uint64)
        self.ids = row["ids"]
        self.lengths = _unpacked(row["lengths"], len(self.ids), np.uint32).astype(np.int64)
        self.words = np.cumsum(words, dtype=np.uint64)
        self.places = _unpacked(row["places"], row["n_words"], np.uint32)
        starts = np.cumsum(self.lengths) - self.lengths
        self.depth = np.arange(row["n_words"]) - np.repeat(starts, self.lengths)

    def levels(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per order: sorted distinct n-grams, the words that end one, and which it is."""
        hashed = self.words[self.places]
        yield self.words, np.arange(len(hashed)), self.places
        gram = hashed
        for level in range(2, order + 1):
            gram = np.concatenate([gram[:1], _mixed(gram[:-1], hashed[1:])])
            at = np.flatnonzero(self.depth >= level - 1)
            distinct, which = np.unique(gram[at], return_inverse=True)
            yield distinct, at, which


def _part_starts(grams: np.ndarray, parts: int) -> np.ndarray:
    """Where each hash partition begins among sorted n-grams, and their end."""
    part = ((grams >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))


def _gram_rows(order: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                for level, (grams, _, which) in enumerate(_Block(row).levels(order), 1):
                    counts = np.bincount(which, minlength=len(grams))
                    starts = _part_starts(grams, parts)
                    full = np.flatnonzero(np.diff(starts))
                    spans = [slice(starts[p], starts[p + 1]) for p in full]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "part": pa.array(full, pa.int64()),
                            "level": pa.array(np.full(len(full), level, np.int32)),
                            "block": pa.array(np.full(len(full), row["block"], np.int64)),
                            "n": pa.array(np.diff(starts)[full], pa.int64()),
                            "grams": pa.array(
                                [_packed(np.diff(grams[s], prepend=np.uint64(0))) for s in spans], pa.binary()
                            ),
                            "counts": pa.array([_packed(counts[s]) for s in spans], pa.binary()),
                        }
                    )

    return run


def block_grams(blocks: DataFrame, order: int, parts: int) -> DataFrame:
    """The distinct n-grams of each block with frequencies, a row per hash partition."""
    return blocks.mapInArrow(_gram_rows(order, parts), GRAMS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the count table of each (part, level) and joins it to the rows it came from."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["part"], row["level"]) != key and rows:
                yield _joined(rows)
                rows = []
            key = (row["part"], row["level"])
            rows.append(row)
    if rows:
        yield _joined(rows)


def _joined(rows: list[dict]) -> pa.RecordBatch:
    """Each row of one hash partition with the counts of its n-grams over all of them."""
    grams = np.concatenate([np.cumsum(_unpacked(r["grams"], r["n"], np.uint64), dtype=np.uint64) for r in rows])
    table, which = np.unique(grams, return_inverse=True)
    del grams
    total = np.zeros(len(table), np.int64)
    ends = np.cumsum([r["n"] for r in rows])
    spans = [which[e - r["n"] : e] for r, e in zip(rows, ends)]
    for r, span in zip(rows, spans):
        total[span] += _unpacked(r["counts"], r["n"], np.int64)
    columns = {c: [r[c] for r in rows] for c in ("part", "level", "block", "n")}
    columns["counts"] = [_packed(total[span]) for span in spans]
    schema = pa.schema(
        [("part", pa.int64()), ("level", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("counts", pa.binary())]
    )
    return pa.RecordBatch.from_pydict(columns, schema=schema)


def gram_counts(grams: DataFrame, parts: int) -> DataFrame:
    """Corpus counts for each row of :func:`block_grams`, in the order of its n-grams."""
    dealt = grams.repartitionById(parts, F.col("part").cast("int"))
    return dealt.sortWithinPartitions("part", "level").mapInArrow(_counted, COUNTS)


def _score_rows(order: int, total: int, backoff: float, min_count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counts = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["level"] == 0:
                    if block is not None:
                        yield scores(block, counts)
                    block, counts = _Block(row), {k: [] for k in range(1, order + 1)}
                else:
                    counts[row["level"]].append(_unpacked(row["counts"], row["n"], np.int64))
        if block is not None:
            yield scores(block, counts)

    def scores(block: _Block, counts: dict[int, list[np.ndarray]]) -> pa.RecordBatch:
        score = np.zeros(len(block.places))
        before = None
        for level, (grams, at, which) in enumerate(block.levels(order), 1):
            found = np.concatenate([np.zeros(0, np.int64), *counts[level]])
            if len(found) != len(grams):
                raise ValueError(f"{len(found)} counts for {len(grams)} n-grams of order {level}")
            own = np.zeros(len(score), np.int64)
            own[at] = found[which]
            if level == 1:
                score = np.log(own) - math.log(total or 1)
            else:
                seen = np.flatnonzero(own >= max(min_count, 1))
                score += math.log(backoff)
                score[seen] = np.log(own[seen]) - np.log(before[seen - 1])
            before = own
        doc = np.repeat(np.arange(len(block.lengths)), block.lengths)
        sums = np.bincount(doc, weights=score, minlength=len(block.lengths))
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(block.ids, pa.int64()),
                "n_words": pa.array(block.lengths, pa.int64()),
                "log_score": pa.array(sums, pa.float64()),
            }
        )

    return run


def backoff_scores(
    docs: DataFrame,
    order: int = ORDER,
    backoff: float = BACKOFF,
    min_count: int = MIN_COUNT,
    block_words: int = BLOCK_WORDS,
    part_words: int = PART_WORDS,
) -> DataFrame:
    """``(doc_id, n_words, log_score, mean_log_score)``, one row per doc_id."""
    spark = docs.sparkSession
    blocks = token_blocks(docs, block_words)
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // part_words))
    counts = gram_counts(block_grams(blocks, order, parts), parts)
    rows = blocks.withColumns({"part": F.lit(-1).cast("bigint"), "level": F.lit(0)})
    rows = rows.unionByName(counts, allowMissingColumns=True).repartition(parts, "block")
    scored = rows.sortWithinPartitions("block", "level", "part").mapInArrow(
        _score_rows(order, total, backoff, min_count), SCORES
    )
    sums = scored.groupBy("doc_id").agg(F.sum("n_words").alias("n_words"), F.sum("log_score").alias("log_score"))
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))
    return sums.withColumn("mean_log_score", mean)
