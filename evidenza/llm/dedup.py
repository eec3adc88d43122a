"""Exact dedup through a cuckoo-filter index of live digests.

The index is cut into shards by a hash of the digest.  A shard holds a cuckoo
filter (16-bit fingerprints, four slots a bucket) and, by primary bucket, the
content it stands for: digest, smallest doc_id, number of rows.  A digest that
the filter does not know is new.  A hit is verified against the content of its
bucket; only an equal 256-bit digest counts, so a false positive becomes a key of
its own.  An insertion that finds no slot doubles the shard's filter, which is
filled again from the stored keys.  Deletion verifies in the same way, then takes
the fingerprint out of the filter.  Shards are sized by ``shard_keys``, so no
task holds more than that many keys at a time; copies are combined inside each
Arrow batch before anything is shuffled.

Defined cases: null and empty texts are equal; a row without doc_id is counted
and can stay only if its group has no doc_id at all; of rows that repeat a doc_id and
its text one stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidenza.llm.storage import written

SHARD_KEYS = 100_000
SLOTS = 4
MAX_KICKS = 200
INDEX = "shard bigint, digest binary, keep_id bigint, group_size bigint, filter binary"
STATE, STORED, DELETED, INSERTED = range(4)


def content_digest(text: Column) -> Column:
    """SHA-256 of the text with each run of blanks as one space; null is empty."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.unhex(F.sha2(plain.cast("binary"), 256))


class CuckooFilter:
    """Approximate set of digests with deletion; false positives, never false negatives."""

    def __init__(self, buckets: int = 1024, table: bytes | None = None):
        self.slots = memoryview(bytearray(table if table else 2 * SLOTS * buckets)).cast("H")
        self.mask = len(self.slots) // SLOTS - 1
        if self.mask & (self.mask + 1):
            raise ValueError("the number of buckets must be a power of two")

    def places(self, digest: bytes) -> tuple[int, int, int]:
        """Fingerprint, primary bucket, other bucket."""
        mark = int.from_bytes(digest[:2], "big") or 1
        first = int.from_bytes(digest[2:10], "big") & self.mask
        return mark, first, self.other(first, mark)

    def other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x9E3779B1)) & self.mask

    def _put(self, bucket: int, old: int, new: int) -> bool:
        for at in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
            if self.slots[at] == old:
                self.slots[at] = new
                return True
        return False

    def __contains__(self, digest: bytes) -> bool:
        mark, first, other = self.places(digest)
        return any(
            mark in self.slots[SLOTS * b : SLOTS * b + SLOTS].tolist() for b in (first, other)
        )

    def insert(self, digest: bytes) -> bool:
        """False if no slot was found; the filter must then be built anew, larger."""
        mark, first, other = self.places(digest)
        if self._put(first, 0, mark) or self._put(other, 0, mark):
            return True
        bucket = other
        for kick in range(MAX_KICKS):
            at = SLOTS * bucket + kick % SLOTS
            mark, self.slots[at] = self.slots[at], mark
            bucket = self.other(bucket, mark)
            if self._put(bucket, 0, mark):
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        """Only for digests known to be in the set."""
        mark, first, other = self.places(digest)
        return self._put(first, mark, 0) or self._put(other, mark, 0)


class Shard:
    """One shard: the filter, and the content of each primary bucket."""

    def __init__(self, buckets: int = 1024):
        self.filter = CuckooFilter(buckets)
        self.content: dict[int, list[list]] = {}
        self.resized = 0

    def _find(self, digest: bytes) -> list | None:
        if digest not in self.filter:
            return None
        _, bucket, _ = self.filter.places(digest)
        return next((x for x in self.content.get(bucket, ()) if x[0] == digest), None)

    def _store(self, entry: list) -> None:
        _, bucket, _ = self.filter.places(entry[0])
        self.content.setdefault(bucket, []).append(entry)

    def entries(self) -> Iterator[list]:
        for bucket in self.content.values():
            yield from bucket

    def restore(self, table: bytes) -> None:
        self.filter = CuckooFilter(table=table)

    def insert(self, digest: bytes, keep_id: int | None, rows: int) -> None:
        known = self._find(digest)
        if known is not None:
            known[1] = min((x for x in (known[1], keep_id) if x is not None), default=None)
            known[2] += rows
            return
        self._store([digest, keep_id, rows])
        if not self.filter.insert(digest):
            self.resize()

    def resize(self) -> None:
        """Double the filter until all stored keys fit."""
        keys, buckets = list(self.entries()), self.filter.mask + 1
        while True:
            buckets *= 2
            self.resized += 1
            self.filter, self.content = CuckooFilter(buckets), {}
            for entry in keys:
                self._store(entry)
            if all(self.filter.insert(entry[0]) for entry in keys):
                return

    def delete(self, digest: bytes) -> bool:
        known = self._find(digest)
        if known is None:
            return False
        _, bucket, _ = self.filter.places(digest)
        self.content[bucket].remove(known)
        return self.filter.delete(digest)


def _run_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shard, kind); each shard is emitted when it is complete."""
    current, shard = None, Shard()

    def rows() -> Iterator[pa.RecordBatch]:
        found = list(shard.entries())
        for start in range(0, len(found), 10_000):
            part = found[start : start + 10_000]
            yield _index_rows(current, part, [None] * len(part))
        yield _index_rows(current, [(None, None, None)], [bytes(shard.filter.slots)])

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("shard", "kind", "digest", "keep_id", "group_size", "filter")]
        for number, kind, digest, keep_id, size, table in zip(*columns, strict=True):
            if number != current:
                if current is not None:
                    yield from rows()
                current, shard = number, Shard()
            if kind == STATE:
                shard.restore(table)
            elif kind == STORED:
                shard._store([digest, keep_id, size])
            elif kind == DELETED:
                shard.delete(digest)
            else:
                shard.insert(digest, keep_id, size)
    if current is not None:
        yield from rows()


def _index_rows(shard: int, entries: list, tables: list) -> pa.RecordBatch:
    digests, keeps, sizes = zip(*entries, strict=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard] * len(entries), pa.int64()),
            pa.array(digests, pa.binary()),
            pa.array(keeps, pa.int64()),
            pa.array(sizes, pa.int64()),
            pa.array(tables, pa.binary()),
        ],
        ["shard", "digest", "keep_id", "group_size", "filter"],
    )


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies inside one batch become one row before the shuffle."""
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by("digest").aggregate([("doc_id", "min"), ([], "count_all")])
        names = dict(zip(table.column_names, table.columns, strict=True))
        yield from pa.table(
            {
                "digest": names["digest"],
                "keep_id": pc.cast(names["doc_id_min"], pa.int64()),
                "group_size": pc.cast(names["count_all"], pa.int64()),
            }
        ).to_batches()


def _apply(rows: DataFrame, shards: int) -> DataFrame:
    """Sends rows to their shards and runs them; one shard is always whole in one task."""
    placed = rows.withColumn(
        "shard", F.coalesce(F.col("shard"), F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("bigint"))
    )
    return placed.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(_run_shards, INDEX)


def _arrivals(digests: DataFrame) -> DataFrame:
    combined = digests.select("doc_id", "digest").mapInArrow(
        _combine, "digest binary, keep_id bigint, group_size bigint"
    )
    return combined.selectExpr(
        "CAST(NULL AS bigint) AS shard", f"{INSERTED} AS kind", "digest", "keep_id", "group_size",
        "CAST(NULL AS binary) AS filter",
    )


def build_index(digests: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """Index of ``(doc_id, digest)`` rows, and its number of shards."""
    shards = max(1, -(-digests.count() // shard_keys))
    return _apply(_arrivals(digests), shards), shards


def update_index(
    index: DataFrame, shards: int, inserted: DataFrame | None = None, deleted: DataFrame | None = None
) -> DataFrame:
    """The index after deleting the digests of ``deleted``, then adding ``inserted``."""
    rows = index.withColumn("kind", F.when(F.col("digest").isNull(), STATE).otherwise(STORED))
    if deleted is not None:
        gone = deleted.select("digest").distinct()
        rows = rows.unionByName(
            gone.selectExpr("CAST(NULL AS bigint) AS shard", f"{DELETED} AS kind", "digest",
                            "CAST(NULL AS bigint) AS keep_id", "CAST(NULL AS bigint) AS group_size",
                            "CAST(NULL AS binary) AS filter")
        )
    if inserted is not None:
        rows = rows.unionByName(_arrivals(inserted))
    return _apply(rows, shards)


def exact_duplicates(docs: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``(doc_id, digest, keep_id, group_size, kept)`` for every row of ``docs``."""
    digests = docs.select("doc_id", content_digest(F.col("text")).alias("digest"))
    digests = written(digests.withColumn("place", F.monotonically_increasing_id()), "digests")
    index, _ = build_index(digests.drop("place"), shard_keys)
    classes = index.where("digest IS NOT NULL").select("digest", "keep_id", "group_size")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "place"))
    firsts = digests.groupBy("digest").agg(first.alias("first")).select("digest", F.col("first.place").alias("first"))
    return digests.join(classes, "digest").join(firsts, "digest").select(
        "doc_id", "digest", "keep_id", "group_size", (F.col("place") == F.col("first")).alias("kept")
    )
