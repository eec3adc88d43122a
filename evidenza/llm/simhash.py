"""SimHash near-duplicate detection by pigeonhole blocks.

A fingerprint has 64 bits, cut into five blocks.  Two fingerprints that differ
in at most three bits agree on at least two whole blocks, so every close pair
meets in one of the ten tables keyed by a pair of blocks (about 26 bits).
Equal fingerprints are one node from the start, which makes any number of exact
copies a single row.  A bucket larger than ``tile_rows`` is cut into tiles, and
every pair of tiles is one group of work of at most twice that size; inside a
group a forest of verified links is walked, so a group of g fingerprints emits
at most g - 1 links, never all its pairs.  Components are found by alternating
large-star and small-star steps, each written to the shared folder.

Defined cases: a null or empty text, or one without words, has fingerprint zero
and links like any other.  Rows that share a doc_id are one document: their
fingerprints are linked.  A row without doc_id gets a fingerprint and
the component of its fingerprint, null if no row with a doc_id has it; it links
no others.  Columns besides the two named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidenza.llm.batches import text_udf
from evidenza.llm.storage import written

SHINGLE_WORDS = 3
SEED = 42
MAX_DISTANCE = 3
#: (shift, width) of the blocks; one more than MAX_DISTANCE would do, a fifth makes keys longer.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
TILE_ROWS = 4096


def shingle_hashes(text: bytes, size: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of every run of ``size`` words; of the whole text if it has fewer."""
    words = text.split()  # bytes split at exactly 09-0D and 20
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: len(words) - size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)]


def majority_bits(hashes: Sequence[int], counts: Sequence[int]) -> pa.Array:
    """Signed 64-bit fingerprint per run of ``counts`` hashes: bits set in over half of them."""
    prints = np.zeros(len(counts), np.uint64)
    if len(hashes):
        counts = np.array(counts)
        full = np.flatnonzero(counts)
        bits = np.unpackbits(
            np.asarray(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        first = np.cumsum(counts[full]) - counts[full]
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        over = 2 * ones > counts[full][:, None]
        prints[full] = np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()
    return pa.array(prints.view(np.int64))


def simhash(texts: pa.Array) -> pa.Array:
    """The fingerprint of the shingles of each text, repeats included."""
    lowered = pc.cast(pc.ascii_lower(pc.fill_null(texts, "")), pa.binary())
    hashes, counts = [], []
    for text in lowered:
        found = shingle_hashes(text.as_py())
        hashes.extend(found)
        counts.append(len(found))
    return majority_bits(hashes, counts)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` for every row."""
    return docs.select("doc_id", text_udf(simhash, "bigint")(F.col("text")).alias("fp"))


def _mask(blocks) -> int:
    value = sum(((1 << width) - 1) << shift for shift, width in blocks)
    return value - (1 << 64) if value >> 63 else value


def forest(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Index pairs that join all members that are linked, directly or through others."""
    links, left = [], np.arange(len(prints))
    while left.size:
        queue, left = [left[0]], left[1:]
        while queue and left.size:
            at = queue.pop()
            near = np.bitwise_count(prints[left] ^ prints[at]) <= distance
            if near.any():
                found, left = left[near], left[~near]
                links.extend((int(at), int(x)) for x in found)
                queue.extend(found)
    return links


def _linker(distance: int):
    """Reads rows sorted by group and yields verified links of each group."""

    def link(key: np.ndarray, fp: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        change = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        starts = np.r_[0, change]
        sizes = np.diff(np.r_[starts, len(fp)])
        pairs = starts[sizes == 2]
        close = pairs[np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= distance]
        left, right = [node[close]], [node[close + 1]]
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            if found := forest(fp[start : start + size], distance):
                a, b = np.array(found).T + start
                left.append(node[a])
                right.append(node[b])
        a, b = np.concatenate(left), np.concatenate(right)
        other = a != b
        low, high = np.minimum(a, b)[other], np.maximum(a, b)[other]
        return pa.RecordBatch.from_arrays([pa.array(high), pa.array(low)], ["node", "parent"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)], axis=1)
            rows = rows if rest is None else np.concatenate([rest, rows])
            if not len(rows):
                continue
            last = np.flatnonzero((rows[:, :4] != rows[-1, :4]).any(axis=1))
            cut = last[-1] + 1 if last.size else 0  # the last group may go on
            rest = rows[cut:]
            if cut:
                yield link(rows[:cut, :4], rows[:cut, 4].view(np.uint64), rows[:cut, 5])
        if rest is not None and len(rest):
            yield link(rest[:, :4], rest[:, 4].view(np.uint64), rest[:, 5])

    return run


def close_links(prints: DataFrame, distance: int = MAX_DISTANCE, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Verified links ``(node, parent)``, parent < node, that join all close fingerprints.

    ``prints`` has one row per fingerprint: ``(fp, node)``.
    """
    if distance > len(BLOCKS) - 2:
        raise ValueError("pairs of blocks cannot guarantee this distance")
    masks = [_mask(pair) for pair in combinations(BLOCKS, 2)]
    keys = prints.select(
        "fp",
        "node",
        F.explode(
            F.array(*[
                F.struct(F.lit(i).cast("bigint").alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
                for i, m in enumerate(masks)
            ])
        ).alias("k"),
    ).select("fp", "node", "k.part", "k.bits")
    sizes = keys.groupBy("part", "bits").agg(F.count("*").alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / tile_rows)
    own = F.pmod(F.xxhash64("fp"), tiles)
    member = keys.join(sizes, ["part", "bits"]).withColumns({"tiles": tiles, "own": own})
    member = member.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
    member = member.where((F.col("tiles") == 1) | (F.col("own") != F.col("other"))).select(
        "part", "bits", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp", "node"
    )
    group = ["part", "bits", "a", "b"]
    return (
        member.repartition(*group)
        .sortWithinPartitions(*group)
        .mapInArrow(_linker(distance), "node bigint, parent bigint")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``(node, parent)``: the smallest node that each linked node reaches.

    Alternating large-star and small-star steps; the hub of a large component is
    summed up in the map tasks, and its join is a plain equi-join that Spark can split.
    """
    seen = None
    while True:
        links = written(links, "links")
        sign = links.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "parent"))).first()
        if tuple(sign) == seen or sign[0] == 0:
            return links
        seen = tuple(sign)
        both = links.select(F.col("node").alias("u"), F.col("parent").alias("v")).union(
            links.select(F.col("parent").alias("u"), F.col("node").alias("v"))
        )
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(low, "u").select(F.col("v").alias("node"), F.col("m").alias("parent")).distinct()
        )
        low = large.groupBy("node").agg(F.min("parent").alias("m"))
        small = large.join(low, "node").where("parent != m").select(F.col("parent").alias("node"), "m")
        links = small.union(low).distinct().toDF("node", "parent")


def repeat_links(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Links ``(node, parent)`` between the fingerprints of a doc_id that has several."""
    spread = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    several = rows.join(spread.where("low != high"), "doc_id", "left_semi")
    return several.join(known, "fp").where("node < doc_id").select(
        F.col("doc_id").alias("node"), F.col("node").alias("parent")
    ).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``."""
    rows = written(fingerprints(docs), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    known = nodes.where("node IS NOT NULL")
    roots = components(close_links(known).union(repeat_links(rows, known)))
    classes = nodes.join(roots, "node", "left").select("fp", F.coalesce("parent", "node").alias("component_id"))
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")

