"""Near duplicates by SimHash blocks and the similarity of word shingles: the pipeline's stage.

Two texts are near duplicates if the sets of their five-word shingles have a
Jaccard similarity of ``SIMILARITY`` or more; groups are what such links join.
Equal sets are one node from the start.  Candidates come from two searches, and every
link is checked on the shingle sets themselves, so no link is wrong:

* SimHash with pigeonhole blocks, as in ``simhash``: all nodes whose 64-bit fingerprints
  over their shingles differ in at most ``MAX_DISTANCE`` bits.
* The nodes that share the minima of ``ROWS`` hash functions in one of ``BANDS`` bands.
  A pair of similarity s shares no band with probability (1 - s^4)^24: 3 in a million at
  0.8, less above.  Blocks cannot search that far: at 0.8 about ten of 64 bits differ.

Only narrow rows pass through blocks and buckets:

* What the blocks link is joined first.  A fingerprint is one node there; other nodes that
  have the same one are checked against the least of them.
* In each round of ``ROUNDS`` every bucket that still holds several groups names one head,
  from its largest group, and the members outside that group are checked against it.  A
  family of near copies is joined in a round or two, with a check per member and head.
* What then remains unlinked is compared within its bucket by signatures, one byte of the
  minimum of each of ``SIGNS`` hash functions: pairs of different groups that agree in
  ``MIN_AGREE`` or more are checked.  (A pair of similarity 0.8 agrees in fewer with
  probability 1 in a million; one of 0.69 agrees in as many with probability 1 in 6.)
  A bucket larger than ``TILE_ROWS`` is cut into tiles that meet pairwise.

A check streams the sets of members past the set of their head, so a task holds one set and
one batch.  Nothing is capped: a bucket of many members that stay unlinked costs its square,
but in signatures, not in sets.

Defined cases: a text of fewer words is one shingle; texts without words equal each
other; rows that share a doc_id are compared like any others; a row without doc_id
links none, and has the group of its shingles, null if no row with a doc_id has it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evidenza.llm.batches import text_udf
from evidenza.llm.simhash import close_links, components, majority_bits, shingle_hashes
from evidenza.llm.storage import written
from evidenza.llm.urls import bloom_filter, might_contain, slots

SHINGLE_WORDS = 5
SIMILARITY = 0.8
ROWS = 4
BANDS = 24
#: Bands of the rounds in which buckets name heads.
ROUNDS = (4, 24)
SIGNS = 512
MIN_AGREE = 366
TILE_ROWS = 1024
#: Parts that the members of one head are checked in.
SALTS = 64

_MIX = np.random.default_rng(42).integers(0, 1 << 63, (2, BANDS * ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
_SIGN_MIX = np.random.default_rng(43).integers(0, 1 << 63, (2, SIGNS), np.uint64) * np.uint64(2) + np.uint64(1)
LINKS = "node bigint, parent bigint"


def _sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    lowered = pc.cast(pc.ascii_lower(pc.fill_null(texts, "")), pa.binary())
    return [np.unique(np.array(shingle_hashes(t.as_py(), SHINGLE_WORDS), np.uint64)) for t in lowered]


def _digests(sets: list[np.ndarray]) -> pa.Array:
    return pa.array(np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64))


def _minima(sets: list[np.ndarray], mix: np.ndarray = _MIX) -> Iterator[np.ndarray]:
    """For each hash function the least value over each set; sets are not empty."""
    flat = np.concatenate(sets)
    lengths = np.array([len(s) for s in sets])
    starts = np.cumsum(lengths) - lengths
    for turn, factor in mix.T:
        yield np.minimum.reduceat((flat ^ turn) * factor, starts)


def _keys(sets: list[np.ndarray]) -> pa.Array:
    """A key for each band of each set; none for an empty set."""
    full = [s for s in sets if len(s)]
    sizes = np.array([BANDS if len(s) else 0 for s in sets])
    keys = np.zeros((len(full), BANDS), np.uint64)
    if full:
        least = np.stack(list(_minima(full)), axis=1)
        keys[:] = np.arange(1, BANDS + 1)
        for row in range(ROWS):
            keys = (keys ^ least[:, row::ROWS]) * np.uint64(0x9E3779B97F4A7C15)
            keys ^= keys >> np.uint64(29)
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel().view(np.int64)))


def _marks_and_keys(texts: pa.Array) -> pa.Array:
    sets = _sets(texts)
    return pa.StructArray.from_arrays([_digests(sets), _keys(sets)], ["fp", "keys"])


def _marks_prints_and_keys(texts: pa.Array) -> pa.Array:
    """Digest, SimHash of the set, and keys."""
    sets = _sets(texts)
    prints = majority_bits(np.concatenate(sets), [len(s) for s in sets]) if sets else pa.array([], pa.int64())
    return pa.StructArray.from_arrays([_digests(sets), prints, _keys(sets)], ["fp", "print", "keys"])


def _marks_and_sets(texts: pa.Array) -> pa.Array:
    """Digest, shingles and signature; members of buckets have at least one shingle."""
    sets = _sets(texts)
    full = [s for s in sets if len(s)]
    # the low byte: the high ones of a minimum are all but zero
    signatures = iter(np.stack([m.astype(np.uint8) for m in _minima(full, _SIGN_MIX)], axis=1) if full else [])
    columns = [
        _digests(sets), pa.array([s.tobytes() for s in sets], pa.binary()),
        pa.array([next(signatures).tobytes() if len(s) else b"" for s in sets], pa.binary()),
    ]
    return pa.StructArray.from_arrays(columns, ["fp", "shingles", "signature"])


def _links(nodes: list[int], parents: list[int]) -> pa.RecordBatch:
    a, b = np.array(nodes, np.int64), np.array(parents, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["node", "parent"])


def _values(column: pa.Array) -> Iterator[np.ndarray]:
    """The 64-bit values of each row of a binary column, without copies."""
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        yield np.frombuffer(data[a:b].tobytes(), np.uint64)


def _verifier(similarity: float):
    """Streams rows sorted by (head, salt), the head itself first in each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, None
        for batch in batches:
            nodes, parents = [], []
            names = (batch.column(n).to_pylist() for n in ("head", "salt", "member"))
            for head, salt, member, found in zip(*names, _values(batch.column("shingles")), strict=True):
                if member is None:
                    at, own = (head, salt), found
                elif at == (head, salt):
                    place = np.minimum(np.searchsorted(own, found), len(own) - 1)
                    shared = int((own[place] == found).sum())
                    if shared >= similarity * (len(own) + len(found) - shared):
                        nodes.append(member)
                        parents.append(head)
            yield _links(nodes, parents)

    return run


def verified(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links ``(node, parent)`` of the pairs ``(member, head)`` whose sets are similar."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("member"), F.lit(SALTS)))
    own = sets.select(F.col("fp").alias("member"), "shingles")
    members = salted.join(own, "member").select("head", "salt", "member", "shingles")
    heads = salted.select("head", "salt").distinct().join(own.withColumnRenamed("member", "head"), "head").select(
        "head", "salt", F.lit(None).cast("bigint").alias("member"), "shingles"
    )
    rows = members.unionByName(heads).repartition("head", "salt")
    rows = rows.sortWithinPartitions("head", "salt", F.col("member").asc_nulls_first())
    return rows.mapInArrow(_verifier(similarity), LINKS)


def _grouped(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``(key, fp, root)`` of the buckets that hold several groups."""
    rows = members.join(roots.toDF("fp", "parent"), "fp", "left").select(
        "key", "band", "fp", F.coalesce("parent", "fp").alias("root")
    )
    several = rows.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least != most")
    return rows.join(several.select("key"), "key", "left_semi")


def head_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """``(member, head)``: one head per bucket, from its largest group, and who is not in that group."""
    order = F.struct(F.xxhash64("fp", F.lit(turn)), "fp")
    groups = rows.groupBy("key", "root").agg(F.count("*").alias("n"), F.min(order).alias("pick"))
    heads = groups.groupBy("key").agg(F.max(F.struct("n", "pick", "root")).alias("h")).select(
        "key", F.col("h.pick.fp").alias("head"), F.col("h.root").alias("head_root")
    )
    return rows.join(heads, "key").where("root != head_root").select(F.col("fp").alias("member"), "head").distinct()


def _tiled(rows: DataFrame, tile_rows: int) -> DataFrame:
    """``(key, a, b, own, fp, root)``: rows of each bucket once per pair of tiles that they meet in."""
    sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / tile_rows).alias("tiles"))
    member = rows.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("tiles")))
    member = member.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
    return member.select("key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "fp", "root")


def _agreeing(min_agree: int, similarity: float):
    """Pairs of a tile pair that may be similar: of different groups, in like sizes and signatures.

    A pair of several buckets is named by the one of its first band, and a pair of one tile by that tile's own cell.
    """

    def pairs(at: list[int], rows: list[tuple]) -> pa.RecordBatch:
        own, fps, roots, sizes = (np.array([r[i] for r in rows], np.int64) for i in range(4))
        signatures = np.frombuffer(b"".join(r[4] for r in rows), np.uint8).reshape(len(rows), -1)
        keys = np.array([r[5] for r in rows], np.int64)
        earlier = keys[:, : int(np.flatnonzero(keys[0] == at[0])[0])]
        nodes, parents = [], []
        for i in range(len(rows) - 1):
            rest = slice(i + 1, None)
            near = (roots[rest] != roots[i]) & (
                np.minimum(sizes[rest], sizes[i]) >= similarity * np.maximum(sizes[rest], sizes[i])
            )
            if at[1] != at[2]:
                near &= own[rest] != own[i]
            near &= ~(earlier[rest] == earlier[i]).any(axis=1)
            near &= (signatures[rest] == signatures[i]).sum(axis=1) >= min_agree
            found = fps[rest][near].tolist()
            nodes.extend(found)
            parents.extend([int(fps[i])] * len(found))
        return _links(nodes, parents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *key, own, fp, root, size, signature, keys in zip(*columns, strict=True):
                if key != at:
                    if rows:
                        yield pairs(at, rows)
                    at, rows = key, []
                rows.append((own, fp, root, size, signature, keys))
        if rows:
            yield pairs(at, rows)

    return run


def rest_pairs(
    rows: DataFrame, sets: DataFrame, keys: DataFrame, similarity: float = SIMILARITY, tile_rows: int = TILE_ROWS, min_agree: int = MIN_AGREE
) -> DataFrame:
    """``(member, head)``: the pairs of different groups in a bucket whose signatures agree.

    ``keys`` has ``(fp, keys)``, the buckets of each node.
    """
    signs = sets.select("fp", (F.octet_length("shingles") / 8).cast("bigint").alias("size"), "signature").join(keys, "fp")
    group = ["key", "a", "b"]
    sent = _tiled(rows, tile_rows).join(signs, "fp").select(*group, "own", "fp", "root", "size", "signature", "keys")
    found = sent.repartition(*group).sortWithinPartitions(*group).mapInArrow(_agreeing(min_agree, similarity), LINKS)
    return found.distinct().toDF("member", "head")


def print_pairs(nodes: DataFrame) -> DataFrame:
    """``(member, head)``: nodes of ``(fp, print, keys)`` whose fingerprints are close, as blocks link them.

    A node without shingles is like no other, whatever its fingerprint.
    """
    rows = nodes.where(F.size("keys") > 0).select("fp", "print")
    heads = written(rows.groupBy("print").agg(F.min("fp").alias("node")), "prints")
    equal = rows.join(heads, "print").where("fp != node").select("fp", "node")
    close = close_links(heads.select(F.col("print").alias("fp"), "node"))
    return equal.union(close).toDF("member", "head")


def _member_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(fp, shingles, signature)`` of the nodes in ``wanted``, ``(fp, low)``; a Bloom filter keeps other texts out."""
    table = bloom_filter(wanted.select(F.col("low").alias("key")))
    probe = might_contain(docs.sparkSession.sparkContext.broadcast(table))
    found = docs.select("doc_id", "text").where(probe(*slots(F.xxhash64("doc_id"), len(table))))
    read = text_udf(_marks_and_sets, "struct<fp: bigint, shingles: binary, signature: binary>")
    found = found.select("doc_id", read(F.col("text")).alias("s")).select(
        F.col("doc_id").alias("low"), "s.fp", "s.shingles", "s.signature"
    )
    return found.join(wanted, ["low", "fp"], "left_semi").dropDuplicates(["fp"]).select("fp", "shingles", "signature")


def similar_groups(
    docs: DataFrame, nodes: DataFrame, similarity: float = SIMILARITY, tile_rows: int = TILE_ROWS,
    rounds: tuple[int, ...] = ROUNDS, close: DataFrame | None = None,
) -> DataFrame:
    """``(node, parent)``: the smallest node that each linked node of ``(fp, low, keys)`` reaches.

    ``close`` has pairs ``(member, head)`` that another search found; they are checked first.
    """
    keyed = nodes.select("fp", "low", F.posexplode("keys").alias("band", "key"))
    shared = keyed.groupBy("key").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least != most")
    members = written(keyed.join(shared.select("key"), "key", "left_semi"), "members")
    wanted = members.select("fp", "low")
    if close is not None:
        ends = close.select(F.explode(F.array("member", "head")).alias("fp")).distinct()
        wanted = wanted.union(nodes.select("fp", "low").join(ends, "fp", "left_semi"))
    sets = written(_member_sets(docs, written(wanted.distinct(), "wanted")), "sets")
    members = members.select("key", "band", "fp")
    roots = written(docs.sparkSession.createDataFrame([], LINKS), "links")
    if close is not None and not close.isEmpty():
        roots = components(verified(close, sets, similarity))
    for turn, bands in enumerate(rounds):
        rows = _grouped(members.where(F.col("band") < bands), roots)
        pairs = written(head_pairs(rows, turn), "pairs")
        if pairs.isEmpty():
            continue
        roots = components(roots.union(verified(pairs, sets, similarity)))
    pairs = written(rest_pairs(_grouped(members, roots), sets, nodes.select("fp", "keys"), similarity, tile_rows), "pairs")
    return roots if pairs.isEmpty() else components(roots.union(verified(pairs, sets, similarity)))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(doc_id, text_key, fp, root, component_id)`` for every row: a hash of its text, the digest of
    its shingles, the node that names its group, and the smallest doc_id of the group."""
    read = text_udf(_marks_prints_and_keys, "struct<fp: bigint, print: bigint, keys: array<bigint>>")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), read(F.col("text")).alias("s"))
    rows = written(rows.select("doc_id", "text_key", "s.fp", "s.print", "s.keys"), "shingles")
    nodes = rows.where("doc_id IS NOT NULL").groupBy("fp").agg(
        F.min("doc_id").alias("low"), F.first("print").alias("print"), F.first("keys").alias("keys")
    )
    nodes = written(nodes, "nodes")
    roots = similar_groups(docs, nodes, similarity, tile_rows, close=written(print_pairs(nodes), "close"))
    classes = nodes.select("fp", "low").join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("parent", "fp").alias("root")
    )
    heads = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = written(classes.join(heads, "root").select("fp", "root", "component_id"), "classes")
    return rows.select("doc_id", "text_key", "fp").join(classes, "fp", "left").select(
        "doc_id", "text_key", "fp", "root", "component_id"
    )


def one_of_each(docs: DataFrame, **options: float) -> DataFrame:
    """One row of each group of near duplicates: the first by doc_id, then by the hash of its text,
    then by the hash of all its columns.  Rows without doc_id stay."""
    groups = written(near_duplicates(docs, **options).where("doc_id IS NOT NULL"), "groups")
    first = W.partitionBy("root").orderBy("doc_id", "text_key")
    winners = groups.withColumn("place", F.row_number().over(first)).where("place = 1")
    winners = written(winners.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")), "winners")
    rows = docs.where("doc_id IS NOT NULL").select(F.struct("*").alias("row"), F.xxhash64("text").alias("__key"))
    met = rows.join(winners, (F.col("row.doc_id") == winners["__id"]) & (rows["__key"] == winners["__key"]), "left_semi")
    # only rows that repeat a document and its text are still to be told apart
    again = groups.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1").toDF("__id", "__again", "__n")
    same = (F.col("row.doc_id") == F.col("__id")) & (F.col("__key") == F.col("__again"))
    order = W.partitionBy("row.doc_id", "__key").orderBy(F.xxhash64("row"))
    one = met.join(again, same, "left_semi").withColumn("__place", F.row_number().over(order)).where("__place = 1")
    kept = met.join(again, same, "left_anti").select("row").union(one.select("row"))
    return kept.select("row.*").unionByName(docs.where("doc_id IS NULL"))
