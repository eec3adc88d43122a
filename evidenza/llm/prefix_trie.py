"""Trie of conversation prefixes, built as adaptive radix trees over turn ids.

A turn's id is the first 16 bytes of a SHA-256 over its role and text, so a conversation is
a byte string of fixed-width big-endian ids and a prefix of d turns ends at byte 16 d.
The string is cut into bands of ``BAND`` turns.  The state of a band is the digest of all
bands before it: conversations with equal states have equal prefixes, and each (band,
state) is one subtrie.  Equal (band, state, key) rows are summed up before anything else, so
a group of copies is one row.  Rows are range-partitioned and sorted by (band, state,
key); a task cuts its stream into chunks of bounded size and builds one tree per subtrie
and chunk.  Trees have nodes of 4, 16, 48 and 256 children that grow as they fill, and
one-child paths are compressed; only byte depths that are whole turns emit nodes.

A chunk's nodes are final unless they lie on the path of its first or of its last key, where
they may go on in the neighbouring chunk.  Such open nodes carry the sums of what is closed
below them; they are merged by id and roll up over their ancestors inside the band.

Sums over a subtree that goes on in later bands need no recursion: each later subtrie is
owned by its smallest conversation, every conversation brings the totals of the
subtries that it owns beyond a band as a weight of its key there, and the sum of the weights of
a node's members counts each subtrie below it once.

Defined cases: turns are ordered by number, null first, then by id; null role or text is
empty; a row without conv_id belongs to no conversation and is not read; rows that repeat are
turns of their own; a conversation without turns is a member of the root alone; an empty
table has no nodes.  Columns besides the four named ones are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evidenza.llm.storage import written
from evidenza.operators.spread import join_spread

ID_BYTES = 16
BAND = 64
#: A tree holds at most this many distinct keys and bytes of keys; more begin another chunk.
CHUNK_KEYS = 20_000
CHUNK_BYTES = 8 << 20
BLOCK = 5
MAX_BORROWED = 8
ROOT_STATE = bytes(ID_BYTES)

KEYS = "band int, state binary, key binary, sizes array<bigint>"
KEY_ROWS = f"conv_id bigint, {KEYS}, last boolean"
NODES = (
    "open boolean, band int, place int, id binary, parent binary, path array<binary>, conv_id bigint, parent_conv_id bigint, "
    "n_convs bigint, bytes bigint, more bigint, n_children bigint, n_leaves bigint, saved bigint"
)


# the tree


class Inner:
    """A node with a compressed path and children by byte, in one of four layouts.

    Up to 4 and up to 16 children are two short sorted lists; up to 48 are a table of 256
    slots into a list; more are a table of 256 children.
    """

    __slots__ = ("path", "row", "layout", "keys", "children", "size")

    def __init__(self, path: bytes, row: int | None = None):
        self.path, self.row = path, row
        self.layout, self.keys, self.children, self.size = 4, [], [], 0

    def get(self, byte: int) -> Inner | None:
        if self.layout <= 16:
            at = bisect_left(self.keys, byte)
            return self.children[at] if at < self.size and self.keys[at] == byte else None
        if self.layout == 48:
            slot = self.keys[byte]
            return self.children[slot] if slot < 48 else None
        return self.children[byte]

    def put(self, byte: int, child: Inner) -> None:
        if self.layout == 256:
            self.size += self.children[byte] is None
            self.children[byte] = child
        elif self.layout == 48:
            slot = self.keys[byte]
            if slot < 48:
                self.children[slot] = child
            elif self.size == 48:
                self._grow()
                self.put(byte, child)
            else:
                self.keys[byte] = self.size
                self.children.append(child)
                self.size += 1
        else:
            at = bisect_left(self.keys, byte)
            if at < self.size and self.keys[at] == byte:
                self.children[at] = child
            elif self.size == self.layout:
                self._grow()
                self.put(byte, child)
            else:
                self.keys.insert(at, byte)
                self.children.insert(at, child)
                self.size += 1

    def _grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            slots = bytearray(b"\xff" * 256)
            for slot, byte in enumerate(self.keys):
                slots[byte] = slot
            self.layout, self.keys = 48, slots
        else:
            table: list[Inner | None] = [None] * 256
            for byte, slot in enumerate(self.keys):
                if slot < 48:
                    table[byte] = self.children[slot]
            self.layout, self.keys, self.children = 256, None, table

    def __iter__(self) -> Iterator[tuple[int, Inner]]:
        """Children in byte order."""
        if self.layout <= 16:
            yield from zip(self.keys, self.children, strict=True)
        elif self.layout == 48:
            yield from ((b, self.children[slot]) for b, slot in enumerate(self.keys) if slot < 48)
        else:
            yield from ((b, c) for b, c in enumerate(self.children) if c is not None)


def insert(root: Inner, key: bytes, row: int) -> None:
    """Adds a key that is not in the tree yet.  The root's own path is empty."""
    node, at = root, 0
    while at < len(key):
        child = node.get(key[at])
        if child is None:
            node.put(key[at], Inner(key[at + 1 :], row))
            return
        path, start = child.path, at + 1
        shared = 0
        most = min(len(path), len(key) - start)
        if key[start : start + most] == path[:most]:
            shared = most
        else:
            while path[shared] == key[start + shared]:
                shared += 1
        if shared < len(path):
            upper = Inner(path[:shared])
            upper.put(path[shared], child)
            child.path = path[shared + 1 :]
            node.put(key[at], upper)
            child = upper
        node, at = child, start + shared
    node.row = row


class _Sums:
    """What is known of the nodes below a point: members, and the turn-aligned nodes next below."""

    __slots__ = ("n", "low", "more", "children", "leaves", "saved", "waiting")

    def __init__(self):
        self.n = self.more = self.children = self.leaves = self.saved = 0
        self.low = None
        self.waiting: list[list] = []  # closed rows whose parent is not known yet

    def add(self, other: _Sums) -> None:
        self.n += other.n
        self.more += other.more
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.low = other.low if self.low is None else self.low if other.low is None else min(self.low, other.low)
        self.waiting.extend(other.waiting)


def _prefix_id(state: bytes, prefix: bytes) -> bytes:
    return hashlib.sha256(state + prefix).digest()[:ID_BYTES] if prefix else state


def emit_nodes(band: int, state: bytes, rows: list[tuple], edges: list[bytes]) -> list[list]:
    """The nodes of one subtrie, as far as its chunk knows them.

    ``rows`` is ``(key, sizes, n, low, more, leaves, saved)`` with distinct keys; nodes that are
    prefixes of a key in ``edges`` are open, and so is the subtrie's root.
    """
    root = Inner(b"")
    for i, row in enumerate(rows):
        insert(root, row[0], i)
    out: list[list] = []

    def is_open(prefix: bytes) -> bool:
        return not prefix or any(e.startswith(prefix) for e in edges)

    def node(prefix: bytes, sizes: list[int], below: _Sums, own: tuple | None) -> _Sums:
        """The node of a turn-aligned prefix; ``own`` is the row that ends there."""
        if own is not None:
            _, _, n, low, more, leaves, saved = own
            mine = _Sums()
            mine.n, mine.low, mine.more, mine.leaves, mine.saved = n, low, more, leaves, saved
            below.add(mine)
        turns = len(prefix) // ID_BYTES
        opened = is_open(prefix)
        more = own[4] if own is not None else 0
        leaves, saved, size = below.leaves, below.saved, sizes[turns - 1] if turns else 0
        if not opened:
            leaves += below.children == 0 and not more
            saved += (below.n - 1) * size
        path = None
        if opened:
            path = [_prefix_id(state, prefix[: ID_BYTES * j]) for j in range(turns + 1)]
        row = [
            opened, band, turns, path[-1] if opened else _prefix_id(state, prefix),
            _prefix_id(state, prefix[:-ID_BYTES]) if turns else None, path, below.low, None, below.n, size, more,
            below.children, leaves, saved,
        ]
        out.append(row)
        for child in below.waiting:
            if not opened:
                child[7], child[4] = below.low, None
        up = _Sums()
        up.n, up.low = below.n, below.low
        if not opened:  # an open node meets its parent in the merge
            up.children, up.leaves, up.saved, up.waiting = 1, leaves, saved, [row]
        return up

    def some_sizes(tree: Inner) -> list[int]:
        while tree.row is None:
            tree = next(iter(tree))[1]
        return rows[tree.row][1]

    # post-order with an explicit stack: (tree, bytes before its path, its children yet to come, sums so far)
    stack = [(root, b"", iter(root), _Sums())]
    while stack:
        tree, before, children, sums = stack[-1]
        prefix = before + tree.path
        step = next(children, None)
        if step is not None:
            byte, child = step
            stack.append((child, prefix + bytes((byte,)), iter(child), _Sums()))
            continue
        stack.pop()
        own = rows[tree.row] if tree.row is not None else None
        # the branching byte that leads here belongs to this tree's edge
        first = len(before) - 1 if before else -1
        sizes = some_sizes(tree) if tree.row is not None or tree.size else []
        depth = len(prefix) - len(prefix) % ID_BYTES
        if tree.row is None or depth != len(prefix):
            own = None
        while depth > first and depth >= 0:
            sums = node(prefix[:depth], sizes, sums, own)
            own = None
            depth -= ID_BYTES
        if stack:
            stack[-1][3].add(sums)
    return out


# the stream


def _trees(chunk_keys: int, chunk_bytes: int):
    names = [x.split(" ")[0] for x in NODES.split(", ")]
    kinds = [
        pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.binary()), *[pa.int64()] * 8,
    ]

    def emit(chunk: list[tuple]) -> Iterator[pa.RecordBatch]:
        groups: list[tuple[tuple, list[tuple]]] = []
        for band, state, *row in chunk:
            if not groups or groups[-1][0] != (band, state):
                groups.append(((band, state), []))
            groups[-1][1].append(tuple(row))
        for i, ((band, state), rows) in enumerate(groups):
            edges = [rows[0][0]] * (i == 0) + [rows[-1][0]] * (i == len(groups) - 1)
            out = emit_nodes(band, state, rows, edges)
            for start in range(0, len(out), 5_000):
                columns = zip(*out[start : start + 5_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if chunk and (len(chunk) >= chunk_keys or size >= chunk_bytes):
                    yield from emit(chunk)
                    chunk, size = [], 0
                chunk.append(row)
                size += len(row[2])
        if chunk:
            yield from emit(chunk)

    return run


def _rolled_up(parts: DataFrame) -> DataFrame:
    """Open nodes, whole: their parts are merged by id and summed over their ancestors."""
    key = ["band", "place", "id"]
    merged = parts.groupBy(*key).agg(
        F.first("parent").alias("parent"), F.first("path").alias("path"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.max("bytes").alias("bytes"), F.sum("more").alias("more"),
        F.sum("n_children").alias("closed"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"),
    )
    merged = written(merged, "open")
    below = merged.where("place > 0").groupBy(
        F.col("band").alias("b"), (F.col("place") - 1).alias("pl"), F.col("parent").alias("pa")
    ).agg(F.count("*").alias("opened"))
    here = (F.col("band") == F.col("b")) & (F.col("place") == F.col("pl")) & (F.col("id") == F.col("pa"))
    counted = merged.join(below, here, "left").withColumn("n_children", F.col("closed") + F.coalesce("opened", F.lit(0)))
    leaf = ((F.col("n_children") == 0) & (F.col("more") == 0)).cast("bigint")
    own = counted.select(
        *key, "parent", "path", "conv_id", "n_convs", "bytes", "more", "n_children",
        (F.col("leaves") + leaf).alias("leaves"), (F.col("saved") + (F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    own = written(own, "rolled")
    sums = own.select("band", F.posexplode("path").alias("place", "id"), "leaves", "saved").groupBy(*key).agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved")
    )
    return own.drop("path", "leaves", "saved").join(sums, key)


def subtries(keys: DataFrame, chunk_keys: int = CHUNK_KEYS, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Closed and open nodes of ``(band, state, key, sizes, n, low, more, leaves, saved)``, one row per key."""
    order = ["band", "state", "key"]
    ranged = written(keys, "keys").repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.select(*order, "sizes", "n", "low", "more", "leaves", "saved")
    nodes = written(ranged.mapInArrow(_trees(chunk_keys, chunk_bytes), NODES), "nodes")
    return nodes.where(~F.col("open")).drop("open", "path"), written(_rolled_up(nodes.where("open")), "edges")


# the conversations


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, id, bytes)``: the turns of each conversation, numbered from 0.

    Rows are range-partitioned, numbered inside each part, and moved on by what earlier parts
    hold, so a conversation of any length is spread over many tasks.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat_ws("\n", F.octet_length(role).cast("string"), role, text).cast("binary"), 256))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.substring(digest, 1, ID_BYTES).alias("id"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "id"]
    rows = written(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "turns")
    sizes = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = sizes.select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    local = W.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "id")
    placed = rows.withColumn("local", F.row_number().over(local) - 1).join(base, ["conv_id", "part"])
    return placed.select("conv_id", (F.col("base") + F.col("local")).cast("bigint").alias("pos"), "id", "bytes")


def borrowed(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its block."""
    return F.crc32(conv_id.cast("string").cast("binary")) % (MAX_BORROWED + 1)


def rebuilt(turns: DataFrame) -> DataFrame:
    """``(conv_id, pos, id, bytes)`` of the conversations that begin with turns of another.

    Conversation c takes the first h turns of c - c % ``BLOCK`` and goes on with its own after
    its first h.
    """
    first = F.col("conv_id") - F.col("conv_id") % BLOCK
    convs = turns.select("conv_id").distinct().select("conv_id", first.alias("first"), borrowed(F.col("conv_id")).alias("h"))
    heads = turns.where(F.col("pos") < MAX_BORROWED).select(F.col("conv_id").alias("first"), "pos", "id", "bytes")
    taken = convs.join(heads, "first").where("pos < h").select("conv_id", "pos", "id", "bytes")
    # no more than MAX_BORROWED rows of a conversation are looked at
    lengths = heads.groupBy("first").agg(F.count("*").alias("n"))
    shift = convs.join(lengths, "first", "left").select(
        "conv_id", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("got")
    )
    own = turns.join(shift, "conv_id").where("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("got")).alias("pos"), "id", "bytes")
    return taken.unionByName(own)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gives each band the digest of all bands before it; a conversation's bands come in order."""
    held: tuple | None = None  # the row that waits for the next one
    names = ["conv_id", "band", "state", "key", "sizes", "last"]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.bool_()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        rows = []
        for conv, band, key, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            state = ROOT_STATE
            if held is not None:
                goes_on = held[0] == conv
                rows.append((*held, not goes_on))
                state = _prefix_id(held[2], held[3]) if goes_on else ROOT_STATE
            held = (conv, band, state, key, sizes)
        yield out(rows)
    if held is not None:
        yield out([(*held, True)])


def key_rows(turns: DataFrame, convs: DataFrame, band: int = BAND) -> DataFrame:
    """A row per conversation and band: its state, its key, and whether it is the last one.

    ``convs`` names all conversations; one without turns has an empty key.  One task chains
    the bands of a conversation, a row per ``band`` turns, holding two of them.
    """
    cells = turns.select(
        "conv_id", F.floor(F.col("pos") / band).cast("int").alias("band"), F.struct("pos", "id", "bytes").alias("t")
    ).groupBy("conv_id", "band").agg(F.array_sort(F.collect_list("t")).alias("t"))
    cells = cells.select(
        "conv_id", "band", F.unhex(F.array_join(F.transform("t", lambda t: F.hex(t["id"])), "")).alias("key"),
        F.transform("t", lambda t: t["bytes"]).alias("sizes"),
    )
    bare = convs.join(cells.where("band = 0").select("conv_id"), "conv_id", "left_anti").select(
        "conv_id", F.lit(0).alias("band"), F.lit(b"").alias("key"), F.array().cast("array<bigint>").alias("sizes")
    )
    rows = cells.unionByName(bare).repartition("conv_id").sortWithinPartitions("conv_id", "band")
    return rows.mapInArrow(_chain, KEY_ROWS)


def _summed(rows: DataFrame) -> DataFrame:
    """One row per distinct key of a subtrie, with the weights of its conversations."""
    return rows.groupBy("band", "state", "key").agg(
        F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv_id").alias("low"),
        F.sum(F.when(F.col("last"), 0).otherwise(1)).alias("more"), F.sum("x_leaves").alias("leaves"),
        F.sum("x_saved").alias("saved"),
    )


def _suffix_sums(rows: DataFrame, owned: DataFrame) -> DataFrame:
    """For each band of a conversation the totals of the subtries that it owns in later bands."""
    bands = rows.select("conv_id", "band").join(owned, "conv_id", "left_semi")
    met = bands.join(owned, ["conv_id", "band"], "left")
    later = W.partitionBy("conv_id").orderBy(F.col("band").desc()).rowsBetween(W.unboundedPreceding, -1)
    return met.select(
        "conv_id", "band", F.coalesce(F.sum("leaves").over(later), F.lit(0)).alias("x_leaves"),
        F.coalesce(F.sum("saved").over(later), F.lit(0)).alias("x_saved"),
    )


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the comma-joined ids of each group, which come sorted; holds one group's state."""
    at, state = None, None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["id", "ends"]
        )

    for batch in batches:
        rows = []
        for key, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != at:
                if at is not None:
                    rows.append((at, state.hexdigest()))
                at, state = key, hashlib.sha256(str(conv).encode())
            else:
                state.update(f",{conv}".encode())
        yield out(rows)
    if at is not None:
        yield out([(at, state.hexdigest())])


def _end_id(state: pa.Array, key: pa.Array) -> pa.Array:
    return pa.array([_prefix_id(s.as_py(), k.as_py()) for s, k in zip(state, key, strict=True)], pa.binary())


_end_id.__annotations__ = {"state": pa.Array, "key": pa.Array, "return": pa.Array}


def trie(
    turns: DataFrame, convs: DataFrame | None = None, band: int = BAND, chunk_keys: int = CHUNK_KEYS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """A row per distinct prefix of ``(conv_id, pos, id, bytes)``.

    ``convs`` names all conversations, by default those with turns.  The digest of the ids of
    the conversations that end at a node is sequential by nature: a group of copies
    passes through one task for it, sorted, in constant memory, with nothing but its ids.
    """
    turns = written(turns, "rebuilt")
    convs = turns.select("conv_id").distinct() if convs is None else convs
    rows = written(key_rows(turns, convs, band), "bands")
    nothing = {"x_leaves": F.lit(0).cast("bigint"), "x_saved": F.lit(0).cast("bigint")}

    # totals of the subtries beyond the first band, each credited to the smallest of its conversations
    _, later = subtries(_summed(rows.where("band > 0").withColumns(nothing)), chunk_keys, chunk_bytes)
    roots = later.where("place = 0").select("band", F.col("id").alias("state"), "n_children", "n_leaves", "saved", "conv_id")
    owned = roots.select("conv_id", "band", F.col("n_leaves").alias("leaves"), "saved")
    weights = _suffix_sums(rows, owned)
    weighted = rows.join(weights, ["conv_id", "band"], "left").na.fill(0, ["x_leaves", "x_saved"])

    closed, edges = subtries(_summed(weighted), chunk_keys, chunk_bytes)
    fan = roots.select(F.col("state").alias("id"), F.col("n_children").alias("later"))
    columns = ["band", "place", "id", "parent", "conv_id", "parent_conv_id", "n_convs", "more", "n_children", "n_leaves", "saved"]
    whole = closed.select(*columns).unionByName(
        edges.where("band = 0 OR place > 0").withColumn("parent_conv_id", F.lit(None).cast("bigint")).select(*columns)
    )
    going_on = whole.where("more > 0").join(fan, "id", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("later", F.lit(0))
    ).select(*columns)
    whole = written(whole.where("more = 0").unionByName(going_on), "whole")

    # a node may be the parent of a third of all others
    known = whole.where("parent IS NULL")
    heads = written(edges.where("band = 0 OR place > 0").select("id", "conv_id").unionByName(
        whole.where("more > 0").select("id", "conv_id")
    ).distinct().toDF("parent", "head"), "heads")
    met = join_spread(whole.where("parent IS NOT NULL"), heads, ["parent"], ["id"]).withColumn("parent_conv_id", F.col("head"))
    done = known.select(*columns).unionByName(met.select(*columns))

    last = rows.where("last").select(F.arrow_udf(_end_id, "binary")("state", "key").alias("id"), "conv_id")
    ends = last.repartition("id").sortWithinPartitions("id", "conv_id").mapInArrow(_ends, "id binary, ends string")
    return done.join(ends, "id", "left").select(
        "conv_id", (F.col("band") * band + F.col("place")).cast("bigint").alias("depth"), "parent_conv_id", "n_convs",
        "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, **sizes: int) -> DataFrame:
    """The trie of the rebuilt conversations of a table ``(conv_id, turn, role, text)``."""
    turns = written(turn_rows(conversations), "placed")
    return trie(rebuilt(turns), turns.select("conv_id").distinct(), **sizes)
