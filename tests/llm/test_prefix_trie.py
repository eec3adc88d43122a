"""The trie of conversation prefixes against brute force over lists of turns."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from evidenza.llm import prefix_trie

TURNS = "conv_id bigint, turn bigint, role string, text string"


def turn_id(role, text):
    raw = f"{len(role.encode())}\n{role}\n{text}".encode()
    return hashlib.sha256(raw).digest()[:16]


def rebuilt_by_hand(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs[conv].append(((turn is not None, turn or 0, turn_id(role, text)), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in convs.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        block = abs(c) // 5 * 5 * (1 if c >= 0 else -1)
        out[c] = own.get(block, [])[:h] + turns[h:]
    return out


def by_hand(convs):
    members, ends, below = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                below[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    saved, leaves = defaultdict(int), defaultdict(int)
    for node, own in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(own) - 1) * (len(node[-1][1].encode()) if node else 0)
            leaves[node[:d]] += not below[node]
    return sorted(
        (min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(below[node]), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, own in members.items()
    )


def in_order(found):
    return sorted(tuple(r) for r in found.collect())


def many(seed, convs=120, longest=14, start=-12):
    rng = random.Random(seed)
    rows = []
    for c in range(start, start + convs):
        if rng.random() < 0.15:
            continue
        for t in range(rng.randrange(longest)):
            turn = None if rng.random() < 0.05 else t
            text = rng.choice(["", None, "yes", "no", "é 漢", "a longer answer " * 3])
            rows.append((c, turn, rng.choice(["user", "assistant", None, ""]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{}, {"band": 2, "chunk_keys": 3}, {"band": 3, "chunk_bytes": 64}, {"chunk_keys": 1}])
def test_equals_brute_force(spark, sizes):
    rows = many(1)
    found = prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS).repartition(3), **sizes)
    assert in_order(found) == by_hand(rebuilt_by_hand(rows))


@pytest.mark.parametrize("seed", range(2, 6))
def test_shared_beginnings_over_many_bands(spark, seed):
    """Few distinct turns, so that prefixes are shared far down, and copies of whole conversations."""
    rng = random.Random(seed)
    convs = {}
    for c in range(60):
        base = list(convs[rng.randrange(c)])[: rng.randrange(20)] if c and rng.random() < 0.7 else []
        convs[c] = [*base, *(("user", rng.choice("ab")) for _ in range(rng.randrange(12)))]
    for c in range(60, 75):
        convs[c] = convs[7]
    turns = [(c, i, turn_id(*t), len(t[1])) for c, ts in convs.items() for i, t in enumerate(ts)]
    frame = spark.createDataFrame(turns, "conv_id bigint, pos bigint, id binary, bytes bigint")
    names = spark.createDataFrame([(c,) for c in convs], "conv_id bigint")
    found = prefix_trie.trie(frame, names, band=3, chunk_keys=4)
    assert in_order(found) == by_hand(convs)


def test_layouts_grow_and_paths_split():
    rng = random.Random(4)
    keys = {bytes(rng.choices(range(256), k=2)) + b"tail" for _ in range(3000)} | {bytes([i]) for i in range(256)} | {b""}
    keys |= {k[:3] for k in list(keys)[:500]}
    root = prefix_trie.Inner(b"")
    order = sorted(keys)
    for i in rng.sample(range(len(order)), len(order)):
        prefix_trie.insert(root, order[i], i)
    found, layouts = [], set()

    def walk(node, before):
        layouts.add(node.layout)
        if node.row is not None:
            found.append((before + node.path, node.row))
        for byte, child in node:
            assert node.get(byte) is child
            walk(child, before + node.path + bytes([byte]))

    walk(root, b"")
    assert found == [(k, i) for i, k in enumerate(order)]
    assert root.layout == 256
    small = prefix_trie.Inner(b"")
    grown = []
    for n, byte in enumerate(rng.sample(range(256), 256)):
        assert small.get(byte) is None
        small.put(byte, prefix_trie.Inner(b"", byte))
        grown.append(small.layout)
        assert small.size == n + 1 and [b for b, _ in small] == sorted(b for b, _ in small)
    assert [grown[i] for i in (3, 4, 15, 16, 47, 48, 255)] == [4, 16, 16, 48, 48, 256, 256]


def test_corner_cases(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 0, "assistant", None),
        (None, 0, "user", "nobody's"), (7, 3, "user", "x" * 200_000), (7, 3, None, "x" * 200_000),
    ]
    frame = spark.createDataFrame(rows, TURNS)
    for c in ("id", "pos", "key", "state", "band", "part", "first", "bytes", "n"):
        from pyspark.sql import functions as F

        frame = frame.withColumn(c, F.lit("other"))
    assert in_order(prefix_trie.conversation_trie(frame)) == by_hand(rebuilt_by_hand(rows))
    assert prefix_trie.conversation_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_a_conversation_without_turns_is_a_member_of_the_root(spark):
    turnless = next(c for c in range(1, 50) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    found = prefix_trie.conversation_trie(spark.createDataFrame([(turnless, 0, "user", "x")], TURNS))
    digest = hashlib.sha256(str(turnless).encode()).hexdigest()
    assert in_order(found) == [(turnless, 0, None, 1, 0, 1, 0, digest)]
