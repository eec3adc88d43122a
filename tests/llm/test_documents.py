"""Operators on documents against brute force, with the defined corner cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from evidenza.llm import crf, decontaminate, dedup, lines, mixing, simhash, stupid_backoff

BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = re.compile(r"[\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# near duplicates


def fingerprint(text):
    w = words_of(lowered(text))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(prints, distance=3):
    """Brute force: node -> smallest node, links between all close pairs."""
    parent = {n: n for n in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = list(prints)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if any((x ^ y).bit_count() <= distance for x in prints[a] for y in prints[b]):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {n: find(n) for n in names}


@pytest.mark.parametrize("table", ["docs", "clashing"])
def test_simhash_equals_brute_force(request, table):
    docs = request.getfixturevalue(table)
    prints = defaultdict(set)
    for doc_id, text in rows_of(docs):
        if doc_id is not None:
            prints[doc_id].add(fingerprint(text))
    roots = smallest_reachable(prints)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    by_print = {fp: roots[d] for d, fps in prints.items() for fp in fps}
    for r in found:
        fp = r.fp & (2**64 - 1)
        assert r.component_id == (by_print.get(fp) if r.doc_id is None else roots[r.doc_id])
        if r.doc_id is not None:
            assert fp in prints[r.doc_id]


def test_links_of_a_crowded_bucket_join_all(spark):
    """Many fingerprints around one center, in tiles far smaller than the bucket."""
    rng = np.random.default_rng(5)
    values = {0}
    while len(values) < 300:
        value = int(rng.choice(list(values)))
        for bit in rng.choice(64, int(rng.integers(1, 5)), replace=False):
            value ^= 1 << int(bit)
        values.add(value)
    values = sorted(values)
    signed = [v - 2**64 if v >> 63 else v for v in values]
    prints = spark.createDataFrame(list(zip(signed, range(len(values)), strict=True)), "fp bigint, node bigint")
    roots = smallest_reachable({i: {v} for i, v in enumerate(values)})
    for tile in (16, 4096):
        found = {r.node: r.parent for r in simhash.components(simhash.close_links(prints, tile_rows=tile)).collect()}
        assert {n: found.get(n, n) for n in roots} == roots
    links = simhash.close_links(prints).collect()
    assert all((values[r.node] ^ values[r.parent]).bit_count() <= 3 for r in links)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(1001, 1000)], "node bigint, parent bigint")
    found = {r.node: r.parent for r in simhash.components(links).collect()}
    assert found == {**{i: 0 for i in range(1, 201)}, 1001: 1000}


def test_a_document_with_several_texts_links_them(spark):
    """Rows that share a doc_id are one document: their fingerprints reach each other."""
    rows = [(5, "one two three four"), (5, "other words in this row"), (3, "one two three four"),
            (9, "other words in this row"), (4, "nothing like the rest of them")]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(3, 3), (4, 4), (5, 3), (5, 3), (9, 3)]


def test_operators_on_nothing(nothing, spark):
    assert simhash.near_duplicates(nothing).count() == 0
    assert dedup.exact_duplicates(nothing).count() == 0
    assert lines.keep_bitmaps(nothing).count() == 0
    assert lines.apply_bitmaps(nothing, lines.keep_bitmaps(nothing)).count() == 0
    assert mixing.mixed_words(nothing).count() == 0
    assert stupid_backoff.backoff_scores(nothing).count() == 0
    assert crf.fit(nothing) is None
    assert decontaminate.contamination(nothing, spark.createDataFrame([], "item_id bigint, text string")).count() == 0


def test_numerals_are_no_letters():
    model = crf.train([("en", ["the", "house", "and", "garden"] * 5), ("fr", ["le", "chat", "dans", "maison"] * 5)])
    found = crf.label_texts(model, ["\u00bd \u00b2 \u2167 12_", "\u00bd house", None, ""])
    assert [x["lang"] for x in found] == ["und", "en", "und", "und"]


# exact duplicates


@pytest.mark.parametrize("table", ["docs", "clashing"])
def test_exact_duplicates_equal_brute_force(request, table):
    docs = request.getfixturevalue(table)
    groups = defaultdict(list)
    for doc_id, text in rows_of(docs):
        groups[hashlib.sha256(BLANK_RUN.sub(" ", text or "").encode()).digest()].append(doc_id)
    found = dedup.exact_duplicates(docs, shard_keys=7).collect()
    assert len(found) == docs.count()
    for r in found:
        ids = groups[bytes(r.digest)]
        smallest = min((x for x in ids if x is not None), default=None)
        assert (r.keep_id, r.group_size) == (smallest, len(ids)) and (r.doc_id == smallest or not r.kept)
    assert Counter(bytes(r.digest) for r in found if r.kept) == Counter(groups.keys())


def test_one_of_repeated_rows_stays(spark):
    rows = [(1, "a b"), (1, "a  b"), (1, "a\tb"), (2, "a b"), (None, "a b"), (None, "c"), (None, "c"), (3, None), (3, "")]
    found = dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r.keep_id), r.group_size, r.kept) for r in found) == sorted(
        [("1", 5, True), *[("1", 5, False)] * 4, ("None", 2, True), ("None", 2, False), ("3", 2, True), ("3", 2, False)]
    )


def test_cuckoo_filter_grows_and_deletes():
    shard = dedup.Shard(buckets=4)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(2000)]
    for i, key in enumerate(keys):
        shard.insert(key, i, 1)
    assert shard.resized > 0 and all(k in shard.filter for k in keys)
    shard.insert(keys[5], 2, 3)
    assert shard._find(keys[5]) == [keys[5], 2, 4]
    assert all(shard.delete(k) for k in keys[:1000]) and not shard.delete(keys[0])
    assert [e[0] for e in sorted(shard.entries(), key=lambda e: e[1]) if e[0] in keys[1000:]] == keys[1000:]
    assert sum(k in shard.filter for k in keys[:1000]) < 50


def test_false_positive_is_a_key_of_its_own():
    shard = dedup.Shard(buckets=4)
    a = b"\x01\x02" + b"\0" * 30
    b = b"\x01\x02" + b"\0" * 29 + b"\x01"
    shard.insert(a, 1, 1)
    assert b in shard.filter  # same fingerprint and bucket
    shard.insert(b, 2, 1)
    assert sorted(e[1] for e in shard.entries()) == [1, 2]
    assert shard.delete(a) and b in shard.filter and shard._find(b)[1] == 2


def test_index_takes_and_gives_up_digests(spark):
    def digests(ids):
        rows = [(i, bytearray(hashlib.sha256(str(i % 50).encode()).digest())) for i in ids]
        return spark.createDataFrame(rows, "doc_id bigint, digest binary")

    index, shards = dedup.build_index(digests(range(60)), shard_keys=20)
    index = dedup.update_index(index, shards, inserted=digests(range(100, 110)), deleted=digests(range(20, 30)))
    found = {r.keep_id: r.group_size for r in index.where("digest IS NOT NULL").collect()}
    assert found == {**{i: 3 for i in range(10)}, **{i: 1 for i in range(10, 20)}, **{i: 1 for i in range(30, 50)}}


# lines


def kept_by_hand(docs):
    rows = rows_of(docs)
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            key = lowered(line.strip(BLANKS))
            if len(key) >= 40:
                holders[key].add(doc_id)
    top = {k: max((x for x in v if x is not None), default=None) for k, v in holders.items() if len(v) >= 5}
    return Counter(
        (d, "\n".join(x for x in (t or "").split("\n") if (k := lowered(x.strip(BLANKS))) not in top or top[k] == d))
        for d, t in rows
    )


@pytest.mark.parametrize("table", ["docs", "clashing"])
def test_line_bitmaps_equal_brute_force(request, table):
    docs = request.getfixturevalue(table)
    found = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs)).select("row.doc_id", F.coalesce("text", F.lit(""))).collect()
    assert Counter(tuple(r) for r in found) == kept_by_hand(docs)


def test_common_line_over_many_partitions(spark):
    line = "this line is found in every single document of the table"
    rows = [(i, f"{line}\n{i}\n{line}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        marks = lines.keep_bitmaps(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r.doc_id for r in marks) == list(range(2999))
    assert {zlib.decompress(r.bitmap) for r in marks} == {bytes([0b01000000])}


# mixing


def test_targets_share_the_excess(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 0), ("d", 5)], "source string, source_size bigint")
    found = {r.source: r.target for r in mixing.targets(sizes).collect()}
    # by code point: a 5, b 2, c 1, d 5, null 2; a, d and null stop at their limits
    assert found["a"] == 30 and found["d"] == 15 and found[None] == 0
    assert found["b"] == pytest.approx(1970 * 2 / 3) and found["c"] == pytest.approx(1970 / 3)


def test_permutation_is_one_to_one(spark):
    for n in (1, 2, 7, 1000):
        found = spark.range(n).select(mixing.shuffled(F.col("id"), F.lit(n).cast("bigint"), F.lit("key")).alias("x"))
        assert sorted(r.x for r in found.collect()) == list(range(n))


@pytest.mark.parametrize("n", [1, 2, 9, 640])
def test_permutation_is_undone(spark, n):
    size = F.lit(n).cast("bigint")
    there = mixing.shuffled(F.col("id"), size, F.lit("key"))
    found = spark.range(n).select("id", mixing.shuffled(there, size, F.lit("key"), inverse=True).alias("x")).collect()
    assert all(r.x == r.id for r in found)


def goals_by_hand(sizes):
    """Target of each source: weights 5, 2, 1 in code point order, null last, filled up to three times the size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    goal, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        rate = left / sum(weights[s] for s in free)
        over = {s for s in free if 3 * sizes[s] < weights[s] * rate}
        for s in over:
            goal[s], left = 3.0 * sizes[s], left - 3 * sizes[s]
        if not over:
            goal |= {s: weights[s] * rate for s in free}
        free = free - over if over else set()
    return goal


@pytest.mark.parametrize("table", ["docs", "clashing", "tiny"])
def test_mix_meets_targets(request, spark, table):
    if table == "tiny":
        rows = [(i, "w " * n, s, None) for i, (n, s) in enumerate(
            [(40, "a"), (70, "b"), (335, "c"), (64, "d"), (65, "e"), (1, "f"), (0, "g"), (128, None), (900, "h"), (30, "b"), (5000, "h")]
        )]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    else:
        docs = request.getfixturevalue(table)
    found = mixing.mixed_words(docs).collect()
    assert sorted((r.doc_id or -1, r.size) for r in found) == sorted((d or -1, len(words_of(t))) for d, t in rows_of(docs))
    assert all(0 <= r.taken <= 3 * r.size for r in found)
    sizes = Counter()
    for r in found:
        sizes[r.source] += r.size
    goals = goals_by_hand(sizes)
    for source in sizes:
        own = [r for r in found if r.source == source]
        assert {r.source_size for r in own} == {sizes[source]}
        assert own[0].target == pytest.approx(goals[source])
        assert abs(sum(r.taken for r in own) - goals[source]) <= 0.5 + 1e-6
    again = mixing.mixed_words(docs.repartition(3)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))


def test_mix_equals_brute_force(docs, monkeypatch, spark):
    """Slots, blocks and cuts by hand: counts per shard number a source's slots, a permutation names their blocks."""
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 16)
    monkeypatch.setattr(mixing, "GROUP_SHARDS", 3)
    rows, goals, slots = mixing.mix(docs)
    slots = slots.collect()
    plan = {r.source: r for r in mixing.quotas(goals).collect()}
    shards = Counter((r.shard) for r in slots)
    assert sorted(shards) == list(range(len(shards))) and set(list(shards.values())[:-1]) <= {16, len(slots) % 16}
    laid = defaultdict(list)
    for r in rows.collect():
        laid[r.source] += [(r.start + i, r.doc_id, r.size) for i in range(r.size)]
    taken = Counter()
    for source, p in plan.items():
        own = [r for r in slots if r.source == source]
        assert len(own) == p.slots and sum(r.cut is not None for r in own) == (p.cut is not None)
        uses = Counter(r.block for r in own)
        full = p.slots // p.blocks if p.blocks else 0
        assert all(uses[b] in (full, full + 1) for b in range(p.blocks))
        words = {at: (d, size) for at, d, size in laid[source]}
        assert sorted(words) == list(range(p.source_size))
        for r in own:
            stop = min((r.block + 1) * 64, p.source_size) if r.cut is None else r.block * 64 + r.cut
            for at in range(r.block * 64, stop):
                taken[source, *words[at]] += 1
    found = Counter()
    for r in mixing.mixed_words(docs).collect():
        found[r.source, r.doc_id, r.size] += r.taken
    assert +found == +taken


def test_mix_pieces_add_up(docs):
    taken = Counter()
    for r in mixing.mixed_pieces(docs).collect():
        taken[r.doc_id] += r.words
    sums = Counter()
    for r in mixing.mixed_words(docs).collect():
        sums[r.doc_id] += r.taken
    assert +taken == +sums


# language model


@pytest.mark.parametrize("order, held", [(1, 2_000_000), (2, 2_000_000), (2, 50), (3, 700)])
def test_backoff_scores_equal_brute_force(docs, order, held):
    rows = [(d, words_of(lowered(t))) for d, t in rows_of(docs)]
    counts = Counter(tuple(w[i : i + k]) for _, w in rows for k in range(1, order + 1) for i in range(len(w) - k + 1))
    total = sum(len(w) for _, w in rows)

    def log_s(gram):
        if len(gram) == 1:
            return np.log(counts[gram] / total)
        if counts[gram] >= 2:
            return np.log(counts[gram] / counts[gram[:-1]])
        return np.log(0.4) + log_s(gram[1:])

    want, size = Counter(), Counter()
    for d, w in rows:
        want[d] += 0
        size[d] += len(w)
        for i in range(len(w)):
            gram = tuple(w[max(0, i - order + 1) : i + 1])
            want[d] += log_s(gram) + (order - len(gram)) * np.log(0.4)
    found = stupid_backoff.backoff_scores(docs, order=order, block_words=held, part_words=held).collect()
    assert {r.doc_id: r.n_words for r in found} == dict(size)
    for r in found:
        assert r.log_score == pytest.approx(want[r.doc_id], rel=1e-9, abs=1e-9)
        assert (r.mean_log_score is None) == (r.n_words == 0)


# language


def test_forward_backward_equals_enumeration():
    from itertools import product

    rng = np.random.default_rng(1)
    sizes, n = np.array([5, 0, 3]), 3
    logits, move = rng.normal(size=(8, n)), rng.normal(size=(n, n))
    found, pairs = crf.posteriors(logits, sizes, move, with_pairs=True)
    want, joint, at = [], np.zeros((n, n)), 0
    for size in (5, 3):
        p, q, z = np.zeros((size, n)), np.zeros((n, n)), 0
        for path in product(range(n), repeat=size):
            w = np.exp(sum(logits[at + i, k] for i, k in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
            z += w
            for i, k in enumerate(path):
                p[i, k] += w
            for a, b in zip(path, path[1:]):
                q[a, b] += w
        want.append(p / z)
        joint += q / z
        at += size
    assert np.allclose(found, np.concatenate(want), atol=1e-4) and np.allclose(pairs, joint, atol=1e-3)


def test_long_sequences_do_not_depend_on_their_neighbours():
    rng = np.random.default_rng(2)
    logits, move = rng.normal(size=(1000, 4)) * 3, rng.normal(size=(4, 4))
    whole, _ = crf.posteriors(logits, np.array([700, 300]), move)
    parts = [crf.posteriors(x, np.array([len(x)]), move)[0] for x in (logits[:700], logits[700:])]
    assert np.allclose(whole, np.concatenate(parts), atol=1e-4)


def test_language_of_documents_and_words(spark, docs):
    model = crf.fit(docs)
    assert model.labels == ["en", "fr"]
    text = "the quick brown fox near the river le chat noir dort sur la table"
    rows = spark.createDataFrame([(1, text), (2, None), (3, "12 !"), (4, "")], "doc_id bigint, text string")
    found = {r.doc_id: r.found for r in rows.select("doc_id", crf.language_column(F.col("text"), spark, model).alias("found")).collect()}
    assert [(s.first_word, s.n_words, s.lang) for s in found[1].spans] == [(0, 7, "en"), (7, 7, "fr")]
    assert all(found[i] == ("und", 0.0, 0.0, []) for i in (2, 3, 4))
    right = docs.where("lang IS NOT NULL AND text rlike '[a-z]{3}' AND doc_id < 20").select(
        (crf.language_column(F.col("text"), spark, model)["lang"] == F.col("lang")).alias("ok")
    )
    assert all(r.ok for r in right.collect())
    assert rows.select(crf.language_column(F.col("text"), spark, None)["lang"].alias("x")).distinct().collect()[0].x == "und"


# decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def hits_by_hand(text, items):
    words = WORD.findall(lowered(text))
    hit, names = set(), set()
    for item, item_text in items:
        w = WORD.findall(lowered(item_text))
        n = min(10, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                names.add("null" if item is None else str(item))
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("max_words", [10**6, 12])
def test_windows_equal_brute_force(spark, clashing, max_words):
    """In one automaton, and in several that scan one after another."""
    items = [
        (1, "Quick brown FOX jumps over the lazy dog near the river bank while"), (2, "lazy dog"), (10, "le chat noir"),
        (3, None), (4, "?!"), (1, "in the tall, green trees"), (None, "souris mange"), (5, "never seen in any of them at all"),
    ]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contamination(clashing, benchmark, max_words=max_words).collect()
    assert len(found) == clashing.count()
    for r in found:
        assert (r.found.n_words, r.found.n_hit, r.found["items"]) == hits_by_hand(r.row.text, items)
        inside = [x for s in r.found.spans for x in WORD.findall(lowered(r.row.text[s.start : s.stop]))]
        assert len(inside) == r.found.n_hit


def test_codes_of_many_words():
    group = [(f"word{i} end", [str(i)]) for i in range(60_000)]
    scanner = decontaminate.Scanner(group)
    found = scanner.scan("x Word59999 END word3 y word3 end")
    assert (found["n_words"], list(found["places"]), found["items"]) == (7, [1, 2, 5, 6], ["3", "59999"])
