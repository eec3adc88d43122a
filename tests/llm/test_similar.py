"""Near duplicates of the pipeline's stage against brute force over shingle sets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from evidenza.llm import similar
from tests.llm.test_documents import lowered, words_of


def shingles(text):
    w = words_of(lowered(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def by_hand(rows, similarity=0.8):
    """Smallest doc_id of the group of each row, None without one."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if rows[i][0] is None or rows[j][0] is None:
                continue
            if a == b or len(a & b) / len(a | b) >= similarity:
                root[find(i)] = find(j)
    heads = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            heads[find(i)] = min(d, heads.get(find(i), d))
    known = {sets[i]: heads[find(i)] for i, (d, _) in enumerate(rows) if d is not None}
    return [known.get(s) for s in sets]


def edited(rng, words, changes):
    words = list(words)
    for at in rng.choice(len(words), changes, replace=False):
        words[at] = f"new{rng.integers(1 << 40)}"
    return words


def families():
    """Texts at many similarities around 0.8, chains of edits, and one crowded family."""
    rng = np.random.default_rng(3)
    rows = []
    for family in range(40):
        words = [f"w{rng.integers(1 << 30)}" for _ in range(int(rng.integers(40, 400)))]
        rows.append(" ".join(words))
        for _ in range(3):
            rows.append(" ".join(edited(rng, words, int(rng.integers(1, 1 + len(words) // 30)))))
        for _ in range(3):
            words = edited(rng, words, max(1, len(words) // 60))
            rows.append(" ".join(words).upper())
    base = [f"b{i}" for i in range(200)]
    rows += [" ".join(edited(rng, base, 1 + i % 5)) for i in range(80)]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("tile", [16, 1024])
def test_groups_equal_brute_force(spark, tile):
    rows = [*families(), (None, "b0 b1 b2"), (900, None), (901, " "), (902, "One two"), (903, "one  TWO"), (904, "two")]
    found = similar.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), tile_rows=tile).collect()
    expected = dict(zip((d for d, _ in rows), by_hand(rows), strict=True))
    assert {r.doc_id: r.component_id for r in found} == expected and len(found) == len(rows)
    assert len(set(expected.values())) < len(rows) - 100


@pytest.mark.parametrize("table", ["docs", "clashing", "nothing"])
def test_corner_cases(request, table):
    docs = request.getfixturevalue(table)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = similar.near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.component_id) for r in found), key=repr) == sorted(
        zip((d for d, _ in rows), by_hand(rows), strict=True), key=repr
    )


def test_the_stage_drops_similar_texts(spark):
    """Most pairs of similarity 0.8 to 0.97 differ in more than three of 64 SimHash bits."""
    rows = families()
    kept = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(by_hand(rows)))


@pytest.mark.parametrize("rounds", [(), similar.ROUNDS])
def test_rounds_change_no_group(spark, rounds):
    """Heads only save checks: without any, signatures find the same links."""
    rows = families()[:220]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = docs.select("doc_id", similar.text_udf(similar._marks_and_keys, "struct<fp: bigint, keys: array<bigint>>")("text").alias("s"))
    nodes = marks.groupBy("s.fp").agg(F.min("doc_id").alias("low"), F.first("s.keys").alias("keys"))
    links = {r.node: r.parent for r in similar.similar_groups(docs, nodes, rounds=rounds, tile_rows=16).collect()}
    lows = {r.fp: r.low for r in nodes.collect()}
    groups = {}
    for fp, low in lows.items():
        groups.setdefault(links.get(fp, fp), set()).add(low)
    expected = {}
    for (d, _), head in zip(rows, by_hand(rows), strict=True):
        expected.setdefault(head, set()).add(d)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_checks_are_linear_in_a_family(spark):
    """Four times the near copies give about four times the pairs whose sets are sent."""
    sent = []
    for n in (150, 600):
        rng = np.random.default_rng(8)
        base = [f"b{i}" for i in range(300)]
        docs = spark.createDataFrame([(i, " ".join(edited(rng, base, 1 + i % 4))) for i in range(n)], "doc_id bigint, text string")
        marks = docs.select("doc_id", similar.text_udf(similar._marks_and_keys, "struct<fp: bigint, keys: array<bigint>>")("text").alias("s"))
        nodes = marks.groupBy("s.fp").agg(F.min("doc_id").alias("low"), F.first("s.keys").alias("keys"))
        counts = []
        plain = similar.verified

        def counted(pairs, sets, similarity):
            counts.append(pairs.count())
            return plain(pairs, sets, similarity)

        similar.verified = counted
        try:
            assert similar.similar_groups(docs, nodes).select("parent").distinct().count() == 1
        finally:
            similar.verified = plain
        sent.append(sum(counts))
    assert sent[1] < 6 * sent[0] and sent[1] < 8 * 600


def kept_rows(spark, rows, schema="doc_id bigint, text string"):
    return sorted((tuple(r) for r in similar.one_of_each(spark.createDataFrame(rows, schema)).collect()), key=repr)


def test_texts_that_are_not_alike_stay_under_one_id(spark):
    a, b = "alpha beta gamma delta epsilon zeta", "one two three four five six seven"
    assert kept_rows(spark, [(1, a), (1, b), (2, b)]) == [(1, a), (1, b)]
    assert kept_rows(spark, [(1, a), (1, a), (2, a), (None, a), (None, a), (3, b), (2, b)]) == sorted(
        [(1, a), (2, b), (None, a), (None, a)], key=repr
    )
    wide = "doc_id bigint, text string, lang string"
    rows = [(1, a, "en"), (1, a, "de"), (1, a, "fr"), (4, None, None), (5, "", "x")]
    once = kept_rows(spark, rows, wide)
    assert once == kept_rows(spark, rows[::-1], wide) and [r[0] for r in once] == [1, 4]


@pytest.mark.parametrize("table", ["docs", "clashing", "nothing"])
def test_one_row_of_each_group(request, table):
    docs = request.getfixturevalue(table)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = similar.one_of_each(docs)
    assert found.columns == docs.columns
    kept = [r.doc_id for r in found.collect()]
    assert sorted(k for k in kept if k is not None) == sorted({h for (d, _), h in zip(rows, by_hand(rows), strict=True) if d is not None})
    assert kept.count(None) == sum(d is None for d, _ in rows)


def test_blocks_of_fingerprints_find_pairs_without_the_bands(spark):
    """The stage searches by SimHash: every pair within three bits, be it by no band, and checks it."""
    rows = [*families(), (900, None), (901, " "), (902, "One two")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kind = "struct<fp: bigint, print: bigint, keys: array<bigint>>"
    marks = docs.select("doc_id", similar.text_udf(similar._marks_prints_and_keys, kind)("text").alias("s"))
    nodes = marks.groupBy("s.fp", "s.print", "s.keys").agg(F.min("doc_id").alias("low"))
    found = {frozenset((r.member, r.head)) for r in similar.print_pairs(nodes).collect()}
    prints = {r.fp: r["print"] & (2**64 - 1) for r in nodes.collect() if len(r["keys"])}
    near = {frozenset((a, b)) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3}
    assert found and found <= near

    def groups(links):
        root = {x: x for x in prints}
        for _ in prints:
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert groups([tuple(x) for x in found]) == groups([tuple(x) for x in near])
    bare = nodes.withColumn("keys", F.expr("transform(keys, (k, i) -> k ^ fp ^ cast(i as bigint))"))
    links = similar.similar_groups(docs, bare, close=similar.print_pairs(nodes)).collect()
    sets = {r.fp: shingles(dict(rows)[r.low]) for r in nodes.collect()}
    sure = [tuple(x) for x in near if len(sets[min(x)] & sets[max(x)]) >= 0.8 * len(sets[min(x)] | sets[max(x)])]
    assert links and {r.node for r in links} <= {x for p in sure for x in p}
    assert all(groups(sure)[r.node] == groups(sure)[r.parent] for r in links)
