"""Source divergence and quality rules against brute force, with the defined corner cases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evidenza.llm import divergence, quality

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = "text string, lang string, source string"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# source divergence


def audit_by_hand(rows, min_docs, k):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source, found = lang or "", source or "", TERM.findall(lowered(text))
        groups.add((lang, source))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        others = {s for g, s in groups if g == lang}
        v = len(kept)

        def shares(of, lang=lang, kept=kept, v=v):
            total = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 5) // (total + 5 * v) for t in kept}

        p = shares(counts[lang, source])
        q = shares(sum((counts[lang, s] for s in others), Counter()))
        pairs = []
        for s in others - {source}:
            r = shares(counts[lang, s])
            pairs.append((s, sum(abs(p[t] - r[t]) for t in kept)))
        over = [(t, p[t] - q[t]) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", over, k)):
            ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(ordered)]
    return sorted(out)


def prose(seed, docs=160, sources=9):
    rng = random.Random(seed)
    pool = [f"w{chr(97 + i % 26)}{'éß漢'[i % 3]}{chr(97 + i // 26)}" for i in range(140)]
    rows = []
    for _ in range(docs):
        source = rng.choice([None, "", "hot", "hot", "hot", *(f"s{i}" for i in range(sources))])
        lean = sum(map(ord, source or "")) % 50
        words = [pool[min(139, int(rng.expovariate(1 / 30)) + rng.choice([0, lean]))] for _ in range(rng.randrange(60))]
        rows.append((" ".join(w.upper() if rng.random() < 0.2 else w for w in words), rng.choice(["en", "de", None]), source))
    return rows


@pytest.mark.parametrize(
    "sizes", [{}, {"part_terms": 7, "block_terms": 5, "tile_sources": 2}, {"part_terms": 20, "block_terms": 64, "tile_sources": 3}]
)
def test_audit_equals_brute_force(spark, sizes):
    rows = prose(1)
    docs = spark.createDataFrame(rows, COLUMNS).repartition(4)
    found = divergence.audit(docs, min_docs=4, k=6, **sizes)
    expected = audit_by_hand(rows, 4, 6)
    assert sorted(tuple(r) for r in found.collect()) == expected
    assert {r[2] for r in expected} == {"pair", "term"} and max(r[5] for r in expected if r[2] == "term") == 6


def test_audit_corner_cases(spark):
    """No terms, no kept terms, a lone source, ties, repeated rows, long texts, clashing columns."""
    rows = [(None, None, None), ("1 2 3", "en", "a"), ("", "en", "b"), ("x" * 300_000, "fr", "a"), ("only one", "fr", "b")]
    rows += [("tie tie same same", "de", "a")] * 5 + [("same tie", "de", "b")] * 3 + [("1", "de", None), ("alone alone", "it", "z")] * 4
    docs = spark.createDataFrame(rows, COLUMNS)
    for c in ("term", "n", "docs", "g", "l", "v", "idx", "p", "value", "rank", "part"):
        docs = docs.withColumn(c, F.lit("other"))
    found = sorted(tuple(r) for r in divergence.audit(docs, min_docs=4, k=2).collect())
    assert found == audit_by_hand(rows, 4, 2)
    assert ("fr", "a", "pair", "b", 0, 1) in found and not any(r[0] == "it" and r[2] == "pair" for r in found)
    assert divergence.audit(spark.createDataFrame([], COLUMNS)).count() == 0


def test_skyband_keeps_what_fewer_dominate():
    rng = np.random.default_rng(2)
    for n, k in ((1, 1), (40, 3), (900, 5)):
        g, l = rng.integers(0, 12, n), rng.integers(0, 40, n)
        names = [f"{x:x}é" for x in rng.permutation(n)]
        above = [
            sum(g[j] >= g[i] and l[j] <= l[i] and names[j].encode() < names[i].encode() for j in range(n)) for i in range(n)
        ]
        found = divergence.skyband(g, l, names, k, block=64).tolist()
        assert sorted(found) == [i for i in range(n) if above[i] < k]


def test_long_texts_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE_BYTES", 16)
    text = "Alpha beta-gamma DÉLTA epsilon " * 9 + "end" * 30
    assert [w.decode() for part in divergence.terms(text.encode()) for w in part] == TERM.findall(lowered(text))


# quality rules


def measures_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    covered, seen = set(), defaultdict(list)
    for i in range(len(words) - 4):
        seen[tuple(words[i : i + 5])].append(i)
    for at in seen.values():
        if len(at) > 1:
            covered.update(i + j for i in at for j in range(5))
    lines = [x for x in (text or "").split("\n") if x.strip(quality.BLANKS)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)
    )


def test_measures_equal_brute_force():
    rng = random.Random(6)
    for _ in range(300):
        texts = [
            rng.choice([None, "", " \n\x0b"]) if rng.random() < 0.2
            else "".join(rng.choice(rng.choice(["ab é|.\n \t\x0bz  ", "a b\n"])) for _ in range(rng.randrange(90)))
            for _ in range(rng.randrange(7))
        ]
        found = quality.judge_texts(pa.array(texts, pa.string())).to_pylist()
        assert [tuple(r[m] for m in quality.MEASURES[:5]) for r in found] == [measures_by_hand(t) for t in texts]


GOOD = "This line is a whole sentence that says a thing or two about the world."


@pytest.mark.parametrize("line, failed", [
    (GOOD, False), ("He said \"so.\"", False), ("Short heading", True), ("一二三。", False), ("", False), (" \t", False),
    ("a line of eight words or more without a stop", False), ("Home | About | News | Contact us. Or call today.", True),
    ("Buy!! now!! cheap.", True), ("Stop! Go!", False), ("# $ % and *** of some longer line here.", True),
    ("Accept Cookies to go on reading this page.", True), ("All Rights Reserved.", True),
    ("This long remark on the click here habit of old pages goes on for so many words that it reads as prose, not as a button, "
     "and so it stays in the text as it should, all of it.", False),
])
def test_line_rules(line, failed):
    found = quality.judge_texts(pa.array([line])).to_pylist()[0]
    assert found["n_failed_lines"] == failed
    assert found["text"] == ("" if failed else line)


def test_documents_that_lose_too_much_are_rejected(spark):
    menu = "Home | About | News | Contact"
    prose = [
        "The river rose by two feet overnight.", "Farmers moved their sheep to the upper fields before dawn.",
        "By noon the bridge was closed, and a ferry took the school bus across.", "Nobody was hurt."
    ]
    rows = [
        (1, "\n".join(prose)), (2, "\n".join([menu, *prose])), (3, "\n".join([menu, "Log in", "Terms of use", "Read more", "Our news » Sport » Results » Cup", *prose[:1]])), (4, "\n".join([GOOD] * 3)),
        (5, "Too short."), (6, None), (7, ""), (2, "\n".join([menu, *prose])), (None, "\n".join(prose)), (8, "word " * 50_000),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("found", F.lit("x")).withColumn("kept", F.lit(3))
    found = quality.judged(docs).collect()
    assert [(r.row.doc_id, r.base_failed, r.kept) for r in found] == [
        (1, False, True), (2, False, True), (3, False, False), (4, True, False), (5, True, False), (6, True, False),
        (7, True, False), (2, False, True), (None, False, True), (8, True, False),
    ]
    kept = quality.cleaned(docs)
    assert kept.columns == docs.columns and sorted(r.text for r in kept.collect()) == sorted(["\n".join(prose)] * 4)
    assert quality.cleaned(docs.limit(0)).count() == 0
