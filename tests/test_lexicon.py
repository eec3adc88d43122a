"""One scan of a text against the patterns that say the same."""

import random
import re

import pytest
from pyspark.sql import functions as F

from evidenza.functions.lexicon import WORD_BITS, Lexicon, Term, fold, terms
from evidenza.operators import classify as C

PIECES = [
    *(t.text for t in C.LEXICON.terms), "Energy", "ENERGY", "energy", "http://x.org/energy", "https://reduced.law/saving", "https://", "impact",
    "Impacts", "20%", "%", "5 % a", "a%b", "don't", "DON’T", "can't2", "knot", "not", " ", " ", " ", "\n", "\t", ".", ",", "é", "_", "-", "x", "1",
    "́", "‍", "ﬁ", "ß", "İ", "K", "ſ", "sectoral  targets", "net-zero", "Reduce emissions by", "gRid", "reducing.", " ",
]


def texts(seed, n=1500):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) + rng.choice(["", "", " "]) for _ in range(rng.randrange(9))) for _ in range(n)]


def test_scan_equals_patterns(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts(3), None, ""])], "i int, t string").repartition(3)
    mask = C.LEXICON.mask(F.col("t"))
    patterns = C.flag_terms(F.col("t"))
    rows = df.select("*", mask.alias("mask"), *[c.alias(f"p_{n}") for n, c in patterns.items()],
                     C.negated(F.col("t")).alias("p_negation"), C.extract_terms(F.col("t")).alias("p_terms"))
    names = [*patterns, "negation"]
    rows = rows.select("*", *[C.LEXICON.marked(F.col("mask"), n).alias(f"m_{n}") for n in names],
                       C._sorted_or_null(F.transform(C.LEXICON.listed(F.col("mask"), "sector"), C.capitalize)).alias("m_terms")).collect()
    for r in rows:
        for n in names:
            assert r[f"m_{n}"] == r[f"p_{n}"], (n, r.t)
        assert r.m_terms == r.p_terms, r.t
    assert all(sum(bool(r[f"m_{n}"]) for r in rows) > 20 for n in names)


def test_tags_are_the_same_either_way(spark):
    df = spark.createDataFrame([(t,) for t in [*texts(5, 300), None]], "answer_text string")
    scanned = C.tag_answers(df)
    matched = C.tag_answers(
        df, flag_patterns=C.FLAG_PATTERNS, term_pattern=C.SECTOR_PATTERN, negation_pattern=C.NEGATION_PATTERN, lexicon=None
    )
    columns = [*(F.col(f"flags.{n}").alias(n) for n in C.FLAG_PATTERNS), "negated", "year", "sectors", "quote"]
    assert sorted(map(repr, scanned.select(*columns).collect())) == sorted(map(repr, matched.select(*columns).collect()))
    with pytest.raises(ValueError, match="patterns"):
        C.tag_answers(df, lexicon=None)


def test_large_lexicons_and_long_texts(spark):
    words = [f"w{i}x" for i in range(3 * WORD_BITS + 5)]
    lexicon = Lexicon(tuple(terms("m", words, whole=True)) + (Term("Żółw", ("other",)),))
    rng = random.Random(1)
    rows = [(i, " ".join(rng.sample(words, rng.randrange(40))) + " ŻÓŁW" * (i % 2)) for i in range(30)]
    rows.append((99, "filler " * 100_000 + words[-1]))
    found = spark.createDataFrame(rows, "i int, t string").select("i", "t", lexicon.mask(F.col("t")).alias("m")).select(
        "i", "t", lexicon.listed(F.col("m"), "m").alias("l"), lexicon.marked(F.col("m"), "other").alias("o")
    )
    for r in found.collect():
        have = set(re.findall(r"w\d+x", r.t))
        assert r.l == [w for w in words if w in have] and r.o == ("ŻÓŁW" in r.t)
    with pytest.raises(ValueError, match="empty"):
        Lexicon((Term("", ("m",)),)).find("x")


def test_folding_keeps_length():
    for text in ("İstanbul", "STRASSE ß", "ſ K", "ﬁ", "ÀÉ", "Σς"):
        assert len(fold(text)) == len(text) and fold(text) == fold(text.swapcase() if len(text.swapcase()) == len(text) else text)
