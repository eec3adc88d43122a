"""WordPiece tokens against a public implementation and brute force; windows; whole texts encoded."""

import random
from itertools import zip_longest

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

from evidenza.functions.encoders import HashingEncoder, encode_rows
from evidenza.functions.wordpiece import UNKNOWN, TokenWindows, WordPiece, plain
from evidenza.operators import tokens as T

PIECES = [UNKNOWN, "un", "##aff", "##able", "##a", "##b", "a", "b", "ab", "##ab", "é", "e", "##e", "##t", "!", "$", "·", "中", "x", "##x", "the", "##he", "t", "1", "##1"]


def public(pieces):
    found = Tokenizer(models.WordPiece({p: i for i, p in enumerate(pieces)}, unk_token=UNKNOWN, max_input_chars_per_word=100))
    found.normalizer = normalizers.BertNormalizer(lowercase=True)
    found.pre_tokenizer = pre_tokenizers.BertPreTokenizer()
    return found


def greedy(word, pieces):
    """The longest piece first, by trying all of them."""
    found, rest = [], word
    while rest:
        fits = [p for p in pieces if (p[2:] if found and p.startswith("##") else p if not found and not p.startswith("##") else "\0") == rest[: len(p) - 2 * bool(found)]]
        if not fits:
            return (UNKNOWN,)
        found.append(max(fits, key=len))
        rest = rest[len(found[-1]) - 2 * (len(found) > 1) :]
    return tuple(found)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abxeét THÉ!$·中1\n\t\u00a0\u0301\u2009"), max_size=40))
def test_tokens_equal_a_public_implementation(text):
    assert WordPiece(PIECES).tokens(text) == public(PIECES).encode(text, add_special_tokens=False).tokens


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=4)), st.lists(st.text("ab", min_size=1, max_size=4)), st.text("ab", min_size=1, max_size=12))
def test_matches_equal_brute_force(first, later, word):
    pieces = first + ["##" + p for p in later]
    assert WordPiece(pieces).match(word) == greedy(word, pieces)


def test_corner_cases():
    model = WordPiece(PIECES)
    assert model.tokens("") == model.tokens(" \n") == []
    assert model.tokens("unaffable Q") == ["un", "##aff", "##able", UNKNOWN]
    assert model.tokens("a" * 100) == ["a", *["##a"] * 99] and model.tokens("a" * 101) == [UNKNOWN]
    assert WordPiece([]).tokens("ab ba") == [UNKNOWN, UNKNOWN]
    assert plain("É\u0007") == "e" and model.tokens("\u0007") == []
    small = WordPiece(PIECES)
    small.cache_limit = 2
    assert small.tokens("a b ab x a b") == ["a", "b", "ab", "x", "a", "b"]


def test_windows_hold_every_word_once_and_as_many_as_fit():
    model, rng = WordPiece(PIECES), random.Random(3)
    for _ in range(100):
        text = " ".join("".join(rng.choices("abx", k=rng.randint(1, 6))) for _ in range(rng.randint(0, 40)))
        windows = model.windows(text, 5)
        assert [t for a, b, _, _ in windows for t in model.tokens(text[a:b])] == model.tokens(text)
        for (a, b, words, n), after in zip_longest(windows, windows[1:]):
            assert len(model.tokens(text[a:b])) == n and len(text[a:b].split()) == words
            assert n <= 5 or words == 1
            if after:
                assert n + len(model.tokens(text[after[0] :].split()[0])) > 5


class Counting(HashingEncoder):
    longest = 0

    def encode_batch(self, texts):
        Counting.longest = max([Counting.longest, *(len(WordPiece(PIECES).tokens(t)) for t in texts)])
        if any("xx" in t for t in texts):
            raise ValueError("marked")
        return super().encode_batch(texts)


def test_whole_texts_are_encoded_and_pooled_by_tokens():
    Counting.longest = 0
    encoder = TokenWindows(Counting(16, normalize=False), WordPiece(PIECES), 4)
    text = "a b ab the " * 50 + "un"
    [vector] = encoder.encode_batch([text])
    windows = WordPiece(PIECES).windows(text, 4)
    parts = HashingEncoder(16, normalize=False).encode_batch([text[a:b] for a, b, _, _ in windows])
    weights = np.array([w[3] for w in windows], float)
    assert np.allclose(vector, (parts * weights[:, None]).sum(axis=0) / weights.sum())
    assert Counting.longest == 4 and len(windows) > 40
    rows = encode_rows(encoder, ["a b", None, "", "b xx a", "the"])
    assert [r is None for r in rows] == [False, True, False, True, False]


def test_columns(spark):
    texts = ["unaffable the ab", None, "", "Q", "a b a b a b a"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(2)
    pieces = T.vocabulary_pieces(spark.createDataFrame([(p,) for p in [*PIECES, *PIECES, "", None]], "piece string"))
    assert pieces == sorted(set(PIECES))
    model = WordPiece(PIECES)
    found = {r.id: r.tokens for r in df.select("id", T.token_column(df.text, pieces).alias("tokens")).collect()}
    assert found == {i: None if t is None else model.tokens(t) for i, t in enumerate(texts)}
    rows = {(r.id, r.window_no): tuple(r)[2:] for r in T.window_rows(df, ["id"], pieces, max_tokens=3).collect()}
    assert rows == {(i, k): w for i, t in enumerate(texts) if t for k, w in enumerate(model.windows(t, 3))}
    vectors = df.select("id", T.encode_by_tokens(df.text, pieces, max_tokens=3).alias("v")).collect()
    assert {r.id for r in vectors if r.v is None} == {1}
    empty = df.where("id < 0")
    assert T.window_rows(empty, ["id"], pieces).count() == 0
    with pytest.raises(ValueError):
        T.vocabulary_pieces(spark.createDataFrame([("a",), ("b",)], "piece string"), limit=1)


def test_windows_are_found_once_and_long_words_are_not_kept(spark):
    """One Python pass, whose memory holds no word that is over the limit."""
    df = spark.createDataFrame([(1, None), (2, ""), (3, "the cat " * 5), (4, " \n")], "id int, text string")
    rows = T.window_rows(df, ["id"], PIECES, max_tokens=4)
    assert rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    tokenizer = WordPiece(PIECES)
    expected = [(3, i, *w) for i, w in enumerate(tokenizer.windows("the cat " * 5, 4))]
    assert sorted(tuple(r) for r in rows.collect()) == expected
    long = "x" * 100_000
    assert tokenizer.tokens(long) == [UNKNOWN] and long not in tokenizer._known
    nulls = df.select("id", T.window_column(F.col("text"), PIECES, 4).alias("w")).collect()
    assert {r.id: r.w and len(r.w) for r in nulls} == {1: None, 2: [], 3: len(expected), 4: []}
