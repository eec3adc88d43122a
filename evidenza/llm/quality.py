"""Quality rules by line-first cleaning.

Every line with a word is judged by three rules before the document is:

* punctuation: a line of under ``SENTENCE_WORDS`` words that ends no sentence, a line in
  which symbols are over a tenth of the characters, or one in which over half of three or
  more words are cried out (end in ``!``);
* navigation: separators are words of their own, at least ``MIN_SEPARATORS`` of them and a
  fifth of the line's words;
* boilerplate: a line of at most ``BOILERPLATE_WORDS`` words that holds a known phrase.

Failing lines go.  A document is rejected if it loses more than ``MAX_LOST`` percent of the
characters in its words, or fails the base rules: under ``MIN_WORDS`` words, or over
``MAX_REPEATED`` percent of them inside five-word windows that occur again in the text.

Texts are judged whole, one by one, on slices of bounded size: lines and words are Arrow
arrays, and what depends on a word alone is worked out once per distinct word.  Nothing is
shuffled.  Windows meet by a 64-bit hash, and windows whose hashes meet are compared word
by word, so the counts are exact.

Defined cases: null text has no words, is rejected and stays null; an empty text is one empty
line; lines without words are kept and cost nothing; rows that repeat are judged alike; an
empty table has no rows.  No column but text is read; all are carried in ``row``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidenza.llm.batches import text_udf

MIN_WORDS = 10
WINDOW_WORDS = 5
MAX_REPEATED = 20
MAX_LOST = 50
SENTENCE_WORDS = 8
MIN_SEPARATORS = 3
BOILERPLATE_WORDS = 30
SYMBOLS = "#*$%&|<>"
SEPARATORS = ("|", "||", ">", ">>", "»", "·", "•", "/", "::")
#: A sentence ends in one of these, perhaps inside closing quotes or brackets.
SENTENCE_END = "[.!?…。！？؟][\"')\\]»”’]*$"
PHRASES = (
    "accept cookies", "all rights reserved", "click here", "cookie policy", "enable javascript",
    "licensed under", "log in", "lorem ipsum", "privacy policy", "released under", "sign up",
    "subscribe to", "terms of service", "terms of use",
)
BLANKS = " \t\n\x0b\x0c\r"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_failed_lines", "lost_chars")
FOUND = f"struct<text: string, {', '.join(f'{m}: bigint' for m in MEASURES)}>"


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over consecutive runs of the given lengths, which may be 0."""
    total = np.r_[0, np.cumsum(values, dtype=np.int64)]
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _words(lines: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of the lines in order, and how many each line has."""
    split = pc.ascii_split_whitespace(lines)
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    flat = split.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(full).dictionary_encode(), _sums(full.to_numpy(zero_copy_only=False), lengths)


def repeated_words(codes: np.ndarray, counts: np.ndarray, size: int = WINDOW_WORDS) -> np.ndarray:
    """For each text, its words inside windows that it holds twice or more.

    ``codes`` has the words of all texts, ``counts`` how many each text has.
    """
    if len(codes) < size:
        return np.zeros(len(counts), np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    n = len(codes) - size + 1
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashed = text[:n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(size):
        hashed = (hashed ^ mixed[j : j + n]) * np.uint64(0xBF58476D1CE4E5B9)
        hashed ^= hashed >> np.uint64(32)
    whole = np.flatnonzero(text[:n] == text[size - 1 :])
    order = whole[np.argsort(hashed[whole])]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = hashed[order[1:]] == hashed[order[:-1]]
    met = order[same[1:] | same[:-1]]
    covered = np.zeros(len(codes) + 1, np.int64)
    if met.size:
        rows = np.stack([text[met], *(codes[met + j] for j in range(size))], axis=1)
        _, back, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        again = met[times[back.ravel()] > 1]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + size, -1)
    return _sums(np.cumsum(covered[:-1]) > 0, counts)


def failed_lines(lines: pa.Array, n_words: np.ndarray, chars: np.ndarray, symbols: np.ndarray, seps: np.ndarray, cries: np.ndarray) -> np.ndarray:
    """Whether each line breaks a rule; lines without words break none."""
    bare = pc.ascii_trim(lines, BLANKS)
    ends = pc.match_substring_regex(bare, SENTENCE_END).to_numpy(zero_copy_only=False)
    punctuation = ((n_words < SENTENCE_WORDS) & ~ends) | (10 * symbols > chars) | ((n_words >= 3) & (2 * cries > n_words))
    navigation = (seps >= MIN_SEPARATORS) & (5 * seps >= n_words)
    known = pc.match_substring_regex(pc.ascii_lower(lines), "|".join(PHRASES)).to_numpy(zero_copy_only=False)
    return (n_words > 0) & (punctuation | navigation | (known & (n_words <= BOILERPLATE_WORDS)))


def judge_texts(texts: pa.Array) -> pa.Array:
    """Cleaned text and measures of each text."""
    split = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    lines = split.flatten()
    n_lines = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    words, per_line = _words(lines)
    codes = words.indices.to_numpy()
    distinct = words.dictionary

    def per_word(values: pa.Array) -> np.ndarray:
        return _sums(values.to_numpy(zero_copy_only=False).astype(np.int64)[codes], per_line)

    chars = per_word(pc.utf8_length(distinct))
    symbols = per_word(pc.count_substring_regex(distinct, f"[{SYMBOLS}]"))
    seps = per_word(pc.is_in(distinct, pa.array(SEPARATORS)))
    cries = per_word(pc.ends_with(distinct, "!"))
    failed = failed_lines(lines, per_line, chars, symbols, seps, cries)
    per_text = _sums(per_line, n_lines)
    text = np.repeat(np.arange(len(texts)), n_lines)
    alike = lines.dictionary_encode()
    keys = (text * len(alike.dictionary) + alike.indices.to_numpy())[per_line > 0]
    first = np.bincount(np.unique(keys) // max(1, len(alike.dictionary)), minlength=len(texts))
    n_failed = _sums(failed, n_lines)
    cleaned = []
    starts = np.cumsum(n_lines) - n_lines
    for i, value in enumerate(texts):
        if n_failed[i]:
            at = slice(int(starts[i]), int(starts[i] + n_lines[i]))
            kept = lines[at].filter(pa.array(~failed[at]))
            cleaned.append("\n".join(kept.to_pylist()))
        else:
            cleaned.append(value.as_py())
    columns = [
        per_text, _sums(chars, n_lines), _sums(symbols, n_lines), _sums(per_line > 0, n_lines) - first,
        repeated_words(codes, per_text), n_lines, n_failed, _sums(np.where(failed, chars, 0), n_lines),
    ]
    return pa.StructArray.from_arrays(
        [pa.array(cleaned, pa.string()), *(pa.array(c.astype(np.int64)) for c in columns)], ["text", *MEASURES]
    )


def judged(docs: DataFrame) -> DataFrame:
    """``(row, found, base_failed, kept)``: each row as a struct, its cleaned text and measures, and the verdicts."""
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.withColumn("found", text_udf(judge_texts, FOUND)(F.col("row.text")))
    base_failed = (F.col("found.n_words") < MIN_WORDS) | (
        100 * F.col("found.n_repeat_words") > MAX_REPEATED * F.col("found.n_words")
    )
    lost = 100 * F.col("found.lost_chars") > MAX_LOST * F.col("found.word_chars")
    return rows.withColumns({"base_failed": base_failed, "kept": ~base_failed & ~lost})


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their cleaned texts and all their columns."""
    good = judged(docs).where("kept")
    return good.select(*[F.col("found.text" if c == "text" else f"row.`{c}`").alias(c) for c in docs.columns])
