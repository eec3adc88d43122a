"""Benchmark decontamination with one Aho-Corasick automaton.

The patterns are the windows of all benchmark items: ten consecutive words after
normalisation, or the whole item if it has fewer.  Each distinct word of the
benchmark gets a code of three characters, one from each of three alphabets, so
matches begin and end at word edges.  A document is normalised the same way (A-Z
lower-cased), coded word by word, words unknown to the benchmark as a code that no
window holds, and scanned once.  Hits are word numbers, which are mapped back to
the original text.

The windows are shipped to the tasks, at most ``MAX_PATTERN_WORDS`` words of them at
a time.  A larger benchmark is cut into automata of that size; each scans the
numbered documents in a pass of its own that emits only hits, and the hits of a
document are put together afterwards.

Defined cases: a null text, of a document or an item, has no words; an item
without words has no window; rows that repeat an item_id are one item; an item
without item_id marks words and is listed as ``null``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidenza.llm.batches import text_udf
from evidenza.llm.storage import new_path, written

WINDOW_WORDS = 10
#: Words of windows in one automaton, about 300 bytes of memory each at most.
MAX_PATTERN_WORDS = 1_000_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Number of words, places of those inside a window, and the items found.
HITS = "struct<n_words: bigint, places: array<int>, items: array<string>>"
SPANS = "array<struct<start: int, stop: int>>"


def lower(text: str) -> str:
    return text.translate(_LOWER)


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def item_windows(benchmark: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """``(window, items)``: each distinct window and the sorted ids of its items."""
    words = F.regexp_extract_all(lowered(F.col("text")), F.lit(f"({WORD.pattern})"), F.lit(1))
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words.alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    windows = F.transform(starts, lambda i: F.array_join(F.slice("w", i, F.lit(size)), " "))
    rows = rows.where(F.size("w") > 0).select("item", F.explode(windows).alias("window"))
    return rows.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def pattern_groups(windows: DataFrame, max_words: int = MAX_PATTERN_WORDS) -> Iterator[list[tuple[str, list[str]]]]:
    """The windows in groups of at most ``max_words`` words, normally one."""
    group, held = [], 0
    for row in windows.orderBy("window").toLocalIterator():
        n_words = row.window.count(" ") + 1
        if group and held + n_words > max_words:
            yield group
            group, held = [], 0
        group.append((row.window, list(row["items"])))
        held += n_words
    yield group


class Scanner:
    """The automaton of one group of windows, over words coded as characters."""

    DIGITS = 128
    CODE_CHARS = 3
    UNKNOWN = "\0\0\0"

    def __init__(self, group: list[tuple[str, list[str]]]):
        self.codes: dict[str, str] = {}
        self.automaton = ahocorasick.Automaton()
        for window, items in group:
            words = window.split(" ")
            self.automaton.add_word("".join([self.code(word) for word in words]), (len(words), tuple(items)))
        if len(self.automaton):
            self.automaton.make_automaton()

    def code(self, word: str) -> str:
        """Digits of the word's number, highest first; few words make few branches at the root."""
        if word not in self.codes:
            left, digits = len(self.codes), []
            for place in range(1, self.CODE_CHARS + 1):
                left, digit = divmod(left, self.DIGITS)
                digits.append(chr(place * self.DIGITS + digit))
            if left:
                raise ValueError("an automaton of so many words has no codes left")
            self.codes[word] = "".join(reversed(digits))
        return self.codes[word]

    def scan(self, text: str | None) -> dict:
        words = WORD.findall(lower(text)) if text else []
        if not words or not len(self.automaton):
            return {"n_words": len(words), "places": [], "items": []}
        coded = "".join([self.codes.get(word, self.UNKNOWN) for word in words])
        longest: dict[int, int] = {}
        items: set[str] = set()
        for end, (n_words, names) in self.automaton.iter(coded):
            last = end // self.CODE_CHARS
            longest[last] = max(n_words, longest.get(last, 0))
            items.update(names)
        if not longest:
            return {"n_words": len(words), "places": [], "items": []}
        edges = np.zeros(len(words) + 1, np.int32)
        for last, n_words in longest.items():
            edges[last + 1 - n_words] += 1
            edges[last + 1] -= 1
        return {"n_words": len(words), "places": np.flatnonzero(np.cumsum(edges[:-1])), "items": sorted(items)}


def scan_column(text: Column, spark, group: list[tuple[str, list[str]]]) -> Column:
    """Struct of n_words, places of hit words, and items."""
    shipped = spark.sparkContext.broadcast(group)
    kind = pa.struct([("n_words", pa.int64()), ("places", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])
    scanner: list[Scanner] = []

    def work(texts: pa.Array) -> pa.Array:
        if not scanner:
            scanner.append(Scanner(shipped.value))
        return pa.array([scanner[0].scan(x.as_py()) for x in texts], kind)

    return text_udf(work, HITS)(text)


def original_spans(texts: pa.Array, places: pa.Array) -> pa.Array:
    """Character ranges of the original text for runs of word numbers."""
    found = []
    for text, words in zip(texts, places, strict=True):
        at = np.asarray(words.values) if words.is_valid else np.empty(0, np.int64)
        spans = []
        if len(at):
            ends = [m.span() for m in WORD.finditer(lower(text.as_py()))]
            runs = np.split(at, np.flatnonzero(np.diff(at) > 1) + 1)
            spans = [{"start": ends[run[0]][0], "stop": ends[run[-1]][1]} for run in runs]
        found.append(spans)
    return pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))


original_spans.__annotations__ = {"texts": pa.Array, "places": pa.Array, "return": pa.Array}


def _scanned_in_passes(rows: DataFrame, groups: Iterable[list[tuple[str, list[str]]]]) -> DataFrame:
    """``rows`` with ``hits``, one pass over the numbered texts for each group."""
    spark = rows.sparkSession
    numbered = written(rows.withColumn("number", F.monotonically_increasing_id()), "numbered")
    folder = new_path(spark, "hits")
    for group in groups:
        hits = numbered.select("number", scan_column(F.col("row.text"), spark, group).alias("hits"))
        hits.where(F.size("hits.places") > 0).write.mode("append").parquet(folder)
    whole = spark.read.schema(f"number bigint, hits {HITS}").parquet(folder).groupBy("number").agg(
        F.array_sort(F.flatten(F.collect_set("hits.places"))).alias("places"),
        F.array_sort(F.flatten(F.collect_set("hits.items"))).alias("items"),
    )
    n_words = F.regexp_count(lowered(F.col("row.text")), F.lit(WORD.pattern)).cast("bigint")
    return numbered.join(whole, "number", "left").select("row", F.struct(
        n_words.alias("n_words"),
        F.array_distinct(F.coalesce("places", F.array().cast("array<int>"))).alias("places"),
        F.array_distinct(F.coalesce("items", F.array().cast("array<string>"))).alias("items"),
    ).alias("hits"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, max_words: int = MAX_PATTERN_WORDS
) -> DataFrame:
    """Every row of ``docs`` as struct ``row`` beside ``found``: n_words, n_hit, items, and
    spans of the original text."""
    rows = docs.select(F.struct("*").alias("row"))
    groups = pattern_groups(item_windows(benchmark, size), max_words)
    first, second = next(groups), next(groups, None)
    if second is None:
        scanned = rows.withColumn("hits", scan_column(F.col("row.text"), docs.sparkSession, first))
    else:
        scanned = _scanned_in_passes(rows, chain([first, second], groups))
    touched = F.when(F.size("hits.places") > 0, F.col("row.text"))
    return scanned.select("row", F.struct(
        F.col("hits.n_words").alias("n_words"), F.size("hits.places").cast("bigint").alias("n_hit"),
        F.col("hits.items").alias("items"),
        F.arrow_udf(original_spans, SPANS)(touched, F.col("hits.places")).alias("spans"),
    ).alias("found"))
