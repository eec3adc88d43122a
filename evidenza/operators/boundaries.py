"""Sentence boundaries that know abbreviations, which are learned from the corpus itself.

A type (a lower-case word, perhaps with full stops inside) is an abbreviation if it stands
before a full stop far more often than chance has it.  The score is the log-likelihood
ratio of that, as Dunning's test gives it, against a word that is followed by one nearly
always, weighted as Kiss and Strunk (2006) weight it: short types and types with inner stops
count for more, and each occurrence without a stop counts against long types.

Counts are grouped sums over all texts.  A splitter looks candidates up in the table by a
join on the word, so the table may have any size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evidenza.functions.sentences import sentences

#: A word of letters, perhaps with stops between them, and the stop after it.
WORD_AND_STOP = r"\p{L}+(?:\.\p{L}+)*\.?"
LAST_WORD = r"(\p{L}+(?:\.\p{L}+)*)\.$"
#: How often an abbreviation is followed by a stop.
STOP_RATE = 0.99
THRESHOLD = 0.3


def type_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n, n_stopped)``: occurrences of each type, and those before a stop."""
    found = F.regexp_extract_all(F.lower(text), F.lit(WORD_AND_STOP), F.lit(0))
    tokens = texts.select(F.explode(found).alias("token"))
    stopped = F.endswith("token", F.lit("."))
    return tokens.select(F.rtrim(F.col("token"), F.lit(".")).alias("word"), stopped.alias("stopped")).groupBy("word").agg(
        F.count("*").alias("n"), F.count_if("stopped").alias("n_stopped")
    )


def score(n: Column, n_stopped: Column, rate: Column, word: Column) -> Column:
    """Weighted log-likelihood ratio; ``rate`` is the share of all words that stand before a stop."""
    free = (n - n_stopped).cast("double")
    held = n_stopped.cast("double")
    chance = held * F.ln(rate) + free * F.ln(1 - rate)
    always = held * F.ln(F.lit(STOP_RATE)) + free * F.ln(F.lit(1 - STOP_RATE))
    inner = F.length(word) - F.length(F.replace(word, F.lit("."), F.lit("")))
    letters = (F.length(word) - inner).cast("double")
    return -2 * (chance - always) * F.exp(-letters) * (inner + 1) * F.pow(letters, -free)


def abbreviation_scores(texts: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n, n_stopped, score)`` of the types that stand before a stop at least once.

    If every word or no word does, nothing can be told, and all scores are 0.
    """
    counts = type_counts(texts, text)
    totals = counts.agg((F.sum("n_stopped") / F.sum("n")).alias("rate"))
    rated = counts.where("n_stopped > 0").withColumn("rate", totals.scalar())
    known = (F.col("rate") > 0) & (F.col("rate") < 1)
    found = F.when(known, score(F.col("n"), F.col("n_stopped"), F.col("rate"), F.col("word"))).otherwise(F.lit(0.0))
    return rated.select("word", "n", "n_stopped", found.alias("score"))


def abbreviations(texts: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(word)``: the learned abbreviations."""
    return abbreviation_scores(texts, text).where(F.col("score") >= threshold).select("word")


def sentence_rows(
    texts: DataFrame,
    key: Sequence[str],
    known: DataFrame,
    text: str = "text",
    splitter: Callable[[Column], Column] = sentences,
) -> DataFrame:
    """``(*key, sentence_idx, sentence)``: pieces of the splitter, joined again after abbreviations.

    ``key`` must tell the rows of ``texts`` apart; ``known`` has one ``word`` per row.  A piece that
    ends in a known word and a stop goes on in the next piece.
    """
    pieces = texts.select(*key, F.posexplode(splitter(F.col(text))).alias("_pos", "_piece"))
    pieces = pieces.withColumn("_word", F.nullif(F.regexp_extract(F.lower("_piece"), LAST_WORD, 1), F.lit("")))
    marks = known.select(F.col("word").alias("_word"), F.lit(1).alias("_known"))
    met = pieces.join(marks, "_word", "left")
    order = W.partitionBy(*key).orderBy("_pos")
    begins = F.when(F.lag("_known").over(order) == 1, 0).otherwise(1)
    numbered = met.withColumn("_begins", begins).withColumn("_number", F.sum("_begins").over(order))
    parts = F.array_sort(F.collect_list(F.struct("_pos", "_piece")))
    joined = numbered.groupBy(*key, "_number").agg(parts.alias("_parts"))
    return joined.select(
        *key, (F.col("_number") - 1).cast("int").alias("sentence_idx"), F.array_join(F.col("_parts._piece"), " ").alias("sentence")
    )
