"""A training corpus from ``documents``: five stages, each written and read again.

Rows without doc_id cannot be judged by id: they stay where a stage compares
documents, and share one mask of lines.  An empty table passes through all stages.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidenza.llm import crf, decontaminate, lines, mixing, similar
from evidenza.llm.storage import scratch, written

#: Rows that pass between Spark and Python at once; each carries a whole text.
BATCH_ROWS = 1024
#: A document goes if the model is less sure than this of its words, averaged over letters.
MIN_CERTAINTY = 0.5


def small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """The stage in a session whose Arrow batches have at most ``BATCH_ROWS`` rows."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        name = "spark.sql.execution.arrow.maxRecordsPerBatch"
        if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
            spark.conf.set(name, str(BATCH_ROWS))  # stays set: what a stage returns runs later
        return stage(spark, docs, sf_dir)

    return run_stage


@small_batches
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in known languages: texts without letters, or whose words are in doubt, go.

    A text may be in several languages.  Where no row has both a text and a lang, nothing can
    be learned, and every text with a letter stays.
    """
    model = crf.fit(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    rows = docs.select(F.struct("*").alias("row"))
    found = rows.withColumn("found", crf.language_column(F.col("row.text"), spark, model))
    known = (F.col("found.lang") != crf.UNKNOWN) & (F.col("found.certainty") >= MIN_CERTAINTY)
    return found.where(known).select("row.*")


@small_batches
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that five or more share, but in the last of these."""
    found = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs))
    fresh = {"text": F.col("text"), "n_chars": F.char_length("text").cast("bigint")}
    return found.select(*[fresh.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


@small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest id, of each group of near duplicates: texts whose
    five-word shingles have a Jaccard similarity of 0.8 or more, and what these join.  Blocks
    of SimHash fingerprints find them, and bands of minima those whose fingerprints are
    further apart.  Texts that are not alike stay, also if they share a doc_id."""
    return similar.one_of_each(docs)


@small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contamination(docs, benchmark).where("found.n_hit = 0").select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """For each document, the words that the mix takes from it, repeats counted."""
    return mixing.mixed_words(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixture", mixture),
]

#: Training, fingerprints and keyed permutations have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what a stage wrote on its way is removed when its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scratch(spark):
            docs = written(stage(spark, docs, sf_dir), name, kept=True)
    return docs
