"""From section and country tables to evidence, predictions, pages and boxes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidenza.functions.encoders import HashingEncoder, encode_column
from evidenza.functions.text import fixed
from evidenza.operators.boxes import box_document, format_boxes, lookup_predictions, with_keys
from evidenza.operators.classify import LABELS, QUESTIONS, classify, confidence
from evidenza.operators.retrieve import best_evidence, chunk_rows, evidence_chunks, located_sections


def question_table(
    spark: SparkSession,
    questions: Sequence[str] = QUESTIONS,
    labels: Sequence[str] = LABELS,
    encoder_factory: Callable[[], object] = HashingEncoder,
) -> DataFrame:
    """``(question_id, label, question, embedding)`` of a fixed list of questions."""
    rows = [(i, label, text) for i, (label, text) in enumerate(zip(labels, questions, strict=True))]
    table = spark.createDataFrame(rows, "question_id int, label string, question string")
    return table.withColumn("embedding", encode_column(F.col("question"), encoder_factory))


def find_evidence(
    sections: DataFrame,
    countries: DataFrame,
    questions: DataFrame,
    encoder_factory: Callable[[], object] = HashingEncoder,
    country: str | None = None,
    k: int = 1,
) -> DataFrame:
    """Best chunk per (country, question): ``country, question_id, score, chunk, source_url``.

    Chunks are encoded and scored in one pass; only keys and scores leave it, and the texts of
    the winners are read from their sections again.
    """
    if country:
        sections = sections.filter(F.col("country_doc_id") == country)
    located = located_sections(sections, countries).withColumnRenamed("country_doc_id", "country")
    key = ("country", "source_url", "section_title")
    chunked = chunk_rows(located, key).withColumn("chunk_key", F.xxhash64("chunk"))
    winners = best_evidence(
        chunked,
        questions,
        order=("source_url", "section_title", "chunk_idx", "chunk_key"),
        text="chunk",
        encoder_factory=encoder_factory,
        k=k,
    )
    return evidence_chunks(winners, located, key).drop("chunk_key")


def predict(
    evidence: DataFrame,
    questions: DataFrame,
    encoder_factory: Callable[[], object] = HashingEncoder,
    **classify_options,
) -> DataFrame:
    """Predictions from evidence rows, without a detour through Markdown files.

    The confidence is computed on the whole answer text, its header included.
    """
    header = F.concat(F.lit("Answer/Evidence (Similarity: "), fixed(F.col("score"), 4), F.lit("):"))
    answers = evidence.withColumn("answer_text", F.concat_ws("\n", header, F.col("chunk"))).withColumn(
        "_answer", encode_column(F.col("answer_text"), encoder_factory)
    )
    asked = questions.select("question_id", "label", F.col("embedding").alias("_question"))
    scored = answers.join(asked, "question_id").withColumn(
        "confidence", confidence(F.col("_question"), F.col("_answer"))
    )
    return classify(scored, **classify_options).drop("_answer", "_question")


def question_boxes(
    predictions: DataFrame,
    names: DataFrame,
    questions: Mapping[str, str],
    aliases: Mapping[str, str],
    order: Sequence[str] = ("name",),
) -> DataFrame:
    """Ordered Q&A boxes of the named countries."""
    keyed = with_keys(names, aliases)
    found = lookup_predictions(keyed, predictions, questions)
    return box_document(format_boxes(found), list(questions), order)
