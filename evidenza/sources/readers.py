"""File and column readers.

Each file reader is ``spark.read`` plus a column parser; the parsers also work
on documents that already sit in a table column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidenza.functions.text import title_case
from evidenza.operators.spread import join_spread
from evidenza.schemas import PREDICTION, STRUCTURED_DOCUMENT, TRUTH, UNSTRUCTURED_DOCUMENT, nested


def _whole_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return (
        spark.read.option("pathGlobFilter", pattern)
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_name").alias("file_name"), "value")
    )


def _stem(file_name: Column, suffix: str) -> Column:
    return F.left(file_name, F.length(file_name) - len(suffix))


# --- JSON documents ---------------------------------------------------------


def is_one_object(value: Column) -> Column:
    """Whether the text is one JSON object from beginning to end."""
    # between brackets, anything but one whole value gives another length or none
    whole = F.json_array_length(F.concat(F.lit("["), value, F.lit("]"))) == 1
    return F.coalesce(whole & F.json_object_keys(value).isNotNull(), F.lit(False))


def parse_documents(
    rows: DataFrame, schema: T.StructType, keep: Sequence[str] = ("country",), value: str = "value"
) -> DataFrame:
    """JSON documents in a column as typed columns plus ``is_corrupt``.

    A field of the wrong type becomes null and the rest of the document stays;
    text that is not exactly one JSON object is marked and keeps only its key.
    """
    parsed = F.from_json(F.col(value), schema, {"mode": "PERMISSIVE"})
    return rows.select(*keep, (~is_one_object(F.col(value))).alias("is_corrupt"), parsed.alias("_doc")).select(
        *keep,
        *[F.when(~F.col("is_corrupt"), F.col(f"_doc.{n}")).alias(n) for n in schema.fieldNames()],
        "is_corrupt",
    )


def _json_rows(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    """JSON texts with their country: the partition folder if there is one, else the file stem.

    ``lines`` says how the files are made: one object per line, as the writers
    of this library leave them, or one object per file.
    """
    rows = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=not lines)
    stem = _stem(F.col("_metadata.file_name"), ".json")
    country = F.col("country").cast("string") if "country" in rows.columns else stem
    return rows.select(country.alias("country"), "value").filter(F.btrim("value", F.lit(" \t\r\n")) != "")


def read_structured(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    """Structured documents of a folder; see ``_json_rows`` for ``lines`` and the key."""
    return parse_documents(_json_rows(spark, path, lines), STRUCTURED_DOCUMENT)


def read_unstructured(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    return parse_documents(_json_rows(spark, path, lines), UNSTRUCTURED_DOCUMENT).withColumn(
        "timestamp", F.col("timestamp").try_cast("timestamp")
    )


def ingest_outcome(documents: DataFrame) -> DataFrame:
    """One row with the numbers of readable and unreadable documents."""
    return documents.agg(
        F.count_if(~F.col("is_corrupt")).alias("updated"), F.count_if("is_corrupt").alias("failed")
    )


# --- Markdown files ---------------------------------------------------------


def read_reports(spark: SparkSession, path: str, country_filter: str | None = None) -> DataFrame:
    """``(country, value)`` of ``*_report.md`` files; files with a blank key are left out.

    ``country_filter`` keeps names that contain it, ignoring case.
    """
    files = _whole_files(spark, path, "*_report.md")
    if country_filter:
        files = files.filter(F.contains(F.lower("file_name"), F.lit(country_filter.lower())))
    keyed = files.select(_stem(F.col("file_name"), "_report.md").alias("country"), "value")
    return keyed.filter(F.col("country") != "")


def page_country(file_name: Column) -> Column:
    """``new_zealand_policy_targets.md`` -> ``New Zealand``."""
    return title_case(F.replace(_stem(file_name, "_policy_targets.md"), F.lit("_"), F.lit(" ")))


def read_prediction_pages(spark: SparkSession, path: str) -> DataFrame:
    """``(country, value)`` of ``*_policy_targets.md`` files, keys as display names."""
    return _whole_files(spark, path, "*_policy_targets.md").select(
        page_country(F.col("file_name")).alias("country"), "value"
    )


# --- nested prediction and truth files --------------------------------------


def explode_nested(rows: DataFrame, leaf: T.StructType, value: str = "value") -> DataFrame:
    """country -> label -> fields as one row per (country, label).

    A text that is not exactly one JSON object ends the job instead of vanishing.
    """
    bad = F.raise_error(F.concat(F.lit("not one JSON object: "), F.left(F.col(value), F.lit(80))))
    checked = F.when(is_one_object(F.col(value)), F.col(value)).otherwise(bad.cast("string"))
    parsed = rows.select(F.from_json(checked, nested(leaf)).alias("_m"))
    return (
        parsed.select(F.explode("_m").alias("country", "_labels"))
        .select("country", F.explode("_labels").alias("label", "_leaf"))
        .select("country", "label", "_leaf.*")
    )


def _read_nested(spark: SparkSession, path: str, leaf: T.StructType, lines: bool) -> DataFrame:
    rows = spark.read.text(path, wholetext=not lines)
    return explode_nested(rows.filter(F.btrim("value", F.lit(" \t\r\n")) != ""), leaf)


def read_predictions(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    """Prediction JSON: with ``lines`` one object per line, as written here, else one per file."""
    return _read_nested(spark, path, PREDICTION, lines)


def read_truth(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    return _read_nested(spark, path, TRUTH, lines)


# --- tables -----------------------------------------------------------------


def sections_of_countries(
    countries: DataFrame, sections: DataFrame, spread: Sequence[str] = ("section_url",)
) -> DataFrame:
    """All sections with their country's columns in one join instead of a query per country.

    ``spread`` tells the sections of a country apart, see ``join_spread``.
    """
    home = countries.withColumn("country_doc_id", F.col("doc_id"))
    return join_spread(sections, home, ["country_doc_id"], spread)
