"""Writers.  Every write is one distributed job and safe to repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Parts that the rows of one country are split into, so files of one country at most.
COUNTRY_PARTS = 32


def _write(df: DataFrame, country: str, path: str, kind: str) -> None:
    """Directory per country, replacing only the countries that are written."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    getattr(writer.partitionBy(country), kind)(path)


def _by_country(df: DataFrame, country: str, path: str, kind: str, spread: Sequence[str]) -> None:
    """Rows dealt by country and a salt of their ``spread`` columns.

    A hash needs no sampling, so what made the rows runs once, and a country
    that holds most of them goes through many tasks.
    """
    part = F.pmod(F.xxhash64(*spread), F.lit(COUNTRY_PARTS))
    dealt = df.repartition(F.col(country), part).sortWithinPartitions(country, *spread)
    _write(dealt.drop(*[c for c in spread if c.startswith("_")]), country, path, kind)


def write_documents(df: DataFrame, path: str, country: str = "country", value: str = "value") -> None:
    """One text (report, page) per country."""
    _write(df.select(country, value).repartition(country), country, path, "text")


def write_lines(
    df: DataFrame, path: str, order: Sequence[str], country: str = "country", line: str = "line"
) -> None:
    """Ordered lines of per-country documents.

    Range partitioning on (country, ``order``) keeps a small country in one file
    and splits a large one over many, in order.  A repeated write replaces a
    country's lines instead of appending them again.
    """
    rows = df.select(country, *order, line)
    ordered = rows.repartitionByRange(country, *order).sortWithinPartitions(country, *order)
    _write(ordered.drop(*order), country, path, "text")


def write_structured(sections: DataFrame, path: str, country: str = "country") -> None:
    """Structured JSON, one object per section line: ``{country_name, sections:{title:{content,url}}}``."""
    body = F.create_map(F.col("section_title"), F.struct("content", F.col("section_url").alias("url")))
    rows = sections.select(country, "country_name", body.alias("sections"), F.col("section_url").alias("_url"))
    _by_country(rows, country, path, "json", ["_url"])


def write_unstructured(
    sections: DataFrame, path: str, lines, version: str = "1.0", country: str = "country"
) -> None:
    """Flattened JSON, one object per section line; ``lines`` is the content column."""
    rows = sections.select(
        country,
        F.col(country).alias("country_slug"),
        "country_name",
        lines.alias("content"),
        F.create_map("section_title", "section_url").alias("urls"),
        F.col("scraped_at").alias("timestamp"),
        F.lit(version).alias("version"),
        F.col("section_url").alias("_url"),
    )
    _by_country(rows, country, path, "json", ["_url"])


def write_items(items: DataFrame, path: str, country: str = "country", section: str = "section_title") -> None:
    """JSON items in a directory per country and section."""
    named = items.withColumn("section", F.replace(F.lower(section), F.lit(" "), F.lit("_")))
    (
        named.repartition(country, "section")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(country, "section")
        .json(path)
    )


def country_index(items: DataFrame, country: str = "country") -> DataFrame:
    return items.select(country).distinct()


def write_predictions(nested: DataFrame, path: str, country: str = "country") -> None:
    """Nested predictions, one ``{country: {label: {...}}}`` object per line."""
    line = F.to_json(F.create_map(F.col(country), F.col("predictions")), {"ignoreNullFields": "false"})
    nested.select(line.alias("value")).write.mode("overwrite").text(path)


def write_low_confidence(counts: DataFrame, path: str) -> bool:
    """CSV with a header; true if there is anything to report.

    The target is replaced in any case, so rows of an earlier run never stay.
    """
    counts.write.mode("overwrite").option("header", True).csv(path)
    return not counts.sparkSession.read.option("header", True).csv(path).isEmpty()


def write_ordered_text(
    rows: DataFrame, path: str, order: Sequence[str], line: str = "line", separator: str = "\n"
) -> None:
    """One document as part files in order, ``separator`` after every row."""
    (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(line)
        .write.mode("overwrite")
        .option("lineSep", separator)
        .text(path)
    )
