"""Question-and-answer boxes from predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidenza.functions.text import label_title, number_text, strip

# The names that can be asked for, and the wordings of a box.
COUNTRY_NAMES = (
    "Argentina", "Australia", "Bhutan", "Brazil", "Canada", "Chile", "China", "Colombia",
    "Costa Rica", "EU", "Egypt", "Ethiopia", "Gabon", "Germany", "India", "Indonesia",
    "Iran", "Japan", "Kazakhstan", "Kenya", "Mexico", "Morocco",
    "Nepal", "New Zealand", "Nigeria", "Norway", "Peru", "Philippines", "Russia",
    "Saudi Arabia", "Singapore", "South Africa", "South Korea", "Switzerland", "Thailand",
    "The Gambia", "Turkey", "UAE", "USA", "Ukraine", "United Kingdom", "Vietnam",
)
# Names whose prediction key is not their lower-case form.
KEY_ALIASES = {
    "Costa Rica": "costa-rica", "New Zealand": "new-zealand", "Russia": "russian-federation",
    "Saudi Arabia": "saudi-arabia", "South Africa": "south-africa", "South Korea": "south-korea",
    "The Gambia": "gambia", "United Kingdom": "uk",
}
ANSWER_YES = "✅ Yes"
ANSWER_NO = "❌ No"
NO_QUOTE = "No quote provided."
BOX_SEPARATOR = "\n---\n"


def fill_template(template: Column, country: Column) -> Column:
    return F.replace(template, F.lit("{country}"), country)


def select_names(names: DataFrame, request: str, name: str = "name") -> DataFrame:
    """Rows asked for: ``all``, or those named in a comma-separated list."""
    if request.strip().lower() == "all":
        return names
    wanted = [part.strip() for part in request.split(",")]
    return names.filter(F.col(name).isin(wanted))


def with_keys(names: DataFrame, aliases: Mapping[str, str] = KEY_ALIASES, name: str = "name") -> DataFrame:
    """Add the prediction key of each name: its alias, else its lower-case form."""
    key = F.lower(F.col(name))
    if aliases:
        table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
        key = F.coalesce(F.try_element_at(table, F.col(name)), key)
    return names.withColumn("key", key)


def lookup_predictions(
    keyed_names: DataFrame, predictions: DataFrame, questions: Mapping[str, str], country: str = "country"
) -> DataFrame:
    """Predictions of the named countries, for labels that have a question."""
    template = F.create_map(*[F.lit(x) for pair in questions.items() for x in pair])
    asked = predictions.filter(F.col("label").isin(*questions)).withColumnRenamed(country, "key")
    return keyed_names.join(asked, "key").withColumn(
        "question", fill_template(F.try_element_at(template, F.col("label")), F.col("name"))
    )


def unmatched_names(keyed_names: DataFrame, predictions: DataFrame, country: str = "country") -> DataFrame:
    """Names without any prediction; prediction keys are reduced before the join."""
    known = predictions.select(F.col(country).alias("key")).distinct()
    return keyed_names.join(known, "key", "left_anti")


def answer_text(yes_no: Column) -> Column:
    """Only a plain ``yes`` counts as yes in a box."""
    return F.when(yes_no == "yes", ANSWER_YES).otherwise(ANSWER_NO)


def list_text(values: Column) -> Column:
    joined = F.array_join(values, ", ")
    return F.when(F.coalesce(joined, F.lit("")) != "", joined).otherwise("N/A")


def quote_text(quote: Column) -> Column:
    """Quote without an answer header and without a similarity tail."""
    text = strip(F.coalesce(quote, F.lit("")))
    shown = F.when(F.contains(text, F.lit("Similarity:")), strip(F.split_part(text, F.lit("Similarity:"), F.lit(1))))
    shown = F.coalesce(shown, text)
    dropped = F.lower(text).startswith("answer/evidence") | (shown == "")
    return F.concat(F.lit("> "), F.when(dropped, NO_QUOTE).otherwise(shown))


def percent_text(confidence: Column) -> Column:
    """Confidence as a percentage, ``N/A`` if there is no number."""
    return F.coalesce(number_text(confidence.try_cast("double") * 100, 2), F.lit("N/A"))


def format_boxes(infos: DataFrame) -> DataFrame:
    """Add ``box``, the Markdown box of each (name, label, question, prediction) row."""
    lines = F.concat(
        F.lit("\n### "), F.col("name"), F.lit(" – "), label_title(F.col("label")),
        F.lit("\n\n**Question:** "), F.col("question"),
        F.lit("  \n**Answer:** "), answer_text(F.col("yes_no")),
        F.lit("  \n**Explanation:** "), F.coalesce(F.col("explanation"), F.lit("None")),
        F.lit("  \n**Target Year(s):** "), list_text(F.col("year")),
        F.lit("  \n**Sectors:** "), list_text(F.col("sectors")),
        F.lit("\n\n**Quote:**  \n"), quote_text(F.col("quote")),
        F.lit("\n\n**Confidence:** "), percent_text(F.col("confidence")),
        F.lit("%  \n**Source:** [Link]("), F.coalesce(F.col("source_url"), F.lit("#")),
        F.lit(")\n"),
    )
    return infos.withColumn("box", lines)


def box_document(boxes: DataFrame, labels: Sequence[str], order: Sequence[str] = ("name",)) -> DataFrame:
    """Boxes with ``label_place``; the document order is ``order``, then ``label_place``.

    The document stays a set of rows.  ``write_ordered_text`` sorts them, once,
    and with ``BOX_SEPARATOR`` between rows its files are the finished document.
    """
    place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("label"))
    return boxes.select(*dict.fromkeys([*order, *boxes.columns]), place.cast("int").alias("label_place"))
