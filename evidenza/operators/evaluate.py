"""Predictions against truth at several grouping levels, and confidence tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidenza.functions.text import drop_first, fixed
from evidenza.operators.classify import CONFIDENCE_THRESHOLD, LABELS

# Fixed values.
POSITIVE_ANSWERS = ("yes", "soft_yes")
LOW_MARK = " 🟥"


# --- evaluation -------------------------------------------------------------


def label_grid(countries: DataFrame, labels: Sequence[str] = LABELS, country: str = "country") -> DataFrame:
    """Every country with every label; labels multiply inside the row, no join."""
    return countries.select(country, F.explode(F.array(*[F.lit(x) for x in labels])).alias("label"))


def is_positive(yes_no: Column, accepted: Sequence[str] = POSITIVE_ANSWERS) -> Column:
    return F.coalesce(F.lower(yes_no).isin(*accepted), F.lit(False)).cast("int")


def binarize(
    countries: DataFrame,
    answers: DataFrame,
    labels: Sequence[str] = LABELS,
    accepted: Sequence[str] = POSITIVE_ANSWERS,
    country: str = "country",
    name: str = "flag",
) -> DataFrame:
    """0/1 per (country, label); a missing answer counts as 0."""
    grid = label_grid(countries, labels, country)
    return grid.join(answers.select(country, "label", "yes_no"), [country, "label"], "left").select(
        country, "label", is_positive(F.col("yes_no"), accepted).alias(name)
    )


def align_countries(truth: DataFrame, predictions: DataFrame, country: str = "country") -> DataFrame:
    """``(country, status)``: ``both``, ``skipped`` (truth only) or ``extra``."""
    t = truth.select(country).distinct().withColumn("_truth", F.lit(True))
    p = predictions.select(country).distinct().withColumn("_pred", F.lit(True))
    status = (
        F.when(F.col("_truth") & F.col("_pred"), "both")
        .when(F.col("_truth"), "skipped")
        .otherwise("extra")
    )
    return t.join(p, country, "full_outer").select(country, status.alias("status"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def precision_recall_f1(
    cells: DataFrame,
    country: str = "country",
    label: str = "label",
    y_true: str = "y_true",
    y_pred: str = "y_pred",
) -> DataFrame:
    """Overall, per-label and per-country scores of 0/1 cells in one pass.

    ``(level, label, country, tp, fp, fn, precision, recall, f1)``; scores with
    an empty denominator are 0.  Counts combine before the shuffle.
    """
    t, p = F.col(y_true), F.col(y_pred)
    counts = (
        cells.groupingSets([[], [F.col(label)], [F.col(country)]], F.col(label), F.col(country))
        .agg(
            F.grouping_id().alias("_level"),
            F.count_if((t == 1) & (p == 1)).alias("tp"),
            F.count_if((t == 0) & (p == 1)).alias("fp"),
            F.count_if((t == 1) & (p == 0)).alias("fn"),
        )
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    level = F.when(F.col("_level") == 3, "overall").when(F.col("_level") == 1, "label").otherwise("country")
    return counts.select(
        level.alias("level"),
        F.col(label).alias("label"),
        F.col(country).alias("country"),
        "tp",
        "fp",
        "fn",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def evaluate(
    truth: DataFrame, predictions: DataFrame, labels: Sequence[str] = LABELS, country: str = "country"
) -> DataFrame:
    """Scores over the countries that both sides hold; a missing answer counts as 0."""
    key = [country, "label"]
    both = align_countries(truth, predictions, country).filter("status = 'both'")
    expected = truth.select(*key, F.col("yes_no").alias("_truth"))
    found = predictions.select(*key, F.col("yes_no").alias("_pred"))
    cells = label_grid(both, labels, country).join(expected, key, "left").join(found, key, "left")
    return precision_recall_f1(
        cells.select(*key, is_positive(F.col("_truth")).alias("y_true"), is_positive(F.col("_pred")).alias("y_pred")),
        country,
    )


def truth_template(
    predictions: DataFrame, labels: Sequence[str] = LABELS, country: str = "country"
) -> DataFrame:
    """Every predicted country with every label set to ``no``; blank names removed."""
    countries = predictions.select(country).filter(F.col(country) != "").distinct()
    return label_grid(countries, labels, country).withColumn("yes_no", F.lit("no"))


def summary_lines(scores: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Markdown summary as ``(block, place, name, line)`` rows, in one pass over the scores.

    Order by block, place, name; the per-country table may be of any length.
    The overall row brings the headings.
    """

    def table(heading: str, width: int) -> str:
        head = f"| {heading:<{width}} | Precision | Recall | F1-score |"
        rule = f"|{'-' * (width + 2)}|-----------|--------|----------|"
        return f"{head}\n{rule}"

    def row(name: str, width: int) -> Column:
        return F.format_string(f"| %-{width}s | %s     | %s  | %s    |", F.col(name), *numbers)

    def line(block: int, place: Column, name: Column, text: Column) -> Column:
        return F.struct(
            F.lit(block).alias("block"), place.cast("int").alias("place"), name.alias("name"), text.alias("line")
        )

    numbers = [fixed(F.col(c), 2) for c in ("precision", "recall", "f1")]
    first, none = F.lit(-1), F.lit("")
    overall = F.array(
        line(1, first, none, F.lit("## ✅ Overall Evaluation Results")),
        line(1, F.lit(0), none, F.format_string("- **Precision:** %s\n- **Recall:** %s\n- **F1-score:** %s\n", *numbers)),
        line(2, first, none, F.lit("## 📊 Per-label Performance\n" + table("Target Field", 22))),
        line(3, first, none, F.lit("\n## 🗺️ Per-country Performance\n" + table("Country", 16))),
    )
    place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("label"))
    level = F.col("level")
    return scores.select(
        F.inline(
            F.when(level == "overall", overall)
            .when(level == "label", F.array(line(2, place, F.col("label"), row("label", 22))))
            .otherwise(F.array(line(3, F.lit(0), F.col("country"), row("country", 16))))
        )
    )


# --- confidence tables ------------------------------------------------------


def page_confidences(pages: DataFrame, country: str = "country", value: str = "value") -> DataFrame:
    """``(country, label, confidence)`` read back from prediction pages.

    Blocks without a confidence line drop out; an unreadable number counts 0.
    """
    parts = drop_first(F.split(F.col(value), "## "))
    blocks = pages.select(country, F.explode(parts).alias("_block"))
    first = F.btrim(F.get(F.split(F.btrim(F.col("_block"), F.lit(" \t\r\n")), r"\r?\n"), F.lit(0)))
    number = F.regexp_extract(F.col("_block"), r"(?m)^\s*[-*]\s+\*\*Confidence\*\*:\s+([0-9.]+)", 1)
    return blocks.filter(number != "").select(
        country,
        F.replace(F.lower(first), F.lit(" "), F.lit("_")).alias("label"),
        F.coalesce(number.try_cast("double"), F.lit(0.0)).alias("confidence"),
    )


def confidence_pivot(
    confidences: DataFrame, labels: Sequence[str] = LABELS, country: str = "country"
) -> DataFrame:
    """country x label matrix, missing cells 0; a repeated cell is an error."""
    values = [F.max(F.when(F.col("label") == x, F.col("confidence"))).alias(x) for x in labels]
    repeats = [F.count_if(F.col("label") == x).alias(f"_n_{i}") for i, x in enumerate(labels)]
    wide = confidences.groupBy(country).agg(*values, *repeats)
    most = F.greatest(*[F.col(f"_n_{i}") for i in range(len(labels))]) if len(labels) > 1 else F.col("_n_0")
    cells = [
        F.when(most > 1, F.raise_error(F.concat(F.lit("repeated cell for "), F.col(country))).cast("double"))
        .otherwise(F.coalesce(F.col(x), F.lit(0.0)))
        .alias(x)
        for x in labels
    ]
    return wide.select(country, *cells)


def confidence_annotation(value: Column, threshold: float = CONFIDENCE_THRESHOLD) -> Column:
    """Two decimals, with a mark below the threshold."""
    return F.concat(
        fixed(value, 2), F.when(value < threshold, LOW_MARK).otherwise("")
    )


def low_confidence_counts(
    confidences: DataFrame, threshold: float = CONFIDENCE_THRESHOLD, country: str = "country"
) -> DataFrame:
    """``(country, low_confidence_count)`` of countries that have any, most first."""
    return (
        confidences.filter(F.col("confidence") < threshold)
        .groupBy(country)
        .agg(F.count("*").alias("low_confidence_count"))
        .orderBy(F.col("low_confidence_count").desc(), country)
    )


def project_2d(rows: DataFrame, key: str, vector: str) -> DataFrame | None:
    """First two principal components of the vectors, or None for a single row.

    Each axis is turned so that its largest loading is positive; the points are
    centered, as the components are those of the covariance.
    """
    if len(rows.select(key).take(2)) < 2:
        return None
    data = rows.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    model = PCA(k=2, inputCol="_v", outputCol="_p").fit(data)
    loadings = model.pc.toArray()
    signs = [1.0 if column[abs(column).argmax()] >= 0 else -1.0 for column in loadings.T]
    center = data.select(Summarizer.mean(F.col("_v")).alias("m")).first().m.toArray() @ loadings
    point = vector_to_array("_p")
    return model.transform(data).select(
        key, *[((F.get(point, F.lit(i)) - F.lit(float(center[i]))) * F.lit(signs[i])).alias(f"pc{i + 1}") for i in range(2)]
    )
