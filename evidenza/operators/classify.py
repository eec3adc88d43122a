"""Evidence text -> tags, confidence gate, rule answers and prediction pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidenza.functions.lexicon import Lexicon, Term, terms
from evidenza.functions.text import capitalize, drop_first, fixed, label_title, let, number_text, strip
from evidenza.functions.vectors import cosine

# ---------------------------------------------------------------------------
# Labels, questions, word patterns, answers and wordings.
# ---------------------------------------------------------------------------

LABELS = (
    "net_zero_target", "sector_targets", "efficiency_target", "electricity_net_zero", "carbon_pricing",
)

QUESTIONS = (
    "Does the country have a net zero target, and if so, what year is the target set for?",
    "Does the country have a multi-sector climate strategy that sets quantified sector-specific emission targets or projections for key sectors like Electricity, Transport, Industry, LULUCF/Agriculture, and any other fifth sector with significant emissions?",
    "Does the country have an energy efficiency law or a strategic framework for national energy efficiency, AND has it set an energy efficiency target (economy-wide or sectoral)?",
    "Has the country set a net zero electricity target aligned with 1.5°C (e.g., by 2035 for high-income, 2040 for China, 2045 for rest of world), or an equivalent economy-wide net zero commitment?",
    "Does the country have a carbon pricing mechanism in place (e.g., carbon tax or emissions trading system)?",
)

YEAR_PATTERNS = (
    r"(?U)\b(20\d{2})\b",
    r"(?iU)(?:by|target year|before|achieve by)\s+(20\d{2})",
)
YEAR_PHRASES = {r"(?iU)\bmid[-\s]?century\b": "2050"}

SECTOR_PATTERN = (
    r"(?iU)\b(electricity|power|transport|mobility|industry|industrial|agriculture|agricultural"
    r"|lulucf|energy|sectoral targets)\b"
)

FLAG_PATTERNS = {
    "target": r"(?iu)net zero|carbon neutrality",
    "sector": SECTOR_PATTERN,
    "policy": r"(?iu)strategy|framework|law|policy|act",
    "efficiency": r"(?U)\b(efficiency|efficiencies|energy|energies|savings?|reduc(e|es|ed|ing))\b",
    "measure": r"(?iU)\b(target|goal|objective|reduce emissions by|save energy|%|percent)\b",
    "net_zero": r"(?iu)net zero",
    "scenario": r"(?iu)scenario",
    "grid": r"(?iu)electricity|power|grid|renewable energy",
    "pricing": r"(?iu)carbon (tax|pricing|trading|ETS|market)",
}

# Web addresses hold words that say nothing about the text around them.
IGNORED_IN_FLAGS = {"efficiency": r"https?://\S+"}

# The same words as terms, which one scan finds together.
LEXICON = Lexicon((
    *terms("target", ("net zero", "carbon neutrality")),
    *terms("sector", (
        "electricity", "power", "transport", "mobility", "industry", "industrial", "agriculture", "agricultural",
        "lulucf", "energy", "sectoral targets",
    ), whole=True),
    *terms("policy", ("strategy", "framework", "law", "policy", "act")),
    *terms("efficiency", (
        "efficiency", "efficiencies", "energy", "energies", "saving", "savings", "reduce", "reduces", "reduced", "reducing",
    ), whole=True, ignore_case=False, outside_links=True),
    *terms("measure", ("target", "goal", "objective", "reduce emissions by", "save energy", "%", "percent"), whole=True),
    *terms("net_zero", ("net zero",)),
    *terms("scenario", ("scenario",)),
    *terms("grid", ("electricity", "power", "grid", "renewable energy")),
    *terms("pricing", ("carbon tax", "carbon pricing", "carbon trading", "carbon ets", "carbon market")),
    *terms("negation", ("not", "never"), whole=True),
    Term("n't", ("negation",), ends=True),
    Term("n’t", ("negation",), ends=True),
))

NEGATION_PATTERN = r"(?iU)\b(not|never)\b|n['’]t\b"
NEGATION_NOTE = " (Note: negation present in sentence, which may weaken the claim.)"

CONFIDENCE_THRESHOLD = 0.7
LOW_CONFIDENCE = "low_confidence"
LOW_CONFIDENCE_TEXT = "Low semantic similarity."
QUOTE_CHARS = 300


@dataclass(frozen=True)
class Rule:
    """``answer`` for ``label`` if all flags in ``needs`` hold; earlier rules win."""

    label: str
    needs: tuple[str, ...]
    answer: str
    explanation: str


RULES = (
    Rule("net_zero_target", ("target",), "yes", "Mentions net zero target."),
    Rule("sector_targets", ("sector",), "yes", "Mentions sector-specific targets."),
    Rule(
        "efficiency_target", ("policy", "efficiency", "measure"), "yes",
        "Mentions energy efficiency law or strategy and sets an efficiency target.",
    ),
    Rule(
        "efficiency_target", ("policy", "efficiency"), "soft_yes",
        "Mentions energy efficiency law or strategy, but target is unclear or missing.",
    ),
    Rule(
        "efficiency_target", ("efficiency",), "soft_yes",
        "Mentions energy efficiency themes, but no clear policy or target.",
    ),
    Rule(
        "electricity_net_zero", ("net_zero", "scenario", "grid"), "soft_yes",
        "Only scenario-based evidence for net zero electricity.",
    ),
    Rule(
        "electricity_net_zero", ("net_zero", "grid"), "yes",
        "Mentions net zero electricity or decarbonised power sector.",
    ),
    Rule("carbon_pricing", ("pricing",), "yes", "Mentions carbon pricing mechanism."),
)


# --- tags -------------------------------------------------------------------


def _sorted_or_null(values: Column) -> Column:
    return let(F.array_sort(F.array_distinct(values)), lambda v: F.when(F.size(v) > 0, v))


def extract_years(
    text: Column,
    patterns: Sequence[str] = YEAR_PATTERNS,
    phrases: Mapping[str, str] = YEAR_PHRASES,
) -> Column:
    """Distinct years in order, null if none; ``phrases`` stand for a fixed year."""
    found = [F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in patterns]
    none = F.array().cast("array<string>")
    found += [
        F.when(text.rlike(p), F.array(F.lit(year))).otherwise(none) for p, year in phrases.items()
    ]
    return _sorted_or_null(F.concat(*found))


def extract_terms(text: Column, pattern: str = SECTOR_PATTERN) -> Column:
    """Distinct lexicon terms in the text, capitalised, in order; null if none."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return _sorted_or_null(F.transform(found, capitalize))


def flag_terms(
    text: Column,
    patterns: Mapping[str, str] = FLAG_PATTERNS,
    ignored: Mapping[str, str] = IGNORED_IN_FLAGS,
    policy_entity: Column | None = None,
) -> dict[str, Column]:
    """One boolean Column per pattern.

    ``policy_entity`` is an optional boolean from a user's own entity tagger; it
    sets the ``policy`` flag as well.
    """
    flags = {
        name: (F.regexp_replace(text, ignored[name], "") if name in ignored else text).rlike(p)
        for name, p in patterns.items()
    }
    if policy_entity is not None:
        flags["policy"] = flags["policy"] | F.coalesce(policy_entity, F.lit(False))
    return flags


# --- confidence, rules and notes --------------------------------------------


def confidence(question_vector: Column, answer_vector: Column) -> Column:
    """Unrounded similarity of question and answer; null if either is missing."""
    return cosine(question_vector, answer_vector)


def is_low_confidence(score: Column, threshold: float = CONFIDENCE_THRESHOLD) -> Column:
    """True below the threshold; a missing score lets the rules run."""
    return F.coalesce(score < threshold, F.lit(False))


def negated(text: Column, pattern: str = NEGATION_PATTERN) -> Column:
    return text.rlike(pattern)


def _first_match(label: Column, flags: Mapping[str, Column], rules: Sequence[Rule], field: str):
    chain = F
    for rule in rules:
        holds = reduce(lambda a, b: a & b, [flags[n] for n in rule.needs], label == rule.label)
        chain = chain.when(holds, getattr(rule, field))
    return chain


def tag_answers(
    answers: DataFrame,
    text: str = "answer_text",
    flag_patterns: Mapping[str, str] | None = None,
    ignored: Mapping[str, str] = IGNORED_IN_FLAGS,
    year_patterns: Sequence[str] = YEAR_PATTERNS,
    year_phrases: Mapping[str, str] = YEAR_PHRASES,
    term_pattern: str | None = None,
    negation_pattern: str | None = None,
    policy_entity: str | None = None,
    lexicon: Lexicon | None = LEXICON,
) -> DataFrame:
    """Append what the rules need to know of each text: ``flags`` (a struct of
    booleans), ``negated``, ``year``, ``sectors`` and ``quote``.

    One scan of the text finds all terms of the ``lexicon``: its marks are the flags, but ``sector``
    also lists the terms and ``negation`` is the negation.  A pattern that is given takes the place of the
    lexicon's marks (``flag_patterns`` of the same names, ``term_pattern``, ``negation_pattern``).
    A text that answers several questions is best tagged before it is repeated
    per label, without its text.
    """
    content = F.col(text)
    given = dict(flag_patterns or {})
    entity = F.col(policy_entity) if policy_entity else None
    if lexicon is None and not (given and term_pattern and negation_pattern):
        raise ValueError("without a lexicon all patterns must be given")
    names = [] if lexicon is None else dict.fromkeys(m for t in lexicon.terms for m in t.marks)
    if lexicon is not None:
        answers = answers.withColumn("_mask", lexicon.mask(content))
    mask = F.col("_mask")
    flags = {n: lexicon.marked(mask, n) for n in names if n != "negation" and n not in given}
    flags |= flag_terms(content, given, {n: p for n, p in ignored.items() if n in given})
    if entity is not None:
        flags["policy"] = flags["policy"] | F.coalesce(entity, F.lit(False))
    if term_pattern is not None:
        sectors = extract_terms(content, term_pattern)
    else:
        sectors = _sorted_or_null(F.transform(lexicon.listed(mask, "sector"), capitalize))
    tagged = answers.withColumns(
        {
            "flags": F.struct(*[c.alias(n) for n, c in flags.items()]),
            "negated": negated(content, negation_pattern) if negation_pattern else lexicon.marked(mask, "negation"),
            "year": extract_years(content, year_patterns, year_phrases),
            "sectors": sectors,
            "quote": F.left(content, F.lit(QUOTE_CHARS)),
        }
    )
    return tagged.drop("_mask")


def apply_rules(
    tagged: DataFrame,
    label: str = "label",
    score: str = "confidence",
    rules: Sequence[Rule] = RULES,
    threshold: float = CONFIDENCE_THRESHOLD,
) -> DataFrame:
    """Append ``yes_no`` and ``explanation``; ``score`` is rounded to four places.

    ``score`` comes as the unrounded similarity, on which the threshold acts.
    """
    known = {n: F.col(f"flags.{n}") for n in tagged.schema["flags"].dataType.fieldNames()}
    answer = _first_match(F.col(label), known, rules, "answer").otherwise("no")
    reason = _first_match(F.col(label), known, rules, "explanation")
    noted = F.when(
        F.col("negated") & answer.isin("yes", "soft_yes"), F.concat(reason, F.lit(NEGATION_NOTE))
    ).otherwise(reason)
    low = is_low_confidence(F.col(score), threshold)
    return tagged.withColumns(
        {
            "yes_no": F.when(low, LOW_CONFIDENCE).otherwise(answer),
            "explanation": F.when(low, LOW_CONFIDENCE_TEXT).otherwise(noted),
            score: fixed(F.col(score), 4).cast("double"),
        }
    ).drop("flags", "negated")


def classify(
    answers: DataFrame,
    text: str = "answer_text",
    label: str = "label",
    score: str = "confidence",
    rules: Sequence[Rule] = RULES,
    threshold: float = CONFIDENCE_THRESHOLD,
    **tag_options,
) -> DataFrame:
    """Predictions of rows of (label, text, score): tags, then rules.

    Row-local: projections without a shuffle.
    """
    return apply_rules(tag_answers(answers, text, **tag_options), label, score, rules, threshold)


# --- report blocks ----------------------------------------------------------


def _plain_markdown(line: Column) -> Column:
    """Text of a Markdown line: quote, heading, list and bold marks and escapes removed.

    As in rendering, heading and list marks count at the line start only, and a
    ``**`` with blanks on both sides is no bold mark.
    """
    unquoted = F.regexp_replace(line, "^ {0,3}> ?", "")
    unmarked = F.regexp_replace(unquoted, r"^(#{1,6}\s*|[-*+]\s+)", "")
    lone = F.regexp_replace(unmarked, r"(?<=^|\s)\*\*(?=\s|$)", "\x03")
    unbolded = F.regexp_replace(lone, r"\*\*(.+?)\*\*", "$1")
    kept = F.replace(unbolded, F.lit("\x03"), F.lit("**"))
    return F.replace(kept, F.lit("\\`"), F.lit("`"))


def answer_blocks(reports: DataFrame, key: Sequence[str] = ("country",), value: str = "value") -> DataFrame:
    """Question blocks of Markdown reports.

    ``(*key, block_no, question, header, evidence, answer_text, source_url)``: a
    ``###`` heading starts a block, the ``Source URL:`` line gives the first
    link, ``header`` is the answer line and ``evidence`` the quoted text.
    ``answer_text`` joins both, as the rules and quotes use it.
    """
    parts = drop_first(F.split(F.col(value), r"(?m)^### "))
    lines = F.split(F.col("_block"), r"\r?\n")
    plain = F.transform(drop_first(F.col("_lines")), lambda line: strip(_plain_markdown(line)))
    content = F.filter(
        "_plain",
        lambda s: (s != "") & ~s.rlike(r"^(-{3,}|\*{3,})$") & ~F.lower(s).startswith("source url:"),
    )
    source = F.filter("_plain", lambda s: F.lower(s).startswith("source url:"))
    # the text of a Markdown link, brackets in it and all, else a bare address
    said = F.array_join(source, "\n")
    linked = F.regexp_extract(said, r"\[(https?://\S+?)\]\(", 1)
    url = F.when(linked != "", linked).otherwise(F.regexp_extract(said, r"(https?://\S+)", 1))
    # one step per projection, so that no array is computed twice
    blocks = (
        reports.select(*key, F.posexplode(parts).alias("block_no", "_block"))
        .withColumn("_lines", lines)
        .withColumn("_plain", plain)
        .withColumn("_content", content)
        .withColumn("_first", F.get("_content", F.lit(0)))
        .withColumn("_url", url)
    )
    is_header = F.coalesce(F.lower("_first").startswith("answer/evidence"), F.lit(False))
    rest = drop_first(F.col("_content"))
    return blocks.select(
        *key,
        "block_no",
        strip(F.get("_lines", F.lit(0))).alias("question"),
        F.when(is_header, F.col("_first")).alias("header"),
        F.array_join(F.when(is_header, rest).otherwise(F.col("_content")), "\n").alias("evidence"),
        F.array_join("_content", "\n").alias("answer_text"),
        F.when(F.col("_url") != "", F.col("_url")).alias("source_url"),
    )


def attach_labels(blocks: DataFrame, labels: DataFrame, on: str = "block_no") -> DataFrame:
    """Label each block by its question's id; unknown ids drop out.

    The label table is small, and Spark broadcasts it if its size says so.
    """
    return blocks.join(labels, on)


# --- prediction pages and nested files --------------------------------------


def prediction_block(label: str = "label", **names: str) -> Column:
    """Markdown block of one prediction; year and sector lines only if present."""

    def field(name: str) -> Column:
        return F.col(names.get(name, name))

    def or_default(value: Column, default: str) -> Column:
        return F.coalesce(value.cast("string"), F.lit(default))

    return F.concat_ws(
        "\n\n",
        F.concat(F.lit("## "), label_title(F.col(label))),
        F.concat(F.lit("- **Answer**: `"), or_default(field("yes_no"), "N/A"), F.lit("`")),
        F.concat(F.lit("- **Explanation**: "), or_default(field("explanation"), "None")),
        F.concat(F.lit("- **Year(s)**: "), F.array_join(field("year"), ", ")),
        F.concat(F.lit("- **Sector(s)**: "), F.array_join(field("sectors"), ", ")),
        F.concat(F.lit("- **Confidence**: "), or_default(number_text(field("confidence"), 4), "None")),
        F.concat(F.lit("- **Source URL**: "), or_default(field("source_url"), "None")),
        F.concat(F.lit("> "), F.replace(F.coalesce(field("quote"), F.lit("")), F.lit("\n"), F.lit(" ")), F.lit("\n")),
    )


def country_pages(
    predictions: DataFrame,
    title: Column,
    labels: Sequence[str] = LABELS,
    country: str = "country",
) -> DataFrame:
    """``(country, page)``: blocks in label order below a heading.

    One row per (country, label), so a page gathers at most ``len(labels)`` blocks.
    """
    place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("label"))
    pages = (
        predictions.select(country, place.alias("_place"), prediction_block().alias("_block"))
        .groupBy(country)
        .agg(F.array_sort(F.collect_list(F.struct("_place", "_block"))).alias("_blocks"))
    )
    heading = F.concat(F.lit("# Policy Targets for "), title, F.lit("\n"))
    return pages.select(
        country, F.concat_ws("\n\n", heading, F.array_join("_blocks._block", "\n\n")).alias("page")
    )


def nest_predictions(predictions: DataFrame, country: str = "country", label: str = "label") -> DataFrame:
    """``(country, predictions map<label, struct>)``, one row per country.

    A file is one such object per line; there is never a single row that holds
    all countries.
    """
    fields = ["yes_no", "explanation", "year", "sectors", "quote", "confidence", "source_url"]
    entry = F.struct(F.col(label), F.struct(*fields).alias("prediction"))
    return predictions.groupBy(country).agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("predictions")
    )
