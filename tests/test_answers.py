"""Rules with the real word lists, reports, evaluation and boxes on fixtures."""

import pytest
from pyspark.sql import functions as F

from evidenza.operators import boxes as B
from evidenza.operators import classify as C
from evidenza.operators import evaluate as V
from evidenza.operators import retrieve as R


def tags(spark, text):
    df = C.tag_answers(spark.createDataFrame([(text,)], "answer_text string"))
    return df.first()


@pytest.mark.parametrize(
    "text, years",
    [
        ("net zero by 2050", ["2050"]),
        ("carbon neutrality by mid-century", ["2050"]),
        ("by 20301", ["2030"]),
        ("IMF, 2020a", None),
        ("from 2035 to 2020, before 2035", ["2020", "2035"]),
        ("in 1990", None),
    ],
)
def test_years(spark, text, years):
    assert tags(spark, text).year == years


def test_sectors_and_flags(spark):
    row = tags(spark, "sectoral targets for Transport and LULUCF")
    assert row.sectors == ["Lulucf", "Sectoral targets", "Transport"]
    assert tags(spark, "the impact is small").flags.policy
    assert not tags(spark, "the effect is small").flags.policy
    assert tags(spark, "Carbon Neutrality").flags.target
    assert not tags(spark, "see https://example.org/energy/ there").flags.efficiency
    assert tags(spark, "x" * 400).quote == "x" * 300
    entity = spark.sql("SELECT 'nothing' answer_text, true law")
    assert C.tag_answers(entity, policy_entity="law").first().flags.policy


CASES = [
    ("net_zero_target", "net zero by 2050", "yes"),
    ("net_zero_target", "nothing here", "no"),
    ("sector_targets", "targets for industry", "yes"),
    ("efficiency_target", "energy efficiency law with a 20% target", "yes"),
    ("efficiency_target", "energy efficiency law", "soft_yes"),
    ("efficiency_target", "energy saving is common", "soft_yes"),
    ("electricity_net_zero", "net zero scenario for the power grid", "soft_yes"),
    ("electricity_net_zero", "net zero electricity", "yes"),
    ("electricity_net_zero", "net zero", "no"),
    ("carbon_pricing", "a carbon tax", "yes"),
    ("carbon_pricing", "cap and trade", "no"),
]


def test_rules(spark):
    rows = [(label, text, 0.9, want) for label, text, want in CASES]
    df = spark.createDataFrame(rows, "label string, answer_text string, confidence double, want string")
    for r in C.classify(df).collect():
        assert r.yes_no == r.want, r
        assert (r.explanation is None) == (r.want == "no")


def test_confidence_gate_and_negation(spark):
    text = "It does not have a net zero target"
    rows = [(0.6999, "low_confidence"), (0.70, "yes"), (None, "yes"), (0.69999999, "low_confidence")]
    df = spark.createDataFrame(
        [("net_zero_target", text, c, w) for c, w in rows],
        "label string, answer_text string, confidence double, want string",
    )
    for r in C.classify(df).collect():
        assert r.yes_no == r.want
        if r.yes_no == "yes":
            assert r.explanation == "Mentions net zero target." + C.NEGATION_NOTE
        else:
            assert r.explanation == "Low semantic similarity."
    assert tags(spark, "they don’t").negated and not tags(spark, "nothing notable").negated


# --- reports ----------------------------------------------------------------


def report_frames(spark):
    questions = spark.createDataFrame([(0, "First?"), (1, "Second?")], "question_id int, question string")
    countries = spark.createDataFrame(
        [("mexico", "Mexico"), ("gabon", "Gabon"), ("peru", "Peru")], "country string, country_name string"
    )
    evidence = spark.createDataFrame(
        [("mexico", 1, 0.125, "b `x`\ny", "https://example.org/b"), ("mexico", 0, 0.85081, "a", "https://example.org/a")],
        "country string, question_id int, score double, chunk string, source_url string",
    )
    chunked = spark.createDataFrame([("mexico",), ("mexico",), ("peru",)], "country string")
    return countries, evidence, questions, chunked


def test_reports_round_trip(spark):
    countries, evidence, questions, chunked = report_frames(spark)
    reports = {r.country: r.report for r in R.country_reports(countries, evidence, questions, chunked).collect()}
    assert reports["mexico"] == (
        "## Country: Mexico\n\n---\n"
        "### Question 1: First?\n\n**Answer/Evidence (Similarity: 0.8508):**\n> a\n\n"
        "**Source URL:** [https://example.org/a](https://example.org/a)\n\n---\n"
        "### Question 2: Second?\n\n**Answer/Evidence (Similarity: 0.1250):**\n> b \\`x\\` y\n\n"
        "**Source URL:** [https://example.org/b](https://example.org/b)\n\n---\n"
    )
    assert "No text chunks" in reports["gabon"] and "Failed to generate" in reports["peru"]
    frame = spark.createDataFrame(list(reports.items()), "country string, value string")
    blocks = C.answer_blocks(frame).orderBy("block_no").collect()
    assert [(b.country, b.block_no, b.question, b.evidence, b.source_url) for b in blocks] == [
        ("mexico", 0, "Question 1: First?", "a", "https://example.org/a"),
        ("mexico", 1, "Question 2: Second?", "b `x` y", "https://example.org/b"),
    ]
    assert blocks[0].answer_text == "Answer/Evidence (Similarity: 0.8508):\na"


def test_prediction_page(spark):
    rows = [
        ("mexico", "sector_targets", "yes", "Why.", ["2020", "2021"], ["Energy"], "line\nbreak", 0.8435, "https://example.org/a"),
        ("mexico", "net_zero_target", "no", None, None, None, "q", None, None),
    ]
    df = spark.createDataFrame(
        rows,
        "country string, label string, yes_no string, explanation string, year array<string>, sectors array<string>,"
        " quote string, confidence double, source_url string",
    )
    page = C.country_pages(df, F.initcap("country")).first().page
    assert page == (
        "# Policy Targets for Mexico\n\n\n## Net Zero Target\n\n- **Answer**: `no`\n\n- **Explanation**: None\n\n"
        "- **Confidence**: None\n\n- **Source URL**: None\n\n> q\n\n\n"
        "## Sector Targets\n\n- **Answer**: `yes`\n\n- **Explanation**: Why.\n\n- **Year(s)**: 2020, 2021\n\n"
        "- **Sector(s)**: Energy\n\n- **Confidence**: 0.8435\n\n- **Source URL**: https://example.org/a\n\n> line break\n"
    )
    back = V.page_confidences(spark.createDataFrame([("Mexico", page)], "country string, value string"))
    assert [tuple(r) for r in back.collect()] == [("Mexico", "sector_targets", 0.8435)]


def test_page_confidence_cases(spark):
    page = "# T\n\n## Net Zero Target\n\n* **Confidence**: 0.5\n> quote ## inner\n\n## Carbon Pricing\n- **Confidence**: 1.2.3\n"
    frame = spark.createDataFrame([("X", page), ("Y", "# only a heading")], "country string, value string")
    got = {tuple(r) for r in V.page_confidences(frame).collect()}
    assert got == {("X", "net_zero_target", 0.5), ("X", "carbon_pricing", 0.0)}


# --- evaluation -------------------------------------------------------------


def test_evaluate(spark):
    kind = "country string, label string, yes_no string"
    truth = spark.createDataFrame(
        [("a", "net_zero_target", "yes"), ("a", "carbon_pricing", "Soft_Yes"), ("b", "net_zero_target", "no"), ("z", "carbon_pricing", "yes")],
        kind,
    )
    found = spark.createDataFrame(
        [("a", "net_zero_target", "soft_yes"), ("b", "net_zero_target", "yes"), ("c", "net_zero_target", "yes")], kind
    )
    status = {r.country: r.status for r in V.align_countries(truth, found).collect()}
    assert status == {"a": "both", "b": "both", "z": "skipped", "c": "extra"}
    scores = V.evaluate(truth, found)
    by_key = {(r.level, r.label, r.country): r for r in scores.collect()}
    overall = by_key[("overall", None, None)]
    assert (overall.tp, overall.fp, overall.fn) == (1, 1, 1)
    assert (overall.precision, overall.recall, overall.f1) == (0.5, 0.5, 0.5)
    empty = by_key[("label", "sector_targets", None)]
    assert (empty.precision, empty.recall, empty.f1) == (0.0, 0.0, 0.0)
    for level in ("label", "country"):
        assert sum(r.tp + r.fn for k, r in by_key.items() if k[0] == level) == overall.tp + overall.fn
    lines = [r.line for r in V.summary_lines(scores).orderBy("block", "place", "name").collect()]
    assert lines[1] == "- **Precision:** 0.50\n- **Recall:** 0.50\n- **F1-score:** 0.50\n"
    assert "| net_zero_target        | 0.50     | 1.00  | 0.67    |" in lines
    assert "| a                | 1.00     | 0.50  | 0.67    |" in lines


def test_published_counts(spark):
    """Counts per label of nine evaluated countries give the recomputed overall F1 of 0.83."""
    counts = {
        "net_zero_target": (9, 0, 0), "sector_targets": (8, 1, 0), "efficiency_target": (7, 0, 1),
        "electricity_net_zero": (1, 0, 6), "carbon_pricing": (2, 0, 3),
    }
    cells = [
        ("x", label, *pair)
        for label, (tp, fp, fn) in counts.items()
        for pair in [(1, 1)] * tp + [(0, 1)] * fp + [(1, 0)] * fn
    ]
    scores = V.precision_recall_f1(spark.createDataFrame(cells, "country string, label string, y_true int, y_pred int"))
    rows = {(r.level, r.label): (round(r.precision, 2), round(r.recall, 2), round(r.f1, 2)) for r in scores.collect()}
    assert rows[("overall", None)] == (0.96, 0.73, 0.83)
    assert rows[("label", "electricity_net_zero")] == (1.0, 0.14, 0.25)
    assert rows[("label", "sector_targets")] == (0.89, 1.0, 0.94)


def test_template(spark):
    df = spark.createDataFrame([("a",), ("a",), ("",)], "country string")
    rows = {tuple(r) for r in V.truth_template(df).collect()}
    assert rows == {("a", label, "no") for label in C.LABELS}


def test_pivot(spark):
    df = spark.createDataFrame(
        [("u", "net_zero_target", 0.65), ("u", "carbon_pricing", 0.9), ("m", "net_zero_target", 0.8)],
        "country string, label string, confidence double",
    )
    wide = {r.country: r for r in V.confidence_pivot(df).collect()}
    assert wide["u"].net_zero_target == 0.65 and wide["m"].carbon_pricing == 0.0
    notes = [r.n for r in df.select(V.confidence_annotation(F.col("confidence")).alias("n")).collect()]
    assert sorted(notes) == ["0.65 🟥", "0.80", "0.90"]
    assert [tuple(r) for r in V.low_confidence_counts(df).collect()] == [("u", 1)]
    with pytest.raises(Exception, match="repeated cell"):
        V.confidence_pivot(df.union(df)).collect()


def test_projection(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    data = rng.normal(size=(40, 4)) * [5, 2, 1, 0.1]
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "k int, v array<double>")
    got = np.array([(r.pc1, r.pc2) for r in V.project_2d(df, "k", "v").orderBy("k").collect()])
    _, _, axes = np.linalg.svd(data - data.mean(0), full_matrices=False)
    for i in range(2):
        axis = axes[i] * np.sign(axes[i][abs(axes[i]).argmax()])
        assert np.allclose(got[:, i], (data - data.mean(0)) @ axis)
    assert V.project_2d(df.limit(1), "k", "v") is None


# --- boxes ------------------------------------------------------------------


def test_boxes(spark):
    rows = [
        ("mexico", "net_zero_target", "yes", "Why.", None, ["Energy"], "Answer/Evidence (Similarity: 0.8): x", "0.831", "https://example.org/a"),
        ("mexico", "sector_targets", "soft_yes", None, ["2020", "2030"], [], "good Similarity: 0.9", None, None),
        ("mexico", "carbon_pricing", "yes", "not asked", None, None, "q", "0.5", None),
        ("costa-rica", "net_zero_target", "no", None, None, None, "", "bad", None),
    ]
    predictions = spark.createDataFrame(
        rows,
        "country string, label string, yes_no string, explanation string, year array<string>, sectors array<string>,"
        " quote string, confidence string, source_url string",
    )
    names = spark.createDataFrame([(n,) for n in B.COUNTRY_NAMES], "name string")
    chosen = B.select_names(names, "Mexico, Costa Rica,Atlantis ,Kenya")
    assert B.select_names(names, " ALL ").count() == 42 and chosen.count() == 3
    asked = {"net_zero_target": "Has {country} a target?", "sector_targets": "Sectors of {country}?"}
    plain = B.with_keys(chosen, {})
    assert {r.name for r in B.unmatched_names(plain, predictions).collect()} == {"Costa Rica", "Kenya"}
    keyed = B.with_keys(chosen)
    assert {r.name for r in B.unmatched_names(keyed, predictions).collect()} == {"Kenya"}
    boxes = B.box_document(B.format_boxes(B.lookup_predictions(keyed, predictions, asked)), list(asked))
    got = [(r.name, r.label, r.box) for r in boxes.orderBy("name", "label_place").collect()]
    assert [g[:2] for g in got] == [
        ("Costa Rica", "net_zero_target"), ("Mexico", "net_zero_target"), ("Mexico", "sector_targets"),
    ]
    assert got[1][2] == (
        "\n### Mexico – Net Zero Target\n\n**Question:** Has Mexico a target?  \n**Answer:** ✅ Yes  \n"
        "**Explanation:** Why.  \n**Target Year(s):** N/A  \n**Sectors:** Energy\n\n**Quote:**  \n> No quote provided.\n\n"
        "**Confidence:** 83.1%  \n**Source:** [Link](https://example.org/a)\n"
    )
    assert "**Answer:** ❌ No  " in got[2][2] and "> good\n" in got[2][2] and "**Confidence:** N/A%" in got[2][2]
    assert "**Target Year(s):** 2020, 2030  " in got[2][2] and "[Link](#)" in got[2][2]
    assert "> No quote provided." in got[0][2] and "N/A%" in got[0][2]
