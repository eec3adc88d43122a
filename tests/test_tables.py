"""Inserts, upserts, vectors and retrieval, with skewed and failing inputs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import Word2VecModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from evidenza.functions.encoders import HashingEncoder, encode_column, encode_rows
from evidenza.operators import embed as E
from evidenza.operators import ingest as I
from evidenza.operators import retrieve as R
from evidenza.operators.boxes import KEY_ALIASES
from evidenza.plans import evidence as plan
from evidenza.schemas import COUNTRIES, SECTIONS

NOW = "2024-06-01 12:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def test_insert_if_absent_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2), ("c", 5)], "k string, v int")
    once = I.insert_if_absent(old, new, ["k"], ["v"])
    twice = I.insert_if_absent(once, new, ["k"], ["v"])
    expected = {("a", 1), ("b", 2), ("c", 5)}
    assert {tuple(r) for r in once.collect()} == expected == {tuple(r) for r in twice.collect()}


def sections(spark, rows):
    return spark.createDataFrame(rows, SECTIONS)


def test_section_upsert(spark):
    old = sections(
        spark,
        [("u1", "m", "S", "same", [1.0], "en", None), ("u2", "m", "S", "old", [1.0], "en", None),
         ("u3", "m", "S", None, [1.0], "en", None), ("u4", "m", "S", "alone", [1.0], "es", None)],
    )
    new = sections(
        spark,
        [("u1", "x", "T", "same", None, None, None), ("u2", "x", "T", "new", None, None, None),
         ("u3", "x", "T", None, None, "de", None), ("u5", "p", "N", "fresh", None, None, None)],
    )
    merged = I.section_upsert(old, new, now())
    got = {r.section_url: r for r in merged.collect()}
    assert got["u1"].embedding == [1.0] and got["u1"].section_title == "T" and got["u1"].country_doc_id == "m"
    assert got["u2"].embedding is None and got["u2"].text_content == "new"
    assert got["u3"].embedding == [1.0] and got["u3"].language == "de"
    assert got["u4"].language == "es" and got["u4"].scraped_at is None
    assert got["u5"].country_doc_id == "p" and got["u5"].language == "en" and str(got["u5"].scraped_at) == NOW
    again = I.section_upsert(merged.select(*old.columns), new, now())
    assert sorted(map(repr, again.collect())) == sorted(map(repr, merged.collect()))


def test_small_batch_does_not_shuffle_the_stored_table(spark, tmp_path):
    stored, batch = str(tmp_path / "stored"), str(tmp_path / "batch")
    sections(spark, [(f"u{i}", "m", "S", "text", None, "en", None) for i in range(100)]).write.parquet(stored)
    sections(spark, [("u1", "m", "S", "new", None, "en", None), ("x", "m", "S", "new", None, "en", None)]).write.parquet(batch)
    merged = I.section_upsert(spark.read.parquet(stored), spark.read.parquet(batch), now())
    plan_text = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan_text
    # only the batch is dealt by key, to find its newest rows; no scan of the stored table is
    above = []
    for line in plan_text.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [(d, x) for d, x in above if d < depth] + [(depth, line)]
        if "FileScan" in line and "/stored" in line:
            assert not any("hashpartitioning" in x for _, x in above)
    assert merged.count() == 101 and merged.filter("text_content = 'new'").count() == 2


def test_last_version_in_a_batch_wins(spark):
    old = sections(spark, [("u1", "m", "S", "text one", [1.0], "en", None)])
    batch = spark.createDataFrame(
        [("u1", "m", "S", "text two", None, 1), ("u1", "m", "S", "text one", None, 2), ("u2", "m", "S", "b", None, 2), ("u2", "m", "S", "a", None, 1)],
        "section_url string, country_doc_id string, section_title string, text_content string, language string, at int",
    )
    got = {r.section_url: r for r in I.section_upsert(old, batch, now(), [F.col("at").desc()]).collect()}
    assert len(got) == 2 and I.section_upsert(old, batch, now(), [F.col("at").desc()]).count() == 2
    assert got["u1"].embedding == [1.0] and got["u2"].text_content == "b"
    found = I.classify_changes(old, batch, ["section_url"], ["text_content"], order=[F.col("at").desc()]).collect()
    assert [(r.section_url, r.action) for r in found] == [("u2", "insert")]


def test_country_upsert(spark):
    old = spark.createDataFrame([("m", "Mexiko", "u", "es", None, None)], COUNTRIES)
    new = spark.createDataFrame([("m", "Mexico", "u2", None, None, None), ("p", "Peru", "u3", None, None, None)], COUNTRIES)
    got = {r.doc_id: r for r in I.country_upsert(old, new, now()).collect()}
    assert (got["m"].country_name, got["m"].country_url, got["m"].language) == ("Mexico", "u2", "es")
    assert got["m"].created_at is None and str(got["m"].last_scraped_at) == NOW
    assert got["p"].language == "en" and str(got["p"].created_at) == NOW


def test_changes_ignore_audit_columns(spark):
    kind = "k string, v string, scraped_at string"
    old = spark.createDataFrame([("a", "1", "x"), ("b", None, "x"), ("c", "1", "x")], kind)
    new = spark.createDataFrame([("a", "1", "y"), ("b", "2", "y"), ("c", None, "x"), ("d", None, None)], kind)
    got = {(r.k, r.action, tuple(r.changed or ())) for r in I.classify_changes(old, new, ["k"], ["v", "scraped_at"]).collect()}
    assert got == {("b", "update", ("v",)), ("c", "update", ("v",)), ("d", "insert", ())}


def test_constraints_with_a_hot_orphan(spark):
    child = spark.range(3000).select(F.when(F.col("id") < 2000, 7).otherwise(1).alias("fk"), F.col("id").alias("k"))
    child = child.unionByName(spark.sql("SELECT cast(null as int) fk, 5L k"))
    parent = spark.sql("SELECT 1 id")
    got = {(r.constraint, r.column): r.violations for r in I.constraint_violations(child, ["fk", "k"], [["k"]], "fk", parent, "id").collect()}
    assert got == {("not_null", "fk"): 1, ("not_null", "k"): 0, ("unique", "k"): 1, ("foreign_key", "fk"): 2000}


# --- vectors ----------------------------------------------------------------


class Picky(HashingEncoder):
    """Fails on any text that holds the word ``poison``."""

    def encode_batch(self, texts):
        if any("poison" in t for t in texts):
            raise ValueError("poison")
        return super().encode_batch(texts)


def test_embed_pending_isolates_failures(spark):
    long = "a text that is long enough"
    rows = sections(
        spark,
        [("kept", "m", "S", long, [2.0], "en", None), ("null", "m", "S", None, None, "en", None),
         ("short", "m", "S", "  too short   " + " " * 20, None, "en", None), ("good", "m", "S", long, None, "en", None),
         ("bad", "m", "S", long + " poison", None, "en", None), ("other", "p", "S", long, None, "en", None)],
    )
    done = E.embed_pending(rows, Picky, 64, country="m")
    got = {r.section_url: r for r in done.collect()}
    assert {k: r.outcome for k, r in got.items()} == {
        "kept": "kept", "null": "zero", "short": "zero", "good": "embedded", "bad": "failed", "other": "kept",
    }
    assert got["kept"].embedding == [2.0] and got["null"].embedding == [0.0] * 64
    assert got["bad"].embedding is None and got["other"].embedding is None
    assert np.linalg.norm(got["good"].embedding) == pytest.approx(1.0, abs=1e-6)
    progress = {r.country_doc_id: r for r in E.embedding_progress(done).collect()}
    assert (progress["m"].n_sections, progress["m"].n_embedded, progress["m"].n_failed) == (5, 1, 1)
    assert {r.section_url for r in E.pending_sections(done, "m").collect()} == {"bad"}
    again = E.embed_pending(done.drop("outcome"), HashingEncoder, 64)
    assert {r.section_url for r in again.filter("outcome = 'embedded'").collect()} == {"bad", "other"}


def test_gate_reads_whole_texts(spark):
    df = spark.createDataFrame([("x" * 40000,), ("  " + "y" * 20,), ("y" * 19,)], "t string")
    lengths = [r.n for r in df.select(F.length(E.embedding_gate(F.col("t"))).alias("n")).collect()]
    assert lengths == [40000, 20, None]


def test_masked_mean_pool(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0], 1), ("a", [3.0, 6.0], 1), ("a", [9.0, 9.0], 0), ("b", [1.0, 1.0], 0)], "g string, embedding array<float>, mask int")
    assert {r.g: r.embedding for r in E.masked_mean_pool(df, ["g"]).collect()} == {"a": [2.0, 4.0], "b": [0.0, 0.0]}


def test_word_vectors(spark, tmp_path):
    words = ["energy", "policy", "target", "carbon"]
    rows = [(i, [words[(i + j) % 4] for j in range(6)] + (["rare"] if i == 0 else [])) for i in range(30)] + [(99, ["unseen"])]
    tokens = spark.createDataFrame(rows, "id int, tokens array<string>")
    model = E.fit_word_vectors(tokens, vector_size=8, min_count=5, partitions=1)
    vectors = {r.word: np.array(r.vector) for r in model.getVectors().collect()}
    assert set(vectors) == set(words)
    got = {r.id: r for r in E.word_vector_documents(tokens, model.getVectors(), ["id"]).collect()}
    expected = np.mean([vectors[w] for w in rows[0][1] if w in vectors], axis=0)
    assert got[0].n_words == 6 and np.allclose(got[0].document_vector, expected, atol=1e-6)
    assert got[99].document_vector is None
    path = E.save_word_vectors(model, str(tmp_path / "model"))
    E.save_word_vectors(model, path)
    assert Word2VecModel.load(path).getVectors().count() == 4


def test_word_vectors_move_once_per_block(spark):
    """Blocks change no mean; repeated keys, null keys and repeated words keep their meaning."""
    rng = np.random.default_rng(5)
    words = [f"w{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}" for i in range(100)]
    rows = [(i % 37, f"k{i % 3}", [words[j] for j in rng.integers(0, 100, int(rng.integers(0, 90)))] + ["unknown"]) for i in range(150)]
    rows += [(None, "k0", ["waa"]), (500, "k1", None), (501, "k1", []), (502, "k2", ["unknown", "unknown"])]
    tokens = spark.createDataFrame(rows, "id int, kind string, tokens array<string>")
    values = [(w, [float(x) for x in rng.integers(-9, 9, 3)]) for w in words] + [("waa", [1.0, 2.0, 3.0])]
    table = spark.createDataFrame(values, "word string, v array<double>").select("word", array_to_vector("v").alias("vector"))
    expected = {}
    for i, kind, found in rows:
        own = expected.setdefault((i, kind), [])
        own += [v for w in found or () if i is not None for x, v in values if x == w]
    for block_rows in (8192, 10):
        got = {(r.id, r.kind): r for r in E.word_vector_documents(tokens, table, ["id", "kind"], block_rows=block_rows).collect()}
        assert got.keys() == expected.keys()
        for at, own in expected.items():
            assert got[at].n_words == len(own)
            assert np.allclose(got[at].document_vector, np.mean(own, axis=0)) if own else got[at].document_vector is None
    batch = pa.RecordBatch.from_pydict({"b": [0, 1, 0], "t": [["x", "y", "x"], ["x"], ["y", "z"]]})
    asked = [(r["b"], r["word"]) for part in E._block_words("b", "t")(iter([batch, batch])) for r in part.to_pylist()]
    assert sorted(asked) == [(0, "x"), (0, "y"), (0, "z"), (1, "x")]


def test_words_are_found_once_per_text(spark):
    df = spark.createDataFrame([("Green energy--policy, the l'accord's end",), ("",), (None,)], "text string")
    rows = E.word_rows(df.select(E.word_tokens(F.col("text")).alias("tokens")))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert sorted(r.word for r in rows.collect()) == ["end", "energy", "green", "policy"]


# --- retrieval --------------------------------------------------------------


def brute_force(rows, questions, k):
    best = {}
    for g in {r[0] for r in rows}:
        for q, qv in questions:
            scored = []
            for group, i, v in rows:
                if group == g and v is not None:
                    a, b = np.array(v, dtype="float32").astype(float), np.array(qv, dtype="float32").astype(float)
                    n = np.linalg.norm(a) * np.linalg.norm(b)
                    scored.append((-round(float(a @ b / n), 9) if n else 0.0, i))
            for rank, (s, i) in enumerate(sorted(scored)[:k], 1):
                best[(g, q, rank)] = (i, round(-s, 6))
    return best


TILES = {"question_tiles": 3, "candidate_tiles": 2}


@pytest.mark.parametrize(
    "k, block, tiles", [(1, 512, {}), (3, 512, {}), (2, 2, {}), (1, 512, TILES), (3, 1, TILES), (2, 512, {"max_question_bytes": 300})]
)
def test_best_evidence_equals_brute_force(spark, k, block, tiles):
    rng = np.random.default_rng(5)
    # one group holds most rows, vectors repeat (ties), some are zero or missing
    base = rng.integers(-2, 3, size=(40, 6)).astype(float)
    rows = [("hot" if i % 5 else f"g{i % 3}", i, None if i % 17 == 0 else base[i % 40].tolist()) for i in range(600)]
    questions = [(q, rng.integers(-2, 3, size=6).astype(float).tolist()) for q in range(5)] + [(5, [0.0] * 6)]
    df = spark.createDataFrame(rows, "country string, chunk_idx int, embedding array<float>").repartition(7)
    qdf = spark.createDataFrame(questions, "question_id int, embedding array<float>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        found = R.best_evidence(df, qdf, k=k, question_block=block, **tiles).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    got = {(r.country, r.question_id, r["rank"]): (r.chunk_idx, round(r.score, 6)) for r in found}
    assert got == brute_force(rows, questions, k)


def test_no_pairs_and_no_full_rows_in_the_plan(spark):
    df = spark.range(100).select(F.lit("a").alias("country"), F.col("id").alias("chunk_idx"), F.array(F.lit(1.0).cast("float")).alias("embedding"))
    questions = spark.sql("SELECT 0 question_id, array(1f) embedding")
    text = R.best_evidence(df, questions)._jdf.queryExecution().toString()
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text
    assert "WindowGroupLimit" in text and "Partial" in text


def test_texts_are_not_dealt_by_country_alone(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(100).select(
            F.concat(F.lit("hot"), F.col("id") % 1).alias("country_doc_id"), F.col("id").cast("string").alias("section_url"), F.lit("T").alias("section_title"),
            F.lit("One sentence. Two sentences.").alias("text_content"),
        )
        countries = spark.createDataFrame([("hot0", "https://example.org/")], "doc_id string, country_url string")
        found = R.chunk_lineage(rows, countries)
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "hashpartitioning(country_doc_id" in text
        assert all("_part" in x for x in text.splitlines() if "hashpartitioning" in x)
        assert found.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_end_to_end(spark):
    questions = plan.question_table(spark)
    countries = spark.createDataFrame(
        [("mexico", "Mexico", "https://example.org/mexico/", "en", None, None), ("gabon", "Gabon", "https://example.org/gabon/", "en", None, None)],
        COUNTRIES,
    )
    text = (
        "The country has a net zero target. The net zero target is set for 2050. It is a law. "
        "There is a carbon tax. The carbon pricing mechanism is in place. It is a tax."
    )
    rows = sections(spark, [("https://example.org/mexico/t/", "mexico", "Targets", text, None, "en", None), ("https://example.org/gabon/", "gabon", "Summary", None, None, "en", None)])
    evidence = plan.find_evidence(rows, countries, questions)
    found = {r.question_id: r for r in evidence.collect()}
    assert set(found) == {0, 1, 2, 3, 4} and "net zero" in found[0].chunk
    assert found[0].source_url == "https://example.org/mexico/t/"
    assert plan.find_evidence(rows, countries, questions, country="gabon").count() == 0
    predictions = plan.predict(evidence, questions, threshold=0.1)
    by_label = {r.label: r for r in predictions.collect()}
    assert by_label["net_zero_target"].yes_no == "yes" and by_label["net_zero_target"].year == ["2050"]
    assert by_label["net_zero_target"].quote.startswith("Answer/Evidence (Similarity: 0.")
    names = spark.createDataFrame([("Mexico",)], "name string")
    boxes = plan.question_boxes(predictions, names, {"net_zero_target": "Has {country} a target?"}, KEY_ALIASES)
    assert boxes.count() == 1
    reports = R.country_reports(
        countries.withColumnRenamed("doc_id", "country"), evidence, questions
    )
    assert {r.country: r.report.count("### Question") for r in reports.collect()} == {"mexico": 5, "gabon": 0}


class Limited:
    """Length and number of vowels; takes ten characters at most."""

    max_chars = 10

    def encode_batch(self, texts):
        assert all(len(t) <= 10 for t in texts)
        return np.array([[len(t), sum(c in "aeiou" for c in t)] for t in texts], float)


def test_long_texts_are_encoded_in_windows():
    text = "abcde" * 5  # windows of 10, 10 and 5
    (vector,) = encode_rows(Limited(), [text])
    assert np.allclose(vector, [(100 + 100 + 25) / 25, (4 * 10 + 4 * 10 + 2 * 5) / 25])
    assert encode_rows(Limited(), [None, "", text])[0] is None


def test_candidates_are_encoded_once_for_any_number_of_questions(spark):
    calls = spark.sparkContext.accumulator(0)

    class Counted(HashingEncoder):
        def encode_batch(self, texts):
            calls.add(len(texts))
            return super().encode_batch(texts)

    rows = spark.createDataFrame([(f"c{i % 3}", i, f"some text {i}") for i in range(60)], "country string, chunk_idx int, t string")
    questions = spark.createDataFrame([(q, HashingEncoder().encode_batch([f"text {q}"])[0].tolist()) for q in range(7)], "question_id int, embedding array<float>")
    found = R.best_evidence(rows, questions, vector=None, text="t", encoder_factory=Counted, question_block=2).collect()
    assert len(found) == 21 and calls.value == 60
    calls = spark.sparkContext.accumulator(0)
    tiled = R.best_evidence(rows, questions, vector=None, text="t", encoder_factory=Counted, question_tiles=3, candidate_tiles=2)
    assert calls.value == 0  # nothing runs while the plan is built
    assert sorted(map(tuple, tiled.collect())) == sorted(map(tuple, found))


def test_no_chunk_text_is_moved_before_the_winners_are_known(spark):
    from evidenza.plans.evidence import find_evidence, question_table

    countries = spark.createDataFrame([("a", "http://a")], "doc_id string, country_url string")
    rows = [("a", "u1", "t", "One fact. Two facts. Three. Four net zero facts. Five."), ("a", None, "t", "Net zero by 2050."),
            ("a", "u1", "t", "Another text under the same address. More of it."), ("a", "u1", "t", "Net zero by 2050."), ("a", "u1", "t", "Net zero by 2050.")]
    sections = spark.createDataFrame(rows, "country_doc_id string, section_url string, section_title string, text_content string")
    found = find_evidence(sections, countries, question_table(spark), k=2)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window ["):]
    scorer = [line for line in window.splitlines() if "MapInArrow" in line]
    assert scorer and all("chunk#" not in line.split("], ")[0].replace("chunk_", "") for line in scorer)
    got = found.collect()
    assert len(got) == 10 and all(r.chunk for r in got)
    assert len({(r.question_id, r["rank"]) for r in got}) == 10


def test_encoder_gives_null_for_null(spark):
    df = spark.createDataFrame([("a b",), (None,)], "t string")
    got = [r.v for r in df.select(encode_column(F.col("t"), HashingEncoder).alias("v")).collect()]
    assert sum(x > 0 for x in got[0]) in (1, 2) and got[1] is None
