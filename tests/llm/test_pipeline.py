"""The pipeline's stages on corner cases, and every corpus query beside its SQL twin."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from evidenza.llm.queries import ORACLES, QUERIES
from tests.llm.test_documents import hits_by_hand, kept_by_hand, words_of
from tests.oracle import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
HERE = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@HERE
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert difference(spark, connect(FOLDER), FOLDER, QUERIES[name], ORACLES[name]) is None


@HERE
def test_held_out_languages(spark):
    rows = QUERIES["op1_language_crf"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet"), "doc_id")
    held = rows.where("held_out AND lang IS NOT NULL")
    assert held.where("lang = lang_pred").count() >= 0.95 * held.count() > 0


@pytest.fixture
def folder(spark, tmp_path):
    items = [(1, "noir dort sur la table de la cuisine et la souris"), (2, None)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("table", ["docs", "clashing", "nothing"])
def test_stages_keep_columns_and_decide(request, spark, folder, table):
    docs = request.getfixturevalue(table)
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.schema.names == docs.schema.names, name
        assert dict(out.dtypes) == dict(docs.dtypes), name
    language = [r.doc_id for r in corpus_pipeline.language(spark, docs, folder).collect()]
    assert len(language) == sum(any(c.isalpha() for c in t or "") for _, t in given)
    deduped = corpus_pipeline.line_dedup(spark, docs, folder).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in deduped) == sorted(
        (d or -1, t) for (d, t), n in kept_by_hand(docs).items() for _ in range(n)
    )
    assert all(r.n_chars == len(r.text) for r in deduped if r.text is not None)
    clean = corpus_pipeline.decontamination(spark, docs, folder).collect()
    items = [(1, "noir dort sur la table de la cuisine et la souris")]
    assert len(clean) == sum(hits_by_hand(t, items)[1] == 0 for _, t in given)
    assert corpus_pipeline.mixture(spark, docs, folder).count() == len(given)


def test_language_without_labels_keeps_texts_with_letters(spark):
    rows = [(1, "two clean texts"), (2, "of plain words"), (3, "1234 !!"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("lang", F.lit(None).cast("string"))
    assert sorted(r.doc_id for r in corpus_pipeline.language(spark, docs, "").collect()) == [1, 2]


def test_a_text_in_several_languages_stays(spark):
    words = {"en": "the house and garden of my brother", "fr": "le chat noir dort dans la maison", "de": "der hund und die katze schlafen"}
    rows = [(i, " ".join([t] * 4), lang) for i, (lang, t) in enumerate(words.items())]
    rows.append((9, " ".join(words.values()), None))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.language(spark, docs, "").collect()) == [0, 1, 2, 9]


def test_working_tables_go_with_their_run(spark, tmp_path):
    from evidenza.llm import storage

    with storage.scratch(spark):
        gone = storage.written(spark.range(3), "gone").inputFiles()[0]
        kept = storage.written(spark.range(4), "kept", kept=True)
        assert os.path.exists(gone.removeprefix("file://"))
    assert not os.path.exists(os.path.dirname(gone.removeprefix("file://"))) and kept.count() == 4


@HERE
def test_run_applies_every_stage(spark):
    found = corpus_pipeline.run(spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, map(tuple, docs.collect())))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert 0 < len(found) < len(texts) and all(r.size <= len(words_of(texts[r.doc_id])) for r in found)
