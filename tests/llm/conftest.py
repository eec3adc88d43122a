import pytest

from tests.conftest import spark  # noqa: F401

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "word%d and more of the same prose, " * 40


def texts() -> list[tuple]:
    """Nulls, empty and long texts, ties, repeated rows, and near copies."""
    rows = []
    base = "the quick brown fox jumps over the lazy dog near the river bank while birds sing in the tall green trees"
    for i in range(12):
        rows.append((i, f"{base}\nunique line number {i} " + "x" * i, "en", "a", 1))
    for i in range(12, 18):
        rows.append((i, "le chat noir dort sur la table de la cuisine et la souris mange le fromage", "fr", "b", 2))
    rows += [
        (20, None, None, None, None), (21, "", "en", "a", 0), (22, " \t\n\x0b ", "fr", None, 5), (23, "1234 5678 !!", "en", "b", 3),
        (24, " ".join(f"tok{j} of some long and winding text" for j in range(4000)), "en", "c", 9),
        (25, "BASE " + base.upper(), "en", "a", 4), (25, "BASE " + base.upper(), "en", "a", 4),
        (None, base, "en", "a", 1), (None, "no id here at all", "en", None, 1),
        (26, "éà ü ñ 漢字 текст 🙂 mixed", "fr", "b", 7),
    ]
    shared = "a line that is long enough to be judged as shared boilerplate"
    for i in range(30, 38):
        rows.append((i, f"first of {i}\n  {shared.upper() if i % 2 else shared}\t\nlast of {i}\n{shared}", "en", "d", 1))
    return rows


@pytest.fixture(scope="session")
def docs(spark):  # noqa: F811
    return spark.createDataFrame(texts(), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def clashing(docs):
    """Extra columns named like the operators' own."""
    names = ("fp", "node", "component_id", "row", "found", "bitmap", "size", "target", "digest", "d", "k", "start", "block", "text_key")
    from pyspark.sql import functions as F

    return docs.withColumns({n: F.lit("other") for n in names})


@pytest.fixture(scope="session")
def nothing(spark):  # noqa: F811
    return spark.createDataFrame([], SCHEMA)
