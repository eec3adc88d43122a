"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from evidenza.plans.catalog import ORACLES, QUERIES
from tests.oracle import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert difference(spark, con, FOLDER, QUERIES[name], ORACLES[name]) is None


def test_projection_runs_whole(spark):
    assert set(QUERIES) - set(ORACLES) == {"pca_projection"}
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").count()
    assert QUERIES["pca_projection"](spark, FOLDER).count() == rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0
