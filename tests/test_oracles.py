"""Every registered query against its SQL statement, on the middle tables."""

import os

import pytest

import __spark_entry__ as entry_points
from tests import oracle
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf{os.environ.get('RANKFLOW_TEST_SF', '0.01')}"


@pytest.fixture(scope="module")
def duck():
    con = oracle.connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", list(entry_points.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    assert oracle.differences(result, duck, entry_points.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", list(entry_points.oracle_sql()))
def test_sql_finds_rows(duck, name):
    """A query whose result is empty would prove nothing."""
    sql = entry_points.oracle_sql()[name]
    assert duck.execute(f"SELECT count(*) FROM ({sql}) q").fetchone()[0] > 0


def test_forest_labels_every_unlabelled_document(spark, duck):
    predicted = entry_points.queries()["rf_predict"](spark, SF_DIR)
    unlabelled = duck.execute("SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)").fetchall()
    rows = predicted.collect()
    assert sorted(r.doc_id for r in rows) == sorted(d for (d,) in unlabelled)
    assert {r.quality for r in rows} <= {"0", "1"}


def test_flagship_entry(spark):
    assert entry_points.entry(spark).columns == ["id", "items"]


def test_stepwise_and_flagship_lists_agree(spark):
    steps = entry_points.queries()["ordered_lists"](spark, SF_DIR)
    once = entry_points.queries()["cascade_recommend"](spark, SF_DIR)
    assert sorted(map(tuple, steps.collect())) == sorted(map(tuple, once.collect()))
