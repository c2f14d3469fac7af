"""Every registered query against its SQL answer, on whole tables."""

import pytest
from conftest import MEDIUM

import __spark_entry__ as entry_points
from compare import assert_same, connect

NO_ANSWER = {"churn_gbt_cv"}  # boosted trees; see test_tree_grid
QUERIES, ANSWERS = entry_points.QUERIES, entry_points.ORACLE_SQL


@pytest.fixture(scope="module")
def duck():
    return connect(MEDIUM)


def test_every_query_has_an_answer():
    assert set(QUERIES) - set(ANSWERS) == NO_ANSWER
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ANSWERS))
def test_matches_sql(spark, duck, name):
    assert_same(QUERIES[name](spark, MEDIUM).toPandas(), duck.execute(ANSWERS[name]).df())


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() == 15


def test_tree_grid_is_whole(spark):
    rows = QUERIES["churn_gbt_cv"](spark, MEDIUM).collect()
    assert len(rows) == 20 and all(r["n_folds"] == 5 and 0 <= r["mean_score"] <= 1 for r in rows)
