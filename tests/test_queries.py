"""Every named query against its SQL twin on the smallest tables."""

from __future__ import annotations

import os

import pytest

import compare
from __spark_entry__ import SMOKE_DIR, entry
from adlift.plans.oracle import statements
from adlift.plans.queries import registered as queries

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="test tables not present")

ORACLE = statements()
# These train 120 trees; the model tests cover them with a few.
SLOW = {"propensity_scores", "propensity_metrics", "score_requests"}
CHECKED_SLOWLY = {"propensity_checks", "score_request_checks"}


@pytest.fixture(scope="module")
def con():
    return compare.connect(SMOKE_DIR)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - CHECKED_SLOWLY))
def test_query_matches_sql(spark, con, name):
    assert compare.difference(queries()[name](spark, SMOKE_DIR), con, ORACLE[name]) == ""


def test_queries_without_sql(spark):
    assert set(queries()) - set(ORACLE) == SLOW | {"creative_decisions_thompson"}
    assert queries()["creative_decisions_thompson"](spark, SMOKE_DIR).count() == 188


def test_entry(spark):
    assert entry(spark).count() == 2


def test_model_matrix_is_written_once(spark):
    """Split, fit and scores read the written matrix, whose rows are those of the point-in-time set."""
    from adlift.operators.features import training_matrix
    from adlift.plans import queries as named
    from adlift.plans.medallion import layers

    rows = named._model_rows(spark, SMOKE_DIR)
    assert rows.inputFiles() and all("/propensity_matrix/" in f for f in rows.inputFiles())
    want = training_matrix(named._training_in_time(layers(spark, SMOKE_DIR)))
    got = rows.drop("is_test")
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
