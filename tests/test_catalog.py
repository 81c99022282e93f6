"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import os

import pytest
from sql_check import compare, connect

import __spark_entry__ as entry_points
from wattloom.catalog import all_queries, all_sql

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")

ROWS_ONLY = {
    "m7_train_random_forest", "m8_train_boosted_trees", "m9_feature_importance", "m10_compare_feature_sets", "m11_predict",
    "m12_score_forecast", "m13_actual_vs_predicted", "k6_save_and_load_model", "x9_train_evaluate_export",
    "x10_screen_features", "x10_top_features", "x11_score_forecast",
}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_only_models_lack_sql():
    assert set(all_queries()) - set(all_sql()) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query_equals_sql(spark, duck, name):
    assert compare(all_queries()[name](spark, FOLDER), duck, all_sql()[name]) is None


@pytest.mark.parametrize("name", ["m13_actual_vs_predicted", "x11_score_forecast"])
def test_model_queries_run(spark, name):
    assert all_queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
    assert entry_points.queries().keys() >= all_queries().keys()
