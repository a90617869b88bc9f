import pytest

import __spark_entry__ as entry
from compare import difference
from tidegrid.catalog import all_queries

SF = "/root/testdata/sf0.001"
# One of each kind; tests/compare.py runs them all.
CHECKED = [
    "regrid_hourly", "feature_table", "fill_seasonal_year", "cv_folds", "forecast_recursive",
    "duplicate_rows", "correlation_matrix", "run_labels", "registry_models", "apply_promotions",
    "registry_by_stage", "unregistered_top_runs", "problem_runs", "monitoring_report", "train_linear",
    "transform_new_text", "dotted_names", "encode_weather",
]


def test_every_query_has_sql():
    assert set(all_queries()) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_equal_to_sql(spark, name):
    assert difference(spark, SF, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
