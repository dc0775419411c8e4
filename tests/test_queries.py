"""Every registered query against its SQL, on the usual and on the large-group paths."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry_module
from wearline import catalog

NAMES = list(catalog.QUERIES)
# Queries whose operators choose a way by measured size.
SIZED = [
    "agg_two_level", "alert_zone_counts", "boxplot_stats", "describe_numeric", "feature_engineering", "ffill_bfill",
    "impute_group_median", "matmul_coo", "oversample_minority", "rolling_sequences", "rul_test_truth",
    "preprocess_drop", "preprocess_median", "train_on_windows", "score_on_windows", "grid_search_cv", "window_position_stats", "sequence_index", "rolling_with_gaps", "sequences_with_gaps", "split_by_engine", "split_random", "src_positional_truth",
]


@pytest.fixture(scope="module")
def con(small):
    return compare.database(small)


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_sql(spark, con, small, name):
    assert compare.difference(spark, con, name, small) is None


@pytest.mark.parametrize("name", SIZED)
def test_agrees_with_sql_on_large_group_paths(spark, con, small, small_limits, name):
    assert compare.difference(spark, con, name, small) is None


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert [(r["pos"], r["Alert"], r["n"]) for r in rows] == [(1, "Critical", 0), (2, "Warning", 10), (3, "Safe", 5)]


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(NAMES) == set(catalog.ORACLES)
