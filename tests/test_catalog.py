"""Registered queries; ``check.py`` runs all of them, here a spread of quick ones."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from conftest import SMALL
from procwarden.plans import catalog

QUICK = [
    "io2_read_json", "io6_load_rules", "p01_fill_text", "p02_basename", "r04_regex", "r12_all_matches",
    "r15_dataset_columns", "r18_events_per_rule", "f01_parent_process_name", "f06_command_line_entropy",
    "f12_suspicious_argument_ratio", "f24_parent_child_pair_rarity", "f33_model_columns", "f35_apply_saved_encoder",
    "m04_forest_fit", "m05_forest_score", "m06_outlier_factor", "m07_boundary_score", "m11_ensemble",
    "u4_detect_full_ensemble", "m12_explain", "m13_score_summary", "c09_description", "u4_detect", "e08_roc", "e23_incident_row",
]


def test_keys():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) == set(catalog.CHECKS)


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("key", QUICK)
def test_against_sql(spark, con, key):
    assert compare(spark, con, key, SMALL) == "ok"


def test_entry(spark):
    df = entry.entry(spark)
    assert "final_verdict" in df.columns and df.count() == 1000
