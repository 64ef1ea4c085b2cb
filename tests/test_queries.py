"""Every registered query against its SQL on the smallest tables, and the inventory they must cover."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from verification.compare import compare, connect
from verification.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"

INVENTORY = """
read_pm_sequence read_pm_files stream_pm_files read_counter_catalog write_pm_report write_pm_summary write_pm_issues
eric_file_fields period_to_local hour_bucket nokia_file_fields nokia_period common_columns_eric common_columns_nokia
shred_mdc shred_3gpp detect_eric_dialect shred_nokia_lte shred_nokia_umts throughput_mo_filter explode_counters
canonical_counter
eric_cell_id_lte eric_cell_id_umts eric_relation cell_grain_filter nokia_lte_cell_id nokia_lte_plmn nokia_lte_cell_id_2
nokia_neighbour_target nokia_umts_cell_ids nokia_traffic_class
counter_kind report_columns neighbour_columns project_configured expand_pdf expand_comp expand_special relation_report
merge_last neighbour_sum rlc_class_sum olpc_class_sum relation_sum split_by_type
missing_counters_eric missing_counters_nokia array_length_issues dedupe_issues unused_elements elements_not_used
quarantine_bad_files
""".split()


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


def test_inventory_is_covered():
    assert set(INVENTORY) <= set(queries())
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) == set(ORACLE) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, name):
    assert compare(queries()[name](spark, SF), tables, oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry(spark).count() > 0
