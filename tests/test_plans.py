"""Plan shapes that matter at scale: what is combined before an exchange, what is pruned."""

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_sums_combine_before_one_exchange(spark):
    for name in ("neighbour_sum", "rlc_class_sum", "olpc_class_sum", "relation_sum"):
        plan = plan_of(queries()[name](spark, SF))
        assert plan.count("Exchange") == 1 and "partial_sum" in plan, name
        assert "HashAggregate" in plan and "SortAggregate" not in plan, name


def test_merge_combines_before_the_exchange(spark):
    plan = plan_of(queries()["merge_last"](spark, SF))
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan


def test_only_used_columns_are_read_and_every_cell_is_kept(spark):
    plan = plan_of(queries()["project_configured"](spark, SF))
    assert "PushedFilters: [], ReadSchema" in plan and "props" not in plan


def test_types_prune_to_their_partition(spark):
    plan = plan_of(queries()["lte_nokia_report"](spark, SF))
    assert plan.count("(meas_type") >= 4 and "PartitionFilters: [isnotnull(meas_type" in plan
    assert "from_xml" not in plan


def test_findings_of_documents_need_no_exchange(spark):
    for name in ("umts_ericsson_wide_missing", "umts_ericsson_wide", "missing_counters_nokia", "elements_not_used", "unused_elements"):
        assert "Exchange" not in plan_of(queries()[name](spark, SF)), name


def test_a_task_holds_no_copy_of_a_document_for_every_step_of_its_merge(spark):
    plan = plan_of(queries()["umts_ericsson_wide_missing"](spark, SF))
    for step in ("objects", "ordered", "starts"):
        assert f" AS {step}#" not in plan, step


def test_what_a_file_lacks_is_united_before_the_exchange(spark):
    plan = plan_of(queries()["missing_counters_eric"](spark, SF))
    assert "partial_bit_or" in plan


def test_wide_reports_read_values_by_index(spark):
    plan = plan_of(queries()["umts_ericsson_wide"](spark, SF))
    assert "try_element_at" not in plan and "element_at(values" not in plan and "values" in plan


def test_no_cross_joins_and_no_python(spark):
    for name in ("lte_ericsson_report", "umts_ericsson_report", "missing_counters_eric", "array_length_issues",
                 "missing_counters_nokia", "unused_elements", "elements_not_used", "umts_nokia_report"):
        plan = plan_of(queries()[name](spark, SF))
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
            assert word not in plan, (name, word)
