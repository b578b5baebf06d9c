"""Physical plans: what must not be there at scale, and what must."""

import pytest

from estate.plans import queries

EAGER = {"append_ledger", "backup_ledger", "write_catalog", "write_report_json"}
BATCH = sorted(k for k in queries.queries() if not k.startswith("stream_") and k not in EAGER)


def plan(spark, key, sf_dir):
    return queries.queries()[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", BATCH)
def test_no_pairwise_joins(spark, sf_dir, key):
    text = plan(spark, key, sf_dir)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


TOP_N = "log_timeline recent_errors log_common_errors sample_migration largest_files recent_files top_types_by_size".split()


@pytest.mark.parametrize("key", TOP_N + ["top_types_by_count", "folder_distribution", "failure_classes_top", "sample_per_dir"])
def test_top_n_is_not_a_global_sort(spark, sf_dir, key):
    text = plan(spark, key, sf_dir)
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


@pytest.mark.parametrize("key", ["sample_per_dir", "top_dirs_per_depth"])
def test_hot_groups_are_cut_before_the_shuffle(spark, sf_dir, key):
    assert plan(spark, key, sf_dir).count("WindowGroupLimit") == 4


def test_no_window_over_all_rows(spark, sf_dir):
    text = plan(spark, "assign_batches", sf_dir)
    windows = [line for line in text.splitlines() if " Window [" in line]
    assert windows and all("], [_range#" in line for line in windows) and "SinglePartition" not in text


def test_large_ledgers_join_by_shuffle(spark, sf_dir):
    """Without a small side the resume join shuffles once per side and re-uses the distinct paths' partitioning."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, "remaining_files", sf_dir)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the side of the inventory by its normalised path, the other one only by the distinct paths
    assert text.count("Exchange hashpartitioning(regexp_replace(") == 1 and text.count("Exchange hashpartitioning(_done") == 1
    assert text.count("Exchange") == 4 and "Broadcast" not in text


def test_scans_read_only_what_they_need(spark, sf_dir):
    text = plan(spark, "by_document_type", sf_dir)
    assert "o_custkey" not in text and "o_comment" not in text
    assert "PushedFilters: [IsNotNull" in plan(spark, "remaining_files", sf_dir)
