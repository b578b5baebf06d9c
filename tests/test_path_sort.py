"""Joins on paths sort a column, not the derivation of a path, which would run again for every two rows compared."""

import re

import pytest

from estate.functions.paths import normalize_path
from estate.operators import ledger, planning, reconcile

FILES = "relative_path string, size_bytes bigint, modified_ts timestamp_ntz"
LEDGER = "run_id string, path string, attempt int, status string, error string, size_bytes bigint, event_ts timestamp_ntz"
LISTED = "id string, name string, path string, download_url string, size bigint"


@pytest.mark.parametrize("name", ["remaining", "done", "sync", "new", "retry", "merge", "rebuild"])
def test_no_join_sorts_by_the_derivation_of_a_path(spark, rows, name):
    files, outcomes, listed = rows([], FILES), rows([], LEDGER), rows([], LISTED)
    made = {
        "remaining": lambda: reconcile.remaining_files(files, outcomes),
        "done": lambda: reconcile.already_done(files, outcomes),
        "sync": lambda: planning.sync_plan(files, files),
        "new": lambda: planning.new_files(listed, listed),
        "retry": lambda: ledger.retry_plan(outcomes, listed),
        "merge": lambda: ledger.merge_retry(outcomes, outcomes),
        "rebuild": lambda: reconcile.rebuild_ledger(listed, files),
    }
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = made[name]()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    sorts = re.findall(r"Sort \[(.*)\], false", plan)
    assert sorts and not [x for x in sorts if "CASE" in x]
    assert "_key" not in made[name]().columns


def test_normalized_paths(spark, rows):
    given = ["/a/b", "a//b", "\\a\\\\b", "//a/", "/", "", "\\", "///", "a/b/", " /a", None]
    table = rows([(x,) for x in given], "p string").select("p", normalize_path("p").alias("q"))
    assert [r.q for r in table.collect()] == ["a/b", "a/b", "a/b", "a/", "", "", "", "", "a/b/", " /a", None]


def test_null_and_odd_paths_join_as_before(rows):
    files = rows([("x\\a", 1, None), (None, 2, None), ("/b//c", 3, None), ("b/c", 4, None), ("d", 5, None)], FILES)
    done = rows([("r", "x/a", 1, "success", None, 1, None), ("r", None, 1, "success", None, 1, None), ("r", "b\\c", 1, "success", None, 1, None)], LEDGER)
    assert sorted(r.size_bytes for r in reconcile.remaining_files(files, done).collect()) == [2, 5]
    assert sorted(r.size_bytes for r in reconcile.already_done(files, done).collect()) == [1, 3, 4]
    assert sorted((r.size_bytes, r.action) for r in planning.sync_plan(files, files.filter("size_bytes = 1")).collect()) == [(1, "skip"), (2, "create"), (3, "create"), (4, "create"), (5, "create")]
