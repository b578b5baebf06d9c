"""The stored ledger: one file however its path is written, no shuffle of what is laid out by path, whole after a crash."""

import uuid

import pytest

from estate.operators import ledger, reconcile
from estate.session import children, new_location
from estate.sources.path_ledger import PathLedger, store_files

SCHEMA = "run_id string, path string, attempt int, status string, skipped boolean, error string, size_bytes bigint, event_ts timestamp_ntz, batch int"


def outcome(path, status="success", second=0, attempt=1, run="r"):
    from datetime import datetime

    return (run, path, attempt, status, False, None, 5, datetime(2024, 1, 1, 0, 0, second), 0)


@pytest.fixture
def stored(spark, rows):
    made = PathLedger.create(spark, new_location(spark, "ledger"), rows([], SCHEMA).schema, buckets=4)
    made.append(rows([outcome("x\\a", second=1), outcome("/x//b", "failed", 2), outcome(None)], SCHEMA), "one")
    made.append(rows([outcome("x/a", "failed", 3), outcome("x/b", "failed", 1), outcome("x\\a", second=2)], SCHEMA), "two")
    return made


def seen(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_spellings_are_one_file(stored, rows):
    files = rows([("x/a", 5), ("x\\b", 6), ("x//c", 7)], "relative_path string, size_bytes bigint")
    for _ in range(3):
        assert seen(ledger.dedupe_latest(stored.rows()), "path", "status", "path_key") == [("x/a", "failed", "x/a"), ("x/b", "failed", "x/b")]
        assert seen(reconcile.remaining_files(files, stored.rows()), "relative_path") == [("x//c",), ("x\\b",)]  # x/a had a success
        assert seen(reconcile.already_done(files, stored.rows()), "path") == [("x/a",)]
        stored.compact()
    assert sum(r.entries for r in stored.rows().collect()) == 5 and stored.rows().count() == 3


def test_a_repeated_append_replaces_itself(stored, rows, spark):
    before = seen(stored.rows(), "path", "status", "entries")
    stored.append(rows([outcome("x/a", "failed", 3), outcome("x/b", "failed", 1), outcome("x\\a", second=2)], SCHEMA), "two")
    assert seen(stored.rows(), "path", "status", "entries") == before
    again = PathLedger.open(spark, stored.location)
    again.append(rows([("only/path", "success")], "path string, status string"), "three")
    assert ("only/path", "success", 1) in seen(again.rows(), "path", "status", "entries")
    with pytest.raises(ValueError):
        again.append(rows([], SCHEMA), "base")


def test_a_compaction_that_breaks_off_changes_nothing(stored, rows, monkeypatch):
    from estate.sources import path_ledger

    before = seen(stored.rows(), "path", "status", "entries")

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(path_ledger, "mark", broken)
    with pytest.raises(RuntimeError):
        stored.compact()
    assert stored.version() == 0 and seen(stored.rows(), "path", "status", "entries") == before
    monkeypatch.undo()
    stored.append(rows([outcome("new")], SCHEMA), "three")
    stored.compact()
    assert stored.version() == 1 and ("new", "success", 1) in seen(stored.rows(), "path", "status", "entries")
    stored.compact()
    stored.compact()
    assert [n for n in children(stored.spark, stored.location) if n.startswith("v")] == ["v2", "v2.done", "v3", "v3.done"]


def test_no_exchange_on_what_is_stored_by_path(spark, stored, rows):
    table = f"files_{uuid.uuid4().hex}"
    files = store_files(rows([("x/a", 5), ("x\\b", 6)], "relative_path string, size_bytes bigint"), table, "relative_path", 4, new_location(spark, "files"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan(ledger.dedupe_latest(stored.rows()))
        assert "Exchange" not in plan(reconcile.remaining_files(files, stored.rows()))
        loose = plan(reconcile.remaining_files(rows([("x/a", 5)], "relative_path string, size_bytes bigint"), stored.rows()))
        assert loose.count("Exchange hashpartitioning") == 1
        assert seen(reconcile.remaining_files(files, stored.rows()), "relative_path") == [("x\\b",)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql(f"DROP TABLE {table}")


def test_counts_go_by_file(rows):
    both = rows([outcome("a/b"), outcome("a\\b", second=1), outcome("/a//b", second=2)], SCHEMA)
    summary = ledger.run_summary(both, 2).first()
    assert summary.paths_done == 1 and not summary.complete and summary.remaining == 1
    assert ledger.ledger_quality(both).first().distinct_paths == 1
    assert seen(ledger.dedupe_latest(both), "path") == [("a/b",)]
