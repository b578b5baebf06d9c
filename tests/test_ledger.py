"""Ledger documents, joins and retries."""

import json
from datetime import datetime

import pytest

from estate.operators import ledger, planning, reconcile
from estate.plans import tables as t
from estate.sources import documents, sinks

LEDGER = (
    "run_id string, path string, attempt int, status string, skipped boolean, error string, size_bytes bigint, "
    "event_ts timestamp_ntz, batch int"
)


def at(hour):
    return datetime(2024, 1, 1, hour)


def write(folder, name, content):
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content, indent=1), encoding="utf-8")


L1 = {
    "last_processed_index": 3,
    "results": {
        "success": [
            {"status": "success", "file": "a", "local_path": "/x/a"},
            {"status": "success", "path": "b", "file": "ignored", "skipped": True},
            {"status": "success", "path": "", "file": "c"},
            {"status": "success"},
        ],
        "failed": [{"status": "failed", "file": "d", "error": "404"}],
    },
}
L2 = {
    "completed_files": {"a": {"status": "completed", "size": 8485, "timestamp": 1754648717.1635153}},
    "failed_files_list": [{"path": "b", "error": "x", "timestamp": 1754648717.5, "batch": 4}],
}
L3 = {"completed_files": ["a", "b"], "failed_files": [{"file": "c", "error": "e", "timestamp": "2024-01-01T05:00:00"}]}
L4 = {"completed_batches": [1, 2], "last_batch": 2, "failed_files": [{"file": "c", "error": "e"}]}
L5 = {
    "results": {
        "success": [{"path": "a", "size": 5, "timestamp": "2024-01-01T05:00:00", "status": "success"}],
        "failed": [{"path": "b", "error": "gone", "timestamp": "2024-01-01T05:00:00Z", "status": "pending"}],
    }
}
L6 = {"error_count": 2, "failed_files": [{"path": "a", "error": "x"}, "b", {"path": "c"}]}


@pytest.mark.parametrize(
    "layout,doc,want",
    [
        ("L1", L1, {("a", "success", False, None), ("b", "success", True, None), ("c", "success", False, None), ("d", "failed", False, "404")}),
        ("L2", L2, {("a", "success", False, None), ("b", "failed", False, "x")}),
        ("L3", L3, {("a", "success", False, None), ("b", "success", False, None), ("c", "failed", False, "e")}),
        ("L4", L4, {("c", "failed", False, "e")}),
        ("L5", L5, {("a", "success", False, None), ("b", "pending", False, "gone")}),
        ("L6", L6, {("a", "failed", False, "x"), ("b", "failed", False, "Download failed"), ("c", "failed", False, None)}),
    ],
)
def test_layouts(spark, tmp_path, layout, doc, want):
    write(tmp_path, "one.json", doc)
    got = documents.read_ledger(spark, str(tmp_path), layout).collect()
    assert {(r.path, r.status, r.skipped, r.error) for r in got} == want
    assert {r.ledger_id for r in got} == {"one.json"}


def test_layout_values(spark, tmp_path):
    write(tmp_path, "two.json", L2)
    got = {r.path: r for r in documents.read_ledger(spark, str(tmp_path), "L2").collect()}
    assert got["a"].size_bytes == 8485 and got["b"].batch == 4
    assert got["a"].event_ts == datetime(2025, 8, 8, 10, 25, 17, 163515)
    docs = spark.read.schema(documents.LEDGER_LAYOUTS["L4"]).json(spark.sparkContext.parallelize([json.dumps(L4)]))
    from pyspark.sql import functions as F

    assert [r.batch for r in documents.ledger_batches(docs.withColumn("ledger_id", F.lit("x"))).collect()] == [1, 2]


def test_tolerant_reader(spark, tmp_path):
    text = json.dumps({"results": {"success": [{"file": "a"}], "failed": []}, "turbo_mode": True})
    write(tmp_path, "whole.json", text)
    write(tmp_path, "comma.json", text + ",\n")
    write(tmp_path, "brace.json", text[:-1] + " ,\r\n")
    write(tmp_path, "inner.json", text[:30])
    write(tmp_path, "words.json", "not json")
    write(tmp_path, "empty.json", "")
    got = {r.ledger_id: r for r in documents.read_ledger_tolerant(spark, str(tmp_path)).collect()}
    assert {k: r.is_corrupt for k, r in got.items() if k != "empty.json"} == {
        "whole.json": False,
        "comma.json": False,
        "brace.json": False,
        "inner.json": True,
        "words.json": True,
    }
    assert got["brace.json"].results.success[0].file == "a" and got["brace.json"].turbo_mode is True


def test_empty_text_is_corrupt(spark, rows):
    got = documents.parse_tolerant(rows([("e", ""), ("n", None)], "ledger_id string, value string")).collect()
    assert [r.is_corrupt for r in got] == [True, True]


def test_manifest_forms(spark, tmp_path):
    (tmp_path / "doc").mkdir()
    (tmp_path / "bare").mkdir()
    entry = {"id": "1", "name": "a.pdf", "path": "x/a.pdf", "download_url": "u", "size": 3}
    write(tmp_path / "doc", "m.json", {"files": [entry, entry], "site_id": "s", "total_files": 2})
    write(tmp_path / "bare", "m.json", [entry])
    whole = documents.read_manifest(spark, str(tmp_path / "doc")).collect()
    bare = documents.read_manifest(spark, str(tmp_path / "bare"), bare=True).collect()
    assert [(r.path, r.size, r.site_id) for r in whole] == [("x/a.pdf", 3, "s")] * 2
    assert [(r.path, r.size, r.site_id) for r in bare] == [("x/a.pdf", 3, None)]


def test_inventory_and_directories(spark, tmp_path):
    (tmp_path / "i").mkdir()
    (tmp_path / "d").mkdir()
    write(tmp_path / "i", "i.json", {"files": [{"relative_path": "a", "size_bytes": 4, "modified_time": 1.5}]})
    write(tmp_path / "d", "d.json", {"directories": ["F/a", "F/a/b"]})
    row = documents.read_inventory(spark, str(tmp_path / "i")).first()
    assert (row.relative_path, row.size_bytes, row.modified_ts) == ("a", 4, datetime(1970, 1, 1, 0, 0, 1, 500000))
    assert [r.directory for r in documents.read_directories(spark, str(tmp_path / "d")).collect()] == ["F/a", "F/a/b"]


def test_each_ledger_is_scanned_once_and_may_lack_a_part(spark, tmp_path):
    only_failed = {
        "L1": {"results": {"failed": [{"file": "a", "error": "x"}, None]}},
        "L2": {"failed_files_list": [{"path": "a", "error": "x"}]},
        "L3": {"failed_files": [{"file": "a", "error": "x"}]},
        "L4": {"failed_files": [{"file": "a", "error": "x"}]},
        "L5": {"results": {"failed": [{"path": "a", "error": "x"}]}},
        "L6": {"failed_files": ["a", None]},
    }
    only_done = {
        "L1": {"results": {"success": [{"file": "b", "size": 2}]}},
        "L2": {"completed_files": {"b": {"size": 2, "batch": 1}}},
        "L3": {"completed_files": ["b"]},
        "L5": {"results": {"success": [{"path": "b", "size": 2}]}},
    }
    for layout in documents.LEDGER_LAYOUTS:
        folder = tmp_path / layout
        folder.mkdir()
        write(folder, "one.json", only_failed[layout])
        write(folder, "empty.json", {})
        write(folder, "two.json", only_done.get(layout, {}))
        got = documents.read_ledger(spark, str(folder), layout)
        assert got._jdf.queryExecution().executedPlan().toString().count("FileScan json") == 1
        assert sorted((r.path, r.status) for r in got.collect()) == [("a", "failed"), *([("b", "success")] if layout in only_done else [])]


def test_resume_from_batches(spark, rows, tmp_path):
    write(tmp_path, "one.json", {"completed_batches": [1, 3, 3], "failed_files": []})
    files = rows([(f"f{i}", i) for i in range(7)], "relative_path string, size_bytes bigint")
    left = planning.resume_batches(files, documents.read_ledger_batches(spark, str(tmp_path)), batch_size=2)
    assert sorted((r.relative_path, r.batch) for r in left.collect()) == [("f2", 2), ("f3", 2), ("f6", 4)]


def test_remaining_and_done_make_the_inventory(spark, sf_dir):
    files, rows_ = t.files(spark, sf_dir), t.ledger(spark, sf_dir)
    left = {r[0] for r in reconcile.remaining_files(files, rows_).select("relative_path").collect()}
    done = {r[0] for r in reconcile.already_done(files, rows_).select("path").collect()}
    assert not left & done and left | done == {r[0] for r in files.select("relative_path").collect()}


def test_joins_meet_on_the_normalised_path_and_multiply_nothing(spark, rows):
    listed = "relative_path string, size_bytes bigint, modified_ts timestamp_ntz"
    files = rows([("x/a", 1, at(1)), ("x/b", 1, at(1)), ("x/c", 1, at(1))], listed)
    disk = rows([("x\\a", 9, at(1)), ("/x//a", 4, at(2)), ("x/b", 1, at(1)), ("x/d", 1, at(1))], listed)
    outcomes = rows([("r", "x\\a", 1, "success", False, None, 4, at(1), 1), ("r", "x//c", 1, "failed", False, "e", 0, at(1), 1)], LEDGER)
    manifest = rows([("i", "x\\a", "u", 4), ("j", "/x/c", "u", 5), ("j", "x/c", "u", 5)], "id string, path string, download_url string, size bigint")

    assert sorted(r.relative_path for r in reconcile.remaining_files(files, outcomes).collect()) == ["x/b", "x/c"]
    assert [r.path for r in reconcile.already_done(files, outcomes).collect()] == ["x/a"]
    matched = sorted((r.relative_path, r.match, r.disk_size) for r in reconcile.reconcile(outcomes, disk).collect())
    assert matched == [("x/a", "matched", 4), ("x/b", "missing_from_progress", 1), ("x/d", "missing_from_progress", 1)]
    known = sorted((r.path, r.in_progress, r.modified_ts) for r in reconcile.unify_registry(outcomes, disk).collect())
    assert known == [("x/a", True, at(2)), ("x/b", False, at(1)), ("x/d", False, at(1))]
    assert sorted(r.status for r in reconcile.rebuild_ledger(manifest, disk).collect()) == ["pending", "pending", "success"]
    assert [(r.path, r.id, r["size"]) for r in ledger.retry_plan(outcomes, manifest).collect()] == [("x//c", "j", 5)]
    retried = rows([("r", "x/c", 2, "success", False, None, 5, at(2), 1)], LEDGER)
    assert sorted((r.path, r.status) for r in ledger.merge_retry(outcomes, retried).collect()) == [("x/c", "success"), ("x\\a", "success")]
    plan = sorted((r.relative_path, r.action) for r in planning.sync_plan(files, disk).collect())
    assert plan == [("x/a", "skip"), ("x/b", "skip"), ("x/c", "create")]
    assert planning.manifest_scope(manifest, disk).first().ready_files == 1
    assert [r.id for r in planning.new_files(manifest, manifest.filter("id = 'j'").limit(1)).collect()] == ["i"]


def test_failed_files_stay_remaining(spark, rows):
    files = rows([("a", 1), ("b", 1), ("c", 1)], "relative_path string, size_bytes bigint")
    outcomes = rows([("r", "a", 1, "failed", False, "x", 0, at(1), 9), ("r", "b", 1, "success", False, None, 1, at(1), 1)], LEDGER)
    assert {r.relative_path for r in reconcile.remaining_files(files, outcomes).collect()} == {"a", "c"}


def test_dedupe_latest_has_no_ties(spark, rows):
    data = [
        ("r", "a", 1, "success", False, None, 5, at(1), 1),
        ("r", "a", 2, "failed", False, "x", 0, at(2), 1),
        ("r", "a", 2, "success", True, None, 5, at(2), 1),
        ("r", "b", 1, "success", None, None, None, None, 1),
    ]
    for order in (data, data[::-1]):
        got = {r.path: (r.status, r.attempt, r.skipped) for r in ledger.dedupe_latest(rows(order, LEDGER)).collect()}
        assert got == {"a": ("success", 2, True), "b": ("success", 1, None)}


def test_merge_retry_keeps_one_row_per_path_after_dedupe(spark, sf_dir):
    rows_ = t.ledger(spark, sf_dir)
    retried = ledger.failed(rows_).filter("batch < 3")
    merged = ledger.merge_retry(rows_, retried)
    latest = ledger.dedupe_latest(merged)
    assert latest.count() == latest.select("path").distinct().count() == rows_.select("path").distinct().count()


def test_append_ledger_is_idempotent(spark, rows, tmp_path):
    where = str(tmp_path / "ledger")
    first = rows([("r", "a", 1, "success", False, None, 5, at(1), 1), ("r", "b", 1, "failed", False, "x", 0, at(1), 2)], LEDGER)
    again = rows([("r", "b", 2, "success", False, None, 7, at(2), 2)], LEDGER)
    for part in (first, first, again):
        sinks.append_ledger(part, where, "one")
    back = spark.read.parquet(where)
    assert {(r.path, r.attempt, r.status) for r in back.collect()} == {("a", 1, "success"), ("b", 2, "success")}
    assert back.count() == 2
    more = rows([("r", "c", 1, "success", False, None, 7, at(2), 2)], LEDGER)
    for _ in range(2):
        sinks.append_ledger(more, where, "two")
    assert sorted(r.path for r in spark.read.parquet(where).collect()) == ["a", "b", "c"]


def test_whatever_is_no_success_is_still_to_be_done(spark, rows):
    data = [("r", p, 1, s, False, None, 5, at(1), 1) for p, s in zip("abcd", ("success", "pending", "failed", None))]
    open_ = rows(data, LEDGER)
    manifest = rows([("i", "b", "u", 1), ("i", "b", "u", 1), (None, "c", "", 2)], "id string, path string, download_url string, size bigint")
    plan = ledger.retry_plan(open_, manifest).collect()
    assert sorted(r.path for r in plan) == ["b", "c", "d"]
    retried = rows([("r", "c", 2, "success", False, None, 5, at(2), 1)], LEDGER)
    merged = ledger.merge_retry(open_, retried).collect()
    assert sorted((r.path, r.status or "") for r in merged) == [("a", "success"), ("b", "pending"), ("c", "success"), ("d", "")]
    assert {r.outcome: r.entries for r in ledger.status_counts(open_).collect()} == {"downloaded": 1, "failed": 3}


def test_backup_is_never_overwritten(spark, rows, tmp_path):
    one = rows([("r", "a", 1, "success", False, None, 5, at(1), 1)], LEDGER)
    sinks.backup_ledger(one, str(tmp_path), "s1")
    with pytest.raises(Exception, match="already exists"):
        sinks.backup_ledger(one, str(tmp_path), "s1")


def test_clear_failed_history(spark, rows):
    data = [("r", "a", 1, "success", False, None, 5, at(1), 1), ("r", "b", 1, "failed", False, "x", 0, at(1), 2)]
    kept, history = ledger.clear_failed(rows(data, LEDGER), "2024-01-02 00:00:00")
    assert [r.path for r in kept.collect()] == ["a"]
    assert history.first().asDict() == {
        "timestamp": datetime(2024, 1, 2),
        "action": "cleared_failed_status",
        "files_cleared": 1,
        "reason": "Prepare for retry",
    }


def test_freshness(spark, rows):
    data = [
        ("now", "s", "d", "f", "2024-01-02T00:00:00"),
        ("limit", "s", "d", "f", "2024-01-01T00:00:00Z"),
        ("old", "s", "d", "f", "2023-12-31T23:59:59"),
        ("none", "s", "d", "f", None),
        ("broken", "s", "d", "f", "soon"),
        ("other", "s", "x", "f", "2024-01-02T00:00:00"),
        ("missing", "s", "d", None, "2024-01-02T00:00:00"),
    ]
    df = rows(data, "k string, site_id string, drive_id string, folder_id string, timestamp string")
    got = {r.k: r.is_valid for r in ledger.freshness(df, "s", "d", "f", "2024-01-02 00:00:00").collect()}
    assert got == {"now": True, "limit": True, "old": False, "none": True, "broken": False, "other": False, "missing": False}


def test_retry_plan(spark, rows):
    outcomes = rows(
        [("r", p, 1, "failed", False, e, 0, at(1), 1) for p, e in (("a", "x"), ("b", "HTTP 401"), ("c", "401"), ("d", "x"), ("e", None))], LEDGER
    )
    manifest = rows(
        [("a", "1", "u", 5), ("b", "2", "u", 5), ("c", None, "u", 5), ("e", "5", "", 5)],
        "path string, id string, download_url string, size bigint",
    )
    got = {r.path: (r.action, r["size"]) for r in ledger.retry_plan(outcomes, manifest).collect()}
    assert got == {"a": ("retry_as_is", 5), "b": ("refresh_url", 5), "c": ("skip_no_id", 5), "d": ("skip_no_id", 0), "e": ("refresh_url", 5)}


def test_catalog_table(spark, sf_dir, tmp_path):
    from estate.operators import inventory

    catalog = inventory.build_catalog(t.files(spark, sf_dir), t.BASE, "2024-01-01", "library")
    ddl = sinks.write_catalog(catalog, str(tmp_path / "c"), table="estate_catalog_test")
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS estate_catalog_test (") and ddl.count("\n    ") == 15
    assert spark.table("estate_catalog_test").count() == catalog.count()
    spark.sql("DROP TABLE estate_catalog_test")
    assert [f.name for f in catalog.schema] == [f.name for f in spark.read.parquet(str(tmp_path / "c")).schema]


def test_retry_history(spark, rows):
    data = [("r", "a", 1, "success", False, None, 5, at(1), 1), ("r", "b", 1, "failed", False, "x", 0, at(1), 2)]
    row = ledger.retry_history(rows(data, LEDGER), "2024-01-02 00:00:00").first()
    assert row.asDict() == {"timestamp": datetime(2024, 1, 2), "attempted": 2, "successful": 1, "still_failed": 1}
    none = ledger.retry_summary(rows([], LEDGER)).first()
    assert (none.attempted, none.success_rate, none.recovered_bytes) == (0, 0.0, 0)
