"""Scans, hashes, copies, log lines and trees on real files."""

import hashlib
import os
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from estate.operators import hierarchy, logs, planning
from estate.sources import files, loglines, sinks


def make(root, tree):
    for rel, data in tree.items():
        path = root / rel
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)


TREE = {"a/x.PDF": b"12345", "a/b c/é.xls": b"", "top.txt": b"hello", "a/.hidden.pdf": b"no", "a/big.msg": b"z" * 5000, "a/_draft.pdf": b"d"}


def test_scan(spark, tmp_path):
    make(tmp_path, TREE)
    got = {r.relative_path: r.size_bytes for r in files.scan_files(spark, str(tmp_path)).collect()}
    assert got == {k: len(v) for k, v in TREE.items()}
    only = {r.relative_path for r in files.scan_files_filtered(spark, f"file://{tmp_path}").collect()}
    assert only == {"a/x.PDF", "a/b c/é.xls", "a/big.msg", "a/_draft.pdf"}
    every = {r.relative_path for r in files.scan_files_filtered(spark, str(tmp_path), transfer_types_only=False).collect()}
    assert every == only | {"top.txt"}
    os.utime(tmp_path / "top.txt", (1_700_000_000.25, 1_700_000_000.25))
    row = files.scan_files(spark, str(tmp_path)).filter("relative_path = 'top.txt'").first()
    assert row.modified_ts == datetime(2023, 11, 14, 22, 13, 20, 250000)


def test_checksum(spark, rows, tmp_path):
    make(tmp_path, TREE)
    listed = files.scan_files(spark, str(tmp_path)).select("relative_path").unionByName(rows([("gone.pdf",)], "relative_path string"))
    got = {r.relative_path: (r.checksum, r.error) for r in files.content_checksum(listed, str(tmp_path)).collect()}
    assert got.pop("gone.pdf")[0] is None
    assert got == {rel: (hashlib.md5(data).hexdigest(), None) for rel, data in TREE.items()}


def test_copy(spark, rows, tmp_path):
    make(tmp_path / "from", TREE)
    make(tmp_path / "to", {"top.txt": b"HELLO", "a/x.PDF": b"shorter or longer"})
    (tmp_path / "to" / "blocked").write_bytes(b"a file where a folder is needed")
    make(tmp_path / "from", {"blocked/y.pdf": b"y"})
    manifest = rows([(p,) for p in ["a/x.PDF", "a/b c/é.xls", "top.txt", "none.pdf", "blocked/y.pdf"]], "path string")
    first = files.copy_files(manifest, str(tmp_path / "from"), str(tmp_path / "to"), attempts=2, backoff_seconds=0.01, verify_md5=True)
    got = {r.path: r for r in first.collect()}
    assert {p: (r.status, r.skipped, r.attempt) for p, r in got.items() if p != "blocked/y.pdf"} == {
        "a/x.PDF": ("success", False, 1),
        "a/b c/é.xls": ("success", False, 1),
        "top.txt": ("success", False, 1),
        "none.pdf": ("failed", False, 0),
    }
    assert (got["blocked/y.pdf"].status, got["blocked/y.pdf"].attempt) == ("failed", 2) and got["blocked/y.pdf"].error
    assert (tmp_path / "to" / "a" / "x.PDF").read_bytes() == b"12345"
    assert got["a/x.PDF"].checksum == hashlib.md5(b"12345").hexdigest()
    assert not [p for p in (tmp_path / "to").rglob(".*")]
    again = files.copy_files(manifest, str(tmp_path / "from"), str(tmp_path / "to"), attempts=1, concurrency=3)
    assert {r.path: r.skipped for r in again.collect() if r.status == "success"} == {"a/x.PDF": True, "a/b c/é.xls": True, "top.txt": True}


def test_copy_in_parts(spark, rows, tmp_path):
    """Parts of large files are joined whole; parts of an earlier run of the same source are taken up, others are not; none stay."""
    big = bytes(range(256)) * 40
    make(tmp_path / "from", {"a/big.pdf": big, "a/small.pdf": b"s", "b/late.pdf": big[::-1], "c/kept.pdf": big, "c/grown.pdf": big + b"!", "d/same.pdf": big})
    make(tmp_path / "to", {"c/kept.pdf": b"old and never looked at", "d/same.pdf": bytes(len(big))})
    roots = (str(tmp_path / "from"), str(tmp_path / "to"))
    state = os.stat(tmp_path / "from/a/big.pdf")
    named = lambda name, at: f".{hashlib.md5(name.encode()).hexdigest()}.{len(big)}.{at}.1000.parts"
    left = bytes(1000)  # other bytes show which part is used
    make(tmp_path / "to", {f"a/{named('big.pdf', state.st_mtime_ns)}/3000": left, f"b/{named('late.pdf', 1)}/0": left})
    data = [("a/big.pdf", None, len(big)), ("a/small.pdf", "create", 1), ("b/late.pdf", "create", len(big)), ("c/kept.pdf", "skip", len(big))]
    data += [("c/grown.pdf", None, len(big)), ("d/same.pdf", "overwrite", len(big)), ("none.pdf", None, 5000), ("b/late.pdf", "create", len(big))]
    manifest = rows(data, "path string, action string, size_bytes bigint")
    got = files.copy_files(manifest, *roots, backoff_seconds=0.01, part_bytes=1000).collect()
    assert sorted((r.path, r.status, r.skipped) for r in got if r.path != "b/late.pdf") == [
        ("a/big.pdf", "success", False), ("a/small.pdf", "success", False), ("c/grown.pdf", "success", False), ("c/kept.pdf", "success", True),
        ("d/same.pdf", "success", False), ("none.pdf", "failed", False),
    ]
    assert [r.status for r in got if r.path == "b/late.pdf"] == ["success", "success"]
    read = lambda p: (tmp_path / "to" / p).read_bytes()
    assert read("a/big.pdf") == big[:3000] + left + big[4000:] and read("b/late.pdf") == big[::-1]
    assert read("c/kept.pdf").startswith(b"old") and read("c/grown.pdf") == big + b"!" and read("d/same.pdf") == big
    assert [p.parent.name for p in (tmp_path / "to").rglob("*.parts")] == ["b"]  # of the other state of the source
    checked = files.copy_files(manifest.filter("path = 'a/big.pdf'"), *roots, verify_md5=True, part_bytes=1000).collect()
    assert [(r.skipped, r.checksum) for r in checked] == [(False, hashlib.md5(big).hexdigest())] and read("a/big.pdf") == big
    assert files.copy_files(manifest.filter("false"), *roots).collect() == []


def test_work_is_dealt_by_bytes(spark, rows):
    """A file of half of all bytes is alone in its task, and small ones share the others."""
    sizes = [("m.big", 1 << 40)] + [(f"{k % 7}/{k:04}", 1 << 30) for k in range(1000)] + [("n", None), ("n", None), ("z", -5)]
    df = rows(sizes, "path string, size_bytes bigint")
    dealt = files.deal_by_bytes(df, "path", 8).withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r.path, r.size_bytes or 0) for r in dealt) == sorted((p, s or 0) for p, s in sizes)
    per_task = {}
    for r in dealt:
        per_task.setdefault(r.task, []).append(r.size_bytes or 0)
    alone = [v for v in per_task.values() if 1 << 40 in v]
    others = [sum(v) for v in per_task.values() if 1 << 40 not in v]
    share = (2000 << 30) / 8
    assert sum(alone[0]) < (1 << 40) + share and len(others) >= 4 and max(others) <= share * 1.05
    by_size = files.deal_by_bytes(df, "path", None, 100 << 30).rdd.getNumPartitions()
    assert by_size in (20, 21) and files.deal_by_bytes(df.filter("false"), "path").count() == 0
    assert files.deal_by_bytes(df.select("path"), "path", 3).rdd.getNumPartitions() == 3


def test_unreadable_entries_are_rows(spark, tmp_path, monkeypatch):
    """A link to itself cannot be read even by root; a folder that refuses is tried in this process."""
    make(tmp_path, TREE)
    os.symlink("loop.pdf", tmp_path / "a" / "loop.pdf")
    os.symlink("gone", tmp_path / "a" / "dangling.pdf")
    (tmp_path / "a" / os.fsdecode(b"caf\xe9.pdf")).write_bytes(b"latin")
    got = {r.relative_path: (r.size_bytes, r.error) for r in files.scan_files(spark, str(tmp_path), unreadable="rows").collect()}
    assert {p: s for p, (s, e) in got.items() if e is None} == {k: len(v) for k, v in TREE.items()}
    assert set(got) - set(TREE) == {"a/loop.pdf", "a/caf\ufffd.pdf"} and "symbolic links" in got["a/loop.pdf"][1]
    kept = files.scan_files_filtered(spark, str(tmp_path), unreadable="rows").filter("error is not null")
    assert kept.count() == 2
    with pytest.raises(Exception, match="loop.pdf|UTF-8"):
        files.scan_files(spark, str(tmp_path)).count()

    real = os.scandir
    monkeypatch.setattr(os, "scandir", lambda p: (_ for _ in ()).throw(PermissionError(13, "Permission denied", p)) if p.endswith("b c") else real(p))
    asked = [pa.RecordBatch.from_pydict({"relative_path": ["a/b c", "gone"]})]
    listed = [r for b in files._list_task(str(tmp_path), True)(iter(asked)) for r in b.to_pylist()]
    assert [(r["relative_path"], r["is_folder"], r["size_bytes"]) for r in listed] == [("a/b c", False, None)] and "Permission" in listed[0]["error"]
    with pytest.raises(PermissionError):
        list(files._list_task(str(tmp_path), False)(iter(asked)))


def test_a_flat_folder_is_listed_in_batches(spark, tmp_path):
    for k in range(2500):
        (tmp_path / f"{k}.pdf").touch()
    batches = list(files._list_task(str(tmp_path), False)(iter([pa.RecordBatch.from_pydict({"relative_path": [""]})])))
    assert [b.num_rows for b in batches] == [1000, 1000, 500]
    from pyarrow import fs

    plain = sorted(files._entries(fs.LocalFileSystem(), str(tmp_path), True))
    assert plain == sorted(files._local_entries(str(tmp_path), True)) and len(plain) == 2500
    assert files.scan_files(spark, str(tmp_path)).count() == 2500


@pytest.mark.parametrize("max_bytes", ["134217728", "3000"])
def test_log_line_numbers_over_blocks(spark, tmp_path, max_bytes):
    """The numbers do not depend on how a file is cut into blocks."""
    one = [f"2024-01-01 00:00:{i % 60:02},000 - INFO - line {i}" if i % 7 else "   " for i in range(1, 401)]
    (tmp_path / "one.log").write_text("\n".join(one) + "\n", encoding="utf-8")
    (tmp_path / "two.log").write_text("\n\nlast without newline", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", max_bytes)
    try:
        lines = loglines.read_log_lines(spark, str(tmp_path / "*.log")).collect()
        plain = loglines.read_log_lines(spark, str(tmp_path / "*.log"), line_numbers=False).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {(r.file.rsplit("/", 1)[1], r.line_number): r.raw_line for r in lines}
    want = {("one.log", i): text for i, text in enumerate(one, 1) if text.strip()}
    want[("two.log", 3)] = "last without newline"
    assert got == want and plain == len(want)


def test_log_lines_are_not_copied_and_a_new_split_is_an_error(spark, tmp_path, monkeypatch):
    (tmp_path / "one.log").write_text("".join(f"line {i} {'x' * 80}\n" for i in range(2000)))
    written = []
    durable = loglines.durable
    monkeypatch.setattr(loglines, "durable", lambda df: written.append(df.columns) or durable(df))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        lines = loglines.read_log_lines(spark, str(tmp_path))
        assert lines.count() == 2000 and written == [["file", "_block", "_length", "_first", "_rows", "_before"]]
        assert lines.filter("cast(split(raw_line, ' ')[1] as int) + 1 <> line_number").count() == 0
        spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
        with pytest.raises(Exception, match="split otherwise"):
            lines.select("raw_line", "line_number", "file").filter("line_number > 0").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_log_analysis(spark, rows):
    lines = [
        ("old.log", 1, "2024-01-01 10:00:00,000 - INFO - 🔥 TURBO Progress: 10/100 (10.0%) - 3 new downloads"),
        ("old.log", 2, "2024-01-01 11:00:00,000 - ERROR - ❌ Attempt 1 failed for a/b.pdf: 404 Client Error: Not Found for url: https://h/x"),
        ("new.log", 1, "2024-01-02 10:30:00,000 - INFO - 🔥 TURBO Progress: 1200/5000 (24.0%) - 3 new downloads"),
        ("new.log", 2, "2024-01-02 10:31:00,000 - INFO - ✅ Downloaded: a/c.pdf"),
        ("new.log", 3, "no time, but Failed"),
    ]
    df = rows(lines, "file string, line_number bigint, raw_line string")
    events, fields = logs.parse_log(df), logs.parse_log_fields(df)
    latest = logs.log_performance(fields).first()
    assert (latest.files_processed, latest.total_files, latest.current_progress) == (1200, 5000, 24.0)
    assert {r.error_class: r.errors for r in logs.log_errors(fields).collect()} == {"Other": 2}
    exact = logs.parse_log_fields(df, failed_mode="first_colon")
    assert {r.error_class: r.errors for r in logs.log_errors(exact).collect()} == {"File Not Found": 1, "Other": 1}
    row = exact.filter("event_type = 'download_failed'").first()
    assert (row.file_path, row.error_type) == ("a/b.pdf", "Attempt 1")
    assert {r.hour: r.downloads for r in logs.log_hourly(events).collect()} == {"10:00": 1}
    assert [r.event_ts for r in logs.recent_errors(events).collect()] == [datetime(2024, 1, 1, 11)]
    timeline = logs.log_timeline(events).collect()
    assert [r.summary for r in timeline] == [
        "Progress: 10.0% (10/100)",
        "Failed: b.pdf: 404 Client Error: Not Found for url - Attempt 1",
        "Progress: 24.0% (1,200/5,000)",
        "Downloaded: c.pdf",
    ]
    empty = logs.log_performance(fields.filter("false")).first()
    assert (empty.speed_samples, empty.avg_speed, empty.total_files) == (0, None, None)


ITEMS = [
    (1, 0, "A", True),
    (2, 1, "B", True),
    (3, 2, "deep.pdf", False),
    (4, 1, "Forms", True),
    (5, 4, "skipped.pdf", False),
    (6, 4, "Below", True),
    (7, 6, "also.pdf", False),
    (8, 0, "root.pdf", False),
    (9, 99, "orphan.pdf", False),
]
ITEM = "id bigint, parent_id bigint, name string, is_folder boolean"


def test_flatten_hierarchy(spark, rows):
    items = rows(ITEMS, ITEM)
    assert {r.path for r in hierarchy.flatten_hierarchy(items, 0).collect()} == {"A/B/deep.pdf", "root.pdf"}
    every = {r.path for r in hierarchy.flatten_hierarchy(items, 0, skip=None).collect()}
    assert every == {"A/B/deep.pdf", "root.pdf", "A/Forms/skipped.pdf", "A/Forms/Below/also.pdf"}


def test_cycle_is_reported(spark, rows):
    loop = rows([(1, 0, "a", True), (2, 1, "b", True), (1, 2, "a", True)], ITEM)
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.folder_paths(loop, 0)


def test_deep_trees_take_few_rounds(spark, rows, monkeypatch):
    """600 levels in ten rounds, a cycle apart from the root is found, and so is a chain that leads into one."""
    written = []
    durable = hierarchy.durable
    monkeypatch.setattr(hierarchy, "durable", lambda df: written.append(1) or durable(df))
    chain = [(k, k - 1, f"d{k}", True) for k in range(1, 601)] + [(1000, 999, "lost", True), (1001, 1000, "below", True), (2000, 5, "side", True)]
    found = {r.id: (r.path, r.depth) for r in hierarchy.folder_paths(rows(chain, ITEM), 0).collect()}
    assert len(written) <= 12 and set(found) == {*range(1, 601), 2000}
    assert all(found[k] == ("/".join(f"d{j}" for j in range(1, k + 1)), k) for k in range(1, 601))
    assert found[2000] == ("d1/d2/d3/d4/d5/side", 6)
    apart = [(1, 0, "a", True), (2, 4, "b", True), (3, 2, "c", True), (4, 3, "d", True), (5, 4, "e", True), (6, 5, "f", True)]
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.folder_paths(rows(apart, ITEM), 0)
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.folder_paths(rows([(1, 1, "a", True)], ITEM), 0)
    twice = [(1, 0, "a", True), (1, 0, "a", True), (2, 1, "b", True)]
    assert sorted(r.path for r in hierarchy.folder_paths(rows(twice, ITEM), 0).collect()) == ["a", "a", "a/b", "a/b"]
    assert hierarchy.folder_paths(rows([], ITEM), 0).count() == 0


def test_nameless_folder_is_kept(spark, rows):
    items = rows([(1, 0, None, True), (2, 1, "b", True), (3, 2, "f.pdf", False)], ITEM)
    assert [r.path for r in hierarchy.flatten_hierarchy(items, 0).collect()] == ["b/f.pdf"]


def test_missing_root_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="nowhere"):
        files.scan_files(spark, str(tmp_path / "nowhere")).count()


def test_copy_of_changed_file_and_impossible_name(spark, rows, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "t").mkdir()
    (tmp_path / "s" / "a.txt").write_text("new")
    (tmp_path / "t" / "a.txt").write_text("old")
    listed, roots = rows([("a.txt",), ("x" * 300,)], "path string"), (str(tmp_path / "s"), str(tmp_path / "t"))
    plain = {r.path[:5]: (r.status, r.skipped) for r in files.copy_files(listed, *roots).collect()}
    assert plain == {"a.txt": ("success", True), "xxxxx": ("failed", False)}
    checked = {r.path[:5]: (r.status, r.skipped) for r in files.copy_files(listed, *roots, verify_md5=True).collect()}
    assert checked["a.txt"] == ("success", False) and (tmp_path / "t" / "a.txt").read_text() == "new"
    assert not any(r.skipped for r in files.copy_files(listed, *roots, overwrite=True).collect())


def test_resolve_folder(spark, rows):
    asked = rows([("/A/B/",), ("A",), ("a",), ("/",), ("A/none",)], "folder_path string")
    got = {r.folder_path: (r.folder_id, r.found) for r in hierarchy.resolve_folder(asked, rows(ITEMS, ITEM), 0).collect()}
    assert got == {"/A/B/": (2, True), "A": (1, True), "a": (None, False), "/": (0, True), "A/none": (None, False)}


def test_estimate_golden(spark, rows):
    """A known estate: 376,888 files of 240.9575127530843 GB."""
    size = round(240.9575127530843 * 1024**3)
    got = planning.estimate_from_totals(rows([(376888, size, 0)], "file_count bigint, total_bytes bigint, archive_bytes bigint")).first()
    assert (got.duration_hours, got.monthly_cost_label, got.batch_size) == (24.095751, "$5.54/month", 1000)


def test_report_json(spark, rows):
    df = rows([(1, datetime(2024, 1, 2, 3, 4, 5))], "n int, at timestamp_ntz")
    assert sinks.report_json(df).first().report == '{"n":1,"at":"2024-01-02T03:04:05"}'
