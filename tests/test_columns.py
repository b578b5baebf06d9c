"""Scalar rules on their edge values."""

from datetime import datetime, timedelta
from urllib.parse import quote

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from estate.functions import classify, loglines, measures, paths, rules


def values(spark, data, column, kind="string"):
    """Evaluate a column over ``x`` in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {kind}")
    return [r.y for r in df.select("i", column.alias("y")).orderBy("i").collect()]


def test_extension(spark):
    names = ["a.PDF", ".bashrc", ".a.b", "a..b", "a.", "noext", "a.b.c", "..x", "", None]
    assert values(spark, names, paths.extension("x")) == [".pdf", "", ".b", ".b", "", "", ".c", "", "", None]


def test_paths(spark):
    data = ["a/b/c.pdf", "c.pdf", "a/b/", None]
    assert values(spark, data, paths.parent_dir("x")) == ["a/b", ".", "a/b", None]
    assert values(spark, data, paths.top_folder("x")) == ["a", None, "a", None]
    assert values(spark, data, paths.depth("x")) == [2, 0, 2, None]
    raw = ["\\a\\\\b//c", "/a/b/", "a", "//", None]
    assert values(spark, raw, paths.normalize_path("x")) == ["a/b/c", "a/b/", "a", "", None]
    assert values(spark, raw, paths.normalize_path("x", url=True)) == ["a/b/c", "a/b", "a", "", None]


def test_prefixes(spark):
    got = values(spark, ["F/a/b", "F", "F/a"], paths.path_prefixes("x", 2))
    assert got == [["F/a", "F/a/b"], [], ["F/a"]]


SAMPLE_URIS = ["a b/c+d*e~f/é#g&h%i[j]?k=l", "plain/path.pdf", "tab\tand\"quote", "日本/ß"]


def test_encode_target_uri(spark):
    assert values(spark, SAMPLE_URIS, paths.encode_target_uri("x")) == [quote(u, safe="/") for u in SAMPLE_URIS]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=20), min_size=1, max_size=30))
def test_encode_target_uri_property(spark, texts):
    assert values(spark, texts, paths.encode_target_uri("x")) == [quote(u, safe="/") for u in texts]


def test_convert_uri_scheme(spark):
    data = ["abfss://box@host/a/b@c", "https://host/a", "abfss://nobox/a"]
    assert values(spark, data, paths.convert_uri_scheme("x")) == ["https://host/a/b@c", "https://host/a", "abfss://nobox/a"]


def test_size_bucket(spark):
    sizes = [None, 0, 1, 1048575, 1048576, 52428799, 52428800, -1]
    want = ["unknown", "unknown", "small", "small", "medium", "medium", "large", "unknown"]
    assert values(spark, sizes, measures.size_bucket("x"), "bigint") == want


AGES = [(-3600, "recent"), (3599, "recent"), (3600, "today"), (86399, "today"), (86400, "yesterday"), (172799, "yesterday"), (172800, "older")]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_age_bucket(spark, zone):
    """The same in any session time zone, also across a clock change."""
    as_of = datetime(2024, 3, 11, 1, 0, 0)
    data = [as_of - timedelta(seconds=s) for s, _ in AGES] + [None]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = values(spark, data, measures.age_bucket("x", as_of), "timestamp_ntz")
        back = values(spark, data[:3], measures.wall(measures.instant(F.col("x"))), "timestamp_ntz")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [w for _, w in AGES] + ["older"]
    assert back == data[:3]


def test_human_size(spark):
    data = [0, 1, 512, 1023, 1024, 1536, 1024**2, 1024**3 - 1, 1024**4, 5 * 1024**5, None]
    want = ["0 B", "1.0 B", "512.0 B", "1023.0 B", "1.0 KB", "1.5 KB", "1.0 MB", "1024.0 MB", "1.0 TB", "5120.0 TB", None]
    assert values(spark, data, measures.human_size("x"), "bigint") == want


def test_eta_label(spark):
    assert values(spark, [0.0, 0.5, 1.0, 23.96, 24.0, 60.0, None], measures.eta_label("x"), "double") == [
        "0 minutes",
        "30 minutes",
        "1.0 hours",
        "24.0 hours",
        "1.0 days",
        "2.5 days",
        None,
    ]


CLASSES = [
    # text, log, monitor, insight, insight_detail
    ("429 timeout", "Timeout", "Timeout", "Rate Limiting (429)", "Rate Limiting (429)"),
    ("404 connection", "File Not Found", "File Not Found", "Connection Error", "Connection Error"),
    ("access 429", "Rate Limit", "Permission", "Rate Limiting (429)", "Rate Limiting (429)"),
    ("Timed Out", "Other", "Timeout", "Other Error", "Other Error"),
    ("UNAUTHORIZED", "Authentication", "Authentication", "Other Error", "Other Error"),
    ("502 bad gateway", "Other", "Server Error", "Other Error", "Other Error"),
    ("403 denied: x", "Other", "Other", "Access Denied (403)", "Access Denied (403)"),
    ("disk full: no space", "Other", "Other", "Other Error", "disk full"),
    ("y" * 60 + ": z", "Other", "Other", "Other Error", "y" * 50),
    ("", "Other", "Other", "Other Error", "Other Error"),
    (None, "Other", "Other", "Other Error", "Other Error"),
]


def test_detail_of_any_length(spark):
    late = ["x" * 50 + "1: a", "x" * 50 + "2: a", None]
    assert values(spark, late, classify.classify_error("x", "insight_detail"))[:2] == ["x" * 50] * 2
    whole = values(spark, late, classify.classify_error("x", "insight_detail", detail_chars=None))
    assert whole[:2] == ["x" * 50 + "1", "x" * 50 + "2"]


@pytest.mark.parametrize("i,rule_set", list(enumerate(["log", "monitor", "insight", "insight_detail"])))
def test_classify_error(spark, i, rule_set):
    got = values(spark, [c[0] for c in CLASSES], classify.classify_error("x", rule_set))
    assert got == [c[i + 1] for c in CLASSES]


def test_custom_rules(spark):
    own = [("Quota", ["507"], ["quota"]), ("Other disk", [], ["disk"])]
    assert values(spark, ["507", "QUOTA", "Disk", "x"], classify.match_rules("x", own, "-")) == ["Quota", "Quota", "Other disk", "-"]


def test_document_type(spark):
    names = ["My_INVOICE.xls", "receipt invoice", "a.pdf", "b.DOCX", "c.csv", "d.TIFF", "contract_statement.jpg", "noext", "pdf"]
    want = ["Invoice", "Invoice", "Document", "Document", "Spreadsheet", "Image", "Contract", "Other", "Other"]
    assert values(spark, names, classify.document_type("x")) == want


def test_messages(spark):
    data = ["a" * 100, "b" * 101, "", None]
    assert values(spark, data, classify.truncate_message("x")) == ["a" * 100, "b" * 100 + "...", "", None]
    assert values(spark, ["k: v: w", "none", None], classify.error_prefix("x")) == ["k", "none", rules.UNKNOWN_ERROR]


LINES = [
    ("2025-08-07 15:10:00,123 - INFO - 🔥 TURBO Progress: 50/376882 (0.1%) - 7 new downloads", "turbo_progress"),
    ("2025-08-07 15:10:00,123 - INFO - 🚀 Speed: 12.5 files/sec | ETA: 3.5 hours", "speed"),
    ("2025-08-07 15:10:00,123 - INFO - about ETA: 3.5 hours", "eta"),
    ("2025-08-07 15:10:00,123 - INFO - ✅ Downloaded: a/b.pdf", "download_success"),
    ("2025-08-07 15:10:00,123 - ERROR - ❌ Attempt 2 failed for a/b.pdf: Read timeout", "download_failed"),
    ("2025-08-07 15:10:00,123 - INFO - 🔐 Re-Authenticating now", "auth_token"),
    ("2025-08-07 15:10:00,123 - INFO - 📁 Processing folder: x/", "folder_processing"),
    ("2025-08-07 15:10:00,123 - INFO - 🚀 TURBO MODE: Using 25 parallel workers", "turbo_mode"),
    ("2025-08-07 15:10:00,123 - INFO - 📂 TURBO: Resuming from file 12/40", "resume"),
    ("2025-13-07 15:10:00,123 - TRACE - nothing", "unknown"),
    ("Downloaded: without marker", "unknown"),
]


def test_log_lines(spark):
    texts = [t for t, _ in LINES]
    assert values(spark, texts, loglines.event_type("x")) == [k for _, k in LINES]
    levels = values(spark, texts, loglines.log_level("x"))
    assert levels == ["INFO"] * 4 + ["ERROR"] + ["INFO"] * 4 + [None, None]
    stamps = values(spark, texts, loglines.log_timestamp("x"))
    assert stamps[0] == datetime(2025, 8, 7, 15, 10, 0, 123000) and stamps[-2:] == [None, None]


def test_every_pattern_holds_its_plain_text():
    assert set(rules.LOG_EVENT_TEXT) == {k for k, _ in rules.LOG_EVENTS}
    for kind, pattern in rules.LOG_EVENTS:
        assert rules.LOG_EVENT_TEXT[kind] in pattern


def test_epochs_and_buckets_ignore_the_session_zone(spark):
    """Half past two does not exist in this zone on this day."""
    from estate.operators import progress
    from estate.sources import documents

    gap = datetime(2024, 3, 10, 2, 30)
    epoch = (gap - datetime(1970, 1, 1)).total_seconds()
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        doc = '{"completed_files": {"a": {"status": "completed", "size": 1, "timestamp": %r}}}' % epoch
        texts = spark.createDataFrame([("x", doc)], "ledger_id string, value string")
        docs = texts.select("ledger_id", F.from_json("value", documents.LEDGER_LAYOUTS["L2"]).alias("d")).select("ledger_id", "d.*")
        outcomes = documents.ledger_rows(docs, "L2").withColumn("run_id", F.lit("r"))
        assert [r.event_ts for r in outcomes.collect()] == [gap]
        assert [r.ts for r in progress.outcomes_over_time(outcomes).collect()] == [gap.replace(minute=0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
