"""Query registry: key -> callable ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estate.functions import classify, loglines, measures, paths
from estate.operators import hierarchy, inventory, ledger, logs, planning, progress
from estate.operators import reconcile as matching
from estate.plans import stored, tables as t
from estate.session import new_location
from estate.sources.path_ledger import PathLedger
from estate.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-08-01 04:00:00"
RUN_END = "2001-12-01 00:00:00"
BASE = t.BASE
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return {**_REGISTRY, **stored.queries()}


# --- columns ----------------------------------------------------------------
@query
def normalize_path(spark, d):
    raw = F.concat(F.lit("\\"), F.replace("relative_path", F.lit("/"), F.lit("\\")), F.lit("//x/"))
    rows = t.files(spark, d).select("file_key", raw.alias("raw_path"))
    return inventory.normalize_paths(rows, "raw_path", "plain_path").withColumn(
        "url_path", paths.normalize_path("raw_path", url=True)
    )


@query
def file_attributes(spark, d):
    rows = inventory.file_attributes(t.files(spark, d))
    return rows.select(
        "relative_path", "name", "parent_dir", "extension", F.round("size_mb", 6).alias("size_mb"), F.round("size_gb", 6).alias("size_gb")
    )


@query
def top_folder(spark, d):
    return inventory.with_top_folder(t.files(spark, d)).select("relative_path", "top_folder")


@query
def mime_type(spark, d):
    return inventory.with_mime_type(t.files(spark, d)).select("relative_path", "mime_type")


@query
def document_type(spark, d):
    return inventory.with_document_type(t.files(spark, d)).select("relative_path", "document_type")


@query
def file_id(spark, d):
    return inventory.with_file_id(t.files(spark, d)).select("relative_path", "file_id")


@query
def target_path(spark, d):
    return inventory.with_target(t.files(spark, d), BASE).select("relative_path", "target_path")


@query
def encode_target_uri(spark, d):
    urls = t.load(spark, d, "pages").select(F.concat("url", F.lit("/é *~+ "), F.col("page_id").cast("string")).alias("path"))
    return inventory.with_target_uri(urls.unionByName(t.files(spark, d).select(F.col("relative_path").alias("path"))), "path")


@query
def convert_uri_scheme(spark, d):
    stored_uri = F.regexp_replace("url", "^https://", "abfss://box@")
    return t.load(spark, d, "pages").select("page_id", paths.convert_uri_scheme(stored_uri).alias("uri"))


@query
def size_bucket(spark, d):
    return inventory.with_size_bucket(t.files(spark, d)).select("relative_path", "size_bytes", "size_bucket")


@query
def age_bucket(spark, d):
    return inventory.with_age_bucket(t.files(spark, d), AS_OF).select("relative_path", "modified_ts", "age_bucket")


@query
def classify_error(spark, d):
    rows = ledger.failed(t.ledger(spark, d))
    sets = ["log", "monitor", "insight", "insight_detail"]
    return rows.select("path", "attempt", *[classify.classify_error("error", s).alias(f"{s}_class") for s in sets])


@query
def error_prefix(spark, d):
    return ledger.failed(t.ledger(spark, d)).select("path", "attempt", classify.error_prefix("error").alias("prefix"))


@query
def human_size(spark, d):
    return inventory.with_human_size(t.files(spark, d)).select("relative_path", "size_bytes", "size_label")


@query
def eta_label(spark, d):
    hours = F.col("size_bytes") / F.lit(1234567.0)
    return t.files(spark, d).select("relative_path", measures.eta_label(hours).alias("eta_label"))


@query
def truncate_message(spark, d):
    return t.load(spark, d, "documents").select(
        "doc_id", classify.truncate_message("text").alias("message"), classify.path_tail("text").alias("tail")
    )


@query
def large_files(spark, d):
    return inventory.large_files(t.files(spark, d)).select("relative_path", "size_bytes")


@query
def preflight_violations(spark, d):
    named = t.files(spark, d).select(
        F.when(F.col("file_key") % 9 == 0, F.concat("relative_path", F.lit(":x")))
        .when(F.col("file_key") % 14 == 0, F.concat(F.repeat(F.lit("deep/"), F.lit(90)), "relative_path"))
        .otherwise(F.col("relative_path"))
        .alias("relative_path"),
        (F.col("size_bytes") * 1200).alias("size_bytes"),
    )
    return inventory.preflight_violations(named, BASE)


@query
def build_catalog(spark, d):
    return inventory.build_catalog(t.files(spark, d), BASE, AS_OF, "library")


# --- joins ------------------------------------------------------------------
@query
def remaining_files(spark, d):
    return matching.remaining_files(t.files(spark, d), t.ledger(spark, d)).select("relative_path", "size_bytes")


@query
def already_done(spark, d):
    return matching.already_done(t.files(spark, d), t.ledger(spark, d))


@query
def reconcile(spark, d):
    return matching.reconcile(t.ledger(spark, d), t.disk(spark, d))


@query
def reconcile_summary(spark, d):
    return matching.reconcile_summary(t.ledger(spark, d), t.disk(spark, d))


def _registry(spark, d):
    return matching.unify_registry(t.ledger(spark, d), t.disk(spark, d))


@query
def unify_registry(spark, d):
    return _registry(spark, d)


@query
def rebuild_ledger(spark, d):
    return matching.rebuild_ledger(t.manifest(spark, d), t.disk(spark, d))


@query
def rebuild_summary(spark, d):
    return matching.rebuild_summary(matching.rebuild_ledger(t.manifest(spark, d), t.disk(spark, d)))


@query
def retry_plan(spark, d):
    return ledger.retry_plan(t.ledger(spark, d), t.manifest(spark, d, version=1))


def _retried(spark, d):
    """New outcomes of the rows that are no success; half of them succeed, those of odd batches stand for other paths."""
    again = t.elsewhere(ledger.failed(t.ledger(spark, d)), "path", F.col("batch") % 2 != 0)
    ok = F.col("entry_index") % 2 == 0
    return again.withColumns(
        {
            "status": F.when(ok, "success").otherwise("failed"),
            "error": F.when(~ok, F.col("error")),
            "size_bytes": F.when(ok, F.col("entry_index") * 10).otherwise(F.lit(0)).cast("bigint"),
            "attempt": (F.col("attempt") + 10).cast("int"),
        }
    )


@query
def merge_retry(spark, d):
    merged = ledger.merge_retry(t.ledger(spark, d), _retried(spark, d))
    return merged.select("path", "attempt", "status", "error", "size_bytes", "batch")


@query
def retry_summary(spark, d):
    return ledger.retry_summary(_retried(spark, d))


@query
def retry_history(spark, d):
    return ledger.retry_history(_retried(spark, d), AS_OF)


@query
def retry_statistics(spark, d):
    """Statistics of the ledger after the retry."""
    return matching.rebuild_summary(ledger.merge_retry(t.ledger(spark, d), _retried(spark, d)))


@query
def clear_failed(spark, d):
    kept, history = ledger.clear_failed(t.ledger(spark, d), AS_OF)
    per_run = kept.groupBy("run_id").agg(F.count(F.lit(1)).alias("entries")).withColumn("action", F.lit("kept"))
    return per_run.unionByName(
        history.select(F.lit("history").alias("run_id"), F.col("files_cleared").alias("entries"), "action")
    )


@query
def dir_coverage(spark, d):
    return inventory.dir_coverage(t.created_dirs(spark, d), t.attempted_dirs(spark, d))


@query
def sync_plan(spark, d):
    return planning.sync_plan(t.files(spark, d), t.target_files(spark, d))


@query
def new_files(spark, d):
    return planning.new_files(t.manifest(spark, d), t.manifest(spark, d, version=1)).select("path", "id", "size")


def _ready(spark, d):
    return planning.migration_ready(t.manifest(spark, d), t.disk(spark, d))


@query
def migration_ready(spark, d):
    return _ready(spark, d).select("path", "target_path", "size")


@query
def sample_migration(spark, d):
    return planning.sample_migration(_ready(spark, d)).select("target_path", "size")


# --- roll-ups ---------------------------------------------------------------
@query
def inventory_totals(spark, d):
    return inventory.inventory_totals(t.files(spark, d))


@query
def by_extension(spark, d):
    return inventory.by_extension(t.files(spark, d))


@query
def by_directory(spark, d):
    return inventory.by_directory(t.files(spark, d))


@query
def by_document_type(spark, d):
    return inventory.by_document_type(t.files(spark, d))


@query
def migration_estimate(spark, d):
    return planning.migration_estimate(t.files(spark, d), AS_OF)


@query
def adaptive_batch_size(spark, d):
    return planning.adaptive_batch_size(t.files(spark, d))


@query
def file_stats(spark, d):
    return inventory.file_stats(t.files(spark, d))


@query
def size_distribution(spark, d):
    return inventory.size_distribution(t.files(spark, d))


@query
def age_distribution(spark, d):
    return inventory.age_distribution(_registry(spark, d), AS_OF)


@query
def folder_distribution(spark, d):
    return inventory.folder_distribution(t.files(spark, d))


@query
def insight_summary(spark, d):
    return inventory.insight_summary(_registry(spark, d))


@query
def estimate_total_size(spark, d):
    return inventory.estimate_total_size(t.files(spark, d))


@query
def ledger_status_counts(spark, d):
    return ledger.status_counts(t.ledger(spark, d))


def _total(spark, d) -> int:
    """Number of files, the total every progress figure is measured against."""
    return t.load(spark, d, "orders").count()


def _snapshots_of_ledger(spark, d):
    rows = t.ledger(spark, d)
    return ledger.union_ledgers({"turbo": rows.filter("batch >= 5"), "plain": rows.filter("batch < 5")})


@query
def union_ledgers(spark, d):
    return _snapshots_of_ledger(spark, d).select("ledger_id", "path", "attempt", "status", "batch")


@query
def ledger_compare(spark, d):
    return ledger.ledger_compare(_snapshots_of_ledger(spark, d), _total(spark, d))


def _totals(spark, d):
    return progress.ledger_totals(t.ledger(spark, d))


@query
def progress_stats(spark, d):
    return progress.progress_stats(_totals(spark, d), 10 * _total(spark, d), "entries")


@query
def health_metrics(spark, d):
    return progress.health_metrics(_totals(spark, d), 5 * _total(spark, d))


def _throughput(spark, d):
    return progress.throughput_metrics(_totals(spark, d), 2 * _total(spark, d), RUN_END)


@query
def throughput_metrics(spark, d):
    return _throughput(spark, d)


@query
def completion_forecast(spark, d):
    return progress.completion_forecast(_throughput(spark, d), 2 * _total(spark, d), RUN_END)


@query
def ledger_quality(spark, d):
    return ledger.ledger_quality(t.ledger(spark, d))


@query
def manifest_scope(spark, d):
    return planning.manifest_scope(t.manifest(spark, d), t.disk(spark, d))


@query
def batch_summary(spark, d):
    return ledger.batch_summary(t.ledger(spark, d))


@query
def run_summary(spark, d):
    return ledger.run_summary(t.ledger(spark, d), _total(spark, d))


@query
def failure_reasons(spark, d):
    return ledger.failure_reasons(t.ledger(spark, d))


@query
def failure_classes(spark, d):
    return ledger.failure_classes(t.ledger(spark, d), "monitor")


@query
def failure_classes_top(spark, d):
    return ledger.failure_classes(t.ledger(spark, d), "insight_detail", top=5)


@query
def failure_prefixes(spark, d):
    return ledger.failure_prefixes(t.ledger(spark, d))


@query
def error_feed(spark, d):
    bad = ledger.failed(t.ledger(spark, d))
    counted = bad.agg(F.count(F.lit(1)).alias("error_count"))
    return ledger.error_feed(bad.filter("batch < 5"), bad.filter("batch >= 5").select("path"), counted, AS_OF)


@query
def alerts(spark, d):
    per_batch = ledger.batch_summary(t.ledger(spark, d))
    done = F.col("success") + F.col("failed")
    metrics = per_batch.select(
        "run_id",
        "batch",
        F.round(F.lit(100.0) * F.col("failed") / done, 6).alias("error_rate"),
        F.round(F.lit(140.0) * F.col("success") / done, 6).alias("progress_pct"),
        (F.col("batch") * 3 + 70).cast("double").alias("disk_usage_pct"),
    )
    return progress.alerts(metrics, ("run_id", "batch"))


@query
def dirs_by_depth(spark, d):
    return inventory.dirs_by_depth(t.directories(spark, d))


# --- order, windows, sets ---------------------------------------------------
@query
def assign_batches(spark, d):
    return planning.assign_batches(t.files(spark, d)).select("relative_path", "size_bytes", "position", "batch")


@query
def snapshot_deltas(spark, d):
    return progress.snapshot_deltas(t.snapshots(spark, d))


@query
def snapshot_rate(spark, d):
    return progress.snapshot_rate(t.snapshots(spark, d))


@query
def running_batch_speed(spark, d):
    per_day = t.ledger(spark, d).groupBy("run_id", F.to_date("event_ts").alias("day")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("attempt").cast("double").alias("seconds")
    )
    batches = per_day.withColumn("batch", F.date_diff("day", F.lit("1995-01-01").cast("date"))).drop("day")
    return progress.running_batch_speed(batches)


@query
def progress_milestones(spark, d):
    return progress.progress_milestones(t.ledger(spark, d), 5 * _total(spark, d), every=50)


@query
def dedupe_latest(spark, d):
    return ledger.dedupe_latest(t.ledger(spark, d))


@query
def dedupe_latest_spellings(spark, d):
    return ledger.dedupe_latest(t.ledger_spelled(spark, d))


@query
def run_summary_spellings(spark, d):
    return ledger.run_summary(t.ledger_spelled(spark, d), _total(spark, d))


@query
def ledger_quality_spellings(spark, d):
    return ledger.ledger_quality(t.ledger_spelled(spark, d))


def _stored_ledger(spark, d):
    """The ledger in three appends, one of them repeated, with a compaction between them."""
    rows = t.ledger_spelled(spark, d)
    made = PathLedger.create(spark, new_location(spark, "ledger"), rows.schema, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for k in (0, 1, 1, 2):
        made.append(rows.filter(F.col("batch") % 3 == k), f"part-{k}")
        if k == 1:
            made.compact()
    return made.rows()


@query
def path_ledger_latest(spark, d):
    return ledger.dedupe_latest(_stored_ledger(spark, d)).select(*t.ledger(spark, d).columns)


@query
def path_ledger_remaining(spark, d):
    return matching.remaining_files(t.files(spark, d), _stored_ledger(spark, d)).select("relative_path", "size_bytes")


@query
def top_dirs_per_depth(spark, d):
    return inventory.top_dirs_per_depth(t.directories(spark, d))


@query
def sample_per_dir(spark, d):
    return inventory.sample_per_dir(t.files(spark, d), 100, 2000).select("directory", "relative_path", "size_bytes")


@query
def top_types_by_size(spark, d):
    return inventory.top_types_by_size(t.files(spark, d))


@query
def top_types_by_count(spark, d):
    return inventory.top_types_by_count(t.files(spark, d))


@query
def largest_files(spark, d):
    return inventory.largest_files(t.files(spark, d))


@query
def recent_files(spark, d):
    return inventory.recent_files(t.files(spark, d))


@query
def dirs_creation_order(spark, d):
    return planning.dirs_creation_order(t.directories(spark, d))


@query
def directory_prefixes(spark, d):
    return t.directories(spark, d)


@query
def missing_dirs(spark, d):
    return inventory.missing_dirs(t.directories(spark, d), t.created_dirs(spark, d))


@query
def flatten_hierarchy(spark, d):
    return hierarchy.flatten_hierarchy(t.items(spark, d), t.ROOT_ID, skip=["NATION_7", "Private"])


@query
def resolve_folder(spark, d):
    customer, nation, region = (t.load(spark, d, n) for n in ("customer", "nation", "region"))
    home = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    asked = F.when(F.col("c_custkey") % 10 == 0, F.lower("r_name")).otherwise(F.col("r_name"))
    requests = home.select(F.concat(F.lit("/"), asked, F.lit("/"), F.col("n_name"), F.lit("/")).alias("folder_path"))
    return hierarchy.resolve_folder(requests, t.items(spark, d), t.ROOT_ID)


# --- ledger snapshots -------------------------------------------------------
@query
def select_best_ledger(spark, d):
    return ledger.select_best(t.ledger_candidates(spark, d)).select("source_id", "candidate_id", "priority", "backup_ts")


@query
def ledger_freshness(spark, d):
    rows = ledger.freshness(
        t.listing_snapshots(spark, d), "site-O", "drive-0", "folder-1", "2001-08-01T00:00:00", ttl_hours=24 * 900
    )
    return rows.select("snapshot_id", "is_valid")


# --- logs -------------------------------------------------------------------
def _events(spark, d):
    return logs.parse_log(t.log_lines(spark, d))


def _fields(spark, d):
    return logs.parse_log_fields(t.log_lines(spark, d))


@query
def parse_log(spark, d):
    return _events(spark, d).select("file", "line_number", "event_ts", "level", "event_type", "raw_line")


_FIELD_COLUMNS = [
    "current",
    "total",
    "percentage",
    "new_downloads",
    "files_per_sec",
    "eta_hours",
    "file_path",
    "error_type",
    "error_message",
    "folder_path",
]


@query
def parse_log_fields(spark, d):
    return _fields(spark, d).select("file", "line_number", "event_type", *_FIELD_COLUMNS)


@query
def parse_log_fields_all_types(spark, d):
    rows = logs.parse_log_fields(t.all_log_lines(spark, d))
    return rows.select("line_id", "event_type", *_FIELD_COLUMNS, "workers", "resume_from", loglines.event_summary().alias("summary"))


@query
def parse_log_fields_first_colon(spark, d):
    rows = logs.parse_log_fields(t.log_lines(spark, d), failed_mode="first_colon")
    return rows.select("file", "line_number", "event_type", "file_path", "error_type", "error_message")


@query
def log_summary(spark, d):
    return logs.log_summary(_events(spark, d))


@query
def log_performance(spark, d):
    return logs.log_performance(_fields(spark, d))


@query
def log_errors(spark, d):
    return logs.log_errors(_fields(spark, d))


@query
def log_hourly(spark, d):
    return logs.log_hourly(_events(spark, d))


@query
def log_common_errors(spark, d):
    texts = t.log_lines(spark, d).select(F.substr("raw_line", F.lit(25)).alias("raw_line"))
    return logs.log_common_errors(texts)


@query
def recent_errors(spark, d):
    return logs.recent_errors(_events(spark, d))


@query
def log_timeline(spark, d):
    return logs.log_timeline(_events(spark, d))


# --- streaming --------------------------------------------------------------
def _outcome_stream(spark, d):
    return jobs.stream_table(spark, f"{d}/events.parquet").select(*t.outcome_columns())


def _places(spark, label):
    return new_location(spark, label), new_location(spark, f"{label}-state")


@query
def stream_log_events(spark, d):
    lines = jobs.stream_table(spark, f"{d}/events.parquet").select(*t.log_columns())
    typed = jobs.log_events(lines)
    return jobs.run_append(typed.select("event_ts", "level", "event_type", "raw_line"), *_places(spark, "stream-log"))


@query
def stream_throughput(spark, d):
    stream = jobs.throughput(_outcome_stream(spark, d), width="1 hour")
    return jobs.run_updates(stream, ["window_start", "window_end", "status"], *_places(spark, "stream-throughput"))


@query
def stream_sliding_error_rate(spark, d):
    stream = jobs.sliding_error_rate(_outcome_stream(spark, d))
    rates = jobs.run_updates(stream, ["window_start", "window_end"], *_places(spark, "stream-errors"))
    return jobs.alerting(rates)


def _arriving(spark, d):
    """The outcomes as they arrive, a micro-batch each time, some of them late."""
    location = new_location(spark, "arriving")
    t.arriving_outcomes(spark, d, location)
    return jobs.stream_table(spark, location, files_per_batch=1)


@query
def stream_throughput_late(spark, d):
    stream = jobs.throughput(_arriving(spark, d), width="1 hour")
    return jobs.run_updates(stream, ["window_start", "window_end", "status"], *_places(spark, "stream-throughput"), compact_every=3)


@query
def stream_sliding_error_rate_late(spark, d):
    stream = jobs.sliding_error_rate(_arriving(spark, d))
    return jobs.alerting(jobs.run_updates(stream, ["window_start", "window_end"], *_places(spark, "stream-errors"), compact_every=3))


@query
def stream_dedupe_ledger(spark, d):
    unique = jobs.dedupe_ledger(_outcome_stream(spark, d)).select("path", "status")
    return jobs.run_append(unique, *_places(spark, "stream-dedupe"))


@query
def stream_ledger_upsert(spark, d):
    rows = jobs.run_ledger_upsert(_outcome_stream(spark, d), "live", *_places(spark, "stream-ledger"))
    return rows.select("run_id", "path", "status", "skipped", "size_bytes", "event_ts")


@query
def stream_idle_detect(spark, d):
    run = F.concat(F.lit("run_"), (F.col("user_id") % 3).cast("string")).alias("run_id")
    rows = jobs.stream_table(spark, f"{d}/events.parquet").select(run, *t.outcome_columns())
    stream = jobs.idle_sessions(rows, gap="10 minutes")
    return jobs.run_append(stream, *_places(spark, "stream-idle"))
