"""Operators over the ledger: one row per file outcome.

Columns: ``run_id, path, attempt, status, skipped, error, size_bytes, event_ts, batch``;
``status`` is success, failed or pending; a skipped file is a success, and whatever is not a success, null included, is
still to be done.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.functions import measures, rules
from estate.functions.classify import classify_error, error_prefix
from estate.functions.measures import gb, mb, ratio
from estate.functions.paths import keyed_by_path, normalize_path, path_key

SUCCESS = "success"


def _is_success() -> Column:
    return F.col("status").eqNullSafe(F.lit(SUCCESS))


def is_skipped() -> Column:
    return F.coalesce(F.col("skipped"), F.lit(False))


def succeeded(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("status") == SUCCESS)


def failed(ledger: DataFrame) -> DataFrame:
    """Every row that is not a success: failed, pending, null or anything else."""
    return ledger.filter(~_is_success())


def outcome_class() -> Column:
    return (
        F.when(~_is_success(), "failed").when(is_skipped(), "skipped").otherwise("downloaded")
    )


def dedupe_latest(ledger: DataFrame, keys: tuple[str, ...] = ("path",)) -> DataFrame:
    """The latest row per path, which stands normalised: ``x\\a`` and ``x/a`` are one file.

    Every column takes part in the tie-break, so the result does not depend on the row
    order; the maximum is combined before the shuffle, so a hot path stays small.
    """
    order = [c for c in ("event_ts", "attempt", "batch", "size_bytes", "status") if c in ledger.columns]
    rest = [c for c in ledger.columns if c not in order and c not in keys]
    named = [path_key(ledger).alias(k) if k == "path" else F.col(k) for k in keys]
    latest = ledger.groupBy(*named).agg(F.max(F.struct(*order, *rest)).alias("_last"))
    return latest.select(*[c if c in keys else F.col(f"_last.{c}").alias(c) for c in ledger.columns])


def union_ledgers(snapshots: dict[str, DataFrame]) -> DataFrame:
    """All snapshots with the name each came from."""
    out = None
    for name, df in snapshots.items():
        named = df.withColumn("ledger_id", F.lit(name))
        out = named if out is None else out.unionByName(named, allowMissingColumns=True)
    return out


def status_counts(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy(outcome_class().alias("outcome")).agg(F.count(F.lit(1)).alias("entries"))


def _counts() -> list[Column]:
    good = _is_success()
    return [
        F.count_if(good).alias("success"),
        F.count_if(~good).alias("failed"),
        F.count_if(good & ~is_skipped()).alias("downloaded"),
        F.count_if(good & is_skipped()).alias("skipped"),
    ]


def ledger_compare(ledgers: DataFrame, total_files: int) -> DataFrame:
    """One row per snapshot; ``last_index`` is the highest entry position reached."""
    return (
        ledgers.groupBy("ledger_id")
        .agg(
            F.max("entry_index").alias("last_index"),
            *_counts(),
            F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"),
            F.max("event_ts").alias("last_event_ts"),
        )
        .withColumn("progress_pct", F.round(ratio(F.col("last_index"), F.lit(total_files), 100.0), 6))
    )


def ledger_quality(ledger: DataFrame) -> DataFrame:
    """Completeness of the success rows.  Rows are combined per path before the totals."""
    size = F.coalesce(F.col("size_bytes"), F.lit(0))
    per_path = (
        succeeded(ledger)
        .groupBy(path_key(ledger).alias("path"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(size > 0).alias("sized"),
            F.count_if(size == 0).alias("unsized"),
            F.sum(F.when(size > 0, size)).alias("bytes"),
            F.count("event_ts").alias("timed"),
        )
    )
    none = F.lit(0)
    return per_path.agg(
        F.coalesce(F.sum("n"), none).alias("entries"),
        F.coalesce(F.sum("sized"), none).alias("with_size"),
        F.coalesce(F.sum("unsized"), none).alias("without_size"),
        F.coalesce(F.sum("bytes"), none).alias("total_bytes"),
        F.coalesce(F.sum("timed"), none).alias("with_timestamp"),
        F.count("path").alias("distinct_paths"),
    ).select(
        "entries",
        "with_size",
        "without_size",
        F.round(gb("total_bytes"), 6).alias("total_gb"),
        F.round(ratio(mb("total_bytes"), F.col("with_size")), 6).alias("avg_mb"),
        "with_timestamp",
        "distinct_paths",
    )


def batch_summary(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("run_id", "batch").agg(
        *_counts(), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes")
    )


def run_summary(ledger: DataFrame, total_files: int | Column) -> DataFrame:
    """Totals per run; complete when the distinct paths done reach the total.

    Distinct paths, whichever way they are written, are counted from rows combined per (run, path).
    """
    total = total_files if isinstance(total_files, Column) else F.lit(total_files)
    good = _is_success()
    per_path = ledger.groupBy("run_id", path_key(ledger).alias("path")).agg(
        *_counts(),
        F.max(good).alias("done"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
    )
    totals = per_path.groupBy("run_id").agg(
        *[F.sum(c).alias(c) for c in ("success", "failed", "downloaded", "skipped")],
        F.count_if("done").alias("paths_done"),
        F.min("first_ts").alias("started_ts"),
        F.max("last_ts").alias("ended_ts"),
    )
    entries = F.col("success") + F.col("failed")
    return totals.select(
        "run_id",
        "success",
        "failed",
        "downloaded",
        "skipped",
        "paths_done",
        F.round(ratio(F.col("success"), entries, 100.0), 6).alias("success_rate"),
        F.round(measures.seconds_between(F.col("ended_ts"), F.col("started_ts")) / 3600, 6).alias("duration_hours"),
        F.greatest(total - F.col("paths_done"), F.lit(0)).cast("bigint").alias("remaining"),
        (F.col("paths_done") >= total).alias("complete"),
    )


# --- snapshots of whole ledgers ---------------------------------------------
def select_best(candidates: DataFrame, source: tuple[str, ...] = ("source_id",)) -> DataFrame:
    """Per source, the first readable candidate by priority, then the newest backup."""
    # counts down with time: the newest backup has the smallest value
    age = measures.seconds_between(measures.timestamp("1970-01-01"), F.col("backup_ts"))
    ranked = F.struct(F.col("priority"), age, F.col("candidate_id"))
    rest = [c for c in candidates.columns if c not in source]
    best = (
        candidates.filter(~F.col("is_corrupt"))
        .groupBy(*source)
        .agg(F.min(F.struct(ranked.alias("_rank"), *rest)).alias("_best"))
    )
    return best.select(*source, *[F.col(f"_best.{c}").alias(c) for c in rest])


def freshness(
    snapshots: DataFrame, site_id: str, drive_id: str, folder_id: str, as_of: datetime | str, ttl_hours: float = 24
) -> DataFrame:
    """``is_valid``: the snapshot was taken for this configuration and is young enough.

    No timestamp means valid, an unreadable one invalid.
    """
    same = (
        F.col("site_id").eqNullSafe(F.lit(site_id))
        & F.col("drive_id").eqNullSafe(F.lit(drive_id))
        & F.col("folder_id").eqNullSafe(F.lit(folder_id))
    )
    text = F.regexp_replace("timestamp", "Z$", "")
    taken = text.try_cast("timestamp_ntz")
    age = measures.seconds_between(measures.timestamp(as_of), taken)
    young = F.when(F.coalesce(text, F.lit("")) == "", F.lit(True)).otherwise(
        F.coalesce(age <= F.lit(ttl_hours * 3600.0), F.lit(False))
    )
    return snapshots.withColumn("is_valid", same & young)


# --- retries ----------------------------------------------------------------
def retry_plan(ledger: DataFrame, manifest: DataFrame) -> DataFrame:
    """What to do with each failed row; files missing from the manifest get empty defaults."""
    # a listing may name a path twice: one row per path, with an id if there is one
    listed = manifest.groupBy(normalize_path("path").alias("_listed")).agg(F.max(F.struct("id", "download_url", "size")).alias("_m"))
    listed = listed.select("_listed", F.col("_m.id").alias("_id"), F.col("_m.download_url").alias("_url"), F.col("_m.size").alias("_size"))
    url = F.coalesce(F.col("_url"), F.lit(""))
    stale = (url == "") | F.contains(F.coalesce(F.col("error"), F.lit("")), F.lit("401"))
    action = F.when(stale & F.col("_id").isNull(), "skip_no_id").when(stale, "refresh_url").otherwise("retry_as_is")
    return keyed_by_path(failed(ledger), "path").join(listed, F.col("_key") == F.col("_listed"), "left").select(
        "path",
        "attempt",
        "error",
        F.col("_id").alias("id"),
        url.alias("download_url"),
        F.coalesce(F.col("_size"), F.lit(0)).cast("bigint").alias("size"),
        action.alias("action"),
    )


def merge_retry(ledger: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Replace the rows of the retried paths that are no success by their new outcomes; all others stay."""
    retried = outcomes.select(normalize_path("path").alias("_retried")).distinct()
    kept = keyed_by_path(ledger, "path").join(retried, F.col("_key") == F.col("_retried"), "left").filter(_is_success() | F.col("_retried").isNull()).select(*ledger.columns)
    return kept.unionByName(outcomes, allowMissingColumns=True)


def clear_failed(ledger: DataFrame, as_of: datetime | str) -> tuple[DataFrame, DataFrame]:
    """The successes of the ledger, and the history row saying how many others went."""
    history = ledger.agg(F.count_if(~_is_success()).alias("files_cleared")).select(
        measures.timestamp(as_of).alias("timestamp"),
        F.lit("cleared_failed_status").alias("action"),
        "files_cleared",
        F.lit("Prepare for retry").alias("reason"),
    )
    return succeeded(ledger), history


def retry_history(outcomes: DataFrame, as_of: datetime | str) -> DataFrame:
    """The history row of a retry: attempted, successful, still failed."""
    return retry_summary(outcomes).select(
        measures.timestamp(as_of).alias("timestamp"), "attempted", "successful", "still_failed"
    )


def retry_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(_is_success()).alias("successful"),
        F.count_if(~_is_success()).alias("still_failed"),
        F.coalesce(F.sum(F.when(F.col("status") == SUCCESS, F.col("size_bytes"))), F.lit(0)).alias("recovered_bytes"),
    ).withColumn("success_rate", F.round(ratio(F.col("successful"), F.col("attempted"), 100.0), 2))


# --- failures ---------------------------------------------------------------
def failure_reasons(ledger: DataFrame) -> DataFrame:
    reason = F.coalesce("error", F.lit(rules.UNKNOWN_ERROR)).alias("reason")
    return _most_common(failed(ledger), reason)


def failure_classes(
    ledger: DataFrame, rule_set: str = "monitor", top: int | None = None, detail_chars: int | None = rules.DETAIL_PREFIX_CHARS
) -> DataFrame:
    counts = _most_common(failed(ledger), classify_error("error", rule_set, detail_chars).alias("error_class"))
    return counts if top is None else counts.limit(top)


def failure_prefixes(ledger: DataFrame) -> DataFrame:
    return _most_common(failed(ledger), error_prefix("error").alias("prefix"))


def _most_common(rows: DataFrame, label: Column) -> DataFrame:
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("failures"))
    return counts.orderBy(F.desc("failures"), counts.columns[0])


def error_feed(structured: DataFrame, bare_paths: DataFrame, error_count: DataFrame, as_of: datetime | str) -> DataFrame:
    """Failures as one feed: structured rows, bare path strings, and a system row when errors were counted."""
    unknown = F.lit("Unknown")
    one = structured.select(
        F.lit("download_failure").alias("type"),
        F.coalesce("path", unknown).alias("file"),
        F.coalesce("error", F.lit(rules.UNKNOWN_ERROR)).alias("error"),
        F.coalesce(F.left(F.col("event_ts").cast("string"), F.lit(19)), unknown).alias("timestamp"),
    )
    two = bare_paths.select(
        F.lit("download_failure").alias("type"),
        F.col("path").alias("file"),
        F.lit(rules.DOWNLOAD_FAILED).alias("error"),
        unknown.alias("timestamp"),
    )
    three = error_count.filter(F.col("error_count") > 0).select(
        F.lit("system_error").alias("type"),
        F.lit("Multiple files").alias("file"),
        F.concat(F.col("error_count").cast("string"), F.lit(" errors encountered during download")).alias("error"),
        F.left(measures.timestamp(as_of).cast("string"), F.lit(19)).alias("timestamp"),
    )
    return one.unionByName(two).unionByName(three)
