"""Progress, throughput, forecasts and alerts."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.functions import measures, rules
from estate.functions.measures import mb, ratio
from estate.operators.ledger import SUCCESS, is_skipped, outcome_class
from estate.operators.ordering import number_rows, with_previous
from estate.session import durable


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """One row of counts that the metrics below start from."""
    good = F.col("status").eqNullSafe(F.lit(SUCCESS))
    return ledger.agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if(good & ~is_skipped()).alias("downloaded"),
        F.count_if(good & is_skipped()).alias("skipped"),
        F.count_if(~good).alias("failed"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"),
        F.min("event_ts").alias("started_ts"),
        F.max("event_ts").alias("last_event_ts"),
    )


def progress_stats(totals: DataFrame, total_files: int, last_index: int | str, turbo: bool = True) -> DataFrame:
    """Position, rates and time left at an assumed speed."""
    at = F.col(last_index) if isinstance(last_index, str) else F.lit(last_index).cast("bigint")
    total = F.lit(total_files).cast("bigint")
    processed = F.least(at, total)
    remaining = F.greatest(F.lit(0).cast("bigint"), total - processed)
    speed = rules.TURBO_FILES_PER_SECOND if turbo else rules.PLAIN_FILES_PER_SECOND
    hours = remaining / F.lit(speed) / 3600
    return totals.select(
        total.alias("total_files"),
        processed.alias("processed"),
        "downloaded",
        "skipped",
        "failed",
        "entries",
        F.round(ratio(processed, total, 100.0), 6).alias("progress_pct"),
        remaining.alias("remaining"),
        F.round(F.lit(100.0) * F.col("downloaded") / F.greatest(processed, F.lit(1)), 6).alias("success_rate"),
        F.round(hours, 6).alias("eta_hours"),
        measures.eta_label(hours).alias("eta_label"),
    )


def health_metrics(totals: DataFrame, total_files: int, processed: str = "entries") -> DataFrame:
    total, done = F.lit(total_files).cast("bigint"), F.col(processed)
    remaining = total - done
    base = F.greatest(done, F.lit(1))
    return totals.select(
        F.round(ratio(done, total, 100.0), 6).alias("progress_pct"),
        remaining.alias("remaining"),
        F.round(remaining / (rules.TURBO_FILES_PER_SECOND * 3600), 6).alias("eta_hours"),
        F.round(F.lit(100.0) * F.col("downloaded") / base, 6).alias("success_rate"),
        F.round(F.lit(100.0) * F.col("failed") / base, 6).alias("error_rate"),
    )


def throughput_metrics(totals: DataFrame, total_files: int, as_of: datetime | str, started: str = "started_ts") -> DataFrame:
    """Rates since the start; zero when no time has passed."""
    elapsed = measures.seconds_between(measures.timestamp(as_of), F.col(started))
    moving = (elapsed > 0) & (F.col("downloaded") > 0)
    return totals.select(
        F.round(elapsed, 6).alias("elapsed_seconds"),
        F.when(moving, F.round(F.col("downloaded") / elapsed * 60, 2)).otherwise(0.0).alias("files_per_minute"),
        F.when(moving, F.round(mb("total_bytes") / elapsed, 2)).otherwise(0.0).alias("mb_per_second"),
        F.round(ratio(F.col("downloaded"), F.lit(total_files), 100.0), 2).alias("completion_rate"),
        F.round(ratio(F.col("total_bytes"), F.col("downloaded")), 6).alias("avg_file_bytes"),
        "downloaded",
        "total_bytes",
    )


def completion_forecast(metrics: DataFrame, total_files: int, as_of: datetime | str) -> DataFrame:
    """Time and volume left at the measured rate; unknown (null) without one."""
    left = F.lit(total_files).cast("bigint") - F.col("downloaded")
    minutes = F.when((F.col("files_per_minute") > 0) & (left > 0), left / F.col("files_per_minute"))
    seconds = F.floor(minutes * 60).cast("bigint")
    left_bytes = F.when(F.col("avg_file_bytes") > 0, F.floor(left * F.col("avg_file_bytes")).cast("bigint"))
    return metrics.select(
        left.alias("remaining_files"),
        F.round(minutes, 6).alias("remaining_minutes"),
        (measures.timestamp(as_of) + F.make_dt_interval(secs=seconds)).alias("completion_ts"),
        left_bytes.alias("remaining_bytes"),
        (F.col("total_bytes") + left_bytes).alias("projected_bytes"),
        measures.human_size(left_bytes).alias("remaining_size"),
    )


def alerts(metrics: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per metrics row and rule that fires."""
    fired = F.array(
        *[
            F.when(
                (F.col(metric) > low) & (F.col(metric) <= high),
                F.struct(F.lit(name).alias("alert"), F.lit(level).alias("level"), F.col(metric).alias("value")),
            )
            for name, level, metric, low, high in rules.ALERT_RULES
        ]
    )
    return metrics.select(*keys, F.inline(F.array_compact(fired)))


# --- over time --------------------------------------------------------------
def snapshot_deltas(snapshots: DataFrame, within: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """Change of each poll against the one before."""
    rows = with_previous(snapshots, ["ts"], within, ["success", "failed"])
    up, down = F.col("success") - F.col("previous_success"), F.col("failed") - F.col("previous_failed")
    return rows.select(
        *within,
        "ts",
        "success",
        "failed",
        up.alias("success_delta"),
        down.alias("failed_delta"),
        F.coalesce((up > 0) | (down != 0), F.lit(False)).alias("changed"),
    )


def snapshot_rate(snapshots: DataFrame, within: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """Successes per second since the poll before; 0 unless they grew."""
    rows = with_previous(snapshots, ["ts"], within, ["success", "ts"])
    grown = F.col("success") - F.col("previous_success")
    passed = measures.seconds_between(F.col("ts"), F.col("previous_ts"))
    rate = F.when((grown > 0) & (passed > 0), F.round(grown / passed, 6)).otherwise(0.0)
    return rows.select(*within, "ts", "success", rate.alias("files_per_second"))


def running_batch_speed(batches: DataFrame) -> DataFrame:
    """Files per second of each batch and the running mean within its run.

    ``batches`` holds ``(run_id, batch, files, seconds)``.
    """
    speed = ratio(F.col("files"), F.col("seconds"))
    rows = number_rows(batches, ["batch"], ["run_id"], {"_speeds": speed})
    return rows.select(
        "run_id",
        "batch",
        F.round(speed, 6).alias("batch_speed"),
        F.round(F.col("_speeds") / F.col("ordinal"), 6).alias("running_speed"),
    )


def progress_milestones(ledger: DataFrame, totals: Mapping[str, int] | int, every: int = 50) -> DataFrame:
    """Every ``every``-th completion of a run: percentage, rate since its start, time left.

    Completions are counted per run and time before they are ordered, so many at one
    moment are one row; the marks that fall on that moment are spelled out afterwards, in
    two steps that keep the arrays short.
    """
    if isinstance(totals, Mapping):
        total = F.create_map(*[F.lit(x) for pair in totals.items() for x in pair])[F.col("run_id")]
    else:
        total = F.lit(totals)
    moments = ledger.groupBy("run_id", "event_ts").agg(F.count(F.lit(1)).alias("_n"))
    rows = number_rows(moments, ["event_ts"], ["run_id"], {"_done": F.col("_n")})
    started = rows.groupBy("run_id").agg(F.min("event_ts").alias("_start"))
    first = (F.floor((F.col("_done") - F.col("_n")) / every).cast("bigint") + 1) * every
    step = every * 10_000
    parts = rows.filter(first <= F.col("_done")).select(
        "run_id", "event_ts", "_done", F.explode(F.sequence(first, F.col("_done"), F.lit(step).cast("bigint"))).alias("_from")
    )
    last = F.least(F.col("_done"), F.col("_from") + (step - every))
    marks = parts.select(
        "run_id", "event_ts", F.explode(F.sequence(F.col("_from"), last, F.lit(every).cast("bigint"))).alias("completed")
    )
    elapsed = measures.seconds_between(F.col("event_ts"), F.col("_start"))
    speed = ratio(F.col("completed"), elapsed)
    return marks.join(durable(started), "run_id").select(
        "run_id",
        "completed",
        "event_ts",
        F.round(ratio(F.col("completed"), total, 100.0), 6).alias("progress_pct"),
        F.round(speed, 6).alias("files_per_second"),
        F.round(F.when(speed > 0, (total - F.col("completed")) / speed / 3600).otherwise(0.0), 6).alias("eta_hours"),
    )


def outcomes_over_time(ledger: DataFrame, seconds: int = 3600) -> DataFrame:
    """Cumulative outcome counts per time bucket: the snapshot table of a ledger."""
    per_bucket = ledger.groupBy("run_id", measures.floor_time(F.col("event_ts"), seconds).alias("ts")).agg(
        F.count_if(outcome_class() != "failed").alias("_ok"), F.count_if(outcome_class() == "failed").alias("_bad")
    )
    running: dict[str, Column] = {"success": F.col("_ok"), "failed": F.col("_bad")}
    return number_rows(per_bucket, ["ts"], ["run_id"], running).select("run_id", "ts", "success", "failed")
