"""Operators over log lines ``(file, line_number, raw_line)`` and parsed events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.functions import loglines, measures
from estate.functions.classify import classify_error, truncate_message


def parse_log(lines: DataFrame) -> DataFrame:
    """Time, level and event type of each line."""
    typed = lines.withColumns(
        {
            "event_ts": loglines.log_timestamp("raw_line"),
            "level": loglines.log_level("raw_line"),
            "event_type": loglines.event_type("raw_line"),
        }
    )
    return typed


def parse_log_fields(lines: DataFrame, failed_mode: str = "greedy") -> DataFrame:
    """``parse_log`` with one nullable typed column per field."""
    events = lines if "event_type" in lines.columns else parse_log(lines)
    return events.withColumns(loglines.event_fields("raw_line", "event_type", failed_mode))


def _newest(df: DataFrame) -> list[Column]:
    return [F.desc_nulls_last("event_ts")] + [F.desc(c) for c in ("file", "line_number") if c in df.columns]


def log_summary(events: DataFrame) -> DataFrame:
    """Counts per type and per level, and the covered time, as ``(section, label, ...)`` rows.

    One grouping-sets pass gives all three sections.
    """
    kind = F.grouping_id()
    rows = events.groupingSets(
        [[F.col("event_type")], [F.col("level")], []], F.col("event_type"), F.col("level")
    ).agg(
        kind.alias("_set"),
        F.count(F.lit(1)).alias("events"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
    )
    section = F.when(F.col("_set") == 1, "event_type").when(F.col("_set") == 2, "level").otherwise("all")
    label = F.when(F.col("_set") == 1, F.col("event_type")).when(F.col("_set") == 2, F.col("level")).otherwise("all")
    return (
        rows.select(section.alias("section"), label.alias("label"), "events", "first_ts", "last_ts")
        .filter(F.col("label").isNotNull())
        .withColumn(
            "duration_hours",
            F.round(measures.seconds_between(F.col("last_ts"), F.col("first_ts")) / 3600, 6),
        )
    )


def log_performance(fields: DataFrame) -> DataFrame:
    """Speed statistics and the latest progress line, one row."""
    at = F.struct(*[F.col(c) for c in ("event_ts", "file", "line_number") if c in fields.columns])
    progress = F.col("event_type") == "turbo_progress"
    speed = F.when(F.col("event_type") == "speed", F.col("files_per_sec"))
    latest = F.struct(at.alias("at"), "percentage", "current", "total")
    # summed as decimals, whose total does not depend on the row order
    exact = speed.cast("decimal(28,9)")
    return fields.agg(
        F.count_if(F.col("event_type") == "speed").alias("speed_samples"),
        F.count_if(progress).alias("progress_samples"),
        F.round(F.sum(exact).cast("double") / F.count(exact), 6).alias("avg_speed"),
        F.max(speed).alias("max_speed"),
        F.min(speed).alias("min_speed"),
        F.max(F.when(progress, latest)).alias("_latest"),
    ).select(
        "speed_samples",
        "progress_samples",
        "avg_speed",
        "max_speed",
        "min_speed",
        F.col("_latest.percentage").alias("current_progress"),
        F.col("_latest.current").alias("files_processed"),
        F.col("_latest.total").alias("total_files"),
    )


def mentions_failure() -> Column:
    return F.contains(F.lower("raw_line"), F.lit("failed"))


def error_lines(events: DataFrame) -> DataFrame:
    return events.filter(F.coalesce(F.col("level") == "ERROR", F.lit(False)) | mentions_failure())


def log_errors(fields: DataFrame) -> DataFrame:
    """Failures per class; only download failures carry a message to classify."""
    label = F.when(F.col("event_type") == "download_failed", classify_error("error_message", "log")).otherwise("Other")
    return error_lines(fields).groupBy(label.alias("error_class")).agg(F.count(F.lit(1)).alias("errors"))


def recent_errors(events: DataFrame, n: int = 20) -> DataFrame:
    rows = error_lines(events).filter(F.col("event_ts").isNotNull())
    keys = [c for c in ("file", "line_number") if c in rows.columns]
    return (
        rows.orderBy(*_newest(rows))
        .limit(n)
        .select("event_ts", *keys, "event_type", truncate_message("raw_line").alias("message"))
    )


def log_hourly(events: DataFrame) -> DataFrame:
    """Successes per hour of the day, over all days."""
    return (
        events.filter((F.col("event_type") == "download_success") & F.col("event_ts").isNotNull())
        .groupBy(F.concat(F.lpad(F.hour("event_ts").cast("string"), 2, "0"), F.lit(":00")).alias("hour"))
        .agg(F.count(F.lit(1)).alias("downloads"))
    )


def log_common_errors(lines: DataFrame, n: int = 5) -> DataFrame:
    """Most frequent identical lines that mention a failure."""
    counts = lines.filter(mentions_failure()).groupBy("raw_line").agg(F.count(F.lit(1)).alias("occurrences"))
    return counts.orderBy(F.desc("occurrences"), "raw_line").limit(n)


def log_timeline(events: DataFrame, n: int = 50) -> DataFrame:
    """The last typed events in time order with a sentence each.

    Sorting the ``n`` rows again, oldest first, keeps the field parsing above the top-n,
    so only those rows are parsed.
    """
    typed = events.filter(F.col("event_ts").isNotNull() & (F.col("event_type") != "unknown"))
    keys = [c for c in ("file", "line_number") if c in typed.columns]
    last = parse_log_fields(typed.orderBy(*_newest(typed)).limit(n).orderBy("event_ts", *keys))
    return last.select("event_ts", *keys, "event_type", "level", loglines.event_summary().alias("summary"))
