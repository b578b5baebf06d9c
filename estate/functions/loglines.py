"""Column expressions that read one log line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estate.functions import rules
from estate.functions.classify import first_match
from estate.functions.paths import file_name

_PATTERN = dict(rules.LOG_EVENTS)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(line: Column | str) -> Column:
    return F.regexp_replace(_col(line), r"^\s+|\s+$", "")


def log_timestamp(line: Column | str) -> Column:
    text = F.regexp_extract(_col(line), rules.LOG_TIMESTAMP, 1)
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("timestamp_ntz")


def log_level(line: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(line), rules.LOG_LEVEL, 1), F.lit(""))


def event_type(line: Column | str) -> Column:
    text = _col(line)
    tests = [(F.contains(text, F.lit(rules.LOG_EVENT_TEXT[k])) & F.rlike(text, F.lit(p)), k) for k, p in rules.LOG_EVENTS]
    return first_match(tests, "unknown")


def event_fields(line: Column | str, kind: Column | str = "event_type", failed_mode: str = "greedy") -> dict[str, Column]:
    """Typed columns per event type; each is null for the other types.

    ``failed_mode='greedy'`` splits a failure line at its last ``": "`` and
    ``'first_colon'`` at the first one after the file.
    """
    text, k = _col(line), _col(kind)
    failed = _PATTERN["download_failed"] if failed_mode == "greedy" else rules.LOG_FAILED_FIRST_COLON

    def take(name: str, i: int, pattern: str | None = None) -> Column:
        return F.when(k == name, F.regexp_extract(text, pattern or _PATTERN[name], i))

    return {
        "current": take("turbo_progress", 1).try_cast("bigint"),
        "total": F.coalesce(take("turbo_progress", 2), take("resume", 2)).try_cast("bigint"),
        "percentage": take("turbo_progress", 3).try_cast("double"),
        "new_downloads": take("turbo_progress", 4).try_cast("bigint"),
        "files_per_sec": take("speed", 1).try_cast("double"),
        "eta_hours": take("eta", 1).try_cast("double"),
        "file_path": F.coalesce(take("download_success", 1), take("download_failed", 2, failed)),
        "error_type": take("download_failed", 1, failed),
        "error_message": take("download_failed", 3, failed),
        "folder_path": take("folder_processing", 1),
        "workers": take("turbo_mode", 1).try_cast("bigint"),
        "resume_from": take("resume", 1).try_cast("bigint"),
    }


def event_summary() -> Column:
    """One readable sentence over the columns of a parsed event."""
    kind = F.col("event_type")
    number = lambda c: F.format_number(F.col(c), 0)
    return first_match(
        [
            (
                kind == "turbo_progress",
                F.concat(
                    F.format_string("Progress: %.1f%% (", F.col("percentage")),
                    number("current"),
                    F.lit("/"),
                    number("total"),
                    F.lit(")"),
                ),
            ),
            (kind == "speed", F.format_string("Speed: %.1f files/sec", F.col("files_per_sec"))),
            (kind == "download_success", F.concat(F.lit("Downloaded: "), file_name("file_path"))),
            (
                kind == "download_failed",
                F.concat(F.lit("Failed: "), file_name("file_path"), F.lit(" - "), F.col("error_type")),
            ),
            (kind == "turbo_mode", F.concat(F.lit("Started with "), F.col("workers").cast("string"), F.lit(" workers"))),
            (kind == "resume", F.concat(F.lit("Resumed from file "), number("resume_from"))),
        ],
        F.left(F.col("raw_line"), F.lit(rules.MESSAGE_CHARS)),
    )
