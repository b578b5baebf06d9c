"""Joins between inventory, manifest and ledger, all on the normalised path.

The side that is looked up holds one row per path, so that no row of the other side is multiplied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.functions import rules
from estate.functions.measures import gb, ratio
from estate.functions.paths import keyed_by_path, normalize_path, path_key
from estate.operators.ledger import SUCCESS, dedupe_latest, succeeded

PATH, SIZE, MODIFIED = "relative_path", "size_bytes", "modified_ts"


def completed_paths(ledger: DataFrame) -> DataFrame:
    """Distinct normalised paths with a success.  The same partitioning serves the join that follows."""
    return succeeded(ledger).select(path_key(ledger).alias("_done")).distinct()


def unique_files(files: DataFrame) -> DataFrame:
    """One row per normalised path: the one modified last, the largest of several."""
    deciding = [c for c in (MODIFIED, SIZE) if c in files.columns]
    latest = files.groupBy(normalize_path(PATH).alias(PATH)).agg(F.max(F.struct(*deciding)).alias("_last"))
    return latest.select(PATH, *[F.col(f"_last.{c}").alias(c) for c in deciding])


def remaining_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Resume rule: inventory rows without a success, whatever the order of earlier runs.

    A side that is stored by path (``sources.path_ledger``) is not shuffled.
    """
    return keyed_by_path(files, PATH).join(completed_paths(ledger), F.col("_key") == F.col("_done"), "left_anti").drop("_key")


def already_done(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Inventory rows with a success, as skipped outcomes."""
    done = keyed_by_path(files, PATH).join(completed_paths(ledger), F.col("_key") == F.col("_done"), "left_semi")
    return done.select(
        F.col(PATH).alias("path"), F.lit(SUCCESS).alias("status"), F.lit(True).alias("skipped"), F.col(SIZE)
    )


def reconcile(ledger: DataFrame, disk: DataFrame) -> DataFrame:
    """Successful ledger paths against the disk.

    Both sides are made unique per path first, the ledger from no more columns than decide the size.
    """
    deciding = succeeded(ledger).select(normalize_path("path").alias("path"), *[c for c in ("event_ts", "attempt", "batch", SIZE) if c in ledger.columns])
    left = dedupe_latest(deciding).select(
        F.col("path").alias(PATH), F.col(SIZE).alias("ledger_size"), F.lit(True).alias("_in_ledger")
    )
    right = unique_files(disk).select(PATH, F.col(SIZE).alias("disk_size"), F.lit(True).alias("_on_disk"))
    kind = (
        F.when(F.col("_in_ledger") & F.col("_on_disk"), "matched")
        .when(F.col("_on_disk"), "missing_from_progress")
        .otherwise("missing_from_filesystem")
    )
    return left.join(right, PATH, "full_outer").select(
        PATH,
        kind.alias("match"),
        "ledger_size",
        "disk_size",
        F.when(kind == "matched", F.coalesce(F.col("ledger_size") == F.col("disk_size"), F.lit(False))).alias(
            "size_match"
        ),
    )


def reconcile_summary(ledger: DataFrame, disk: DataFrame) -> DataFrame:
    rows = reconcile(ledger, disk)
    matched = F.col("match") == "matched"
    return rows.agg(
        F.count_if(matched).alias("matched"),
        F.count_if(F.col("match") == "missing_from_progress").alias("missing_from_progress"),
        F.count_if(F.col("match") == "missing_from_filesystem").alias("missing_from_filesystem"),
        F.count_if(F.col("size_match")).alias("size_matches"),
        F.count_if(~F.col("size_match")).alias("size_mismatches"),
        F.coalesce(F.sum(F.when(matched, F.col("disk_size"))), F.lit(0)).alias("corrected_bytes"),
    ).withColumn("corrected_gb", F.round(gb("corrected_bytes"), 6))


def unify_registry(ledger: DataFrame, disk: DataFrame) -> DataFrame:
    """One row per known path, from the ledger's successes, the disk, or both."""
    # the run, the error text and the entry position decide nothing here
    named = succeeded(ledger).drop("run_id", "error", "entry_index").withColumn("path", normalize_path("path"))
    left = dedupe_latest(named).select(
        "path",
        F.lit(True).alias("_in_ledger"),
        (~F.coalesce(F.col("skipped"), F.lit(False))).alias("_downloaded"),
        F.coalesce(F.col("status"), F.lit("unknown")).alias("_status"),
        F.col("event_ts").alias("ledger_ts"),
    )
    right = unique_files(disk).select(F.col(PATH).alias("path"), SIZE, MODIFIED, F.lit(True).alias("_on_disk"))
    return left.join(right, "path", "full_outer").select(
        "path",
        F.coalesce("_in_ledger", F.lit(False)).alias("in_progress"),
        F.coalesce("_on_disk", F.lit(False)).alias("on_filesystem"),
        F.coalesce("_downloaded", F.lit(True)).alias("is_downloaded"),
        F.coalesce("_status", F.lit("filesystem_only")).alias("status"),
        F.coalesce(SIZE, F.lit(0)).cast("bigint").alias(SIZE),
        "ledger_ts",
        MODIFIED,
    )


def rebuild_ledger(manifest: DataFrame, disk: DataFrame) -> DataFrame:
    """A new ledger from the listing and what is on disk: one row per listed row."""
    present = disk.select(normalize_path(PATH).alias("_found")).distinct()
    found = F.col("_found").isNotNull()
    return keyed_by_path(manifest, "path").join(present, F.col("_key") == F.col("_found"), "left").select(
        "path",
        F.when(found, F.lit(SUCCESS)).otherwise(F.lit("pending")).alias("status"),
        F.when(found, F.coalesce("size", F.lit(0))).cast("bigint").alias(SIZE),
        F.when(~found, F.lit(rules.NOT_DOWNLOADED)).alias("error"),
    )


def rebuild_summary(rebuilt: DataFrame) -> DataFrame:
    good = F.col("status").eqNullSafe(F.lit(SUCCESS))
    rate = F.round(ratio(F.col("downloaded_count"), F.col("total_count"), 100.0), 2)
    return rebuilt.agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(good).alias("downloaded_count"),
        F.count_if(~good).alias("failed_count"),
        F.coalesce(F.sum(F.when(good, F.col(SIZE))), F.lit(0)).alias("total_size"),
    ).select("*", rate.alias("success_rate"), rate.alias("completion_percentage"))
