"""Batches, estimates and synchronisation plans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.functions import measures, paths, rules
from estate.functions.measures import gb
from estate.operators.ordering import number_in_place

PATH, SIZE, MODIFIED = "relative_path", "size_bytes", "modified_ts"


def assign_batches(files: DataFrame, batch_size: int = 100, smallest_first: bool = True) -> DataFrame:
    """Add ``position`` and ``batch`` in order of (size, path), or of path alone."""
    order = [SIZE, PATH] if smallest_first else [PATH]
    return with_batch(number_in_place(files, order, ordinal="position"), batch_size)


def with_batch(numbered: DataFrame, batch_size: int) -> DataFrame:
    batch = F.floor((F.col("position") - 1) / batch_size).cast("bigint") + 1
    return numbered.withColumn("batch", batch)


def resume_batches(
    files: DataFrame, completed: DataFrame, batch_size: int = 100, smallest_first: bool = True
) -> DataFrame:
    """Resume from a ledger of whole batches: the files of the batches that ``completed`` does not name.

    The batches must have been cut from the same files with the same size and order.
    """
    done = completed.select("batch").distinct()
    return assign_batches(files, batch_size, smallest_first).join(done, "batch", "left_anti")


def dirs_creation_order(directories: DataFrame, batch_size: int = 10) -> DataFrame:
    """Shallowest first, in batches."""
    keyed = directories.withColumn("depth", paths.depth("directory"))
    return with_batch(number_in_place(keyed, ["depth", "directory"], ordinal="position"), batch_size)


def migration_estimate(files: DataFrame, as_of: datetime | str) -> DataFrame:
    """Duration, cost and batch size of a whole inventory, one row."""
    old = F.col(MODIFIED) < measures.timestamp(as_of) - F.make_dt_interval(F.lit(rules.ARCHIVE_AFTER_DAYS))
    totals = files.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum(SIZE), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.sum(F.when(old, F.col(SIZE))), F.lit(0)).alias("archive_bytes"),
    )
    return estimate_from_totals(totals)


def estimate_from_totals(totals: DataFrame) -> DataFrame:
    total_gb = gb("total_bytes")
    cost = total_gb * rules.STORAGE_COST_PER_GB
    return totals.select(
        "file_count",
        "total_bytes",
        F.round(total_gb / rules.GB_PER_HOUR, 6).alias("duration_hours"),
        F.round(cost, 6).alias("monthly_cost"),
        F.format_string("$%.2f/month", cost).alias("monthly_cost_label"),
        F.least(F.lit(rules.MAX_BATCH_SIZE), F.floor(F.col("file_count") / 10)).cast("bigint").alias("batch_size"),
        F.round(F.col("file_count") / rules.FILES_PER_SECOND_HOST_COPY / 3600, 1).alias("file_rate_hours"),
        F.round(gb("archive_bytes") * rules.ARCHIVE_COST_PER_GB, 6).alias("archive_cost"),
    )


def adaptive_batch_size(files: DataFrame) -> DataFrame:
    """Batch size per folder from its average file size."""
    avg = F.col("total_bytes") / F.col("file_count")
    size = None
    for limit, batch in rules.ADAPTIVE_BATCH:
        size = F.when(avg < limit, F.lit(batch)) if size is None else size.when(avg < limit, F.lit(batch))
    per_folder = files.groupBy(paths.parent_dir(PATH).alias("directory")).agg(
        F.count(F.lit(1)).alias("file_count"), F.sum(SIZE).alias("total_bytes")
    )
    return per_folder.select(
        "directory",
        F.round(avg, 6).alias("avg_bytes"),
        size.otherwise(F.lit(rules.ADAPTIVE_BATCH_OTHERWISE)).alias("batch_size"),
    )


def sync_plan(source: DataFrame, target: DataFrame) -> DataFrame:
    """Action per source file; files only at the target are left alone.

    A target that lists a path more than once counts with its newest row.
    """
    there = target.groupBy(paths.normalize_path(PATH).alias("_there")).agg(F.max(MODIFIED).alias("target_ts"))
    action = (
        F.when(F.col("_there").isNull(), "create")
        .when(F.col(MODIFIED) > F.col("target_ts"), "overwrite")
        .otherwise("skip")
    )
    return paths.keyed_by_path(source, PATH).join(there, F.col("_key") == F.col("_there"), "left").select(PATH, SIZE, action.alias("action"))


def new_files(latest: DataFrame, previous: DataFrame, key: str = "path") -> DataFrame:
    """Rows of the latest listing whose path the previous one does not name."""
    known = previous.select(paths.normalize_path(key).alias("_known")).distinct()
    return paths.keyed_by_path(latest, key).join(known, F.col("_key") == F.col("_known"), "left_anti").drop("_key")


def migration_ready(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest rows whose file exists, under its normalised target path."""
    present = files.select(paths.normalize_path(PATH).alias("target_path")).distinct()
    keyed = manifest.withColumn("target_path", paths.normalize_path("path"))
    return keyed.join(present, "target_path", "left_semi")


def sample_migration(ready: DataFrame, n: int = 100) -> DataFrame:
    """First ready files, for a trial run."""
    return ready.orderBy("target_path").limit(n)


def manifest_scope(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Listed files, target folders, bytes and ready files, one row."""
    present = files.select(paths.normalize_path(PATH).alias("target_path")).distinct().withColumn("_ready", F.lit(1))
    keyed = manifest.withColumn("target_path", paths.normalize_path("path"))
    per_folder = (
        keyed.join(present, "target_path", "left")
        .groupBy(paths.parent_dir("target_path").alias("directory"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.count("_ready").alias("ready"))
    )
    return per_folder.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("listed_files"),
        F.count(F.lit(1)).alias("target_directories"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.sum("ready"), F.lit(0)).alias("ready_files"),
    )
