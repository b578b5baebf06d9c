"""Operators over the file inventory ``(relative_path, size_bytes, modified_ts)``."""

from __future__ import annotations

import json
import mimetypes
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.functions import classify, measures, paths, rules
from estate.functions.measures import gb, mb
from estate.operators.ordering import top_n_per_group

PATH, SIZE, MODIFIED = "relative_path", "size_bytes", "modified_ts"


# --- columns ----------------------------------------------------------------
def normalize_paths(df: DataFrame, column: str, out: str = PATH, url: bool = False) -> DataFrame:
    return df.withColumn(out, paths.normalize_path(column, url))


def file_attributes(files: DataFrame) -> DataFrame:
    """Add name, folder, extension, MB and GB."""
    return files.select(
        "*",
        paths.file_name(PATH).alias("name"),
        paths.parent_dir(PATH).alias("parent_dir"),
        paths.extension(paths.file_name(PATH)).alias("extension"),
        mb(SIZE).alias("size_mb"),
        gb(SIZE).alias("size_gb"),
    )


def with_top_folder(files: DataFrame) -> DataFrame:
    return files.withColumn("top_folder", paths.top_folder(PATH))


def mime_table(files: DataFrame) -> DataFrame:
    """The standard extension table of the Python library: about 170 rows, a fixed size."""
    known = F.from_json(F.lit(json.dumps(mimetypes.MimeTypes().types_map[True])), "map<string,string>")
    return files.sparkSession.range(1).select(F.explode(known).alias("mime_extension", "mime_type"))


def with_mime_type(files: DataFrame, path: str = PATH) -> DataFrame:
    """Add the MIME type of the extension, null when unknown.

    A compression suffix is ignored, and the short forms of compressed archives are
    read as such.
    """
    name = paths.file_name(path)
    short = F.lower(F.regexp_extract(name, r"\.(tgz|taz|tz|tbz2|txz)$", 1))
    plain = F.regexp_replace(name, r"\.(gz|Z|bz2|xz|br)$", "")
    ext = (
        F.when(short != "", F.lit(".tar"))
        .when(F.endswith(F.lower(plain), F.lit(".svgz")), F.lit(".svg"))
        .otherwise(paths.extension(plain))
    )
    keyed = files.withColumn("mime_extension", ext)
    return keyed.join(F.broadcast(mime_table(files)), "mime_extension", "left").drop("mime_extension")


def with_document_type(files: DataFrame) -> DataFrame:
    return files.withColumn("document_type", classify.document_type(paths.file_name(PATH)))


def with_file_id(files: DataFrame) -> DataFrame:
    return files.withColumn("file_id", paths.file_id(PATH))


def with_target(files: DataFrame, base: str) -> DataFrame:
    return files.withColumn("target_path", paths.target_path(base, PATH))


def with_target_uri(df: DataFrame, column: str, out: str = "target_uri") -> DataFrame:
    return df.withColumn(out, paths.encode_target_uri(column))


def with_size_bucket(files: DataFrame) -> DataFrame:
    return files.withColumn("size_bucket", measures.size_bucket(SIZE))


def with_age_bucket(files: DataFrame, as_of: datetime | str, column: str = MODIFIED) -> DataFrame:
    return files.withColumn("age_bucket", measures.age_bucket(column, as_of))


def with_human_size(files: DataFrame) -> DataFrame:
    return files.withColumn("size_label", measures.human_size(SIZE))


def large_files(files: DataFrame, above: int = rules.LARGE_FILE_ABOVE) -> DataFrame:
    return files.filter(F.col(SIZE) > above)


def preflight_violations(files: DataFrame, base: str) -> DataFrame:
    """One row per file and broken target limit."""
    target = paths.target_path(base, PATH)
    broken = F.array(
        F.when(F.col(SIZE) > rules.MAX_FILE_BYTES, F.lit("file_too_large")),
        F.when(F.length(target) > rules.MAX_PATH_CHARS, F.lit("path_too_long")),
        F.when(F.rlike(paths.file_name(PATH), F.lit(rules.SPECIAL_CHARACTERS)), F.lit("special_characters")),
    )
    return files.select(PATH, SIZE, F.explode(F.array_compact(broken)).alias("rule"))


def build_catalog(
    files: DataFrame, base: str, migration_date: datetime | str, source_system: str, checksums: DataFrame | None = None
) -> DataFrame:
    """The 15-column catalogue; ``checksums`` is an optional ``(relative_path, checksum)``."""
    rows = with_mime_type(files)
    if checksums is not None:
        rows = rows.join(checksums.select(PATH, "checksum"), PATH, "left")
    elif "checksum" not in rows.columns:
        rows = rows.withColumn("checksum", F.lit(None).cast("string"))
    if "created_ts" not in rows.columns:
        rows = rows.withColumn("created_ts", F.lit(None).cast("timestamp_ntz"))
    name = paths.file_name(PATH)
    values: dict[str, Column] = {
        "file_id": paths.file_id(PATH),
        "file_name": name,
        "file_path": F.col(PATH),
        "target_path": paths.target_path(base, PATH),
        "file_size_bytes": F.col(SIZE),
        "file_extension": paths.extension(name),
        "mime_type": F.col("mime_type"),
        "created_date": F.col("created_ts"),
        "modified_date": F.col(MODIFIED),
        "migration_date": measures.timestamp(migration_date),
        "migration_status": F.lit("pending"),
        "checksum": F.col("checksum"),
        "source_system": F.lit(source_system),
        "document_type": classify.document_type(name),
        "folder_structure": paths.parent_dir(PATH),
    }
    return rows.select([values[c].cast(t.lower()).alias(c) for c, t in rules.CATALOG_COLUMNS])


# --- roll-ups ---------------------------------------------------------------
def _count_and_size() -> list[Column]:
    total = F.coalesce(F.sum(SIZE), F.lit(0)).cast("bigint")
    return [F.count(F.lit(1)).alias("file_count"), total.alias("total_bytes"), F.round(gb(total), 6).alias("total_gb")]


def inventory_totals(files: DataFrame) -> DataFrame:
    return files.agg(*_count_and_size()).withColumn(
        "avg_mb", F.round(measures.ratio(mb("total_bytes"), F.col("file_count")), 6)
    )


def by_extension(files: DataFrame) -> DataFrame:
    return files.groupBy(paths.extension_label(paths.file_name(PATH)).alias("extension")).agg(*_count_and_size())


def by_directory(files: DataFrame) -> DataFrame:
    return files.groupBy(paths.parent_dir(PATH).alias("directory")).agg(*_count_and_size())


def by_document_type(files: DataFrame) -> DataFrame:
    """Files and GB per document type, largest first."""
    kind = classify.document_type(paths.file_name(PATH)).alias("document_type")
    return files.groupBy(kind).agg(*_count_and_size()).orderBy(F.desc("total_bytes"), "document_type")


def file_stats(files: DataFrame) -> DataFrame:
    """Totals, distinct folders and average size; dot-files are left out."""
    visible = files.filter(~F.startswith(paths.file_name(PATH), F.lit(".")))
    per_folder = visible.groupBy(paths.parent_dir(PATH).alias("directory")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(SIZE).alias("bytes")
    )
    return per_folder.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("file_count"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
        F.count(F.lit(1)).alias("folder_count"),
    ).withColumn("avg_bytes", F.round(measures.ratio(F.col("total_bytes"), F.col("file_count")), 6))


def size_distribution(files: DataFrame) -> DataFrame:
    return files.groupBy(measures.size_bucket(SIZE).alias("size_bucket")).agg(F.count(F.lit(1)).alias("file_count"))


def age_distribution(registry: DataFrame, as_of: datetime | str) -> DataFrame:
    """Files per age class; the ledger time is preferred to the modification time."""
    ts = F.coalesce("ledger_ts", MODIFIED) if "ledger_ts" in registry.columns else F.col(MODIFIED)
    return registry.groupBy(measures.age_bucket(ts, as_of).alias("age_bucket")).agg(
        F.count(F.lit(1)).alias("file_count")
    )


def folder_distribution(files: DataFrame, n: int = 10, path: str = PATH) -> DataFrame:
    folder = paths.top_folder(path)
    counts = files.filter(folder.isNotNull()).groupBy(folder.alias("top_folder")).agg(
        F.count(F.lit(1)).alias("file_count")
    )
    return counts.orderBy(F.desc("file_count"), "top_folder").limit(n)


def insight_summary(registry: DataFrame) -> DataFrame:
    """One row of totals over a unified registry.

    Extension and top folder are pre-aggregated together, so the two distinct counts
    run over that small table instead of expanding every row.
    """
    ext = paths.extension_label(paths.file_name("path"))
    small = registry.groupBy(ext.alias("ext"), paths.top_folder("path").alias("folder")).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("is_downloaded")).alias("downloaded"),
        F.count_if(F.col(SIZE) > 0).alias("sized"),
        F.sum(F.when(F.col(SIZE) > 0, F.col(SIZE))).alias("bytes"),
    )
    total = small.agg(
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("b"),
        F.countDistinct("ext").alias("unique_file_types"),
        F.countDistinct("folder").alias("unique_folders"),
        F.coalesce(F.sum("files"), F.lit(0)).alias("files_processed"),
        F.coalesce(F.sum("downloaded"), F.lit(0)).alias("files_downloaded"),
        F.coalesce(F.sum("sized"), F.lit(0)).alias("files_with_size"),
    )
    return total.select(
        F.round(gb("b"), 2).alias("total_size_gb"),
        F.round(mb("b") / F.greatest("files_downloaded", F.lit(1)), 2).alias("avg_file_size_mb"),
        "unique_file_types",
        "unique_folders",
        "files_processed",
        "files_downloaded",
        "files_with_size",
    )


def sample_per_dir(files: DataFrame, per_directory: int, overall: int) -> DataFrame:
    """A sampling operator: the first files by path of each folder, and of all folders."""
    keyed = files.withColumn("directory", paths.parent_dir(PATH))
    first = top_n_per_group(keyed, ["directory"], [PATH], per_directory, salt_on=PATH)
    return first.orderBy(PATH).limit(overall)


def estimate_total_size(files: DataFrame) -> DataFrame:
    """Total size of the files of transferred types: the exact sum, so the scale factor is 1."""
    eligible = classify.is_transfer_type(paths.file_name(PATH))
    return files.agg(
        F.count(F.lit(1)).alias("all_files"),
        F.count_if(eligible).alias("sampled_files"),
        F.coalesce(F.sum(F.when(eligible, F.col(SIZE))), F.lit(0)).cast("bigint").alias("sampled_bytes"),
    ).select("*", F.lit(1.0).alias("scale_factor"), F.round(gb("sampled_bytes"), 6).alias("estimated_gb"))


def top_types_by_size(files: DataFrame, n: int = 10) -> DataFrame:
    return by_extension(files).orderBy(F.desc("total_bytes"), "extension").limit(n)


def top_types_by_count(files: DataFrame, n: int = 10) -> DataFrame:
    return by_extension(files).orderBy(F.desc("file_count"), "extension").limit(n)


def largest_files(files: DataFrame, n: int = 10) -> DataFrame:
    return (
        files.filter(F.col(SIZE) > 0)
        .orderBy(F.desc(SIZE), PATH)
        .limit(n)
        .select(PATH, SIZE, F.round(mb(SIZE), 2).alias("size_mb"), measures.human_size(SIZE).alias("size_label"))
    )


def recent_files(files: DataFrame, n: int = 10) -> DataFrame:
    return (
        files.orderBy(F.desc(MODIFIED), PATH)
        .limit(n)
        .select(PATH, MODIFIED, F.round(mb(SIZE), 2).alias("size_mb"), classify.path_tail(PATH).alias("path_tail"))
    )


# --- directories ------------------------------------------------------------
def directory_prefixes(files: DataFrame, base: str, shortest: int = 2) -> DataFrame:
    """Every folder holding files and its ancestors below ``base``.

    Folders are made distinct before they are exploded, so the work after the first
    shuffle is by folder and not by file.
    """
    folder = paths.parent_dir(PATH)
    folders = files.filter(folder != rules.ROOT_DIRECTORY).select(folder.alias("folder")).distinct()
    return prefixes_of(folders, base, shortest)


def prefixes_of(folders: DataFrame, base: str, shortest: int = 2) -> DataFrame:
    """``directory_prefixes`` over a ready list of folders in a column ``folder``."""
    full = paths.target_path(base, paths.normalize_path("folder"))
    return folders.select(F.explode(paths.path_prefixes(full, shortest)).alias("directory")).distinct()


def dirs_by_depth(directories: DataFrame) -> DataFrame:
    return directories.groupBy(paths.depth("directory").alias("depth")).agg(F.count(F.lit(1)).alias("directory_count"))


def top_dirs_per_depth(directories: DataFrame, n: int = 5) -> DataFrame:
    """First folders by name per depth, and how many more there are."""
    keyed = directories.withColumn("depth", paths.depth("directory"))
    first = top_n_per_group(keyed, ["depth"], ["directory"], n, salt_on="directory")
    more = keyed.groupBy("depth").agg(F.greatest(F.count(F.lit(1)) - n, F.lit(0)).cast("bigint").alias("more"))
    return first.join(more, "depth").select("depth", "directory", "more")


def missing_dirs(required: DataFrame, created: DataFrame) -> DataFrame:
    return required.join(created.select("directory").distinct(), "directory", "left_anti")


def dir_coverage(created: DataFrame, attempted: DataFrame) -> DataFrame:
    """Created against attempted folders: both, created_only or attempted_only."""
    left = created.select("directory").distinct().withColumn("_made", F.lit(True))
    right = attempted.select("directory").distinct().withColumn("_tried", F.lit(True))
    state = (
        F.when(F.col("_made") & F.col("_tried"), "both")
        .when(F.col("_made"), "created_only")
        .otherwise("attempted_only")
    )
    return left.join(right, "directory", "full_outer").select("directory", state.alias("coverage"))
