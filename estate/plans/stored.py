"""Queries that go through stored files: Spark writes them from the given tables, the
operator under test reads them back.  Stored documents are cut by key range, one per
line, so none grows with the data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estate.functions.measures import seconds_between, timestamp
from estate.functions.paths import parent_dir
from estate.operators import inventory, ledger, planning
from estate.plans import tables as t
from estate.session import new_location
from estate.sources import documents, files, loglines, sinks

Query = Callable[[SparkSession, str], DataFrame]
ENTRIES_PER_DOCUMENT = 500
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _as_files(spark: SparkSession, d: str, elsewhere: str = "false", label: str = "files") -> str:
    root = new_location(spark, label)
    _run(files.write_files(t.elsewhere(t.contents(spark, d), "relative_path", F.expr(elsewhere)), root))
    return root


@query
def scan_files(spark, d):
    return files.scan_files(spark, _as_files(spark, d)).select("relative_path", "size_bytes")


@query
def scan_files_filtered(spark, d):
    root = new_location(spark, "files")
    folder, name = F.regexp_replace("relative_path", "[^/]*$", ""), F.substring_index("relative_path", "/", -1)
    hidden = F.when(F.col("doc_id") % 6 == 0, F.concat(folder, F.lit("."), name)).otherwise(F.col("relative_path"))
    _run(files.write_files(t.contents(spark, d).withColumn("relative_path", hidden), root))
    return files.scan_files_filtered(spark, root).select("relative_path", "size_bytes")


@query
def content_checksum(spark, d):
    root = _as_files(spark, d)
    return files.content_checksum(files.scan_files(spark, root), root)


@query
def copy_files(spark, d):
    source = _as_files(spark, d, "doc_id % 10 = 0", "source")
    target = _as_files(spark, d, "doc_id % 7 <> 0", "target")
    listed = t.contents(spark, d).select(F.col("relative_path").alias("path"))
    location = new_location(spark, "outcomes")
    # the outcomes are kept: reading them again must not copy again
    files.copy_files(listed, source, target, verify_md5=True).write.parquet(location)
    return spark.read.parquet(location)


@query
def copy_sync_plan(spark, d):
    """Create, overwrite and skip in one call: a third of the files is not there, some of the others are newer at the source."""
    source, target = _as_files(spark, d, label="source"), _as_files(spark, d, "doc_id % 3 = 0", "target")
    listed = t.contents(spark, d).select("relative_path", F.octet_length("content").cast("bigint").alias("size_bytes"), "doc_id", timestamp("2001-08-01 04:00:00").alias("modified_ts"))
    older = F.col("modified_ts") + F.make_dt_interval(F.col("doc_id") % 5 - 2)
    there = listed.filter("doc_id % 3 <> 0").withColumn("modified_ts", older)
    location = new_location(spark, "outcomes")
    files.apply_sync_plan(planning.sync_plan(listed, there), source, target).write.parquet(location)
    return spark.read.parquet(location)


@query
def read_manifest(spark, d):
    location = new_location(spark, "manifest")
    entry = F.struct("id", "name", "path", "download_url", "size")
    doc = F.floor(F.col("file_key") / ENTRIES_PER_DOCUMENT).cast("bigint")
    rows = t.manifest(spark, d).groupBy(doc.alias("doc")).agg(F.collect_list(entry).alias("files"))
    text = F.to_json(
        F.struct(
            "files",
            F.lit("2001-08-01T00:00:00").alias("timestamp"),
            F.size("files").alias("total_files"),
            F.lit("site-1").alias("site_id"),
            F.concat(F.lit("drive-"), F.col("doc").cast("string")).alias("drive_id"),
        )
    )
    rows.select(text.alias("value")).write.text(location)
    return documents.read_manifest(spark, location, multi_line=False)


@query
def read_inventory(spark, d):
    location = new_location(spark, "inventory")
    epoch = seconds_between(F.col("modified_ts"), timestamp("1970-01-01"))
    entry = F.struct(F.col("relative_path").alias("path"), "relative_path", "size_bytes", epoch.alias("modified_time"))
    doc = F.floor(F.col("file_key") / ENTRIES_PER_DOCUMENT)
    rows = t.files(spark, d).groupBy(doc.alias("doc")).agg(F.collect_list(entry).alias("files"))
    rows.select(F.to_json(F.struct(F.lit("2001-08-01T00:00:00").alias("timestamp"), "files")).alias("value")).write.text(location)
    return documents.read_inventory(spark, location, multi_line=False)


@query
def read_directories(spark, d):
    """One document per parent folder."""
    location = new_location(spark, "directories")
    rows = t.directories(spark, d).groupBy(parent_dir("directory").alias("parent")).agg(F.collect_list("directory").alias("directories"))
    rows.select(F.to_json(F.struct(F.size("directories").alias("total_directories"), "directories")).alias("value")).write.text(location)
    return documents.read_directories(spark, location, multi_line=False)


@query
def resume_batches(spark, d):
    """Ledgers of whole batches, one per nation: together they name every second batch up to twice the suppliers."""
    location = new_location(spark, "batches")
    done = t.load(spark, d, "supplier").groupBy("s_nationkey").agg(F.collect_list(F.col("s_suppkey") * 2).alias("completed_batches"))
    done.select(F.to_json(F.struct("completed_batches", F.array_max("completed_batches").alias("last_batch"))).alias("value")).write.text(location)
    left = planning.resume_batches(t.files(spark, d), documents.read_ledger_batches(spark, location, multi_line=False))
    return left.select("relative_path", "size_bytes", "position", "batch")


def _ledger_documents(spark: SparkSession, d: str) -> DataFrame:
    """``(layout, doc, value)``: outcomes of ``events`` as JSON documents in all six layouts."""
    rows = t.load(spark, d, "events").select("event_id", *t.outcome_columns()).select(
        F.floor(F.col("event_id") / ENTRIES_PER_DOCUMENT).cast("bigint").alias("doc"),
        F.when(F.col("event_id") % 19 != 0, F.concat("path", F.lit("-"), F.col("event_id").cast("string")))
        .otherwise(F.lit(""))
        .alias("path"),
        "status",
        "skipped",
        "size_bytes",
        F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("iso"),
        seconds_between(F.col("event_ts"), timestamp("1970-01-01")).alias("epoch"),
        (F.col("event_id") % 10).cast("int").alias("batch"),
        F.concat(F.lit("HTTP "), (F.col("event_id") % 5 + 400).cast("string")).alias("error"),
    )
    layout = F.concat(F.lit("L"), (F.col("doc") % 6 + 1).cast("string"))
    good, bad = F.col("status") == "success", F.col("status") == "failed"

    def gather(where: Column, value: Column) -> Column:
        return F.collect_list(F.when(where, value))

    grouped = rows.groupBy(layout.alias("layout"), "doc").agg(
        gather(good, F.struct("status", F.col("path").alias("file"), "skipped")).alias("l1_ok"),
        gather(bad, F.struct("status", F.col("path").alias("file"), "error")).alias("l1_bad"),
        gather(
            good & (F.col("path") != ""),
            F.struct("path", F.struct(F.lit("completed").alias("status"), F.col("size_bytes").alias("size"), F.col("epoch").alias("timestamp"), "batch")),
        ).alias("l2_ok"),
        gather(bad, F.struct("path", "error", F.col("epoch").alias("timestamp"), "batch")).alias("l2_bad"),
        gather(good, F.col("path")).alias("l3_ok"),
        gather(bad, F.struct(F.col("path").alias("file"), "error", F.col("iso").alias("timestamp"))).alias("l3_bad"),
        gather(good, F.struct("path", F.col("size_bytes").alias("size"), F.col("iso").alias("timestamp"), "status")).alias("l5_ok"),
        gather(
            bad, F.struct("path", "error", F.col("iso").alias("timestamp"), F.lit("pending").alias("status"))
        ).alias("l5_bad"),
        gather(
            bad,
            F.when(F.col("batch") < 5, F.to_json(F.struct("path", "error", F.col("iso").alias("timestamp")))).otherwise(
                F.concat(F.lit('"'), F.col("path"), F.lit('"'))
            ),
        ).alias("l6_bad"),
    )
    results = lambda ok, no: F.to_json(
        F.struct(
            F.lit(ENTRIES_PER_DOCUMENT).alias("last_processed_index"),
            F.struct(F.col(ok).alias("success"), F.col(no).alias("failed")).alias("results"),
        )
    )
    text = (
        F.when(F.col("layout") == "L1", results("l1_ok", "l1_bad"))
        .when(
            F.col("layout") == "L2",
            F.to_json(F.struct(F.map_from_entries("l2_ok").alias("completed_files"), F.col("l2_bad").alias("failed_files_list"))),
        )
        .when(
            F.col("layout") == "L3",
            F.to_json(F.struct(F.col("l3_ok").alias("completed_files"), F.col("l3_bad").alias("failed_files"))),
        )
        .when(
            F.col("layout") == "L4",
            F.to_json(F.struct(F.array(F.lit(1), F.lit(2)).alias("completed_batches"), F.col("l3_bad").alias("failed_files"))),
        )
        .when(F.col("layout") == "L5", results("l5_ok", "l5_bad"))
        .otherwise(F.concat(F.lit('{"error_count": 1, "failed_files": ['), F.array_join("l6_bad", ","), F.lit("]}")))
    )
    return grouped.select("layout", "doc", text.alias("value"))


@query
def read_ledger(spark, d):
    location = new_location(spark, "ledgers")
    _ledger_documents(spark, d).select("layout", "value").write.partitionBy("layout").text(location)
    out = None
    for layout in documents.LEDGER_LAYOUTS:
        # small inputs may not fill every layout
        present = f"{location}/layout={layout}"
        if not _exists(spark, present):
            continue
        rows = documents.read_ledger(spark, present, layout, multi_line=False)
        out = rows if out is None else out.unionByName(rows)
    return out.drop("ledger_id")


def _exists(spark: SparkSession, path: str) -> bool:
    from pyarrow import fs

    filesystem, plain = fs.FileSystem.from_uri(path)
    return filesystem.get_file_info(plain).type == fs.FileType.Directory


@query
def read_ledger_tolerant(spark, d):
    """Documents cut short, with a trailing comma, or broken beyond repair."""
    location = new_location(spark, "ledgers")
    doc = F.col("doc")
    whole = F.col("value")
    damaged = (
        F.when(doc % 4 == 1, F.left(whole, F.length(whole) - 1))
        .when(doc % 4 == 2, F.concat(whole, F.lit(",")))
        .when(doc % 4 == 3, F.left(whole, F.floor(F.length(whole) / 2).cast("int")))
        .otherwise(whole)
    )
    _ledger_documents_l1(spark, d).select(damaged.alias("value")).write.text(location)
    parsed = documents.read_ledger_tolerant(spark, location, "L1", multi_line=False)
    return parsed.select(
        "is_corrupt",
        F.coalesce(F.size("results.success"), F.lit(0)).cast("bigint").alias("success"),
        F.coalesce(F.size("results.failed"), F.lit(0)).cast("bigint").alias("failed"),
    ).groupBy("is_corrupt").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("success").alias("success"), F.sum("failed").alias("failed")
    )


def _ledger_documents_l1(spark: SparkSession, d: str) -> DataFrame:
    rows = t.load(spark, d, "events").select(
        F.floor(F.col("event_id") / 100).cast("bigint").alias("doc"), *t.outcome_columns()
    )
    ok = F.struct("status", F.col("path").alias("file"), "skipped")
    return rows.groupBy("doc").agg(
        F.collect_list(F.when(F.col("status") == "success", ok)).alias("success"),
        F.collect_list(F.when(F.col("status") == "failed", ok)).alias("failed"),
    ).select("doc", F.to_json(F.struct(F.struct("success", "failed").alias("results"), F.lit(100).alias("last_processed_index"))).alias("value"))


@query
def read_log_lines(spark, d):
    """Log files with an empty line after every tenth."""
    location = new_location(spark, "logs")
    lines = t.log_lines(spark, d)
    text = F.when(F.col("line_number") % 10 == 0, F.concat("raw_line", F.lit(" \n"))).otherwise(F.col("raw_line"))
    (
        lines.repartition("file")
        .sortWithinPartitions("file", "line_number")
        .select("file", text.alias("value"))
        .write.partitionBy("file")
        .text(location)
    )
    numbered = loglines.read_log_lines(spark, location)
    return numbered.select(F.regexp_extract("file", "file=([^/]+)/", 1).alias("file"), "line_number", "raw_line")


@query
def write_catalog(spark, d):
    location = new_location(spark, "catalog")
    catalog = inventory.build_catalog(t.files(spark, d), t.BASE, "2001-08-01 04:00:00", "library")
    sinks.write_catalog(catalog, location)
    return spark.read.parquet(location)


@query
def write_report_json(spark, d):
    location = new_location(spark, "report")
    sinks.write_report_json(inventory.by_directory(t.files(spark, d)), location)
    return spark.read.schema("directory string, file_count bigint, total_bytes bigint, total_gb double").json(location)


@query
def append_ledger(spark, d):
    """Two appends of the same batches leave each outcome once."""
    location = new_location(spark, "ledger")
    rows = t.ledger(spark, d)
    sinks.append_ledger(rows, location, "load")
    sinks.append_ledger(rows.filter("batch < 3"), location, "load")
    back = spark.read.schema(rows.schema).parquet(location)
    return back.select("run_id", "batch", "path", "attempt", "status", "size_bytes", "event_ts")


@query
def backup_ledger(spark, d):
    """The backup holds the rows as they were before the failures were cleared."""
    location = new_location(spark, "backup")
    rows = t.ledger(spark, d)
    sinks.backup_ledger(rows, location, "20010801_040000")
    kept, _ = ledger.clear_failed(rows, "2001-08-01 04:00:00")
    saved = spark.read.parquet(location)
    count = F.count(F.lit(1)).alias("entries")
    return (
        saved.groupBy("snapshot_id", "status")
        .agg(count)
        .unionByName(kept.groupBy("status").agg(count).withColumn("snapshot_id", F.lit("current")))
    )
