"""JSON documents: source listings and transfer ledgers in their six layouts.

One document is one JSON value; with ``multi_line=False`` each line is a document, which
lets Spark split large inputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estate.functions import rules
from estate.functions.measures import wall

# --- Fixed values: document schemas ----------------------------------------
MANIFEST = (
    "files ARRAY<STRUCT<id: STRING, name: STRING, path: STRING, download_url: STRING, size: BIGINT>>, "
    "timestamp STRING, total_files BIGINT, site_id STRING, drive_id STRING, folder_id STRING"
)
MANIFEST_ENTRY = "id STRING, name STRING, path STRING, download_url STRING, size BIGINT"
INVENTORY = (
    "timestamp STRING, files ARRAY<STRUCT<path: STRING, relative_path: STRING, size_bytes: BIGINT, modified_time: DOUBLE>>"
)
DIRECTORIES = "timestamp STRING, total_directories BIGINT, directories ARRAY<STRING>"
_RESULTS = (
    "last_processed_index BIGINT, timestamp STRING, turbo_mode BOOLEAN, total_count BIGINT, is_running BOOLEAN, "
    "results STRUCT<"
    "success: ARRAY<STRUCT<status: STRING, file: STRING, path: STRING, local_path: STRING, skipped: BOOLEAN, "
    "size: BIGINT, timestamp: STRING>>, "
    "failed: ARRAY<STRUCT<status: STRING, file: STRING, path: STRING, error: STRING, timestamp: STRING>>>"
)
LEDGER_LAYOUTS = {
    # results.success / results.failed, keyed by file
    "L1": _RESULTS,
    # completed_files as a map from path
    "L2": "total_files BIGINT, uploaded_files BIGINT, failed_files BIGINT, skipped_files BIGINT, "
    "completed_files MAP<STRING, STRUCT<status: STRING, size: BIGINT, timestamp: DOUBLE, batch: INT>>, "
    "failed_files_list ARRAY<STRUCT<path: STRING, error: STRING, timestamp: DOUBLE, batch: INT>>, "
    "start_time DOUBLE, last_update DOUBLE",
    # completed_files as an array of paths
    "L3": "completed_files ARRAY<STRING>, failed_files ARRAY<STRUCT<file: STRING, error: STRING, timestamp: STRING>>",
    # completed batches only, with the failures
    "L4": "completed_batches ARRAY<INT>, last_batch INT, "
    "failed_files ARRAY<STRUCT<file: STRING, error: STRING, timestamp: STRING>>",
    # rebuilt: as L1, keyed by path
    "L5": _RESULTS,
    # failures only: objects or bare path strings
    "L6": "failed_files ARRAY<STRING>, error_count BIGINT, start_time STRING, downloaded_count BIGINT, total_count BIGINT",
}
_FAILURE = "path STRING, file STRING, error STRING, timestamp STRING"


def read_manifest(spark: SparkSession, path: str, multi_line: bool = True, bare: bool = False) -> DataFrame:
    """One row per listed file with the header of its snapshot.

    ``bare`` reads documents that are just an array of entries (or one entry per line).
    """
    reader = spark.read.option("multiLine", str(multi_line).lower()).option("recursiveFileLookup", "true")
    if bare:
        rows = reader.schema(MANIFEST_ENTRY).json(path)
        header = {"timestamp": "string", "total_files": "bigint", "site_id": "string", "drive_id": "string"}
        return rows.select(
            "path", "id", "name", "download_url", "size", *[F.lit(None).cast(t).alias(c) for c, t in header.items()]
        )
    rows = reader.schema(MANIFEST).json(path)
    entry = rows.select("timestamp", "total_files", "site_id", "drive_id", F.explode("files").alias("f"))
    return entry.select(
        "f.path", "f.id", "f.name", "f.download_url", "f.size", "timestamp", "total_files", "site_id", "drive_id"
    )


def read_inventory(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A stored inventory as ``(relative_path, size_bytes, modified_ts)``."""
    rows = spark.read.option("multiLine", str(multi_line).lower()).schema(INVENTORY).json(path)
    f = rows.select(F.explode("files").alias("f"))
    return f.select("f.relative_path", "f.size_bytes", _epoch(F.col("f.modified_time")).alias("modified_ts"))


def read_directories(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    rows = spark.read.option("multiLine", str(multi_line).lower()).schema(DIRECTORIES).json(path)
    return rows.select(F.explode("directories").alias("directory"))


def read_ledger(spark: SparkSession, path: str, layout: str, multi_line: bool = True) -> DataFrame:
    """One row per outcome of the ledger documents below ``path``."""
    reader = spark.read.option("multiLine", str(multi_line).lower()).option("recursiveFileLookup", "true")
    docs = reader.schema(LEDGER_LAYOUTS[layout]).json(path)
    return ledger_rows(docs.withColumn("ledger_id", F.col("_metadata.file_name")), layout)


def _iso(text: Column) -> Column:
    return F.regexp_replace(text, "Z$", "").try_cast("timestamp_ntz")


def _epoch(seconds: Column) -> Column:
    return wall(F.timestamp_micros(F.round(seconds * 1_000_000).cast("bigint")))


#: columns of an outcome beside the id of its document
_OUTCOME = {
    "layout": "string",
    "path": "string",
    "status": "string",
    "skipped": "boolean",
    "error": "string",
    "size_bytes": "bigint",
    "event_ts": "timestamp_ntz",
    "batch": "int",
}


def _outcome(layout: str, key: Column, status: Column | str, **given: Column) -> Column:
    """The outcome of one entry; what a layout does not hold is null."""
    given = {
        "layout": F.lit(layout), "path": key, "status": F.lit(status) if isinstance(status, str) else status, "skipped": F.lit(False), **given
    }
    return F.struct(*[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in _OUTCOME.items()])


def _named(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _each(entries: Column, outcome: Callable[[Column], Column]) -> Column:
    """The outcomes of an array that may be missing."""
    return F.transform(F.coalesce(entries, F.array()), outcome)


def _failure(layout: str, key: str, time: Callable[[Column], Column], batch: bool = False) -> Callable[[Column], Column]:
    def outcome(r: Column) -> Column:
        more = {"batch": r["batch"]} if batch else {}
        return _outcome(layout, _named(r[key]), "failed", error=r["error"], event_ts=time(r["timestamp"]), **more)

    return outcome


def _outcomes(layout: str) -> Column:
    """All outcomes of a document of one layout, successes first, as one array."""
    if layout in ("L1", "L5"):
        key = lambda r: F.coalesce(_named(r["path"]), _named(r["file"]))
        good = _each(
            F.col("results.success"),
            lambda r: _outcome(
                layout, key(r), "success", skipped=F.coalesce(r["skipped"], F.lit(False)), size_bytes=r["size"], event_ts=_iso(r["timestamp"])
            ),
        )
        bad = _each(
            F.col("results.failed"),
            lambda r: _outcome(layout, key(r), F.coalesce(r["status"], F.lit("failed")), error=r["error"], event_ts=_iso(r["timestamp"])),
        )
        return F.concat(good, bad)
    if layout == "L2":
        good = _each(
            F.map_entries("completed_files"),
            lambda r: _outcome(
                layout, _named(r["key"]), "success",
                size_bytes=r["value"]["size"], event_ts=_epoch(r["value"]["timestamp"]), batch=r["value"]["batch"],
            ),
        )
        return F.concat(good, _each(F.col("failed_files_list"), _failure(layout, "path", _epoch, batch=True)))
    if layout == "L3":
        good = _each(F.col("completed_files"), lambda p: _outcome(layout, _named(p), "success"))
        return F.concat(good, _each(F.col("failed_files"), _failure(layout, "file", _iso)))
    if layout == "L4":
        return _each(F.col("failed_files"), _failure(layout, "file", _iso))
    if layout == "L6":

        def either(e: Column) -> Column:
            is_object = F.startswith(F.ltrim(e), F.lit("{"))
            r = F.when(is_object, F.from_json(e, _FAILURE))
            return _outcome(
                layout,
                F.when(is_object, F.coalesce(_named(r["path"]), _named(r["file"]))).otherwise(_named(e)),
                "failed",
                error=F.when(is_object, r["error"]).otherwise(F.lit(rules.DOWNLOAD_FAILED)),
                event_ts=_iso(r["timestamp"]),
            )

        return _each(F.col("failed_files"), either)
    raise ValueError(f"unknown ledger layout {layout!r}")


def ledger_rows(docs: DataFrame, layout: str) -> DataFrame:
    """Outcome rows of parsed documents of one layout, each read once; rows without a path are dropped."""
    rows = docs.select("ledger_id", F.inline(_outcomes(layout)))
    return rows.select("layout", "ledger_id", *[c for c in _OUTCOME if c != "layout"]).filter(F.col("path").isNotNull())


def ledger_batches(docs: DataFrame) -> DataFrame:
    """Completed batch numbers of L4 documents."""
    return docs.select("ledger_id", F.explode("completed_batches").alias("batch"))


def read_ledger_batches(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Completed batch numbers of the L4 documents below ``path``; their failures come from ``read_ledger``."""
    reader = spark.read.option("multiLine", str(multi_line).lower()).option("recursiveFileLookup", "true")
    docs = reader.schema(LEDGER_LAYOUTS["L4"]).json(path)
    return ledger_batches(docs.withColumn("ledger_id", F.col("_metadata.file_name")))


def read_ledger_tolerant(spark: SparkSession, path: str, layout: str = "L1", multi_line: bool = True) -> DataFrame:
    """Parsed documents that never fail the job.

    A document is parsed as it is; else after dropping trailing commas and space and
    closing the outer brace; else it is reported with ``is_corrupt``.
    """
    texts = (
        spark.read.option("wholetext", str(multi_line).lower())
        .option("recursiveFileLookup", "true")
        .text(path)
        .withColumn("ledger_id", F.col("_metadata.file_name"))
    )
    return parse_tolerant(texts, layout)


def parse_tolerant(texts: DataFrame, layout: str = "L1") -> DataFrame:
    """``read_ledger_tolerant`` over a table ``(ledger_id, value)``."""
    schema = LEDGER_LAYOUTS[layout] + ", _bad STRING"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    cut = F.regexp_replace("value", r"[,\n\r\t ]+$", "")
    closed = F.when(F.rlike(cut, F.lit(r"[}\]]$")), cut).otherwise(F.concat(cut, F.lit("}")))
    usable = lambda c: F.col(c).isNotNull() & F.col(f"{c}._bad").isNull()
    parsed = texts.withColumn("_first", F.from_json("value", schema, options)).withColumn(
        "_second", F.when(~usable("_first"), F.from_json(closed, schema, options))
    )
    doc = F.when(usable("_first"), F.col("_first")).when(usable("_second"), F.col("_second"))
    return parsed.select("ledger_id", doc.alias("_doc")).select(
        "ledger_id", F.col("_doc").isNull().alias("is_corrupt"), "_doc.*"
    ).drop("_bad")
