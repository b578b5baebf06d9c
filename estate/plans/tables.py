"""The estate's tables derived by Spark from the given star-schema tables.

orders are files, lineitem their transfer outcomes, events the log and the outcome
stream, region/nation/customer a folder tree, documents file contents, pages URIs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estate.functions import paths
from estate.operators.inventory import directory_prefixes
from estate.operators.ledger import failed
from estate.operators.progress import outcomes_over_time

BASE = "Files/Estate"
ROOT_ID = 0
EXTENSIONS = [".PDF", ".pdf", ".xls", ".msg", ".jpg", ".docx", ""]
PREFIXES = {"1": "Invoice_", "2": "receipt_", "3": "Contract_", "4": "Statement_"}
ERRORS = [
    "401 Client Error: Unauthorized for url: https://h/x",
    "404 Client Error: Not Found for url: https://h/x",
    "Read timed out",
    "HTTPSConnectionPool: Max retries exceeded",
    "429 Too Many Requests",
    "503 Server Error",
    "Permission denied",
    "checksum mismatch",
]
LOG_ERRORS = [
    "401 Client Error: Unauthorized for url: https://h/x",
    "Read timeout",
    "Connection reset",
    "429 Too Many Requests",
    "503 Server Error",
]
DOC_EXTENSIONS = [".pdf", ".xls", ".msg", ".txt", ".jpg"]


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _plus_seconds(ts: str, seconds: Column) -> Column:
    return F.col(ts) + F.make_dt_interval(secs=seconds)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_key, relative_path, size_bytes, modified_ts``"""
    key = F.col("o_orderkey")
    folder = F.when(
        F.col("o_orderstatus") == "P", F.concat(F.lit("Plant Invoices/P"), (key % 2 + 4).cast("string"), F.lit("/"))
    ).otherwise(F.concat(F.lit("Processed Invoices/"), F.date_format("o_orderdate", "yyyy/MM"), F.lit("/")))
    digit = F.left("o_orderpriority", F.lit(1))
    prefix = F.when(digit == "1", PREFIXES["1"])
    for d in ("2", "3", "4"):
        prefix = prefix.when(digit == d, PREFIXES[d])
    name = F.concat(prefix.otherwise("scan_"), key.cast("string"), _pick(EXTENSIONS, key % 7))
    size = F.when(key % 50 == 0, F.lit(0)).otherwise(F.floor(F.col("o_totalprice") * 200)).cast("bigint")
    return load(spark, sf_dir, "orders").select(
        key.alias("file_key"),
        F.concat(folder, name).alias("relative_path"),
        size.alias("size_bytes"),
        _plus_seconds("o_orderdate", key % 86400).alias("modified_ts"),
    )


def elsewhere(df: DataFrame, column: str, when: Column) -> DataFrame:
    """``df`` with the paths of some rows under another folder: they meet no row of the estate, and no row is lost."""
    return df.withColumn(column, F.when(when, F.concat(F.lit("Moved/"), F.col(column))).otherwise(F.col(column)))


def otherwise_written(df: DataFrame, column: str, key: Column) -> DataFrame:
    """``df`` with backslashes in the paths of some rows, doubled or leading slashes in those of others."""
    path = F.col(column)
    return df.withColumn(
        column,
        F.when(key % 6 == 1, F.replace(path, F.lit("/"), F.lit("\\")))
        .when(key % 6 == 2, F.replace(path, F.lit("/"), F.lit("//")))
        .when(key % 6 == 3, F.concat(F.lit("/"), path))
        .otherwise(path),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One outcome per lineitem row; its many repeated paths are the duplicate entries."""
    outcome = load(spark, sf_dir, "lineitem")
    bad = F.col("l_returnflag") == "R"
    extra = F.when(F.col("l_suppkey") % 10 == 0, 1).otherwise(0)
    known = files(spark, sf_dir).select("file_key", "relative_path", F.col("size_bytes").alias("file_size"))
    return outcome.join(known, outcome["l_orderkey"] == known["file_key"]).select(
        F.concat(F.lit("run_"), F.col("l_linestatus")).alias("run_id"),
        F.col("relative_path").alias("path"),
        F.col("l_linenumber").cast("int").alias("attempt"),
        F.when(bad & (F.col("l_partkey") % 16 == 3), "pending")
        .when(bad & (F.col("l_partkey") % 16 == 5), None)
        .when(bad, "failed")
        .otherwise("success")
        .alias("status"),
        (F.col("l_returnflag") == "A").alias("skipped"),
        F.when(bad, _pick(ERRORS, F.col("l_partkey") % 8)).alias("error"),
        F.when(bad, F.lit(0)).otherwise(F.col("file_size") + extra).cast("bigint").alias("size_bytes"),
        _plus_seconds("l_shipdate", F.col("l_partkey") % 86400).alias("event_ts"),
        (F.col("l_suppkey") % 10).cast("int").alias("batch"),
        F.col("l_orderkey").alias("entry_index"),
    )


def ledger_spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger with its paths written in several ways, those of one file too."""
    return otherwise_written(ledger(spark, sf_dir), "path", F.col("attempt") + F.col("entry_index"))


def manifest(spark: SparkSession, sf_dir: str, version: int = 2) -> DataFrame:
    """Source listing; version 1 holds a tenth of the files in another folder, names paths in several ways and some twice."""
    listed = files(spark, sf_dir)
    key = F.col("file_key")
    if version == 1:
        listed = elsewhere(listed, "relative_path", key % 10 == 0)
        listed = otherwise_written(listed.unionByName(listed.filter(key % 9 == 0)), "relative_path", key)
    return listed.select(
        F.when(key % 13 != 0, F.concat(F.lit("id-"), key.cast("string"))).alias("id"),
        paths.file_name(paths.normalize_path("relative_path")).alias("name"),
        F.col("relative_path").alias("path"),
        F.when(key % 11 == 0, "").otherwise(F.concat(F.lit("https://h/"), key.cast("string"))).alias("download_url"),
        F.col("size_bytes").alias("size"),
        key.alias("file_key"),
    )


def disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files found on disk: one of five in another folder, some listed twice, the older time with another size."""
    key = F.col("file_key")
    found = elsewhere(files(spark, sf_dir), "relative_path", key % 5 == 0)
    again = found.filter(key % 9 == 0).withColumns(
        {"size_bytes": F.col("size_bytes") + 7, "modified_ts": F.col("modified_ts") - F.make_dt_interval(F.lit(1))}
    )
    return found.unionByName(otherwise_written(again, "relative_path", key + 1)).transform(otherwise_written, "relative_path", key)


def target_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target inventory: one of four files in another folder, a third older than the source, some listed again with an older time."""
    key = F.col("file_key")
    earlier = lambda df, days: df.withColumn("modified_ts", F.col("modified_ts") - F.make_dt_interval(days))
    there = earlier(elsewhere(files(spark, sf_dir), "relative_path", key % 4 == 0), F.when(key % 3 == 0, 1).otherwise(0))
    there = there.unionByName(earlier(there.filter(key % 7 == 0), F.lit(5)))
    return otherwise_written(there, "relative_path", key).select("relative_path", "size_bytes", "modified_ts")


def directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return directory_prefixes(files(spark, sf_dir), BASE)


def created_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders created so far: those of one year in two stand in another folder, but for the ``P`` rows."""
    other = ~F.startswith("relative_path", F.lit("Plant")) & (F.year("modified_ts") % 2 != 0)
    return directory_prefixes(elsewhere(files(spark, sf_dir), "relative_path", other), BASE)


def attempted_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of the outcomes that are no success."""
    tried = failed(ledger(spark, sf_dir)).select(F.col("path").alias("relative_path"))
    return directory_prefixes(tried, BASE)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(*log_columns())


def all_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_id, raw_line`` over ``events``: each of the nine event types by turns, and lines of none."""
    eid, user = F.col("event_id"), F.col("user_id")
    text = lambda c: c.cast("string")
    kinds = [
        F.concat(F.lit("🔥 TURBO Progress: "), text(eid), F.lit("/"), text(eid + user), F.lit(" (12.5%) - "), text(user), F.lit(" new downloads")),
        F.concat(F.lit("🚀 Speed: "), text(user % 40), F.lit(".25 files/sec | ETA: 2.5 hours")),
        F.concat(F.lit("⏰ ETA: "), text(user % 90), F.lit(".75 hours")),
        F.concat(F.lit("✅ Downloaded: P1/f"), text(eid), F.lit(".pdf")),
        F.concat(F.lit("❌ Attempt "), text(user % 3 + 1), F.lit(" failed for P2/f"), text(eid), F.lit(".pdf: HTTP 429")),
        F.concat(F.lit("🔐 "), F.lit("Worker "), text(user), F.lit(": Authenticating")),
        F.concat(F.lit("📁 Processing folder: dir"), text(user), F.lit("/")),
        F.concat(F.lit("🚀 TURBO MODE: Using "), text(user % 64 + 1), F.lit(" parallel workers")),
        F.concat(F.lit("📂 TURBO: Resuming from file "), text(eid), F.lit("/"), text(eid + user)),
        F.concat(F.lit("Waiting for worker "), text(user)),
    ]
    message = F.element_at(F.array(*kinds), (eid % len(kinds) + 1).cast("int"))
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS")
    # generated, as in log_columns
    line = F.explode(F.array(F.concat(stamp, F.lit(" - INFO - "), message)))
    return load(spark, sf_dir, "events").select(eid.alias("line_id"), line.alias("raw_line"))


def log_columns() -> list[Column]:
    """``file, line_number, raw_line`` over ``events``, in batch or streaming: files of 1000 lines."""
    eid, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    text = lambda c: c.cast("string")
    attempt = F.concat(F.lit("WARNING - ❌ Attempt "), text(eid % 3 + 1), F.lit(" failed for P5/f"), text(user))
    message = (
        F.when(kind == "click", F.concat(F.lit("INFO - ✅ Downloaded: Plant Invoices/P4/f"), text(eid), F.lit(".pdf")))
        .when(kind == "error", F.concat(attempt, F.lit(".pdf: "), _pick(LOG_ERRORS, user % 5)))
        .when(kind == "view", F.concat(F.lit("INFO - 🚀 Speed: "), text(eid % 40), F.lit(".5 files/sec | ETA: 2.5 hours")))
        .when(
            kind == "purchase",
            F.concat(
                F.lit("INFO - 🔥 TURBO Progress: "),
                text(eid),
                F.lit("/10000 ("),
                text(F.floor(eid / 100).cast("bigint")),
                F.lit(".0%) - "),
                text(user),
                F.lit(" new downloads"),
            ),
        )
        .otherwise(F.concat(F.lit("INFO - 📁 Processing folder: dir"), text(user), F.lit("/")))
    )
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS")
    return [
        F.concat(F.lit("log-"), text(F.floor(eid / 1000).cast("bigint"))).alias("file"),
        (eid % 1000 + 1).cast("bigint").alias("line_number"),
        # generated, not projected: filters on a line must not repeat its derivation
        F.explode(F.array(F.concat(stamp, F.lit(" - "), message))).alias("raw_line"),
    ]


def outcome_columns() -> list[Column]:
    """Outcome rows over ``events``, in batch or streaming."""
    kind = F.col("event_type")
    return [
        F.concat(F.lit("P"), (F.col("user_id") % 6).cast("string"), F.lit("/f"), F.col("user_id").cast("string")).alias("path"),
        F.when(kind == "error", "failed").otherwise("success").alias("status"),
        (kind == "view").alias("skipped"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("size_bytes"),
        F.col("ts").alias("event_ts"),
    ]


#: arrivals that the outcomes are dealt to; some come one or two arrivals late
ARRIVALS = 8


def arriving_outcomes(spark: SparkSession, sf_dir: str, location: str) -> None:
    """The outcomes as files in the order of their arrival, one file for each of ``ARRIVALS`` equal stretches of time."""
    events = load(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(micros), F.max(micros)).first()
    on_time = F.call_function("div", (micros - F.lit(first)) * ARRIVALS, F.lit((last or 0) - (first or 0) + 1))
    late = F.when(F.col("user_id") % 11 == 0, 2).when(F.col("user_id") % 11 == 1, 1).otherwise(0)
    rows = events.select(F.least(F.lit(ARRIVALS - 1), on_time + late).alias("arrival"), *outcome_columns())
    for k in range(ARRIVALS):
        rows.filter(F.col("arrival") == k).drop("arrival").repartition(1).write.mode("append").parquet(location)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative outcomes per run and hour."""
    events = load(spark, sf_dir, "events")
    run = F.concat(F.lit("run_"), (F.col("user_id") % 3).cast("string")).alias("run_id")
    return outcomes_over_time(events.select(run, *outcome_columns()))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, parent_id, name, is_folder``"""
    base = lambda c, k: (F.col(c).cast("bigint") + k * 1_000_000_000)
    regions = load(spark, sf_dir, "region").select(
        base("r_regionkey", 1).alias("id"), F.lit(ROOT_ID).cast("bigint").alias("parent_id"), F.col("r_name").alias("name"), F.lit(True).alias("is_folder")
    )
    nations = load(spark, sf_dir, "nation").select(
        base("n_nationkey", 2).alias("id"), base("n_regionkey", 1).alias("parent_id"), F.col("n_name").alias("name"), F.lit(True).alias("is_folder")
    )
    customers = load(spark, sf_dir, "customer").select(
        base("c_custkey", 3).alias("id"),
        base("c_nationkey", 2).alias("parent_id"),
        F.concat("c_name", F.lit(".pdf")).alias("name"),
        F.lit(False).alias("is_folder"),
    )
    return regions.unionByName(nations).unionByName(customers)


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, relative_path, content``: every document as a file."""
    doc = F.col("doc_id")
    path = F.concat("source", F.lit("/"), "lang", F.lit("/doc_"), doc.cast("string"), _pick(DOC_EXTENSIONS, doc % 5))
    return load(spark, sf_dir, "documents").select(
        "doc_id", path.alias("relative_path"), F.col("text").cast("binary").alias("content")
    )


def ledger_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger snapshots per customer: one candidate per order."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("source_id"),
        F.col("o_orderkey").alias("candidate_id"),
        F.left("o_orderpriority", F.lit(1)).cast("int").alias("priority"),
        F.col("o_orderdate").alias("backup_ts"),
        (F.col("o_orderkey") % 3 == 0).alias("is_corrupt"),
    )


def listing_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot headers, some without a time and some with an unreadable one."""
    key = F.col("o_orderkey")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    stamp = F.when(key % 11 == 0, F.lit(None)).when(key % 13 == 0, "not a time").when(key % 17 == 0, F.concat(iso, F.lit("Z"))).otherwise(iso)
    return load(spark, sf_dir, "orders").select(
        key.alias("snapshot_id"),
        F.concat(F.lit("site-"), F.col("o_orderstatus")).alias("site_id"),
        F.concat(F.lit("drive-"), (key % 2).cast("string")).alias("drive_id"),
        F.when(key % 5 != 0, F.lit("folder-1")).alias("folder_id"),
        stamp.alias("timestamp"),
    )
