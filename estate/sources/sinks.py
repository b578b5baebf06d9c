"""Durable outputs: catalogue, reports and the append-only ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.functions import rules


def catalog_ddl(table: str, location: str | None = None, fmt: str = "parquet") -> str:
    columns = ",\n".join(f"    {name} {kind}" for name, kind in rules.CATALOG_COLUMNS)
    where = f"\nLOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {table} (\n{columns}\n)\nUSING {fmt.upper()}{where}"


def write_catalog(catalog: DataFrame, location: str, table: str | None = None, fmt: str = "parquet") -> str:
    """Write the catalogue and return its DDL; with ``table`` it is also registered."""
    catalog.write.format(fmt).mode("overwrite").save(location)
    ddl = catalog_ddl(table or "catalog", location, fmt)
    if table:
        catalog.sparkSession.sql(ddl)
    return ddl


def report_json(df: DataFrame, column: str = "report") -> DataFrame:
    """Each row as a JSON text, times in ISO form."""
    options = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss"}
    return df.select(F.to_json(F.struct(*df.columns), options).alias(column))


def write_report_json(df: DataFrame, location: str) -> None:
    df.write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss").json(location)


def append_ledger(outcomes: DataFrame, location: str, append_id: str) -> None:
    """Append outcomes as one partition per ``(run_id, batch, append_id)``.

    The caller names the append: the same name again is a replay and replaces its own partitions, so a repeated
    job leaves each outcome once; another name adds rows, also to a batch that is there.  Other partitions are
    not read or rewritten.  The rebalance hint gathers small batches into
    few files and splits a large one over several tasks.
    """
    (
        outcomes.withColumn("append_id", F.lit(append_id))
        .hint("rebalance", "run_id", "batch")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id", "batch", "append_id")
        .parquet(location)
    )


def backup_ledger(ledger: DataFrame, location: str, snapshot_id: str) -> str:
    """Keep the ledger as it is now under ``snapshot_id`` and return where."""
    target = f"{location.rstrip('/')}/snapshot_id={snapshot_id}"
    ledger.write.mode("errorifexists").parquet(target)
    return target
