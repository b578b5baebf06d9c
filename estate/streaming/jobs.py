"""Structured Streaming versions of the polled monitors.

Builders take a streaming (or batch) DataFrame and return one; ``run_*`` start a query
whose checkpoint is its resume state.  Sinks write to the shared folder, never to the
driver.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StringType, StructField, StructType

from estate.functions.measures import instant, ratio, wall
from estate.functions.paths import normalize_path
from estate.operators.ledger import SUCCESS, is_skipped
from estate.operators.logs import parse_log
from estate.session import children, mark, remove
from estate.sources.sinks import append_ledger

# the helpers of the session step travel with their tasks; executors need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def stream_table(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet table as a stream of its files, oldest first; ``files_per_batch`` bounds a micro-batch.

    The path is written as a pattern matching only itself, which the file source accepts
    for a folder and for a single file.
    """
    itself = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(itself)


def _timed(outcomes: DataFrame, late: str) -> DataFrame:
    """Watermarks need instants; times without zone are read as UTC."""
    return outcomes.withColumn("event_ts", instant(F.col("event_ts"))).withWatermark("event_ts", late)


def log_events(lines: DataFrame) -> DataFrame:
    """Typed events of a stream of lines (``value``); streams have no line numbers."""
    return parse_log(lines.withColumnRenamed("value", "raw_line") if "value" in lines.columns else lines)


def throughput(outcomes: DataFrame, width: str = "5 seconds", late: str = "10 minutes") -> DataFrame:
    """Files and bytes per tumbling window and status."""
    return (
        _timed(outcomes, late)
        .groupBy(F.window("event_ts", width), "status")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("bytes"))
        .select(*_bounds(), "status", "files", "bytes")
    )


def sliding_error_rate(
    outcomes: DataFrame, width: str = "1 hour", slide: str = "15 minutes", late: str = "10 minutes"
) -> DataFrame:
    """Error rate per sliding window.  ``alerting`` selects the windows above a threshold."""
    return (
        _timed(outcomes, late)
        .groupBy(F.window("event_ts", width, slide))
        .agg(F.count(F.lit(1)).alias("files"), F.count_if(~F.col("status").eqNullSafe(F.lit(SUCCESS))).alias("failed"))
        .select(*_bounds(), "files", "failed", F.round(ratio(F.col("failed"), F.col("files"), 100.0), 6).alias("error_rate"))
    )


def alerting(rates: DataFrame, above: float = 10.0) -> DataFrame:
    return rates.filter(F.col("error_rate") > above)


def dedupe_ledger(outcomes: DataFrame, late: str = "10 minutes") -> DataFrame:
    """First outcome per path, which stands normalised, and status within the watermark."""
    named = outcomes.withColumn("path", normalize_path("path"))
    return _timed(named, late).dropDuplicatesWithinWatermark(["path", "status"])


def idle_sessions(outcomes: DataFrame, gap: str = "30 seconds", late: str = "10 minutes", key: str = "run_id") -> DataFrame:
    """Activity sessions per run; a gap without outcomes ends one.

    As a stream: every task first merges its own outcomes, whatever their run, to the stretches they make, so that of a run
    with most of the outcomes only a few rows per task are shuffled; a stateful step then merges stretches to sessions and
    holds no more than the open ones of each run.  A session is returned once the watermark has passed its end.  Outcomes without a time
    are left out; a null run is a run; outcomes older than the watermark are late and dropped.
    """
    good = (F.col("status") == SUCCESS) & ~is_skipped()
    if not outcomes.isStreaming:
        sessions = _timed(outcomes, late).groupBy(F.session_window("event_ts", gap).alias("window"), key)
        return sessions.agg(F.count(F.lit(1)).alias("files"), F.count_if(good).alias("downloaded")).select(key, *_bounds(), "files", "downloaded")
    spark = outcomes.sparkSession
    length = spark.range(1).select(F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL '{gap}'"))).first()[0]
    at = F.unix_micros(instant(F.col("event_ts")))
    rows = outcomes.filter(F.col("event_ts").isNotNull()).select(
        F.col(key).alias("run"), at.alias("start"), at.alias("last"), F.lit(1).cast("bigint").alias("files"), F.coalesce(good, F.lit(False)).cast("bigint").alias("downloaded")
    )
    kind = rows.schema["run"].dataType.simpleString()

    def stretches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield _merged(part, length)

    def sessions(run: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names = ["start", "last", "files", "downloaded"]
        held = [pd.DataFrame(dict(zip(names, state.get, strict=True)))] if state.exists else []
        if not state.hasTimedOut:
            held += [p[names] for p in parts]
        merged = _merged(pd.concat(held).assign(run=0), length)[names]
        mark = state.getCurrentWatermarkMs()
        closed = merged["last"] + length <= mark * 1000
        left = merged[~closed]
        if len(left):
            state.update(tuple(left[n].astype("int64").tolist() for n in names))
            # the first millisecond by which the session that ends first has ended: the step is called beyond it
            state.setTimeoutTimestamp(max(-(-int(left["last"].min() + length) // 1000) - 1, mark + 1))
        elif state.exists:
            state.remove()
        out = merged[closed]
        yield pd.DataFrame({"run": [run[0]] * len(out), **{n: out[n].to_numpy() for n in names}})

    dated = rows.mapInPandas(stretches, rows.schema).withColumn("seen", F.timestamp_micros("last")).withWatermark("seen", late)
    lists = "start array<bigint>, last array<bigint>, files array<bigint>, downloaded array<bigint>"
    found = dated.groupBy("run").applyInPandasWithState(
        sessions, f"run {kind}, start bigint, last bigint, files bigint, downloaded bigint", lists, "append", GroupStateTimeout.EventTimeTimeout
    )
    edge = lambda micros: wall(F.timestamp_micros(micros))
    return found.select(
        F.col("run").alias(key), edge(F.col("start")).alias("window_start"), edge(F.col("last") + length).alias("window_end"), "files", "downloaded"
    )


def _merged(rows: pd.DataFrame, gap: int) -> pd.DataFrame:
    """Stretches of a run that are no further apart than ``gap`` microseconds, as one row each."""
    if not len(rows):
        return rows
    run = pd.factorize(rows["run"], use_na_sentinel=False)[0]
    order = np.lexsort((rows["start"].to_numpy(), run))
    rows, run = rows.iloc[order], run[order]
    last = rows["last"].groupby(run).cummax().to_numpy()
    new = np.r_[True, (run[1:] != run[:-1]) | (rows["start"].to_numpy()[1:] > last[:-1] + gap)]
    firsts = np.flatnonzero(new)
    add = lambda c: np.add.reduceat(rows[c].to_numpy(), firsts)
    return pd.DataFrame(
        {"run": rows["run"].to_numpy()[firsts], "start": rows["start"].to_numpy()[firsts], "last": last[np.r_[firsts[1:], len(rows)] - 1],
         "files": add("files"), "downloaded": add("downloaded")}
    )


def _bounds() -> list[Column]:
    return [wall(F.col("window.start")).alias("window_start"), wall(F.col("window.end")).alias("window_end")]


# --- sinks ------------------------------------------------------------------
def run_append(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Drain what is available into an exactly-once Parquet sink and return the sink."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def run_updates(stream: DataFrame, keys: list[str], out: str, checkpoint: str, compact_every: int = 16) -> DataFrame:
    """Keep the newest version of each window in a table of micro-batches.

    A repeated micro-batch overwrites its own folder.  Every ``compact_every`` micro-batches the newest versions are gathered in a base, so
    a read takes each window once and the few micro-batches since, however many there were.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact_updates(batch.sparkSession, out, keys, stream.schema, batch_id)

    _drain(stream, write, "update", checkpoint)
    return read_updates(stream.sparkSession, out, keys, stream.schema)


def _bases(spark: SparkSession, out: str) -> list[int]:
    """The last micro-batch of each complete base, ascending."""
    names = [n for n in children(spark, f"{out}/base") if n.endswith(".done")]
    return sorted(int(n.removeprefix("upto=").removesuffix(".done")) for n in names)


def _batches(spark: SparkSession, out: str) -> list[int]:
    return sorted(int(n.removeprefix("batch_id=")) for n in children(spark, out) if n.startswith("batch_id="))


def read_updates(spark: SparkSession, out: str, keys: list[str], schema: StructType, upto: int | None = None) -> DataFrame:
    """The newest version of each window: from the newest base and the micro-batches after it, up to ``upto`` if given."""
    bases = _bases(spark, out)
    base = bases[-1] if bases else -1
    since = [k for k in _batches(spark, out) if k > base and (upto is None or k <= upto)]
    reader = spark.read.schema(schema)
    rows = spark.createDataFrame([], schema) if base < 0 else reader.parquet(f"{out}/base/upto={base}")
    rows = rows.withColumn("batch_id", F.lit(base).cast("bigint"))
    if since:
        dated = spark.read.schema(StructType([*schema.fields, StructField("batch_id", LongType())])).option("basePath", out)
        rows = rows.unionByName(dated.parquet(*[f"{out}/batch_id={k}" for k in since]))
    values = [c for c in schema.names if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch_id")).alias("_v"))
    return newest.select(*keys, "_v.*")


def compact_updates(spark: SparkSession, out: str, keys: list[str], schema: StructType, upto: int) -> None:
    """Gather all micro-batches up to ``upto`` in a new base.

    The base counts once its mark is there, which is one step: a crash before it leaves the base before and all micro-batches, a crash after
    it leaves files that no read looks at.  What the base *before* has replaced is removed, so readers of that base
    are not disturbed.  A repeated compaction does nothing.
    """
    bases = _bases(spark, out)
    if bases and bases[-1] >= upto:
        return
    read_updates(spark, out, keys, schema, upto).write.mode("overwrite").parquet(f"{out}/base/upto={upto}")
    mark(spark, f"{out}/base/upto={upto}.done")
    if bases:
        for k in _batches(spark, out):
            if k <= bases[-1]:
                remove(spark, f"{out}/batch_id={k}")
        for k in bases[:-1]:
            remove(spark, f"{out}/base/upto={k}.done")
            remove(spark, f"{out}/base/upto={k}")


def run_ledger_upsert(outcomes: DataFrame, run_id: str, out: str, checkpoint: str) -> DataFrame:
    """Append each micro-batch to the ledger as partition ``(run_id, batch)`` of this stream.

    Micro-batches count from 0 in each checkpoint, so the id that the checkpoint keeps names the append, however its path
    is written: another stream adds its own rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        stream_id = json.loads(batch.sparkSession.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]
        append_ledger(batch.withColumns({"run_id": F.lit(run_id), "batch": F.lit(batch_id)}), out, stream_id)

    _drain(outcomes, write, "append", checkpoint)
    return _read_or_empty(
        outcomes.sparkSession, out, outcomes.schema, StructField("run_id", StringType()), StructField("batch", LongType()),
        StructField("append_id", StringType()),
    ).drop("append_id")


def _read_or_empty(spark: SparkSession, path: str, columns: StructType, *partitions: StructField) -> DataFrame:
    """A stream that found nothing has written no table yet."""
    schema = StructType([*columns.fields, *partitions])
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _drain(stream: DataFrame, write: Callable[[DataFrame, int], None], mode: str, checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
