"""Streams over many files, one file per micro-batch, against the batch answer."""

import pytest
from pyspark.sql import functions as F

from estate.plans import tables as t
from estate.streaming import jobs


@pytest.fixture(scope="module")
def sliced(spark, sf_dir, tmp_path_factory):
    """The outcome table cut into files in time order."""
    where = str(tmp_path_factory.mktemp("stream") / "outcomes.parquet")
    run = F.concat(F.lit("run_"), (F.col("user_id") % 3).cast("string")).alias("run_id")
    rows = t.load(spark, sf_dir, "events").select(run, *t.outcome_columns()).orderBy("event_ts")
    data = rows.toPandas()
    for i in range(4):
        part = data.iloc[i * len(data) // 4 : (i + 1) * len(data) // 4]
        spark.createDataFrame(part, rows.schema).coalesce(1).write.mode("append").parquet(where)
    return where


def stream(spark, where):
    itself = f"{where[:-1]}[{where[-1]}]"
    return spark.readStream.schema(spark.read.parquet(where).schema).option("maxFilesPerTrigger", 1).parquet(itself)


def places(tmp_path):
    return str(tmp_path / "out"), str(tmp_path / "state")


def same(a, b):
    return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.select(*a.columns).collect()), key=str)


def test_throughput_updates(spark, sliced, tmp_path):
    got = jobs.run_updates(
        jobs.throughput(stream(spark, sliced), "1 hour"), ["window_start", "window_end", "status"], *places(tmp_path)
    )
    assert got.count() > 100 and same(jobs.throughput(spark.read.parquet(sliced), "1 hour"), got)
    assert len(list((tmp_path / "out").glob("batch_id=*"))) >= 4


KEYS = ["window_start", "window_end", "status"]


def folders(tmp_path):
    return sorted(p.name for p in (tmp_path / "out").glob("batch_id=*")), sorted(p.name for p in (tmp_path / "out" / "base").glob("*.done"))


def test_compaction_gathers_micro_batches(spark, sliced, tmp_path):
    got = jobs.run_updates(jobs.throughput(stream(spark, sliced), "1 hour"), KEYS, *places(tmp_path), compact_every=1)
    assert same(jobs.throughput(spark.read.parquet(sliced), "1 hour"), got)
    batches, bases = folders(tmp_path)
    # what the base before has replaced is gone, and its own files stay for its readers
    assert len(bases) == 2 and len(batches) == 1


@pytest.mark.parametrize("step", ["mark", "remove"])
def test_compaction_survives_a_crash_at_any_step(spark, sliced, tmp_path, monkeypatch, step):
    """Stopped before the mark or while it cleans up, the stream goes on where it was and loses nothing."""
    calls, real = [], getattr(jobs, step)

    def broken(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        real(*args)

    monkeypatch.setattr(jobs, step, broken)
    build = lambda: jobs.throughput(stream(spark, sliced), "1 hour")
    with pytest.raises(Exception, match="lost"):
        jobs.run_updates(build(), KEYS, *places(tmp_path), compact_every=1)
    midway = jobs.read_updates(spark, places(tmp_path)[0], KEYS, build().schema)
    assert midway.groupBy(*KEYS).count().filter("count > 1").isEmpty()
    got = jobs.run_updates(build(), KEYS, *places(tmp_path), compact_every=1)
    assert same(jobs.throughput(spark.read.parquet(sliced), "1 hour"), got)


def test_late_rows_are_dropped_by_the_watermark(spark, sf_dir, tmp_path):
    where = str(tmp_path / "arriving")
    t.arriving_outcomes(spark, sf_dir, where)
    late = jobs.throughput(jobs.stream_table(spark, where, files_per_batch=1), "1 hour")
    got = jobs.run_updates(late, KEYS, *places(tmp_path), compact_every=3)
    every = spark.read.parquet(where).count()
    counted = got.agg(F.sum("files")).first()[0]
    assert every == t.load(spark, sf_dir, "events").count() and 0.8 * every < counted < every


def test_sliding_error_rate(spark, sliced, tmp_path):
    got = jobs.run_updates(jobs.sliding_error_rate(stream(spark, sliced)), ["window_start", "window_end"], *places(tmp_path))
    want = jobs.sliding_error_rate(spark.read.parquet(sliced))
    assert same(want, got)
    assert jobs.alerting(got).count() == want.filter("error_rate > 10").count()


def test_restart_reads_nothing_twice(spark, sliced, tmp_path):
    out, state = places(tmp_path)
    first = jobs.run_ledger_upsert(stream(spark, sliced), "live", out, state).count()
    second = jobs.run_ledger_upsert(stream(spark, sliced), "live", out, state).count()
    assert first == second == spark.read.parquet(sliced).count()


def test_dedupe_within_watermark(spark, sliced, tmp_path):
    got = jobs.run_append(jobs.dedupe_ledger(stream(spark, sliced), late="60 days").select("path", "status"), *places(tmp_path))
    want = spark.read.parquet(sliced).select("path", "status").distinct()
    assert same(want, got)


def test_idle_sessions(spark, sliced, tmp_path):
    got = jobs.run_append(jobs.idle_sessions(stream(spark, sliced), "10 minutes"), *places(tmp_path))
    every = {tuple(r) for r in jobs.idle_sessions(spark.read.parquet(sliced), "10 minutes").collect()}
    closed = {tuple(r) for r in got.collect()}
    assert len(closed) == got.count() and closed <= every and len(every) - len(closed) <= 6


def test_idle_sessions_touch_no_setting_and_keep_all_outcomes(spark, sliced, tmp_path):
    """Sessions that go on over several micro-batches, one run with nearly all outcomes, a null run, none of it lost."""
    rows = spark.read.parquet(sliced).withColumn("run_id", F.when(F.col("path").startswith("P0"), F.lit(None)).otherwise(F.lit("hot")))
    end = rows.agg(F.max("event_ts")).first()[0]
    where = str(tmp_path / "in.parquet")
    data = rows.orderBy("event_ts").toPandas()
    for i in range(5):
        part = data.iloc[i * len(data) // 5 : (i + 1) * len(data) // 5]
        spark.createDataFrame(part, rows.schema).repartition(1).write.mode("append").parquet(where)
    last = rows.limit(1).withColumn("event_ts", F.lit(end) + F.expr("INTERVAL 30 DAYS")).withColumn("run_id", F.lit("end"))
    last.repartition(1).write.mode("append").parquet(where)
    before = {k: v for k, v in spark.conf.getAll.items()}
    got = jobs.run_append(jobs.idle_sessions(stream(spark, where), "3 hours", late="1 day"), *places(tmp_path))
    assert {k: v for k, v in spark.conf.getAll.items()} == before
    want = jobs.idle_sessions(rows, "3 hours").select(*got.columns)
    assert same(want, got) and got.agg(F.sum("files")).first()[0] == rows.count()


def test_an_append_is_named_by_the_checkpoint_however_written(spark, sliced, tmp_path):
    out, state = places(tmp_path)
    first = jobs.run_ledger_upsert(stream(spark, sliced), "live", out, state).count()
    again = jobs.run_ledger_upsert(stream(spark, sliced), "live", out, f"file:{state}/../state/").count()
    assert first == again == spark.read.parquet(sliced).count()
    assert len({p.name for p in (tmp_path / "out").glob("run_id=live/batch=*/append_id=*")}) == 1


def test_stream_without_files(spark, tmp_path):
    schema = "path string, status string, skipped boolean, size_bytes bigint, event_ts timestamp_ntz"
    (tmp_path / "none").mkdir()
    empty = spark.readStream.schema(schema).parquet(str(tmp_path / "none"))
    out, state = places(tmp_path)
    got = jobs.run_updates(jobs.throughput(empty), ["window_start", "window_end", "status"], out, state)
    assert got.count() == 0 and got.columns == ["window_start", "window_end", "status", "files", "bytes"]
    assert jobs.run_ledger_upsert(empty, "live", f"{out}-2", f"{state}-2").count() == 0
