"""Numbering, running totals and top-n against brute force, with one hot group."""

import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from estate.operators import ordering, planning


def sample(n=3000, seed=1):
    rnd = random.Random(seed)
    return [("hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None]), rnd.randint(0, 40), i) for i in range(n)]


def test_number_rows_with_hot_group(spark, rows):
    data = sample()
    got = ordering.number_rows(rows(data, "g string, v int, i int"), ["v", "i"], ["g"], {"total": F.col("v")}).collect()
    groups = defaultdict(list)
    for g, v, i in data:
        groups[g].append((v, i))
    want = {}
    for g, members in groups.items():
        total = 0
        for n, (v, i) in enumerate(sorted(members), 1):
            total += v
            want[i] = (n, total)
    assert {r.i: (r.ordinal, r.total) for r in got} == want


def test_number_in_place(spark, rows):
    """Hot and null groups, null keys and ties over many ranges; an empty table."""
    data = [(g, v if i % 11 else None, i) for g, v, i in sample()]
    df = rows(data, "g string, v int, i int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        got = ordering.number_in_place(df, ["v", "i"], ["g"], {"total": F.col("v")}).collect()
        tied = ordering.number_in_place(df, ["v"]).collect()
        assert ordering.number_in_place(df.filter("false"), ["v"], ["g"], {"total": F.col("v")}).collect() == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    key = lambda v: (v is not None, v or 0)
    groups = defaultdict(list)
    for g, v, i in data:
        groups[g].append((key(v), i))
    want = {}
    for members in groups.values():
        total = 0
        for n, ((_, v), i) in enumerate(sorted(members), 1):
            total += v
            want[i] = (n, total)
    assert {r.i: (r.ordinal, r.total or 0) for r in got} == want
    tied.sort(key=lambda r: r.ordinal)
    assert [r.ordinal for r in tied] == list(range(1, len(data) + 1))
    assert [key(r.v) for r in tied] == sorted(key(r.v) for r in tied)


def test_numbering_writes_no_copy(spark, tmp_path, monkeypatch):
    """What is written holds a row per range, however wide the rows are."""
    wide = tmp_path / "wide"
    digits = F.concat(*[F.sha2(F.concat("id", F.lit(k)).cast("string"), 256) for k in range(16)])
    spark.range(4000).select(F.col("id").alias("size_bytes"), F.concat(F.lit("p"), "id").alias("relative_path"), digits.alias("wide")).write.parquet(str(wide))
    written = []
    durable = ordering.durable
    monkeypatch.setattr(ordering, "durable", lambda df: written.append(durable(df)) or written[-1])
    numbered = planning.assign_batches(spark.read.parquet(str(wide)), 7)
    assert numbered.agg(F.max("position"), F.count_distinct("position")).first()[:] == (4000, 4000)
    assert len(written) == 1 and all("wide" not in w.columns for w in written)
    size = lambda folder: sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    from pathlib import Path
    from urllib.parse import unquote, urlparse

    parts = {Path(unquote(urlparse(f).path)).parent for w in written for f in w.inputFiles()}
    assert 0 < sum(map(size, parts)) < size(wide) / 20


def test_with_previous(spark, rows):
    data = sample(500)
    got = ordering.with_previous(rows(data, "g string, v int, i int"), ["v", "i"], ["g"], ["i"]).collect()
    groups = defaultdict(list)
    for g, v, i in data:
        groups[g].append((v, i))
    want = {}
    for members in groups.values():
        last = None
        for _, i in sorted(members):
            want[i], last = last, i
    assert {r.i: r.previous_i for r in got} == want


def test_top_n_per_group(spark, rows):
    data = sample()
    got = ordering.top_n_per_group(rows(data, "g string, v int, i int"), ["g"], ["v", "i"], 7, salt_on="i", salts=4)
    groups = defaultdict(list)
    for g, v, i in data:
        groups[g].append((v, i))
    want = {i for m in groups.values() for _, i in sorted(m)[:7]}
    assert {r.i for r in got.collect()} == want and got.count() == len(want)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=60), st.integers(1, 9))
def test_batches_partition_the_input(spark, sizes, batch_size):
    files = spark.createDataFrame([(f"p{i:03}", s) for i, s in enumerate(sizes)], "relative_path string, size_bytes bigint")
    got = planning.assign_batches(files, batch_size).orderBy("position").collect()
    want = sorted((s, f"p{i:03}") for i, s in enumerate(sizes))
    assert [(r.size_bytes, r.relative_path) for r in got] == want
    assert [r.position for r in got] == list(range(1, len(sizes) + 1))
    assert [r.batch for r in got] == [i // batch_size + 1 for i in range(len(sizes))]


def test_milestones_at_one_moment(spark, rows):
    """Most completions at one instant: all of its milestones are there, more than one array holds."""
    from datetime import datetime

    from estate.operators import progress

    t0, t1 = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 10)
    few = rows([("r", t0)] * 7 + [("s", t0)] * 4, "run_id string, event_ts timestamp_ntz")
    many = spark.range(60_000).select(F.lit("r").alias("run_id"), F.lit(t1.isoformat()).cast("timestamp_ntz").alias("event_ts"))
    got = progress.progress_milestones(few.unionByName(many), {"r": 120_014, "s": 100}, every=5).collect()
    assert sorted(r.completed for r in got if r.run_id == "r") == list(range(5, 60_008, 5))
    assert not [r for r in got if r.run_id == "s"]
    row = next(r for r in got if r.completed == 60_005)
    assert (row.event_ts, row.files_per_second, row.eta_hours) == (t1, 6000.5, round(60_009 / 6000.5 / 3600, 6))


def test_previous_rows_across_ranges(spark):
    """Null groups, one hot group over many ranges, and groups that end where a range does."""
    from pyspark.sql import Window

    from estate.operators.ordering import with_previous

    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("g"), (F.col("id") % 700).cast("string"))).alias("g"),
        F.col("id").alias("at"), F.when(F.col("id") % 5 > 0, F.col("id") * 2).alias("v"),
    )
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the ranges are few
    try:
        found = with_previous(rows, ["at"], ["g"], ["at", "v"]).collect()
        text = with_previous(rows, ["at"], ["g"], ["at", "v"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    order = Window.partitionBy("g").orderBy("at")
    want = rows.select("*", F.lag("at").over(order).alias("previous_at"), F.lag("v").over(order).alias("previous_v")).collect()
    assert sorted(map(str, found)) == sorted(map(str, want))
    assert "SortMergeJoin" not in text and with_previous(rows.filter("false"), ["at"], ["g"], ["v"]).count() == 0
