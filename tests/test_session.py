"""The shared folder and bounded broadcasts."""

import pytest

from estate import session


class FakeConf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder


class FakeSession:
    def __init__(self, master, conf=None, folder=None):
        self.conf, self.sparkContext = FakeConf(conf or {}), FakeContext(master, folder)


def test_the_named_folder_wins():
    named = FakeSession("spark://host:7077", {"spark.checkpoint.dir": "hdfs://nn/shared"}, "hdfs://nn/other")
    assert session.shared_dir(named) == "hdfs://nn/shared"
    assert session.new_location(named, "x").startswith("hdfs://nn/shared/x-")


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession("yarn"))


def test_durable_keeps_rows_and_schema(spark, rows):
    df = rows([(1, None, [1.5]), (None, "é", [])], "a bigint, b string, c array<double>")
    kept = session.durable(df)
    assert sorted(map(str, kept.collect())) == sorted(map(str, df.collect())) and kept.dtypes == df.dtypes


OWNING = ["assign_batches", "snapshot_deltas", "progress_milestones", "flatten_hierarchy", "stream_throughput_late", "path_ledger_latest"]


@pytest.mark.parametrize("key", OWNING)
def test_written_tables_go_when_the_result_is_stored(spark, sf_dir, tmp_path, key):
    from estate.plans import queries
    from estate.session import children, shared_dir, written_tables

    before = children(spark, shared_dir(spark))
    with written_tables(spark) as owned:
        queries.queries()[key](spark, sf_dir).write.parquet(str(tmp_path / "result"))
        assert owned
    assert children(spark, shared_dir(spark)) == before
    assert spark.read.parquet(str(tmp_path / "result")).count() > 0


def test_a_block_that_fails_leaves_nothing(spark, rows):
    from estate.session import children, durable, shared_dir, written_tables

    before = children(spark, shared_dir(spark))
    with pytest.raises(RuntimeError), written_tables(spark):
        durable(rows([(1,)], "x int"))
        with written_tables(spark):
            durable(rows([(2,)], "x int"))
        raise RuntimeError("lost")
    assert children(spark, shared_dir(spark)) == before
