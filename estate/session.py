"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "estate") -> SparkSession:
    """Single-machine session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local master gets a folder of its own when the setting is missing: on a
    cluster a machine-local folder would not survive the loss of an executor.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="estate-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


@contextmanager
def written_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Own the tables that operators write to the shared folder inside the block, and remove them when it ends.

        with written_tables(spark):
            planning.assign_batches(files).write.parquet(target)

    Results are lazy and read those tables: store them inside the block.  The names are fresh, so a block that failed and is
    run again meets nothing of the first run, which has removed its own tables.  A block inside a block owns its own.
    """
    mine: list[str] = []
    token = _owned.set(mine)
    try:
        yield mine
    finally:
        _owned.reset(token)
        for location in mine:
            remove(spark, location)


def new_location(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    location = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(location)
    return location


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage: write the rows to a table in the shared folder and read them back.

    As safe against lost executors as a reliable checkpoint, and later reads take only the
    columns they need and know the size.
    """
    location = new_location(df.sparkSession, "cut")
    df.write.parquet(location)
    return df.sparkSession.read.schema(df.schema).parquet(location)


# --- names in the shared folder, by Spark's own file systems --------------------
def _at(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), there


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, sorted; none if it isn't there."""
    system, there = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(there)) if system.exists(there) else []


def make_folder(spark: SparkSession, path: str) -> None:
    system, there = _at(spark, path)
    system.mkdirs(there)


def mark(spark: SparkSession, path: str) -> None:
    """Make an empty file: one step, which either has happened or not."""
    system, there = _at(spark, path)
    system.create(there, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file, if it is there."""
    system, there = _at(spark, path)
    system.delete(there, True)
