"""A stored ledger laid out by path.

Rows carry the normalised path as ``path_key`` and lie in buckets of its hash, sorted by it, so that looking up, resuming and
taking the latest row need no shuffle of the ledger.  The ledger is a folder:

    layout                    columns and number of buckets, written once
    v3/append_id=x/...        the rows of one append; ``append_id=base`` are those of a compaction
    v3.done                   version 3 is complete; the highest complete version counts

An append writes its own partition only, and again if it is repeated.  A compaction writes the next version and then marks it, so
a crash at any point leaves the version before, whole.  One writer at a time; readers need not wait: the version before
stays until the next compaction.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from estate.functions.paths import PATH_KEY, normalize_path
from estate.session import children, make_folder, mark, remove

BUCKETS = 64
#: how many outcomes a row stands for
ENTRIES = "entries"
_APPEND, _BASE = "append_id", "base"


class PathLedger:
    """``create`` makes a ledger for outcomes of a schema, ``open`` finds it again."""

    def __init__(self, spark: SparkSession, location: str, ddl: str, buckets: int):
        self.spark, self.location, self.buckets = spark, location.rstrip("/"), buckets
        self.columns = StructType.fromDDL(ddl)

    @classmethod
    def create(cls, spark: SparkSession, location: str, outcomes: StructType, buckets: int = BUCKETS) -> PathLedger:
        """``outcomes`` must hold ``path`` and ``status``.  Choose as many buckets as shuffles of the ledger would have partitions."""
        kept = StructType([f for f in outcomes.fields if f.name not in (PATH_KEY, ENTRIES, _APPEND)])
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
        spark.createDataFrame([(ddl, buckets)], "columns string, buckets int").coalesce(1).write.json(f"{location.rstrip('/')}/layout")
        return cls(spark, location, ddl, buckets)

    @classmethod
    def open(cls, spark: SparkSession, location: str) -> PathLedger:
        layout = spark.read.schema("columns string, buckets int").json(f"{location.rstrip('/')}/layout").first()
        return cls(spark, location, layout["columns"], layout["buckets"])

    def version(self) -> int:
        done = [int(n[1:-5]) for n in children(self.spark, self.location) if n.startswith("v") and n.endswith(".done")]
        return max(done, default=0)

    def _table(self, version: int) -> str:
        """The version as a table of the session's catalogue, with the partitions that are there now."""
        place = f"{self.location}/v{version}"
        make_folder(self.spark, place)
        name = f"path_ledger_{hashlib.md5(place.encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.columns.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {PATH_KEY} STRING, {ENTRIES} BIGINT, {_APPEND} STRING) USING parquet "
            f"PARTITIONED BY ({_APPEND}) CLUSTERED BY ({PATH_KEY}) SORTED BY ({PATH_KEY}) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )
        self.spark.catalog.recoverPartitions(name)
        return name

    def _combined(self, rows: DataFrame) -> DataFrame:
        """Per path the latest success and the latest other outcome; a hot path is combined before any shuffle."""
        names = [f.name for f in self.columns.fields]
        order = [c for c in ("event_ts", "attempt", "batch", "size_bytes", "status") if c in names]
        rest = [c for c in names if c not in (*order, "path")] + ["path"]
        good = F.col("status").eqNullSafe(F.lit("success"))
        latest = rows.groupBy(PATH_KEY, good.alias("_good")).agg(F.max(F.struct(*order, *rest)).alias("_last"), F.sum(ENTRIES).alias(ENTRIES))
        return latest.select(*[F.col(f"_last.{c}").alias(c) for c in names], PATH_KEY, ENTRIES)

    def _write(self, rows: DataFrame, version: int, append_id: str) -> None:
        """Replace one partition, and no other: it is named in the statement."""
        table = self._table(version)
        self.spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({_APPEND} = :append_id) SELECT * FROM {{rows}}", args={"append_id": append_id}, rows=rows)

    def append(self, outcomes: DataFrame, append_id: str) -> None:
        """Add outcomes under a name; the same name again replaces what it has added.

        Columns that outcomes lack are null, others are left out.  Rows without a path are dropped: they name no file.
        """
        if append_id == _BASE:
            raise ValueError(f"{_BASE!r} names what compactions write")
        have = set(outcomes.columns)
        given = outcomes.select(
            *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.columns.fields],
            normalize_path("path").alias(PATH_KEY), F.lit(1).cast("bigint").alias(ENTRIES),
        )
        self._write(self._combined(given.filter(F.col("path").isNotNull())).repartition(self.buckets, PATH_KEY), self.version(), append_id)

    def rows(self) -> DataFrame:
        """All rows of the ledger; operators that go by ``path_key`` shuffle none of them."""
        return self.spark.table(self._table(self.version())).drop(_APPEND)

    def compact(self) -> None:
        """Leave at most two rows per path: the latest success and the latest other outcome."""
        now = self.version()
        remove(self.spark, f"{self.location}/v{now + 1}")  # of a compaction that did not end
        self._write(self._combined(self.rows()), now + 1, _BASE)
        mark(self.spark, f"{self.location}/v{now + 1}.done")
        if now:
            remove(self.spark, f"{self.location}/v{now - 1}.done")
            remove(self.spark, f"{self.location}/v{now - 1}")


def store_files(files: DataFrame, table: str, path: str, buckets: int = BUCKETS, location: str | None = None) -> DataFrame:
    """An inventory as a table with the layout of a ledger of as many buckets: joins of the two shuffle neither."""
    keyed = files.withColumn(PATH_KEY, normalize_path(path)).repartition(buckets, PATH_KEY)
    writer = keyed.write.mode("overwrite").bucketBy(buckets, PATH_KEY).sortBy(PATH_KEY)
    (writer.option("path", location) if location else writer).saveAsTable(table)
    return files.sparkSession.table(table)
