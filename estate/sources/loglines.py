"""Log files as numbered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estate.functions.loglines import strip
from estate.session import durable

_FILE, _BLOCK, _ID = "file", "_block", "_id"
_SPLIT = "the log files were split otherwise when their lines were counted: read them again"


def read_log_lines(spark: SparkSession, pattern: str | list[str], line_numbers: bool = True) -> DataFrame:
    """``(file, line_number, raw_line)`` of every non-empty line; empty lines are counted.

    Files stay splittable: a first pass counts the lines of each file block and writes that down, one narrow row per block; the
    result reads the files once more and shifts the place of a line in its block by the counts of the earlier blocks.  The text
    itself is never written.  Both passes go over one listing of the files; should they be split otherwise after all, because
    the cluster's size or ``spark.sql.files.maxPartitionBytes`` changed in between, the result is an error, never a wrong
    number.  Without ``line_numbers`` the lines are read in one pass.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(pattern).select(
        F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_BLOCK), F.col("_metadata.file_block_length").alias("_length"), "value"
    )
    if not line_numbers:
        text = lines.select(_FILE, strip("value").alias("raw_line"))
        return text.filter(F.col("raw_line") != "")
    placed = lines.withColumn(_ID, F.monotonically_increasing_id())
    blocks = placed.groupBy(_FILE, _BLOCK, "_length").agg(F.min(_ID).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(_FILE).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = durable(blocks.select("*", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")))
    at = F.col(_ID) - F.col("_first")
    number = F.when((at >= 0) & (at < F.col("_rows")), F.col("_before") + at + 1).otherwise(F.raise_error(F.lit(_SPLIT)).cast("bigint"))
    joined = placed.join(offsets, [_FILE, _BLOCK, "_length"], "left")
    return joined.select(_FILE, number.alias("line_number"), strip("value").alias("raw_line")).filter(F.col("raw_line") != "")
