"""Numbering, running totals and top-n that never gather a hot group in one task.

A window partitioned by run or folder would put a group holding a third of all rows
into a single task.  Here rows are range-partitioned by (group, order), numbered inside
each range, and shifted by the totals of the earlier ranges of the same group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StructField, StructType, TimestampNTZType

from estate.session import durable

_RANGE, _LOCAL, _FIRST, _BEFORE = "_range", "_local", "_first", "_before"


def number_rows(
    df: DataFrame,
    order_by: Sequence[Column | str],
    within: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    ordinal: str = "ordinal",
) -> DataFrame:
    """Add a 1-based ``ordinal`` and running ``sums`` per ``within`` group in the given order.

    The order should have few ties: rows equal in all keys share a range, so count them
    together first where many can be equal.
    The sorted ranges are written to a table, so that the sampled range bounds are the same for
    the numbering and for the totals, also after the loss of an executor.
    """
    sums = dict(sums or {})
    ranged = df.orderBy(*within, *order_by).withColumn("_id", F.monotonically_increasing_id())
    for name, expr in sums.items():
        ranged = ranged.withColumn(f"_add_{name}", expr)
    ranged = durable(
        ranged.withColumn(_RANGE, F.shiftright("_id", 33).cast("int"))
        .withColumn(_LOCAL, F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_id")
    )
    keys = [_RANGE, *within]
    same = (F.col(_RANGE) == F.col(f"_key_{_RANGE}")) & _same(within)

    # one row per range and group: few, unless the groups themselves are many
    totals = ranged.groupBy(*keys).agg(
        F.min(_LOCAL).alias(_FIRST),
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(f"_add_{n}").alias(f"_sum_{n}") for n in sums],
    )
    earlier = Window.partitionBy(*within).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        _FIRST,
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(_BEFORE),
        *[F.sum(f"_sum_{n}").over(earlier).alias(f"_before_{n}") for n in sums],
    )
    for key in keys:
        offsets = offsets.withColumnRenamed(key, f"_key_{key}")
    out = ranged.join(durable(offsets), same, "inner")
    local = Window.partitionBy(*keys).orderBy(_LOCAL).rowsBetween(Window.unboundedPreceding, 0)
    for name in sums:
        running = F.sum(f"_add_{name}").over(local)
        out = out.withColumn(name, F.coalesce(F.col(f"_before_{name}"), F.lit(0)) + running)
    return out.select(
        *df.columns,
        (F.col(_BEFORE) + F.col(_LOCAL) - F.col(_FIRST) + 1).cast("bigint").alias(ordinal),
        *sums,
    )


#: rows sampled for each range, and ranges for each shuffle partition
SAMPLED, RANGES = 16, 2


def number_in_place(
    df: DataFrame, order_by: Sequence[str], within: Sequence[str] = (), sums: Mapping[str, Column] | None = None, ordinal: str = "ordinal"
) -> DataFrame:
    """``number_rows`` for rows that are read again rather than copied: nothing as wide as ``df`` is written.

    Bounds of the ranges come from a sample of the keys and are fixed in the plan: two for each shuffle partition, each drawn from 16
    rows, so the driver's part does not grow with the rows.  A first pass reads the keys alone and counts each range; the result reads ``df`` once more, sorts each range and shifts it by the counts before.  So the pass that
    counts and the one that numbers agree whatever is lost or run again, as long as ``df`` gives the same rows each time it is
    read: write it down first if it does not.  Where ``df`` is an aggregate that costs much and holds little, take ``number_rows``.

    Keys are ascending with nulls first.  Rows equal in all keys share a range, and are numbered in any order; an empty ``df`` gives
    an empty result.
    """
    sums = dict(sums or {})
    keys = [*within, *order_by]
    ranges = RANGES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = _with_range(df, keys, _bounds(df.select(F.struct(*keys).alias("_key")), ranges))
    added = ranged.select(_RANGE, *within, *[e.alias(f"_add_{n}") for n, e in sums.items()])
    totals = added.groupBy(_RANGE, *within).agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(f"_add_{n}").alias(f"_sum_{n}") for n in sums])
    earlier = Window.partitionBy(*within).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_key_{k}") for k in (_RANGE, *within)],
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(_BEFORE),
        *[F.sum(f"_sum_{n}").over(earlier).alias(f"_before_{n}") for n in sums],
    )
    each = Window.partitionBy(_RANGE, *within).orderBy(*order_by)
    upto = each.rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", F.row_number().over(each).alias(_LOCAL), *[F.sum(e).over(upto).alias(f"_upto_{n}") for n, e in sums.items()])
    same = (F.col(_RANGE) == F.col(f"_key_{_RANGE}")) & _same(within)
    # every row has its offset; a left join spares the search a second run to rule out nulls
    return local.join(durable(offsets), same, "left").select(
        *df.columns,
        (F.col(_BEFORE) + F.col(_LOCAL)).cast("bigint").alias(ordinal),
        *[(F.coalesce(F.col(f"_before_{n}"), F.lit(0)) + F.col(f"_upto_{n}")).alias(n) for n in sums],
    )


def _bounds(keys: DataFrame, ranges: int) -> list[Row]:
    """At most ``ranges`` ascending keys, each the end of a range, from a sample of ``SAMPLED`` rows for each range."""
    drawn = keys.withColumn("_draw", F.xxhash64("_key", F.monotonically_increasing_id())).orderBy("_draw").limit(ranges * SAMPLED)
    found = drawn.agg(F.array_distinct(F.array_sort(F.collect_list("_key"))).alias("_all"))
    step = F.greatest(F.lit(1), F.ceil(F.size("_all") / ranges)).cast("int")
    return found.select(F.filter("_all", lambda _, i: i % step == step - 1)).first()[0]


def _with_range(df: DataFrame, keys: Sequence[str], bounds: list[Row]) -> DataFrame:
    """Add a number that grows with the key: two short searches, first among the ends of groups of bounds, then within one."""

    def value(v, kind: DataType) -> Column:
        return F.lit(v.isoformat() if isinstance(kind, TimestampNTZType) and v is not None else v).cast(kind)

    def struct(row: Row) -> Column:
        return F.struct(*[value(v, df.schema[k].dataType).alias(k) for k, v in zip(keys, row, strict=True)])

    if not bounds:
        return df.withColumn(_RANGE, F.lit(0))
    width = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    below = lambda found: F.coalesce(F.size(F.filter(found, lambda b: b <= F.struct(*keys))), F.lit(0))
    passed = df.withColumn("_passed", below(F.array(*[struct(g[-1]) for g in groups])))
    inside = below(F.get(F.array(*[F.array(*map(struct, g)) for g in groups]), F.col("_passed")))
    return passed.withColumn(_RANGE, F.col("_passed") * width + inside).drop("_passed")


def _same(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for key in keys:
        cond = cond & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    return cond


def top_n_per_group(
    df: DataFrame, group: Sequence[str], order_by: Sequence[Column | str], n: int, salt_on: str, salts: int = 32
) -> DataFrame:
    """First ``n`` rows of each group in the given (total) order.

    A group is first cut to ``n`` rows per salt, so a hot group reaches its final task
    with at most ``n * salts`` rows.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_on), F.lit(salts)))
    inner = Window.partitionBy(*group, "_salt").orderBy(*order_by)
    outer = Window.partitionBy(*group).orderBy(*order_by)
    return (
        salted.withColumn("_rank", F.row_number().over(inner))
        .filter(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(outer))
        .filter(F.col("_rank") <= n)
        .drop("_salt", "_rank")
    )


def with_previous(df: DataFrame, order_by: Sequence[str], within: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Add ``previous_<column>`` from the row before, per ``within`` group.

    One sort deals the rows to ranges; within a range the columns are moved down by a row, batch by batch.  Only the first row of a
    range lacks its neighbour, which is the last one of the range before: one row per range, so a small table carries them.
    The ranges are written, so that first and last rows agree.  Rows equal in all keys may stand in any order.
    """
    names = [*df.columns]
    keys = [*within, *[c for c in columns if c not in within]]

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, seen, before = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            above = {}
            for c in keys:
                column = batch.column(c)
                first = before[c] if before else pa.nulls(1, column.type)
                above[c] = pa.concat_arrays([first, column.slice(0, n - 1)])
            same = np.ones(n, bool)
            same[0] = before is not None
            for c in within:
                equal = pc.equal(batch.column(c), above[c]).fill_null(False)
                both = pc.and_(pc.is_null(batch.column(c)), pc.is_null(above[c]))
                same &= pc.or_(equal, both).to_numpy(zero_copy_only=False)
            keep = pa.array(same)
            before = {c: batch.column(c).slice(n - 1) for c in keys}
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *(pc.if_else(keep, above[c], pa.nulls(n, above[c].type)) for c in columns),
                 pa.array(np.full(n, place, np.int32)), pa.array(np.arange(seen, seen + n))],
                names=[*names, *(f"previous_{c}" for c in columns), _RANGE, _LOCAL],
            )
            seen += n

    schema = StructType(
        [*df.schema.fields, *[StructField(f"previous_{c}", df.schema[c].dataType) for c in columns], StructField(_RANGE, IntegerType()), StructField(_LOCAL, LongType())]
    )
    ranged = durable(df.orderBy(*within, *order_by).mapInArrow(moved, schema))
    # one row per range
    ends = ranged.groupBy(_RANGE).agg(F.max_by(F.struct(*keys), _LOCAL).alias("_end"))
    before = ends.select((F.col(_RANGE)).alias("_at"), F.lag("_end").over(Window.orderBy(_RANGE)).alias("_end"))
    heads = ranged.filter(F.col(_LOCAL) == 0).join(F.broadcast(before), F.col(_RANGE) == F.col("_at"))
    near = F.col("_end").isNotNull()
    for c in within:
        near = near & F.col(c).eqNullSafe(F.col("_end")[c])
    mended = heads.select(*names, *[F.when(near, F.col("_end")[c]).alias(f"previous_{c}") for c in columns])
    return ranged.filter(F.col(_LOCAL) > 0).drop(_RANGE, _LOCAL).unionByName(mended)
