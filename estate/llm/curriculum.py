"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0..1.  Its integral says how many of the source's
tokens are due by a given time; inverting that demand at the running token total of a document gives the
document's training position, and a range sort by position gives the training order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estate.llm.words import fresh, word_count
from estate.operators.ordering import number_rows
from estate.session import durable

#: a source is repeated at most so often
MAX_EPOCHS = 3
#: base weights of the sources by code point, repeating
WEIGHTS = (1, 2, 3)
#: change of a source's weight over time, repeating: its weight runs from ``1 - s`` to ``1 + s`` times the mean
SLOPES = (-0.5, 0.0, 0.5)


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, weight_rank, target`` from ``source, size``.

    The targets share the sum of all sizes by weight; a target above ``max_epochs`` times its source is cut to
    that and the excess goes to the others by weight.  That ends where every open source gets the same amount
    per weight, and sources close in the order of capacity per weight, so one pass in that order finds it.
    The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("bigint") - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("weight_rank") % len(weights) + 1).cast("int"))
    ranked = per.withColumn("weight_rank", rank).withColumn("_w", weight).withColumn("_cap", F.col("source_size") * max_epochs)
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "weight_rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / (
        F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    )
    levelled = ranked.withColumn("_level", level)
    open_ = F.col("_level") * F.col("_w") < F.col("_cap")
    # the first open source in this order fixes the amount per weight for all later ones
    final = F.first(F.when(open_, F.col("_level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.coalesce(final * F.col("_w"), F.col("_cap").cast("double")), F.col("_cap").cast("double"))
    return levelled.select("source", "source_size", "weight_rank", target.alias("target"))


def position(share: Column, slope: Column) -> Column:
    """The time at which ``share`` of a source's tokens is due.

    The weight ``1 + slope (2t - 1)`` integrates to ``W(t) = (1 - slope) t + slope t^2``; this is its inverse, in a
    form that also holds for slope 0.
    """
    lead = F.lit(1.0) - slope
    return 2 * share / (lead + F.sqrt(lead * lead + 4 * slope * share))


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size`` of each row, written once: the texts are read for nothing else."""
    return durable(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))


def plan_mix(docs: DataFrame, **options) -> DataFrame:
    """``plan_sizes`` of the words of ``docs``."""
    return plan_sizes(sizes(docs), **options)


def plan_sizes(
    narrow: DataFrame, weights: Sequence[int] = WEIGHTS, slopes: Sequence[float] = SLOPES, max_epochs: int = MAX_EPOCHS, seed: str = "mix"
) -> DataFrame:
    """``doc_id, source, rows, source_size, target, copies, positions`` for each distinct pair of document and source.

    Documents of a source are taken in the order of ``md5(seed:doc_id)``: whole passes over the source, then those
    whose middle lies within the rest of the target.  Copy ``k`` sits where its middle token is due.  Running
    totals come from range-partitioned rows, so a source with a third of all rows is many tasks.  The plan is written.

    Null text has size 0; a null source is a source, the last one; rows that share a document id and source,
    a null id included, are one unit and get the same copies; an empty table gives an empty plan.
    """
    units = narrow.groupBy("doc_id", "source").agg(F.sum("size").cast("bigint").alias("unit"), F.count(F.lit(1)).alias("rows"))
    keyed = units.withColumn("_key", F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))))
    running = number_rows(keyed, ["_key", "doc_id"], ["source"], {"until": F.col("unit")})
    targets = source_targets(narrow, weights, max_epochs)
    joined = running.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = F.col("target") - full * F.col("source_size")
    middle = F.col("until") - F.col("unit") / 2
    copies = full + F.when((F.col("unit") > 0) & (middle < rest), 1).otherwise(0)
    slope = F.element_at(F.array(*[F.lit(float(s)) for s in slopes]), (F.col("weight_rank") % len(slopes) + 1).cast("int"))
    due = lambda k: F.least((k * F.col("source_size") + middle) / F.col("target"), F.lit(1.0))
    positions = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1), lambda k: position(due(k), slope)))
    planned = joined.withColumn("copies", copies.cast("bigint")).select(
        "doc_id", "source", "rows", "source_size", "target", "copies", F.coalesce(positions, F.array().cast("array<double>")).alias("positions")
    )
    return durable(planned)


def _with_plan(docs: DataFrame, plan: DataFrame, name: str = "_plan") -> DataFrame:
    """Each row of ``docs`` with its unit's plan in the column ``name``; the plan is unique per document and source."""
    d, o = fresh(docs, "_d"), fresh(docs, "_s")
    side = plan.select(F.col("doc_id").alias(d), F.col("source").alias(o), F.struct("rows", "source_size", "target", "copies", "positions").alias(name))
    return docs.join(side, F.col("doc_id").eqNullSafe(F.col(d)) & F.col("source").eqNullSafe(F.col(o))).drop(d, o)


def mix_sizes(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies, positions`` per row of ``docs``: what ``mix`` takes of it."""
    narrow = sizes(docs)
    planned = _with_plan(narrow, plan_sizes(narrow, **options))
    p = F.col("_plan")
    return planned.select(
        "doc_id", "size", p["source_size"].alias("source_size"), p["target"].alias("target"),
        (F.col("size") * p["copies"]).alias("taken"), p["copies"].alias("copies"), p["positions"].alias("positions"),
    )


def mixed_sizes(docs: DataFrame, places: bool = False, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` per row of ``docs``, with ``taken`` counted in the range-sorted result of ``mix``.

    That result is made of ids, sources and sizes, without the texts.  Rows that share an id and source have the same copies, so each
    has its share of what the result holds of them.  ``places`` adds ``first_position`` and ``last_position``, null for what is left out.
    """
    narrow = sizes(docs)
    plan = plan_sizes(narrow, **options)
    mixed = durable(mix(narrow, plan))
    held = mixed.groupBy("doc_id", "source").agg(F.count(F.lit(1)).alias("_held"), F.min("position").alias("_first"), F.max("position").alias("_last"))
    held = held.select(F.col("doc_id").alias("_i"), F.col("source").alias("_o"), "_held", "_first", "_last")
    unit = plan.join(held, F.col("doc_id").eqNullSafe(F.col("_i")) & F.col("source").eqNullSafe(F.col("_o")), "left")
    copies = (F.coalesce("_held", F.lit(0)) / F.col("rows")).cast("bigint")
    unit = unit.select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), "source_size", "target", copies.alias("_copies"), "_first", "_last")
    counted = narrow.join(unit, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")))
    more = [F.col("_first").alias("first_position"), F.col("_last").alias("last_position")] if places else []
    return counted.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("_copies")).alias("taken"), *more)


def mix(docs: DataFrame, plan: DataFrame | None = None, **options) -> DataFrame:
    """The rows of ``docs`` in training order, repeated or left out as planned, with ``position`` (0 to 1).

    A ``plan`` that ``plan_mix`` made of the same rows is used as it is.  Null texts, empty texts and rows without an id or source are
    taken as ``plan_sizes`` says; a repeated row has the copies of its unit each time; a column ``position`` of ``docs`` stays and
    the new one gets an underscore; an empty table gives an empty result.
    """
    at, name = fresh(docs, "position"), fresh(docs, "_plan")
    plan = plan_mix(docs, **options) if plan is None else plan
    copied = _with_plan(docs, plan, name).select(*docs.columns, F.explode(f"{name}.positions").alias(at))
    return copied.orderBy(at, "doc_id")
