"""Connected components of a link table, without gathering any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.session import durable


def components(links: DataFrame, source: str = "a", target: str = "b") -> DataFrame:
    """``id, component`` for every id in ``links``; the component is its smallest id.

    Each round every id moves to its smallest neighbour (found by a minimum that is combined before the shuffle) and on
    to where that one moves; the links are then drawn between the new places, and what became a loop or double is
    dropped.  So links shrink from round to round, and long chains need a logarithmic number of rounds.  All joins are
    equi joins of written tables on unique ids: a hub that holds a third of the links is split by the adaptive skew join.
    """
    pair = links.select(F.col(source).alias("a"), F.col(target).alias("b"))
    places = durable(pair.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("component")))
    open_ = durable(pair.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while not open_.isEmpty():
        both = open_.union(open_.select("b", "a"))
        lower = durable(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low")).select("id", F.least("id", "low").alias("low")))
        step = durable(lower.join(lower.select(F.col("id").alias("low"), F.col("low").alias("to")), "low").select("id", "to"))
        move = lambda df, column: df.join(step.select(F.col("id").alias(column), "to"), column, "left").withColumn(
            column, F.coalesce("to", column)
        ).drop("to")
        places = durable(move(places, "component"))
        moved = move(move(open_, "a"), "b").filter("a != b")
        open_ = durable(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return places
