"""Folder trees given as ``(id, parent_id, name, is_folder)`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.functions import paths, rules
from estate.session import durable


def folder_paths(
    items: DataFrame, root: object, skip: list[str] | None = None
) -> DataFrame:
    """``(id, path, depth)`` of every folder below ``root``, by pointer doubling.

    Each folder knows the path from an ancestor, at first its parent, down to itself.  A round joins the folders that have not reached
    the root with the folders of their ancestor, so the known stretch doubles: a tree of 1,000 levels takes ten rounds.
    A round is one join and one written table, with no more rows than there are folders; what has reached the root is not written again
    but is looked up by the later rounds, as are the stretches of the round itself.

    Folders named in ``skip`` are left out with all they hold, and so are folders that hang from no known folder; a folder without a name
    is kept.  Trees may be of any depth.  A folder below itself is an error, and so is one with two parents; a
    folder that is listed twice counts twice.
    """
    folders = items.filter("is_folder").select("id", "parent_id", "name")
    if skip:
        folders = folders.filter(~F.coalesce(F.col("name").isin(skip), F.lit(False)))
    # a folder without a name adds nothing to a path
    start = folders.select(
        "id", F.col("parent_id").alias("up"), F.col("name").alias("path"), F.lit(1).alias("depth"), F.coalesce(F.col("parent_id") == F.lit(root), F.lit(False)).alias("there")
    )
    known = durable(start)
    if not known.groupBy("id").agg(F.min("up").alias("low"), F.max("up").alias("high")).filter("low < high").isEmpty():
        raise ValueError("a folder has two parents: it lies below itself or in two places, a cycle or no tree")
    reached = [known.filter("there").drop("there", "up")]
    waiting = known.filter("not there")
    left = waiting.count()
    while left:
        # the stretches of this round: those that have reached the root, of all rounds, and those that wait
        ends = reached[0]
        for more in reached[1:]:
            ends = ends.unionByName(more)
        stretches = ends.withColumn("up", F.lit(None).cast(known.schema["up"].dataType)).withColumn("there", F.lit(True)).unionByName(waiting)
        above = stretches.select(F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("path").alias("_path"), F.col("depth").alias("_depth"), F.col("there").alias("_there"))
        joined = durable(
            waiting.join(above, F.col("up") == F.col("_id")).select(
                "id", F.col("_up").alias("up"), F.concat_ws("/", "_path", "path").alias("path"), (F.col("_depth") + F.col("depth")).alias("depth"),
                F.col("_there").alias("there"),
            )
        )
        reached.append(joined.filter("there").drop("there", "up"))
        waiting = joined.filter("not there")
        # the nearest of the waiting folders ends in each round, at the root or where its ancestor isn't known
        still = waiting.count()
        if still == left:
            raise ValueError("a folder lies below itself: the tree has a cycle")
        left = still
    out = reached[0]
    for more in reached[1:]:
        out = out.unionByName(more)
    return out


def flatten_hierarchy(
    items: DataFrame, root: object, skip: list[str] | None = rules.SKIPPED_FOLDERS, folders: DataFrame | None = None
) -> DataFrame:
    """Full path of every file below ``root``.

    Only folders take part in the level joins; files are joined once.  A folder holding
    very many files is split by the adaptive skew join, whose other side is unique.
    """
    known = folder_paths(items, root, skip) if folders is None else folders
    files = items.filter(~F.col("is_folder")).select("id", "parent_id", "name")
    inside = files.join(known.select(F.col("id").alias("parent_id"), F.col("path").alias("folder")), "parent_id")
    at_root = files.filter(F.col("parent_id") == F.lit(root)).select("id", F.col("name").alias("path"), "name")
    return inside.select("id", F.concat_ws("/", "folder", "name").alias("path"), "name").unionByName(at_root)


def resolve_folder(requests: DataFrame, items: DataFrame, root: object) -> DataFrame:
    """Folder id of each requested ``folder_path``; names match exactly, ``found`` tells if one exists.

    The empty path and ``/`` are the root itself.
    """
    known = folder_paths(items, root).select(F.col("path").alias("_path"), F.col("id").alias("_id"))
    asked = requests.withColumn("_path", paths.normalize_path("folder_path", url=True))
    is_root = F.col("_path") == ""
    return asked.join(known, "_path", "left").select(
        "folder_path",
        F.when(is_root, F.lit(root)).otherwise(F.col("_id")).alias("folder_id"),
        (is_root | F.col("_id").isNotNull()).alias("found"),
    )
