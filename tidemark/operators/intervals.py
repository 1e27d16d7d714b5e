"""Folders as intervals: a subtree is a range of pre-order numbers.

One range sort over the folders, and over the place behind each subtree, gives every folder
its number and the last number below it. "At or below one of these folders" is then a
comparison of numbers: overlapping subtrees are reduced to the outermost ones by a
running sum, so together they hold no number twice, and folders meet them by bins of
numbers. No folder is multiplied by its depth, and the root is no join key.

Folders are texts with ``/`` between the names; the characters U+0000 to U+0002 must not
occur in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import has_parent, parent_folder
from .numbering import rows_before

#: Numbers of one bin; an interval is listed once per bin it reaches into.
BIN = 64


def labels(folders: DataFrame) -> DataFrame:
    """``(folder, first, last)``: 0-based pre-order numbers of each distinct folder and of the end of its subtree."""
    distinct = folders.select("folder").where(F.col("folder").isNotNull()).distinct()
    # With the separator below all other characters a subtree is one range, and ends before its own name and U+0002.
    key = F.translate("folder", "/", "\x01")
    marked = distinct.select("folder", F.explode(F.array(
        F.struct(F.concat(key, F.lit("\x01")).alias("key"), F.lit(1).alias("own")),
        F.struct(F.concat(key, F.lit("\x02")).alias("key"), F.lit(0).alias("own")))).alias("m")).select("folder", "m.*")
    placed = rows_before(marked, [], ["key", "own"], "own", "_before")
    return placed.groupBy("folder").agg(
        F.max(F.when(F.col("own") == 1, F.col("_before"))).alias("first"),
        (F.max(F.when(F.col("own") == 0, F.col("_before"))) - 1).alias("last"))


def leaves(labelled: DataFrame) -> DataFrame:
    """Folders with no other folder below them."""
    return labelled.where(F.col("first") == F.col("last")).select("folder")


def outermost(labelled: DataFrame) -> DataFrame:
    """The intervals that lie in no other one."""
    ends = labelled.select(F.explode(F.array(
        F.struct(F.col("first").alias("at"), F.lit(1).alias("turn"), F.lit(1).alias("open"), F.col("last").alias("last")),
        F.struct((F.col("last") + 1).alias("at"), F.lit(0).alias("turn"), F.lit(-1).alias("open"), F.lit(None).cast("bigint").alias("last")),
    )).alias("e")).select("e.*")
    placed = rows_before(ends, [], ["at", "turn"], "open", "_inside")
    return placed.where((F.col("open") == 1) & (F.col("_inside") == 0)).select(F.col("at").alias("first"), "last")


def inside(labelled: DataFrame, tops: DataFrame) -> DataFrame:
    """The rows of ``labelled`` at or below one of the labelled folders ``tops``."""
    ranges = outermost(tops).select(
        F.col("first").alias("_from"), F.col("last").alias("_to"),
        F.explode(F.sequence(F.floor(F.col("first") / BIN), F.floor(F.col("last") / BIN))).alias("_bin"))
    binned = labelled.withColumn("_bin", F.floor(F.col("first") / BIN))
    meets = (binned["_bin"] == ranges["_bin"]) & F.col("first").between(F.col("_from"), F.col("_to"))
    return binned.join(ranges, meets, "left_semi").drop("_bin")


def below(files: DataFrame, removed: DataFrame, path: str = "path") -> DataFrame:
    """Files at any depth under a removed folder (``folder``), by labels of both."""
    parents = files.where(has_parent(path)).select(parent_folder(path).alias("folder")).distinct()
    labelled = labels(parents.unionByName(removed.select("folder")))
    tops = labelled.join(removed.select("folder").distinct(), "folder", "left_semi")
    doomed = inside(labelled, tops).select(F.col("folder").alias("_folder"))
    return files.withColumn("_folder", parent_folder(path)).join(doomed, "_folder", "left_semi").drop("_folder")
