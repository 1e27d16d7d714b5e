"""Folder digests: a crawl compares files only in folders whose digests differ.

A folder's own digest adds up two hashes of (path, whole second, size) of its files, so
neither order nor partitioning matters; its subtree's digest adds up the own digests at
and below it. Both are sums of partial sums. ``descend`` starts at the roots and goes on
to the folders below a folder only where the subtree digests of the stored and the
listed side differ, a level a round. Files then meet in a full join for the folders that
changed, and all other stored files are unchanged without any comparison.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import col
from ..functions.paths import ancestors, parent_folder
from ..functions.values import seconds
from ..session import checkpoint_root
from .filters import PathRules
from .inventory import REJECT, UNCHANGED, diff

_SUMS = ("n", "low", "high")


def depth(folder: Column | str) -> Column:
    return F.regexp_count(col(folder), F.lit("/")).cast("int")


def _hash(seed: str) -> Column:
    # Whole numbers of 19 digits: their sums are exact in any order, far beyond the number of files there can be.
    return F.xxhash64(F.lit(seed), "path", seconds("last_modified_ms"), "size").cast("decimal(19,0)")


def own_digests(files: DataFrame) -> DataFrame:
    """``(folder, n, low, high)`` of the files directly in each folder."""
    return files.where(~F.col("is_dir")).groupBy(parent_folder("path").alias("folder")).agg(
        F.count(F.lit(1)).cast("decimal(38,0)").alias("n"),
        *[F.sum(_hash(s)).cast("decimal(38,0)").alias(s) for s in _SUMS[1:]])


def subtree_digests(own: DataFrame) -> DataFrame:
    """``(folder, n, low, high)`` at and below each folder, folders without files of their own included."""
    above = own.select(F.explode(F.concat(ancestors("folder"), F.array("folder"))).alias("folder"), *_SUMS)
    return above.groupBy("folder").agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in _SUMS])


@dataclass(frozen=True)
class Descent:
    """``changed`` lists folders whose own files differ; the numbers say what was looked at."""

    changed: DataFrame
    compared: int
    skipped: int


def _paired(stored: DataFrame, listed: DataFrame) -> DataFrame:
    """``(folder, same)`` of the folders of both sides."""
    left = stored.select("folder", F.struct(*_SUMS).alias("a"))
    right = listed.select("folder", F.struct(*_SUMS).alias("b"))
    return left.join(right, "folder", "full").select("folder", F.col("a").eqNullSafe(F.col("b")).alias("same"))


def descend(stored: DataFrame, listed: DataFrame) -> Descent:
    """Folders whose own digests differ, found from the roots downwards; both sides as ``own_digests``.

    A folder is compared if the one above it differs, and skipped if it is not compared.
    """
    checkpoint_root(stored.sparkSession)
    trees = _paired(subtree_digests(stored), subtree_digests(listed)).withColumns(
        {"depth": depth("folder"), "above": parent_folder("folder")}).checkpoint()
    found = trees.groupBy("depth").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("same")).alias("differ")).collect()
    total = sum(r["n"] for r in found)
    own = _paired(stored, listed)
    compared, reached = 0, None
    for level in sorted(r["depth"] for r in found if r["differ"]):  # levels without any difference are never entered
        here = trees.where(F.col("depth") == level)
        known = trees.where(F.col("depth") < level).select(F.col("folder").alias("above"))
        open_ = here.join(known, "above", "left_anti")  # roots
        if reached is not None:
            open_ = open_.unionByName(here.join(reached.withColumnRenamed("folder", "above"), "above", "left_semi"))
        open_ = open_.select("folder", "same").checkpoint()
        compared += open_.count()
        mine = open_.where(~F.col("same")).select("folder")
        reached = mine if reached is None else reached.unionByName(mine)
    if reached is None:
        return Descent(trees.select("folder").limit(0), 0, total)
    return Descent(own.where(~F.col("same")).join(reached, "folder", "left_semi").select("folder"), compared, total - compared)


def digest_diff(
    previous: DataFrame, current: DataFrame, rules: PathRules | None = None, stored: DataFrame | None = None,
) -> tuple[DataFrame, Descent]:
    """The rows of ``inventory.diff``, with files compared in changed folders only, and the descent.

    ``stored`` are the stored files' ``own_digests`` where an earlier crawl has kept
    them. Refused files are no part of the listed digests, so a folder that the rules
    judge anew differs. Listings that know unreadable entries go to ``diff`` itself.
    """
    if "readable" in current.columns:
        raise ValueError("unreadable entries have no digest; use inventory.diff")
    rules = rules or PathRules()
    old = previous.where(~F.col("is_dir")).withColumn("folder", parent_folder("path"))
    now = current.where(~F.col("is_dir")).withColumns({"folder": parent_folder("path"), "_kept": rules.keeps_entry()})
    found = descend(own_digests(old) if stored is None else stored, own_digests(now.where("_kept")))
    changed = found.changed.checkpoint()
    compared = diff(
        old.join(changed, "folder", "left_semi").drop("folder"), now.join(changed, "folder", "left_semi").drop("folder", "_kept"), rules)
    names = ["path", "status", "last_modified_ms", "size"]
    same = old.join(changed, "folder", "left_anti").withColumn("status", F.lit(UNCHANGED)).select(names)
    refused = now.where(~F.coalesce("_kept", F.lit(False))).join(changed, "folder", "left_anti").groupBy("path").agg(
        F.max(F.struct("last_modified_ms", "size")).alias("v")).select("path", F.lit(REJECT).alias("status"), "v.*")
    return compared.unionByName(same).unionByName(refused.select(names)), found
