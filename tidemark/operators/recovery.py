"""Recovery of a crawl's state from three sides: the index's export, the stored inventory and a listing.

The sides meet by path in one grouping, which reduces each side before its shuffle. What
is listed decides; every path gets a kind that says how the sides disagree:

========== ======== ======= ======= ===========================================
kind       listed   stored  index   action
========== ======== ======= ======= ===========================================
agreed     yes      same    current none
unstored   yes      no, or  current none; stored as listed
                    other
lost       yes      yes     no      INSERT
new        yes      no      no      INSERT
stale      yes      any     older   UPDATE
ghost      no       any     yes     DELETE
forgotten  no       yes     no      none; no longer stored
========== ======== ======= ======= ===========================================

Times are compared by whole seconds. A file that the rules refuse is not listed. Of a
path repeated on one side the newest row counts. Null paths are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import has_parent, parent_folder
from ..functions.values import seconds
from .filters import PathRules
from .inventory import RECOVERED_LEVEL, as_inventory, leaf_folders, tasks, version

AGREED, UNSTORED, LOST, NEW = "agreed", "unstored", "lost", "new"
STALE, GHOST, FORGOTTEN = "stale", "ghost", "forgotten"


@dataclass(frozen=True)
class Recovery:
    """``merged`` has a row per path (kind, action, time, size); the rest follows from it."""

    merged: DataFrame

    def inventory(self) -> DataFrame:
        """What to store: every listed file, as listed."""
        return as_inventory(self.merged.where("listed").select("path", "last_modified_ms", "size"))

    def actions(self) -> DataFrame:
        return self.merged.where("action is not null").select("path", "action", "last_modified_ms", "size")

    def tasks(self) -> DataFrame:
        """Crawl tasks of the lowest folders in which the index and the listing disagree."""
        folders = self.merged.where(F.col("action").isNotNull() & has_parent("path")).select(
            parent_folder("path").alias("folder")).distinct()
        return tasks(leaf_folders(folders), RECOVERED_LEVEL)


def _side(rows: DataFrame, name: str, path: str = "path", size: Column | None = None) -> DataFrame:
    if "is_dir" in rows.columns:
        rows = rows.where(~F.col("is_dir"))
    zero = F.lit(0).cast("bigint")
    size = F.col("size").cast("bigint") if size is None else size
    return rows.where(F.col(path).isNotNull()).select(
        F.col(path).alias("path"), F.lit(name).alias("side"),
        F.coalesce(F.col("last_modified_ms").cast("bigint"), zero).alias("ms"), F.coalesce(size, zero).alias("size"))


def reconcile(index: DataFrame, stored: DataFrame, listing: DataFrame, rules: PathRules | None = None) -> Recovery:
    """Merge the index's export (``id``, ``last_modified_ms``), the stored files and a whole listing."""
    kept = listing.where((rules or PathRules()).keeps_entry())
    sides = _side(index, "i", "id", F.lit(0).cast("bigint")).unionByName(_side(stored, "s")).unionByName(_side(kept, "l"))
    order = version("ms", "size")

    def newest(name: str, column: str) -> Column:
        mine = F.col("side") == name
        return F.max_by(F.when(mine, F.col(column)), F.when(mine, order)).alias(f"{name}_{column}")

    by_path = sides.groupBy("path").agg(*[newest(n, c) for n in "isl" for c in ("ms", "size")])
    has = {n: F.col(f"{n}_ms").isNotNull() for n in "isl"}
    same = has["s"] & (seconds("s_ms") == seconds("l_ms")) & (F.col("s_size") == F.col("l_size"))
    kind = (
        F.when(has["l"] & ~has["i"], F.when(has["s"], LOST).otherwise(NEW))
        .when(has["l"] & (seconds("i_ms") < seconds("l_ms")), STALE)
        .when(has["l"], F.when(same, AGREED).otherwise(UNSTORED))
        .when(has["i"], GHOST).otherwise(FORGOTTEN)
    )
    action = F.when(F.col("kind").isin(LOST, NEW), "INSERT").when(F.col("kind") == STALE, "UPDATE").when(
        F.col("kind") == GHOST, "DELETE")
    return Recovery(by_path.withColumn("kind", kind).select(
        "path", "kind", action.alias("action"), has["l"].alias("listed"),
        F.coalesce("l_ms", "s_ms", "i_ms").alias("last_modified_ms"), F.coalesce("l_size", "s_size", F.lit(0)).cast("bigint").alias("size")))
