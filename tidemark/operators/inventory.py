"""Folder inventory: snapshot comparison, cascades and state."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import col
from ..functions.paths import ancestors, file_name, has_parent, level_below, parent_folder
from ..functions.values import seconds, zulu_to_ms
from .filters import PathRules

RECOVERED_LEVEL = 99

INSERT, UPDATE, DELETE = "insert", "update", "delete"
UNCHANGED, REJECT = "unchanged", "reject"


def version(modified: Column | str, size: Column | str) -> Column:
    """(modified, size) as one number of up to 38 digits: it orders like the pair and can be hashed."""
    return col(modified).cast("decimal(19,0)") * F.lit(Decimal(10**19)) + col(size).cast("decimal(19,0)")


def newest_per_path(df: DataFrame) -> DataFrame:
    """One row per path: the newest, by (modified, size).

    Over numbers and flags this is a hash aggregate; a struct as the order would sort every listed path.
    """
    order = version("last_modified_ms", "size")
    return df.groupBy("path").agg(*[F.max_by(c, order).alias(c) for c in df.columns if c != "path"])


def diff(previous: DataFrame, current: DataFrame, rules: PathRules | None = None) -> DataFrame:
    """Status of every file of two listings, in one full outer join on path.

    The stored side holds one row per path; of a path listed several times the
    newest row counts (reduced before the shuffle the join needs anyway). New files are inserts, files whose
    whole-second time moved forward are updates, stored files that vanished are
    deletes. A file the rules refuse is a reject when new and a delete when stored.
    An entry present but unreadable is left unchanged, never deleted, and so is every
    stored file below a listed folder that could not be read.
    """
    rules = rules or PathRules()
    flag = F.col("readable") if "readable" in current.columns else F.lit(True)
    listed = current.where(~F.col("is_dir")).select(
        "path", "last_modified_ms", "size", F.coalesce(flag, F.lit(True)).alias("readable")
    )
    prev = previous.where(~F.col("is_dir")).select(
        "path", F.lit(True).alias("was"), F.col("last_modified_ms").alias("old_ms"),
        F.col("size").alias("old_size"),
    )
    if "readable" in current.columns:
        prev = prev.withColumn("_folder", parent_folder("path"))
        closed = under_any(parent_folders(prev), closed_folders(current)).select(
            F.col("folder").alias("_folder"), F.lit(True).alias("closed"))
        prev = prev.join(closed, "_folder", "left").drop("_folder")
    else:
        prev = prev.withColumn("closed", F.lit(None).cast("boolean"))
    cur = newest_per_path(listed).withColumn("is_dir", F.lit(False)).select(
        "path", F.lit(True).alias("is"), rules.keeps_entry().alias("kept"), "readable",
        F.col("last_modified_ms").alias("new_ms"),
        F.col("size").alias("new_size"),
    )
    was, now = F.col("was").isNotNull(), F.col("is").isNotNull()
    status = (
        F.when(~now, F.when(F.col("closed"), UNCHANGED).otherwise(DELETE))
        .when(~F.col("readable"), F.when(was, UNCHANGED).otherwise(REJECT))
        .when(was & ~F.col("kept"), DELETE)
        .when(~F.col("kept"), REJECT)
        .when(~was, INSERT)
        .when(seconds("old_ms") < seconds("new_ms"), UPDATE)
        .otherwise(UNCHANGED)
    )
    fresh = F.col("status").isin(INSERT, UPDATE, REJECT)
    return prev.join(cur, "path", "full").withColumn("status", status).select(
        "path", "status",
        F.when(fresh, F.col("new_ms")).otherwise(F.coalesce("old_ms", "new_ms")).alias("last_modified_ms"),
        F.when(fresh, F.col("new_size")).otherwise(F.coalesce("old_size", "new_size")).alias("size"),
    )


def actions(changes: DataFrame) -> DataFrame:
    """Rows sent on to the index: action in upper case, no unchanged or rejected files."""
    return changes.where(F.col("status").isin(INSERT, UPDATE, DELETE)).withColumn(
        "action", F.upper("status")
    )


def apply_changes(previous: DataFrame, changes: DataFrame) -> DataFrame:
    """The stored files after a change set, in one full outer join on path.

    Deletes are removed, inserts and updates replace what is stored, files the
    change set does not mention stay.
    """
    touched = changes.where(F.col("status").isin(INSERT, UPDATE, DELETE)).select(
        "path", F.col("status").alias("_status"), F.col("last_modified_ms").alias("_ms"), F.col("size").alias("_size")
    )
    stored = previous.where(~F.col("is_dir")).select("path", "last_modified_ms", "size")
    untouched = F.col("_status").isNull()
    return (
        stored.join(touched, "path", "full")
        .where(untouched | (F.col("_status") != DELETE))
        .select(
            "path",
            F.when(untouched, F.col("last_modified_ms")).otherwise(F.col("_ms")).alias("last_modified_ms"),
            F.when(untouched, F.col("size")).otherwise(F.col("_size")).alias("size"),
        )
    )


def surviving(changes: DataFrame) -> DataFrame:
    """The stored files after a diff over the whole tree; its rows already name every file."""
    kept = changes.where(F.col("status").isin(INSERT, UPDATE, UNCHANGED))
    return kept.select("path", "last_modified_ms", "size")


def as_inventory(files: DataFrame) -> DataFrame:
    """Files (path, modified, size) in inventory shape."""
    return files.select(
        "path", parent_folder("path").alias("parent"), file_name("path").alias("name"),
        F.lit(False).alias("is_dir"), "last_modified_ms", "size",
    )


def complete_listing(files: DataFrame, listing: str, folders: DataFrame | None = None) -> DataFrame:
    """Files in inventory shape with their listing's id, and a folder row with the number of files.

    ``folders`` adds listed folders that may hold no file.
    """
    names = files.columns
    counts = files.where(~F.col("is_dir")).groupBy(F.col("parent").alias("path")).agg(F.count_distinct("path").alias("entries"))
    if folders is not None:
        counts = folders.select(F.col("folder").alias("path")).distinct().join(counts, "path", "full")
    ends = counts.select(
        "path", parent_folder("path").alias("parent"), file_name("path").alias("name"), F.lit(True).alias("is_dir"),
        F.lit(0).cast("bigint").alias("last_modified_ms"), F.lit(0).cast("bigint").alias("size"),
        F.coalesce("entries", F.lit(0)).cast("bigint").alias("entries"),
    )
    rows = files.select(*names).withColumn("entries", F.lit(None).cast("bigint"))
    return rows.unionByName(ends, allowMissingColumns=True).withColumn("listing", F.lit(listing))


def closed_folders(current: DataFrame) -> DataFrame:
    """Listed folders that could not be read."""
    if "readable" not in current.columns:
        return current.select(F.col("path").alias("folder")).limit(0)
    return current.where(F.col("is_dir") & ~F.coalesce("readable", F.lit(True))).select(F.col("path").alias("folder")).distinct()


def under_any(folders: DataFrame, above: DataFrame, floor: int = 0) -> DataFrame:
    """The folders that are one of ``above`` or lie below one: an equi-join on their own ancestors."""
    lines = folders.select(
        "folder", F.explode(F.concat(ancestors("folder", floor), F.array("folder"))).alias("above"))
    return lines.join(above.select(F.col("folder").alias("above")), "above", "left_semi").select("folder").distinct()


def folders_of(files: DataFrame, floor: int = 0) -> DataFrame:
    """Every listed folder, empty ones included, and every folder above the rows.

    Parents are made distinct first, so the ancestor lists are built per folder
    and not per file; both distincts reduce before their shuffle.
    """
    parents = parent_folders(files)
    if "is_dir" in files.columns:
        own = files.where("is_dir").select(F.col("path").alias("folder"))
        parents = parents.unionByName(own).distinct()
    return (
        parents.select(F.explode(F.concat(ancestors("folder", floor), F.array("folder"))).alias("folder"))
        .distinct()
    )


def parent_folders(files: DataFrame, path: str = "path") -> DataFrame:
    """Distinct folders of the paths that have one."""
    return files.where(has_parent(path)).select(parent_folder(path).alias("folder")).distinct()


def new_folders(previous: DataFrame, current: DataFrame) -> DataFrame:
    return current.join(previous, "folder", "left_anti")


def known_folders(previous: DataFrame, current: DataFrame) -> DataFrame:
    return current.join(previous, "folder", "left_semi")


def gone_folders(
    previous: DataFrame, current: DataFrame, rules: PathRules | None = None, closed: DataFrame | None = None
) -> DataFrame:
    """Stored folders missing from the current listing, or refused by the rules now.

    Nothing is known about folders at or below a ``closed`` one; they are not gone.
    """
    if rules is not None:
        current = current.where(rules.keeps_name("folder"))
    missing = previous.join(current, "folder", "left_anti")
    return missing if closed is None else missing.join(under_any(missing, closed), "folder", "left_anti")


def below(files: DataFrame, removed: DataFrame, floor: int = 0) -> DataFrame:
    """Files at any depth under a removed folder.

    The ancestor test runs once per distinct parent folder; files then meet their
    own parent in an equi-join. No prefix comparison and no pairwise loop.
    """
    doomed = under_any(parent_folders(files), removed, floor)
    return files.withColumn("folder", parent_folder("path")).join(doomed, "folder", "left_semi").drop("folder")


def folder_to_file(previous: DataFrame, current: DataFrame, rules: PathRules | None = None) -> DataFrame:
    """Paths stored as a folder that are a regular file now.

    ``action`` is INSERT for a file the rules keep, else REJECT; the caller also
    cascades a delete over everything below the path.
    """
    rules = rules or PathRules()
    was_dir = previous.where("is_dir").select("path")
    is_file = current.where(~F.col("is_dir"))
    return is_file.join(was_dir, "path", "left_semi").withColumn(
        "action", F.when(rules.keeps_path("path"), "INSERT").otherwise("REJECT")
    )


def missing_roots(roots: DataFrame, current: DataFrame) -> DataFrame:
    """Queued folders that no longer exist; they cascade like any vanished folder."""
    return roots.join(current, "folder", "left_anti")


def leaf_folders(folders: DataFrame, floor: int = 0) -> DataFrame:
    """Folders with no other listed folder below them."""
    inner = folders.select(F.explode(ancestors("folder", floor)).alias("folder")).distinct()
    return folders.join(inner, "folder", "left_anti")


def tasks(folders: DataFrame, level: int | None = None, root: str | None = None) -> DataFrame:
    """Crawl tasks (id, level): a fixed level, else the depth below the root."""
    depth_column = F.lit(level).cast("int") if level is not None else level_below("folder", F.lit(root))
    return folders.select(F.concat("folder", F.lit("/")).alias("id"), depth_column.alias("level"))


def task_json(task_rows: DataFrame) -> DataFrame:
    return task_rows.select("id", F.to_json(F.struct("id", "level")).alias("task"))


def recovery_tasks(index: DataFrame, floor: int = 0) -> DataFrame:
    """Tasks rebuilt from the ids of an index: its leaf folders at the recovered level."""
    return tasks(leaf_folders(parent_folders(index, "id"), floor), RECOVERED_LEVEL)


def recovery_rows(index: DataFrame, columns: Sequence[str] = ("id", "last_modified")) -> DataFrame:
    """Id and modification time of each indexed document, unreadable dates as 0."""
    identifier, modified = columns
    return index.select(F.col(identifier).alias("id"), zulu_to_ms(modified).alias("lastmod"))
