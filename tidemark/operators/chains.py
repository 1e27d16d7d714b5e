"""Chains over a table of (id, parent): full paths by pointer doubling.

Every row knows how far up it has come; a round lets it jump as far again by what the row it
points to knows, so a chain of a million rows takes twenty rounds. Only rows that are still
under way are joined, each to the one row it points to. A first pass works on numbers
alone and tells roots, orphans and cycles; paths are built in a second one, without the
rows of cycles, whose paths would have no end. Each round writes the rows that it moved by ``checkpoint()``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root

WHOLE, ORPHAN, CYCLE = "whole", "orphan", "cycle"


def _starts(nodes: DataFrame, identifier: str, parent: str, name: str) -> DataFrame:
    """One row per id, with ``jump`` (null at the top) and whether the parent is missing."""
    rows = nodes.where(F.col(identifier).isNotNull()).select(
        F.col(identifier).alias("id"), F.col(parent).alias("parent"), F.col(name).cast("string").alias("name"))
    least = F.min(F.struct(F.col("parent").isNull().alias("none"), "parent", "name")).alias("v")
    one = rows.groupBy("id").agg(least).select("id", "v.parent", "v.name")
    ids = one.select(F.col("id").alias("known"))
    return one.join(ids, one["parent"] == ids["known"], "left").select(
        "id", "name", F.col("known").alias("jump"),
        F.when(F.col("parent").isNotNull() & F.col("known").isNull(), ORPHAN).otherwise(WHOLE).alias("status"))


def _climb(rows: DataFrame, carried: str, joined, limit: int | None) -> tuple[DataFrame, int]:
    """Rounds of doubling until no row has a ``jump``, or ``limit`` rounds; ``joined(mine, further)`` extends ``carried``."""
    checkpoint_root(rows.sparkSession)
    names = rows.columns
    rows, rounds = rows.checkpoint(), 0
    ended, moving = [rows.where("jump is null")], rows.where("jump is not null")
    while (limit is None or rounds < limit) and not moving.isEmpty():
        every = reduce(DataFrame.unionByName, [*ended, moving])
        up = every.select(
            F.col("id").alias("jump"), F.col("jump").alias("up_jump"), F.col("root").alias("up_root"),
            F.col("status").alias("up_status"), F.col(carried).alias("up_carried"))
        moved = moving.drop("root", "status").join(up, "jump").select(
            *[c for c in names if c not in ("jump", "root", "status", carried)],
            F.col("up_jump").alias("jump"), F.col("up_root").alias("root"), F.col("up_status").alias("status"),
            joined(F.col(carried), F.col("up_carried")).alias(carried)).select(*names).checkpoint()
        # A row that has come to its top stays where it was written.
        ended, moving = [*ended, moved.where("jump is null")], moved.where("jump is not null")
        rounds += 1
    return reduce(DataFrame.unionByName, [*ended, moving]), rounds


def chains(
    nodes: DataFrame, identifier: str = "id", parent: str = "parent", name: str = "name", with_path: bool = True,
) -> DataFrame:
    """``(id, root, depth, status)`` of every id, and ``path``, the names from the top down to it.

    ``status`` is ``whole`` below a row without a parent, ``orphan`` below one whose
    parent is not in the table (that row is the root then), and ``cycle`` in or below a
    cycle (root, depth and path are null). Null ids are left out; of several rows of
    one id the one with the smallest parent counts, a null one last.
    """
    checkpoint_root(nodes.sparkSession)
    start = _starts(nodes, identifier, parent, name).checkpoint()
    top = F.when(F.col("jump").isNull(), F.col("id"))
    steps = F.when(F.col("jump").isNull(), 0).otherwise(1).cast("bigint")
    # A chain without a cycle ends within as many doublings as the number of rows has digits to base two.
    limit = max(1, start.count()).bit_length() + 1
    ends, _ = _climb(
        start.select("id", "jump", top.alias("root"), "status", steps.alias("depth")), "depth", lambda a, b: a + b, limit)
    endless = F.col("jump").isNotNull()
    made = ends.select(
        "id", F.when(~endless, F.col("root")).alias("root"), F.when(~endless, F.col("depth")).alias("depth"),
        F.when(endless, CYCLE).otherwise(F.col("status")).alias("status"))
    if not with_path:
        return made
    finite = start.join(made.where(F.col("status") != CYCLE).select("id"), "id", "left_semi")
    paths, _ = _climb(
        finite.select("id", "jump", top.alias("root"), "status", F.array("name").alias("path")), "path",
        lambda a, b: F.concat(b, a), None)
    return made.join(paths.select("id", "path"), "id", "left")
