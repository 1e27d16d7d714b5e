"""Crawl plan: listing and stored inventory to changes, actions and the next inventory."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import file_name, parent_folder
from ..operators import inventory as inv
from ..operators.filters import PathRules


@dataclass(frozen=True)
class CrawlPlan:
    changes: DataFrame
    documents: DataFrame
    inventory: DataFrame
    new_folders: DataFrame
    gone_folders: DataFrame


def plan_crawl(
    listing: DataFrame, stored: DataFrame, rules: PathRules | None = None, service: str = "files"
) -> CrawlPlan:
    """Everything one crawl produces.

    The listing covers the whole tree, so the single diff on path already yields
    the deletes of vanished folders; the folder results serve reporting and the
    seeding of tasks.
    """
    rules = rules or PathRules()
    changes = inv.diff(stored, listing, rules)
    todo = inv.actions(changes)
    documents = todo.select(
        F.col("path").alias("id"), F.lit(f"FS:{service}").alias("source"), "action",
        file_name("path").alias("title"), parent_folder("path").alias("parent_id"),
        "last_modified_ms", "size",
    )
    kept = listing.where(rules.keeps_entry())
    before, now = inv.folders_of(stored), inv.folders_of(kept)
    return CrawlPlan(
        changes=changes,
        documents=documents,
        inventory=inv.as_inventory(inv.surviving(changes)),
        new_folders=inv.new_folders(before, now),
        gone_folders=inv.gone_folders(before, now, closed=inv.closed_folders(listing)),
    )
