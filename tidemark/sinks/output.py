"""Outputs of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import gathered


def write_action_log(changes: DataFrame, path: str, mode: str = "append") -> None:
    """Change rows, one folder per action."""
    changes.write.mode(mode).partitionBy("action").parquet(path)


def write_ids(docs: DataFrame, path: str, identifier: str = "id", mode: str = "append") -> None:
    docs.select(F.col(identifier).cast("string").alias("value")).write.mode(mode).text(path)


def to_messages(docs: DataFrame, identifier: str = "id") -> DataFrame:
    """Each document as one JSON text."""
    return docs.select(identifier, F.to_json(F.struct("*")).alias("message"))


def write_documents(docs: DataFrame, path: str, mode: str = "append") -> None:
    to_messages(docs).select(F.col("message").alias("value")).write.mode(mode).text(path)


def catalogue(classes: DataFrame) -> DataFrame:
    """Nested library catalogue from (library, class) rows: one row per library, all classes in it."""
    keys = ["libraryId", "name", "domainName", "storageAdmin"]
    pairs = classes.select(
        "libraryId", F.col("library_name").alias("name"), "domainName", "storageAdmin",
        "class_name", "class_id",
        F.struct(F.col("class_name").alias("name"), F.col("class_id").alias("value")).alias("_item"),
    ).distinct()
    nested = gathered(pairs, keys, ["class_name", "class_id"], "_item", "_items", lambda items: items)
    return nested.select(*keys, F.struct(F.flatten("_items").alias("items")).alias("documentTypes"))


def write_catalogue(classes: DataFrame, path: str, mode: str = "overwrite") -> None:
    catalogue(classes).write.mode(mode).json(path)
