"""API plan: landed documents past the library mark to flat attachment documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import DEFAULT_VIEW_URL
from ..operators.documents import api_documents, attach_comments, attachment_rows, flat_metas
from ..operators.incremental import recent


def recent_documents(docs: DataFrame, marks: DataFrame, **names: str) -> DataFrame:
    """Typed documents changed at or after the mark of their library."""
    return recent(api_documents(docs, **names), marks, "library_id", "modification_ms").drop("hwm")


def of_classes(docs: DataFrame, classes: DataFrame, class_column: str = "class_id") -> DataFrame:
    """Documents of the listed (library, class) pairs."""
    wanted = classes.select(F.col("libraryId").alias("library_id"), F.col("class_id").alias(class_column))
    return docs.join(wanted, ["library_id", class_column], "left_semi")


def plan_api(
    docs: DataFrame, marks: DataFrame, comments: DataFrame | None = None,
    storage_account: str | None = None, source_prefix: str = "API_",
    link_template: str = DEFAULT_VIEW_URL, **names: str,
) -> DataFrame:
    """One document per attachment with all ``metas_*`` values.

    With ``comments`` (documents.comments_joined) the rows carry the whole comment text.
    """
    typed = recent_documents(docs, marks, link_template=link_template, **names)
    if comments is None:
        return attachment_rows(flat_metas(typed, storage_account), source_prefix)
    return attachment_rows(flat_metas(attach_comments(typed, comments), storage_account, comments="comments"), source_prefix)


def next_marks(docs: DataFrame, started_ms: int, library: str = "library_id") -> DataFrame:
    """The query start time, once per library after all its classes were read."""
    return docs.select(F.col(library).alias("source")).distinct().withColumn(
        "hwm", F.lit(started_ms).cast("bigint")
    )
