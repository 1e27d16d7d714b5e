"""Landed responses of a paged document API."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import model


def read_document_pages(
    spark: SparkSession, path: str, folder: T.StructType | None = None
) -> DataFrame:
    """One row (doc) per document of the landed pages."""
    pages = spark.read.schema(model.api_page_schema(folder)).json(path)
    return documents_of(pages)


def documents_of(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode("documentList").alias("doc"))


def parse_documents(texts: DataFrame, text: str | Column, folder: T.StructType | None = None) -> DataFrame:
    """Documents held as JSON text; unreadable text gives a null ``doc``.

    The one-element explode keeps the parsed value: filters on its fields are not
    moved below it, where Spark would parse the text again for every field.
    """
    parsed = F.from_json(text, model.api_document_schema(folder))
    return texts.select("*", F.explode(F.array(parsed)).alias("doc"))


def read_comment_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(model.COMMENT_PAGE).json(path)


def read_library_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(model.LIBRARY_PAGE).json(path)


def read_class_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(model.CLASS_PAGE).json(path)
