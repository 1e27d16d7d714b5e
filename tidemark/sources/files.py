"""File listings and file bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import crate_path, file_name, parent_folder
from ..operators.filters import BODY_CAP


def list_files(
    spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True
) -> DataFrame:
    """Inventory rows of the files under a folder; contents are not read.

    Spark lists the tree from the driver, gives no folder rows and fails on a folder
    it may not read. For billions of files, empty folders or folders that cannot be
    read, let the crawl take a listing table (path, parent, name, is_dir,
    last_modified_ms, size and, if known, readable) that its own jobs wrote.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    found = reader.load(path).select("path", "modificationTime", "length")
    return found.select(crate_path(F.regexp_replace("path", r"\Afile:/+", "/")).alias("path"),
                        F.unix_millis("modificationTime").alias("last_modified_ms"),
                        F.col("length").alias("size")).select(
        "path", parent_folder("path").alias("parent"), file_name("path").alias("name"),
        F.lit(False).alias("is_dir"), "last_modified_ms", "size",
    )


def read_bodies(spark: SparkSession, path: str, cap: int = BODY_CAP, glob: str | None = None) -> DataFrame:
    """(path, length, content) of every file; beyond the cap the content is null.

    The length test is pushed to the scan, so content beyond the cap is never read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    found = reader.load(path)
    within = found.where(F.col("length") <= cap).select("path", "length", "content")
    beyond = found.where(F.col("length") > cap).select("path", "length", F.lit(None).cast("binary").alias("content"))
    return within.unionByName(beyond).withColumn("path", crate_path(F.regexp_replace("path", r"\Afile:/+", "/")))
