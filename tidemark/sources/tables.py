"""Tables read incrementally."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession, location: str | None = None, kind: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table in any Spark format, ``jdbc`` included.

    For JDBC pass url, dbtable, driver and, for a parallel read, partitionColumn,
    lowerBound, upperBound and numPartitions. Column lists and filters against
    literals, such as both marks of a batch, are sent to the database; a limit and
    the cut's top-N run in Spark over the mark column. Not run against a database
    here. The options may hold a password and are never logged.
    """
    reader = spark.read.format(kind).options(**dict(options or {}))
    return reader.load(location) if location else reader.load()
