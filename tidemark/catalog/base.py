"""Registry of named queries over the shared tables and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the same result in plain SQL."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_ms(column: str) -> Column:
    return F.unix_millis(F.col(column).cast("timestamp"))


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt over all cores: a small file is one task, however much is done with each of its rows."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)
