"""Header-style index records: numbered ``name=value`` entries and a content flag."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import meta_entry, target_index, utc_minute
from ..functions.common import no_strings
from .filters import HEADER_BODY_CAP, has_indexable_content


def numbered_entries(fields: str | Column, has_content: Column) -> Column:
    """``name=value`` texts in (field, position) order, the content flag last.

    The position in the array plus one is the gap-free entry number, so numbering
    needs no window and no shuffle.
    """
    opened = F.flatten(F.transform(
        F.array_sort(F.map_entries(fields)),
        lambda e: F.transform(
            F.filter(e["value"], lambda v: v.isNotNull()), lambda v: meta_entry(e["key"], v)
        ),
    ))
    flag = F.concat(F.lit("indexedContent="), F.coalesce(has_content, F.lit(False)).cast("string"))
    return F.concat(F.coalesce(opened, no_strings()), F.array(flag))


def header_records(
    docs: DataFrame, configured_index: str | None = None, cap: int = HEADER_BODY_CAP
) -> DataFrame:
    """Insert or update messages; a document without any index name is an error row."""
    content = has_indexable_content(F.col("is_stub"), F.col("size"), cap)
    index = target_index("fields", configured_index)
    return docs.select(
        index.alias("index"),
        F.col("id").alias("filename"),
        F.lit("add").alias("request"),
        utc_minute("last_modified_ms").alias("last_modified"),
        numbered_entries("fields", content).alias("entries"),
        F.when(content, F.col("body")).alias("body"),
        F.when(index.isNull(), F.lit("no index specified")).alias("error"),
    )


def header_entries(records: DataFrame) -> DataFrame:
    """(filename, meta number, entry) rows of header records."""
    # Outer, so that Spark does not add a filter that builds the entries a second time;
    # there is always at least the content flag.
    return records.select(
        "index", "filename", F.posexplode_outer("entries").alias("_pos", "entry")
    ).select(
        "index", "filename", F.concat(F.lit("meta"), (F.col("_pos") + 1).cast("string")).alias("meta"),
        (F.col("_pos") + 1).cast("bigint").alias("n"), "entry",
    )


def header_deletes(docs: DataFrame, configured_index: str | None = None) -> DataFrame:
    index = target_index("fields", configured_index)
    return docs.select(
        index.alias("index"), F.col("id").alias("filename"), F.lit("delete").alias("request"),
        F.when(index.isNull(), F.lit("no index specified")).alias("error"),
    )


_CHANGES = T.StructType([
    T.StructField("index", T.StringType()), T.StructField("filename", T.StringType()),
    T.StructField("request", T.StringType()), T.StructField("last_modified", T.StringType()),
    T.StructField("entries", T.ArrayType(T.StringType())), T.StructField("body", T.StringType()),
    T.StructField("run", T.LongType()),
])


class HeaderTable:
    """Header records by (index, filename): each run adds its requests, the last one of a record counts."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def append(self, requests: DataFrame, run: int | None = None) -> None:
        """Add the requests that name an index; of several runs the larger number is later.

        A run under the same number replaces its own requests, so a repeated run changes nothing.
        """
        run = time.time_ns() if run is None else run
        good = requests.where(F.col("error").isNull())
        for name in ("last_modified", "entries", "body"):
            if name not in requests.columns:
                good = good.withColumn(name, F.lit(None).cast(_CHANGES[name].dataType))
        good.select(*[F.col(n).cast(_CHANGES[n].dataType) for n in _CHANGES.names if n != "run"]) \
            .write.mode("overwrite").parquet(f"{self.path}/run={run}")

    def read(self) -> DataFrame:
        """The records after all runs. A delete and an add of one run leave the record added."""
        try:
            rows = self.spark.read.schema(_CHANGES).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], _CHANGES)
        adds = F.col("request") == "add"
        # The winner is found from the narrow columns; the wide ones meet it in one join.
        order = F.struct("run", adds.alias("adds"))
        last = rows.groupBy("index", "filename").agg(F.max(order).alias("_last")).where("_last.adds").select(
            F.col("index").alias("_i"), F.col("filename").alias("_f"), F.col("_last.run").alias("_r"))
        same = (F.col("index") == F.col("_i")) & (F.col("filename") == F.col("_f")) & (F.col("run") == F.col("_r"))
        return rows.where(adds).join(last, same, "left_semi").drop("run", "request").dropDuplicates(["index", "filename"])


def write_headers(docs: DataFrame, settings: Mapping[str, str], run: int | None = None) -> DataFrame:
    """Add the records that have an index to the table; report the status of every document."""
    index = settings.get("index")
    HeaderTable(docs.sparkSession, settings["path"]).append(header_records(docs, index), run)
    known = target_index("fields", index).isNotNull()
    status = F.when(known, F.lit("success")).otherwise(F.lit("no index specified"))
    return docs.select("id", status.alias("status"), known.alias("success"))


def delete_headers(docs: DataFrame, settings: Mapping[str, str], run: int | None = None) -> None:
    """Take the documents' records out of the table."""
    HeaderTable(docs.sparkSession, settings["path"]).append(header_deletes(docs, settings.get("index")), run)
