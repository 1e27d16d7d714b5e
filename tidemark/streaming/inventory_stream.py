"""Folder listings arriving as a stream, compared with the stored inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.paths import parent_folder
from ..model import INVENTORY
from ..operators import inventory as inv
from ..operators.filters import PathRules
from ..sinks.state import DIRECT, VersionedTable, stream_key

_CHANGES = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("parent", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("last_modified_ms", T.LongType()),
    T.StructField("size", T.LongType()),
    T.StructField("listing", T.StringType()),
    T.StructField("entries", T.LongType()),
    T.StructField("seq", T.LongType()),
])
#: Besides file changes the log says what a folder's listing has shown, how long it is, and that it was settled.
SEEN, END, DONE = "seen", "end", "done"
_FOLDER = ["parent", "listing"]


class InventoryTable:
    """Stored files as a base snapshot and a log of change batches.

    A folder's listing may be cut over any number of batches and arrive in any
    order. Its rows carry the listing's id, and its folder row (``is_dir``) the number
    of files in ``entries``. New and changed files are logged at once; files are
    deleted only when all entries of one listing have been seen, and then only
    those that no open listing of the folder has shown. A folder row without
    ``entries``, as of a folder that cannot be read, settles nothing.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.table = VersionedTable(spark, root, INVENTORY, _CHANGES, "parent")

    def start_from(self, rows: DataFrame) -> None:
        self.table.write_base(rows)

    def read(self) -> DataFrame:
        return _files(*self.table.snapshot())

    def compact(self) -> None:
        """Store the files as the next base, and what open listings have shown beside it."""
        def fold(base: DataFrame, log: DataFrame) -> tuple[DataFrame, DataFrame]:
            done = log.where(F.col("status") == DONE).select(*_FOLDER).distinct()
            return _files(base, log), log.where(F.col("status").isin(SEEN, END)).join(done, _FOLDER, "left_anti")

        self.table.rewrite(fold)

    def apply_listing(self, listing: DataFrame, batch_id: int, rules: PathRules, stream: str = DIRECT) -> None:
        """Compare the listed files with the stored ones, settle complete folders, log the changes.

        Only folders of the batch are looked at: of the base the files of their buckets
        are read, and base and log are reduced to them before anything is folded.
        """
        if self.table.covers(stream, batch_id):
            return
        seq = self.table.turn()
        for name, kind in (("listing", "string"), ("entries", "bigint")):
            if name not in listing.columns:
                listing = listing.withColumn(name, F.lit(None).cast(kind))
        listing = listing.withColumn("listing", F.coalesce("listing", F.lit("")))
        files = listing.where(~F.col("is_dir"))
        seen = files.select("path", "parent", "listing").distinct()
        ends = listing.where(F.col("is_dir") & F.col("entries").isNotNull()).select(
            "path", F.col("path").alias("parent"), "listing", "entries")
        touched = files.select("parent").unionByName(ends.select("parent")).distinct()
        base, log = self.table.snapshot((stream, batch_id), self.table.touched(touched))
        log = log.join(touched, "parent", "left_semi")
        stored = _files(base.join(touched, "parent", "left_semi"), log)

        changed = inv.diff(stored.join(seen.select("path"), "path", "left_semi"), files, rules).where(
            F.col("status").isin(inv.INSERT, inv.UPDATE, inv.DELETE)
        ).withColumn("parent", parent_folder("path"))

        settled = log.where(F.col("status") == DONE).select(*_FOLDER).distinct()
        shown = log.where(F.col("status") == SEEN).select("path", *_FOLDER).unionByName(seen.select("path", *_FOLDER))
        shown = shown.join(settled, _FOLDER, "left_anti").distinct()
        sizes = log.where(F.col("status") == END).select(*_FOLDER, "entries").unionByName(ends.select(*_FOLDER, "entries"))
        complete = (
            sizes.join(settled, _FOLDER, "left_anti").groupBy(*_FOLDER).agg(F.max("entries").alias("entries"))
            .join(shown.groupBy(*_FOLDER).agg(F.count("path").alias("n")), _FOLDER, "left")
            .where(F.coalesce("n", F.lit(0)) >= F.col("entries")).select(*_FOLDER)
        )
        gone = (
            stored.join(complete.select("parent").distinct(), "parent", "left_semi")
            .join(shown.select("path"), "path", "left_anti")
            .select("path", "parent", "last_modified_ms", "size").withColumn("status", F.lit(inv.DELETE))
        )
        rows = (
            changed.unionByName(gone, allowMissingColumns=True)
            .unionByName(seen.withColumn("status", F.lit(SEEN)), allowMissingColumns=True)
            .unionByName(ends.withColumn("status", F.lit(END)), allowMissingColumns=True)
            .unionByName(complete.withColumn("status", F.lit(DONE)), allowMissingColumns=True)
        )
        self.table.write_batch(rows.withColumn("seq", F.lit(seq).cast("bigint")), batch_id, stream)


def _files(base: DataFrame, log: DataFrame) -> DataFrame:
    """The stored files: each path's last change in the order of the batches, over the base."""
    changes = log.where(F.col("status").isin(inv.INSERT, inv.UPDATE, inv.DELETE))
    last = changes.groupBy("path").agg(
        F.max_by(F.struct("status", "last_modified_ms", "size"), "seq").alias("_c")
    ).select("path", "_c.*")
    return inv.as_inventory(inv.apply_changes(base, last))


def stream_listings(
    source: DataFrame, table: InventoryTable, checkpoint: str, rules: PathRules | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    chosen, stream = rules or PathRules(), stream_key(checkpoint)
    return (
        source.writeStream
        .foreachBatch(lambda batch, batch_id: table.apply_listing(batch, batch_id, chosen, stream))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
