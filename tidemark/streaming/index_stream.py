"""Actions applied to an index table as a restartable stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.index import UPDATE, action_kind, apply_actions, still_relevant
from ..sinks.state import DIRECT, VersionedTable, stream_key


class IndexTable:
    """An index kept as a base snapshot and a log of action batches.

    A micro-batch only appends its actions, under its stream and batch number, so a
    replayed batch changes nothing and the cost follows the batch and not the index.
    Reading folds all actions by (time, sequence). A compacted base holds the rows
    that no action orders, and the actions that can still matter, tombstones
    included, so the result is the same however the rows were cut into batches and
    streams, and wherever a compaction fell between them.
    """

    def __init__(
        self, spark: SparkSession, root: str, content: T.StructType, order: Sequence[str],
        action_schema: T.StructType, identifier: str = "id", modified: str = "modified",
        buckets: int = 8,
    ) -> None:
        self.identifier, self.modified, self.order = identifier, modified, list(order)
        self.content = content.names
        base = T.StructType([
            action_schema[identifier],
            T.StructField("last_modified", action_schema[modified].dataType),
            *content.fields,
        ])
        self.table = VersionedTable(spark, root, base, action_schema, identifier, buckets)

    def start_from(self, rows: DataFrame) -> None:
        self.table.write_base(rows)

    def write(self, actions: DataFrame, batch_id: int, stream: str = DIRECT) -> None:
        self.table.write_batch(actions, batch_id, stream)

    def read(self) -> DataFrame:
        base, changes = self.table.snapshot()
        return apply_actions(
            base, changes, self.identifier, "action", self.modified, self.order, self.content
        )

    def compact(self) -> list[int]:
        """Fold the batches into the base; the buckets whose ids they touch are written anew, and returned.

        Batches and compactions of other writers may come at the same time.
        """
        def fold(base: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
            kept = still_relevant(changes, self.identifier, "action", self.order)
            replaced = kept.where(action_kind("action") != UPDATE).select(self.identifier).distinct()
            return base.join(replaced, self.identifier, "left_anti"), kept

        return self.table.rewrite(fold)


def stream_actions(
    source: DataFrame, to_actions: Callable[[DataFrame], DataFrame], index: IndexTable,
    checkpoint: str, interval: str | None = None,
) -> StreamingQuery:
    """Start the stream: every available row once, or on an interval when one is given."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    stream = stream_key(checkpoint)
    return (
        to_actions(source).writeStream
        .foreachBatch(lambda batch, batch_id: index.write(batch, batch_id, stream))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
