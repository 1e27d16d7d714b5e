"""Continuous task messages: accepted tasks and rejected texts to separate outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.messages import accepted, parse_tasks, rejected


def stream_tasks(
    messages: DataFrame, out: str, checkpoint: str, text: str = "value", interval: str | None = None
) -> StreamingQuery:
    """Write tasks to ``out/tasks`` and unreadable messages to ``out/rejects``.

    Both folders are keyed by batch id and replaced on a replay. A failing task is
    retried by Spark; when retries run out the query fails and restarts from its
    checkpoint.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_tasks(batch, text)
        accepted(parsed).write.mode("overwrite").parquet(f"{out}/tasks/batch_id={batch_id}")
        rejected(parsed, text).write.mode("overwrite").parquet(f"{out}/rejects/batch_id={batch_id}")

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
