"""Attempts at messages as keyed state: a message is retried until its limit, then it is a dead letter.

Each row of the stream is one attempt at a message, in the order of ``seq``, and says
whether it went well. The state of a message is how often it failed and whether it is
settled; a success settles it as ``done``, the last failure that its limit allows as
``dead``, every earlier failure is a ``retry``, which the caller hands out again. Attempts at
a settled message give nothing. State, progress and written files belong to one
checkpoint, so a batch that is run again changes nothing.

Rows without a message id are left out; a null ``ok`` is a failure. Order holds within a
batch; batches come in the order of the source.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from .folder_state import STATE_STORE

# Workers get this module's code with the query, so they need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DONE, RETRY, DEAD = "done", "retry", "dead"
#: Fixed value: how often a message is tried.
ATTEMPTS = 5
OUTCOMES = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("attempt", T.LongType()),
    T.StructField("outcome", T.StringType()), T.StructField("value", T.StringType())])
_STATE = T.StructType([T.StructField("failures", T.LongType()), T.StructField("settled", T.BooleanType())])


class AttemptProcessor(StatefulProcessor):
    def __init__(self, limit: int) -> None:
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("attempts", _STATE)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        failures, settled = self.state.get() or (0, False)
        if settled:
            return
        for row in sorted(rows, key=lambda r: (r["seq"] is None, r["seq"])):
            settled = bool(row["ok"])
            failures += not settled
            outcome = DONE if settled else DEAD if failures >= self.limit else RETRY
            yield Row(id=key[0], seq=row["seq"], attempt=failures + settled, outcome=outcome, value=row["value"])
            settled = outcome != RETRY
            if settled:
                break
        self.state.update((failures, settled))

    def close(self) -> None:
        pass


def stream_attempts(
    attempts: DataFrame, out: str, checkpoint: str, limit: int = ATTEMPTS, interval: str | None = None,
) -> StreamingQuery:
    """Write the outcomes of ``(id, seq, ok, value)`` rows below ``out``, a folder per outcome."""
    attempts.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    rows = attempts.where(F.col("id").isNotNull()).select(
        F.col("id").cast("string").alias("id"), F.col("seq").cast("bigint").alias("seq"), "ok", F.col("value").cast("string").alias("value"))
    outcomes = rows.groupBy("id").transformWithState(
        statefulProcessor=AttemptProcessor(limit), outputStructType=OUTCOMES, outputMode="Append", timeMode="None")
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        outcomes.writeStream.format("parquet").outputMode("append").partitionBy("outcome").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
