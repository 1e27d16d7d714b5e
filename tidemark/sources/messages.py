"""Task and document messages held as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import CRAWL_TASK


def parse_tasks(messages: DataFrame, text: str = "value") -> DataFrame:
    """Add the parsed task; ``ok`` is false for bad JSON or a missing key."""
    parsed = messages.withColumn("task", F.from_json(text, CRAWL_TASK, {"mode": "PERMISSIVE"}))
    ok = F.col("task.id").isNotNull() & F.col("task.level").isNotNull()
    return parsed.withColumn("ok", F.coalesce(ok, F.lit(False)))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where("ok").select("task.*")


def rejected(parsed: DataFrame, text: str = "value") -> DataFrame:
    return parsed.where("NOT ok").select(text)
