"""Ordered processing stages over a document DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Processor = Callable[[DataFrame, Mapping[str, str]], DataFrame]
Terminator = Callable[[DataFrame, Mapping[str, str]], DataFrame]


@dataclass(frozen=True)
class Stage:
    """A named processor with its settings.

    ``handles_deletes`` false lets rows whose action is DELETE pass around it.
    A processor may return more rows than it got (child documents).
    """

    name: str
    run: Processor
    priority: int | None = None
    settings: Mapping[str, str] = field(default_factory=dict)
    handles_deletes: bool = False


CONFIG = T.StructType([T.StructField("stages", T.ArrayType(T.StructType([
    T.StructField("stage", T.StringType()), T.StructField("priority", T.IntegerType()),
    T.StructField("settings", T.MapType(T.StringType(), T.StringType()))])))])


def load_stages(spark: SparkSession, path: str, known: Mapping[str, Stage]) -> list[Stage]:
    """The stages that a JSON file lists: ``{"stages": [{"stage", "priority", "settings"}, …]}``.

    ``known`` has the processors by name; the file's settings go over the processor's
    own, a priority that the file lacks stays open. A stage may be listed twice.
    Unknown names, and files that are no such JSON, are refused.
    """
    rows = spark.read.schema(CONFIG).option("multiLine", True).option("mode", "FAILFAST").json(path).collect()
    listed = [entry for row in rows for entry in row["stages"] or []]
    unknown = sorted({str(e["stage"]) for e in listed} - set(known))
    if unknown:
        raise ValueError(f"no processor for {', '.join(unknown)}")
    return [
        replace(known[e["stage"]], priority=e["priority"], settings={**known[e["stage"]].settings, **(e["settings"] or {})})
        for e in listed
    ]


def ordered(stages: Sequence[Stage]) -> list[Stage]:
    """By priority, then list position; stages without a priority come last."""
    return sorted(stages, key=lambda s: (s.priority is None, s.priority or 0))


def run_stages(docs: DataFrame, stages: Sequence[Stage], action: str = "action") -> DataFrame:
    """Apply the stages in order.

    Neighbouring stages that do not handle deletes share one detour, so the rows
    are split once per run of such stages and not once per stage.
    """
    def apply(df: DataFrame, stage: Stage) -> DataFrame:
        return df.transform(stage.run, stage.settings)

    for aware, group in groupby(ordered(stages), key=lambda s: s.handles_deletes or action not in docs.columns):
        members = list(group)
        if aware:
            docs = reduce(apply, members, docs)
            continue
        is_delete = F.coalesce(F.upper(action) == "DELETE", F.lit(False))
        docs = reduce(apply, members, docs.where(~is_delete)).unionByName(
            docs.where(is_delete), allowMissingColumns=True
        )
    return docs


def terminate(docs: DataFrame, terminator: Terminator, settings: Mapping[str, str]) -> DataFrame:
    """Send the documents to their final sink; the result has (id, status, success) per document."""
    return terminator(docs, settings).select("id", "status", "success")
