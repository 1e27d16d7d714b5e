"""Table plan: rows past the mark to documents, then the next mark."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.documents import row_documents
from ..operators.incremental import DEFAULT_BATCH, batch_cut, between_marks, next_mark, past_mark
from ..sinks.output import write_documents
from ..sinks.state import MarkStore


@dataclass(frozen=True)
class TableSource:
    service: str
    mark_column: str
    keys: Sequence[str]
    columns: Sequence[str] | None = None
    where: str | None = None
    path_column: str | None = None
    batch: object = DEFAULT_BATCH


def read_batch(table: DataFrame, source: TableSource, mark: int, cut: object) -> DataFrame:
    """The rows past the mark up to ``cut``."""
    columns = list(source.columns) if source.columns else table.columns
    needed = list(dict.fromkeys([*columns, source.mark_column, *source.keys]))
    return between_marks(table, source.mark_column, mark, cut, needed, source.where)


def batch_documents(batch: DataFrame, source: TableSource) -> DataFrame:
    columns = list(source.columns) if source.columns else batch.columns
    wanted = batch.select(*dict.fromkeys([*columns, *source.keys]))
    return row_documents(wanted, source.keys, source.service, source.path_column)


def run_once(table: DataFrame, source: TableSource, marks: MarkStore, out: str) -> tuple[int, int]:
    """One batch: write the documents, then save the mark. Returns (rows, mark).

    The cut is fixed first, by a job over the mark column alone; the batch is then
    read once, between two literal marks, and counted while it is written. The mark
    saved is the cut, and it is written last; a run that stops before leaves the old
    one and simply reads the same rows again.
    """
    mark = marks.get(source.service)
    cut = batch_cut(table, source.mark_column, mark, source.batch, source.where)
    if cut is None:
        return 0, mark
    # The batch is a range of marks, so its output folder is named by the range
    # and a repeated run replaces it.
    seen = Observation()
    batch = read_batch(table, source, mark, cut).observe(seen, F.count(F.lit(1)).alias("rows"))
    write_documents(batch_documents(batch, source), f"{out}/{source.service}/{mark}-{int(cut)}", "overwrite")
    marks.save_one(source.service, int(cut))
    return seen.get["rows"], int(cut)


def run_backlog(table: DataFrame, source: TableSource, marks: MarkStore, out: str) -> tuple[int, int]:
    """Everything past the mark in one job, for a first load or a large backlog.

    The upper end is fixed first, so rows that arrive meanwhile wait for the next
    run. The same rows as ``drain`` reads, without a job per batch.
    """
    mark = marks.get(source.service)
    rows = past_mark(table, source.mark_column, mark, where=source.where)
    end = next_mark(rows, source.mark_column, mark).first()
    if end.rows:
        batch = rows.where(F.col(source.mark_column) <= end.hwm)
        columns = list(source.columns) if source.columns else table.columns
        wanted = batch.select(*dict.fromkeys([*columns, *source.keys]))
        made = row_documents(wanted, source.keys, source.service, source.path_column)
        write_documents(made, f"{out}/{source.service}/{mark}-{end.hwm}", "overwrite")
        marks.save_one(source.service, end.hwm)
    return end.rows, end.hwm


def drain(
    table: DataFrame, source: TableSource, marks: MarkStore, out: str, max_batches: int | None = None
) -> int:
    """Repeat ``run_once`` until an empty batch; each batch is one distributed job."""
    done = 0
    while max_batches is None or done < max_batches:
        rows, _ = run_once(table, source, marks, out)
        if rows == 0:
            break
        done += 1
    return done
