"""Reads past a high-water mark: batches, marks, pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import rows_before

DEFAULT_BATCH = 1000
PAGE_SIZE = 25
#: Rows that one task may sort for a cut, and quantiles drawn from a range in one round.
TOP, GRID = 10_000, 200


def batch_size(value: object) -> int:
    """A usable batch size; anything unreadable or below one is the default."""
    try:
        size = int(str(value))
    except ValueError:
        return DEFAULT_BATCH
    return size if size >= 1 else DEFAULT_BATCH


def past_mark(
    df: DataFrame, mark_column: str, mark: int,
    columns: Sequence[str] | None = None, where: str | Column | None = None,
) -> DataFrame:
    """Configured columns and extra predicate, rows strictly past the mark (when it is positive)."""
    if where is not None:
        df = df.where(where)
    if mark > 0:
        df = df.where(F.col(mark_column) > mark)
    return df.select(*columns) if columns else df


def next_batch(
    df: DataFrame, mark_column: str, mark: int, size: object = DEFAULT_BATCH,
    columns: Sequence[str] | None = None, where: str | Column | None = None,
) -> DataFrame:
    """The first ``size`` rows past the mark, extended through ties on the mark column.

    Cutting between equal marks would lose the rest of them under the strict
    comparison of the next read. The cut-off is a top-N over one column, inside
    the batch's own plan; beyond ``TOP`` rows it is worked out by ``batch_cut`` first.
    """
    rows = past_mark(df, mark_column, mark, where=where).where(F.col(mark_column).isNotNull())
    if batch_size(size) > TOP:
        batch = rows.where(F.col(mark_column) <= F.lit(batch_cut(df, mark_column, mark, size, where)))
    else:
        batch = rows.where(F.col(mark_column) <= _top(rows, mark_column, batch_size(size)).scalar())
    return batch.select(*columns) if columns else batch


def _top(rows: DataFrame, mark_column: str, n: int) -> DataFrame:
    return rows.select(mark_column).orderBy(mark_column).limit(n).agg(F.max(mark_column).alias("cut"))


def _nth(rows: DataFrame, mark_column: str, n: int) -> object:
    """The n-th smallest mark, or the largest of fewer: a range that holds it, cut down by sketches.

    A round draws quantiles of the range by a mergeable sketch, counts exactly up to
    the two around the rank, and goes on between them; the range loses most of its rows each
    time. Only a range of ``TOP`` rows or fewer is sorted. Marks are whole numbers, as the
    columns of ``MarkStore`` are.
    """
    mark = F.col(mark_column)
    places = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    while True:
        count, least, most = rows.agg(F.count(mark), F.min(mark), F.max(mark)).first()
        if n >= count or least == most:
            return most
        if count <= TOP:
            return _top(rows, mark_column, n).first()["cut"]
        # The sketch works on doubles: distances from the least mark keep their digits as ranges get narrow.
        grid = rows.agg(F.percentile_approx((mark - F.lit(least)).cast("double"), places, 20 * GRID)).first()[0]
        at = int(n * GRID / count)
        low, high = (least + type(least)(grid[i]) for i in (max(0, at - 1), min(GRID, at + 2)))
        if low >= most:
            low, high = least + type(least)((most - least) / 2), most
        up_to_low, up_to_high = rows.agg(F.count_if(mark <= F.lit(low)), F.count_if(mark <= F.lit(high))).first()
        if up_to_low >= n:
            rows = rows.where(mark <= F.lit(low))
        elif up_to_high < n:
            rows, n = rows.where(mark > F.lit(high)), n - up_to_high
        else:
            rows, n = rows.where((mark > F.lit(low)) & (mark <= F.lit(high))), n - up_to_low


def batch_cut(
    df: DataFrame, mark_column: str, mark: int, size: object = DEFAULT_BATCH, where: str | Column | None = None
) -> object:
    """The largest mark of the next batch, None if there is no row: jobs over one column.

    Up to ``TOP`` rows this is one top-N; a larger batch, which may be a third of the
    table, is cut by sketches and exact counts.
    """
    rows = past_mark(df, mark_column, mark, where=where).where(F.col(mark_column).isNotNull())
    n = batch_size(size)
    return _top(rows, mark_column, n).first()["cut"] if n <= TOP else _nth(rows, mark_column, n)


def between_marks(
    df: DataFrame, mark_column: str, mark: int, cut: object,
    columns: Sequence[str] | None = None, where: str | Column | None = None,
) -> DataFrame:
    """Rows past the mark up to ``cut``; both bounds are literals and reach the scan.

    Rows that arrive later with a mark in the range belong to it too, so what is
    written and the mark that is saved always agree.
    """
    rows = past_mark(df, mark_column, mark, where=where).where(F.col(mark_column) <= F.lit(cut))
    return rows.select(*columns) if columns else rows


def next_mark(batch: DataFrame, mark_column: str, mark: int) -> DataFrame:
    """The largest mark of the batch; an empty batch keeps the old one."""
    newest = F.coalesce(F.max(mark_column).cast("bigint"), F.lit(mark).cast("bigint"))
    return batch.agg(newest.alias("hwm"), F.count(F.lit(1)).alias("rows"))


def plan_batches(
    df: DataFrame, mark_column: str, mark: int, size: object = DEFAULT_BATCH
) -> DataFrame:
    """Every batch of a full drain in one job: number, rows, first and last mark.

    Rows are counted per mark value first, so equal marks always share a batch;
    a batch then holds the marks whose preceding rows fall in the same multiple
    of the batch size.
    """
    n = batch_size(size)
    values = past_mark(df, mark_column, mark).where(F.col(mark_column).isNotNull())
    counted = values.groupBy(F.col(mark_column).alias("mark")).agg(F.count(F.lit(1)).alias("rows"))
    placed = rows_before(counted, [], ["mark"], "rows", "_before")
    batch = F.floor(F.col("_before") / n).cast("bigint")
    return placed.groupBy(batch.alias("batch")).agg(
        F.sum("rows").alias("rows"), F.min("mark").alias("first_mark"), F.max("mark").alias("last_mark")
    )


def with_marks(
    df: DataFrame, marks: DataFrame, source: str, name: str = "hwm"
) -> DataFrame:
    """Attach each source's mark; a source without one starts at 0."""
    known = marks.select(F.col("source").alias("_source"), F.col("hwm").alias("_hwm"))
    return (
        df.join(known, F.col(source) == F.col("_source"), "left")
        .withColumn(name, F.coalesce("_hwm", F.lit(0).cast("bigint")))
        .drop("_source", "_hwm")
    )


def recent(df: DataFrame, marks: DataFrame, source: str, modified: str) -> DataFrame:
    """Documents changed at or after their source's mark."""
    return with_marks(df, marks, source).where(F.col(modified) >= F.col("hwm"))


def page(
    df: DataFrame, modified: str, identifier: str, after: tuple[object, object] | None = None,
    size: int = PAGE_SIZE,
) -> DataFrame:
    """Newest-first page; ``after`` is the (modified, id) of the last row already seen."""
    if after is not None:
        at, last = (F.lit(v) for v in after)
        df = df.where(
            (F.col(modified) < at) | ((F.col(modified) == at) & (F.col(identifier) > last))
        )
    return df.orderBy(F.desc(modified), F.asc(identifier)).limit(size)


def count_per(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_docs"))


def usable_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with at least one non-null key part."""
    return df.where(F.coalesce(*[F.col(k).cast("string") for k in keys]).isNotNull())


def null_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    lost = F.coalesce(*[F.col(k).cast("string") for k in keys]).isNull()
    return df.agg(F.count_if(lost).alias("null_keys"), F.count(F.lit(1)).alias("rows"))
