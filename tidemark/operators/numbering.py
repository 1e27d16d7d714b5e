"""Exact row numbers that survive a key holding a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import checkpoint_root

_SLICE, _TIE = "_slice", "_tie"
#: Values gathered by one task at a time where a group's values are joined.
PIECE = 10_000


def rows_before(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str | None = None, name: str = "before",
) -> DataFrame:
    """Rows (or summed weights) that precede each row among the rows with the same keys.

    The rows are range-partitioned by keys and order, so a hot group is spread over
    many tasks; each slice adds up its own rows and then adds the totals of the
    slices before it. The slices are written by ``checkpoint()`` when this is called.
    """
    amount = F.col(weight) if weight else F.lit(1)
    earlier = (W.unboundedPreceding, -1)
    checkpoint_root(df.sparkSession)
    # The tie column lets full copies of one row be spread as well. The slices
    # are fixed by the checkpoint: a lost task must not re-draw their bounds.
    sliced = (
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(*keys, *order, _TIE)
        .withColumn(_SLICE, F.spark_partition_id())
        .checkpoint()
    )
    by_slice = W.partitionBy(*keys).orderBy(_SLICE).rowsBetween(*earlier)
    totals = sliced.groupBy(*keys, _SLICE).agg(F.sum(amount).alias("_total")).select(
        *keys, _SLICE, F.coalesce(F.sum("_total").over(by_slice), F.lit(0)).alias("_earlier")
    )
    same = [sliced[k].eqNullSafe(totals[k]) for k in [*keys, _SLICE]]
    within = W.partitionBy(*[sliced[k] for k in [*keys, _SLICE]]).orderBy(*order, _TIE).rowsBetween(*earlier)
    inside = F.coalesce(F.sum(amount).over(within), F.lit(0))
    return sliced.join(totals, same, "inner").select(
        *[sliced[c] for c in df.columns], (inside + F.col("_earlier")).cast("bigint").alias(name)
    )


def row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "n") -> DataFrame:
    """1-based number of each row among the rows with the same keys."""
    return rows_before(df, keys, order, None, name).withColumn(name, F.col(name) + 1)


def gathered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, of_piece: Callable[[Column], Column],
) -> DataFrame:
    """``(keys, n_values, name)``: pieces of each group's ordered values, as an array in order.

    ``of_piece`` turns an array of values into a piece, so only the values travel
    through the first shuffle and only pieces through the second. One row holds a
    whole group's pieces, because the caller's record does.
    """
    numbered = row_number(df.select(*dict.fromkeys([*keys, *order, value])), keys, order, "_n")
    values = F.transform(F.sort_array(F.collect_list(F.struct("_n", F.col(value).alias("v")))), lambda x: x["v"])
    pieces = (
        numbered.withColumn("_piece", F.floor((F.col("_n") - 1) / PIECE)).groupBy(*keys, "_piece")
        .agg(values.alias("_all"))
        .select(*keys, "_piece", F.size("_all").cast("bigint").alias("_size"), of_piece(F.col("_all")).alias("_made"))
    )
    ordered = F.sort_array(F.collect_list(F.struct("_piece", F.col("_made").alias("made"))))
    return pieces.groupBy(*keys).agg(
        F.sum("_size").alias("n_values"), F.transform(ordered, lambda x: x["made"]).alias(name)
    )


def joined_text(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, separator: str, name: str,
    render: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Ordered values of each group joined to one text; ``render`` turns a value into text."""
    text = render or (lambda v: v)
    made = gathered(df, keys, order, value, name, lambda all_: F.array_join(F.transform(all_, lambda v: text(v)), separator))
    return made.withColumn(name, F.array_join(name, separator))
