"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.common import col
from ..session import configure

ROOT = str(Path(__file__).resolve().parents[2])

#: Lower-cases A-Z and turns every other ASCII character but digits and letters into a blank.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings for whole texts in Python tasks.

    Small Arrow batches bound a task's memory where texts are long, and the
    workers find this package where the driver found it.
    """
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))
    return spark


def fold(doc_id: Column | str) -> Column:
    """Fold 0, 1 or 2 of a document; fold 1 is held out of all training."""
    return F.crc32(col(doc_id).cast("string")) % 3


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def packed(df: DataFrame, used: dict[str, str], without: Iterable[str] = ()) -> DataFrame:
    """``df`` as the columns ``used`` (new name to old one) and all columns in one struct ``_row``.

    No column's name can then clash with those an operator makes on its way;
    ``select("_row.*", …)`` unpacks them. Columns named in ``without`` are left out.
    """
    left_out = {n.lower() for n in without}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in left_out]
    row = F.struct(*kept) if kept else F.struct(F.lit(None).alias("_none"))
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in used.items()], row.alias("_row"))


def spread(column: str, salt: str) -> Column:
    """A number in [0, 1) that depends on the column and salt alone; for stated, repeatable samples."""
    return F.pmod(F.xxhash64(F.col(column).cast("string"), F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)


def schema_with(df: DataFrame, *fields: T.StructField) -> T.StructType:
    """The schema of ``df`` with fields replaced or added."""
    new = {f.name.lower() for f in fields}
    return T.StructType([f for f in df.schema.fields if f.name.lower() not in new] + list(fields))


def with_arrays(batch: pa.RecordBatch, columns: Iterable[tuple[str, pa.Array]]) -> pa.RecordBatch:
    """The batch with columns replaced or added at the end, as ``schema_with`` orders them."""
    columns = list(columns)
    new = {n.lower() for n, _ in columns}
    keep = [n for n in batch.schema.names if n.lower() not in new]
    return pa.RecordBatch.from_arrays(
        [batch.column(batch.schema.get_field_index(n)) for n in keep] + [a for _, a in columns],
        names=keep + [n for n, _ in columns],
    )
