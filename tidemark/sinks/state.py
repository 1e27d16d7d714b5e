"""State kept between runs: high-water marks and versioned tables with a change log."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.common import col
from ..model import MARK
from ..session import discard

BUCKET = "tidemark_bucket"
#: Tasks that write one bucket.
SPLITS = 4
#: The stream of batches that are written without one.
DIRECT = "direct"


def stream_key(checkpoint: str) -> str:
    """The name under which a stream with this checkpoint writes its batches."""
    return "s" + hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    try:
        return spark.read.schema(schema).options(**options).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class Conflict(RuntimeError):
    """Other writers were first every time."""


@dataclass(frozen=True)
class Version:
    """Folders of the buckets' rows and kept changes, and the last batch of each stream in them."""

    number: int
    rows: dict[str, str]
    kept: dict[str, str]
    covered: dict[str, int]


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    folder, files = _file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def read_text(spark: SparkSession, path: str) -> str:
    file, files = _file_system(spark, path)
    stream = files.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Whether this call made the file; a file that is there already stays as it is.

    The whole text is written beside it and then renamed, so nobody sees a part of
    it; of two writers one wins where the file system's rename is atomic.
    """
    jvm = spark._jvm
    target, files = _file_system(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_draft-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration()).rename(
            draft, target, options)
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def next_number(spark: SparkSession, folder: str) -> int:
    """A number that no other call on this folder gets, above all given before."""
    number = max((int(n) for n in list_names(spark, folder) if n.isdigit()), default=0) + 1
    while not create_if_absent(spark, f"{folder}/{number:020d}", ""):
        number += 1
    return number


class MarkStore:
    """Marks per source; saving appends, the newest run wins, a missing source reads as 0.

    Runs are numbered in the order in which their marks are saved, whatever the clocks of their drivers.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def save(self, marks: DataFrame, run_id: int | None = None) -> None:
        """Append (source, hwm) rows; call this last, after the data of the run is written."""
        run = next_number(self.spark, f"{self.path}.runs") if run_id is None else run_id
        marks.select("source", F.col("hwm").cast("bigint").alias("hwm"), F.lit(run).cast("bigint").alias("run_id")) \
            .repartition(1).write.mode("append").parquet(self.path)

    def save_one(self, source: str, hwm: int, run_id: int | None = None) -> None:
        row = self.spark.range(1).select(F.lit(source).alias("source"), F.lit(hwm).alias("hwm"))
        self.save(row, run_id)

    def read(self) -> DataFrame:
        rows = _read_or_empty(self.spark, self.path, MARK)
        return rows.groupBy("source").agg(F.max_by("hwm", "run_id").alias("hwm"))

    def get(self, source: str) -> int:
        row = self.read().where(F.col("source") == source).first()
        return row.hwm if row else 0


def marks_from_lines(lines: DataFrame) -> DataFrame:
    """``source:millis`` text lines as marks; a line without a colon is ignored."""
    at = F.instr("value", ":")
    return lines.where(at > 1).select(
        F.substring_index("value", ":", 1).alias("source"),
        F.substr("value", at + 1).try_cast("bigint").alias("hwm"),
    )


class VersionedTable:
    """A base snapshot in hash buckets and the change batches written after it, from any number of streams.

    A batch costs only its own rows: it is written to a folder named by its stream
    and its number there, so writing it again replaces the same folder and a replay
    changes nothing, and no stream can replace or hide another one's batches.

    A version names a folder for each bucket of ``key`` (base rows, and the changes that
    still matter beside them) and the last batch of each stream that it covers. It is
    one small file, created only if no other writer has created the same version
    before; who comes second reads the new version and does its work again.
    ``rewrite`` looks at the buckets alone that later batches touch; the other buckets
    keep their files. No path that is being read is ever overwritten.
    """

    def __init__(
        self, spark: SparkSession, root: str, base_schema: T.StructType, change_schema: T.StructType,
        key: str, buckets: int = 8,
    ) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.base_schema, self.change_schema = base_schema, change_schema
        self.key, self.buckets = key, buckets

    # ------------------------------------------------------------- versions

    def _current(self) -> Version:
        names = [n for n in list_names(self.spark, f"{self.root}/versions") if n.endswith(".json")]
        if not names:
            return Version(0, {}, {}, {})
        made = json.loads(read_text(self.spark, f"{self.root}/versions/{max(names)}"))
        return Version(made["version"], made["rows"], made["kept"], made["covered"])

    def _commit(self, version: Version) -> bool:
        path = f"{self.root}/versions/{version.number:020d}.json"
        return create_if_absent(self.spark, path, json.dumps(
            {"version": version.number, "rows": version.rows, "kept": version.kept, "covered": version.covered}))

    def bucket_of(self, key: Column | str) -> Column:
        return F.pmod(F.xxhash64(col(key)), F.lit(self.buckets)).cast("int")

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets of the keys of ``keys``; a number each, so there are no more than buckets."""
        return sorted(r[0] for r in keys.select(self.bucket_of(self.key)).distinct().collect())

    def _logged(self, covered: dict[str, int]) -> DataFrame:
        schema = T.StructType([
            *self.change_schema.fields, T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType())
        ])
        later = _read_or_empty(self.spark, f"{self.root}/changes", schema)
        for stream, last in covered.items():
            later = later.where((F.col("stream") != stream) | (F.col("batch_id") > last))
        return later

    def _stored(self, paths: dict[str, str], schema: T.StructType, buckets: Iterable[int] | None) -> DataFrame:
        wanted = set(paths) if buckets is None else {str(b) for b in buckets} & set(paths)
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[paths[b] for b in sorted(wanted, key=int)])

    # ------------------------------------------------------------- reading

    def snapshot(
        self, without: tuple[str, int] | None = None, buckets: Iterable[int] | None = None,
    ) -> tuple[DataFrame, DataFrame]:
        """The base, and the changes kept with it or written later, of one version.

        ``without`` leaves out one batch (stream, number); ``buckets`` reads the stored files of these alone.
        """
        now = self._current()
        later = self._logged(now.covered)
        if without is not None:
            stream, batch_id = without
            later = later.where((F.col("stream") != stream) | (F.col("batch_id") != batch_id))
        kept = self._stored(now.kept, self.change_schema, buckets)
        return self._stored(now.rows, self.base_schema, buckets), kept.unionByName(later.select(*self.change_schema.names))

    def changes(self) -> DataFrame:
        return self.snapshot()[1]

    def covers(self, stream: str, batch_id: int) -> bool:
        """Whether the base already holds this batch."""
        return batch_id <= self._current().covered.get(stream, -1)

    def turn(self) -> int:
        """A number above all that were given before."""
        return next_number(self.spark, f"{self.root}/turns")

    # ------------------------------------------------------------- writing

    def write_batch(self, rows: DataFrame, batch_id: int, stream: str = DIRECT) -> None:
        rows.select(*self.change_schema.names).write.mode("overwrite").parquet(
            f"{self.root}/changes/stream={stream}/batch_id={batch_id}"
        )

    def _write(self, df: DataFrame, names: list[str], path: str) -> dict[str, str]:
        """Rows by bucket below ``path``; the folder of each bucket that has any."""
        parts = F.pmod(F.xxhash64(*names), F.lit(SPLITS))  # a key that owns many rows is written by several tasks
        bucketed = df.select(*names).withColumn(BUCKET, self.bucket_of(self.key))
        bucketed.repartition(F.col(BUCKET), parts).write.partitionBy(BUCKET).parquet(path)
        found = [n for n in list_names(self.spark, path) if n.startswith(f"{BUCKET}=")]
        return {n.split("=")[1]: f"{path}/{n}" for n in found}

    def rewrite(
        self, build: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]], retries: int = 8,
    ) -> list[int]:
        """Store what ``build`` makes of base and changes, bucket by touched bucket; the touched buckets.

        ``build`` takes the base and the changes of the touched buckets and gives the
        new base and the changes to keep. Batches that arrive meanwhile stay in the log.
        """
        for _ in range(retries):
            now = self._current()
            later = self._logged(now.covered)
            last = {r.stream: r.last for r in later.groupBy("stream").agg(F.max("batch_id").alias("last")).collect()}
            if not last:
                return []
            seen = F.lit(False)
            for stream, batch_id in last.items():
                seen = seen | ((F.col("stream") == stream) & (F.col("batch_id") <= batch_id))
            later = later.where(seen).select(*self.change_schema.names)
            touched = self.touched(later)
            kept = self._stored(now.kept, self.change_schema, touched)
            rows, keep = build(self._stored(now.rows, self.base_schema, touched), kept.unionByName(later))
            if self._store(now, rows, keep, touched, {**now.covered, **last}):
                return touched
        raise Conflict(f"{retries} other versions of {self.root} came first")

    def _store(self, now: Version, rows: DataFrame, kept: DataFrame | None, touched: list[int], covered: dict[str, int]) -> bool:
        path = f"{self.root}/base/{now.number + 1:08d}-{uuid.uuid4().hex}"
        old = {str(b) for b in touched}
        new_rows = self._write(rows, self.base_schema.names, f"{path}/rows")
        new_kept = self._write(kept, self.change_schema.names, f"{path}/kept") if kept is not None else {}
        version = Version(
            now.number + 1, {b: p for b, p in now.rows.items() if b not in old} | new_rows,
            {b: p for b, p in now.kept.items() if b not in old} | new_kept, covered)
        if self._commit(version):
            return True
        discard(self.spark, path)
        return False

    def write_base(self, rows: DataFrame, retries: int = 8) -> None:
        """Store a new base in place of all that is stored and logged."""
        for _ in range(retries):
            now = self._current()
            covered = dict(now.covered)
            for r in self._logged(covered).groupBy("stream").agg(F.max("batch_id").alias("last")).collect():
                covered[r.stream] = r.last
            if self._store(now, rows, None, list(range(self.buckets)), covered):
                return
        raise Conflict(f"{retries} other versions of {self.root} came first")

    def vacuum(self) -> None:
        """Remove bases and batches that the newest version replaces; run it while nobody reads or writes older ones."""
        now = self._current()
        used = {p[len(self.root) + 6:].split("/")[0] for p in [*now.rows.values(), *now.kept.values()]}
        for name in list_names(self.spark, f"{self.root}/base"):
            if name not in used:
                discard(self.spark, f"{self.root}/base/{name}")
        for stream in list_names(self.spark, f"{self.root}/changes"):
            for batch in list_names(self.spark, f"{self.root}/changes/{stream}"):
                last = now.covered.get(stream.removeprefix("stream="), -1)
                if batch.startswith("batch_id=") and int(batch.split("=")[1]) <= last:
                    discard(self.spark, f"{self.root}/changes/{stream}/{batch}")
