"""Stored files laid out so that a crawl finds them without a shuffle.

Files are written as a bucketed table: sorted buckets by path, below a folder for each
shard, a hash of the file's folder. A diff shuffles the listing to the stored buckets;
the stored side is neither shuffled nor read beyond the shards that a partial listing
touches. A version names the table of each shard; saving a partial crawl writes its shards
anew and leaves the others as they are. Versions are small files that only one writer can
create (``state.create_if_absent``).
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import col
from ..functions.paths import parent_folder
from ..operators import inventory as inv
from ..operators.filters import PathRules
from .state import Conflict, create_if_absent, list_names, read_text

_COLUMNS = "path string, last_modified_ms bigint, size bigint"


class BucketedInventory:
    """Path, time and size of the stored files; ``buckets`` and ``shards`` are fixed by the first save."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, shards: int = 8) -> None:
        self.spark, self.root, self.buckets, self.shards = spark, root.rstrip("/"), buckets, shards

    def shard_of(self, folder: Column | str) -> Column:
        return F.pmod(F.xxhash64(col(folder)), F.lit(self.shards)).cast("int")

    def _current(self) -> tuple[int, dict[str, str]]:
        names = list_names(self.spark, f"{self.root}/versions")
        names = [n for n in names if n.endswith(".json")]
        if not names:
            return 0, {}
        made = json.loads(read_text(self.spark, f"{self.root}/versions/{max(names)}"))
        return made["version"], made["shards"]

    def _table(self, path: str) -> DataFrame:
        name = "tidemark_" + hashlib.md5(path.encode()).hexdigest()
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_COLUMNS}, shard int) USING parquet PARTITIONED BY (shard) "
            f"CLUSTERED BY (path) SORTED BY (path) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        if not self.spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "in-memory":
            self.spark.sql(f"MSCK REPAIR TABLE {name}")
        return self.spark.table(name)

    def _layers(self, shards: list[int] | None) -> list[tuple[list[int], DataFrame]]:
        """Shards and stored files of each table that holds some of the wanted shards."""
        groups = defaultdict(list)
        for shard, path in self._current()[1].items():
            if shards is None or int(shard) in shards:
                groups[path].append(int(shard))
        return [(sorted(own), self._table(path).where(F.col("shard").isin(own))) for path, own in sorted(groups.items())]

    def read(self, shards: list[int] | None = None) -> DataFrame:
        """The stored files in inventory shape, of some shards or all."""
        layers = [stored.select("path", "last_modified_ms", "size") for _, stored in self._layers(shards)]
        return inv.as_inventory(reduce(DataFrame.unionByName, layers) if layers else self.spark.createDataFrame([], _COLUMNS))

    def touched(self, listing: DataFrame) -> list[int]:
        """Shards of the listed folders and of the folders of listed files; at most ``shards`` numbers."""
        folder = F.when(F.col("is_dir"), F.col("path")).otherwise(parent_folder("path"))
        return sorted(r[0] for r in listing.select(self.shard_of(folder)).distinct().collect() if r[0] is not None)

    def diff(self, listing: DataFrame, rules: PathRules | None = None, partial: bool = False) -> DataFrame:
        """The rows of ``inventory.diff`` against the stored files.

        A ``partial`` listing covers the folders it names (as folders, or by their
        files); stored files of its shards outside these folders are unchanged, those
        of other shards are not looked at.
        """
        shards = self.touched(listing) if partial else list(range(self.shards))
        listed = listing.withColumn("_shard", self.shard_of(F.when(F.col("is_dir"), F.col("path")).otherwise(parent_folder("path"))))
        layers = self._layers(shards)
        missing = [s for s in shards if not any(s in own for own, _ in layers)]
        if missing:
            layers.append((missing, None))
        found = None
        for own, stored in layers:
            if stored is None:
                stored = self.spark.createDataFrame([], _COLUMNS)
            # As many parts as buckets, so that the stored side can stay where it is.
            mine = listed.where(F.col("_shard").isin(own)).drop("_shard").repartition(self.buckets, "path")
            changes = inv.diff(stored.select("path", "last_modified_ms", "size", F.lit(False).alias("is_dir")), mine, rules)
            found = changes if found is None else found.unionByName(changes)
        if found is None:  # an empty partial listing
            return inv.diff(self.read([]), listing, rules)
        if not partial:
            return found
        folders = listing.select(F.when(F.col("is_dir"), F.col("path")).otherwise(parent_folder("path")).alias("_folder")).distinct()
        known = folders.withColumn("_listed", F.lit(True))
        other = (F.col("status") == inv.DELETE) & F.col("_listed").isNull()
        return found.withColumn("_folder", parent_folder("path")).join(known, "_folder", "left").withColumn(
            "status", F.when(other, inv.UNCHANGED).otherwise(F.col("status"))).drop("_folder", "_listed")

    def save(self, files: DataFrame, shards: list[int] | None = None) -> None:
        """Store files (path, time, size) as the whole of the shards given, or of all.

        Raises ``Conflict`` if another version was stored since this one was begun: the
        files were worked out from an older one.
        """
        version, now = self._current()
        path = f"{self.root}/tables/{version + 1:08d}-{uuid.uuid4().hex}"
        rows = files.select("path", "last_modified_ms", "size", self.shard_of(parent_folder("path")).alias("shard"))
        name = "tidemark_" + hashlib.md5(path.encode()).hexdigest()
        (
            rows.repartition(self.buckets, "path").sortWithinPartitions("shard", "path").write
            .partitionBy("shard").bucketBy(self.buckets, "path").sortBy("path").option("path", path).saveAsTable(name)
        )
        written = {n.split("=")[1] for n in list_names(self.spark, path) if n.startswith("shard=")}
        replaced = {str(s) for s in (range(self.shards) if shards is None else shards)}
        new = {s: p for s, p in now.items() if s not in replaced} | {s: path for s in written}
        if not create_if_absent(self.spark, f"{self.root}/versions/{version + 1:020d}.json", json.dumps(
                {"version": version + 1, "shards": new})):
            raise Conflict(f"another version of {self.root} came first")

    def apply(self, listing: DataFrame, rules: PathRules | None = None, partial: bool = False) -> DataFrame:
        """Compare, store the files that are left, and return the changes, read from what was written beside them."""
        shards = self.touched(listing) if partial else None
        out = f"{self.root}/changes/{uuid.uuid4().hex}"
        self.diff(listing, rules, partial).write.parquet(out)
        changes = self.spark.read.parquet(out)
        self.save(inv.surviving(changes), shards)
        return changes
