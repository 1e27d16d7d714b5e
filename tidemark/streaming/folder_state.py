"""The stored inventory as keyed state: folder listings compared inside Spark's state store.

A folder has slots; a slot takes the paths whose hash falls to it, so a folder that holds
a large share of all files is spread over ``slots`` tasks. The key of the state is a group of
folder slots, by hash: calls to the store cost far more than the rows in them, so a batch
reads and writes the stored files of a group in one call each. A group keeps its slots'
stored files, the listings that are open with what they have shown so far, and
nothing else; a batch reads and writes the groups of its own rows only, and neither a
base snapshot nor a log is scanned. State and progress are kept by the stream's checkpoint, so a
restart goes on where the last batch ended.

A listing is known by its id. Its folder row (``is_dir``) gives the number of files in
``entries``; ``in_slots`` turns it into one such row per slot. New and changed files are
given out at once, deletes when all entries of a slot have been seen in one listing:
then the stored files go that no open listing of the slot has shown. A listing that
stays open for ``expire_ms`` is forgotten, and deletes nothing.

Of a path listed several times in one batch the newest row counts. Rows of a listing
that is settled open it anew, which changes nothing unless the folder row comes
again, too. A null listing id is the id "". Rows without a path or a folder are
left out.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import islice
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.common import col
from ..functions.paths import parent_folder
from ..operators.filters import PathRules
from ..operators.inventory import DELETE, INSERT, UPDATE, as_inventory

# Workers get this module's code with the query, so they need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGES = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("last_modified_ms", T.LongType()), T.StructField("size", T.LongType()),
])
def _lists(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, T.ArrayType(kind)) for name, kind in kinds.items()])


_TEXT, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
# Lists side by side: a list of structs would be read and written field by field.
#: Folder slots with the number of their files, and these files.
_FILES = _lists(parents=_TEXT, slots=_INT, counts=_INT, paths=_TEXT, times=_LONG, sizes=_LONG)
#: Open listings: folder slot, id, number of files (-1: not known yet), start and number of paths shown, and these paths.
_OPEN = _lists(parents=_TEXT, slots=_INT, listings=_TEXT, entries=_LONG, starts=_LONG, counts=_INT, shown=_TEXT)
#: Columns of the rows in their order; the group comes behind them.
_COLUMNS = ["path", "parent", "slot", "last_modified_ms", "size", "entries", "listing", "verdict"]
_UNREADABLE, _REFUSED, _KEPT = 0, 1, 2
_STORED = ["parent", "slot", "path", "last_modified_ms", "size"]
_CHANGE = Row(*CHANGES.names)

Slot = tuple[str, int]
Files = dict[str, tuple[int, int]]
Open = dict[str, tuple[int, set[str], int]]


def slot_of(path: Column | str, slots: int) -> Column:
    return F.pmod(F.xxhash64(col(path)), F.lit(slots)).cast("int")


class FolderProcessor(StatefulProcessor):
    """Compares the rows of a group of folder slots with their stored files."""

    def __init__(self, expire_ms: int | None) -> None:
        self.expire_ms = expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.files = handle.getValueState("files", _FILES)
        self.open = handle.getValueState("open", _OPEN)

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        stored: dict[Slot, Files] = {}
        for parent, slot, path, ms, size in zip(*(initialState[c] for c in _STORED), strict=True):
            stored.setdefault((parent, slot), {})[path] = (ms, size)
        self._keep_files(stored)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        newest: dict[Slot, dict[str, tuple]] = {}
        shown: dict[Slot, dict[str, set[str]]] = {}
        entries: dict[tuple[Slot, str], int] = {}
        for row in rows:
            path, parent, slot, ms, size, number, listing, verdict = row[:len(_COLUMNS)]
            place, listing = (parent, slot), listing or ""
            mine = shown.setdefault(place, {}).setdefault(listing, set())
            if number is not None:
                entries[place, listing] = max(number, entries.get((place, listing), 0))
                continue
            mine.add(path)
            files = newest.setdefault(place, {})
            other = files.get(path)
            if other is None or other[:2] < (ms, size):
                files[path] = (ms, size, verdict)
        every, known = self._stored_files(), self._open_listings()
        touched, changed, opened = False, False, False
        for place, listings in shown.items():
            mine, stored = known.setdefault(place, {}), every.setdefault(place, {})
            complete = False
            for listing, paths in listings.items():
                total, before, since = mine.get(listing, (-1, set(), None))
                total, paths = max(total, entries.get((place, listing), -1)), paths | before
                listings[listing] = paths
                if 0 <= total <= len(paths):
                    complete = True
                    changed |= mine.pop(listing, None) is not None
                    continue
                if since is None:
                    since = timerValues.getCurrentProcessingTimeInMs() if self.expire_ms else 0
                    opened = True
                mine[listing] = (total, paths, since)
                changed = True
            gone = []
            if complete:  # what was stored before this batch, and neither a settled nor an open listing has shown
                alive = set().union(*listings.values(), *(k[1] for k in mine.values()))
                gone = [(path, old) for path, old in stored.items() if path not in alive]
            for path, row in newest.get(place, {}).items():
                for change in self._judge(path, row, stored):
                    touched = True
                    yield change
            for path, old in gone:
                del stored[path]
                touched = True
                yield _CHANGE(path, DELETE, *old)
        if opened and self.expire_ms:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.expire_ms)
        if touched:
            self._keep_files(every)
        if changed:
            self._keep_open(known)

    def _stored_files(self) -> dict[Slot, Files]:
        state = self.files.get()
        if not state:
            return {}
        parents, slots, counts, *columns = state
        files = zip(*columns, strict=True)
        return {
            place: {path: (ms, size) for path, ms, size in islice(files, n)}
            for *place, n in zip(parents, slots, counts, strict=True) for place in [tuple(place)]}

    def _keep_files(self, stored: dict[Slot, Files]) -> None:
        places = [place for place, files in stored.items() if files]
        if not places:
            self.files.clear()
            return
        every = [(path, *old) for place in places for path, old in stored[place].items()]
        self.files.update((
            [p for p, _ in places], [s for _, s in places], [len(stored[place]) for place in places],
            *([f[i] for f in every] for i in range(3))))

    def _open_listings(self) -> dict[Slot, Open]:
        state, known = self.open.get(), {}
        if state:
            *columns, shown = state
            paths = iter(shown)
            for parent, slot, listing, total, since, n in zip(*columns, strict=True):
                known.setdefault((parent, slot), {})[listing] = (total, set(islice(paths, n)), since)
        return known

    def _keep_open(self, known: dict[Slot, Open]) -> None:
        rows = [(*place, listing, *k) for place, mine in known.items() for listing, k in mine.items()]
        if not rows:
            self.open.clear()
            return
        self.open.update((
            *([r[i] for r in rows] for i in range(4)), [r[5] for r in rows], [len(r[4]) for r in rows],
            [path for r in rows for path in r[4]]))

    def _judge(self, path: str, row: tuple, stored: Files) -> Iterator[Row]:
        ms, size, verdict = row
        old = stored.get(path)
        if verdict == _UNREADABLE:
            return
        if verdict == _REFUSED:
            if old is not None:
                del stored[path]
                yield _CHANGE(path, DELETE, *old)
            return
        # Whole seconds, rounded down like the other comparisons.
        if old is not None and not old[0] // 1000 < ms // 1000:
            return
        stored[path] = (ms, size)
        yield _CHANGE(path, INSERT if old is None else UPDATE, ms, size)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        self._keep_open({
            place: {k: v for k, v in mine.items() if v[2] + self.expire_ms > due}
            for place, mine in self._open_listings().items()})
        return iter([])

    def close(self) -> None:
        pass


def in_slots(files: DataFrame, listing: str, slots: int = 1, folders: DataFrame | None = None) -> DataFrame:
    """Files in inventory shape as rows of one listing, with a folder row for every slot of every folder.

    ``folders`` adds listed folders that may hold no file.
    """
    named = files.where(~F.col("is_dir"))
    counts = named.groupBy(F.col("parent").alias("path"), slot_of("path", slots).alias("slot")).agg(
        F.count_distinct("path").alias("entries"))
    places = named.select(F.col("parent").alias("path"))
    if folders is not None:
        places = places.unionByName(folders.select(F.col("folder").alias("path")))
    every = places.distinct().select("path", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    zero = F.lit(0).cast("bigint")
    ends = every.join(counts, ["path", "slot"], "left").select(
        "path", F.col("path").alias("parent"), F.lit(True).alias("is_dir"), zero.alias("last_modified_ms"),
        zero.alias("size"), F.coalesce("entries", zero).alias("entries"), "slot")
    rows = named.select(
        "path", "parent", "is_dir", "last_modified_ms", "size", F.lit(None).cast("bigint").alias("entries"),
        slot_of("path", slots).alias("slot"))
    return rows.unionByName(ends).withColumn("listing", F.lit(listing))


class FolderState:
    """An inventory kept by a stream with keyed state, its changes in a table beside it.

    ``slots``, ``groups`` and the session's number of shuffle partitions are fixed by the first start.
    A batch that lists one file reads and writes its group: take more groups for small batches over
    very many files, and more slots if a folder's files do not fit in a task.
    """

    def __init__(
        self, spark: SparkSession, root: str, slots: int = 1, expire_ms: int | None = None, groups: int = 16_384,
    ) -> None:
        self.spark, self.slots, self.expire_ms, self.groups = spark, slots, expire_ms, groups
        root = root.rstrip("/")
        self.checkpoint, self.changes_path = f"{root}/checkpoint", f"{root}/changes"

    def stream(
        self, source: DataFrame, rules: PathRules | None = None, stored: DataFrame | None = None, interval: str | None = None,
    ) -> StreamingQuery:
        """Start or go on with the stream over rows as ``in_slots`` gives them.

        ``stored`` are the files to start from, in inventory shape; only the first
        start reads them. Give them to every start, as the plan has to stay the same.
        """
        # The one setting of the session this needs: state of any size beside the heap.
        self.spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        flag = F.coalesce("readable", F.lit(True)) if "readable" in source.columns else F.lit(True)
        rows = source.where(
            F.col("path").isNotNull() & F.col("parent").isNotNull() & (~F.col("is_dir") | F.col("entries").isNotNull())
        ).select(
            "path", "parent", "slot", "last_modified_ms", "size", F.when(F.col("is_dir"), F.col("entries")).alias("entries"), "listing",
            F.when(~flag, _UNREADABLE).when((rules or PathRules()).keeps_entry(), _KEPT).otherwise(_REFUSED).alias("verdict"))
        group = F.pmod(F.xxhash64("parent", "slot"), F.lit(self.groups)).cast("int").alias("group")
        base = None
        if stored is not None:
            base = stored.where(~F.col("is_dir")).select(
                parent_folder("path").alias("parent"), slot_of("path", self.slots).alias("slot"), "path", "last_modified_ms", "size"
            ).groupBy(group).agg(F.sort_array(F.collect_list(F.struct(*_STORED))).alias("f")).select(  # of one path the newest last
                "group", *[F.col(f"f.{c}").alias(c) for c in _STORED]).groupBy("group")
        changes = rows.select(*_COLUMNS, group).groupBy("group").transformWithState(
            statefulProcessor=FolderProcessor(self.expire_ms), outputStructType=CHANGES, outputMode="Append",
            timeMode="ProcessingTime" if self.expire_ms else "None", initialState=base)
        trigger = {"processingTime": interval} if interval else {"availableNow": True}
        # With timers a stream over what is there would go on for ever with batches without rows.
        idle = "spark.sql.streaming.noDataMicroBatches.enabled"
        before = self.spark.conf.get(idle)
        self.spark.conf.set(idle, "true" if interval else "false")
        try:
            return (
                changes.writeStream.format("parquet").outputMode("append").option("path", self.changes_path)
                .option("checkpointLocation", self.checkpoint).trigger(**trigger).start()
            )
        finally:
            self.spark.conf.set(idle, before)

    def read(self) -> DataFrame:
        """The stored files after the last whole batch, from the state store itself."""
        state = self.spark.read.format("statestore").option("path", self.checkpoint).option("stateVarName", "files").load()
        value = F.col("value")
        zipped = F.arrays_zip(
            value["paths"].alias("path"), value["times"].alias("last_modified_ms"), value["sizes"].alias("size"))
        return as_inventory(state.select(F.inline(zipped)))

    def changes(self) -> DataFrame:
        """All changes given out so far."""
        return self.spark.read.schema(CHANGES).parquet(self.changes_path)
