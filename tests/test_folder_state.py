"""Listings as keyed state: batches, restarts, slots, open listings and their expiry."""

import time

import pytest

from tidemark.operators.filters import PathRules
from tidemark.streaming.folder_state import FolderState, in_slots

FILES = "path string, parent string, name string, is_dir boolean, last_modified_ms bigint, size bigint"
ROWS = ("path string, parent string, is_dir boolean, last_modified_ms bigint, size bigint, entries bigint, slot int, "
        "listing string")


def files(spark, *rows):
    return spark.createDataFrame([(p, p.rsplit("/", 1)[0], p.rsplit("/", 1)[1], False, ms, size) for p, ms, size in rows], FILES)


class Feed:
    """Each call is one batch of a stream that is started anew."""

    def __init__(self, spark, root, stored=None, rules=None, **options):
        self.spark, self.root, self.stored, self.rules = spark, str(root), stored, rules
        self.state = FolderState(spark, f"{root}/state", **options)

    def batch(self, rows):
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/in")
        source = self.spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(f"{self.root}/in")
        self.state.stream(source, self.rules, self.stored).awaitTermination()
        return sorted(tuple(r)[0:1] + (r.last_modified_ms, r.size) for r in self.state.read().collect())

    def rows(self, *rows):
        return self.spark.createDataFrame(rows, ROWS)

    def log(self):
        return sorted((r.status, r.path, r.last_modified_ms) for r in self.state.changes().collect())


def file(path, ms, size, listing="1", slot=0):
    return (path, path.rsplit("/", 1)[0], False, ms, size, None, slot, listing)


def end(folder, entries, listing="1", slot=0):
    return (folder, folder, True, 0, 0, entries, slot, listing)


def test_changes_follow_the_newest_row_by_whole_seconds(spark, tmp_path):
    feed = Feed(spark, tmp_path, files(spark, ("/a/same", 1500, 1), ("/a/moved", 1500, 1), ("/a/back", 5000, 1), ("/b/x", 1, 1)))
    got = feed.batch(feed.rows(
        file("/a/same", 1999, 2), file("/a/moved", 2000, 2), file("/a/back", 100, 2), file("/a/new", 7000, 1),
        file("/a/new", 9000, 3), file("/a/new", 8000, 2), (None, "/a", False, 1, 1, None, 0, "1"), file("/a/same", 1600, 9)))
    assert got == [("/a/back", 5000, 1), ("/a/moved", 2000, 2), ("/a/new", 9000, 3), ("/a/same", 1500, 1), ("/b/x", 1, 1)]
    assert feed.log() == [("insert", "/a/new", 9000), ("update", "/a/moved", 2000)]


def test_deletes_wait_for_the_whole_listing_over_restarts(spark, tmp_path):
    feed = Feed(spark, tmp_path, files(spark, ("/a/1", 1, 1), ("/a/2", 1, 1), ("/a/3", 1, 1), ("/b/1", 1, 1)))
    assert len(feed.batch(feed.rows(end("/a", 2)))) == 4
    assert len(feed.batch(feed.rows(file("/a/1", 1, 1)))) == 4
    assert len(feed.batch(feed.rows(file("/a/1", 1, 1)))) == 4  # the same row again shows nothing new
    # A second listing is open, too, and has shown /a/3: it stays although the first has not shown it.
    assert len(feed.batch(feed.rows(file("/a/3", 1, 1, "2")))) == 4
    assert [r[0] for r in feed.batch(feed.rows(file("/a/4", 1, 1)))] == ["/a/1", "/a/3", "/a/4", "/b/1"]
    assert [r[0] for r in feed.batch(feed.rows(end("/a", 1, "2")))] == ["/a/3", "/b/1"]
    assert [r[0] for r in feed.batch(feed.rows(end("/b", 0, "9"), end("/c", 0, "9")))] == ["/a/3"]
    assert feed.log() == [("delete", "/a/1", 1), ("delete", "/a/2", 1), ("delete", "/a/4", 1), ("delete", "/b/1", 1), ("insert", "/a/4", 1)]


def test_rules_and_unreadable_files(spark, tmp_path):
    feed = Feed(spark, tmp_path, files(spark, ("/a/old.tmp", 1, 1), ("/a/x", 1, 1)), PathRules(exclude_types=("tmp",)))
    assert feed.batch(feed.rows(file("/a/old.tmp", 9000, 1), file("/a/new.tmp", 9000, 1))) == [("/a/x", 1, 1)]


@pytest.mark.parametrize("slots", [1, 4])
def test_a_folder_in_slots(spark, tmp_path, slots):
    old = files(spark, *[(f"/a/{i}", 1000, i) for i in range(60)])
    now = files(spark, *[(f"/a/{i}", 1000 if i % 2 else 3000, i) for i in range(30, 90)])
    feed = Feed(spark, tmp_path, old, slots=slots)
    rows = in_slots(now, "1", slots, old.select("parent").withColumnRenamed("parent", "folder")).select(
        "path", "parent", "is_dir", "last_modified_ms", "size", "entries", "slot", "listing")
    assert rows.where("is_dir").count() == slots
    feed.batch(rows.where("size % 3 = 0 and not is_dir"))
    got = feed.batch(rows.where("size % 3 <> 0 or is_dir"))
    assert got == sorted((f"/a/{i}", 1000 if i % 2 else 3000, i) for i in range(30, 90))
    assert len(feed.log()) == 30 + 30 + 15


def test_an_open_listing_expires(spark, tmp_path):
    feed = Feed(spark, tmp_path, files(spark, ("/a/1", 1, 1)), expire_ms=1)
    feed.batch(feed.rows(end("/a", 1)))
    time.sleep(0.1)
    feed.batch(feed.rows(file("/z/1", 1, 1)))  # timers fire with the next batch
    time.sleep(0.1)
    assert [r[0] for r in feed.batch(feed.rows(file("/a/2", 1, 1)))] == ["/a/1", "/a/2", "/z/1"]


def test_a_start_without_stored_files(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    assert feed.batch(feed.rows(file("/a/1", 1, 1))) == [("/a/1", 1, 1)]


def test_folders_of_one_group_share_one_value_and_are_settled_each_for_itself(spark, tmp_path):
    old = files(spark, *[(f"/{f}/{i}", 1000, i) for f in "abc" for i in range(3)])
    feed = Feed(spark, tmp_path, old, groups=1)
    # /a is listed whole, /b stays open, /c is not listed.
    got = feed.batch(feed.rows(file("/a/0", 5000, 9), end("/a", 1), file("/b/0", 1000, 0), end("/b", 2), file("/d/0", 1, 1)))
    assert [r[0] for r in got] == ["/a/0", *[f"/{f}/{i}" for f in "bc" for i in range(3)], "/d/0"]
    got = feed.batch(feed.rows(file("/b/1", 1000, 1)))
    assert [r[0] for r in got] == ["/a/0", "/b/0", "/b/1", "/c/0", "/c/1", "/c/2", "/d/0"]
    assert feed.log() == [
        ("delete", "/a/1", 1000), ("delete", "/a/2", 1000), ("delete", "/b/2", 1000), ("insert", "/d/0", 1), ("update", "/a/0", 5000)]
    state = spark.read.format("statestore").option("path", feed.state.checkpoint).option("stateVarName", "files").load()
    assert state.count() == 1
