"""Layout and commits of stored state: buckets that stay in place, writers that meet, digests that spare folders."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import digests
from tidemark.operators import inventory as inv
from tidemark.operators.filters import PathRules
from tidemark.sinks.buckets import BucketedInventory
from tidemark.sinks.state import Conflict, MarkStore, create_if_absent, list_names, next_number, read_text

from .test_streams import ACTIONS, index_table, rows_of


def files(spark, *rows):
    return inv.as_inventory(spark.createDataFrame(list(rows), "path string, last_modified_ms bigint, size bigint"))


def stored_files(table, bucket):
    path = table.table._current().rows[str(bucket)]
    return sorted(n for n in list_names(table.table.spark, path) if n.endswith(".parquet"))


# ----------------------------------------------------------------- commits


def test_a_file_is_created_once_and_whole(spark, tmp_path):
    path = f"{tmp_path}/new/folder/v1"
    assert create_if_absent(spark, path, "first") and not create_if_absent(spark, path, "second")
    assert read_text(spark, path) == "first" and list_names(spark, f"{tmp_path}/new/folder") == ["v1"]
    assert [next_number(spark, f"{tmp_path}/turns") for _ in range(3)] == [1, 2, 3]


def test_marks_are_ordered_by_their_saving(spark, tmp_path, monkeypatch):
    marks = MarkStore(spark, str(tmp_path / "marks"))
    monkeypatch.setattr("time.time_ns", lambda: 0)
    for hwm in (5, 9, 7):
        MarkStore(spark, marks.path).save_one("a", hwm)
    assert marks.get("a") == 7


def test_compaction_writes_touched_buckets_only(spark, tmp_path):
    table = index_table(spark, tmp_path)
    table.start_from(spark.createDataFrame([(i, 0, f"old{i}") for i in range(200)], "id bigint, last_modified bigint, content string"))
    of = {r.id: r.b for r in spark.range(200).select("id", table.table.bucket_of("id").alias("b")).collect()}
    before = {b: stored_files(table, b) for b in range(8)}
    table.write(spark.createDataFrame([(7, "DELETE", 5, 1, None), (7, "INSERT", 6, 2, "new")], ACTIONS), 0)
    want = rows_of(table)
    assert table.compact() == [of[7]] and rows_of(table) == want and want[7] == (6, "new")
    for b in range(8):
        assert (stored_files(table, b) == before[b]) == (b != of[7])
    assert table.compact() == []
    table.table.vacuum()
    assert rows_of(table) == want


def test_of_two_writers_one_does_its_work_again(spark, tmp_path, monkeypatch):
    first, second = index_table(spark, tmp_path), index_table(spark, tmp_path)
    first.write(spark.createDataFrame([(1, "DELETE", 5, 1, None)], ACTIONS), 0, "a")
    tries, store = [], first.table._store

    def late(*args):
        tries.append(args[0].number)
        if len(tries) == 1:  # the other one compacts, with a batch of its own, while this one writes
            second.write(spark.createDataFrame([(9, "INSERT", 6, 2, "nine")], ACTIONS), 0, "b")
            second.compact()
        return store(*args)

    monkeypatch.setattr(first.table, "_store", late)
    first.write(spark.createDataFrame([(2, "UPDATE", 7, 3, "two")], ACTIONS), 1, "a")
    first.compact()
    assert tries == [tries[0]] or tries == [tries[0], tries[0] + 1]
    assert rows_of(first) == rows_of(second) == {2: (7, "two") if rows_of(first)[2][1] == "two" else (7, "old2"), 9: (6, "nine")}
    assert first.table._current().covered == {"a": 1, "b": 0}
    monkeypatch.setattr(first.table, "_store", lambda *a: False)
    first.write(spark.createDataFrame([(3, "INSERT", 8, 4, "c")], ACTIONS), 2, "a")
    with pytest.raises(Conflict):
        first.table.rewrite(lambda base, log: (base, log), retries=2)


# ----------------------------------------------------------------- buckets


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_stored_side_of_a_diff_is_not_shuffled(spark, tmp_path):
    stored = BucketedInventory(spark, str(tmp_path / "b"), buckets=4, shards=3)
    stored.save(files(spark, *[(f"/r/{i % 20}/{i}", 1000 * i, i) for i in range(400)]))
    listing = files(spark, *[(f"/r/{i % 20}/{i}", 1000 * i + 1000 * (i % 2), i) for i in range(100, 500)])
    changes = stored.diff(listing)
    changes.collect()
    plan = plan_of(changes)
    plan = plan[:plan.find("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    join = plan[plan.index("SortMergeJoin"):]
    left = join[:join.index("Exchange")] if "Exchange" in join else join
    assert "FileScan parquet" in left and "Bucketed: true" in left, plan
    got = {(r.path, r.status) for r in changes.collect()}
    assert got == {(r.path, r.status) for r in inv.diff(stored.read(), listing).collect()}


def test_a_partial_crawl_reads_and_writes_its_shards_only(spark, tmp_path):
    stored = BucketedInventory(spark, str(tmp_path / "b"), buckets=2, shards=16)
    stored.save(files(spark, *[(f"/r/{i % 40}/{i}", 1000, i) for i in range(400)]))
    before = stored._current()[1]
    listing = inv.complete_listing(files(spark, ("/r/3/3", 1000, 3), ("/r/3/43", 5000, 4), ("/r/3/new", 1, 1)), "1")
    shards = stored.touched(listing)
    assert len(shards) == 1
    changes = stored.diff(listing, partial=True)
    assert re.search(rf"PartitionFilters: \[[^\]]*shard#\d+ (= {shards[0]}|IN \({shards[0]}\))", plan_of(changes))
    changed = {r.path: r.status for r in stored.apply(listing, partial=True).collect() if r.status != "unchanged"}
    assert changed == {"/r/3/43": "update", "/r/3/new": "insert", **{f"/r/3/{i}": "delete" for i in range(83, 400, 40)}}
    after = stored._current()[1]
    assert {s for s in before if before[s] != after[s]} == {str(shards[0])}
    assert stored.read().count() == 400 - 8 + 1
    assert stored.diff(listing.limit(0), partial=True).count() == 0
    again = BucketedInventory(spark, str(tmp_path / "b"), buckets=2, shards=16)
    assert again.read().count() == 393


def test_a_partial_crawl_of_new_and_emptied_folders(spark, tmp_path):
    stored = BucketedInventory(spark, str(tmp_path / "b"), buckets=2, shards=4)
    listing = inv.complete_listing(files(spark, ("/n/1", 1, 1)), "1", spark.createDataFrame([("/e",)], "folder string"))
    assert [tuple(r)[:2] for r in stored.apply(listing, partial=True).collect()] == [("/n/1", "insert")]
    empty = inv.complete_listing(files(spark), "2", spark.createDataFrame([("/n",)], "folder string"))
    assert [tuple(r)[:2] for r in stored.apply(empty, PathRules(), partial=True).collect()] == [("/n/1", "delete")]
    assert stored.read().count() == 0


def test_a_save_on_an_older_version_is_refused(spark, tmp_path, monkeypatch):
    one, two = (BucketedInventory(spark, str(tmp_path / "b"), buckets=2, shards=2) for _ in range(2))
    one.save(files(spark, ("/a/1", 1, 1)))
    old = two._current()
    one.save(files(spark, ("/a/2", 1, 1)))
    monkeypatch.setattr(two, "_current", lambda: old)
    with pytest.raises(Conflict):
        two.save(files(spark, ("/a/3", 1, 1)))
    assert [r.path for r in one.read().collect()] == ["/a/2"]


# ----------------------------------------------------------------- digests


def test_equal_trees_are_compared_at_no_folder(spark):
    tree = files(spark, *[(f"/r/{i % 5}/{i % 3}/{i}", 1000 * i, i) for i in range(60)])
    changes, found = digests.digest_diff(tree, tree.repartition(7))
    assert (found.compared, found.skipped) == (0, 1 + 5 + 15)
    assert {r.status for r in changes.collect()} == {"unchanged"} and changes.count() == 60


def test_the_descent_follows_differences_only(spark):
    rows = [(f"/r/{i % 5}/{i % 3}/{i}", 1000 * i, i) for i in range(60)]
    now = [(p, ms + 1000 if p == "/r/4/2/14" else ms + 1 if p == "/r/1/1/1" else ms, size) for p, ms, size in rows]
    changes, found = digests.digest_diff(files(spark, *rows), files(spark, *now))
    # The root, its five folders and the three of the one that differs; a change within a second is none.
    assert (found.compared, found.skipped) == (1 + 5 + 3, 12)
    assert [r.folder for r in found.changed.collect()] == ["/r/4/2"]
    assert [r.path for r in changes.where("status <> 'unchanged'").collect()] == ["/r/4/2/14"]


def test_digest_diff_gives_the_rows_of_the_plain_diff(spark):
    rules = PathRules(exclude_types=("tmp",), max_size=50)
    old = files(spark, ("/a/1", 1000, 1), ("/a/b/2", 1000, 1), ("/a/b/old.tmp", 1000, 1), ("/c/3", 1500, 1), ("/g/9", 1, 1), ("top", 1, 1))
    now = files(spark, ("/a/1", 1000, 1), ("/a/b/2", 2000, 1), ("/a/b/old.tmp", 1000, 1), ("/c/3", 1999, 2), ("/c/n.tmp", 1, 1),
                ("/c/n.tmp", 2, 1), ("/d/e/5", 1, 1), ("/d/e/5", 4000, 2), ("/d/big", 1, 99))
    want = {tuple(r) for r in inv.diff(old, now, rules).collect()}
    got = [tuple(r) for r in digests.digest_diff(old, now, rules)[0].collect()]
    assert set(got) == want and len(got) == len(want)
    kept = digests.digest_diff(old, now, rules, digests.own_digests(old))[0]
    assert {tuple(r) for r in kept.collect()} == want
    assert {r.status for r in digests.digest_diff(files(spark), now)[0].collect()} == {"insert"}
    assert {r.status for r in digests.digest_diff(old, files(spark))[0].collect()} == {"delete"}
    with pytest.raises(ValueError):
        digests.digest_diff(old, now.withColumn("readable", F.lit(True)))
