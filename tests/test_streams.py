import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalog import QUERIES
from tidemark.catalog import folders as folder_queries
from tidemark.operators import inventory as inv
from tidemark.operators.filters import PathRules
from tidemark.streaming.index_stream import IndexTable, stream_actions
from tidemark.streaming.inventory_stream import InventoryTable, stream_listings
from tidemark.streaming.messages_stream import stream_tasks

from .test_index import sequential

ACTIONS = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("action", T.StringType()), T.StructField("modified", T.LongType()),
    T.StructField("seq", T.LongType()), T.StructField("content", T.StringType())])
CONTENT = T.StructType([T.StructField("content", T.StringType())])


def index_table(spark, root):
    table = IndexTable(spark, str(root / "index"), CONTENT, ["modified", "seq"], ACTIONS)
    table.start_from(spark.createDataFrame([(1, 0, "old1"), (2, 0, "old2")], "id bigint, last_modified bigint, content string"))
    return table


def rows_of(table):
    return {r.id: (r.last_modified, r.content) for r in table.read().collect()}


def test_stream_equals_one_batch_and_restarts(spark, tmp_path):
    rng = random.Random(11)
    actions = [(rng.randint(1, 6), rng.choice(["INSERT", "UPDATE", "DELETE"]), rng.randint(1, 40), n, f"c{n}") for n in range(80)]
    expected = sequential({1: (0, "old1"), 2: (0, "old2")}, actions)
    table, source = index_table(spark, tmp_path), str(tmp_path / "in")

    def land(rows):
        spark.createDataFrame(rows, ACTIONS).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(ACTIONS).option("maxFilesPerTrigger", 1).parquet(source)
        stream_actions(stream, lambda df: df, table, str(tmp_path / "check")).awaitTermination()

    shuffled = rng.sample(actions, len(actions))
    land(shuffled[:30])
    land(shuffled[30:50])
    run()
    land(shuffled[50:])
    run()
    assert rows_of(table) == expected
    run()
    assert rows_of(table) == expected and table.table.changes().count() == 80


def test_replayed_batch_and_compaction_change_nothing(spark, tmp_path):
    table = index_table(spark, tmp_path)
    batch = spark.createDataFrame([(1, "DELETE", 5, 1, None), (3, "UPDATE", 6, 2, "c")], ACTIONS)
    table.write(batch, 0)
    before = rows_of(table)
    table.write(batch, 0)
    assert rows_of(table) == before == {2: (0, "old2"), 3: (6, "c")}
    table.compact()
    assert rows_of(table) == before and table.table.changes().count() == 2  # the tombstone and the update
    table.write(spark.createDataFrame([(3, "UPDATE", 9, 3, "d")], ACTIONS), 1)
    assert rows_of(table) == {2: (0, "old2"), 3: (9, "c")}


def test_a_second_stream_does_not_replace_batches_of_the_first(spark, tmp_path):
    table = index_table(spark, tmp_path)
    for n, (ident, content) in enumerate([(7, "seven"), (8, "eight")]):
        source = str(tmp_path / f"in{n}")
        spark.createDataFrame([(ident, "INSERT", 5 + n, n, content)], ACTIONS).write.parquet(source)
        for _ in range(2):
            stream = spark.readStream.schema(ACTIONS).parquet(source)
            stream_actions(stream, lambda df: df, table, str(tmp_path / f"check{n}")).awaitTermination()
        if n == 0:
            table.compact()
    assert rows_of(table) == {1: (0, "old1"), 2: (0, "old2"), 7: (5, "seven"), 8: (6, "eight")}


def listing(spark, rows):
    return inv.as_inventory(spark.createDataFrame(rows, "path string, last_modified_ms bigint, size bigint"))


def folders(spark, names):
    return spark.createDataFrame([(n,) for n in names], "folder string")


def test_listing_stream(spark, tmp_path):
    table = InventoryTable(spark, str(tmp_path / "state"))
    table.start_from(listing(spark, [("/r/a/1", 1000, 1), ("/r/a/2", 1000, 1), ("/r/b/3", 1000, 1), ("/r/c/4", 1000, 1)]))
    source = str(tmp_path / "in")
    first = inv.complete_listing(
        listing(spark, [("/r/a/1", 5000, 1), ("/r/a/5", 1, 1), ("/r/a/6.no", 1, 1)]), "1", folders(spark, ["/r/c"]))
    first.coalesce(1).write.parquet(source)

    def run():
        stream = spark.readStream.schema(first.schema).parquet(source)
        stream_listings(stream, table, str(tmp_path / "check"), PathRules(exclude_types=("no",))).awaitTermination()

    run()
    want = [("/r/a/1", 5000), ("/r/a/5", 1), ("/r/b/3", 1000)]
    assert sorted((r.path, r.last_modified_ms) for r in table.read().collect()) == want
    run()
    assert sorted((r.path, r.last_modified_ms) for r in table.read().collect()) == want
    table.compact()
    table.table.vacuum()
    assert sorted((r.path, r.last_modified_ms) for r in table.read().collect()) == want
    inv.complete_listing(listing(spark, [("/r/a/1", 5000, 1)]), "2").coalesce(1).write.mode("append").parquet(source)
    run()
    assert sorted(r.path for r in table.read().collect()) == ["/r/a/1", "/r/b/3"]


def test_a_listing_cut_over_batches_deletes_only_when_complete(spark, tmp_path):
    table = InventoryTable(spark, str(tmp_path / "state"))
    table.start_from(listing(spark, [("/r/a/1", 1000, 1), ("/r/a/2", 1000, 1), ("/r/a/3", 1000, 1)]))
    whole = inv.complete_listing(listing(spark, [("/r/a/1", 1000, 1), ("/r/a/2", 9000, 1), ("/r/a/4", 1, 1)]), "7")

    def paths():
        return sorted((r.path, r.last_modified_ms) for r in table.read().collect())

    def give(where, batch):
        table.apply_listing(whole.where(where), batch, PathRules())

    give("path = '/r/a/1'", 0)
    assert len(paths()) == 3
    give("is_dir", 1)  # the end is known before all entries
    table.compact()
    table.table.vacuum()
    assert len(paths()) == 3
    give("path = '/r/a/2'", 2)
    give("path = '/r/a/2'", 2)
    assert paths() == [("/r/a/1", 1000), ("/r/a/2", 9000), ("/r/a/3", 1000)]
    # A newer listing shows another new file before the older one is complete.
    table.apply_listing(listing(spark, [("/r/a/5", 1, 1)]).withColumn("listing", F.lit("8")), 3, PathRules())
    give("path = '/r/a/4'", 4)
    want = [("/r/a/1", 1000), ("/r/a/2", 9000), ("/r/a/4", 1), ("/r/a/5", 1)]
    assert paths() == want
    give("path = '/r/a/4'", 4)
    table.compact()
    give("path = '/r/a/4'", 4)
    assert paths() == want


def test_streams_that_take_turns_keep_their_batches(spark, tmp_path):
    for compacting in (False, True):
        root = tmp_path / str(compacting)
        table = index_table(spark, root)

        def run(name, rows):
            source = str(root / name)
            spark.createDataFrame(rows, ACTIONS).coalesce(1).write.mode("append").parquet(source)
            stream = spark.readStream.schema(ACTIONS).parquet(source)
            stream_actions(stream, lambda df: df, table, str(root / f"check-{name}")).awaitTermination()
            if compacting:
                table.compact()
                table.table.vacuum()

        run("a", [(7, "INSERT", 5, 1, "seven")])
        run("b", [(8, "INSERT", 6, 2, "eight")])
        run("a", [(9, "INSERT", 7, 3, "nine"), (8, "UPDATE", 8, 4, "x")])
        assert rows_of(table) == {1: (0, "old1"), 2: (0, "old2"), 7: (5, "seven"), 8: (8, "eight"), 9: (7, "nine")}


def test_late_actions_do_the_same_after_any_compaction(spark, tmp_path):
    rng = random.Random(5)
    for trial in range(4):
        actions = [(rng.randint(1, 5), rng.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"]), rng.randint(1, 30), n, f"c{n}")
                   for n in range(40)]
        expected = sequential({1: (0, "old1"), 2: (0, "old2")}, actions)
        late = rng.sample(actions, len(actions))
        table = index_table(spark, tmp_path / str(trial))
        for batch in range(3):
            table.write(spark.createDataFrame(late[batch::3], ACTIONS), batch)
            table.compact()
        assert rows_of(table) == expected


def test_task_messages_and_rejects(spark, tmp_path):
    lines = ['{"id":"/a/","level":0}', '{"id":"/b/"', '{"level":1}', '{"id":"/c/","level":"x"}', "text"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/m.txt").write_text("\n".join(lines))
    out = str(tmp_path / "out")
    for _ in range(2):
        messages = spark.readStream.text(str(tmp_path / "in"))
        stream_tasks(messages, out, str(tmp_path / "check")).awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(f"{out}/tasks").select("id", "level").collect()] == [("/a/", 0)]
    assert spark.read.parquet(f"{out}/rejects").select(F.count("*")).first()[0] == 4


@pytest.mark.parametrize("name, batches", [("inventory_stream", 1), ("inventory_stream_batches", 3)])
def test_a_listing_is_written_and_read_by_many_tasks(spark, tmp_path, monkeypatch, name, batches):
    monkeypatch.setattr(folder_queries, "shared_dir", lambda _, label: f"{tmp_path}/{label}")
    QUERIES[name](spark, "/root/testdata/sf0.001")
    assert len(list((tmp_path / "inventory/listing").glob("part-*.parquet"))) > 4 * batches
