"""Chains, interval labels and exact cuts against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import chains, incremental, intervals
from tidemark.operators import inventory as inv


def test_chains_of_every_kind(spark):
    rows = [(i, i - 1 if i % 500 else None, f"n{i}") for i in range(1, 1100)]  # roots 500 and 1000; 1 points to the missing 0
    rows += [(2001, 2002, "a"), (2002, 2003, "b"), (2003, 2001, "c"), (2004, 2003, "below"), (2005, 2005, "self")]
    rows += [(3001, None, None), (3002, 3001, "x"), (3002, 9999, "again"), (None, 3001, "nobody")]
    got = {r.id: r for r in chains.chains(spark.createDataFrame(rows, "id long, parent long, name string")).collect()}
    assert len(got) == len({r[0] for r in rows} - {None})
    for i in range(1, 1100):
        top = i // 500 * 500 or 1
        assert (got[i].root, got[i].depth, got[i].status) == (top, i - top, "orphan" if top == 1 else "whole")
        assert got[i].path == [f"n{k}" for k in range(top, i + 1)]
    for i in range(2001, 2006):
        assert (got[i].root, got[i].depth, got[i].path, got[i].status) == (None, None, None, "cycle")
    assert got[3002].root == 3001 and got[3002].path == [None, "x"] and got[3002].depth == 1


def test_chains_of_nothing_and_without_paths(spark):
    empty = spark.createDataFrame([], "id string, parent string, name string")
    assert chains.chains(empty).collect() == []
    two = spark.createDataFrame([("a", "", "A"), ("", None, "top")], "id string, parent string, name string")
    found = chains.chains(two, with_path=False)
    assert found.columns == ["id", "root", "depth", "status"]
    assert {tuple(r) for r in found.collect()} == {("a", "", 1, "whole"), ("", "", 0, "whole")}


def folders(spark, names):
    return spark.createDataFrame([(n,) for n in names], "folder string")


def test_labels_are_subtrees(spark):
    rng = random.Random(4)
    names = {"/".join(["/r", *(rng.choice(["a", "b", "a b", "a-b", "é", "a.", "0"]) for _ in range(rng.randrange(5)))]) for _ in range(300)}
    got = {r.folder: (r.first, r.last) for r in intervals.labels(folders(spark, [*names, *names, None])).collect()}
    assert set(got) == names and sorted(f for f, _ in got.values()) == list(range(len(names)))
    for folder, (first, last) in got.items():
        inside = {n for n in names if n == folder or n.startswith(folder + "/")}
        assert inside == {n for n, (f, _) in got.items() if first <= f <= last}
    leaf = {r.folder for r in intervals.leaves(intervals.labels(folders(spark, names))).collect()}
    assert leaf == {n for n in names if not any(m.startswith(n + "/") for m in names)}


@pytest.mark.parametrize("removed", [["/r"], ["/r/1", "/r/1/2", "/r/10", "/gone/x"], ["/r/3/3"], []])
def test_below_equals_the_ancestor_join(spark, removed):
    rows = [(f"/r/{i % 12}/{i % 7}/{i}", i, i) for i in range(500)] + [("/rest/1", 1, 1), ("top", 1, 1), ("/gone/x", 1, 1)]
    files = inv.as_inventory(spark.createDataFrame(rows, "path string, last_modified_ms bigint, size bigint"))
    gone = folders(spark, removed)
    got = sorted(r.path for r in intervals.below(files, gone).collect())
    assert got == sorted(r.path for r in inv.below(files, gone).collect())
    assert got == sorted(p for p, _, _ in rows if any(p.startswith(g + "/") for g in removed))


@pytest.mark.parametrize("values", [
    list(range(40_000)), [7] * 20_000 + list(range(20_000)), [5] * 30_000, [i * i % 1009 for i in range(40_000)],
    [2**62 - i // 3 for i in range(30_000)],
])
def test_cuts_of_large_batches_are_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 10, "mark long").repartition(5).cache()
    for n in (10_001, len(values) // 2, len(values) - 1, len(values), len(values) + 5):
        assert incremental.batch_cut(df, "mark", 0, n) == sorted(v for v in values if v > 0 or True)[min(n, len(values)) - 1]


def test_a_large_batch_sorts_no_more_than_a_small_range(spark):
    df = spark.range(50_000).select(F.col("id").alias("mark"))
    batch = incremental.next_batch(df, "mark", 10, 20_000)
    assert "TakeOrdered" not in batch._jdf.queryExecution().executedPlan().toString()
    assert batch.agg(F.max("mark"), F.count("mark")).first() == (20_010, 20_000)
    assert incremental.batch_cut(df.limit(0), "mark", 0, 20_000) is None


def test_rows_at_their_top_are_not_written_again(spark, monkeypatch):
    frame, written = type(spark.range(1)), []
    checkpoint = frame.checkpoint

    def counted(df, *args):
        made = checkpoint(df, *args)
        written.append(made.count())
        return made

    monkeypatch.setattr(frame, "checkpoint", counted)
    rows = [(i, i - 1 if 1 < i <= 64 else None, "n") for i in range(1, 1001)]
    got = {r.id: r for r in chains.chains(spark.createDataFrame(rows, "id long, parent long, name string")).collect()}
    assert {i: (r.root, r.depth, len(r.path)) for i, r in got.items()} == {
        i: (1, i - 1, i) if i <= 64 else (i, 0, 1) for i in range(1, 1001)}
    # The start, the first state of both passes, and then only the rows of the chain.
    assert [n for n in written if n > 63] == [1000] * 3
