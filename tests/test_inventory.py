import random

import pytest
from pyspark.sql import functions as F

from tidemark.catalog import QUERIES, folders
from tidemark.operators import inventory as inv
from tidemark.operators.filters import PathRules, capped_body, has_indexable_content
from tidemark.plans.crawl import plan_crawl
from tidemark.sources.files import list_files, read_bodies

RULES = PathRules(
    exclude_names=(".*~.*", "dir0-0", ".*snapshot.*", ".*/folder2exclude", ".*/notme.txt", "(broken"),
    exclude_types=("DS_Store", "not"),
)


def listing(spark, rows):
    files = spark.createDataFrame(rows, "path string, last_modified_ms bigint, size bigint")
    return inv.as_inventory(files)


def paths(df, column="path"):
    return sorted(r[column] for r in df.collect())


def test_crawl_rules(spark):
    rows = [(f"crawldocs/{p}", 1, 1) for p in (
        "folder2add/addme.txt", "folder2add/subfolder2add/addme2.txt", "folder2add/addme.not",
        "folder2add/notme.txt", "folder2exclude/any.txt", "folder2add/notme.txt.bak")]
    kept = listing(spark, rows).where(RULES.keeps_entry())
    assert paths(kept) == [
        "crawldocs/folder2add/addme.txt", "crawldocs/folder2add/notme.txt.bak",
        "crawldocs/folder2add/subfolder2add/addme2.txt"]


@pytest.mark.parametrize(
    "rules, path, is_dir, kept",
    [
        (PathRules(include_types=("txt",)), "/a/b.txt", False, True),
        (PathRules(include_types=("txt",)), "/a/b.TXT", False, False),
        (PathRules(include_types=("txt",)), "/a/b", False, True),
        (PathRules(include_types=("txt",), exclude_types=("txt",)), "/a/b.txt", False, False),
        (PathRules(exclude_types=("d",)), "/a.d", True, True),
        (PathRules(exclude_types=("d",)), "/a.d/b", False, True),
        (PathRules(exclude_names=("/a",)), "/a/", True, False),
        (PathRules(exclude_names=("b",)), "/a/b", False, True),
        (PathRules(), "/a/b.txt", False, True),
    ],
)
def test_path_rules(spark, rules, path, is_dir, kept):
    df = spark.createDataFrame([(path, is_dir)], "path string, is_dir boolean")
    assert df.select(rules.keeps_path("path", F.col("is_dir"))).first()[0] is kept


def test_diff_statuses(spark):
    prev = listing(spark, [("/f/same", 1500, 1), ("/f/older", 5000, 1), ("/f/newer", 1000, 1),
                           ("/f/gone", 1, 1), ("/f/now.not", 1, 1), ("/f/grown", 1, 1)])
    cur = listing(spark, [("/f/same", 1999, 2), ("/f/older", 1000, 1), ("/f/newer", 2000, 1),
                          ("/f/new", 1, 1), ("/f/now.not", 9000, 1), ("/f/bad.not", 1, 1),
                          ("/f/grown", 9000, 10), ("/f/big", 1, 10)])
    rules = PathRules(exclude_types=("not",), max_size=10)
    got = {r.path: r.status for r in inv.diff(prev, cur, rules).collect()}
    assert got == {
        "/f/same": "unchanged", "/f/older": "unchanged", "/f/newer": "update", "/f/gone": "delete",
        "/f/new": "insert", "/f/now.not": "delete", "/f/bad.not": "reject", "/f/grown": "delete",
        "/f/big": "reject"}


def test_copies_of_a_listed_path_count_once(spark):
    prev = listing(spark, [("/f/a", 1000, 1)])
    cur = listing(spark, [("/f/a", 1000, 1), ("/f/a", 9000, 2), ("/f/b", 1, 1)] + [("/f/a", 5000, 1)] * 50)
    got = sorted((r.path, r.status, r.size) for r in inv.diff(prev, cur).collect())
    assert got == [("/f/a", "update", 2), ("/f/b", "insert", 1)]


def test_zero_times_do_not_hide_presence(spark):
    prev = listing(spark, [("/f/a", None, None)])
    cur = listing(spark, [("/f/a", None, 1), ("/f/b", None, 1)])
    got = {r.path: r.status for r in inv.diff(prev, cur).collect()}
    assert got == {"/f/a": "unchanged", "/f/b": "insert"}


def test_unreadable_is_not_a_delete(spark):
    prev = listing(spark, [("/f/a", 1, 1)])
    cur = listing(spark, [("/f/a", 9000, 1), ("/f/b", 1, 1)]).withColumn("readable", F.lit(False))
    got = {r.path: r.status for r in inv.diff(prev, cur).collect()}
    assert got == {"/f/a": "unchanged", "/f/b": "reject"}


@pytest.mark.parametrize("seed", range(3))
def test_applying_the_diff_gives_the_current_listing(spark, seed):
    rng = random.Random(seed)

    def rows():
        return [(f"/r/{a}/{b}.t", rng.randint(0, 5) * 1000, rng.randint(0, 9))
                for a in range(4) for b in range(6) if rng.random() < 0.6]

    prev, cur = listing(spark, rows()), listing(spark, rows())
    rules = PathRules(exclude_names=(r".*/3\.t",), max_size=8)
    plan = plan_crawl(cur, prev, rules)
    want = cur.where(rules.keeps_entry())
    assert paths(plan.inventory) == paths(want)
    applied = inv.apply_changes(prev, plan.changes)
    assert sorted(map(tuple, applied.collect())) == sorted(map(tuple, inv.surviving(plan.changes).collect()))
    again = plan_crawl(cur, plan.inventory, rules)
    assert set(r.status for r in again.changes.collect()) <= {"unchanged", "reject"}
    actions = {r.action for r in plan.documents.collect()}
    assert actions <= {"INSERT", "UPDATE", "DELETE"}


def test_folder_changes_and_cascade(spark):
    prev = listing(spark, [("/r/a/1", 1, 1), ("/r/a/b/2", 1, 1), ("/r/ab/3", 1, 1), ("/r/c/4", 1, 1)])
    cur = listing(spark, [("/r/ab/3", 1, 1), ("/r/c/4", 1, 1), ("/r/d/e/5", 1, 1)])
    before, now = inv.folders_of(prev), inv.folders_of(cur)
    assert paths(inv.new_folders(before, now), "folder") == ["/r/d", "/r/d/e"]
    assert paths(inv.known_folders(before, now), "folder") == ["/r", "/r/ab", "/r/c"]
    gone = inv.gone_folders(before, now)
    assert paths(gone, "folder") == ["/r/a", "/r/a/b"]
    assert paths(inv.below(prev, gone)) == ["/r/a/1", "/r/a/b/2"]
    refused = inv.gone_folders(before, now, PathRules(exclude_names=("/r/c",)))
    assert paths(refused, "folder") == ["/r/a", "/r/a/b", "/r/c"]
    roots = spark.createDataFrame([("/r",), ("/gone",)], "folder string")
    assert paths(inv.missing_roots(roots, now), "folder") == ["/gone"]


def test_cascade_meets_a_hot_folder_and_duplicate_ancestors(spark):
    files = listing(spark, [(f"/r/hot/{i % 3}/{i}", 1, 1) for i in range(300)] + [("/r/x/1", 1, 1)])
    removed = spark.createDataFrame([("/r/hot",), ("/r/hot/1",)], "folder string")
    assert inv.below(files, removed).count() == 300


def test_folder_became_a_file(spark):
    prev = spark.createDataFrame([("/r/x", True), ("/r/y", True), ("/r/z", False)], "path string, is_dir boolean")
    cur = spark.createDataFrame(
        [("/r/x", False), ("/r/y", True), ("/r/z", False)], "path string, is_dir boolean")
    got = inv.folder_to_file(prev, cur).collect()
    assert [(r.path, r.action) for r in got] == [("/r/x", "INSERT")]
    refused = inv.folder_to_file(prev, cur, PathRules(exclude_names=(".*/x",))).first()
    assert refused.action == "REJECT"


def test_leaf_folders_use_true_ancestors(spark):
    index = spark.createDataFrame(
        [("/a/b/1.txt",), ("/a/bc/2.txt",), ("/a/3.txt",), ("noslash",), ("/a/b/d/4",)], "id string")
    assert paths(inv.parent_folders(index, "id"), "folder") == ["/a", "/a/b", "/a/b/d", "/a/bc"]
    tasks = sorted((r.id, r.level) for r in inv.recovery_tasks(index).collect())
    assert tasks == [("/a/b/d/", 99), ("/a/bc/", 99)]
    single = spark.createDataFrame([("/a/b/1.txt",)], "id string")
    assert inv.recovery_tasks(single).first().id == "/a/b/"


def test_recovery_rows(spark):
    index = spark.createDataFrame([("/a/1", "2020-01-01T00:00:00Z"), ("/a/2", "?")], "id string, last_modified string")
    assert sorted(tuple(r) for r in inv.recovery_rows(index).collect()) == [("/a/1", 1577836800000), ("/a/2", 0)]


def test_tasks_hold_the_depth_below_the_root(spark):
    folders = spark.createDataFrame([("/r",), ("/r/a",), ("/r/a/b",)], "folder string")
    got = {r.id: r.level for r in inv.tasks(folders, root="/r").collect()}
    assert got == {"/r/": 0, "/r/a/": 1, "/r/a/b/": 2}
    assert inv.task_json(inv.tasks(folders, 0)).where("id = '/r/'").first().task == '{"id":"/r/","level":0}'


def test_newest_per_path(spark):
    rows = listing(spark, [("/a", 1, 1), ("/a", 3, 2), ("/a", 3, 1), ("/b", 1, 1)])
    assert sorted((r.path, r.last_modified_ms, r.size) for r in inv.newest_per_path(rows).collect()) == [
        ("/a", 3, 2), ("/b", 1, 1)]


def test_listing_real_files(spark, tmp_path):
    for name, text in (("x/a.txt", "12345"), ("x/y/b é.txt", "1"), ("x/c.bin", "12")):
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(text)
    rows = {r.name: (r.parent, r.size) for r in list_files(spark, str(tmp_path)).collect()}
    assert rows == {"a.txt": (f"{tmp_path}/x", 5), "b é.txt": (f"{tmp_path}/x/y", 1), "c.bin": (f"{tmp_path}/x", 2)}
    bodies = {r.path.rsplit("/", 1)[1]: r.content for r in read_bodies(spark, str(tmp_path), 4).collect()}
    assert bodies == {"a.txt": None, "b é.txt": b"1", "c.bin": b"12"}


def test_body_caps(spark):
    df = spark.createDataFrame([("abc",), ("abcd",), (None,)], "b string")
    assert [r[0] for r in df.select(capped_body("b", 3)).collect()] == ["abc", None, None]
    flags = spark.createDataFrame([(False, 5), (True, 5), (None, 0), (False, 11)], "s boolean, n bigint")
    assert [r[0] for r in flags.select(has_indexable_content(F.col("s"), F.col("n"), 10)).collect()] == [
        True, False, False, False]


def test_patterns_are_judged_by_the_engine_that_runs_them(spark):
    rules = PathRules(exclude_names=(r".*/\p{Lu}[^/]*", r"/x/a*+b", "(broken", "(?P<python>x)"))
    df = spark.createDataFrame([("/x/Upper",), ("/x/lower",), ("/x/aab",), ("/x/xx",)], "path string")
    kept = sorted(r.path for r in df.where(rules.keeps_name("path")).collect())
    assert kept == ["/x/lower", "/x/xx"] and rules.dropped == ("(broken", "(?P<python>x)")


def test_folders_that_cannot_be_read_and_empty_ones(spark):
    def rows(names):
        return inv.as_inventory(spark.createDataFrame([(n, 1000, 1) for n in names], "path string, last_modified_ms bigint, size bigint"))

    stored = rows(["/r/a/1", "/r/b/c/2", "/r/d/3", "/r/e/4"])
    now = rows(["/r/a/1"]).withColumn("readable", F.lit(True))
    folder = spark.createDataFrame([("/r/b", "/r", "b", True, 0, 0, False), ("/r/d", "/r", "d", True, 0, 0, True)], now.schema)
    now = now.unionByName(folder)
    status = {r.path: r.status for r in inv.diff(stored, now).collect()}
    assert status == {"/r/a/1": "unchanged", "/r/b/c/2": "unchanged", "/r/d/3": "delete", "/r/e/4": "delete"}
    plan = plan_crawl(now, stored)
    assert [r.folder for r in plan.gone_folders.collect()] == ["/r/e"]
    assert sorted(r.path for r in plan.inventory.collect()) == ["/r/a/1", "/r/b/c/2"]
    roots = spark.createDataFrame([("/r/d",), ("/gone",)], "folder string")
    assert [r.folder for r in inv.missing_roots(roots, inv.folders_of(now)).collect()] == ["/gone"]


def test_a_body_beyond_the_cap_is_a_row_without_content(spark, tmp_path):
    (tmp_path / "small.txt").write_text("abc")
    (tmp_path / "large.txt").write_text("x" * 50)
    rows = {r.path.rsplit("/", 1)[1]: (r.length, r.content) for r in read_bodies(spark, str(tmp_path), cap=10).collect()}
    assert rows == {"small.txt": (3, b"abc"), "large.txt": (50, None)}


def test_one_pass_over_the_lines_gives_both_listings(spark, tmp_path):
    rows = [(p, s, n, q, f, d) for p in (1, 2, None) for s in ("F", None) for n in (1, 2)
            for q, f, d in ((3.0, "N", "1998-05-01"), (3.0, "A", "1998-05-01"), (None, "N", "1998-07-01"), (5.0, "RNA"[n], "2000-01-01"),
                            (7.0, "N", None))][:-7]
    lines = spark.createDataFrame(rows * 2, "l_partkey long, l_linestatus string, l_linenumber int, l_quantity double, l_returnflag string, d string")
    lines.withColumn("l_shipdate", F.col("d").cast("timestamp_ntz")).drop("d").write.parquet(f"{tmp_path}/lineitem.parquet")
    before, now = folders._listings(spark, str(tmp_path))
    for got, want in ((before, folders._listing(spark, str(tmp_path), folders._DAY)), (now, folders._listing(spark, str(tmp_path)))):
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 2


@pytest.mark.parametrize("name", ["digest_diff", "cascade_intervals", "changed_folders"])
def test_lines_are_not_read_again(spark, name):
    text = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in text
