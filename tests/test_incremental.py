import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import incremental as inc
from tidemark.operators import numbering
from tidemark.operators.numbering import joined_text, row_number
from tidemark.plans.table_ingest import TableSource, batch_documents, drain, read_batch, run_backlog, run_once
from tidemark.sinks.state import MarkStore, marks_from_lines


@pytest.fixture(scope="module")
def titles(spark):
    rows = [(i, f"File{i - 99}.txt", "This is a title", "Writer") for i in range(100, 105)]
    return spark.createDataFrame(rows, "id int, FILEPATH string, TITLE string, AUTHOR string")


SOURCE = TableSource("titles", "id", ["id"], ["id", "filepath", "title", "author"], path_column="filepath")


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def test_first_read_takes_everything(titles):
    batch = read_batch(titles, SOURCE, 0, inc.batch_cut(titles, "id", 0, SOURCE.batch))
    assert ids(batch) == [100, 101, 102, 103, 104]
    assert inc.next_mark(batch, "id", 0).first().hwm == 104


def test_documents_of_a_batch(titles):
    doc = batch_documents(read_batch(titles, SOURCE, 103, 104), SOURCE).first()
    assert (doc.id, doc.source, doc.temp_path) == ("104", "JDBC://titles", "File5.txt")
    assert doc.fields["title"] == ["This is a title"]


def test_mark_is_strict_and_combines_with_where(titles):
    assert ids(inc.next_batch(titles, "id", 102)) == [103, 104]
    assert ids(inc.next_batch(titles, "id", 101, where="id <> 103")) == [102, 104]


def test_empty_batch_keeps_the_mark(titles):
    batch = inc.next_batch(titles, "id", 104)
    assert batch.count() == 0
    assert tuple(inc.next_mark(batch, "id", 104).first()) == (104, 0)


def test_batch_goes_on_through_ties(spark):
    df = spark.createDataFrame([(m, i) for i, m in enumerate([1, 2, 2, 2, 3])], "m int, i int")
    assert ids(inc.next_batch(df, "m", 0, 2), "m") == [1, 2, 2, 2]


@pytest.mark.parametrize("value, size", [("7", 7), (0, 1000), (-1, 1000), ("x", 1000), (None, 1000)])
def test_batch_size(value, size):
    assert inc.batch_size(value) == size


def test_null_keys_are_dropped_and_counted(spark):
    df = spark.createDataFrame([(1, None), (None, None), (None, "b")], "a int, b string")
    assert inc.usable_keys(df, ["a", "b"]).count() == 2
    assert tuple(inc.null_key_count(df, ["a", "b"]).first()) == (1, 3)


def test_drain_reads_every_row_once(spark, tmp_path):
    rows = [(i, f"t{i}") for i in random.Random(1).sample(range(1, 1000), 60)]
    table = spark.createDataFrame(rows, "id int, title string")
    marks = MarkStore(spark, str(tmp_path / "marks"))
    source = TableSource("t", "id", ["id"], batch=25)
    assert drain(table, source, marks, str(tmp_path / "out")) == 3
    written = spark.read.json(str(tmp_path / "out/t/*"))
    assert sorted(int(r.id) for r in written.collect()) == sorted(i for i, _ in rows)
    assert marks.get("t") == max(i for i, _ in rows)
    assert run_once(table, source, marks, str(tmp_path / "out")) == (0, marks.get("t"))


def test_stopped_run_is_repeated_from_the_old_mark(spark, tmp_path):
    table = spark.createDataFrame([(i, "x") for i in range(1, 11)], "id int, title string")
    source = TableSource("t", "id", ["id"], batch=4)
    marks = MarkStore(spark, str(tmp_path / "marks"))

    class Stopped(MarkStore):
        def save_one(self, *_):
            raise RuntimeError("stopped before the mark was saved")

    with pytest.raises(RuntimeError):
        run_once(table, source, Stopped(spark, marks.path), str(tmp_path / "out"))
    run_once(table, source, marks, str(tmp_path / "out"))
    written = spark.read.json(str(tmp_path / "out/t/*"))
    assert sorted(int(r.id) for r in written.collect()) == [1, 2, 3, 4]


def test_planned_batches_cover_every_row_once(spark):
    rng = random.Random(3)
    values = [rng.randint(1, 40) for _ in range(200)] + [20] * 100
    df = spark.createDataFrame([(v,) for v in values], "m int").repartition(5)
    plan = inc.plan_batches(df, "m", 0, 30).orderBy("batch").collect()
    assert sum(r.rows for r in plan) == len(values)
    for earlier, later in zip(plan, plan[1:]):
        assert earlier.last_mark < later.first_mark
    for r in plan:
        assert r.rows == sum(r.first_mark <= v <= r.last_mark for v in values)


def test_row_number_with_a_hot_key(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), rng.randint(0, 9), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, o int, i int").repartition(4)
    got = row_number(df, ["k"], ["o"], "n").collect()
    assert sorted((r.k or "", r.o, r.i) for r in got) == sorted((k or "", o, i) for k, o, i in rows)
    for key in {r.k for r in got}:
        group = sorted((r.n, r.o) for r in got if r.k == key)
        assert [n for n, _ in group] == list(range(1, len(group) + 1))
        assert [o for _, o in group] == sorted(o for _, o in group)


@pytest.mark.parametrize("piece", [10_000, 10])
def test_text_holds_every_value_in_order(spark, monkeypatch, piece):
    monkeypatch.setattr(numbering, "PIECE", piece)
    rows = [("a", i, f"v{i}") for i in range(25)] + [("b", 0, "only")] + [("c", 1, "same")] * 12
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(3)
    text = {r.k: (r.n_values, r.text) for r in joined_text(df, ["k"], ["o"], "v", "|", "text").collect()}
    assert text == {"a": (25, "|".join(f"v{i}" for i in range(25))), "b": (1, "only"), "c": (12, "|".join(["same"] * 12))}


def test_recent_is_inclusive_and_defaults_to_zero(spark):
    docs = spark.createDataFrame([("a", 9), ("a", 10), ("a", 11), ("b", 0)], "s string, m bigint")
    marks = spark.createDataFrame([("a", 10)], "source string, hwm bigint")
    got = sorted((r.s, r.m) for r in inc.recent(docs, marks, "s", "m").collect())
    assert got == [("a", 10), ("a", 11), ("b", 0)]


def test_pages_follow_each_other(spark):
    rng = random.Random(7)
    rows = [(i, rng.randint(0, 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, m int")
    seen, after = [], None
    while True:
        page = inc.page(df, "m", "id", after).collect()
        seen += [(r.id, r.m) for r in page]
        if len(page) < 25:
            break
        after = (page[-1].m, page[-1].id)
    assert seen == sorted(rows, key=lambda r: (-r[1], r[0]))


def test_mark_store_keeps_the_newest_run(spark, tmp_path):
    marks = MarkStore(spark, str(tmp_path / "m"))
    assert marks.get("a") == 0
    marks.save_one("a", 7, 1)
    marks.save_one("a", 5, 2)
    marks.save_one("b", 1, 1)
    assert (marks.get("a"), marks.get("b"), marks.get("c")) == (5, 1, 0)


def test_mark_lines(spark):
    lines = spark.createDataFrame([("lib:123",), ("no colon",), (":5",)], "value string")
    assert [tuple(r) for r in marks_from_lines(lines).collect()] == [("lib", 123)]


def test_class_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "s string, c int")
    assert sorted(tuple(r) for r in inc.count_per(df, "s", "c").collect()) == [("a", 1, 2), ("b", 2, 1)]
    assert inc.count_per(df, "s").agg(F.sum("n_docs")).first()[0] == 3


def test_backlog_equals_a_drain(spark, tmp_path):
    table = spark.createDataFrame([(i // 2, i) for i in range(2, 40)], "m int, id int")
    source = TableSource("t", "m", ["id"], batch=7)
    read = {}
    for name, run in (("drain", drain), ("backlog", run_backlog)):
        marks = MarkStore(spark, str(tmp_path / name / "marks"))
        marks.save_one("t", 3, 0)
        run(table, source, marks, str(tmp_path / name / "out"))
        rows = spark.read.schema("id string").json(str(tmp_path / name / "out/t/*"))
        read[name] = (sorted(int(r.id) for r in rows.collect()), marks.get("t"))
        assert run_backlog(table, source, marks, str(tmp_path / name / "out")) == (0, 19)
    assert read["drain"] == read["backlog"] == (list(range(8, 40)), 19)
