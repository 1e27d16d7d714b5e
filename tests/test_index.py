import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import headers, index
from tidemark.operators.mapping import FieldMapping, map_fields, map_long
from tidemark.plans.stages import Stage, ordered, run_stages

ENTRIES = [("permissions", "ao_permission", None, True), ("category", "category", None, True),
           ("client", "category", None, False), ("PID_*", None, "TRUE", None), ("plain", "plain_t", None, False)]
KIND = "id string, fields map<string,array<string>>"


def mapped(spark, fields, mapping=None):
    df = spark.createDataFrame([("1", fields)], KIND)
    return map_fields(df, mapping or FieldMapping.of(ENTRIES)).first().index_fields


def test_mapping_rules(spark):
    got = mapped(spark, {
        "permissions": ["a", "b"], "client": ["c"], "category": ["k"], "PID_x": ["1", "2"], "plain": ["p", "q"],
        "_hier_f": ["0/a/", "1/a/b/"], "unknown": ["u"], "title": ["t"], "empty": [], "owner": ["o", "o2"], "ext": ["e"]})
    assert got == {
        "ao_permission": ["a", "b"], "category": ["k", "c"], "PID_x": ["1", "2"], "plain_t": ["p,q"],
        "_hier_f": ["0/a/", "1/a/b/"], "owner": ["o", "o2"], "ext": ["e"]}


def test_multi_is_decided_by_the_target(spark):
    mapping = FieldMapping.of([("x", "tags", None, True), ("tags", "single", None, False)])
    assert mapped(spark, {"x": ["1", "2"]}, mapping) == {"tags": ["1", "2"]}
    assert mapped(spark, {"tags": ["1", "2"]}, mapping) == {"single": ["1,2"]}


def test_a_field_already_set_as_a_target_is_not_sent_again(spark):
    mapping = FieldMapping.of([("a", "b", None, False), ("b", "c", None, False)])
    assert mapped(spark, {"a": ["1"], "b": ["2"]}, mapping) == {"b": ["1"]}
    assert mapped(spark, {"b": ["2"]}, mapping) == {"c": ["2"]}


def test_mapping_file(spark, tmp_path):
    path = tmp_path / "map.json"
    path.write_text(json.dumps({"iDoc2Solr": [
        {"idocField": "a", "solrField": "b", "multi": True}, {"idocField": "PID_*", "dynamicSolrFieldType": "true"}]}, indent=1))
    mapping = FieldMapping.load(spark, str(path))
    assert mapping.targets["a"] == "b" and "b" in mapping.multi and mapping.prefixes == ("PID_",)
    with pytest.raises(ValueError):
        FieldMapping.of([("a", None, None, None)])
    with pytest.raises(ValueError):
        FieldMapping.of([(None, "b", None, None)])


def test_long_form_mapping(spark):
    long = spark.createDataFrame([("1", "a", 0, "x"), ("1", "_hier_q", 0, "y"), ("1", "z", 0, "w")],
                                 "id string, field string, pos int, value string")
    table = spark.createDataFrame([("a", "b", True)], "source string, target string, multi boolean")
    got = sorted((r.field, r.target or "", r.multi) for r in map_long(long, table).collect())
    assert got == [("_hier_q", "_hier_q", True), ("a", "b", True), ("z", "", False)]


def sequential(target, actions):
    """Apply actions one by one, in order."""
    state = dict(target)
    for ident, action, at, seq, content in sorted(actions, key=lambda a: (a[2], a[3])):
        kind = action.upper()
        if kind == "DELETE":
            state.pop(ident, None)
        elif kind == "UPDATE" and ident in state:
            state[ident] = (at, state[ident][1])
        else:
            state[ident] = (at, content)
    return state


@pytest.mark.parametrize("seed", range(4))
def test_actions_match_a_sequential_run(spark, seed):
    rng = random.Random(seed)
    target = {i: (0, f"old{i}") for i in range(8)}
    actions = [(0 if rng.random() < 0.4 else rng.randint(0, 15), rng.choice(["insert", "Update", "UPDATE", "DELETE", "new"]),
                rng.randint(1, 30), n, f"c{n}") for n in range(120)]
    old = spark.createDataFrame([(k, *v) for k, v in target.items()], "id int, last_modified int, content string")
    new = spark.createDataFrame(actions, "id int, action string, at int, seq int, content string").repartition(4)
    got = index.apply_actions(old, new, "id", "action", "at", ["at", "seq"], ["content"])
    assert {r.id: (r.last_modified, r.content) for r in got.collect()} == sequential(target, actions)


def test_applying_twice_changes_nothing(spark):
    old = spark.createDataFrame([(1, 0, "a"), (2, 0, "b")], "id int, last_modified int, content string")
    new = spark.createDataFrame([(1, "UPDATE", 5, "x"), (2, "DELETE", 6, None), (3, "INSERT", 7, "c")],
                                "id int, action string, at int, content string")
    def step(rows):
        return index.apply_actions(rows, new, "id", "action", "at", ["at"], ["content"])
    once, twice = step(old), step(step(old))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, 5, "a"), (3, 7, "c")]


def test_latest_action_and_deletes(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "id int, action string, at int")
    assert sorted(map(tuple, index.latest_action(df, "id", ["at"]).collect())) == [(1, "b", 2), (2, "c", 1)]
    assert [r.id for r in index.delete_ids(df, df.where("at = 2")).collect()] == [2]


def test_core_record(spark):
    kind = ("id string, url string, title string, mime string, parent_id string, size bigint, last_modified_ms bigint, "
            "source string, child_ids array<string>, is_stub boolean, body string")
    rows = [("1", None, "t", "m", None, 3, 0, "s", ["a", "b"], False, "x"), ("2", "u", None, None, "p", 0, None, None, [], True, "x"),
            ("3", None, None, None, None, 0, None, None, None, None, "y")]
    got = index.core_record(spark.createDataFrame(rows, kind)).collect()
    assert got[0].last_modified == got[0].last_modified_date_s == "1970-01-01T00:00:00Z"
    assert [r.child_ids for r in got] == ["a,b", None, None]
    assert [r["_text_"] for r in got] == ["x", None, "y"]


HEADER = "id string, fields map<string,array<string>>, is_stub boolean, size bigint, last_modified_ms bigint, body string"


def test_header_records(spark):
    rows = [("1", {"b": ["2", "3\\n"], "a": ["1"]}, False, 5, 60000, "text"), ("2", {"indexname": ["own", "x"]}, True, 5, 0, "text")]
    df = spark.createDataFrame(rows, HEADER)
    first, second = headers.header_records(df, "main").collect()
    assert first.entries == ["a=1", "b=2", "b=3", "indexedContent=true"]
    assert (first["index"], first.body, first.last_modified, first.error) == ("main", "text", "1970-01-01T00:01Z", None)
    assert (second["index"], second.body) == ("own", None)
    assert second.entries[-1] == "indexedContent=false"
    numbered = headers.header_entries(headers.header_records(df, "main")).where("filename = '1'").collect()
    assert [r.meta for r in sorted(numbered, key=lambda r: r.n)] == ["meta1", "meta2", "meta3", "meta4"]
    missing = headers.header_deletes(df).orderBy("filename").collect()
    assert [(r["index"], r.error) for r in missing] == [(None, "no index specified"), ("own", None)]


def test_stage_order_and_delete_bypass(spark):
    def add(df, settings):
        return df.withColumn("log", F.concat("log", F.lit(settings["x"])))

    def twice(df, _):
        return df.union(df)

    stages = [Stage("last", add, None, {"x": "z"}), Stage("b", add, 1, {"x": "b"}), Stage("c", add, 1, {"x": "c"}),
              Stage("all", add, 0, {"x": "a"}, handles_deletes=True), Stage("copy", twice, 2)]
    assert [s.name for s in ordered(stages)] == ["all", "b", "c", "copy", "last"]
    df = spark.createDataFrame([("1", "INSERT", ""), ("2", "delete", ""), ("3", None, "")], "id string, action string, log string")
    assert sorted((r.id, r.log) for r in run_stages(df, stages).collect()) == [
        ("1", "abcz"), ("1", "abcz"), ("2", "a"), ("3", "abcz"), ("3", "abcz")]
    bare = run_stages(df.drop("action"), [Stage("b", add, 1, {"x": "b"})])
    assert {r.log for r in bare.collect()} == {"b"}


def test_schema_of_actions_is_kept(spark):
    old = spark.createDataFrame([], "id bigint, last_modified bigint, content string")
    new = spark.createDataFrame([(1, "UPDATE", 5, "x")], "id bigint, action string, at bigint, content string")
    got = index.apply_actions(old, new, "id", "action", "at", ["at"], ["content"])
    assert [f.dataType for f in got.schema] == [T.LongType(), T.LongType(), T.StringType()]
    assert tuple(got.first()) == (1, 5, "x")


def test_header_runs_add_up(spark, tmp_path):
    def docs(rows):
        return spark.createDataFrame(rows, "id string, is_stub boolean, size bigint, body string, last_modified_ms bigint, "
                                           "fields map<string,array<string>>")

    settings = {"path": str(tmp_path / "h"), "index": "main"}
    table = headers.HeaderTable(spark, settings["path"])
    assert table.read().count() == 0
    first = [(str(i), False, 3, f"b{i}", 60_000, {"a": [f"v{i}"]}) for i in range(4)]
    headers.write_headers(docs(first), settings, 1)
    headers.write_headers(docs([("9", False, 3, "b9", 60_000, {}), ("0", False, 3, "new", 60_000, {})]), settings, 2)
    headers.delete_headers(docs([("1", False, 3, "x", 0, {})]), settings, 3)
    want = {"0": "new", "2": "b2", "3": "b3", "9": "b9"}
    assert {r.filename: r.body for r in table.read().collect()} == want
    headers.delete_headers(docs([("1", False, 3, "x", 0, {})]), settings, 3)
    assert {r.filename: r.body for r in table.read().collect()} == want
    headers.write_headers(docs([first[1]]), settings, 4)
    assert {r.filename for r in table.read().collect()} == {*want, "1"}
