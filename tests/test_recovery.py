"""Recovery from three sides, attempts with a limit, mapping tables and stage configuration."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import inventory as inv
from tidemark.operators import mapping
from tidemark.operators.filters import PathRules
from tidemark.operators.recovery import reconcile
from tidemark.plans.stages import Stage, load_stages, ordered, run_stages
from tidemark.streaming.attempts import stream_attempts


def files(spark, *rows):
    return inv.as_inventory(spark.createDataFrame(list(rows), "path string, last_modified_ms bigint, size bigint"))


def test_every_way_to_disagree(spark):
    index = spark.createDataFrame(
        [("/r/agreed", 1999), ("/r/other", 1000), ("/r/unstored", 5000), ("/r/stale", 1000), ("/r/ghost", 1000),
         ("/r/ghost2", 1000), ("/r/refused.tmp", 1000), ("/r/twice", 500), ("/r/twice", 9000), (None, 1)], "id string, last_modified_ms bigint")
    stored = files(spark, ("/r/agreed", 1200, 1), ("/r/other", 1000, 7), ("/r/lost", 1000, 1), ("/r/stale", 1000, 1),
                   ("/r/ghost2", 800, 3), ("/r/forgotten", 1, 1), ("/r/twice", 9000, 1))
    listing = files(spark, ("/r/agreed", 1500, 1), ("/r/other", 1000, 1), ("/r/unstored", 1000, 1), ("/r/lost", 1000, 1),
                    ("/r/sub/new", 1000, 1), ("/r/stale", 2000, 2), ("/r/refused.tmp", 1000, 1), ("/r/twice", 9000, 1))
    found = reconcile(index, stored, listing, PathRules(exclude_types=("tmp",)))
    got = {r.path.removeprefix("/r/"): (r.kind, r.action) for r in found.merged.collect()}
    assert got == {
        "agreed": ("agreed", None), "other": ("unstored", None), "unstored": ("unstored", None), "lost": ("lost", "INSERT"),
        "sub/new": ("new", "INSERT"), "stale": ("stale", "UPDATE"), "ghost": ("ghost", "DELETE"), "ghost2": ("ghost", "DELETE"),
        "refused.tmp": ("ghost", "DELETE"), "forgotten": ("forgotten", None), "twice": ("agreed", None)}
    assert sorted(r.path for r in found.inventory().collect()) == sorted(
        "/r/" + n for n in ("agreed", "other", "unstored", "lost", "sub/new", "stale", "twice"))
    assert {r.path: r.size for r in found.inventory().collect()}["/r/stale"] == 2
    assert [tuple(r) for r in found.tasks().collect()] == [("/r/sub/", 99)]
    assert found.actions().count() == 6
    # What was recovered agrees with itself afterwards.
    again = reconcile(found.inventory().select(F.col("path").alias("id"), "last_modified_ms"), found.inventory(), found.inventory())
    assert {r.kind for r in again.merged.collect()} == {"agreed"} and again.tasks().count() == 0
    none = spark.createDataFrame([], "id string, last_modified_ms bigint")
    assert reconcile(none, files(spark), files(spark)).merged.count() == 0


def test_attempts_end_by_success_or_limit(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice("abcdefgh"), n, rng.choice([True, False, False, False, None]), f"v{n}") for n in range(90)] + [(None, 91, True, "")]
    schema = "id string, seq long, ok boolean, value string"
    want, failures, settled = [], {}, set()
    for key, seq, ok, _ in rows[:-1]:
        if key in settled:
            continue
        failures[key] = failures.get(key, 0) + (not ok)
        outcome = "done" if ok else "dead" if failures[key] == 3 else "retry"
        settled |= {key} if outcome != "retry" else set()
        want.append((key, seq, outcome))
    for start in range(0, 91, 31):  # each batch is a stream that is started anew
        spark.createDataFrame(rows[start:start + 31], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        stream_attempts(source, f"{tmp_path}/out", f"{tmp_path}/check", limit=3).awaitTermination()
    stream_attempts(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/check", limit=3).awaitTermination()
    got = [(r.id, r.seq, r.outcome) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert sorted(got) == sorted(want) and {o for _, _, o in want} == {"done", "retry", "dead"}


ENTRIES = [("a", "b", None, False), ("b", "c", None, False), ("c", "d", None, True), ("x", "d", None, None), ("p", "p2", None, None),
           ("PID_*", None, "true", None), ("P*", None, "true", None), ("b*", None, "true", None)]


def test_a_mapping_table_does_what_a_mapping_in_the_row_does(spark):
    known = mapping.FieldMapping.of(ENTRIES)
    rng = random.Random(8)
    names = ["a", "b", "c", "x", "p", "PID_1", "Q", "bx", "_hier_z", "id", "title", "d", "d2", "author"]
    rows = [(str(i), {n: [rng.choice(["1", "2", None, "x y"]) for _ in range(rng.randrange(4))] for n in rng.sample(names, rng.randrange(9))})
            for i in range(120)]
    docs = spark.createDataFrame(rows, "id string, fields map<string,array<string>>")
    mapped = mapping.map_fields(docs, known).select("id", F.explode("index_fields").alias("field", "v"))
    want = sorted(tuple(r) for r in mapped.select("id", "field", F.posexplode("v").alias("pos", "value")).collect())
    long = docs.select("id", F.explode("fields").alias("field", "v")).select("id", "field", F.posexplode("v").alias("pos", "value"))
    targets = spark.createDataFrame([(s, t, t in known.multi) for s, t in known.targets.items()], "source string, target string, multi boolean")
    prefixes = spark.createDataFrame([(p,) for p in known.prefixes], "prefix string")
    got = mapping.map_table(long, targets, prefixes)
    assert got.columns == ["id", "field", "pos", "value"]
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 200
    assert mapping.map_table(long.limit(0), targets, prefixes).collect() == []
    only = mapping.map_table(long, targets.limit(0), prefixes.limit(0)).collect()
    assert {r.field for r in only} == {"_hier_z"}


def test_stages_from_a_file(spark, tmp_path):
    path = tmp_path / "stages.json"
    path.write_text(json.dumps({"stages": [
        {"stage": "add", "settings": {"text": "last"}}, {"stage": "add", "priority": 1},
        {"stage": "up", "priority": 1, "settings": {}}, {"stage": "add", "priority": 0, "settings": {"text": "first"}}]}))
    known = {
        "add": Stage("add", lambda df, s: df.withColumn("t", F.concat("t", F.lit(s["text"]))), 7, {"text": "default"}),
        "up": Stage("up", lambda df, s: df.withColumn("t", F.upper("t")))}
    stages = load_stages(spark, str(path), known)
    assert [(s.name, s.priority) for s in ordered(stages)] == [("add", 0), ("add", 1), ("up", 1), ("add", None)]
    assert run_stages(spark.createDataFrame([("-",)], "t string"), stages).first().t == "-FIRSTDEFAULTlast"
    with pytest.raises(ValueError, match="up"):
        load_stages(spark, str(path), {"add": known["add"]})
