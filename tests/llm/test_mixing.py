"""Curriculum mixing, whitening and ranked search: whole queries and odd input against brute force."""

import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import ball_tree, curriculum, whitening
from tidemark.llm import queries as q
from tidemark.llm.common import prepare

from .conftest import MIDDLE, SMALL, ascii_lower

FLAT = ((0.0, 1.0), (1.0, 1.0))


# ----------------------------------------------------------------- mixing


def fair(sizes, weights, budget, cap):
    """Targets by exact fractions: caps are set one round after the other."""
    capped = set()
    while True:
        open_ = [i for i in range(len(sizes)) if i not in capped]
        left = budget - sum(cap * sizes[i] for i in capped)
        total = sum(weights[i] for i in open_)
        rate = Fraction(left) / total if total else Fraction(0)
        over = {i for i in open_ if rate * weights[i] > cap * sizes[i]}
        if not over:
            return [cap * sizes[i] if i in capped else rate * weights[i] for i in range(len(sizes))]
        capped |= over


@pytest.mark.parametrize("sizes, weights", [
    ([100, 100, 100], [3, 1, 2]), ([10, 1000, 1000], [3, 1, 2]), ([1, 2, 400, 3], [3, 1, 2, 3]), ([5], [3]), ([0, 7], [3, 1]),
])
def test_targets_are_shares_up_to_their_caps(spark, sizes, weights):
    rows = [(i, s, w * curriculum.UNIT) for i, (s, w) in enumerate(zip(sizes, weights))]
    df = spark.createDataFrame(rows, "_source int, _size long, _weight long")
    got = [r["_target"] for r in curriculum.with_targets(df, 1.5, 2.0).orderBy("_source").collect()]
    assert got == pytest.approx([float(x) for x in fair(sizes, weights, Fraction(3, 2) * sum(sizes), 2)])


@pytest.mark.parametrize("knots", [*q.MIX_SCHEDULES, ((0, 0), (0.25, 4), (0.5, 0), (0.75, 0), (1, 2))])
def test_inverse_of_the_demand(spark, knots):
    whole = curriculum.integral(knots)
    assert whole == pytest.approx(np.trapezoid([w for _, w in knots], [t for t, _ in knots]))
    linear = F.array(*[F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(("start", "weight", "slope", "before"), p)])
                       for p in curriculum.pieces(knots)])
    df = spark.range(1000).select((F.col("id") / 1000.0 * whole).alias("y")).select("y", curriculum.inverse(linear, F.col("y")).alias("t"))
    fine = np.linspace(0, 1, 100_001)
    demand = np.r_[0, np.cumsum((np.interp(fine, *zip(*knots))[1:] + np.interp(fine, *zip(*knots))[:-1]) / 2 * np.diff(fine))]
    for y, t in df.collect():
        assert 0 <= t <= 1 and np.interp(t, fine, demand) == pytest.approx(y, abs=1e-6)


def test_bad_schedules_are_refused():
    for knots in ([], [(0, 1)], [(0, 1), (0.5, 1)], [(0, 1), (1, -1)]):
        with pytest.raises(ValueError):
            curriculum.pieces(knots)


def test_mix_follows_targets_and_schedules(spark):
    docs = q.table(spark, MIDDLE, "documents")
    planned = curriculum.plan(docs, q.MIX_SCHEDULES).cache()
    rows = planned.collect()
    words = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs.collect()}
    by_source = defaultdict(list)
    for r in rows:
        assert r["size"] == words[r["doc_id"]]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == sum(t["words"] for t in r["takes"])
        by_source[r["source"]].append(r)
    assert sum(r["taken"] for r in rows) == pytest.approx(1.5 * sum(r["size"] for r in rows), abs=len(by_source))
    for rank, (_, mine) in enumerate(sorted(by_source.items())):
        target = mine[0]["target"]
        assert sum(r["size"] for r in mine) == mine[0]["source_size"]
        assert abs(sum(r["taken"] for r in mine) - target) <= 0.5
        # At every position the words taken so far follow the integral of the schedule.
        takes = sorted((t["position"], t["words"]) for r in mine for t in r["takes"])
        total, so_far = curriculum.integral(q.MIX_SCHEDULES[rank % 3]), 0
        (_, w), (_, v) = q.MIX_SCHEDULES[rank % 3]
        for position, taken in takes:
            demand = (w * position + (v - w) / 2 * position**2) / total * target
            assert demand == pytest.approx(so_far, abs=1e-3)
            so_far += taken
    mix = curriculum.mixed(planned).select("doc_id", "copy", "position", "words", F.spark_partition_id().alias("p")).collect()
    assert [r["position"] for r in mix] == sorted(r["position"] for r in mix)
    assert sum(r["words"] for r in mix) == sum(r["taken"] for r in rows)
    again = curriculum.plan(docs.repartition(7), q.MIX_SCHEDULES)
    assert Counter(map(str, again.collect())) == Counter(map(str, rows))


def test_mix_of_odd_documents(spark):
    prepare(spark)
    rows = [(1, "a b c", None), (1, "a b c", None), (None, None, "s"), (2, "", "s"), (3, " \n", "t"), (4, "x " * 50_000, "t"),
            (5, "é è ü", "Z"), (6, "one", "empty")]
    clash = ["size", "target", "taken", "takes", "source_size", "_row", "_n", "_source", "_s", "position", "_before", "_slice"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("own") for c in clash})
    got = curriculum.plan(docs, q.MIX_SCHEDULES)
    assert set(got.columns) == set(docs.columns) - {"text"}
    found = got.collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in found) == sorted(
        (str(d), len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, _ in rows)
    assert all(r["_row"] == "own" and r["_n"] == "own" and r["_s"] == "own" for r in found)
    assert all(not r["takes"] and r["taken"] == 0 for r in found if r["size"] == 0)
    assert {r["source"]: r["target"] for r in found}["empty"] <= 2
    assert curriculum.mixed(got).count() >= 4
    assert curriculum.plan(docs.limit(0), q.MIX_SCHEDULES).collect() == []
    assert {r["taken"] for r in curriculum.plan(docs.filter("doc_id in (2, 3)"), [FLAT]).collect()} == {0}


# ----------------------------------------------------------------- whitening


@pytest.mark.parametrize("d", [1, 2, 5, 33, 64])
def test_components_are_eigenvectors(d):
    rng = np.random.default_rng(d)
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    for values in (rng.random(d), np.round(rng.random(d) * 3), np.zeros(d), 10.0 ** -np.arange(d), np.r_[1e9, np.ones(d - 1)]):
        a = (turn * values) @ turn.T
        a = (a + a.T) / 2
        for wanted in (None, 2):
            e, v = whitening.components(a, wanted)
            want = np.sort(np.linalg.eigvalsh(a))[::-1][:wanted]
            scale = max(1e-300, np.abs(a).max()) * d
            assert np.abs(e - want).max() <= 1e-13 * scale
            assert np.abs(v.T @ v - np.eye(v.shape[1])).max() <= 1e-12
            assert np.abs(a @ v - v * e).max() <= 1e-13 * scale


def test_polar_factor_is_orthogonal_and_leaves_a_positive_rest():
    rng = np.random.default_rng(7)
    for spread in (0, 3, 9):
        turn = np.linalg.qr(rng.standard_normal((20, 20)))[0]
        a = (turn * (np.where(rng.random(20) < 0.5, -1, 1) * 10.0 ** (-spread * rng.random(20)))) @ turn.T
        a = (a + a.T) / 2
        u = whitening.polar(a)
        assert np.abs(u @ u - np.eye(20)).max() < 1e-12
        assert np.linalg.eigvalsh(u @ a).min() > -1e-12


def whitened_by_hand(rows, k=4):
    """``{index: [values]}`` and the rest, from the definition, with numpy's own eigenvectors."""
    whole = {i: tuple(math.floor(256 * float(c)) for c in v) for i, v in enumerate(rows)
             if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    fit = sorted(set(whole.values()))
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    apart = np.array([[float(Fraction(n * x[j] - sums[j], n)) for j in range(d)] for x in fit])
    cov = apart.T @ apart / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    out = {}
    for i, x in whole.items():
        centred = np.array([float(Fraction(n * x[j] - sums[j], n)) for j in range(d)])
        out[i] = (sum((n * x[j] - sums[j]) ** 2 for j in range(d)), centred @ v / np.sqrt(e))
    return n, e / np.trace(cov), out


@pytest.mark.parametrize("data", [SMALL, MIDDLE])
def test_whitening(spark, data):
    source = q.table(spark, data, "embeddings").select("vec_id", "embedding").collect()
    ids = [r["vec_id"] for r in source]
    assert len(set(ids)) == len(ids)
    n, explained, want = whitened_by_hand([r["embedding"] for r in source])
    got = defaultdict(dict)
    for r in q.QUERIES["op12_whitening"](spark, data).collect():
        got[ids.index(r["vec_id"])][r["component"]] = r
    assert set(got) == set(want)
    signs = None
    for i, (deviation, values) in want.items():
        assert sorted(got[i]) == [1, 2, 3, 4] and {r["n"] for r in got[i].values()} == {n}
        assert {r["deviation"] for r in got[i].values()} == {deviation}
        mine = np.array([got[i][c]["whitened"] for c in range(1, 5)])
        if signs is None:
            signs = np.sign(mine) * np.sign(values)
        assert mine == pytest.approx(values * signs, rel=1e-7, abs=1e-9)
        assert [got[i][c]["explained"] for c in range(1, 5)] == pytest.approx(list(explained), rel=1e-9)
        assert {r["identity_error"] < 1e-10 for r in got[i].values()} == {True}


VECTORS = "vec_id long, embedding array<double>, n string, _x string, component string"


def test_whitening_of_odd_vectors(spark):
    prepare(spark)
    inf = float("inf")
    good = [[1.0, 2.0], [1.0, 2.0], [3.0, -1.0], [0.5, 0.25], [-0.0, 1e-3]]
    odd = [None, [], [1.0, None], [float("nan"), 1.0], [inf, 0.0], [1.0, 2.0, 3.0]]
    rows = [(i % 4 or None, v, "own", "own", "own") for i, v in enumerate(good + odd)]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS))
    assert got.columns == ["vec_id", "_x", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    n, explained, want = whitened_by_hand(good)
    found = got.collect()
    assert n == 4 and len(found) == 2 * len(good)
    assert sorted(r["deviation"] for r in found) == sorted(2 * [w[0] for w in want.values()])
    for c in (1, 2):
        assert sorted(abs(r["whitened"]) for r in found if r["component"] == c) == pytest.approx(
            sorted(abs(w[1][c - 1]) for w in want.values()))


def test_whitening_without_variance(spark):
    prepare(spark)
    same = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], "", "", ""), (2, [1.0, 2.0], "", "", "")], VECTORS)).collect()
    assert len(same) == 4 and {(r["n"], r["deviation"], r["whitened"], r["identity_error"]) for r in same} == {(1, 0, None, None)}
    line = [(i, [float(i), 1.0, 2.0 * i], "", "", "") for i in range(5)]
    flat = whitening.whiten(spark.createDataFrame(line, VECTORS)).collect()
    assert {r["component"] for r in flat if r["whitened"] is not None} == {1}
    assert all(r["explained"] == pytest.approx(float(r["component"] == 1), abs=1e-12) for r in flat)
    assert whitening.whiten(spark.createDataFrame([(1, None, "", "", "")], VECTORS)).collect() == []
    large = whitening.whiten(spark.createDataFrame([(1, [3e17, 1.0], "", "", ""), (2, [1.0, 5e17], "", "", "")], VECTORS)).collect()
    assert {r["deviation"] for r in large} == {None} and all(math.isfinite(r["explained"]) for r in large)


# ----------------------------------------------------------------- search


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", ascii_lower(text))


def ranked_by_hand(docs, items, k=10):
    words = [terms(t) for _, t in docs]
    n, length = sum(bool(w) for w in words), sum(map(len, words))
    df = Counter(t for w in words for t in set(w))
    out = []
    for item, text in items:
        query = Counter(terms(text))
        hits = []
        for (doc, _), own in zip(docs, words):
            tf, score = Counter(own), 0
            for term, often in query.items():
                if tf[term]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    m = 100 - 75 + (75 * len(own) * n) // length
                    score += often * w * ((1000000000 * tf[term]) // (1000 * tf[term] + 8 * m))
            if score > 0:
                hits.append((-score, doc is None, doc if doc is not None else 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(hits, key=lambda h: h[:3])[:k], 1)]
    return out


def test_search_of_odd_texts(spark):
    prepare(spark)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "é", "Straße", "東京"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(40)))) for i in range(300)]
    docs += [(7, docs[7][1]), (None, docs[8][1]), (900, docs[8][1]), (901, None), (902, ""), (903, "?!"), (904, "w1 W1-w2 " * 20_000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=6))) for i in range(20)]
    items += [(3, items[3][1]), (50, None), (51, ""), (52, "unknown words only"), (None, "w1 w1 w2"), (53, "straße É")]
    extra = {c: F.lit("own") for c in ("score", "rank", "n", "terms", "d", "t")}
    frames = [spark.createDataFrame(rows, schema).withColumns(extra) for rows, schema in
              ((docs, "doc_id long, text string"), (items, "item_id long, text string"))]
    want = Counter(ranked_by_hand(docs, items))
    for options in ({}, {"block": 16}, {"part_terms": 5}):
        got = ball_tree.search(frames[0].repartition(5), frames[1], **options)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert Counter(tuple(r) for r in got.collect()) == want
    assert ball_tree.search(frames[0].limit(0), frames[1]).collect() == []
    assert ball_tree.search(frames[0], frames[1].limit(0)).collect() == []


def test_tree_leaves_out_subtrees_and_loses_nothing():
    rng = np.random.default_rng(5)
    width, rows = 400, 4096
    topic = rng.integers(0, 40, rows)
    starts, flat, values = [0], [], []
    for t in topic:
        own = np.unique(np.r_[10 * t + rng.integers(0, 10, 8), rng.integers(0, width, 2)])
        flat.append(own)
        values.append(rng.integers(1, 10**9, len(own)))
        starts.append(starts[-1] + len(own))
    block = ball_tree.Block(np.array(starts), np.concatenate(flat), np.concatenate(values))
    tree = ball_tree.BallTree(block, width)
    dense = np.zeros((rows, width), np.int64)
    for i in range(rows):
        dense[i, block.terms[starts[i]:starts[i + 1]]] = block.values[starts[i]:starts[i + 1]]
    leaves = [n for n in tree.nodes if not n.children]
    assert sorted(np.concatenate([n.rows for n in leaves]).tolist()) == list(range(rows))
    queries = np.zeros((40, width), np.int64)
    for t in range(40):
        queries[t, 10 * t:10 * t + 10] = 1
    bounds = tree.bounds(queries.astype(float))
    scores = queries @ dense.T
    for at, node in enumerate(tree.nodes):
        assert (scores[:, node.rows].max(axis=1) <= bounds[:, at]).all()
    visited = 0
    for t in range(40):
        found, mine, seen = tree.search(bounds[t], queries[t], 10, 1)
        tenth = np.sort(scores[t])[-10]
        assert set(np.flatnonzero(scores[t] >= tenth)) <= set(found.tolist())
        assert (mine == scores[t][found]).all()
        visited += seen
    assert visited < 0.5 * 40 * len(leaves)
