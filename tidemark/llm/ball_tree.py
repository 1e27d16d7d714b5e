"""Ranked lexical search: exact inner products by ball trees over sparse document vectors.

A document's score for an item is the inner product of the item's term counts and the
document's impacts, whole numbers made of a term's weight, its occurrences and the
document's length. Every task packs its documents, in blocks of bounded size, into ball
trees: a node has the centroid of its vectors and the largest distance to it, so

    score <= query . centroid + |query| * radius

for all documents below it, where ``|query|`` leaves out terms that none of them has. A search takes the node of the highest bound first, scores
the documents of leaves with whole numbers, and stops where no bound reaches the worst
of the ``k`` best any more. Bounds are doubles raised by more than their rounding error
and a node is only left out where its bound lies below that worst score, so equal
scores are never lost. The best ``k`` of one block are the mark to beat for the next one
of the task; the few rows a task gives are ranked by Spark, in two steps.

Items are the stated query set: they are dealt into parts of at most 5,000 items and
``part_terms`` different terms (a larger single item is a part of its own), and each
part, the only thing broadcast, meets all documents. Documents' vectors over a part's terms are
written once below the shared folder; document counts of the terms are counted from
them by Spark.

Defined results: a null text has no terms; such a document counts for nothing and is
never a hit. An item without terms, or without a document of score above 0, gives no
rows. Repeated documents are hits each, with ranks of their own; equal scores rank by
ascending id, null ids last. Repeated items give their rows each. Empty tables give no
rows. Only the ids of the inputs are kept.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir
from .common import WORD_BYTES

#: Documents in one tree, and in one of its leaves.
BLOCK, LEAF = 4096, 32
#: Groups of tasks in the first ranking.
SHARES = 64
#: Above the rounding of a sum of some thousand products of doubles.
SAFE = 1e-9


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


# ----------------------------------------------------------------- queries


@dataclass
class Part:
    """Items that are searched together: their terms, and each item's terms with counts."""

    terms: dict[bytes, int] = field(default_factory=dict)
    items: list[tuple[object, list[int], list[int]]] = field(default_factory=list)

    def add(self, item: object, counts: Counter) -> None:
        own = [self.terms.setdefault(t, len(self.terms)) for t in sorted(counts)]
        self.items.append((item, own, [counts[t] for t in sorted(counts)]))


def parts_of(items: DataFrame, item_id: str, text: str, part_terms: int, part_items: int = 5_000) -> Iterator[Part]:
    """Items in parts; the driver holds one part and one item at a time."""
    part = Part()
    for item, words in items.select(item_id, F.col(text).cast("binary")).toLocalIterator():
        counts = Counter(terms_of(bytes(words) if words is not None else None))
        if not counts:
            continue
        full = len(part.items) >= part_items or len(part.terms) + sum(t not in part.terms for t in counts) > part_terms
        if part.items and full:
            yield part
            part = Part()
        part.add(item, counts)
    if part.items:
        yield part


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# ----------------------------------------------------------------- document vectors


def add_vectors(docs: DataFrame, part: Part, doc_id: str, text: str) -> DataFrame:
    """``(d, n, terms, times)``: id, number of terms, and the part's terms in the document with their occurrences."""
    shared = docs.sparkSession.sparkContext.broadcast(part.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            lengths, starts, terms, times = [], [0], [], []
            for value in batch.column(1):
                words = terms_of(value.as_py())
                found = Counter([known[w] for w in words if w in known])
                lengths.append(len(words))
                terms.extend(found.keys())
                times.extend(found.values())
                starts.append(len(terms))
            offsets = pa.array(starts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))], names=["d", "n", "terms", "times"])

    schema = T.StructType([
        T.StructField("d", docs.schema[doc_id].dataType), T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("times", T.ArrayType(T.IntegerType()))])
    return docs.select(F.col(doc_id).alias("d"), F.col(text).cast("binary").alias("t")).mapInArrow(run, schema)


def impacts(weights: np.ndarray, times: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Whole-number impact of each entry; ``lengths`` are those of the entries' documents."""
    m = 100 - 75 + (75 * lengths * n_docs) // n_terms
    return weights * ((1_000_000_000 * times) // (1000 * times + 8 * m))


# ----------------------------------------------------------------- trees


@dataclass
class Block:
    """Sparse vectors in rows: row ``i`` has entries ``starts[i]:starts[i + 1]``."""

    starts: np.ndarray
    terms: np.ndarray
    values: np.ndarray  # whole numbers

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' entries, and for each the row's place in ``rows``."""
        counts = self.starts[rows + 1] - self.starts[rows]
        ends = np.cumsum(counts)
        places = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[rows] - (ends - counts), counts)
        return places, np.repeat(np.arange(len(rows)), counts)


@dataclass
class Node:
    rows: np.ndarray
    children: tuple[int, int] | None = None


class BallTree:
    """Balls over the rows of a block; children divide a ball by its two poles."""

    def __init__(self, block: Block, n_terms: int, leaf: int = LEAF):
        self.block = block
        self.nodes: list[Node] = []
        values = block.values.astype(np.float64)
        row_of = np.repeat(np.arange(len(block.starts) - 1), np.diff(block.starts))
        self.norms = np.bincount(row_of, values * values, minlength=len(block.starts) - 1)
        centroids, radii = [], []
        open_ = [np.arange(len(block.starts) - 1)]
        where: list[tuple[int, int]] = [(-1, 0)]  # parent and side of each open node
        while open_:
            rows, (parent, side) = open_.pop(), where.pop()
            at = len(self.nodes)
            self.nodes.append(Node(rows))
            if parent >= 0:
                left, right = self.nodes[parent].children or (0, 0)
                self.nodes[parent].children = (at, right) if side == 0 else (left, at)
            places, inside = block.entries(rows)
            terms, own = block.terms[places], values[places]
            centre = np.bincount(terms, own, minlength=n_terms) / len(rows)
            apart = self._apart(rows, terms, own, inside, centre)
            centroids.append(centre)
            # The distance is raised by far more than the rounding of its squares, which are as large as the norms.
            scale = float(self.norms[rows].max()) + float(centre @ centre)
            radii.append(math.sqrt(max(0.0, float(apart.max())) + SAFE * scale))
            if len(rows) <= leaf or float(apart.max()) <= SAFE * scale:
                continue
            # One pole is the row furthest from the centre, the other the row furthest from it.
            first = self._apart(rows, terms, own, inside, self._dense(rows[int(apart.argmax())], n_terms))
            second = self._apart(rows, terms, own, inside, self._dense(rows[int(first.argmax())], n_terms))
            near = first < second
            for _ in range(2):  # the halves' own centres divide better than two rows at the rim
                if near.any() and not near.all():
                    means = [np.bincount(terms[near[inside] == side], own[near[inside] == side], minlength=n_terms)
                             / max(1, int((near == side).sum())) for side in (True, False)]
                    near = self._apart(rows, terms, own, inside, means[0]) < self._apart(rows, terms, own, inside, means[1])
            if not near.any() or near.all():
                near = np.arange(len(rows)) < len(rows) // 2
            open_ += [rows[~near], rows[near]]
            where += [(at, 1), (at, 0)]
        self.centroids, self.radii = np.array(centroids), np.array(radii)

    def _dense(self, row: int, n_terms: int) -> np.ndarray:
        own = slice(self.block.starts[row], self.block.starts[row + 1])
        dense = np.zeros(n_terms)
        dense[self.block.terms[own]] = self.block.values[own]
        return dense

    def _apart(self, rows, terms, own, inside, point) -> np.ndarray:
        """Squared distance of the rows from a point."""
        dots = np.bincount(inside, own * point[terms], minlength=len(rows))
        return self.norms[rows] - 2.0 * dots + float(point @ point)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of the scores of each query (row) below each node (column)."""
        # Terms that no vector below a node has add nothing, so the query's length counts without them.
        lengths = np.sqrt((queries * queries) @ (self.centroids > 0).T)
        return (queries @ self.centroids.T + lengths * self.radii) * (1.0 + SAFE) + 1.0

    def search(self, bounds: np.ndarray, query: np.ndarray, k: int, mark: int) -> tuple[np.ndarray, np.ndarray, int]:
        """``(rows, scores, leaves seen)``: at least all rows among the ``k`` best that score ``mark`` or more.

        ``query`` is dense and whole; ``mark`` is 1 or more. Rows tied with the ``k``-th are all given.
        """
        rows_found, scores_found = [], []
        best: list[int] = []  # the k best scores, worst first
        heap, seen = [(-bounds[0], 0)], 0
        while heap and -heap[0][0] >= mark:
            node = self.nodes[heapq.heappop(heap)[1]]
            if node.children:
                for child in node.children:
                    if bounds[child] >= mark:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            seen += 1
            places, inside = self.block.entries(node.rows)
            sums = np.r_[0, np.cumsum(self.block.values[places] * query[self.block.terms[places]])]
            ends = np.searchsorted(inside, np.arange(len(node.rows) + 1))
            scores = sums[ends[1:]] - sums[ends[:-1]]
            good = scores >= mark
            if not good.any():
                continue
            rows_found.append(node.rows[good])
            scores_found.append(scores[good])
            for score in scores[good].tolist():
                if len(best) < k:
                    heapq.heappush(best, score)
                elif score > best[0]:
                    heapq.heapreplace(best, score)
            if len(best) == k:
                mark = max(mark, best[0])
        if not rows_found:
            return np.empty(0, np.int64), np.empty(0, np.int64), seen
        rows, scores = np.concatenate(rows_found), np.concatenate(scores_found)
        keep = scores >= mark
        return rows[keep], scores[keep], seen


# ----------------------------------------------------------------- search


def _id_order(ids: list) -> np.ndarray:
    """Rank of each id in ascending order, nulls last."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))
    ranks = np.empty(len(ids), np.int64)
    ranks[order] = np.arange(len(ids))
    return ranks


def block_hits(part: Part, weights: np.ndarray, n_docs: int, n_terms: int, k: int, block: int = BLOCK, leaf: int = LEAF):
    """Rows ``(item, d, score)``: for each item of the part at most ``k`` hits of each task."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for start in range(0, batch.num_rows, block):
                piece = batch.slice(start, block)
                if held and size + piece.num_rows > block:
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
                held.append(piece)
                size += piece.num_rows
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(part.terms)
        best: list[list[tuple[int, object]]] = [[] for _ in part.items]
        kind = None
        for table in pack(batches):
            kind = table.schema.field("d").type
            table = table.combine_chunks()
            ids = table.column("d").to_pylist()
            terms = table.column("terms").combine_chunks()
            counts = np.diff(terms.offsets.to_numpy())
            starts = np.r_[0, np.cumsum(counts)].astype(np.int64)
            flat = terms.flatten().to_numpy(zero_copy_only=False)
            times = table.column("times").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            lengths = np.repeat(table.column("n").to_numpy(), counts)
            tree = BallTree(Block(starts, flat, impacts(weights[flat], times, lengths, n_docs, n_terms)), width, leaf)
            ranks = _id_order(ids)
            for first in range(0, len(part.items), 256):
                queries = np.zeros((min(256, len(part.items) - first), width), np.int64)
                for q, (_, own, often) in enumerate(part.items[first:first + 256]):
                    queries[q, own] = often
                bounds = tree.bounds(queries.astype(np.float64))
                for q in range(len(queries)):
                    kept = best[first + q]
                    mark = kept[-1][0] if len(kept) == k else 1
                    rows, scores, _ = tree.search(bounds[q], queries[q], k, mark)
                    top = np.lexsort((ranks[rows], -scores))[:k]
                    mine = [(int(scores[i]), ids[rows[i]]) for i in top]
                    both = kept + mine
                    both.sort(key=lambda h: (-h[0], h[1] is None, h[1] if h[1] is not None else 0))
                    best[first + q] = both[:k]
        if kind is not None:
            rows = [(i, d, s) for i, hits in enumerate(best) for s, d in hits]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], kind),
                 pa.array([r[2] for r in rows], pa.int64())], names=["item", "d", "score"])

    return run


def _ranked(hits: DataFrame, keys: list, k: int, name: str) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc("score"), F.col("d").asc_nulls_last())
    return hits.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k)


def _search_part(docs: DataFrame, part: Part, doc_id: str, text: str, k: int, kind: T.DataType, block: int) -> DataFrame:
    spark = docs.sparkSession
    folder = shared_dir(spark, "vectors")
    add_vectors(docs, part, doc_id, text).write.parquet(folder)
    vectors = spark.read.parquet(folder)
    total = vectors.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    weights = np.zeros(len(part.terms), np.int64)
    for row in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most a row per term of the part
        weights[row["t"]] = weight(total["docs"], row["count"])
    found = vectors.filter(F.size("terms") > 0).select("d", "n", "terms", "times").mapInArrow(
        block_hits(part, weights, total["docs"], total["terms"], k, block),
        T.StructType([T.StructField("item", T.LongType()), T.StructField("d", docs.schema[doc_id].dataType),
                      T.StructField("score", T.LongType())]))
    # First the best of some tasks, then of all: no task ranks the rows that all tasks give for an item.
    share = F.pmod(F.spark_partition_id(), F.lit(SHARES))
    some = _ranked(found.withColumn("_share", share), ["item", "_share"], k, "_r").drop("_r", "_share")
    best = _ranked(some, ["item"], k, "rank")
    names = spark.createDataFrame(
        [(i, item) for i, (item, _, _) in enumerate(part.items)],
        T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", kind)]))
    return best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), F.col("d").alias("doc_id"), "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", part_terms: int = 20_000, block: int = BLOCK,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``k`` best documents of score above 0."""
    kind = items.schema[item_id].dataType
    found = None
    for part in parts_of(items, item_id, item_text, part_terms):
        # Each part's few ranked rows are written, so that no plan holds more than one part.
        folder = shared_dir(docs.sparkSession, "hits")
        _search_part(docs, part, doc_id, text, k, kind, block).write.parquet(folder)
        mine = docs.sparkSession.read.parquet(folder)
        found = mine if found is None else found.unionByName(mine)
    if found is not None:
        return found
    return docs.sparkSession.createDataFrame([], T.StructType([
        T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("score", T.LongType())]))
