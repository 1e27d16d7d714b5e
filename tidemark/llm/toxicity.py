"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; every other text is unlabelled, not
negative. Linear classifiers over the presence of words minimise the risk
``p R(P, +) + max(0, R(U, -) - p R(P, -))`` with the class prior ``p``, so unlabelled
toxic texts do not count as clean ones. Where the estimate of the negative risk goes
below zero, the step climbs back out, as the non-negative estimator prescribes. An
L1 penalty leaves a small dictionary of weights, which the tasks apply to whole texts.

One classifier is trained per fold of three and judged on the fold it has not seen;
these scores place the threshold where the estimate ``recall² / Pr(predicted)``,
which needs no negatives, is best. The dictionary applied is their mean.

The fit uses a bounded sample: about ``max_positive`` toxic and ``max_unlabelled`` other
documents, chosen by a hash of the id; the prior is counted over all labels.

Defined results: null, empty and wordless texts score as a text without any known
word. Without a toxic example every score is 0. Repeated rows are scored each; in the
sample an id counts once, and it is toxic if any label of it is. Null ids train
nothing and are scored. Columns named like a result are replaced.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import schema_with, spread, with_arrays

THRESHOLD = 0.7
#: Lower-cases A-Z; digits and ASCII signs part words.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


#: Lengths of word beginnings in bytes, and the numbers of distinct words that share one.
PREFIXES = (4, 5, 6, 7, 8)
LEVELS = (1, 2, 3)


def words_of(text: bytes) -> set[bytes]:
    return set(text.translate(_LETTERS).split())


def _level(key: int, level: int) -> int:
    return (key * 0x9E3779B1 + level) & 0x7FFFFFFF


def _keys(word: bytes) -> list[int]:
    return [crc32(word[:n], n) for n in PREFIXES if len(word) >= n]


def features(text: bytes) -> np.ndarray:
    """31-bit hashes: each word, and each beginning once, twice and three times among distinct words."""
    words = words_of(text)
    shared = Counter(k for w in words for k in _keys(w))
    found = {_level(crc32(w), 0) for w in words}
    found.update(_level(k, n) for k, count in shared.items() for n in LEVELS if count >= n)
    return np.sort(np.fromiter(found, np.int32, len(found)))


@dataclass
class ToxicModel:
    """Weights by feature hash; ``cut`` is the sum of weights that scores the threshold."""

    weights: dict[int, float] = field(default_factory=dict)
    cut: float = math.inf
    #: What a word can contribute: its own weight and the beginnings that have one.
    seen: dict[bytes, tuple[float, list[int]] | None] = field(default_factory=dict, repr=False)

    def _word(self, word: bytes) -> tuple[float, list[int]] | None:
        own = self.weights.get(_level(crc32(word), 0), 0.0)
        keys = [k for k in _keys(word) if any(_level(k, n) in self.weights for n in LEVELS)]
        self.seen[word] = value = (own, keys) if own or keys else None
        return value

    def score(self, text: bytes | None) -> float:
        if self.cut == math.inf:
            return 0.0
        if len(self.seen) > 100_000:
            self.seen.clear()
        seen, terms, shared = self.seen, [], Counter()
        for word in words_of(text or b""):
            known = seen[word] if word in seen else self._word(word)
            if known:
                terms.append(known[0])
                shared.update(known[1])
        terms += [self.weights.get(_level(k, n), 0.0) for k, count in shared.items() for n in LEVELS if count >= n]
        z = math.log(THRESHOLD / (1 - THRESHOLD)) + math.fsum(terms) - self.cut
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit_nnpu(
    row: np.ndarray, col: np.ndarray, n_rows: int, n_cols: int, positive: np.ndarray, unlabelled: np.ndarray,
    prior: float, rounds: int = 150, rate: float = 0.1, penalty: float = 2e-4, beta: float = 0.0,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier from ones at ``(row, col)`` by the nnPU risk."""
    w = np.zeros(n_cols + 1)
    w[-1] = math.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    p_share, u_share = positive / positive.sum(), unlabelled / unlabelled.sum()
    for step in range(1, rounds + 1):
        z = w[-1] + np.bincount(row, weights=w[col], minlength=n_rows)
        up = _sigmoid(z)  # slope of the loss log(1 + exp(z)) of the negative class
        negative_loss = np.logaddexp(0, z)
        negative_risk = (u_share * negative_loss).sum() - prior * (p_share * negative_loss).sum()
        negative_slope = (u_share - prior * p_share) * up
        if negative_risk >= -beta:
            slope = prior * p_share * (up - 1) + negative_slope
        else:
            slope = -negative_slope
        grad = np.append(np.bincount(col, weights=slope[row], minlength=n_cols), slope.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        pace = rate / (np.sqrt(v / (1 - 0.999**step)) + 1e-4)
        w = w - pace * m / (1 - 0.9**step)
        # The penalty by soft thresholding, in the metric of the step; the bias has none.
        w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - pace[:-1] * penalty, 0)
    return w[:-1], float(w[-1])


def _best_cut(z: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Midpoint of the gap below the best lower end of the predicted class."""
    levels = np.unique(z)
    # Positives and unlabelled at or above each level.
    at = np.searchsorted(levels, z)
    recall = np.bincount(at, positive, len(levels))[::-1].cumsum()[::-1] / positive.sum()
    predicted = np.bincount(at, unlabelled, len(levels))[::-1].cumsum()[::-1] / unlabelled.sum()
    best = int(np.argmax(recall**2 / np.maximum(predicted, 1 / unlabelled.sum())))
    below = levels[best - 1] if best else levels[best] - 1.0
    return float((levels[best] + below) / 2)


FOLDS = 3


def fit(sample: pa.Table, prior: float, min_positive: int = 3, min_lift: float = 2.0) -> ToxicModel:
    """The model of a sample with columns ``part`` (0 to 2), ``positive``, ``unlabelled``, ``features``.

    Features count that ``min_positive`` toxic documents have, and ``min_lift`` times as
    large a share of them as of the unlabelled.
    """
    positive = sample["positive"].to_numpy().astype(float)
    unlabelled = sample["unlabelled"].to_numpy().astype(float)
    if not positive.sum() or not 0 < prior < 1:
        return ToxicModel()
    if not unlabelled.sum():
        unlabelled = np.ones(len(positive))
    lists = sample["features"].chunks
    first = np.cumsum([0, *map(len, lists)])

    def ones(hashes_of: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and hashes, a chunk at a time; with a vocabulary only its own, as places in it."""
        for start, chunk in zip(first, lists, strict=False):
            row = np.repeat(np.arange(start, start + len(chunk), dtype=np.int32), np.diff(chunk.offsets.to_numpy()))
            hashes = chunk.flatten().to_numpy()
            if hashes_of is None:
                toxic = positive[row] > 0
                yield row[toxic], hashes[toxic]
            else:
                col = np.searchsorted(hashes_of, hashes).astype(np.int32)
                seen = hashes_of[np.minimum(col, len(hashes_of) - 1)] == hashes
                yield row[seen], col[seen]

    vocabulary, count = np.unique(np.concatenate([h for _, h in ones()]), return_counts=True)
    vocabulary = vocabulary[count >= min_positive]
    if not len(vocabulary):
        return ToxicModel()
    row, col = map(np.concatenate, zip(*ones(vocabulary), strict=True))
    share = np.bincount(col, positive[row], len(vocabulary)) / positive.sum()
    usual = np.bincount(col, unlabelled[row], len(vocabulary)) / unlabelled.sum()
    telling = share >= min_lift * usual
    if not telling.any():
        return ToxicModel()
    kept = telling[col]
    row, col, vocabulary = row[kept], (np.cumsum(telling) - 1)[col[kept]], vocabulary[telling].tolist()
    part = sample["part"].to_numpy()
    weights, out_of_fold = np.zeros(len(vocabulary)), np.zeros(len(positive))
    trained = 0
    for k in range(FOLDS):
        mine = part != k
        p, u = positive * mine, unlabelled * mine
        if not p.sum() or not u.sum():
            p, u = positive, unlabelled
        w, bias = fit_nnpu(row, col, len(positive), len(vocabulary), p, u, prior)
        z = np.bincount(row, weights=w[col], minlength=len(positive))
        out_of_fold = np.where(mine, out_of_fold, z)
        weights += w
        trained += 1
    weights /= trained
    cut = _best_cut(out_of_fold, positive, unlabelled)
    return ToxicModel({w: float(x) for w, x in zip(vocabulary, weights, strict=True) if x}, cut)


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    max_positive: int = 2500, max_unlabelled: int = 7000,
) -> ToxicModel:
    """Fit on the rows given; ``labels`` has an id and a 0/1 label for some of them.

    Only the hashed features of the sample reach the driver. The toxic ids that are broadcast
    are bounded by ``max_positive``.
    """
    known = (
        labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).alias("_toxic"))
    )
    n_known, n_toxic = known.agg(F.count("_id"), F.sum((F.col("_toxic") > 0).cast("bigint"))).first()
    if not n_toxic:
        return ToxicModel()
    prior = min(max(n_toxic / n_known, 1e-4), 1 - 1e-4)
    toxic = known.filter("_toxic > 0").filter(spread("_id", "toxic") < max_positive / n_toxic).select("_id")
    ids = docs.filter(F.col(doc_id).isNotNull())
    share = max_unlabelled / max(1, ids.select(doc_id).count())
    marked = (
        ids.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
        .join(F.broadcast(toxic.withColumn("_positive", F.lit(True))), "_id", "left")
        .withColumn("_positive", F.coalesce("_positive", F.lit(False)))
        .withColumn("_unlabelled", spread("_id", "unlabelled") < share)
        .filter("_positive or _unlabelled")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("_text")).cast(pa.binary()).to_pylist()
            found = pa.array([features(t or b"") for t in texts], pa.list_(pa.int32()))
            names = ["_id", "_positive", "_unlabelled"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(n)) for n in names] + [found], names=[*names, "_features"]
            )

    id_type = docs.schema[doc_id].dataType.simpleString()
    sets = marked.mapInArrow(run, f"_id {id_type}, _positive boolean, _unlabelled boolean, _features array<int>")
    sample = sets.groupBy("_id").agg(
        F.max("_positive").alias("positive"), F.max("_unlabelled").alias("unlabelled"), F.min("_features").alias("features")
    ).select(F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(FOLDS)).cast("int").alias("part"),
             "positive", "unlabelled", "features", F.col("_id").cast("string").alias("id"))
    return fit(sample.toArrow().sort_by("id"), prior)


def score(docs: DataFrame, model: ToxicModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
            scores = [mine.score(t) for t in texts]
            yield with_arrays(batch, [
                ("score", pa.array(scores, pa.float64())),
                ("predicted", pa.array([int(s >= threshold) for s in scores], pa.int32())),
            ])

    return docs.mapInArrow(run, schema_with(
        docs, T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False)
    ))


def keep_clean(docs: DataFrame, model: ToxicModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their own columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([shared.value.score(t) < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
