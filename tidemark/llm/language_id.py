"""Language identification by bit-sliced Bloom filters of character n-grams.

Each place of a filter holds one bit for every language (a byte for each eight of
them), so the conjunction of a few places gives at once all languages whose
frequent n-grams include the one asked for. A text's bits are counted per language;
with ``f`` the rate at which a language's bits are all set by chance, ``(count - n f) /
(1 - f)`` removes the false positives, and the largest corrected count decides.

N-grams are four characters of the lower-cased text; all but letters count as a blank,
and a blank may only stand first or last. Languages are learnt from the labelled
documents of a stated sample (about ``max_documents`` of each language by a hash of
the id); the ``top`` most frequent n-grams of each language enter the filter.

Defined results: a null text or one without a letter is ``und`` with score 0. A text
without any known n-gram, or a tie, goes to the language with most training n-grams,
then by name. Without a labelled document all is ``und``. The score is the winner's
share of all corrected counts. Repeated rows are judged each; columns named like a
result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import schema_with, spread, with_arrays

N = 4
HASHES = 3
UNKNOWN = "und"
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_hashes(text: str) -> tuple[np.ndarray, np.ndarray, bool]:
    """Hash of the n-gram at every place, whether it counts, and whether there is a letter."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letter = _letters()[points]
    size = len(points) - N + 1
    if size <= 0:
        return np.empty(0, np.uint64), np.empty(0, bool), bool(letter.any())
    code = np.where(letter, points, 32).astype(np.uint64)
    mixed = code[:size] * _MIX[0]
    for i in range(1, N):
        mixed += code[i:size + i] * _MIX[i]
        mixed ^= mixed >> np.uint64(29)
        mixed *= _MIX[0]
    mixed ^= mixed >> np.uint64(32)
    counts = letter[1:size + 1]
    for i in range(2, N - 1):
        counts = counts & letter[i:size + i]
    return mixed, counts, bool(letter.any())


def slices(texts: list[str | None], size: int = 1_000_000) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of numbered texts, blanks around each; one beyond ``size`` comes in overlapping slices."""
    numbers: list[int] = []
    group: list[str] = []
    held = 0
    for i, text in enumerate(texts):
        padded = f" {(text or '').lower()} "
        for start in range(0, max(1, len(padded) - N + 1), size):
            part = padded[start:start + size + N - 1]
            numbers.append(i)
            group.append(part)
            held += len(part)
            if held >= size:
                yield numbers, group
                numbers, group, held = [], [], 0
    if group:
        yield numbers, group


@dataclass
class LanguageFilter:
    languages: list[str] = field(default_factory=list)
    #: One byte array for each eight languages.
    tables: list[np.ndarray] = field(default_factory=list)
    false_rate: np.ndarray = field(default_factory=lambda: np.empty(0))

    @classmethod
    def build(cls, ngrams: dict[str, np.ndarray], bits: int = 20) -> LanguageFilter:
        """``ngrams`` has hashes by language, the preferred language first."""
        names = list(ngrams)
        tables = [np.zeros(1 << bits, np.uint8) for _ in range(-(-len(names) // 8))]
        fill = []
        for i, name in enumerate(names):
            table, bit = tables[i // 8], np.uint8(1 << i % 8)
            for at in cls._places(ngrams[name], bits):
                table[at] |= bit
            fill.append(float(((table & bit) != 0).mean()))
        return cls(names, tables, np.array(fill) ** HASHES)

    @staticmethod
    def _places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
        mask = np.uint64((1 << bits) - 1)
        return [((hashes >> np.uint64(bits * j)) & mask).astype(np.int64) for j in range(HASHES)]

    def judge(self, texts: list[str | None]) -> list[tuple[str, float]]:
        size = len(self.languages)
        if not size:
            return [(UNKNOWN, 0.0)] * len(texts)
        bits = len(self.tables[0]).bit_length() - 1
        total = np.zeros(len(texts))
        counts = np.zeros((len(texts), size))
        lettered = np.zeros(len(texts), bool)
        for numbers, group in slices(texts):
            # N-grams across two texts have two blanks inside and do not count.
            hashes, valid, _ = ngram_hashes("".join(group))
            lengths = np.fromiter(map(len, group), np.int64, len(group))
            owner = np.repeat(np.array(numbers), lengths)[:len(hashes)]
            edge = np.repeat(np.cumsum(lengths), lengths)[:len(hashes)] - np.arange(len(hashes)) < N
            at = np.flatnonzero(valid & ~edge)
            owner, places = owner[at], self._places(hashes[at], bits)
            total += np.bincount(owner, minlength=len(texts))
            lettered[owner] = True
            for t, table in enumerate(self.tables):
                found = table[places[0]]
                for place in places[1:]:
                    found &= table[place]
                for i in range(t * 8, min(size, t * 8 + 8)):
                    has = (found >> np.uint8(i % 8)) & np.uint8(1)
                    counts[:, i] += np.bincount(owner[has.view(bool)], minlength=len(texts))
        corrected = np.maximum(0, (counts - total[:, None] * self.false_rate) / (1 - self.false_rate))
        best, whole = corrected.argmax(axis=1), corrected.sum(axis=1)
        share = corrected[np.arange(len(texts)), best] / np.where(whole > 0, whole, 1)
        out = []
        for i, text in enumerate(texts):
            known = lettered[i] or any(map(str.isalpha, text or ""))
            out.append((self.languages[best[i]], float(share[i])) if known else (UNKNOWN, 0.0))
        return out


def train(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", max_documents: int = 2000,
    top: int = 20_000, bits: int = 20,
) -> LanguageFilter:
    """Filters from the rows given; those without text or language teach nothing.

    At most ``top`` hashes of each language reach the driver. N-grams are counted in
    each batch and added up on Spark.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(doc_id).alias("_id"), F.col(text).alias("_text"), F.col(lang).cast("string").alias("_lang"))
    sizes = {r["_lang"]: r["count"] for r in known.groupBy("_lang").count().toLocalIterator()}
    if not sizes:
        return LanguageFilter()
    share = F.lit(1.0)
    for name, n in sorted(sizes.items()):
        if n > max_documents:
            share = F.when(F.col("_lang") == name, F.lit(max_documents / n)).otherwise(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), dtype=object)
            texts = batch.column(0).to_pylist()
            for name in sorted(set(names)):
                for _, group in slices([texts[i] for i in np.flatnonzero(names == name)]):
                    hashes, valid, _ = ngram_hashes("".join(group))
                    found, count = np.unique(hashes[valid], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(found), pa.string()), pa.array(found.view(np.int64)),
                         pa.array(count, pa.int64())], names=["lang", "ngram", "n"])

    sampled = known.filter(F.coalesce(spread("_id", "language"), F.lit(0.0)) < share).select("_text", "_lang")
    counts = sampled.mapInArrow(run, "lang string, ngram long, n long").groupBy("lang", "ngram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "ngram"))
    rows = counts.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", "ngram", "n").toArrow().to_pandas()
    weight = rows.groupby("lang")["n"].sum()
    names = sorted(weight.index, key=lambda x: (-weight[x], x))
    return LanguageFilter.build(
        {x: rows.loc[rows["lang"] == x, "ngram"].to_numpy().view(np.uint64) for x in names}, bits)


def predict(docs: DataFrame, model: LanguageFilter, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.judge(batch.column(batch.schema.get_field_index(text)).to_pylist())
            yield with_arrays(batch, [("lang_pred", pa.array([x for x, _ in found], pa.string())),
                                      ("score", pa.array([s for _, s in found], pa.float64()))])

    return docs.mapInArrow(run, schema_with(
        docs, T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)))
