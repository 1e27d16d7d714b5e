"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items become word sequences, and one automaton holds every substring of all of
them. A document's words stream through it; the state and the length of the
longest match ending at each word tell whether a window of ``window`` item words
ends there, or a whole item that is shorter. Words inside any such match are hit.

The automaton is broadcast, so its size is bounded: items are dealt into parts of at
most ``part_words`` words (one longer item is cut into overlapping pieces, which
changes no window), and each part is collected and broadcast alone. Documents pass
through ``PARTS_AT_ONCE`` parts in one job; with more parts what was found is written
by ``checkpoint()`` and the automata are given up before the next parts are built, so no
task and no driver holds more of them, however large the benchmark is.

Defined results: a null, empty or wordless text has no words and no hits; items
without words and null items are no window; repeated items under one id count
once, and every id with the same text counts. Repeated documents are judged each.
An empty benchmark hits nothing. Ids of items are compared and sorted as strings.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_root
from .common import WORD_BYTES, schema_with, with_arrays

WINDOW = 10
#: Automata that one job, and each of its tasks, holds.
PARTS_AT_ONCE = 2
MADE = {"n_words", "hit_starts", "hit_ends", "hit_items"}
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case (A-Z only): digits, letters and everything beyond ASCII."""
    return text.translate(WORD_BYTES).split()


class Automaton:
    """Suffix automaton of several word sequences, with the items of every window."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        kept = []
        for item, words in items:
            if words:
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
                kept.append((item, ids))
                last = 0
                for word in ids:
                    last = self._extend(last, word)
        self.shortest = min([window, *(len(ids) for _, ids in kept)])
        # Items by the state of a whole window, and short items by the state they end in.
        self.windows: dict[int, set[str]] = {}
        ends: dict[int, list[tuple[int, str]]] = {}
        for item, ids in kept:
            state = 0
            for n, word in enumerate(ids, 1):
                state = self.step[state][word]
                if n >= window:
                    self.windows.setdefault(self._of_length(state, window), set()).add(item)
            if len(ids) < window:
                ends.setdefault(state, []).append((len(ids), item))
        #: Short items that end in a state or in one of its suffixes.
        self.short: dict[int, list[tuple[int, str]]] = {}
        if ends:
            for state in sorted(range(len(self.link)), key=self.length.__getitem__):
                found = ends.get(state, []) + (self.short.get(self.link[state], []) if state else [])
                if found:
                    self.short[state] = found

    def _of_length(self, state: int, n: int) -> int:
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def _extend(self, last: int, word: int) -> int:
        step, link, length = self.step, self.link, self.length
        if word in step[last]:
            target = step[last][word]
            return target if length[target] == length[last] + 1 else self._clone(last, word, target)
        new = self._state(length[last] + 1, {})
        while last >= 0 and word not in step[last]:
            step[last][word] = new
            last = link[last]
        if last >= 0:
            target = step[last][word]
            link[new] = target if length[target] == length[last] + 1 else self._clone(last, word, target)
        return new

    def _state(self, length: int, step: dict[int, int], link: int = 0) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _clone(self, last: int, word: int, target: int) -> int:
        copy = self._state(self.length[last] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = copy
        while last >= 0 and self.step[last].get(word) == target:
            self.step[last][word] = copy
            last = self.link[last]
        return copy

    def matches(self, ids: list[int], offset: int) -> Iterator[tuple[int, int, Iterable[str]]]:
        """``(start, end, items)`` of every window and short item in a run of known words."""
        step, link, length, short, window = self.step, self.link, self.length, self.short, self.window
        state = matched = 0
        for end, word in enumerate(ids, offset + 1):
            while state and word not in step[state]:
                state = link[state]
                matched = length[state]
            following = step[state].get(word)
            if following is None:
                state = matched = 0
                continue
            state = following
            matched += 1
            if matched >= window:
                yield end - window, end, self.windows[self._of_length(state, window)]
            for n, item in short.get(state, ()):
                if n <= matched:
                    yield end - n, end, (item,)

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word spans ``[start, end)`` that are hit, and the items that occur."""
        known = self.vocabulary.get
        ids = [known(w, 0) for w in words]
        if len(ids) < self.shortest:
            return [], set()
        # Only a run of item words as long as the shortest window can hold one.
        edge = np.diff(np.concatenate([[0], np.fromiter(ids, np.int32, len(ids)) > 0, [0]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long_enough = ends - starts >= self.shortest
        found, items = [], set()
        for a, b in zip(starts[long_enough].tolist(), ends[long_enough].tolist(), strict=True):
            for start, end, which in self.matches(ids[a:b], a):
                found.append((start, end))
                items.update(which)
        return merged(found), items


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    edges = {i for start, end in spans for i in (start, end - 1)}
    at = {i: m.span() for i, m in enumerate(_WORD.finditer(text.translate(WORD_BYTES))) if i in edges}
    out, done = [], 0
    for start, end in spans:
        out.append(text[done:at[start][0]])
        done = at[end - 1][1]
    return b"".join([*out, text[done:]])


def _parts(items: DataFrame, item_id: str, text: str, window: int, part_words: int) -> Iterator[list]:
    """Collected items, a part at a time; the numbers of parts come from the sum of all bytes."""
    rows = items.select(F.col(item_id).cast("string").alias("id"), F.col(text).cast("binary").alias("text"))
    rows = rows.filter("id is not null and text is not null").distinct()
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n_parts = max(1, -(-size // (4 * part_words)))  # a word and its blank seldom have under four bytes
    for part in range(n_parts):
        batch: list[tuple[str, list[bytes]]] = []
        held = 0
        mine = rows if n_parts == 1 else rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n_parts)) == part)
        for row in mine.toLocalIterator():
            words = words_of(bytes(row["text"]))
            for start in range(0, max(1, len(words) - window + 1), part_words):
                piece = words[start:start + part_words + window - 1]
                if batch and held + len(piece) > part_words:
                    yield batch
                    batch, held = [], 0
                batch.append((row["id"], piece))
                held += len(piece)
        if batch:
            yield batch


def find_hits(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, part_words: int = 200_000,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_starts``, ``hit_ends`` (word spans) and ``hit_items``."""
    numbers, names = T.ArrayType(T.IntegerType(), False), T.ArrayType(T.StringType(), False)
    made = [T.StructField("n_words", T.LongType(), False), T.StructField("hit_starts", numbers, False),
            T.StructField("hit_ends", numbers, False), T.StructField("hit_items", names, False)]
    docs = docs.withColumns({
        "n_words": F.lit(0).cast("bigint"), "hit_starts": F.array().cast(numbers),
        "hit_ends": F.array().cast(numbers), "hit_items": F.array().cast(names),
    })
    schema = schema_with(docs, *made)
    context = docs.sparkSession.sparkContext

    def scan(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = shared.value
            for batch in batches:
                def column(name, batch=batch):
                    return batch.column(batch.schema.get_field_index(name))

                counts, starts, ends, which = [], [], [], []
                before = zip(column("hit_starts").to_pylist(), column("hit_ends").to_pylist(),
                             column("hit_items").to_pylist(), strict=True)
                for value, (a, b, c) in zip(column(text).cast(pa.binary()).to_pylist(), before, strict=True):
                    words = words_of(value) if value else []
                    spans, found = automaton.hits(words)
                    if a and spans:
                        spans = merged([*zip(a, b, strict=True), *spans])
                    elif a:
                        spans = list(zip(a, b, strict=True))
                    counts.append(len(words))
                    starts.append([s for s, _ in spans])
                    ends.append([e for _, e in spans])
                    which.append(sorted(found.union(c)) if found else c)
                yield with_arrays(batch, [
                    ("n_words", pa.array(counts, pa.int64())), ("hit_starts", pa.array(starts, pa.list_(pa.int32()))),
                    ("hit_ends", pa.array(ends, pa.list_(pa.int32()))), ("hit_items", pa.array(which, pa.list_(pa.string()))),
                ])

        return run

    open_: list = []
    for part in _parts(items, item_id, item_text, window, part_words):
        if len(open_) == PARTS_AT_ONCE:
            checkpoint_root(docs.sparkSession)
            docs = docs.checkpoint()
            while open_:
                open_.pop().destroy()
        open_.append(context.broadcast(Automaton(part, window)))
        docs = docs.mapInArrow(scan(open_[-1]), schema)
    return docs if open_ else docs.mapInArrow(scan(context.broadcast(Automaton([], window))), schema)


def hit_words() -> Column:
    """Words inside any hit span."""
    lengths = F.transform("hit_ends", lambda e, i: (e - F.get("hit_starts", i)).cast("bigint"))
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, x: a + x)


def decontaminate(
    docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW, max_span: int = 0,
    max_coverage: float = 0.5, **options,
) -> DataFrame:
    """``docs`` with hit spans of over ``max_span`` words cut out of the text.

    A document is dropped if more than ``max_coverage`` of its words are hit. Others
    keep all text outside the spans. Columns and their order stay, also those named
    like a result of ``find_hits``.
    """
    own = {c: f"_own_{i}_{c}" for i, c in enumerate(docs.columns) if c.lower() in MADE}
    found = find_hits(docs.withColumnsRenamed(own), items, text, window=window, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            def column(name, batch=batch):
                return batch.column(batch.schema.get_field_index(name))

            values = column(text).cast(pa.binary()).to_pylist()
            spans = zip(column("hit_starts").to_pylist(), column("hit_ends").to_pylist(), strict=True)
            for i, (a, b) in enumerate(spans):
                cut = [(s, e) for s, e in zip(a, b, strict=True) if e - s > max_span]
                if cut:
                    values[i] = without_spans(values[i], cut)
            out = with_arrays(batch, [(text, pa.array(values, pa.binary()).cast(pa.string()))])
            yield out

    clean = found.filter(hit_words() <= max_coverage * F.col("n_words"))
    schema = schema_with(clean, T.StructField(text, T.StringType()))
    return clean.mapInArrow(run, schema).select(*[F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns])
