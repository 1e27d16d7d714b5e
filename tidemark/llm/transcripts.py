"""Transcript parsing: roles of raw lines by a hidden Markov model, then canonical turns.

A transcript is rows of text in order; only its lines count, not the rows. Every line
is in one of nine states: it begins a turn, goes on with it, or is a blank inside or
after it, for each of three roles. A line shows whether a speaker marker opens it and
whose, whether it asks, and how long it is. Start, transition and line probabilities are
counted from transcripts with known roles (``train``), with one added to each count.

Decoding is Viterbi in chunks, so a transcript that holds a third of all rows is not
one task's work: rows are numbered in slices, each chunk of up to ``chunk_rows`` rows or
KiB gives a table of the best scores from its first line's state to that of the next
chunk's first line, passes over these small tables fix the states at the seams, in
groups of ``fan`` by levels, and each chunk is then decoded alone. Of equal paths the one with the lower state number wins.

Result: a row for each turn, ``(id, turn, part, role, content, rendered)``; ``part`` is
the number of its chunk. A turn that goes on in the next chunk has a further part; all
``rendered`` joined by turn and part are the canonical transcript. Markers and blank lines at a turn's edges are not content.

Defined results: null text counts as empty, and an empty row as a blank line. A
transcript without any marker gets its most likely roles. Repeated rows are lines like
others; rows of one position are ordered by their text. A null id is an id like others.
An empty table gives no rows. Other columns are not carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.numbering import rows_before
from ..session import checkpoint_root

ROLES = ("system", "user", "assistant")
BEGIN, GO_ON, GAP = range(3)
STATES = 9  # 3 * role + place
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "prompt", "q"),
    "assistant": ("assistant", "ai", "bot", "answer", "response", "model", "a"),
}
_ROLE = {word: i for i, role in enumerate(ROLES) for word in MARKERS[role]}
_MARKER = re.compile(r"\W{0,6}(" + "|".join(sorted(_ROLE, key=len, reverse=True)) + r")\W{0,3}?(?::|\]|>|\||$)[\s*_]*",
                     re.IGNORECASE | re.ASCII)
OPEN, CLOSE = "<|{}|>\n", "\n<|end|>\n"
#: Sizes of the three line features.
SHAPE = (5, 2, 5)


def features(line: str) -> tuple[int, int, int]:
    """Marker (blank 0, none 1, else 2 + role), question, length class."""
    if not line.strip():
        return 0, 0, 0
    found = _MARKER.match(line)
    kind = 2 + _ROLE[found[1].lower()] if found else 1
    return kind, int(line.rstrip().endswith("?")), min(4, len(line).bit_length() // 2)


@dataclass
class RoleModel:
    start: np.ndarray
    step: np.ndarray
    shows: list[np.ndarray]

    @classmethod
    def from_counts(cls, counts: dict[tuple[str, int, int], int]) -> RoleModel:
        """Logarithms of the smoothed shares; impossible starts and steps stay impossible."""
        start, step = np.ones(STATES), np.ones((STATES, STATES))
        shows = [np.ones((STATES, n)) for n in SHAPE]
        for (kind, a, b), n in counts.items():
            if kind == "start":
                start[a] += n
            elif kind == "step":
                step[a, b] += n
            else:
                shows[int(kind)][a, b] += n
        role, place = np.divmod(np.arange(STATES), 3)
        start[place != BEGIN] = 0
        step[(place[None] != BEGIN) & (role[:, None] != role[None])] = 0
        with np.errstate(divide="ignore"):
            return cls(np.log(start / start.sum()), np.log(step / step.sum(axis=1, keepdims=True)),
                       [np.log(s / s.sum(axis=1, keepdims=True)) for s in shows])

    def scores(self, lines: list[str]) -> list[np.ndarray]:
        known: dict[tuple[int, int, int], np.ndarray] = {}
        out = []
        for line in lines:
            seen = features(line)
            if seen not in known:
                known[seen] = sum(table[:, x] for table, x in zip(self.shows, seen, strict=True))
            out.append(known[seen])
        return out

    def table(self, lines: list[str]) -> np.ndarray:
        """Best scores by the first line's state and the next chunk's first; the last column is the end."""
        shown = self.scores(lines)
        best = np.where(np.eye(STATES, dtype=bool), shown[0][:, None], -np.inf)
        for score in shown[1:]:
            best = (best[:, :, None] + self.step[None]).max(axis=1) + score
        return np.concatenate([(best[:, :, None] + self.step[None]).max(axis=1), best.max(axis=1)[:, None]], axis=1)

    def path(self, lines: list[str], first: int | None = None, following: int | None = None) -> list[int]:
        """The best states of the lines, given those of the first line and of the line that follows."""
        shown, back = self.scores(lines), []
        if first is None:
            best = self.start + shown[0]
        else:
            best = np.where(np.arange(STATES) == first, shown[0], -np.inf)
        for score in shown[1:]:
            reached = best[:, None] + self.step
            back.append(reached.argmax(axis=0))
            best = reached.max(axis=0) + score
        if following is not None and following < STATES:
            best = best + self.step[:, following]
        states = [int(best.argmax())]
        for came in reversed(back):
            states.append(int(came[states[-1]]))
        return states[::-1]


def _lines(texts: list[str | None]) -> list[str]:
    return [line for t in texts for line in (t or "").split("\n")]


def train(turns: DataFrame, conv_id: str = "conv_id", seq: str = "seq", role: str = "role", text: str = "text") -> RoleModel:
    """A model of turns with known roles: rows whose text is one turn, marker included.

    Only counts of states and features reach the driver. The first row of a
    transcript is the one without a row before it; rows of other roles are left out.
    """
    rows = turns.filter(F.col(role).isin(*ROLES)).select(
        F.col(conv_id).alias("c"), F.col(seq).cast("bigint").alias("s"), F.col(role).alias("r"), F.col(text).alias("t"))
    near = rows.groupBy("c", "s").agg(F.min("r").alias("r"))
    following = near.select("c", (F.col("s") - 1).alias("s"), F.col("r").alias("after"))
    before = near.select("c", (F.col("s") + 1).alias("s"), F.lit(True).alias("late"))
    rows = rows.join(following, ["c", "s"], "left").join(before, ["c", "s"], "left").select("r", "t", "after", "late")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, int, int], int] = {}
            for name, value, after, late in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                mine, previous = 3 * ROLES.index(name), None
                for i, line in enumerate(_lines([value])):
                    seen = features(line)
                    state = mine + (BEGIN if i == 0 else GAP if not line.strip() else GO_ON)
                    keys = [(str(k), state, x) for k, x in enumerate(seen)]
                    if previous is not None:
                        keys.append(("step", previous, state))
                    elif not late:
                        keys.append(("start", state, 0))
                    for key in keys:
                        counts[key] = counts.get(key, 0) + 1
                    previous = state
                if after is not None:
                    key = ("step", previous, 3 * ROLES.index(after))
                    counts[key] = counts.get(key, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _, _ in counts], pa.string()), pa.array([a for _, a, _ in counts], pa.int32()),
                 pa.array([b for _, _, b in counts], pa.int32()), pa.array(list(counts.values()), pa.int64())],
                names=["kind", "a", "b", "n"])

    found = rows.mapInArrow(run, "kind string, a int, b int, n long").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    return RoleModel.from_counts({(r["kind"], r["a"], r["b"]): r["n"] for r in found.toLocalIterator()})


def _seams(start: np.ndarray):
    """First states of all chunks, from the tables of rows sorted by transcript and chunk."""
    def chosen(end: np.ndarray, backs: list[np.ndarray]) -> list[int]:
        states = [int(end.argmax())]
        for came in reversed(backs):
            states.append(int(came[states[-1]]))
        return states[::-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: object = _seams
        chunks: list[int] = []
        backs: list[np.ndarray] = []  # a byte for each state and chunk of the current transcript
        reach = end = start
        came, kind = np.empty(0, np.int8), None
        for batch in batches:
            kind = batch.schema.field(0).type
            out: list = []
            tables = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, STATES, STATES + 1)
            for key, chunk, table in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), tables, strict=True):
                if key != current:
                    if chunks:
                        out.append((current, chunks, chosen(end, backs)))
                    current, chunks, backs, reach = key, [], [], start
                if chunks:
                    backs.append(came)
                chunks.append(chunk)
                total = reach[:, None] + table
                end = total[:, STATES]
                came = total[:, :STATES].argmax(axis=0).astype(np.int8)
                reach = total[:, :STATES].max(axis=0)
                reach = reach - reach.max()  # only differences count
            yield from _seam_rows(out, kind)
        if chunks:
            yield from _seam_rows([(current, chunks, chosen(end, backs))], kind)

    return run


#: Chunks whose tables one task puts together.
FAN = 512


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One table for each group, from the tables ``(c, group, chunk, best)`` of rows sorted that way.

    Tables are chained like the lines they stand for, so a group's table is that of all its lines.
    """
    current: object = _compose
    made: np.ndarray | None = None
    kind = None

    def row(table: np.ndarray) -> pa.RecordBatch:
        key, group = current
        return pa.RecordBatch.from_arrays(
            [pa.array([key], kind), pa.array([group], pa.int64()), pa.array([table.reshape(-1)], pa.list_(pa.float64()))],
            names=["c", "chunk", "best"])

    for batch in batches:
        kind = batch.schema.field(0).type
        tables = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, STATES, STATES + 1)
        for key, group, table in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), tables, strict=True):
            if (key, group) != current:
                if made is not None:
                    yield row(made)
                current, made = (key, group), table
            else:
                made = (made[:, :STATES, None] + table[None]).max(axis=1)
    if made is not None:
        yield row(made)


def _inner_seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First states of a group's chunks, from rows ``(c, group, chunk, best, first, following)`` sorted by the first three.

    ``first`` and ``following`` are the states at the group's own seams.
    """
    current: object = _inner_seams
    chunks: list[int] = []
    tables: list[np.ndarray] = []
    ends, kind = (0, STATES), None

    def solved() -> list:
        best, backs = np.where(np.arange(STATES) == ends[0], 0.0, -np.inf), []
        for table in tables[:-1]:
            total = best[:, None] + table[:, :STATES]
            backs.append(total.argmax(axis=0))
            best = total.max(axis=0)
            best = best - best.max()
        states = [int((best + tables[-1][:, ends[1]]).argmax())]
        for came in reversed(backs):
            states.append(int(came[states[-1]]))
        return [(current[0], chunks, states[::-1])]

    def rows() -> Iterator[pa.RecordBatch]:
        for batch in _seam_rows(solved(), kind):
            following = batch.column(3).to_numpy().copy()
            if batch.column(1)[-1].as_py() == chunks[-1]:
                following[-1] = ends[1]
            yield batch.set_column(3, "following", pa.array(following, pa.int32()))

    for batch in batches:
        kind = batch.schema.field(0).type
        found = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, STATES, STATES + 1)
        keys = zip(*[batch.column(k).to_pylist() for k in (0, 1, 2, 4, 5)], strict=True)
        for (key, group, chunk, first, following), table in zip(keys, found, strict=True):
            if (key, group) != current:
                if chunks:
                    yield from rows()
                current, chunks, tables, ends = (key, group), [], [], (first, following)
            chunks.append(chunk)
            tables.append(table)
    if chunks:
        yield from rows()


def seam_states(best: DataFrame, start: np.ndarray, fan: int = FAN) -> DataFrame:
    """``(c, chunk, first, following)`` of all chunks, from their tables ``(c, chunk, best)``.

    A transcript of more than ``fan`` chunks is put together in groups, the groups'
    seams are found first, in the same way, and then those inside each group: no task
    holds more than ``fan`` tables of one transcript.
    """
    key = best.schema["c"]
    seams = T.StructType([key, T.StructField("chunk", T.LongType()), T.StructField("first", T.IntegerType()),
                          T.StructField("following", T.IntegerType())])
    if (best.agg(F.max("chunk")).first()[0] or 0) < fan:
        return best.repartition("c").sortWithinPartitions("c", "chunk").mapInArrow(_seams(start), seams)
    grouped = best.select("c", F.floor(F.col("chunk") / fan).cast("bigint").alias("group"), "chunk", "best")
    above = grouped.repartition("c", "group").sortWithinPartitions("c", "group", "chunk").mapInArrow(
        _compose, T.StructType([key, T.StructField("chunk", T.LongType()), best.schema["best"]])).checkpoint()
    known = seam_states(above, start, fan).withColumnsRenamed({"c": "gc", "chunk": "gg"})
    joined = grouped.join(known, F.col("c").eqNullSafe(F.col("gc")) & (F.col("group") == F.col("gg"))).select(
        "c", "group", "chunk", "best", "first", "following")
    return joined.repartition("c", "group").sortWithinPartitions("c", "group", "chunk").mapInArrow(_inner_seams, seams)


def _seam_rows(found: list, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    for key, chunks, states in found:
        for at in range(0, len(chunks), 10_000):
            some = chunks[at:at + 10_000]
            ahead = states[at + 1:at + 1 + len(some)]
            ahead += [STATES] * (len(some) - len(ahead))
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(some), kind), pa.array(some, pa.int64()),
                 pa.array(states[at:at + len(some)], pa.int32()), pa.array(ahead, pa.int32())],
                names=["c", "chunk", "first", "following"])


def _content(lines: list[str], begins: bool, role: int) -> str:
    if begins:
        found = _MARKER.match(lines[0])
        if found and _ROLE[found[1].lower()] == role:
            lines = [lines[0][found.end():], *lines[1:]]
    return "\n".join(lines)


def _segments(lines: list[str], states: list[int], following: int) -> list[tuple[bool, int, str, str]]:
    """``(begins, role, content, rendered)`` of the turns' parts in a chunk."""
    starts = [0, *[i for i in range(1, len(lines)) if states[i] % 3 == BEGIN], len(lines)]
    out = []
    for a, b in zip(starts, starts[1:], strict=False):
        role, begins = states[a] // 3, states[a] % 3 == BEGIN
        ends = b < len(lines) or following >= STATES or following % 3 == BEGIN
        text = _content(lines[a:b], begins, role)
        if begins:
            text = text.lstrip()
        if ends:
            text = text.rstrip()
        rendered = (OPEN.format(ROLES[role]) if begins else "\n") + text + (CLOSE if ends else "")
        out.append((begins, role, text, rendered))
    return out


def parse(
    transcripts: DataFrame, model: RoleModel, conv_id: str = "conv_id", seq: str = "seq", text: str = "text",
    chunk_rows: int = 256, fan: int = FAN,
) -> DataFrame:
    """``(conv_id, turn, part, role, content, rendered)`` of every transcript."""
    spark = transcripts.sparkSession
    checkpoint_root(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = transcripts.select(
        F.col(conv_id).alias("c"), F.col(seq).alias("s"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # A row counts as one and one more for each KiB, so a chunk is bounded by bytes, but for its last row.
    rows = rows.withColumn("w", 1 + F.floor(F.octet_length("t") / 1024).cast("bigint"))
    numbered = rows_before(rows, ["c"], ["s", "t"], "w", "n")
    chunks = (
        numbered.withColumn("chunk", F.floor(F.col("n") / chunk_rows).cast("bigint")).groupBy("c", "chunk")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "t"))), lambda x: x["t"]).alias("texts"))
        .checkpoint()
    )
    kind = transcripts.schema[conv_id].dataType

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.table(_lines(t)).reshape(-1) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.float64()))], names=["c", "chunk", "best"])

    fields = [T.StructField("c", kind), T.StructField("chunk", T.LongType())]
    best = chunks.mapInArrow(tables, T.StructType([*fields, T.StructField("best", T.ArrayType(T.DoubleType()))])).checkpoint()
    seams = seam_states(best, model.start, fan)
    seams = seams.withColumnsRenamed({"c": "sc", "chunk": "sk"})
    known = chunks.join(seams, F.col("c").eqNullSafe(F.col("sc")) & (F.col("chunk") == F.col("sk"))).select(
        "c", "chunk", "texts", "first", "following")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whose: list[int] = []
            segments: list[tuple[bool, int, str, str]] = []
            for i, (texts, first, after) in enumerate(zip(*[batch.column(k).to_pylist() for k in (2, 3, 4)], strict=True)):
                lines = _lines(texts)
                mine = _segments(lines, shared.value.path(lines, first, after), after)
                whose += [i] * len(mine)
                segments += mine
            places = np.arange(len(whose)) - np.searchsorted(whose, whose) if whose else np.empty(0, np.int64)
            picked = pa.array(whose, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(picked), batch.column(1).take(picked), pa.array(places, pa.int64()),
                 pa.array([int(s[0]) for s in segments], pa.int32()),
                 pa.array([ROLES[s[1]] for s in segments], pa.string()),
                 pa.array([s[2] for s in segments], pa.string()), pa.array([s[3] for s in segments], pa.string())],
                names=["c", "chunk", "place", "begins", "role", "content", "rendered"])

    parts = known.mapInArrow(decode, T.StructType([
        *fields, T.StructField("place", T.LongType()), T.StructField("begins", T.IntegerType()),
        T.StructField("role", T.StringType()), T.StructField("content", T.StringType()),
        T.StructField("rendered", T.StringType())])).checkpoint()
    # Turns are numbered from the small columns; a part that begins none belongs to the turn before.
    small = rows_before(parts.select("c", "chunk", "place", "begins"), ["c"], ["chunk", "place"], "begins", "turn")
    small = small.select(
        F.col("c").alias("sc"), F.col("chunk").alias("sk"), F.col("place").alias("sp"),
        (F.col("turn") + F.col("begins") - 1).alias("turn"))
    same = F.col("c").eqNullSafe(F.col("sc")) & (F.col("chunk") == F.col("sk")) & (F.col("place") == F.col("sp"))
    joined = parts.join(small, same)
    return joined.select(
        F.col("c").alias(conv_id), "turn",
        F.col("chunk").alias("part"), "role", "content", "rendered",
    )
