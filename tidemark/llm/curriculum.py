"""Mixing sources to target weights by a time-varying curriculum.

Every source has a weight schedule: knots ``(time, weight)`` over times 0 to 1, linear in
between. Its integral over all times is the source's weight in the mix, and gives its
target of words: ``share`` times all words by weight, no target above ``max_repeats``
times its source, the excess dealt again by weight until no target is above. The
integral up to a time is the source's cumulative demand. Documents of a source stand in
an order drawn from their ids, one after the other, and once more after the last where
the target exceeds the source; the time at which the demand reaches a document's first
word, the inverse of the cumulative demand, is its training position. ``mixed`` sorts
the takes of all sources by range of position.

The last document that a target reaches is taken up to the target's word, so a source
gives its target rounded to a whole word, and no document exceeds ``max_repeats`` times
its size.

Running totals within a source, which may hold a third of all rows, come from range
slices (``rows_before``), over ids and sizes only. Targets are found by rounds of small
aggregates over the table of sources; what reaches the driver is three numbers a round.
Sums are of whole numbers, so reruns agree in every digit.

Defined results: a null text has size 0. A null source is a source of its own; last in
the order of sources, which is by code point. A document without words, or of a source
without target, takes 0 and has no position. Repeated rows and ids are documents each;
null ids are kept. Without any word all targets are 0; an empty table gives no rows.
Other columns are kept; columns named like a result are replaced, and the text is left
out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import let
from ..operators.numbering import row_number, rows_before
from ..session import checkpoint_root
from .common import packed

Knots = Sequence[tuple[float, float]]

_WORD = r"[^\x20\x09-\x0D]+"
#: Weights are counted in millionths, so that their sums are exact.
UNIT = 1_000_000
#: Tables of sources up to here, some hundred bytes each, are broadcast.
BROADCAST_SOURCES = 100_000
RESULTS = ("size", "source_size", "target", "taken", "takes")


def sizes(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def pieces(knots: Knots) -> list[tuple[float, float, float, float]]:
    """``(start, weight, slope, before)`` of each linear piece; ``before`` is the integral up to its start."""
    knots = sorted((float(t), float(w)) for t, w in knots)
    if not knots or knots[0][0] != 0.0 or knots[-1][0] != 1.0 or any(w < 0 for _, w in knots):
        raise ValueError("a schedule needs knots at times 0 and 1, and no weight below 0")
    made, before = [], 0.0
    for (t, w), (u, v) in zip(knots, knots[1:]):
        if u > t:
            made.append((t, w, (v - w) / (u - t), before))
            before += (w + v) / 2.0 * (u - t)
    return made


def integral(knots: Knots) -> float:
    t, w, slope, before = pieces(knots)[-1]
    return before + w * (1.0 - t) + slope / 2.0 * (1.0 - t) ** 2


def inverse(schedule: Column, reached: Column) -> Column:
    """The time at which the integral of the pieces is ``reached``."""
    def time(piece: Column) -> Column:
        rest = reached - piece["before"]
        root = F.sqrt(F.greatest(piece["weight"] * piece["weight"] + 2.0 * piece["slope"] * rest, F.lit(0.0)))
        return piece["start"] + F.when(rest <= 0.0, 0.0).otherwise(2.0 * rest / (piece["weight"] + root))

    # The last piece that begins at or below what is reached; pieces without weight are passed over.
    own = F.filter(schedule, lambda p: (p["before"] <= reached) & ((p["weight"] > 0.0) | (p["slope"] > 0.0)))
    return let(F.try_element_at(own, F.lit(-1)), time)


def scheduled(sources: DataFrame, schedules: Sequence[Knots]) -> DataFrame:
    """``(_source, _size, _weight, _schedule)``: schedules dealt to the sources in order, repeating.

    ``sources`` has ``_source`` (null last) and ``_size``.
    """
    ranked = row_number(sources.withColumn("_none", F.col("_source").isNull()), [], ["_none", "_source"], "_rank")
    turn = F.pmod(F.col("_rank") - 1, F.lit(len(schedules)))
    weight = schedule = None
    for i, knots in enumerate(schedules):
        total = F.lit(round(integral(knots) * UNIT)).cast("bigint")
        linear = F.array(*[
            F.struct(*[F.lit(v).alias(n) for n, v in zip(("start", "weight", "slope", "before"), p, strict=True)])
            for p in pieces(knots)])
        weight = total if weight is None else F.when(turn == i, total).otherwise(weight)
        schedule = linear if schedule is None else F.when(turn == i, linear).otherwise(schedule)
    return ranked.select("_source", "_size", weight.alias("_weight"), schedule.alias("_schedule"))


def with_targets(sources: DataFrame, share: float, max_repeats: float) -> DataFrame:
    """``sources`` (``_size``, ``_weight``) with ``_target``: shares by weight, capped, the excess dealt again.

    A round caps the sources above their cap and deals what is left to the others;
    capped ones stay capped, as what is left per weight only grows.
    """
    checkpoint_root(sources.sparkSession)
    fixed = sources.checkpoint()
    cap = F.lit(max_repeats) * F.col("_size")
    whole = fixed.agg(F.coalesce(F.sum("_size"), F.lit(0)).alias("n")).first()["n"]
    budget, rate = share * whole, 0.0
    while True:
        over = cap < F.col("_weight") * F.lit(rate)
        row = fixed.agg(
            F.coalesce(F.sum(F.when(over, F.col("_size"))), F.lit(0)).alias("capped"),
            F.coalesce(F.sum(F.when(~over, F.col("_weight"))), F.lit(0)).alias("weight"),
        ).first()
        new = (budget - max_repeats * row["capped"]) / row["weight"] if row["weight"] else rate
        if new <= rate:
            break
        rate = new
    return fixed.withColumn("_target", F.least(cap, F.col("_weight") * F.lit(rate)).cast("double"))


def plan(
    docs: DataFrame, schedules: Sequence[Knots], doc_id: str = "doc_id", text: str = "text", source: str = "source",
    share: float = 1.5, max_repeats: float = 2.0, seed: str = "mix",
) -> DataFrame:
    """Every row of ``docs`` with ``RESULTS``; ``takes`` lists ``(position, copy, words)`` of the row in the mix.

    ``copy`` counts from 0; a take of fewer words than the row's size is its first words.
    """
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("_id").cast("string"), F.lit(""))))
    rows = packed(docs, {"_id": doc_id, "_text": text, "_of": source}, (text, *RESULTS)).select(
        "_row", F.col("_of").cast("string").alias("_source"), sizes(F.col("_text")).alias("_n"), key.alias("_key"))
    checkpoint_root(docs.sparkSession)
    rows = rows.checkpoint()  # texts are read once: drawing range bounds and slicing read these narrow rows
    placed = rows_before(rows, ["_source"], ["_key", "_n"], "_n", "_before")
    by_source = rows.groupBy("_source").agg(F.sum("_n").alias("_size"))
    mix = with_targets(scheduled(by_source, schedules), share, max_repeats).select(
        F.col("_source").alias("_s"), "_size", "_weight", "_schedule", "_target")
    # A row per source; beyond the bound AQE splits a source that holds many rows.
    if mix.count() <= BROADCAST_SOURCES:
        mix = F.broadcast(mix)
    joined = placed.join(mix, F.col("_source").eqNullSafe(F.col("_s")))
    words = F.floor(F.col("_target") + 0.5).cast("bigint")

    def take(copy: Column) -> Column:
        first = copy.cast("bigint") * F.col("_size") + F.col("_before")
        reached = first / F.when(F.col("_target") > 0, F.col("_target")) * (F.col("_weight") / float(UNIT))
        return F.struct(
            inverse(F.col("_schedule"), reached).alias("position"), copy.cast("int").alias("copy"),
            F.least(F.greatest(words - first, F.lit(0)), F.col("_n")).cast("bigint").alias("words"))

    copies = max(1, int(-(-max_repeats // 1)))
    every = F.array(*[take(F.lit(i)) for i in range(copies)])
    takes = F.when(F.col("_target") > 0, F.filter(every, lambda t: t["words"] > 0)).otherwise(F.filter(every, lambda t: F.lit(False)))
    done = joined.select("_row", "_n", "_size", "_target", takes.alias("_takes"))
    return done.select(
        "_row.*", F.col("_n").alias("size"), F.col("_size").cast("bigint").alias("source_size"),
        F.col("_target").alias("target"),
        F.aggregate("_takes", F.lit(0).cast("bigint"), lambda a, t: a + t["words"]).alias("taken"),
        F.col("_takes").alias("takes"))


def first_position(takes: Column) -> Column:
    """Position of a row's first take, null where it has none."""
    return F.get(takes, F.lit(0))["position"]


def in_order(planned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Rows of ``plan`` sorted by range of their first position, then id; rows without a take last."""
    order = [first_position(F.col("takes")).asc_nulls_last(), F.col(doc_id)]
    return planned.repartitionByRange(*order).sortWithinPartitions(*order)


def mixed(planned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """A row per take in training order: the row's columns, ``position``, ``copy``, ``words``.

    Partitions hold ranges of positions; equal positions follow the id.
    """
    rows = planned.select("*", F.explode("takes").alias("_take")).select(
        *[c for c in planned.columns if c not in ("takes", "position", "copy", "words")], "_take.*")
    return rows.repartitionByRange("position", doc_id, "copy").sortWithinPartitions("position", doc_id, "copy")
