"""SimHash near-duplicates by multi-index hashing.

A fingerprint has a bit set where over half of the hashes of a text's word
shingles have it set. Two fingerprints link at ``radius`` or fewer differing
bits, four by default. Of two halves one then differs in two bits at most, so the
balls of one bit around these halves meet: every fingerprint enumerates the ball
of both halves (66 keys), equal keys are brought together, and each meeting is
verified over the whole 64 bits.

A bucket gives back a spanning forest of its links, never all pairs, and equal
fingerprints are one row before any of this. A bucket beyond ``bucket_limit``
fingerprints is not held: its members enumerate the ball of half the radius
around the whole fingerprint, where a shared key alone proves a link, so those
links come from a pre-aggregated minimum by key. Components are found round by
round on Spark.

Defined results: a null, empty or blank text has fingerprint zero, linked like any
other. Fewer words than a shingle give one shingle of all words. Repeated rows and
repeated ids are kept; each row gets its component. Other columns are kept; columns
named like a result are replaced. An empty table gives no rows. A null id is kept
and counts as no document when the smallest id is chosen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_root
from .common import free_name, packed, schema_with, with_arrays
from .components import components

SEED = 42
_ONES = np.uint64(0x0101010101010101)
#: Lower-cases A-Z; the blanks of bytes.split() are those of the word pattern.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 255):  # a byte counts to 255
        part = hashes[start:start + 255]
        lanes = np.array([((part >> np.uint64(j)) & _ONES).sum(dtype=np.uint64) for j in range(8)], dtype="<u8")
        counts += lanes.view(np.uint8).reshape(8, 8).T.reshape(64)  # [byte, j] is bit 8 * byte + j
    return sum(1 << int(i) for i in np.flatnonzero(2 * counts > len(hashes)))


def fingerprint(text: bytes, width: int = 4) -> int:
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    count = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*[words[i:] for i in range(width)])) if len(words) > width else [b" ".join(words)]
    return majority(np.fromiter((digest(s, SEED) for s in shingles), dtype=np.uint64, count=count))


def add_fingerprints(docs: DataFrame, text: str = "text", width: int = 4, name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a (signed) long."""
    schema = schema_with(docs, T.StructField(name, T.LongType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
            found = np.fromiter((fingerprint(t or b"", width) for t in texts), dtype=np.uint64, count=len(texts))
            yield with_arrays(batch, [(name, pa.array(found.view(np.int64)))])

    return docs.mapInArrow(run, schema)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.reshape(-1).view(np.int64))


def half_balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of both halves' one-bit balls: the half's number above its 32 bits."""
    flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(32, dtype=np.uint64)])
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for half in range(2):
            part = (fp >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
            keys = (part[:, None] ^ flips) | np.uint64(half << 32)
            yield pa.RecordBatch.from_arrays([_signed(keys), _signed(np.repeat(fp, 33))], names=["key", "fp"])


def whole_balls(radius: int):
    """Keys of the ball of ``radius`` bits around whole fingerprints."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = ball = np.zeros(1, np.uint64)
        for _ in range(radius):
            ball = np.unique(ball[:, None] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64)))
            flips = np.union1d(flips, ball)
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for start in range(0, len(fps), 256):
                fp = fps[start:start + 256]
                yield pa.RecordBatch.from_arrays(
                    [_signed(fp[:, None] ^ flips), _signed(np.repeat(fp, len(flips)))], names=["key", "fp"]
                )
    return run


def _forest(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the fingerprints of one bucket: each is reached once."""
    rest, froms, tos = fp, [], []
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            node = frontier.pop()
            near = np.bitwise_count(rest ^ node) <= radius
            if near.any():
                reached, rest = rest[near], rest[~near]
                froms.append(np.full(len(reached), node))
                tos.append(reached)
                frontier.extend(reached)
    return (np.concatenate(froms), np.concatenate(tos)) if tos else (fp[:0], fp[:0])


SMALL = 16


def bucket_links(radius: int, limit: int):
    """Links of the buckets of rows ``(key, fp)`` sorted by key.

    Gives ``(a, b)`` for a verified link and ``(fp, null)`` for a member of a bucket
    beyond the limit. At most ``limit`` fingerprints of an unfinished bucket are held.
    """
    def emit(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
        other = pa.nulls(len(a), pa.int64()) if b is None else _signed(b)
        return pa.RecordBatch.from_arrays([_signed(a), other], names=["a", "b"])

    def finish(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole buckets, sorted by key, each within the limit."""
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        member = np.repeat(sizes, sizes)
        few = (member > 1) & (member <= SMALL)
        k, f = key[few], fp[few]
        for step in range(1, SMALL):  # all buckets at once, member against the one `step` further on
            if len(k) <= step:
                break
            near = (k[step:] == k[:-step]) & (np.bitwise_count(f[step:] ^ f[:-step]) <= radius)
            if near.any():
                yield emit(f[:-step][near], f[step:][near])
        for at in np.flatnonzero(sizes > SMALL):
            a, b = _forest(fp[starts[at]:starts[at] + sizes[at]], radius)
            if len(a):
                yield emit(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = np.empty(0, np.int64), np.empty(0, np.uint64)
        over = None  # the key of a bucket that went beyond the limit
        for batch in batches:
            key = np.concatenate([held_key, batch.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([held, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if over is not None:
                same = int(np.searchsorted(key, over, side="right"))
                if same:
                    yield emit(fp[:same], None)
                key, fp = key[same:], fp[same:]
            if not len(key):
                held_key, held = key, fp
                continue
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            large = np.repeat(sizes > limit, sizes)
            if large.any():
                yield emit(fp[large], None)
            last = np.arange(len(key)) >= starts[-1]
            over = key[-1] if sizes[-1] > limit else None
            done = ~large & ~last
            if done.any():
                yield from finish(key[done], fp[done])
            stay = last & ~large
            held_key, held = key[stay], fp[stay]
        if len(held):
            yield from finish(held_key, held)

    return run


def fingerprint_links(fps: DataFrame, radius: int = 4, bucket_limit: int = 4096) -> DataFrame:
    """``(a, b)``: links that connect exactly the distinct fingerprints ``fp`` that link."""
    if radius not in (0, 2, 4):
        raise ValueError("one-bit balls of two halves, and whole balls of half the radius, prove radius 0, 2 and 4")
    checkpoint_root(fps.sparkSession)
    # A few bytes for each fingerprint become 66 keys, so they are dealt out by number, not by size.
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = fps.select("fp").repartition(tasks, "fp").mapInArrow(half_balls, "key long, fp long")
    found = (
        keyed.repartition("key").sortWithinPartitions("key")
        .mapInArrow(bucket_links(radius, bucket_limit), "a long, b long")
        .distinct().checkpoint()
    )
    links = found.filter("b is not null")
    rest = found.filter("b is null").select(F.col("a").alias("fp")).distinct()
    if rest.isEmpty():
        return links
    wide = rest.mapInArrow(whole_balls(radius // 2), "key long, fp long")
    least = wide.groupBy("key").agg(F.min("fp").alias("a"), F.max("fp").alias("m")).filter("a <> m")
    return links.unionByName(wide.join(least, "key").filter("fp <> a").select("a", F.col("fp").alias("b")).distinct())


def _printed(docs: DataFrame, text: str, width: int) -> DataFrame:
    """Every column but the text, with ``_fp`` and ``_text_hash``; written once, read often."""
    checkpoint_root(docs.sparkSession)
    hashed = docs.withColumn("_text_hash", F.xxhash64(F.col(text)))
    return add_fingerprints(hashed, text, width, "_fp").drop(text).checkpoint()


def _roots(printed: DataFrame, radius: int, bucket_limit: int) -> DataFrame:
    """``(_fp, _root)`` of every distinct fingerprint."""
    fps = printed.select(F.col("_fp").alias("fp")).distinct().checkpoint()
    found = components(fingerprint_links(fps, radius, bucket_limit))
    return fps.join(found, fps.fp == found.node, "left").select(
        F.col("fp").alias("_fp"), F.coalesce("root", "fp").alias("_root")
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4,
    bucket_limit: int = 4096,
) -> DataFrame:
    """Every row's columns but the text, with ``fingerprint`` (16 hex digits) and ``component_id``.

    The component's id is the smallest id reachable, the row's own included.
    """
    made = (text, "fingerprint", "component_id")
    printed = _printed(packed(docs, {"_id": doc_id, "_text": text}, made), "_text", width)
    roots = _roots(printed, radius, bucket_limit)
    by_print = printed.groupBy("_fp").agg(F.min("_id").alias("_id"))  # copies are one row from here on
    rooted = by_print.join(roots, "_fp")
    ids = rooted.groupBy("_root").agg(F.min("_id").alias("_component"))
    named = rooted.join(ids, "_root").select("_fp", "_component")
    return printed.join(named, "_fp").select(
        "_row.*", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), F.col("_component").alias("component_id"),
    )


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4,
    bucket_limit: int = 4096,
) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the smallest id, then text hash.

    A component without any id keeps one of its rows. Of full copies under one id
    one row stays.
    """
    printed = _printed(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")), "_text", width)
    choice = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_text_hash").alias("hash"))
    best = printed.groupBy("_fp").agg(F.min(choice).alias("_best"))
    kept = (
        best.join(_roots(printed, radius, bucket_limit), "_fp").groupBy("_root").agg(F.min("_best").alias("_best"))
        .select(F.col("_best.id").alias("_kept_id"), F.col("_best.hash").alias("_kept_hash")).distinct()
    )
    name = free_name(docs, "_text_hash")
    hashed = docs.withColumn(name, F.xxhash64(F.col(text)))
    same = hashed[doc_id].eqNullSafe(kept["_kept_id"]) & (hashed[name] == kept["_kept_hash"])
    return hashed.join(kept, same, "left_semi").dropDuplicates([doc_id, name]).drop(name)
