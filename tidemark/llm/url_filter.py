"""URL filter: rules, then a blocked Bloom filter in front of an exact join with a URL list.

Only DataFrame functions are used. The filter is a table of 512-bit blocks, eight
64-bit words each; an address sets one bit in every word of its block. Addresses
whose bits are all set are possible hits, and only they are shuffled to the
listed addresses, which removes the false positives.

Defined results: an address that is null or has no ``://`` has an empty host and
path, fits no rule, is never listed and is allowed. Repeated rows are judged each.
An empty list allows all that no rule blocks. Columns of the input named like a
result are replaced; all others are kept.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import col
from .common import free_name

WORDS = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column | str) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    name = F.regexp_extract(F.coalesce(_rest(col(url)), F.lit("")), r"\A[^/?#]*", 0)
    return F.translate(name, _UPPER, _LOWER)


def path(url: Column | str) -> Column:
    """From the end of the host to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(_rest(col(url)), F.lit("")), r"\A[^/?#]*([^?#]*)", 1)


def canonical(url: Column | str) -> Column:
    """Host without ``www.`` and path without closing slashes; null without a host.

    Scheme, query and fragment do not tell pages apart here: they carry tracking
    and layout parameters.
    """
    name = F.regexp_replace(host(url), r"\Awww\.", "")
    return F.when(F.length(name) > 0, F.concat(name, F.regexp_replace(path(url), r"/+\z", "")))


def best_rule(host_col: Column, path_col: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Verdict and text of the longest rule that fits, else nulls.

    A rule ``name/path`` fits the host and its subdomains if the path starts with
    the rule's. Of rules of one length a blocking one wins, then the first by name.
    """
    verdict = text = F.lit(None).cast("string")
    # The last one wrapped around the others is asked first.
    for kind, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block", [-ord(c) for c in r[1]])):
        name, _, rest = rule.partition("/")
        fits = ((host_col == name) | host_col.endswith("." + name)) & path_col.startswith("/" + rest)
        verdict, text = F.when(fits, F.lit(kind)).otherwise(verdict), F.when(fits, F.lit(rule)).otherwise(text)
    return verdict, text


def _masks(key: Column) -> list[Column]:
    bits = F.xxhash64(key, F.lit(1))
    place = [F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in place]


def bloom_blocks(listed: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """Rows ``(block, w0 … w7)`` of the filter over the keys."""
    block = F.pmod(F.xxhash64(F.col(key)), F.lit(n_blocks))
    marked = listed.filter(F.col(key).isNotNull()).select(
        block.alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col(key)))]
    )
    return marked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def url_filter(
    pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = (), url: str = "url",
    listed_url: str = "url", bits_per_key: int = 16, broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``listed`` and ``verdict``.

    The list is counted first (one small job), so that the filter has
    ``bits_per_key`` bits for each address. It is broadcast only if all its blocks
    fit in ``broadcast_bytes``; a larger one meets the pages by block number.
    """
    keys = listed.select(canonical(listed_url).alias("key")).filter(F.col("key").isNotNull()).distinct()
    count = keys.agg(F.approx_count_distinct("key")).first()[0] or 0
    n_blocks = 1 << max(0, math.ceil(math.log2(max(1, count * bits_per_key / (64 * WORDS)))))
    blocks = bloom_blocks(keys, "key", n_blocks)
    if n_blocks * 16 * (WORDS + 1) <= broadcast_bytes:
        blocks = F.broadcast(blocks)

    kept = [c for c in pages.columns if c.lower() not in {"host", "path", "rule", "listed", "verdict"}]
    key, by_rule = free_name(pages, "_key"), free_name(pages, "_by_rule")
    address = pages.select(
        *[F.col(f"`{c}`") for c in kept], host(F.col(url)).alias("host"), path(F.col(url)).alias("path"),
        canonical(F.col(url)).alias(key),
    )
    verdict, rule = best_rule(F.col("host"), F.col("path"), rules)
    address = address.withColumns({by_rule: verdict, "rule": rule})

    block = free_name(pages, "_block")
    filters = blocks.select(F.col("block").alias(block), *[F.col(f"w{i}").alias(f"{block}{i}") for i in range(WORDS)])
    asked = address.filter(F.col(by_rule).isNull() & F.col(key).isNotNull())
    probed = asked.withColumn(block, F.pmod(F.xxhash64(F.col(key)), F.lit(n_blocks))).join(filters, block, "left")
    possible = F.lit(True)
    for i, mask in enumerate(_masks(F.col(key))):
        possible = possible & (F.coalesce(F.col(f"{block}{i}"), F.lit(0)).bitwiseAND(mask) == mask)

    names = [*kept, "host", "path", "rule"]
    settled = address.filter(F.col(by_rule).isNotNull() | F.col(key).isNull()).select(
        *[F.col(f"`{c}`") for c in names], F.lit(False).alias("listed"),
        F.coalesce(F.col(by_rule), F.lit("allow")).alias("verdict"),
    )
    passed = probed.filter(~possible).select(
        *[F.col(f"`{c}`") for c in names], F.lit(False).alias("listed"), F.lit("allow").alias("verdict")
    )
    mark = free_name(pages, "_mark")
    exact = probed.filter(possible).join(
        keys.select(F.col("key").alias(key), F.lit(True).alias(mark)), key, "left"
    ).select(
        *[F.col(f"`{c}`") for c in names], F.col(mark).isNotNull().alias("listed"),
        F.when(F.col(mark), F.lit("block")).otherwise("allow").alias("verdict"),
    )
    return settled.unionByName(passed).unionByName(exact)
