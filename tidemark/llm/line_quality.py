"""Quality rules: counts within a text, and lines that too many documents of a host share.

Only DataFrame functions are used, and texts are read in one pass. Its small result
is written once: the counts, a hash of the text, and per distinct normalised line a
hash and its words. Lines are counted per host over documents, copies of a text
included; sums are formed before the shuffle, and a line that owns a large share of the
rows arrives as one row per task.

A line is removed if more than ``max_documents`` documents of its host have it, however
many the host has. A document is depleted, and rejected, if under ``min_left``
of its words or under ``min_words`` words are left.

Defined results: a null text counts as empty; it has no words and fails the base
rules. Lines without a word are no lines here. A null host is a host of its own.
Repeated rows are documents each, and are judged each, alike. Columns of the input named like a result are
replaced, all others are kept; the text itself is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import let
from ..session import checkpoint_root
from .common import packed

_BLANKS = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
           "removed_words")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, _BLANKS), "")


def lines_of(text: Column) -> Column:
    """Lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(_WORD))


def normalised(line: Column) -> Column:
    """Lower case, one blank between words, every digit a zero."""
    return F.regexp_replace(F.lower(F.array_join(words_of(line), " ")), r"[0-9]", "0")


def repeated_words(words: Column, width: int = 5) -> Column:
    """Words inside windows of ``width`` words that occur more than once, all occurrences included."""
    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - width),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]),
        )

    def covered(found: Column) -> Column:
        pairs = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(ordered: Column) -> Column:
            return F.filter(
                ordered,
                lambda x, i: F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)),
            )

        places = let(pairs, lambda ordered: F.sort_array(F.transform(twice(ordered), lambda x: x["i"])))
        # Each window counts up to the next repeated one.
        spans = let(places, lambda p: F.transform(
            p, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(p, i + 1) - x, F.lit(width)))))
        return F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))

    none = F.lit(0).cast("bigint")
    counted = let(
        let(F.transform(words, lambda w: F.xxhash64(w)), windows),
        lambda found: F.when(F.size(F.array_distinct(found)) == F.size(found), none).otherwise(covered(found)),
    )
    return F.when(F.size(words) > width, counted).otherwise(none)


def measured(docs: DataFrame, text: str, host: str) -> DataFrame:
    """One row per document with its counts, ``_host``, ``_hash`` of the text and ``_lines`` (hash, words).

    The other columns are in the struct ``_row``.
    """
    parsed = packed(docs, {"_text": text, "_host": host}, (text, *RESULTS)).withColumn(
        "_text", F.coalesce("_text", F.lit(""))
    ).withColumns({"_words": words_of(F.col("_text")), "_own": lines_of(F.col("_text"))})
    by_line = F.transform("_own", lambda line: F.struct(
        F.xxhash64(normalised(line)).alias("hash"), F.size(words_of(line)).alias("words")))
    return parsed.select(
        "_row", F.col("_host").cast("string").alias("_host"),
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        (F.size("_own") - F.size(F.array_distinct("_own"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.xxhash64("_text").alias("_hash"), by_line.alias("_lines"),
    )


def frequent_lines(rows: DataFrame, max_documents: int) -> DataFrame:
    """``(_host, line)`` of the lines that more documents of their host have, from rows of ``measured``.

    A row lists a line of its document once here, so partial counts before the shuffle are counts of documents.
    """
    seen = rows.select("_host", F.explode(F.array_distinct(F.transform("_lines", lambda x: x["hash"]))).alias("line"))
    return seen.groupBy("_host", "line").count().filter(F.col("count") > max_documents).select("_host", "line")


def quality_rules(
    docs: DataFrame, text: str = "text", host: str = "source", max_documents: int = 20,
    min_left: float = 0.5, min_words: int = 10,
) -> DataFrame:
    """Every row's columns but the text, with the counts, ``removed_words``, ``base_failed`` and ``kept``."""
    checkpoint_root(docs.sparkSession)
    rows = measured(docs, text, host).checkpoint()
    often = frequent_lines(rows, max_documents).withColumnsRenamed({"_host": "_h", "line": "_l"})
    own = rows.select("_host", "_hash", F.explode("_lines").alias("_line"))
    # The words of one document's removed lines; copies of a text on a host share the sum.
    per_line = own.groupBy("_host", "_hash", F.col("_line.hash").alias("_line_hash")).agg(
        F.sum("_line.words").alias("_words"), F.count(F.lit(1)).alias("_times"))
    copies = rows.groupBy("_host", "_hash").agg(F.count(F.lit(1)).alias("_copies"))
    hit = per_line.join(often, F.col("_host").eqNullSafe(F.col("_h")) & (F.col("_line_hash") == F.col("_l")))
    removed = hit.groupBy(F.col("_host").alias("_rh"), F.col("_hash").alias("_rt")).agg(F.sum("_words").alias("_gone"))
    removed = removed.join(
        copies.withColumnsRenamed({"_host": "_ch", "_hash": "_ct"}),
        F.col("_rh").eqNullSafe(F.col("_ch")) & (F.col("_rt") == F.col("_ct")),
    ).select("_rh", "_rt", (F.col("_gone") / F.col("_copies")).cast("bigint").alias("_gone"))
    joined = rows.join(removed, F.col("_host").eqNullSafe(F.col("_rh")) & (F.col("_hash") == F.col("_rt")), "left")
    gone = F.coalesce("_gone", F.lit(0).cast("bigint"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - gone
    return joined.select(
        "_row.*", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        gone.alias("removed_words"), failed.alias("base_failed"),
        (~failed & (left >= min_left * F.col("n_words")) & (left >= min_words)).alias("kept"),
    )


def remove_lines(
    docs: DataFrame, text: str = "text", host: str = "source", max_documents: int = 20,
) -> DataFrame:
    """``docs`` with the lines above the limits taken out of the text."""
    checkpoint_root(docs.sparkSession)
    rows = measured(docs.select(F.col(text).alias("_t"), F.col(host).alias("_s")), "_t", "_s").checkpoint()
    often = frequent_lines(rows, max_documents)
    own = rows.select("_host", "_hash", F.explode("_lines").alias("_line")).select("_host", "_hash", "_line.hash")
    same = F.col("_host").eqNullSafe(F.col("_h")) & (F.col("hash") == F.col("_l"))
    hit = own.join(often.withColumnsRenamed({"_host": "_h", "line": "_l"}), same).groupBy("_host", "_hash").agg(
        F.collect_set("hash").alias("_removed"))
    whole = packed(docs, {"_text": text, "_of": host}).withColumn("_key", F.xxhash64(F.coalesce("_text", F.lit(""))))
    joined = whole.join(hit, F.col("_of").cast("string").eqNullSafe(F.col("_host")) & (F.col("_key") == F.col("_hash")), "left")
    lines = F.filter(F.split("_text", "\n"), lambda line: ~(
        line.rlike(_WORD) & F.array_contains("_removed", F.xxhash64(normalised(line)))))
    clean = F.when(F.col("_removed").isNull(), F.col("_text")).otherwise(F.array_join(lines, "\n"))
    return joined.select(*[clean.alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
