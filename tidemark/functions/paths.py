"""Path and facet functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col, let, no_strings

SLASH = "/"
ESCAPED_SLASH = "%2F"


def _path_fragments(text: Column, separator: str) -> Column:
    """Split, keeping leading empties and dropping trailing ones."""

    def trimmed(parts: Column) -> Column:
        last = F.array_max(F.transform(parts, lambda x, i: F.when(x != "", i + 1)))
        keep = F.when(F.size(parts) == 1, F.lit(1)).otherwise(F.coalesce(last, F.lit(0)))
        return F.slice(parts, F.lit(1), keep)

    return let(F.split(text, separator), trimmed)


def hier_facets(path: Column | str, separator: str = SLASH) -> Column:
    """Numbered prefixes of a path: ``0/a/``, ``1/a/b/``, … (empty for null)."""
    text = F.replace(col(path), F.lit('"'), F.lit(""))
    text = (
        F.when(text.startswith("file://"), F.substr(text, F.lit(8)))
        .when(text.startswith("smb:"), F.substr(text, F.lit(7)))
        .otherwise(text)
    )

    def facets(parts: Column) -> Column:
        return F.transform(
            parts,
            lambda _, i: F.concat(
                i.cast("string"), F.lit(SLASH),
                F.array_join(F.slice(parts, F.lit(1), i + 1), SLASH), F.lit(SLASH),
            ),
        )

    escaped = F.transform(
        _path_fragments(text, separator),
        lambda x: F.replace(x, F.lit(SLASH), F.lit(ESCAPED_SLASH)),
    )
    return F.coalesce(let(escaped, facets), no_strings())


def has_parent(path: Column | str) -> Column:
    """True when a slash lies beyond the first character."""
    return F.instr(F.substr(col(path), F.lit(2)), SLASH) > 0


def parent_folder(path: Column | str) -> Column:
    """The text before the last slash; the path itself when it has no parent."""
    return F.when(
        has_parent(path), F.regexp_replace(col(path), r"/[^/]*\z", "")
    ).otherwise(col(path))


def file_name(path: Column | str) -> Column:
    return F.substring_index(col(path), SLASH, -1)


def extension(path: Column | str) -> Column:
    """What follows the last dot of the last path element; null when there is none."""
    found = F.regexp_extract(file_name(path), r"\.([^.]+)\z", 1)
    return F.when(found != "", found)


def strip_trailing_slash(path: Column | str) -> Column:
    return F.regexp_replace(col(path), r"/\z", "")


def slash_normalise(path: Column | str) -> Column:
    return F.translate(col(path), "\\", "/")


def normalise_root(path: Column | str) -> Column:
    """One spelling for the roots a crawl may start from; always ends with a slash."""
    path = col(path)
    forward = slash_normalise(path)
    root = (
        F.when(path.startswith("smb:\\"), forward)
        .when(path.startswith("smb:"), path)
        .when(
            path.startswith("\\\\"),
            F.concat(F.lit("smb://"), slash_normalise(F.regexp_replace(path, r"\A\\+", ""))),
        )
        .when(path.startswith(SLASH), F.concat(F.lit("file://"), path))
        .when(path.rlike(r"\A[a-zA-Z]:"), F.concat(F.lit("file://"), forward))
        .otherwise(path)
    )
    return F.when(root.endswith(SLASH), root).otherwise(F.concat(root, F.lit(SLASH)))


def crate_path(path: Column | str) -> Column:
    """The inventory spelling of a folder: no scheme, leading slash unless it names a drive."""
    bare = F.regexp_replace(col(path), r"\Afile://", "")
    rooted = F.when(
        bare.startswith(SLASH) | (F.instr(bare, ":") > 1), bare
    ).otherwise(F.concat(F.lit(SLASH), bare))
    return strip_trailing_slash(rooted)


def depth(path: Column | str) -> Column:
    """Number of non-empty elements."""
    return F.size(F.array_remove(F.split(strip_trailing_slash(path), SLASH), ""))


def level_below(path: Column | str, root: Column | str) -> Column:
    """Task level: path depth below its crawl root (0 for the root itself)."""
    return (depth(path) - depth(root)).cast("int")


def ancestors(path: Column | str, floor: int = 0) -> Column:
    """Every proper ancestor folder, shortest first.

    ``floor`` drops that many leading levels: ancestors at or above the crawl
    root match every row and would only create hot keys.
    """

    def prefixes(parts: Column) -> Column:
        count = F.size(parts) - 1
        joined = F.transform(
            F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
            lambda n: F.array_join(F.slice(parts, F.lit(1), n), SLASH),
        )
        return F.filter(
            F.when(count >= 1, joined).otherwise(no_strings()),
            lambda p: (p != "") & ~p.endswith(SLASH) & ((depth(p) > floor) if floor else F.lit(True)),
        )

    return let(F.split(strip_trailing_slash(path), SLASH), prefixes)
