"""Row predicates of the crawl and of body handling."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import lru_cache

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..functions.common import col
from ..functions.paths import ancestors, extension, strip_trailing_slash

log = logging.getLogger(__name__)

MAX_FILE_SIZE = 256 * 1024 * 1024
BODY_CAP = 50_000_000
HEADER_BODY_CAP = 102_400_000


def _compiles(pattern: str) -> bool:
    jvm = SparkSession.active()._jvm
    try:
        jvm.java.util.regex.Pattern.compile(pattern)
    except IllegalArgumentException:  # a PatternSyntaxException is one
        return False
    return True


@lru_cache(maxsize=256)
def _checked(patterns: tuple[str, ...]) -> tuple[str | None, tuple[str, ...]]:
    """The usable patterns as one expression, and those that do not compile.

    Spark matches with Java's expressions, so the session's JVM is asked, not Python.
    """
    usable = [p for p in patterns if _compiles(p)]
    dropped = tuple(p for p in patterns if p not in usable)
    for pattern in dropped:
        log.warning("ignoring invalid name pattern %r", pattern)
    joined = "|".join(f"(?:{p})" for p in usable)
    return (rf"\A(?:{joined})\z" if usable else None), dropped


@dataclass(frozen=True)
class PathRules:
    """Crawl rules. Name patterns match the whole path; types are compared exactly.

    Patterns that do not compile are left out, with a warning; ``dropped`` names them.
    Patterns are compiled when the rules are first used in a session.
    """

    exclude_names: tuple[str, ...] = ()
    include_types: tuple[str, ...] = ()
    exclude_types: tuple[str, ...] = ()
    max_size: int = MAX_FILE_SIZE

    @property
    def dropped(self) -> tuple[str, ...]:
        return _checked(tuple(self.exclude_names))[1]

    @property
    def _names(self) -> str | None:
        return _checked(tuple(self.exclude_names))[0]

    def keeps_name(self, path: Column | str) -> Column:
        return ~col(path).rlike(self._names) if self._names else F.lit(True)

    def keeps_type(self, path: Column | str) -> Column:
        """Includes first, then excludes; a path without an extension is kept."""
        kind = extension(path)
        keep = F.lit(True)
        if self.include_types:
            keep = keep & kind.isin(*self.include_types)
        if self.exclude_types:
            keep = keep & ~kind.isin(*self.exclude_types)
        return F.coalesce(keep, F.lit(True))

    def keeps_path(self, path: Column | str, is_dir: Column | None = None) -> Column:
        """Name rule for everything, type rule for files only."""
        path = strip_trailing_slash(path)
        typed = self.keeps_type(path)
        return self.keeps_name(path) & (typed if is_dir is None else (is_dir | typed))

    def keeps_subtree(self, path: Column | str, floor: int = 0) -> Column:
        """False below a folder the name rules refuse; tested on the row's own ancestors."""
        if not self._names:
            return F.lit(True)
        return ~F.exists(ancestors(path, floor), lambda folder: folder.rlike(self._names))

    def keeps_size(self, size: Column | str) -> Column:
        return col(size) < self.max_size

    def keeps_entry(self) -> Column:
        """Whole rule for a listing row (path, is_dir, size)."""
        is_dir = F.col("is_dir")
        return (
            self.keeps_path("path", is_dir)
            & self.keeps_subtree("path")
            & (is_dir | self.keeps_size("size"))
        )


def capped_body(body: Column | str, cap: int = BODY_CAP) -> Column:
    """The body, or null when it is longer than the cap."""
    return F.when(F.octet_length(col(body)) <= cap, col(body))


def has_indexable_content(stub: Column, size: Column, cap: int = HEADER_BODY_CAP) -> Column:
    """False for a stub, an empty body or one above the cap."""
    return ~F.coalesce(stub, F.lit(False)) & (F.coalesce(size, F.lit(0)) > 0) & (size <= cap)
