"""Small expression helpers shared by the function modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for use inside ``body``.

    Lambdas of higher-order functions re-evaluate every outer expression they
    mention; binding keeps a split or a filter from running once per element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def strings(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def no_strings() -> Column:
    return F.array().cast("array<string>")


def whole_number(text: Column | str, kind: str = "bigint") -> Column:
    """Digits with an optional sign, else null; no blanks, fractions or exponents."""
    text = col(text)
    return F.when(text.rlike(r"\A[+-]?[0-9]+\z"), text.try_cast(kind))


def text_or_null_word(value: Column) -> Column:
    return F.coalesce(value, F.lit("null"))
