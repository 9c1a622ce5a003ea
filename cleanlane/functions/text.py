"""String and coercion expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def title_case(c) -> Column:
    """Python ``str.title``: upper-case the first letter of every run of letters.

    Unlike ``initcap`` (which splits only on spaces, ``'No-Show' -> 'No-show'``),
    any non-letter starts a new word: ``'ta/to' -> 'Ta/To'``, ``'no-show' -> 'No-Show'``.
    A space is inserted after every non-letter, ``initcap`` runs, and exactly the
    inserted spaces are removed again — three built-in string expressions.
    """
    spaced = F.regexp_replace(_c(c), r"(\P{L})", "$1 ")
    return F.regexp_replace(F.initcap(spaced), r"(\P{L}) ", "$1")


def as_text(c, null_text: str | None = "nan") -> Column:
    """pandas ``astype(str)``: nulls become the text ``nan`` unless ``null_text`` is None."""
    s = _c(c).cast("string")
    return s if null_text is None else F.coalesce(s, F.lit(null_text))


def to_number(c) -> Column:
    """pandas ``to_numeric(errors='coerce')`` as double: unparsable and NaN -> null.

    Goes through double so ``'3.7'`` parses (``try_cast('3.7' as bigint)`` is null).
    """
    x = _c(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def to_timestamp_or_null(c) -> Column:
    """``to_datetime(errors='coerce')``: unparsable -> null."""
    col = _c(c)
    return F.coalesce(
        F.try_to_timestamp(col.cast("string")),
        F.try_to_timestamp(col.cast("string"), F.lit("yyyy-MM-dd")),
    )


def contains_ci(c, needle: str) -> Column:
    """Case-insensitive substring test (``needle in value.lower()``)."""
    return F.lower(_c(c)).contains(needle.lower())

