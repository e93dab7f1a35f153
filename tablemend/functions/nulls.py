"""Predicates and choices with one fixed meaning for NULL.

Spark's three-valued logic drops or keeps rows differently from the source
rules this library implements, so each helper states what NULL does.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def matches(col: Column, pattern: str) -> Column:
    """Regex test that is FALSE for NULL, so it can be negated safely."""
    return F.coalesce(col.rlike(pattern), F.lit(False))


def one_of(col: Column, values: Iterable) -> Column:
    """Membership test that is never NULL."""
    return F.coalesce(col.isin(list(values)), F.lit(False))


def if_else(condition: Column, yes, no) -> Column:
    """Two-armed choice; a NULL condition gives NULL, not the second arm."""
    return F.when(condition, yes).when(~condition, no)


def null_if_any(col: Column, values: Iterable) -> Column:
    """NULL where the value is one of the given markers."""
    return F.when(~one_of(col, values), col)


def paste(*cols: Column, sep: str = "", null_text: str | None = "NA") -> Column:
    """Join texts; NULL becomes ``null_text``, or makes the result NULL if that is None."""
    if null_text is not None:
        return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit(null_text)) for c in cols])
    missing = cols[0].isNull()
    for c in cols[1:]:
        missing = missing | c.isNull()
    return F.when(~missing, F.concat_ws(sep, *cols))


def distinct_with_null(col: Column) -> Column:
    """Number of distinct values where NULL counts as one value."""
    return F.count_distinct(col) + F.max(col.isNull().cast("int"))
