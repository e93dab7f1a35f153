"""Projection: rename, keep, drop, derive, reorder."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.functions.nulls import paste


def col(name: str) -> Column:
    """A column by exact name; dots and blanks in the name are taken literally."""
    return F.col("`" + name.replace("`", "``") + "`")


def _require(df: DataFrame, names: Iterable[str]) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"no such column: {absent}; table has {df.columns}")


def rename(df: DataFrame, new_to_old: Mapping[str, str]) -> DataFrame:
    """Rename columns; an absent old name is an error."""
    _require(df, new_to_old.values())
    return df.withColumnsRenamed({old: new for new, old in new_to_old.items()})


def rename_with(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """Rename every column by a function of its name."""
    return df.toDF(*[fn(c) for c in df.columns])


def keep(df: DataFrame, names: Sequence[str], absent: str = "error") -> DataFrame:
    """Only the named columns, in that order; ``absent='ignore'`` skips unknown names."""
    if absent == "error":
        _require(df, names)
    return df.select(*[col(n) for n in names if n in df.columns])


def drop(df: DataFrame, names: Sequence[str], absent: str = "error") -> DataFrame:
    """All but the named columns; an absent name is an error unless ignored."""
    if absent == "error":
        _require(df, names)
    return df.drop(*names)


def keep_matching(df: DataFrame, pattern: str) -> DataFrame:
    """The columns whose name contains a match of ``pattern`` (any case)."""
    return df.select(*[col(c) for c in df.columns if re.search(pattern, c, re.IGNORECASE)])


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """All columns but those whose name contains a match of ``pattern`` (any case)."""
    return df.drop(*[c for c in df.columns if re.search(pattern, c, re.IGNORECASE)])


def derive(df: DataFrame, steps: Iterable[tuple[str, Column]]) -> DataFrame:
    """Set columns one after the other, each seeing the ones before it.

    Neighbouring steps that do not read each other still become one projection:
    Catalyst collapses the stages.
    """
    for name, value in steps:
        df = df.withColumn(name, value)
    return df


def across(df: DataFrame, fn: Callable[[Column], Column], names: Sequence[str] | None = None, dtype: str | None = None) -> DataFrame:
    """Apply ``fn`` to the named columns, or to all columns of one type."""
    if names is not None:
        _require(df, names)
    types = dict(df.dtypes)
    chosen = [c for c in df.columns if (names is None or c in names) and (dtype is None or types[c] == dtype)]
    return df.select(*[fn(col(c)).alias(c) if c in chosen else col(c) for c in df.columns])


def relocate(df: DataFrame, front: Sequence[str]) -> DataFrame:
    """Move the named columns to the front."""
    _require(df, front)
    return df.select(*[col(c) for c in front], *[col(c) for c in df.columns if c not in front])


def add_row_id(df: DataFrame, parts: Sequence[str] = ("Antigen", "Study"), name: str = "ID", null_text: str | None = "NA") -> DataFrame:
    """Readable id pasted from columns; not unique per row when the parts repeat."""
    _require(df, parts)
    return df.withColumn(name, paste(*[col(p) for p in parts], sep="__", null_text=null_text))
