"""Declarative description of one source, and the job that applies it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.functions.split import NON_ALNUM, separate
from tablemend.operators import columns as c
from tablemend.operators.columns import col
from tablemend.operators.joins import HOT_ROWS, join_any
from tablemend.operators.rows import rows_update
from tablemend.sources.delimited import ReadOptions

Steps = Callable[[], Sequence[tuple[str, Column]]]


@dataclass(frozen=True)
class Split:
    """Cut one column into several."""

    column: str
    into: tuple[str | None, ...]
    sep: str = NON_ALNUM
    extra: str = "drop"
    fill: str = "right"
    remove: bool = True


@dataclass(frozen=True)
class Parse:
    """Read columns out of a text by one declared pattern.

    Group n of the pattern is column ``into[n - 1]`` (None: not kept); an empty or
    missing group is NULL. Where the text does not match, the columns in ``whole``
    hold the text and the others are NULL. ``within`` limits the part to rows for
    whose text this pattern holds; other rows keep what their columns had.
    """

    column: str
    pattern: str
    into: tuple[str | None, ...]
    whole: tuple[str, ...] = ()
    within: str | None = None


@dataclass(frozen=True)
class Lookup:
    """Take columns from a named table by the first key that matches."""

    table: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class SourceSpec:
    """How one source table becomes catalogue rows.

    The parts apply in the order they are listed here. ``derive`` and ``where``
    are functions because Spark columns need a running session.
    """

    label: str | None
    source: str
    read: ReadOptions = ReadOptions()
    optional: bool = False
    literal: tuple[str, Sequence[tuple]] | None = None
    lookup: Lookup | None = None
    rename: Mapping[str, str] = field(default_factory=dict)
    split: Sequence[Split] = ()
    parse: Sequence[Parse] = ()
    derive: Steps | None = None
    where: Callable[[], Column] | None = None
    constants: Mapping[str, str] = field(default_factory=dict)
    corrections: Sequence[tuple[str, Sequence[str], Sequence[tuple]]] = ()
    keep: Sequence[str] | None = None
    drop: Sequence[str] = ()
    drop_matching: str | None = None
    distinct: bool = False


def parsed(df: DataFrame, part: Parse) -> DataFrame:
    """Add the columns a part reads out of a text."""
    text = col(part.column)
    met = text.rlike(part.pattern)
    values = {}
    for number, name in enumerate(part.into, start=1):
        if name is not None:
            value = F.when(met, F.nullif(F.regexp_extract(text, part.pattern, number), F.lit("")))
            if name in part.whole:
                value = F.when(~met, text).otherwise(value)
            if part.within is not None:
                before = col(name) if name in df.columns else F.lit(None)
                value = F.when(text.rlike(part.within), value).otherwise(before)
            values[name] = value
    return df.withColumns(values)


def harmonise(df: DataFrame, spec: SourceSpec, tables: Mapping[str, DataFrame] | None = None, label_column: str = "Study", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """One source table in catalogue shape, labelled with its source."""
    if spec.lookup is not None:
        df = join_any(df, (tables or {})[spec.lookup.table], spec.lookup.keys, hot_rows=hot_rows)
    if spec.rename:
        df = c.rename(df, spec.rename)
    for s in spec.split:
        df = separate(df, s.column, s.into, s.sep, s.extra, s.fill, s.remove)
    for p in spec.parse:
        df = parsed(df, p)
    if spec.derive is not None:
        df = c.derive(df, spec.derive())
    if spec.where is not None:
        df = df.where(spec.where())
    if spec.constants:
        df = df.withColumns({name: F.lit(value) for name, value in spec.constants.items()})
    if spec.label is not None:
        df = df.withColumn(label_column, F.lit(spec.label))
    for schema, by, rows in spec.corrections:
        df = rows_update(df, df.sparkSession.createDataFrame(list(rows), schema), by, small=True)
    if spec.keep is not None:
        df = c.keep(df, spec.keep)
    if spec.drop:
        df = c.drop(df, spec.drop)
    if spec.drop_matching is not None:
        df = c.drop_matching(df, spec.drop_matching)
    return df.distinct() if spec.distinct else df
