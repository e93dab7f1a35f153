"""Aggregations: collapse groups, count NULLs, report conflicts, elect a value.

All of them combine on the map side, so no task sees the rows of one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.functions.nulls import distinct_with_null
from tablemend.operators.columns import col
from tablemend.operators.joins import HOT_ROWS, attach_groups, rows_of_groups


def collapse_groups(df: DataFrame, keys: Sequence[str], columns: Sequence[str], sep: str = ", ", null_text: str = "NA") -> DataFrame:
    """One row per key; each column lists its distinct values, sorted.

    NULL is listed as ``null_text``; a group of NULLs only stays NULL. Values are
    sorted rather than in first-seen order, which a distributed table does not have.
    """
    listed = [
        F.nullif(
            F.array_join(F.array_sort(F.collect_set(F.coalesce(col(c).cast("string"), F.lit(null_text)))), sep),
            F.lit(null_text),
        ).alias(c)
        for c in columns
    ]
    return df.groupBy(*[col(k) for k in keys]).agg(*listed)


def null_census(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of NULLs per column."""
    return df.agg(*[F.count_if(col(c).isNull()).alias(c) for c in (columns or df.columns)])


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias(name))


def conflicts(df: DataFrame, determinant: Sequence[str], dependent: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Determinant values that come with more than one dependent value, one row per value found.

    ``n_rows`` counts the rows of a value, ``n_values`` and ``n_group`` the values
    and rows of its determinant. Rows with a NULL on either side are no evidence and are left out.
    """
    keys = list(determinant)
    found = (
        df.dropna(subset=[*keys, dependent])
        .groupBy(*[col(d) for d in keys], col(dependent).cast("string").alias("found_value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return _contested(found, keys, hot_rows)


def _contested(found: DataFrame, keys: Sequence[str], hot_rows: int | None) -> DataFrame:
    """Of (determinant, value, number of rows), what belongs to determinants with several values."""
    sums = {"n_values": F.count(F.lit(1)), "n_group": F.sum("n_rows")}
    return attach_groups(found, keys, sums, nulls="never", hot_rows=hot_rows).where("n_values > 1")


def conflict_report(df: DataFrame, rules: Sequence[tuple[Sequence[str], str]], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """All conflicts of several (determinant, dependent) rules in one long table, from one pass over the rows.

    Each row becomes one (rule, determinant, value) row per rule whose columns it knows; these are counted,
    combined on the map side, and everything else works on the counts.
    """
    asked = []
    for number, (determinant, dependent) in enumerate(rules):
        known = col(dependent).isNotNull()
        for d in determinant:
            known = known & col(d).isNotNull()
        values = F.array(*[col(d).cast("string") for d in determinant])
        asked.append(F.when(known, F.struct(F.lit(number).alias("rule"), values.alias("values"), col(dependent).cast("string").alias("found_value"))))
    long = df.select(F.inline(F.array_compact(F.array(*asked))))
    found = long.groupBy("rule", "values", "found_value").agg(F.count(F.lit(1)).alias("n_rows"))
    named = [F.array(*[F.lit(text) for text in texts]) for texts in (["+".join(d) for d, _ in rules], [d for _, d in rules])]
    return _contested(found, ["rule", "values"], hot_rows).select(
        F.get(named[0], "rule").alias("determinant"),
        F.get(named[1], "rule").alias("dependent"),
        F.array_join("values", "|").alias("determinant_value"),
        "found_value",
        "n_rows",
        "n_values",
        "n_group",
    )


def groups_where(df: DataFrame, keys: Sequence[str], condition: Column, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """All rows of the groups for which an aggregate condition holds."""
    return rows_of_groups(df, keys, condition, hot_rows)


def repeated_in_group(df: DataFrame, keys: Sequence[str], value: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """All rows whose value occurs more than once within its group."""
    return groups_where(df, [*keys, value], F.count(F.lit(1)) > 1, hot_rows)


def groups_with_repeats(df: DataFrame, keys: Sequence[str], value: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """All rows of the groups that have fewer distinct values than rows."""
    return groups_where(df, keys, F.count(F.lit(1)) != distinct_with_null(col(value)), hot_rows)


def elect(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    elected: str,
    preference: Column | None = None,
    weight: str | None = None,
) -> DataFrame:
    """The most frequent name of each key (by rows, or by a ``weight`` column); ties go to ``preference`` (low first), then to the first name.

    Two combined aggregations instead of ranking a group in one task.
    """
    named = df.where(col(name).isNotNull())
    rank = F.lit(0) if preference is None else preference
    per_name = named.groupBy(*[col(k) for k in keys], col(name).alias("__name")).agg(
        (F.count(F.lit(1)) if weight is None else F.sum(col(weight))).alias("__n"), F.min(rank).alias("__rank")
    )
    best = F.min(F.struct((-F.col("__n")).alias("n"), F.col("__rank").alias("rank"), F.col("__name").alias("name")))
    return per_name.groupBy(*[col(k) for k in keys]).agg(best.alias("__best")).select(
        *[col(k) for k in keys], F.col("__best.name").alias(elected)
    )


def with_group_size(df: DataFrame, keys: Sequence[str], name: str = "n", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Add the number of rows of the row's group.

    Counted by a combined aggregation and joined back: a window would bring all
    rows of a group into one task.
    """
    return attach_groups(df, keys, {name: F.count(F.lit(1))}, hot_rows=hot_rows)


def null_out_ambiguous(df: DataFrame, keys: Sequence[str], columns: Sequence[str], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """NULL the given columns in every group of more than one row."""
    sized = with_group_size(df, keys, "__n", hot_rows)
    return sized.withColumns({c: F.when(F.col("__n") <= 1, col(c)) for c in columns}).drop("__n")
