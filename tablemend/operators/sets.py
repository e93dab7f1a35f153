"""Set operations over rows and columns, each with one map-side combined shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.operators.columns import col
from tablemend.operators.joins import HOT_ROWS, anti_join, shared_columns


def union_sources(tables: Sequence[DataFrame]) -> DataFrame:
    """Union of tables with different columns; missing columns are NULL.

    A column must have the same type everywhere: Spark would otherwise coerce
    text to numbers. Duplicates are kept. The unions form a balanced tree, so the
    plan of n tables is log n deep.
    """
    if not tables:
        raise ValueError("nothing to union")
    types: dict[str, str] = {}
    for df in tables:
        for name, dtype in df.dtypes:
            if types.setdefault(name, dtype) != dtype:
                raise TypeError(f"column {name!r} is {types[name]} in one table and {dtype} in another")
    names_seen: dict[str, str] = {}
    for name in types:
        other = names_seen.setdefault(name.lower(), name)
        if other != name:
            raise ValueError(f"columns {other!r} and {name!r} differ only by case")
    level = [
        df.select(*[col(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in types.items()])
        for df in tables
    ]
    while len(level) > 1:
        level = [level[i].unionAll(level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct."""
    return df.distinct()


def _tagged(a: DataFrame, b: DataFrame) -> DataFrame:
    if sorted(a.columns) != sorted(b.columns):
        raise ValueError(f"tables differ in columns: {a.columns} and {b.columns}")
    left = a.select("*", F.lit(1).alias("__a"), F.lit(0).alias("__b"))
    right = b.select(*[col(c) for c in a.columns], F.lit(0).alias("__a"), F.lit(1).alias("__b"))
    return left.unionAll(right)


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``; NULL equals NULL."""
    return one_sided(a, b, "__side").where(F.col("__side") == "left").drop("__side")


def one_sided(a: DataFrame, b: DataFrame, side: str = "side") -> DataFrame:
    """Distinct rows found in only one table, tagged 'left' or 'right'."""
    seen = _tagged(a, b).groupBy(*[col(c) for c in a.columns]).agg(F.max("__a").alias("__a"), F.max("__b").alias("__b"))
    tag = F.when(F.col("__b") == 0, "left").when(F.col("__a") == 0, "right")
    return seen.withColumn(side, tag).where(col(side).isNotNull()).drop("__a", "__b")


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with both counts; empty when the tables are equal."""
    counts = _tagged(a, b).groupBy(*[col(c) for c in a.columns]).agg(F.sum("__a").alias("n_left"), F.sum("__b").alias("n_right"))
    return counts.where("n_left <> n_right")


def coverage(values: DataFrame, column: str, allowed: DataFrame, allowed_column: str) -> DataFrame:
    """One row: how many rows of ``column`` occur, or do not, in another table's column.

    ``n_null`` counts the NULL rows; they are covered only if the other column has a NULL.
    """
    left = values.select(col(column).alias("v"), F.lit(1).alias("n"), F.lit(0).alias("ok"))
    right = allowed.select(col(allowed_column).alias("v"), F.lit(0).alias("n"), F.lit(1).alias("ok"))
    per_value = left.unionAll(right).groupBy("v").agg(F.sum("n").alias("n"), F.max("ok").alias("ok"))
    zero = F.lit(0).cast("long")
    return per_value.agg(
        F.coalesce(F.sum(F.when(F.col("ok") == 1, F.col("n"))), zero).alias("n_covered"),
        F.coalesce(F.sum(F.when(F.col("ok") == 0, F.col("n"))), zero).alias("n_uncovered"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), zero).alias("n_null"),
    )


def upsert_union(preferred: DataFrame, base: DataFrame, on: Sequence[str] | None = None, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """The preferred rows plus the base rows they do not replace (by shared columns if no key is given)."""
    keys = shared_columns(base, preferred) if on is None else on
    return union_sources([preferred, anti_join(base, preferred, keys, hot_rows=hot_rows)])


def collisions(df: DataFrame, column: str, rewrite: Column, name: str = "rewritten") -> DataFrame:
    """Values that would become equal under ``rewrite``, so the rewrite is not safe as a key."""
    return (
        df.select(rewrite.alias(name), col(column).alias("__old"))
        .distinct()
        .groupBy(col(name))
        .agg(F.count(F.lit(1)).alias("n_values"), F.min("__old").alias("first_value"), F.max("__old").alias("last_value"))
        .where("n_values > 1")
    )
