"""Checks that return tables; ``require_empty`` turns one into a hard stop."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tablemend.functions.nulls import matches
from tablemend.operators.columns import col
from tablemend.operators.joins import anti_join
from tablemend.operators.sets import one_sided


class Watch:
    """Metrics gathered by the job that reads or writes a table, without a job of their own.

    ``on`` returns the table with the counting built in; once a job has run over it, ``values`` has the counts. A
    stage that runs again after a lost executor may be counted twice, so a count that must agree is confirmed by
    ``counted``, a job of its own, before it stops anything.
    """

    def __init__(self) -> None:
        self._seen: dict[str, tuple[Observation, DataFrame, dict[str, str]]] = {}

    def on(self, df: DataFrame, name: str, conditions: Mapping[str, Column] | None = None, census: bool | Sequence[str] = False) -> DataFrame:
        """Count rows as ``n_rows``, rows that meet each condition, and with ``census`` the NULLs of all or some columns as ``null:column``."""
        if name in self._seen:
            raise ValueError(f"{name!r} is watched already")
        counts = {"n_rows": F.count(F.lit(1))} | {c: F.count_if(F.coalesce(condition, F.lit(False))) for c, condition in (conditions or {}).items()}
        columns = (df.columns if census is True else census) or ()
        counts |= {f"null:{c}": F.count_if(col(c).isNull()) for c in columns}
        # Metric names are numbered: a condition may be named as it likes.
        names = {f"m{i}": c for i, c in enumerate(counts)}
        observation = Observation()
        self._seen[name] = (observation, df, names)
        return df.observe(observation, *[counts[c].alias(m) for m, c in names.items()])

    def values(self, name: str) -> dict[str, int]:
        """The counts of a watched table; waits for the first job over it."""
        observation, _, names = self._seen[name]
        return {names[m]: v for m, v in observation.get.items()}

    def counted(self, name: str) -> int:
        """The rows of a watched table, counted again by a job of its own."""
        return self._seen[name][1].count()

    def conserved(self, parts: Sequence[str], whole: str) -> bool:
        """Do the rows of the parts add up to those of the whole?"""
        seen = sum(self.values(p)["n_rows"] for p in parts) == self.values(whole)["n_rows"]
        return seen or sum(self.counted(p) for p in parts) == self.counted(whole)


def row_conservation(parts: Sequence[DataFrame], whole: DataFrame) -> DataFrame:
    """One row: rows of all parts, rows of the whole, and whether they agree."""
    counts = [p.agg(F.count(F.lit(1)).alias("n_parts"), F.lit(0).cast("long").alias("n_whole")) for p in parts]
    counts.append(whole.agg(F.lit(0).cast("long").alias("n_parts"), F.count(F.lit(1)).alias("n_whole")))
    both = counts[0]
    for one in counts[1:]:
        both = both.unionAll(one)
    return both.agg(F.sum("n_parts").alias("n_parts"), F.sum("n_whole").alias("n_whole")).withColumn(
        "conserved", F.col("n_parts") == F.col("n_whole")
    )


def missing_labels(found: DataFrame, expected: DataFrame, column: str) -> DataFrame:
    """Source labels present in only one of two tables."""
    return one_sided(found.select(col(column)), expected.select(col(column)))


def unannotated(df: DataFrame, id_column: str = "ALT_ID", control: str = "Isotype_Control") -> DataFrame:
    """Rows without an identifier that are no controls."""
    return df.where(is_unannotated(id_column, control))


def count_conditions(df: DataFrame, conditions: Mapping[str, Column], by: Sequence[str] = ("Study",)) -> DataFrame:
    """Rows per source that meet each condition, one line per source and condition, in one pass."""
    counted = df.groupBy(*[col(b) for b in by]).agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
    return counted.unpivot(list(by), list(conditions), "audit", "n")


def is_unannotated(id_column: str = "ALT_ID", control: str = "Isotype_Control") -> Column:
    """Row without an identifier that is no control."""
    return col(id_column).isNull() & ~F.coalesce(col(control), F.lit(False))


def is_sentinel(column: str = "Cat_Number", sentinel: str = "ERROR") -> Column:
    """Row whose value no rule could classify."""
    return F.coalesce(col(column) == sentinel, F.lit(False))


def sentinels(df: DataFrame, column: str = "Cat_Number", sentinel: str = "ERROR") -> DataFrame:
    """Number of rows per source whose value no rule could classify."""
    marked = df.where(is_sentinel(column, sentinel))
    return marked.groupBy("Study").agg(F.count(F.lit(1)).alias("n"))


def unlike(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose value is missing or does not have the expected form."""
    return df.where(~matches(col(column), pattern))


def unused_names(result: DataFrame, observed: DataFrame, name: str = "Data_Name", label: str = "Study") -> DataFrame:
    """Observed names that did not reach the result."""
    return anti_join(observed, result, [label, name])


def require_empty(audit: DataFrame, message: str) -> None:
    """Stop if the audit found anything; looks at one row only."""
    if not audit.isEmpty():
        raise ValueError(message)


def labels_of(specs: Mapping[str, object] | Sequence[str], spark, column: str = "Study") -> DataFrame:
    """The registered source labels as a table."""
    return spark.createDataFrame([(s,) for s in specs], f"{column} string")
