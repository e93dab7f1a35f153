"""Contracts that are checked while a job runs, without an action of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.operators.columns import col


def fail_if(condition: Column, message: str) -> Column:
    """A filter that is TRUE, or stops the job on the first row that meets the condition."""
    return F.when(condition, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))


def stop_on(result: DataFrame, bad: DataFrame, message: str) -> DataFrame:
    """The result, unless there is a bad row: the job that reads the result then stops."""
    # The row number keeps the check behind the joins that make the bad rows: Spark would move a plain
    # condition before them, where good rows still are.
    numbered = bad.withColumn("__bad", F.monotonically_increasing_id())
    stray = numbered.where(fail_if(F.col("__bad") >= 0, message))
    none = stray.select(*[F.lit(None).cast(t).alias(c) for c, t in result.dtypes])
    return result.select(*[col(c) for c in result.columns]).unionAll(none)
