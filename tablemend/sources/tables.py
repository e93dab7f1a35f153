"""Parquet tables, literal tables, nested names, written results and lineage cuts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemend.operators.columns import col


def literal_table(spark: SparkSession, columns: str, rows: Sequence[tuple]) -> DataFrame:
    """A table whose rows are written out in a program: columns as 'A string, B double'."""
    return spark.createDataFrame(list(rows), columns)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table, such as a reference vocabulary."""
    return spark.read.format(fmt).load(path)


def names_to_rows(df: DataFrame, keys: Sequence[str], array: str, name: str) -> DataFrame:
    """One row per distinct name from a table that holds arrays of names."""
    return df.select(*[col(k) for k in keys], F.explode(col(array)).alias(name)).distinct()


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Store a result at a path of its own; Spark cannot overwrite what the plan still reads.

    Rows are rebalanced by the partition columns first: small partitions become one
    file each, and one that holds a third of all rows is split over many tasks.
    """
    target = urlparse(path).path.rstrip("/") + "/"
    if mode == "overwrite" and any(urlparse(f).path.startswith(target) for f in df.inputFiles()):
        raise ValueError(f"the result still reads {path}; write to another path")
    if partition_by:
        df = df.hint("rebalance", *[F.col(p) for p in partition_by])
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("nullValue", "NA")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def work_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, from ``spark.checkpoint.dir``, or where that is unset from ``tablemend.work.dir``.

    One must be set: no folder of one machine takes its place.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("tablemend.work.dir", None)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the table to the shared work folder and go on from the files.

    Steps that read their input twice would otherwise double the plan each time.
    The files survive the loss of executors; they lie in a folder named after the
    application and may go once its results are stored.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{spark.conf.get('spark.app.id', 'session')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
