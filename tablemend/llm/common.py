"""Helpers shared by the operators: the shared folder, stored tables, Arrow rows, components of a graph."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's binary XXH64 and Python's white-space split agree on these bytes only.
WORD = "[^\\x20\\x09-\\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by spark.checkpoint.dir; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tablemend-")
        spark.sparkContext._jsc.sc().conf().set("spark.checkpoint.dir", folder)
        spark.sparkContext._conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder name not used before, inside the shared folder."""
    return f"{shared_folder(spark)}/tablemend/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, and lost executors cost only their tasks."""
    folder = fresh_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str | None]:
    """One column as Python strings."""
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def ints(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """One integer column without NULLs as a NumPy array."""
    return batch.column(batch.schema.get_field_index(column)).to_numpy(zero_copy_only=False)


def regrouped(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a text column has at most so many bytes in each (one longer text stays alone)."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            before = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, before + most_bytes, side="right")))
            yield batch.slice(at, end - at)
            at = end


def normal_bytes(text: str) -> bytes:
    """The words of a text (cut at ASCII white space), joined by one space, in UTF-8."""
    return b" ".join(text.encode("utf-8", "surrogatepass").split())


def word_bounds(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where the words of joined words start and end."""
    if not joined:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    return np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(joined)]])


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b); the component is its smallest node.

    Rounds of large-star and small-star over joins and combined minima, each stored in the shared folder, until nothing
    changes; the number of rounds follows the logarithm of a component's size. No component meets in one task: a
    node's rows come together only in a MIN that is combined before the shuffle and in a join that splits hot keys.
    Nodes must not be NULL; an edge of a node with itself only names the node.
    """
    pairs = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before: tuple | None = None
    for _ in range(rounds):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        # Large-star: neighbours above a node point to the least of its neighbourhood.
        large = both.where("b >= a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small-star: smaller neighbours of a node, and the node, point to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = large.join(low, F.col("a") == F.col("n")).select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b"))
        pairs = stored(small.distinct(), "edges")
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.max("b"), F.sum((F.col("a") != F.col("b")).cast("int"))).first())
        if now == before:
            return pairs.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
        before = now
    raise RuntimeError("components did not settle")


def sha256_hex(column: Column) -> Column:
    return F.sha2(column, 256)
