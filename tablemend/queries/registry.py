"""Registry of named queries."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablemend.sources.tables import work_folder

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


class Tables:
    """The test tables of one folder, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def new_folder(self, name: str) -> str:
        """A folder not used before, in the work folder; a local session that names none gets one of its own."""
        self.with_work_folder()
        return f"{work_folder(self.spark)}/{name}-{uuid.uuid4().hex}"

    def with_work_folder(self) -> Tables:
        named = self.spark.conf.get("spark.checkpoint.dir", None) or self.spark.conf.get("tablemend.work.dir", None)
        if not named and self.spark.conf.get("spark.master").startswith("local"):
            self.spark.conf.set("tablemend.work.dir", tempfile.mkdtemp(prefix="tablemend-"))
        return self

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of the tables under a name, with its SQL twin."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(sorted(_QUERIES.items()))


def oracle_sql() -> dict[str, str]:
    return dict(sorted(_SQL.items()))
