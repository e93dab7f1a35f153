"""Tables that become visible only after their audits: written aside, checked, then named in a manifest that readers follow.

A published table is a folder with ``data-...`` folders, one per version, and a ``manifest`` table with a row per version.
Adding the manifest row is the one step that makes a version visible; a failed audit, or a job that dies before it,
leaves the version before as it was. Metrics are gathered by the job that writes; nothing is read again for them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablemend.plans.audits import Watch
from tablemend.sources.tables import write_table

MANIFEST = "version long, folder string, schema string, n_rows long, metrics map<string, long>"


class AuditFailed(ValueError):
    """An audit found something; nothing was published."""


def publish(
    df: DataFrame,
    path: str,
    never: Mapping[str, Column] | None = None,
    empty: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
    watch: Watch | None = None,
    conserves: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> int:
    """Write a new version of the table, check it, and make it the one that readers get; its number.

    ``never`` names conditions that no row may meet, counted while the table is written. ``empty`` names audits, functions of the
    stored table, whose result must be empty. ``conserves`` names inputs watched by ``watch`` whose rows must add
    up to the rows of the table. The first audit that fails stops with ``AuditFailed``.
    """
    watch = watch or Watch()
    folder = f"{path}/data-{uuid.uuid4().hex}"
    name = f"published-{uuid.uuid4().hex}"
    watched = watch.on(df, name, conditions=never or {}, census=True)
    write_table(watched, folder, partition_by)
    stored = df.sparkSession.read.schema(df.schema).parquet(folder)
    found = watch.values(name)
    for audit in never or {}:
        # A stage that ran again counts twice; what matters here is only whether anything was counted.
        if found[audit]:
            raise AuditFailed(f"{audit}: {found[audit]} rows; nothing is published")
    n_rows = found["n_rows"]
    if conserves:
        n_parts = sum(watch.values(part)["n_rows"] for part in conserves)
        if n_parts != n_rows:
            # Stages that ran again are counted twice: count once more before stopping.
            n_rows, n_parts = stored.count(), sum(watch.counted(part) for part in conserves)
        if n_parts != n_rows:
            raise AuditFailed(f"{n_parts} rows went in, {n_rows} came out; nothing is published")
    for audit, check in (empty or {}).items():
        if not check(stored).isEmpty():
            raise AuditFailed(f"{audit}: rows found; nothing is published")
    spark = df.sparkSession
    version = max((r["version"] for r in _manifest(spark, path).select("version").collect()), default=0) + 1
    row = spark.createDataFrame([(version, folder, df.schema.json(), n_rows, {k: v for k, v in found.items() if v is not None})], MANIFEST)
    row.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return version


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per published version; without any, an empty table."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The published versions with their rows and metrics, for audits over time."""
    return _manifest(spark, path).select("version", "n_rows", "metrics")


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest published version, or the one asked for; folders that no manifest names are never read."""
    rows = _manifest(spark, path)
    if version is not None:
        rows = rows.where(F.col("version") == version)
    # Two writers at once may take one number; all readers then agree on the same of the two.
    row = rows.orderBy(F.col("version").desc(), F.col("folder").desc()).first()
    if row is None:
        raise ValueError(f"nothing is published at {path}" + ("" if version is None else f" as version {version}"))
    return spark.read.schema(StructType.fromJson(json.loads(row["schema"]))).parquet(row["folder"])
