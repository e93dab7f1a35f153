"""Results per source that are computed again only for sources that changed.

Every source has a digest of all its input rows, whatever their order. The results lie in folders, one for each run that computed
something; a manifest says for each version which source's rows lie in which folder and from what digest they came. A run reads the
inputs once for the digests, computes the sources whose digest is new, and writes a manifest that names the old folders for the rest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablemend.operators.columns import col
from tablemend.plans.reconcile import LABEL, NameRule, reconcile
from tablemend.sources.tables import write_table

MANIFEST = "version long, label string, digest string, folder string, schema string"
Compute = Callable[[dict[str, DataFrame]], DataFrame]


def digests(inputs: Mapping[str, DataFrame], label: str = LABEL, version: str = "") -> DataFrame:
    """(label, digest): one digest per source over all its rows in all inputs, of any order; repeated rows count.

    ``version`` stands for what is done with them: another one makes every digest new. Columns count by name.
    """
    parts = []
    for name, df in inputs.items():
        columns = sorted(c for c in df.columns if c != label)
        row = F.xxhash64(F.lit(name), *[x for c in columns for x in (F.lit(c), col(c), col(c).isNull())])
        other = F.xxhash64(F.lit(version), row)
        parts.append(df.select(col(label).cast("string").alias("label"), row.alias("one"), other.alias("other")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionAll(p)
    # Sums of wide decimals do not run over, and unlike bit_xor they see rows that repeat.
    summed = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("one").cast("decimal(38,0)")).alias("s"), F.sum(F.col("other").cast("decimal(38,0)")).alias("t"))
    shape = json.dumps({name: sorted(df.dtypes) for name, df in inputs.items()})
    return summed.select("label", F.sha2(F.concat_ws(" ", F.lit(version), F.lit(shape), "n", "s", "t"), 256).alias("digest"))


def _manifest(spark: SparkSession, path: str) -> list:
    """The rows of the newest version: one per source."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    newest = rows.agg(F.max("version")).first()[0]
    return rows.where(F.col("version") == newest).collect()


def _of(label: str, wanted: list[str | None]) -> Column:
    """Is the label one of these? A NULL label may be."""
    known = col(label).isin([w for w in wanted if w is not None])
    return F.coalesce(known, F.lit(None in wanted))


def read_sources(spark: SparkSession, path: str, label: str = LABEL) -> DataFrame:
    """The newest results of all sources."""
    rows = _manifest(spark, path)
    if not rows:
        raise ValueError(f"no results at {path}")
    folders: dict[tuple[str, str], list[str | None]] = {}
    for r in rows:
        folders.setdefault((r["folder"], r["schema"]), []).append(r["label"])
    out = None
    for (folder, schema), labels in sorted(folders.items()):
        # Stored by label: a filter on it opens only the folders of these sources.
        part = spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(folder).where(_of(label, labels))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def incremental(inputs: Mapping[str, DataFrame], compute: Compute, path: str, label: str = LABEL, version: str = "") -> list[str | None]:
    """Bring the results at ``path`` up to date and return the labels that were computed.

    ``compute`` gets the inputs cut to the changed sources and gives their rows, each with its source's label; a source's
    rows must depend on that source's input alone. Sources that are in no input any more leave the results.
    """
    spark = next(iter(inputs.values())).sparkSession
    # One row per source, as many as there are specs.
    now = {r["label"]: r["digest"] for r in digests(inputs, label, version).collect()}
    before = {r["label"]: r for r in _manifest(spark, path)}
    changed = [name for name, digest in now.items() if name not in before or before[name]["digest"] != digest]
    kept = [before[name] for name in now if name not in changed]
    if not changed and len(kept) == len(before):
        return []
    number = max((r["version"] for r in before.values()), default=0) + 1
    rows = [(number, r["label"], r["digest"], r["folder"], r["schema"]) for r in kept]
    if changed:
        result = compute({name: df.where(_of(label, changed)) for name, df in inputs.items()})
        folder = f"{path}/part-{uuid.uuid4().hex}"
        write_table(result, folder, [label])
        rows += [(number, name, now[name], folder, result.schema.json()) for name in changed]
    # The one step that makes the version visible.
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return sorted(changed, key=lambda c: (c is None, c or ""))


def reconcile_changed(catalogue: DataFrame, observed: DataFrame, rules: Mapping[str, NameRule], path: str, version: str = "", **how) -> list[str | None]:
    """Like ``reconcile``, but only for sources whose catalogue rows or observed names changed; read the whole with ``read_sources``.

    The rules are code, which no digest sees: give another ``version`` when they change.
    """
    inputs = {"catalogue": catalogue, "observed": observed}
    return incremental(inputs, lambda cut: reconcile(cut["catalogue"], cut["observed"], rules, **how), path, LABEL, version)
