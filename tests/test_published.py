from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tablemend.plans import published as p
from tablemend.plans.audits import Watch


def jobs(spark, run):
    """Number of Spark jobs that a call starts."""
    spark.sparkContext.setJobGroup("counted", "counted")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_versions_become_visible_only_after_their_audits(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="nothing is published"):
        p.read_published(spark, path)
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    assert p.publish(df, path, never={"negative": F.col("i") < 0}) == 1
    for audit in ({"never": {"any": F.lit(True)}}, {"empty": {"no b": lambda t: t.where("s IS NULL")}}):
        with pytest.raises(p.AuditFailed, match="nothing is published"):
            p.publish(df.where("i = 2"), path, **audit)
    assert rows(p.read_published(spark, path)) == rows(df)
    # Another shape is another version; old ones stay readable.
    assert p.publish(df.withColumn("more", F.lit(1)), path, partition_by=["s"]) == 2
    assert sorted(p.read_published(spark, path).columns) == ["i", "more", "s"]
    assert rows(p.read_published(spark, path, 1)) == rows(df)
    assert rows(p.versions(spark, path).select("version", "n_rows", F.col("metrics")["null:s"])) == [(1, 2, 1), (2, 2, 1)]
    with pytest.raises(ValueError, match="version 3"):
        p.read_published(spark, path, 3)


def test_a_lost_row_is_found_and_an_empty_table_is_a_version(spark, tmp_path):
    path, watch = str(tmp_path / "t"), Watch()
    halves = [watch.on(spark.range(10).where(f"id % 2 = {i}"), f"h{i}") for i in range(2)]
    whole = halves[0].union(halves[1])
    with pytest.raises(p.AuditFailed, match="10 rows went in, 9 came out"):
        p.publish(whole.where("id <> 3"), path, watch=watch, conserves=["h0", "h1"])
    watch = Watch()
    assert p.publish(watch.on(spark.range(0), "none"), path, watch=watch, conserves=["none"]) == 1
    assert p.read_published(spark, path).count() == 0


def test_watching_needs_no_job_of_its_own(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "i int, `a b` string")
    watch = Watch()
    parts = [watch.on(df.where("i < 3"), "low"), watch.on(df.where("i >= 3"), "high", conditions={"it's odd": F.col("i") % 2 == 1})]
    whole = watch.on(parts[0].union(parts[1]), "whole", census=True)
    alone = jobs(spark, lambda: df.where("i < 3").union(df.where("i >= 3")).write.parquet(str(tmp_path / "a")))
    assert jobs(spark, lambda: whole.write.parquet(str(tmp_path / "b"))) == alone
    seen = []
    assert jobs(spark, lambda: seen.append((watch.values("whole"), watch.values("high"), watch.conserved(["low", "high"], "whole")))) == 0
    assert seen == [({"n_rows": 3, "null:i": 0, "null:a b": 2}, {"n_rows": 1, "it's odd": 1}, True)]
    with pytest.raises(ValueError, match="already"):
        watch.on(df, "low")
