from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tablemend.session import tuned  # noqa: E402

TABLES = os.environ.get("TEST_TABLES", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Local tests only: a cluster names its own shared folder.
    work = tmp_path_factory.mktemp("work")
    session = (
        tuned(SparkSession.builder.master("local[4]").appName("tests"), 2)
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(work))
        # Tiny tables: compiling a plan costs more than interpreting it.
        .config("spark.sql.codegen.wholeStage", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as a sorted list of tuples, so that order does not matter."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture
def no_broadcast(spark):
    """Plans as for large tables: no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
