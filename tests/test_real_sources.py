"""The registered specs on the real tables, where their folders are given.

TABLEMEND_SOURCES names the folder of clone tables, TABLEMEND_FEATURES the folder
of feature files with their index 10x_files.csv.
"""

from __future__ import annotations

import os

import pytest
from conftest import rows

from tablemend.operators.rows import unmatched_rows
from tablemend.plans import audits
from tablemend.plans import catalogue as cat
from tablemend.plans import source_specs as specs
from tablemend.sources.delimited import read_delimited
from tablemend.sources.tables import cut_lineage

SOURCES, FEATURES = os.environ.get("TABLEMEND_SOURCES"), os.environ.get("TABLEMEND_FEATURES")
pytestmark = pytest.mark.skipif(not (SOURCES and FEATURES), reason="no real source tables given")


def test_real_sources(spark):
    missing = ["PomboAntunes_2021"]
    tables = specs.harmonise_folder(spark, SOURCES, absent=missing)
    index = read_delimited(spark, f"{FEATURES}/10x_files.csv")
    parts = [*tables.values(), specs.harmonise_feature_files(spark, FEATURES, index)]
    unified = cut_lineage(cat.unify(parts), "real")
    assert rows(audits.row_conservation(parts, unified), "conserved") == [(True,)]
    assert rows(audits.sentinels(unified)) == []
    # Every correction finds its row, so the keys are spelled as the corrections expect.
    stray = set()
    for patch, by in specs.catalogue_corrections(spark):
        stray |= {r["Study"] for r in unmatched_rows(unified, patch, by).collect()}
        unified = cut_lineage(cat.correct(unified, [(patch, by)], small=True), "real")
    assert stray == set(missing)
