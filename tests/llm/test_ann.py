from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest
from conftest import TABLES
from llm.helpers import dicts
from pyspark.sql import functions as F

from tablemend.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, query_id int, score int, rank int, c1 int, chunk int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3, 4, 5) for i, v in rows], SCHEMA)


def brute(rows, top):
    """{query: [(vec_id, score)]} by whole search."""
    ok = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in ok:
        if q % 20 == 0:
            out[q] = sorted(((float((v * w).sum()), i) for i, w in ok if i != q), key=lambda x: (-x[0], x[1]))[:top]
    return out


def rows_of(rng, n, d=8):
    rows = [(i, [float(np.float32(rng.gauss(0, 1))) for _ in range(d)]) for i in range(n)]
    same = rows[3][1]
    rows += [(n + k, list(same)) for k in range(60)]
    return rows + [(5000, None), (5001, []), (5002, [0.0] * d), (5003, [1.0, None] * (d // 2)), (5004, [float("nan")] * d), (5020, [float("inf")] * d), (None, same)]


@pytest.mark.parametrize(("chunk", "at_most"), [(4096, 8192), (7, 8192), (50, 3)])
def test_whole_search(spark, chunk, at_most):
    rows = rows_of(random.Random(1), 230)
    out = dicts(ann.search(table(spark, rows), F.col("vec_id") % 20 == 0, centroids=4, share=1.0, chunk=chunk, at_most=at_most))
    want = brute(rows, 20)
    got = {}
    for r in sorted(out, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=0, atol=1e-12)


def test_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (20, [-1.0, 0.0]), (20, [-1.0, 0.0]), (3, [1.0])]
    out = dicts(ann.search(table(spark, rows), F.col("vec_id") % 20 == 0))
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out) == [(0, 1, 1, 1.5), (0, 2, 20, -1.0), (0, 3, 20, -1.0), (20, 1, 1, -0.5), (20, 2, 0, -1.0)]
    assert ann.search(table(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_order_is_by_summed_distance():
    rng = np.random.default_rng(2)
    index = ann.Index(rng.normal(size=(9, 3)), rng.normal(size=(7, 4)))
    for q in rng.normal(size=(20, 7)):
        a, b = ann.distances(q[None, :3], index.first)[0], ann.distances(q[None, 3:], index.second)[0]
        sums = [a[i] + b[j] for i, j in index.order(q)]
        assert len(sums) == len(set(index.order(q))) == 63 and all(x <= y + 1e-12 for x, y in zip(sums, sums[1:], strict=False))


@pytest.mark.skipif(not Path(TABLES).exists(), reason="no test tables")
def test_recall(spark):
    """The index sees fewer vectors than a whole search and finds at least nine tenths of the nearest."""
    df = spark.read.parquet(str(Path(TABLES).parent / "sf0.1" / "embeddings.parquet"))
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = brute(rows, 20)
    got = {}
    for r in dicts(ann.search(df, F.col("vec_id") % 20 == 0)):
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    found = np.mean([len(got[q] & {i for _, i in near}) / len(near) for q, near in want.items()])
    assert found >= 0.9
