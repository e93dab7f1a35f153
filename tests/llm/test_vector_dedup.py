from __future__ import annotations

from pathlib import Path

import numpy as np
import pytest
from conftest import TABLES
from llm.helpers import dicts

from tablemend.llm import vector_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, cls int, n int, leader int, root int, links int, component int, __h1 int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, 3, 4, 5, 6, 7) for i, v, label in rows], SCHEMA)


def brute(rows, cosine=0.98):
    """(vec_id, n_links, component_id, kept) of every row, by comparing all."""
    unit = []
    for i, v, label in rows:
        ok = i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        w = np.array(v, np.float32).astype(float) if ok else None
        unit.append(w / np.abs(w).max() / np.sqrt(((w / np.abs(w).max()) ** 2).sum()) if ok else None)
    n = len(rows)
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in range(n)]
    component = [r[0] for r in rows]
    while True:
        after = [min([component[i], *(component[j] for j in near[i])]) if near[i] else component[i] for i in range(n)]
        if after == component:
            break
        component = after
    return sorted(((r[0], len(near[i]), component[i], r[0] is None or r[0] == component[i]) for i, r in enumerate(rows)), key=repr)


def got(df):
    return sorted((tuple(r[c] for c in ("vec_id", "n_links", "component_id", "kept")) for r in dicts(df)), key=repr)


def clusters(rng, d=16):
    """Chains, tight groups, copies and scaled copies over three labels."""
    rows, i = [], 0
    for label in (0, 1, 2):
        for _ in range(12):
            centre = rng.normal(size=d)
            for _ in range(int(rng.integers(1, 9))):
                rows.append((i, [float(np.float32(x)) for x in centre + rng.normal(size=d) * rng.choice([0.02, 0.1, 0.2])], label))
                i += 1
    rows += [(i + k, rows[2][1], 0) for k in range(60)] + [(i + 60 + k, [float(np.float32(3 * x)) for x in rows[2][1]], 0) for k in range(3)]
    return rows


@pytest.mark.parametrize("how", [{}, {"block": 3}, {"hot_rows": 1, "sampled": 2}, {"hot_rows": 1, "sampled": 1, "block": 5}])
def test_against_all_pairs(spark, how):
    rows = clusters(np.random.default_rng(3))
    same = rows[0][1]
    rows += [(rows[5][0], rows[5][1], rows[5][2]), (9000, None, 0), (9001, [], 0), (9002, [0.0] * 16, 0), (9003, [1.0, None] * 8, 0), (9004, [float("nan")] * 16, 0), (9005, [float("inf")] * 16, 0), (None, same, 0), (9006, same, None), (9007, same, 2), (9008, same[:3], 0), (9009, [-x for x in same], 0), (9010, [1e-30] * 16, 0), (9011, [2e30] * 16, 0)]
    assert got(vector_dedup.near_duplicates(table(spark, rows).repartition(3), **how)) == brute(rows)


def test_edges(spark):
    assert vector_dedup.near_duplicates(table(spark, [])).count() == 0
    rows = [(4, [1.0], 1), (3, [2.0], 1), (5, [-1.0], 1), (7, [0.0, 1.0], 1), (8, [-0.0, 1.0], 1), (9, [1.0, 0.0], 2)]
    assert got(vector_dedup.near_duplicates(table(spark, rows))) == brute(rows)
    assert got(vector_dedup.near_duplicates(table(spark, [(1, None, 1), (2, [1.0, 2.0], None)]))) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_a_dense_group_gives_no_pairs(spark):
    """Three hundred vectors that all link: every link counted once, a few rows a vector."""
    rng = np.random.default_rng(4)
    centre = rng.normal(size=32)
    rows = [(i, [float(np.float32(x)) for x in centre + rng.normal(size=32) * 0.05], 0) for i in range(300)]
    found = vector_dedup.classes(table(spark, rows))
    links = vector_dedup.class_links(found, 0.98, 64, 10**6, 16, tables=6, rotations=4, probes=6)
    assert links.count() < 300 * 40
    assert got(vector_dedup.near_duplicates(table(spark, rows), block=64)) == brute(rows)


def test_rotations_keep_lengths_and_buckets_find_neighbours():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert np.allclose((vector_dedup.rotated(x[:50], 2, 3) ** 2).sum(axis=2), 1)
    off = rng.normal(size=x.shape)
    off -= (off * x).sum(1, keepdims=True) * x
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * off / np.linalg.norm(off, axis=1, keepdims=True)
    a, b = (vector_dedup.bucket_codes(v, 6, 4, 6) for v in (x, y))
    assert ((a[:, :, :1] == b).any(axis=2) | (b[:, :, :1] == a).any(axis=2)).any(axis=1).mean() > 0.998
    far = ((a[:, :, :1] == np.roll(a, 1, axis=0)).any(axis=2)).any(axis=1).mean()
    assert far < 0.01


@pytest.mark.skipif(not Path(TABLES).exists(), reason="no test tables")
def test_tables(spark):
    df = spark.read.parquet(f"{TABLES}/embeddings.parquet")
    assert got(vector_dedup.near_duplicates(df)) == brute([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()])
