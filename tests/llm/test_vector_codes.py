from __future__ import annotations

import hashlib

import numpy as np
import pytest
from llm.helpers import dicts

from tablemend.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code int, error int, entries int, row int, points int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, 3, 4, 5) for i, v, label in rows], SCHEMA)


def brute(rows, parts, entries, rounds):
    """{(vec_id, vector): (code, error)}, {label: error} and the codebooks, by whole search."""
    ok = [(i, np.floor(np.array(v, np.float32).astype(float) * 256).astype(np.int64), label) for i, v, label in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1].tolist()))
    whole = np.array([v for _, v, _ in ok]).reshape(len(ok), parts, -1)
    books = whole[:entries].transpose(1, 0, 2).copy()
    for _ in range(rounds):
        entry = ((whole[:, :, None, :] - books[None]) ** 2).sum(3).argmin(2)
        for j in range(parts):
            for e in range(books.shape[1]):
                if (entry[:, j] == e).any():
                    books[j, e] = whole[entry[:, j] == e, j].sum(0) // (entry[:, j] == e).sum()
    gap = ((whole[:, :, None, :] - books[None]) ** 2).sum(3)
    error, of_label = gap.min(2).sum(1), {}
    for (_, _, label), e in zip(ok, error.tolist(), strict=True):
        of_label[label] = of_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{e:02x}" for e in row), e, of_label[label], digest) for (i, _, label), row, e in zip(ok, gap.argmin(2).tolist(), error.tolist(), strict=True)), key=repr
    )


def got(df):
    return sorted((tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in dicts(df)), key=repr)


@pytest.mark.parametrize("block", [1024, 40])
def test_against_whole_search(spark, block):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=16)], int(i % 3) if i % 7 else None) for i in range(260)]
    # A third of all rows is one vector, and many are ties on a coarse grid.
    rows += [(1000 + i, rows[3][1], 1) for i in range(150)] + [(2000 + i, [float(x) for x in rng.integers(-1, 2, size=16)], 2) for i in range(80)]
    rows += [(5, rows[9][1], 0), (None, rows[8][1], 0), (3000, None, 0), (3001, [], 0), (3002, [1.0, None] * 8, 0), (3003, [float("nan")] * 16, 0), (3004, [float("-inf")] * 16, 0), (3005, [0.0] * 16, None)]
    assert got(vector_codes.digests(table(spark, rows).repartition(3), parts=4, entries=8, block=block)) == brute(rows, 4, 8, 2)


def test_few_rows(spark):
    rows = [(7, [0.5, -0.5], None), (7, [0.5, -0.5], None)]
    assert got(vector_codes.digests(table(spark, rows), parts=2)) == brute(rows, 2, 64, 2)
    assert vector_codes.digests(table(spark, [])).count() == 0
    assert vector_codes.digests(table(spark, [(1, None, 1), (2, [1.0] * 17, 1)])).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_other_lengths_stay_out_and_large_components_stop(spark):
    rows = [(1, [1.0] * 4, 0), (2, [2.0] * 4, 0), (3, [1.0] * 3, 0), (4, [1.0] * 8, 0)]
    assert {r["vec_id"] for r in dicts(vector_codes.digests(table(spark, rows), parts=4))} == {1, 2}
    with pytest.raises(Exception, match="beyond"):
        vector_codes.digests(table(spark, [(1, [1e9] * 16, 0)])).collect()


@pytest.mark.parametrize("kind", ["normal", "grid", "one", "line"])
def test_trees(kind):
    """Balls hold their points, cache their sums, and every point is in one leaf; a walk finds the nearest entries."""
    rng = np.random.default_rng(2)
    points = {"normal": rng.normal(size=(600, 3)) * 99, "grid": rng.integers(0, 3, size=(600, 3)), "one": np.ones((600, 3)), "line": np.outer(np.arange(600), [1, 0, 0]) ** 2}[kind].astype(np.int64)
    forest = vector_codes.Forest(points, np.repeat([0, 1], 300), 2)
    below = {}
    for ball in range(len(forest.radius)):
        left = forest.left[ball]
        below[ball] = forest.member[forest.start[ball] : forest.end[ball]].tolist() if left < 0 else below[left] + below[forest.right[ball]]
        held = points[below[ball]]
        assert forest.count[ball] == len(held) and (forest.sums[ball] == held.sum(0)).all()
        assert (np.sqrt(((held - forest.centre[ball]) ** 2).sum(1)) <= forest.radius[ball] + 1e-6).all()
    assert [sorted(below[r]) for r in forest.roots] == [list(range(300)), list(range(300, 600))]
    tree = {name: getattr(forest, name) for name in vector_codes._TREE} | {"points": points}
    books = np.stack([points[:20], points[300:320]])
    walk = vector_codes.Walk(tree, books)
    whole = ((points.reshape(2, 300, 1, 3) - books[:, None]) ** 2).sum(3).argmin(2)
    assert (walk.entries().reshape(2, 300) == whole).all()
    number, sums = walk.totals()
    assert (number == np.bincount((whole + np.array([[0], [20]])).ravel(), minlength=40)).all() and sums.sum() == points.sum()
    if kind == "one":
        assert len(walk.single[0]) == 600 and not len(walk.owned[0])


def test_owned_balls_are_not_opened():
    """Two far clusters, one entry in each: no point is compared."""
    points = np.concatenate([np.arange(200)[:, None], np.arange(200)[:, None] + 100_000])
    forest = vector_codes.Forest(points, np.zeros(400, np.int64), 1)
    walk = vector_codes.Walk({name: getattr(forest, name) for name in vector_codes._TREE} | {"points": points}, np.array([[[100], [100_100]]]))
    assert forest.count[walk.owned[0]].sum() + len(walk.single[0]) == 400 and len(walk.single[0]) < 30
