from __future__ import annotations

import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import dicts, documents

from tablemend.llm import sharding


def test_shards(spark):
    rows = [(i, "x" * (i * 37 % 400)) for i in range(3000)] + [(None, None), (None, ""), (5, "é" * 10), (5, "é" * 10)]
    out = dicts(sharding.shard_documents(documents(spark, rows, extra=True)))
    assert sorted((r["size"], r["text_crc32"]) for r in out) == sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in rows)
    places, size, later = defaultdict(list), defaultdict(int), defaultdict(int)
    for r in out:
        places[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
        later[r["next_shard"]] += r["size"]
        assert r["law"] == "bytes" and r["grown_shard"] is None
        assert r["next_shard"] in (r["shard"], 24)
    assert sorted(size) == list(range(24)) and all(sorted(v) == list(range(len(v))) for v in places.values())
    assert max(size.values()) - min(size.values()) <= 0.01 * sum(size.values()) / 24 + 400
    assert max(later.values()) <= 1.1 * sum(later.values()) / 25 and later[24] >= 0.9 * sum(later.values()) / 25


def test_a_record_that_is_a_third_of_all_rows(spark, monkeypatch):
    """Copies of one record spread over the shards like other rows, and none is lost."""
    monkeypatch.setattr(sharding, "RUN", 7)
    rows = [(i, "y" * (i % 90)) for i in range(2000)] + [(-1, "z" * 300)] * 1000
    out = dicts(sharding.shard_documents(documents(spark, rows)))
    assert sorted((r["doc_id"], r["size"]) for r in out) == sorted((i, len(t) + 8) for i, t in rows)
    size, places = defaultdict(int), defaultdict(list)
    for r in out:
        size[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    mean = sum(size.values()) / 24
    assert max(size.values()) <= 1.01 * mean + 308 and min(size.values()) >= 0.99 * mean - 308
    assert all(sorted(v) == list(range(len(v))) for v in places.values())


def test_empty(spark):
    assert sharding.shard_documents(documents(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(8, 10_000), min_size=1, max_size=300), st.integers(1, 12))
def test_maps(sizes, shards):
    totals = [(k, s, 1) for k, s in enumerate(sizes)]
    first = sharding.first_map(totals, shards)
    load = [0] * shards
    for k, s, _ in totals:
        load[first.slots[k][0]] += s
    assert max(load) <= sum(load) / shards + max(sizes)
    second = sharding.rebalanced(first, totals, shards + 1)
    assert second.version == 2
    assert all(second.slots[k][0] in (first.slots[k][0], *range(shards + 1)) for k in first.slots)


def test_map_versions(spark):
    totals = [(k, 100 + k, 2) for k in range(50)]
    first = sharding.first_map(totals, 4)
    table = sharding.map_table(spark, first, sharding.rebalanced(first, totals, 5))
    assert table.groupBy("version").count().orderBy("version").collect() == [(1, 50), (2, 50)]
    moved = table.where("version = 1").alias("o").join(table.where("version = 2").alias("n"), "virtual_slot").where("o.shard != n.shard")
    assert 0 < moved.count() <= 15 and moved.where("n.shard != 4").count() == 0
