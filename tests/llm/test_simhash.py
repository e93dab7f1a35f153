from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import dicts, documents

from tablemend.llm import simhash as s
from tablemend.llm.common import components


def plain(text, n=4):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, near):
    """node -> smallest node reachable."""
    found = {}
    for start in sorted(nodes):
        stack = [start]
        while stack:
            x = stack.pop()
            if x not in found:
                found[x] = start
                stack += [y for y in nodes if y not in found and near(x, y)]
    return found


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("aB cÉ\n\tx "), max_size=60))
def test_fingerprint(text):
    assert s.fingerprint(text) == plain(text)


def test_long_fingerprint(monkeypatch):
    monkeypatch.setattr(s, "AT_ONCE", 7)
    text = " ".join(random.Random(1).choices(["the", "of", "Tion", "ed"], k=500))
    assert s.fingerprint(text) == plain(text)


def test_keys_find_all_pairs():
    rng, errors = np.random.default_rng(0), s.golay_errors()
    a = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in rng.integers(0, 5, len(a))], np.uint64)
    pairs = []
    for bits in (a, a ^ flips):
        keys, owners = s.fuzzy_keys(bits.view(np.int64), errors)
        pairs.append(set(zip(owners.tolist(), keys.tolist(), strict=True)))
        assert len(pairs[-1]) == len(keys) <= 108 * len(a)
    assert {o for o, _ in pairs[0] & pairs[1]} == set(range(len(a)))


def test_linked_in_any_batches():
    rng = random.Random(2)
    rows = sorted((rng.choice([1, 2, 3, 4, 5]) if k % 3 else k + 10, rng.getrandbits(6) << 3) for k in range(400))
    for size, bucket in ((1, 1000), (7, 1000), (400, 1000), (7, 20)):
        batches = [pa.RecordBatch.from_pydict({"key": [k for k, _ in rows[i : i + size]], "bits": [b for _, b in rows[i : i + size]]}) for i in range(0, 400, size)]
        out = [r for b in s.linked(iter(batches), 1, bucket) for r in b.to_pylist()]
        large = [(r["key"], r["a"]) for r in out if r["key"] is not None]
        for key in {k for k, _ in rows}:
            mine = {b for k, b in rows if k == key}
            if any(k == key for k, _ in large):
                assert bucket == 20 and sorted(b for k, b in large if k == key) == sorted(b for k, b in rows if k == key)
        if bucket == 1000:
            assert not large
            edges = {(r["a"], r["b"]) for r in out}
            nodes = {b for _, b in rows}
            same_key = {(x, y) for k, x in rows for k2, y in rows if k == k2 and (x ^ y).bit_count() <= 1}
            assert groups(nodes, lambda x, y: (x, y) in edges or (y, x) in edges) == groups(nodes, lambda x, y: (x, y) in same_key)


def near_copies(rng):
    base = [" ".join(rng.choices([f"w{k}" for k in range(50)], k=300)) for _ in range(5)]
    rows = []
    for i in range(60):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = "changed"
        rows.append((i * 3, " ".join(words)))
    return rows + [(1, None), (2, ""), (4, " \n"), (5, "One"), (7, "one"), (None, "one"), (None, "alone"), (0, rows[0][1])]


def test_against_brute_force(spark):
    rows = near_copies(random.Random(4))
    prints = {plain(t) for _, t in rows}
    of = groups(prints, lambda x, y: (x ^ y).bit_count() <= 4)
    least = {}
    for i, t in rows:
        if i is not None:
            least[of[plain(t)]] = min(i, least.get(of[plain(t)], i))
    want = sorted(((i, f"{plain(t):016x}", least.get(of[plain(t)])) for i, t in rows), key=repr)
    out = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in dicts(s.near_duplicates(documents(spark, rows, extra=True)))), key=repr)
    assert out == want


def test_large_keys(spark):
    rng = random.Random(6)
    bits = {0}
    while len(bits) < 120:
        bits.add(rng.choice(sorted(bits)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    bits |= {rng.getrandbits(63) for _ in range(30)}
    signed = [b - (1 << 64) if b >> 63 else b for b in bits]
    df = spark.createDataFrame([(b,) for b in signed], "bits long")
    found = {r["node"]: r["component"] for r in dicts(components(s.links(df, bucket=5)))}
    want = groups(set(signed), lambda x, y: ((x ^ y) & (2**64 - 1)).bit_count() <= 4)
    assert {b: found.get(b, b) for b in signed} == want


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (200, 200), (95, 100)] + [(300, k) for k in range(301, 340)]
    out = {r["node"]: r["component"] for r in dicts(components(spark.createDataFrame(edges, "a long, b long")))}
    nodes = {x for e in edges for x in e}
    both = set(edges) | {(b, a) for a, b in edges}
    assert out == groups(nodes, lambda x, y: (x, y) in both)


def test_empty(spark):
    assert s.near_duplicates(documents(spark, [])).count() == 0


def test_one_document_of_each_component_stays(spark):
    rows = [(i, t) for i, t in near_copies(random.Random(4))] + [(None, "no id"), (90001, "no id"), (90002, "twice"), (90002, "twice"), (90003, None)]
    df = documents(spark, rows, extra=True).selectExpr("*", "7 AS mark", "8 AS _mark", "9 AS chosen_id", "'z' AS `__mark`")
    out = dicts(s.without_copies(df))
    assert s.without_copies(df).columns == df.columns
    of = groups({plain(t) for _, t in rows}, lambda x, y: (x ^ y).bit_count() <= 4)
    first = {}
    for i, t in rows:
        first[of[plain(t)]] = min(first.get(of[plain(t)], (True, 0)), (i is None, i or 0))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out) == sorted(first.values())
    assert all((r["mark"], r["_mark"], r["chosen_id"], r["__mark"]) == (7, 8, 9, "z") for r in out)
