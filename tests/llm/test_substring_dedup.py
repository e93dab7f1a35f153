from __future__ import annotations

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import dicts, documents

from tablemend.llm import substring_dedup as s


def brute(rows, window):
    """Sorted (doc_id, kept words, number removed)."""
    key = lambda i: -(2**62) if i is None else i
    words = [(i, re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            seq = tuple(w[k : k + window])
            first[seq] = min(first.get(seq, (2**62, 0)), (key(i), k))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (key(i), k):
                gone.update(range(k, k + window))
        out.append((i, " ".join(x for k, x in enumerate(w) if k not in gone), len(w), len(gone)))
    return sorted(out, key=repr)


def result(df):
    out = dicts(df)
    for r in out:
        assert sum(x["end"] - x["start"] for x in r["removed"]) == r["n_removed"]
    return sorted(((r["doc_id"], r["text"], r["n_words"], r["n_removed"]) for r in out), key=repr)


def corpus(rng, n):
    vocabulary = [f"w{k}" for k in range(400)] + ["é", " x", "日本"]
    passages = [rng.choices(vocabulary, k=rng.choice([19, 20, 21, 33, 60])) for _ in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.choice([0, 1, 2, 4])):
            words += rng.choice([rng.choices(vocabulary, k=rng.randrange(40)), rng.choice(passages), ["a"] * rng.randrange(60)])
        rows.append((i, rng.choice([" ", "\n", "  ", "\t"]).join(words)))
    rows += [(n + k, rows[k][1]) for k in range(0, n, 5)]
    rows += [(None, " ".join(passages[0])), (None, None), (n + 500, ""), (3, " ".join(passages[1] + passages[0])), (n + 501, "x " * 20), (n + 501, "x " * 20), (n + 502, " lead x" * 5000)]
    rng.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = corpus(random.Random(3), 60)
    df = documents(spark, rows, extra=True).withColumnRenamed("a", "block")
    for block_bytes in (2 << 20, 3000):
        assert result(s.deduplicated(df, block_bytes=block_bytes)) == brute(rows, 20)


def test_small_windows(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("abcd", k=rng.randrange(30)))) for i in range(40)]
    for window in (1, 3, 5):
        assert result(s.deduplicated(documents(spark, rows), window, 100)) == brute(rows, window)


def test_empty(spark):
    assert s.deduplicated(documents(spark, [])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60), st.integers(0, 200), st.integers(0, 200))
def test_cover(window, i, j):
    period, held = s.cover(window)
    size = window - period + 1
    assert size >= 1
    assert any((i + d) % period in held and (j + d) % period in held and d + size <= window for d in range(period))
