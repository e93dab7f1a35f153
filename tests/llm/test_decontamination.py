from __future__ import annotations

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import dicts, documents

from tablemend.llm import decontamination as d


def best(item, text):
    """(distance, end) of the closest stretch, by the whole table."""
    row = np.arange(len(item) + 1)
    least, end = len(item), 0
    for j, c in enumerate(text, 1):
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (x != c)))
        row = new
        if row[-1] < least:
            least, end = row[-1], j
    return least, end


def distance(a, b):
    row = list(range(len(a) + 1))
    for j, c in enumerate(b, 1):
        new = [j]
        for i, x in enumerate(a, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (x != c)))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abé"), min_size=1, max_size=20), st.text(st.sampled_from("abé"), max_size=60))
def test_myers(item, text):
    least, end = best(item, text)
    found = d.Pattern(item).best(text, len(item) - 1)
    if least >= len(item):
        assert found is None
    else:
        assert found[0] == least == distance(item, text[found[1] : found[2]])
        assert least == 0 or found[2] == end


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        at = rng.randrange(len(text))
        rng.choice([lambda: text.pop(at), lambda: text.insert(at, "#"), lambda: text.__setitem__(at, "ß")])()
    return "".join(text)


def corpus(rng):
    syllables = ["tion", "the", "er", "é", "an ", "of ", "Re", ". ", "\n", "st", "日本"]
    words = lambda n: "".join(rng.choices(syllables, k=n))
    items = [(k, words(rng.randrange(20, 110))) for k in range(25)] + [(100, "yes"), (101, ""), (102, None), (103, "Short item"), (None, words(60))]
    rows = []
    for i in range(120):
        parts = [words(rng.randrange(30))]
        if i % 2:
            k, text = rng.choice([x for x in items if x[1] and len(x[1]) > 20])
            n = d.budget(len(d.normal(text)))
            parts += [edited(rng, text, rng.choice([0, 1, n, n, n + 1, 2 * n + 2])), words(rng.randrange(30))]
        rows.append((i, "".join(parts)))
    return rows + [(None, items[0][1]), (200, None), (201, ""), (202, "well yes, a short\nITEM"), (203, "yesterday"), (5, items[1][1]), (5, items[1][1])], items


def brute(rows, items):
    out = []
    for i, t in rows:
        text = d.normal(t or "")
        for k, item in items:
            item = d.normal(item or "")
            if len(item) >= d.PIECE:
                least, _ = best(item, text)
                if least <= d.budget(len(item)):
                    out.append((i, k, least))
            elif item and any(c for c in [d.re.search(rf"(?<!\w){d.re.escape(item)}(?!\w)", text)]):
                out.append((i, k, 0))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    rows, items = corpus(random.Random(7))
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    want = brute(rows, items)
    assert len({i for i, _, x in want if x}) > 10
    texts = {}
    for i, t in rows:
        texts.setdefault(i, d.normal(t or ""))
    for block_chars in (4 << 20, 500):
        out = dicts(d.matched(documents(spark, rows, extra=True), benchmark, block_chars=block_chars))
        assert sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in out), key=repr) == want
        names = dict(items)
        for r in out:
            if r["doc_id"] != 5:
                assert distance(d.normal(names[r["item_id"]]), texts[r["doc_id"]][r["start"] : r["end"]]) == r["distance"]
        kept = d.without_leaks(documents(spark, rows, extra=True), benchmark, block_chars=block_chars)
        assert kept.columns == documents(spark, rows, extra=True).columns
        assert sorted((r["doc_id"] for r in dicts(kept)), key=repr) == sorted((i for i, t in rows if not brute([(i, t)], items)), key=repr)


def test_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a passage that is long enough")], "item_id long, text string")
    some = documents(spark, [(1, "a passage that is long enough")])
    assert d.matched(some, none).count() == 0 and d.without_leaks(some, none).count() == 1
    assert d.matched(documents(spark, []), one).count() == 0 and d.matched(some, one).count() == 1


def test_blocks_leave_the_plan(spark, monkeypatch):
    """Results of all item blocks but the last are stored before the plan goes on, and the whole result is unchanged."""
    names = []
    monkeypatch.setattr(d, "stored", lambda df, name, keep=d.stored: names.append(name) or keep(df, name))
    rows = [(1, "so says the first hidden item here"), (1, "so says the first hidden item here"), (2, "and the second hidden item there"), (3, "nothing of them"), (None, None), (4, "third hidden item")]
    docs = documents(spark, rows)
    items = spark.createDataFrame([(1, "the first hidden item"), (2, "the second hidden item"), (3, "third hidden item")], "item_id long, text string")
    found = sorted((r["doc_id"], r["item_id"]) for r in dicts(d.matched(docs, items, block_chars=1)) if not r["distance"])
    assert found == [(1, 1), (1, 1), (2, 2), (4, 3)] and names == ["matches"] * 2
    assert sorted((r["doc_id"] or 0) for r in dicts(d.without_leaks(docs, items, block_chars=1))) == [0, 3]
    assert names == ["matches"] * 2 + ["leaks"] * 2
