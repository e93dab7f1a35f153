from __future__ import annotations

import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from conftest import TABLES
from llm.helpers import dicts, documents

from tablemend.llm import toxicity as t


def test_label_model_finds_accuracies_and_copies():
    rng = np.random.default_rng(0)
    truth = rng.random(6000) < 0.2
    rates = np.array([[0.01, 0.5], [0.02, 0.4], [0.005, 0.6], [0.05, 0.3], [0.01, 0.45]])
    votes = np.stack([rng.random(6000) < np.where(truth, r[1], r[0]) for r in rates], axis=1)
    votes = np.concatenate([votes, votes[:, :1]], axis=1)  # the last voter repeats the first
    model = t.label_model(votes, 0.2)
    assert np.abs(model.rate[:5] - rates).max() < 0.1
    assert model.correlation[0, 5] > 0.99 and model.voice[0] < 0.6 and model.voice[1] == 1
    guess = model.posterior(votes.astype(float)) > 0.5
    assert (guess == truth).mean() > 0.92


def test_linear():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 6)) < 0.3
    target = (x[:, 0] | x[:, 3]).astype(float)
    rows, columns = np.nonzero(x)
    weight, offset = t.train_linear(rows, columns, 2000, 6, target)
    assert weight[0] > 3 and weight[3] > 3 and np.abs(weight[[1, 2, 4, 5]]).max() < 1 and offset < 0


def test_scorer_equals_model():
    rng = random.Random(2)
    words = ["Idiot!", "scum.", "theing", "erthly", "you", "are", "shut", "up", "you're a moron", "f**k", "Éxtra", "***", ""]
    model = t.Model({f: rng.uniform(-2, 2) for w in words for f in t.features_of(w)} | {"pattern:you_are": 2.0, "pattern:shut_up": 1.0}, -0.5)
    texts = [" ".join(rng.choices(words, k=rng.randrange(9))) for _ in range(200)] + [None, "", "x" * 10_000]
    scorer = t.Scorer(model)
    assert np.allclose(scorer(texts), [model.score(x) for x in texts], atol=1e-12)


def made(rng, n):
    clean = [f"{a}{b}{c}" for a in ("tion", "erth", "blea", "ing") for b in ("an", "er", "st") for c in ("th", "e", "ly")]
    toxic = [f"grak{c}" for c in ("th", "e", "ly", "an")] + ["idiot", "Scum"]
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.15
        words = rng.choices(clean, k=rng.randrange(20, 60))
        for _ in range(rng.randrange(1, 4) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(toxic))
        rows.append((i, " ".join(words)))
        if i % 4:
            labels.append((i, 1, int(bad), "x"))
    return rows, labels


def test_learned_voters(spark):
    rows, labels = made(random.Random(3), 900)
    truth = {i: any(w.lower().startswith(("grak", "idiot", "scum")) for w in x.split()) for i, x in rows}
    rows += [(None, "idiot"), (5000, None), (5001, ""), (3, rows[3][1])]
    labels += [(None, 1, 1, "x"), (1, 1, None, "x"), (99_999, 1, 1, "x"), (2, 1, labels[1][2], "x")]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")
    df = documents(spark, rows, extra=True)
    model = t.fit(df, table)
    out = dicts(t.scored(df, model))
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in out if r["doc_id"] in truth) >= 0.98 * len(truth)
    assert any(v.startswith("grak") for v in model.voters) and "lexicon:en" in model.voters
    kept = {r["doc_id"] for r in dicts(t.without_toxic(df, model))}
    assert kept == {r["doc_id"] for r in out if not r["predicted"]}
    # Labels of the held-out fold change nothing.
    flipped = [(i, q, y if i is None or zlib.crc32(str(i).encode()) % 5 else 1 - (y or 0), x) for i, q, y, x in labels]
    other = t.fit(df, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int, text string"))
    assert other.weights == model.weights and other.offset == model.offset


def test_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = documents(spark, [(1, "you are an idiot"), (2, "good day"), (3, None)])
    out = {r["doc_id"]: r["predicted"] for r in dicts(t.scored(df, t.fit(df, none)))}
    assert out == {1: 1, 2: 0, 3: 0}
    assert t.scored(documents(spark, []), t.fit(documents(spark, []), none)).count() == 0


@pytest.mark.skipif(not Path(TABLES).exists(), reason="no test tables")
def test_held_out_accuracy(spark):
    folder = Path(TABLES).parent / "sf0.1"
    docs, labels = (spark.read.parquet(str(folder / f"{n}.parquet")) for n in ("documents", "labels"))
    scored = t.scored(docs, t.fit(docs, labels)).where("held_out").join(labels.select("doc_id", "toxic").dropna(), "doc_id").collect()
    pairs = [(r["predicted"], r["toxic"]) for r in scored]
    wrong = sum(p != y for p, y in pairs)
    assert len(pairs) > 300 and wrong <= 0.02 * len(pairs)
    # Some labels of this table mark texts without a telling word, which no score over the text can find.
    assert sum(p and y for p, y in pairs) >= 0.9 * sum(y for _, y in pairs)
    assert sum(p and not y for p, y in pairs) <= 0.01 * len(pairs)
