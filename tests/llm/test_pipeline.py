"""The pipeline against a plain rendering of its stages on a small folder of tables."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm.helpers import dicts, documents
from llm.test_decontamination import best, edited
from llm.test_secret_scan import RANDOM
from llm.test_simhash import groups, plain
from llm.test_toxicity import made
from tokenizers import Tokenizer

import corpus_pipeline
from tablemend.llm import decontamination, secret_scan, toxicity


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    rows, labels = made(rng, 400)
    items = [(k, " ".join(rng.choices([f"item{j}" for j in range(40)], k=30))) for k in range(6)]
    for k in range(40):
        text = rows[k][1] + " "
        rows[k] = (k, text + rng.choice([items[k % 6][1], edited(rng, items[k % 6][1], 3), "password=abcdef123456", f"client secret {RANDOM}", "x"]))
    rows += [(1000 + k, rows[k + 100][1]) for k in range(60)] + [(2000 + k, rows[200][1]) for k in range(30)]
    rows += [(3000, None), (3001, ""), (None, "a text without an id"), (5, "twice the same"), (5, "twice the same"), (4000, "long words " * 3000)]
    path = str(tmp_path_factory.mktemp("tables"))
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in dicts(df)), key=repr)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "packing"]

    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = texts(docs)
    want = [(i, t) for i, t in rows if model.score(t) < 0.5]
    clean = stages["toxicity"](spark, docs, folder)
    assert clean.columns == columns and texts(clean) == want and 0 < len(want) < len(rows)
    clean.write.parquet(f"{folder}/1")

    rows, docs = want, spark.read.parquet(f"{folder}/1")
    of = groups({plain(t) for _, t in rows}, lambda x, y: (x ^ y).bit_count() <= 4)
    first = {}
    for i, t in rows:
        here = (i is None, i or 0)
        if of[plain(t)] not in first or here < first[of[plain(t)]][0]:
            first[of[plain(t)]] = (here, i, t)
    single = stages["near_dedup"](spark, docs, folder)
    assert single.columns == columns and sorted((i for i, _ in texts(single)), key=repr) == sorted((i for _, i, _ in first.values()), key=repr)
    assert set(texts(single)) <= set(rows) and len(texts(single)) < len(rows) - 80
    single.write.parquet(f"{folder}/2")

    rows, docs = texts(single), spark.read.parquet(f"{folder}/2")
    items = [decontamination.normal(r["text"]) for r in dicts(spark.read.parquet(f"{folder}/benchmark.parquet"))]
    want = [(i, t) for i, t in rows if not any(best(x, decontamination.normal(t or ""))[0] <= decontamination.budget(len(x)) for x in items)] if len(rows) < 500 else None
    free = stages["decontamination"](spark, docs, folder)
    assert free.columns == columns and texts(free) == want and len(want) < len(rows)
    free.write.parquet(f"{folder}/3")

    rows, docs = want, spark.read.parquet(f"{folder}/3")
    novelty = secret_scan.Novelty()
    want = [(i, t and secret_scan.redacted(t, secret_scan.spans_of(t, novelty), "<secret>")) for i, t in rows]
    masked = stages["secrets"](spark, docs, folder)
    assert masked.columns == columns and texts(masked) == sorted(want, key=repr) and want != rows
    masked.write.parquet(f"{folder}/4")

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = []
    for i, t in want:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        rest = len(ids) % 1024
        cuts = ([0] if rest else []) + list(range(rest, len(ids), 1024))
        pieces += [(i, k, a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(ids)], strict=True))]
    packed = stages["packing"](spark, spark.read.parquet(f"{folder}/4"), folder)
    out = [(r["doc_id"], r["piece"], r["start"], r["ids_crc32"]) for r in dicts(packed)]
    assert sorted(out, key=repr) == sorted(pieces, key=repr)


def test_run(spark, folder):
    out = dicts(corpus_pipeline.run(spark, folder))
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in out)
    for k, (s, offset, _) in enumerate(places):
        assert offset == (places[k - 1][1] + places[k - 1][2] if k and places[k - 1][0] == s else 0)
