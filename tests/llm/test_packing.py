from __future__ import annotations

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import dicts, documents
from tokenizers import Tokenizer

from tablemend.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a  b", "a   b", "\n x", "a\n\n b c\n", " \t lead", "it's we'll  ", "<|endoftext|> x", "a\x1c b", "日本 語 é", "end ", "a \n b", "x  y  z", "1 22 +-+ a.b"]


def ids_of(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


def plain_best_fit(sizes, length):
    """Sequences used by best fit, one piece at a time, the longest first."""
    rooms = []
    for size in sorted(sizes, reverse=True):
        fit = min((r for r in rooms if r >= size), default=None)
        if fit is None:
            rooms.append(length - size)
        else:
            rooms[rooms.index(fit)] = fit - size
    return len(rooms)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab1'st .\n\t\x1c  é<|"), max_size=25), max_size=6))
def test_encoder(texts):
    tokenizer = Tokenizer.from_file(PATH)
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.encoder(PATH)(texts + ODD)]
    assert got == [ids_of(tokenizer, t) for t in texts + ODD]


def test_cache_overflow(monkeypatch):
    monkeypatch.setattr(packing, "CACHED", 5)
    tokenizer, encode = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    for k in range(10):
        text = " ".join(f"w{k * 3 + j}" for j in range(8))
        assert np.frombuffer(next(encode([text])), "<u4").tolist() == ids_of(tokenizer, text)


def test_new_chunks_joined(monkeypatch):
    tokenizer, encode, given_texts = Tokenizer.from_file(PATH), packing.Encoder(PATH), []
    plain = encode.encode
    monkeypatch.setattr(encode, "encode", lambda texts, *more: given_texts.extend(texts) or plain(texts, *more))
    words = [f"w{k}é{k % 7}" for k in range(3000)] + [a + b + c for a in "abcXYZ" for b in ["tion", "QZ", "e"] for c in ["", "st", "Oo"]]
    texts = [" ".join([*words, "w1é1,", "w2é2$$$", "w3é3.%%%", "it's'", "a.\nB", "x\n\ny***", "$$$", "'s", "_", "日本!?", "½##", "a  b", "c \n d", "end\n"])]
    assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == [ids_of(tokenizer, t) for t in texts]
    assert len(given_texts) < 50


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab1½é日'st_.,$%\n\t\x85\u00a0\u3000\u200b   "), max_size=40), max_size=6))
def test_marks_and_white_space(texts):
    encode = packing.encoder(PATH)
    encode.known.clear()
    assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == [ids_of(encode.tokenizer, t) for t in texts]


def test_pieces_encoded_once(monkeypatch):
    tokenizer, encode, pieces = Tokenizer.from_file(PATH), packing.Encoder(PATH), []
    plain = encode.encode_pieces
    monkeypatch.setattr(encode, "encode_pieces", lambda some: pieces.extend(some) or plain(some))
    words = ["qou" + a + b for a in "abcdeé" for b in ["tion", "zß", "ñe", "x", "Ÿ"]]
    texts = [" ".join(f"{a}{mark}{b.capitalize()}" for b in words) for a in words for mark in [".\n", ",", "“", "'s"]]
    assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == [ids_of(tokenizer, t) for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts[::-1])] == [ids_of(tokenizer, t) for t in texts[::-1]]
    # 3,600 chunks are made of each word with and without a space, what follows it, and the marks.
    assert len(pieces) == len(set(pieces)) < 6 * len(words)


def test_pattern_classes():
    tokenizer, encode = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    texts = [f"a{c}b {c} 1{c}2 .{c}- {c}{c}\n{c}'s x{c}'ll  {c}\n\n {c}" for c in map(chr, [*range(1, 0x260), *range(0x2000, 0x2030)])]
    assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == [ids_of(tokenizer, t) for t in texts]


def test_special_with_space(tmp_path):
    file = json.loads(open(PATH, encoding="utf-8").read())
    file["added_tokens"].append(file["added_tokens"][0] | {"id": 50257, "content": "<|a b|>"})
    path = str(tmp_path / "tokenizer.json")
    with open(path, "w", encoding="utf-8") as out:
        json.dump(file, out)
    tokenizer, texts = Tokenizer.from_file(path), ["x <|a", "x b|>", "x <|a b|> y"] + [f"x <|a b{k}|> b|>" for k in range(20)]
    assert [np.frombuffer(b, "<u4").tolist() for b in packing.Encoder(path)(texts)] == [ids_of(tokenizer, t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_best_fit(counts):
    fill, ranks, places = defaultdict(int), defaultdict(list), defaultdict(list)
    for size, rank, n, first, offset in packing.best_fit(counts, 64):
        ranks[size] += range(rank, rank + n)
        for s in range(first, first + n):
            fill[s] += size
            places[s].append((offset, offset + size))
    assert all(sorted(ranks[s]) == list(range(n)) for s, n in counts.items())
    for s, spans in places.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 64 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert len(fill) == plain_best_fit([s for s, n in counts.items() for _ in range(n)], 64)


def test_packed(spark):
    rng = random.Random(0)
    rows = [(i, " ".join(rng.choices(["tion", "the", "erth", "a,", "Blehe"], k=rng.choice([0, 3, 50, 400, 2000])))) for i in range(120)]
    rows += [(None, None), (700, "twice"), (700, "twice"), (900, "x " * 20_000)] + list(enumerate(ODD, 1000))
    out = dicts(packing.packed(documents(spark, rows, extra=True), PATH, with_ids=True))
    tokenizer = Tokenizer.from_file(PATH)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"] <= 1024
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in rows:
        if i != 700:
            ids = ids_of(tokenizer, t or "") + [2]
            mine = sorted(pieces[i], key=lambda r: r["piece"])
            assert sum((r["ids"] for r in mine), []) == ids and [r["piece"] for r in mine] == list(range(len(mine)))
            assert all(r["length"] == 1024 for r in mine[1:]) and mine[0]["start"] == 0
    assert len(pieces[700]) == 2
    for spans in sequences.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))] and sum(n for _, n in spans) <= 1024
    assert len(sequences) == plain_best_fit([r["length"] for r in out], 1024)


def test_lanes(spark):
    rows = [(i, "the " * (i % 3)) for i in range(300)]
    pieces = packing.stored(packing.token_pieces(documents(spark, rows), PATH, 8), "test")
    out = dicts(packing.placed(pieces, 8, lane_rows=7))
    assert len({(r["sequence_id"], r["offset"]) for r in out}) == len(out) == pieces.count()
    spans = sorted((r["sequence_id"], r["offset"], r["length"]) for r in out)
    assert all(o == 0 if k == 0 or spans[k - 1][0] != s else o == spans[k - 1][1] + spans[k - 1][2] for k, (s, o, _) in enumerate(spans))


def test_empty(spark):
    assert packing.packed(documents(spark, []), PATH).count() == 0
