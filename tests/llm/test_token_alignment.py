from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from llm.helpers import dicts, documents

from tablemend.llm import token_alignment
from tablemend.llm.queries import tokenizer_path

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def tokens(text):
    """(ids, byte ends) of both sides, by the libraries over the whole text; None if the bytes differ."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = token_alignment.byte_letters()
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
        return None
    return a_ids, np.cumsum([len(x) for x in a_bytes]).tolist(), b_ids, np.cumsum([len(x) for x in b_bytes]).tolist()


def brute(rows):
    told, counts = [], Counter()
    for doc_id, text in rows:
        groups, links, n = [], [], (0, 0)
        if text and (found := tokens(text)):
            a, a_end, b, b_end = found
            n = (len(a), len(b))
            for low, high in zip([0, *sorted(set(a_end) & set(b_end))][:-1], sorted(set(a_end) & set(b_end)), strict=True):
                groups.append("|".join(",".join(str(i) for i, e in zip(ids, ends, strict=True) if low < e <= high) for ids, ends in ((a, a_end), (b, b_end))))
            for i, (x, xe) in enumerate(zip(a, a_end, strict=True)):
                for j, (y, ye) in enumerate(zip(b, b_end, strict=True)):
                    if max(([0] + a_end)[i], ([0] + b_end)[j]) < min(xe, ye):
                        links.append((x, y))
        counts.update(set(links))
        told.append((doc_id, *n, len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    best = {}
    for (x, _), c in counts.items():
        best[x] = max(best.get(x, 0), c)
    return sorted(((d, a, b, g, len(ln), sum(counts[p] == best[p[0]] for p in ln), sum(counts[p] for p in ln), s) for d, a, b, g, ln, s in told), key=repr)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in dicts(df)), key=repr)


TEXTS = [
    None, "", " ", "  two  spaces and\n a line \n\n\tand tabs ", "The quick brown fox, naïve café 12345!", "<|endoftext|> and <s> or </s><unk> are text",
    "mark ▁ for a space", "a ▁b", "日本語のテキスト と 한국어", "🙂🙃 emoji👨‍👩‍👧", "x" * 300, "antidisestablishmentarianism unbelievably", "\x00nul\x01 bytes no-break　wide", "<0x41> is text",
    "tail ", " head", "a" + " " * 40 + "b", "it's don't we'll 'tis", "1234567890 " * 30, "\r\nwindows\r\n lines",
]


@pytest.mark.parametrize("heavy", [200_000, 3, 0])
def test_against_brute_force(spark, heavy):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "the same words in many rows") for i in range(20)] + [(4, TEXTS[4]), (None, "no id")]
    assert got(token_alignment.alignments(documents(spark, rows, extra=True).repartition(3), A, B, heavy)) == brute(rows)


def test_empty_table(spark):
    assert token_alignment.alignments(documents(spark, []), A, B).columns == list(COLUMNS)
    assert token_alignment.alignments(documents(spark, []), A, B).count() == 0


def test_groups_as_text_and_a_small_memory(spark, monkeypatch):
    rows = [(i, f"word{i} and others {i} times") for i in range(50)] + [(99, "long " * 5000)]
    out = {r["doc_id"]: r for r in dicts(token_alignment.encoded(documents(spark, rows), A, B, with_groups=True))}
    assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in out.values())
    monkeypatch.setattr(token_alignment, "CACHED", 10)
    align = token_alignment.Aligner(A, B)
    for _ in range(2):
        for i, text in rows:
            (groups, links, n_a, n_b, n_groups, _), = align([text])
            assert (groups, n_a, n_b, n_groups, len(links) // 8) == tuple(out[i][c] for c in ("groups", "n_a", "n_b", "n_groups", "n_links"))
    assert len(align.known) <= 20


def test_pointers_reach_the_last_token_of_their_group():
    """A long chain of staggered tokens is one group, found in few doublings."""
    n = 1000
    a_end, b_end = np.append(np.arange(2, 2 * n, 2), 2 * n), np.append(np.arange(1, 2 * n, 2), 2 * n)
    pointer = token_alignment.successors(np.concatenate([[0], a_end[:-1]]), a_end, np.concatenate([[0], b_end[:-1]]), b_end)
    assert set(token_alignment.terminals(pointer).tolist()) == {len(a_end) + len(b_end) - 1}
