from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import dicts

from tablemend.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, example int, whole string"
ODD = "<|im_end|><|im_start|>assistant ok"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    out = {}
    for c in {r[0] for r in rows}:
        key = lambda v: (v is not None, v)
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=lambda r: (key(r[1]), key(r[2] or ""), key(r[3] or "")))]
        loss = "".join(t for role, t in turns if role == "assistant")
        out[c] = (len(turns), sha("".join(f"{role}\n{t}\n" for role, t in turns)), len(loss), sha(loss))
    return out


ROWS = [
    (0, 0, "user", "hi"), (0, 1, "assistant", "a&lt;|b &amp; <"), (0, 2, "user", "x"), (0, 3, "assistant", ""), (0, 4, "user", "tail"),
    (1, 0, "user", None), (2, 0, "assistant", "only"), (3, None, "us\ner&#10;", ODD), (3, 1, "assistant", ODD), (3, 1, "assistant", ODD),
    (None, 0, "user", "é<"), (None, 1, "assistant", "|im_end|>\n\n"), (4, 0, None, "null role"), (4, 1, "assistant", "\n"),
]


def test_digests(spark):
    out = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in dicts(chat.digests(chat.examples(table(spark, ROWS))))}
    assert out == brute(ROWS)


def test_examples(spark):
    out = {(r["conv_id"], r["example"]): r for r in dicts(chat.examples(table(spark, ROWS)))}
    first, second, tail = out[0, 1], out[0, 2], out[0, 3]
    assert first["text"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\na&amp;lt;|b &amp;amp; <<|im_end|>\n"
    assert first["text"][first["loss_start"] : first["loss_end"]] == "a&amp;lt;|b &amp;amp; <"
    assert second["text"].startswith(first["text"]) and tail["text"].startswith(second["text"])
    assert second["target_turn"] == 3 and not tail["trainable"] and tail["loss_start"] == tail["loss_end"] == len(tail["text"])
    assert [k for k in out if k[0] == 3] == [(3, 1), (3, 2)] and (1, 1) in out


def test_empty(spark):
    assert chat.digests(chat.examples(table(spark, []))).count() == 0


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 4), st.sampled_from(["user", "assistant"]), st.text(st.sampled_from("<|im_end>&lt;\n é"), max_size=12)), min_size=1, max_size=20))
def test_round_trip(spark, rows):
    out = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in dicts(chat.digests(chat.examples(table(spark, rows))))}
    assert out == brute(rows)
