"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only that reply is trainable.
Turns that follow the last reply form one more example without a trainable part, so nothing is lost. DataFrame
functions only.

A turn is written `<|im_start|>role\\ntext<|im_end|>\\n`. In roles and texts `&` is written `&amp;` and `<|` is written
`&lt;|`, in roles a line break `&#10;`, so a control string in the output always is one of the template's, and
`unescaped` gives the text back.

Defined cases: a NULL text or role is empty; turns go by (turn, role, text) with NULL first, repeated rows stay; a
NULL conversation id is a conversation; a conversation without replies gives only its context example; an empty table
gives no example; other columns are not read. A conversation is one row: its digest is over the whole of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescaped(text: Column) -> Column:
    for code, plain in (("&#10;", "\n"), ("&lt;|", "<|"), ("&amp;", "&")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def examples(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, example (from 1), target_turn, trainable, last, text, loss_start, loss_end.

    The loss mask is the span [loss_start, loss_end) of text, in code points; it is empty where trainable is false.
    `last` marks the conversation's longest example, which holds all of its turns.
    """
    said = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    head = F.concat(F.lit(START), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("&#10;")), F.lit("\n"))
    turns = said.select("conv_id", "turn", "role", "text", head.alias("head"), escaped(F.col("text")).alias("body"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    written = F.concat("head", "body", F.lit(END + "\n"))
    placed = turns.select(
        "conv_id",
        F.struct(
            F.row_number().over(order).alias("at"),
            "turn",
            (F.col("role") == "assistant").alias("reply"),
            written.alias("written"),
            F.sum(F.length(written)).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int").alias("end"),
            (F.length("body")).alias("chars"),
        ).alias("t"),
    )
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts")).select(
        "conv_id",
        F.array_join(F.transform("ts", lambda t: t["written"]), "").alias("whole"),
        F.size("ts").alias("n"),
        F.transform("ts", lambda t: t.dropFields("written")).alias("ts"),
    )
    kept = F.filter("ts", lambda t: t["reply"] | (t["at"] == F.col("n")))
    close = len(END) + 1
    return whole.select("conv_id", "whole", "n", F.posexplode(kept).alias("k", "t")).select(
        "conv_id",
        (F.col("k") + 1).alias("example"),
        F.when(F.col("t.reply"), F.col("t.turn")).alias("target_turn"),
        F.col("t.reply").alias("trainable"),
        (F.col("t.at") == F.col("n")).alias("last"),
        F.substring(F.col("whole"), F.lit(1), F.col("t.end")).alias("text"),
        F.when(F.col("t.reply"), F.col("t.end") - close - F.col("t.chars")).otherwise(F.col("t.end")).alias("loss_start"),
        F.when(F.col("t.reply"), F.col("t.end") - close).otherwise(F.col("t.end")).alias("loss_end"),
    )


def turns_of(text: Column) -> Column:
    """Read an example's text back: an array of (role, text), unescaped."""
    parts = F.split(text, "\\Q" + END + "\\E\n")
    bodies = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p)))
    cut = F.transform(bodies, lambda b: F.struct(F.substring_index(b, "\n", 1).alias("role"), b.alias("b")))
    return F.transform(
        cut, lambda c: F.struct(unescaped(c["role"]).alias("role"), unescaped(F.substring(c["b"], F.length(c["role"]) + 2, F.length(c["b"]))).alias("text"))
    )


def loss_text(text: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescaped(F.substring(text, start + 1, end - start))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the examples: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    read = formatted.select(
        "conv_id",
        F.struct("example", loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("loss")).alias("l"),
        F.length("text").alias("chars"),
        F.when(F.col("last"), turns_of(F.col("text"))).alias("turns"),
    ).select(
        "conv_id", "l", "chars", F.size("turns").alias("n"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("sha"),
    )
    merged = read.groupBy("conv_id").agg(
        F.max(F.col("n")).cast("long").alias("n_turns"),
        F.max("sha").alias("turns_sha256"),
        F.array_join(F.transform(F.sort_array(F.collect_list("l")), lambda l: l["loss"]), "").alias("loss"),
        F.sum("chars").cast("long").alias("formatted_chars"),
        F.count("*").alias("n_examples"),
    )
    return merged.select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "n_examples"
    )
