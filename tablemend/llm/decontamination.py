"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters may occur in a document with up to k edits. Cut into k+1 pieces, an occurrence with at most
k edits holds one of them unchanged. Piece hits are found over whole texts: the bytes of a batch are read as 64-bit words at
all positions, looked up in a small table of the pieces' first bytes, and compared. Each hit gives the stretch of text
where the item may lie; overlapping stretches are joined and verified with Myers' bit-parallel edit distance.

Text and items are compared in lower case with white space as single spaces. The items are read in blocks of bounded
size, each of which goes to the tasks with the code and is held against all documents. All but the last block are settled,
and their results stored, before a third is read, so a plan holds one block; with one block nothing is shuffled.

Defined cases: a NULL or empty text matches nothing, as does a NULL or empty item; items shorter than a piece are
looked for as they are, without edits, between non-word characters; repeated documents or items give a row each; NULL
ids are kept; an empty table on either side gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.llm.common import regrouped, stored

#: Edits allowed for each character, and the least characters of a piece.
SHARE = 0.08
PIECE = 12
#: Characters of items that one pass holds.
BLOCK_CHARS = 4 << 20
_BITS = 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def budget(n: int, share: float = SHARE) -> int:
    """Edits allowed in an item of n characters: every piece keeps its least length."""
    return max(0, min(int(n * share), n // PIECE - 1))


class Pattern:
    """One item for Myers' algorithm."""

    def __init__(self, text: str):
        self.text, self.size = text, len(text)
        self.masks: dict[str, int] = defaultdict(int)
        self.reverse: dict[str, int] = defaultdict(int)
        for k, c in enumerate(text):
            self.masks[c] |= 1 << k
            self.reverse[c] |= 1 << (self.size - 1 - k)
        self.masks, self.reverse = dict(self.masks), dict(self.reverse)

    def scores(self, text: str, masks: dict[str, int], anchored: int) -> Iterator[int]:
        """Edit distance of the item to the best stretch ending at each character (to the prefix, if anchored is 1)."""
        full, high = (1 << self.size) - 1, 1 << (self.size - 1)
        plus, minus, score = full, 0, self.size
        for c in text:
            equal = masks.get(c, 0)
            vertical = equal | minus
            horizontal = (((equal & plus) + plus) ^ plus) | equal
            up, down = minus | (full & ~(horizontal | plus)), plus & horizontal
            if up & high:
                score += 1
            elif down & high:
                score -= 1
            yield score
            up, down = ((up << 1) | anchored) & full, (down << 1) & full
            plus, minus = down | (full & ~(vertical | up)), up & vertical

    def best(self, text: str, k: int) -> tuple[int, int, int] | None:
        """(distance, start, end) of the closest stretch, the first of equals, if within k."""
        at = text.find(self.text)
        if at >= 0:
            return 0, at, at + self.size
        least, end = k + 1, 0
        for j, score in enumerate(self.scores(text, self.masks, 0), 1):
            if score < least:
                least, end = score, j
        if least > k:
            return None
        back = text[max(0, end - self.size - k) : end][::-1]
        length = next(j for j, score in enumerate(self.scores(back, self.reverse, 1), 1) if score == least)
        return least, end - length, end


@dataclass
class Items:
    """A block of test items: ids, normal texts, and the pieces by their first bytes."""

    ids: list
    texts: list[str]
    share: float = SHARE
    pieces: dict[bytes, list[tuple[int, int, bytes]]] = field(default_factory=lambda: defaultdict(list))
    short: list[tuple[int, re.Pattern]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.patterns: dict[int, Pattern] = {}
        for number, text in enumerate(self.texts):
            if len(text) < PIECE:
                if text:
                    self.short.append((number, re.compile(rf"(?<!\w){re.escape(text)}(?!\w)")))
                continue
            n = budget(len(text), self.share) + 1
            edges = [len(text) * j // n for j in range(n + 1)]
            for a, b in zip(edges, edges[1:], strict=False):
                piece = text[a:b].encode("utf-8", "surrogatepass")
                self.pieces[piece[:PIECE]].append((number, a, piece))
        self.heads = np.array(sorted({int.from_bytes(p[:8], "little") for p in self.pieces}), np.uint64)
        self.table = np.zeros(1 << _BITS, bool)
        self.table[(self.heads * _MIX) >> np.uint64(64 - _BITS)] = True

    def pattern(self, number: int) -> Pattern:
        if number not in self.patterns:
            if len(self.patterns) > 20_000:
                self.patterns.clear()
            self.patterns[number] = Pattern(self.texts[number])
        return self.patterns[number]

    def hits(self, joined: bytes) -> Iterator[tuple[int, int, int]]:
        """(byte position, item, first character of the piece in the item) of every piece in the bytes."""
        for shift in range(min(8, len(joined))):
            heads = np.frombuffer(joined, "<u8", (len(joined) - shift) // 8, shift)
            maybe = np.flatnonzero(self.table[(heads * _MIX) >> np.uint64(64 - _BITS)])
            if not len(maybe):
                continue
            at = np.searchsorted(self.heads, heads[maybe])
            maybe = maybe[self.heads[np.minimum(at, len(self.heads) - 1)] == heads[maybe]]
            for position in (maybe * 8 + shift).tolist():
                for number, first, piece in self.pieces.get(joined[position : position + PIECE], ()):
                    if joined.startswith(piece, position):
                        yield position, number, first

    def matches(self, texts: list[str]) -> dict[int, list[tuple[int, int, int, int]]]:
        """By text: (item, distance, start, end) of the closest occurrence of each item within its budget."""
        encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
        ends = np.cumsum([len(e) + 1 for e in encoded])
        guesses: dict[tuple[int, int], set[int]] = defaultdict(set)
        places: dict[int, np.ndarray] = {}
        if len(self.heads):
            for position, number, first in self.hits(b"\n".join(encoded) + b"\n" * 8):
                row = int(np.searchsorted(ends, position, side="right"))
                position -= int(ends[row]) - len(encoded[row]) - 1
                if len(encoded[row]) != len(texts[row]):
                    if row not in places:
                        places[row] = np.cumsum((np.frombuffer(encoded[row], np.uint8) & 0xC0) != 0x80) - 1
                    position = int(places[row][position])
                guesses[row, number].add(position - first)
        found = defaultdict(list)
        for (row, number), starts in guesses.items():
            pattern = self.pattern(number)
            k = budget(pattern.size, self.share)
            best, text = None, texts[row]
            stretch: list[list[int]] = []
            for s in sorted(starts):
                a, b = max(0, s - k), s + pattern.size + k
                if stretch and a <= stretch[-1][1]:
                    stretch[-1][1] = b
                else:
                    stretch.append([a, b])
            for a, b in stretch:
                one = pattern.best(text[a:b], k)
                if one and (best is None or one[0] < best[0]):
                    best = (one[0], one[1] + a, one[2] + a)
            if best:
                found[row].append((number, *best))
        for number, word in self.short:
            for row, text in enumerate(texts):
                if m := word.search(text):
                    found[row].append((number, 0, m.start(), m.end()))
        return found


def item_blocks(benchmark: DataFrame, share: float = SHARE, block_chars: int = BLOCK_CHARS) -> Iterator[Items]:
    """The items in blocks of bounded size; the driver holds a block and the one before it."""
    ids, texts, size = [], [], 0
    for r in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        text = normal(r[1] or "")
        ids.append(r[0])
        texts.append(text)
        size += len(text)
        if size >= block_chars:
            yield Items(ids, texts, share)
            ids, texts, size = [], [], 0
    if texts:
        yield Items(ids, texts, share)


_COLUMNS = "doc_id long, item_id long, distance int, start long, end long"


def _found(documents: DataFrame, items: Items) -> DataFrame:
    ids, texts, share = items.ids, items.texts, items.share

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Items(ids, texts, share)
        for batch in regrouped(batches, "text"):
            docs = batch.column(0).to_pylist()
            found = block.matches([normal(t or "") for t in batch.column(1).to_pylist()])
            rows = [(docs[row], ids[number], d, s, e) for row, many in sorted(found.items()) for number, d, s, e in sorted(many)]
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "item_id", "distance", "start", "end"])

    return documents.mapInArrow(match, _COLUMNS)


def matched(documents: DataFrame, benchmark: DataFrame, share: float = SHARE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, distance, start, end of every document and item that occurs in it within its budget.

    The closest occurrence counts, the first of equals; start and end are code points of the normal text.
    """
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out, last = documents.sparkSession.createDataFrame([], _COLUMNS), None
    for items in item_blocks(benchmark, share, block_chars):
        if last is not None:
            out = out.unionByName(stored(_found(read, last), "matches"))
        last = items
    return out if last is None else out.unionByName(_found(read, last))


def without_leaks(documents: DataFrame, benchmark: DataFrame, share: float = SHARE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that hold no item; columns and other rows stay as they are."""
    at = documents.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch], ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        block = Items(ids, texts, share)
        for batch in regrouped(batches, "text"):
            found = block.matches([normal(t or "") for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array([row not in found for row in range(batch.num_rows)], pa.bool_()))

    def leaks(batches: Iterator[pa.RecordBatch], ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        block = Items(ids, texts, share)
        for batch in regrouped(batches, "text"):
            found = block.matches([normal(t or "") for t in batch.column(0).to_pylist()])
            yield batch.filter(pa.array([row in found for row in range(batch.num_rows)], pa.bool_())).select(["sha"])

    # Whether a text leaks depends on the text alone: a block that is not the last leaves digests of leaking texts.
    digest, gone, last = F.sha2("text", 256), None, None
    for items in item_blocks(benchmark, share, block_chars):
        if last is not None:
            read = documents.select(F.col("text").cast("string").alias("text"), digest.alias("sha"))
            one = stored(read.mapInArrow(lambda b, i=last.ids, t=last.texts: leaks(b, i, t), "sha string").distinct(), "leaks")
            gone = one if gone is None else gone.unionByName(one)
        last = items
    if last is None:
        return documents
    left = documents.mapInArrow(lambda b, i=last.ids, t=last.texts: keep(b, i, t), documents.schema)
    return left if gone is None else left.join(gone.select(F.col("sha").alias("__leak")), digest == F.col("__leak"), "left_anti")
