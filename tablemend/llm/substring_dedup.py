"""Substring deduplication with difference-cover anchors.

A window is 20 consecutive words. A word is removed if a window that covers it has a word sequence that also starts
earlier (smaller doc_id, or the same document and an earlier start); windows are judged on the input.

Not every window is hashed. Anchors of 8 words are hashed at the word positions that a difference cover modulo 13
holds, 4 of 13: for any two starts i and j some d < 13 has both i+d and j+d in the cover, and the 8 words there lie in
both windows, so equal windows always share an aligned anchor. Only windows that hold an anchor seen more than once are
extended, that is hashed whole (128 bits), and of equal ones the earliest stays.

Whole copies are settled first, by a digest of the text: of a copy that is not the first every word in a window goes, and
its anchors and windows are not needed. Documents are dealt to blocks of about 2 MB of text. A block sends each anchor and each extended window once, however
often it holds it, so a passage or a group of copies that is in a third of all rows has one row per block; the
reducers compare neighbours of sorted rows and hold no group. Answers go back to the blocks.

Defined cases: a NULL text has no words; a NULL doc_id comes before all others; rows that repeat a doc_id are judged by
(doc_id, start) too, so equal windows at the same start all stay; an empty table gives no rows; other columns are not
read. Very long texts are one row of their block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.llm.common import ints, normal_bytes, partitions, stored, word_bounds

WINDOW = 20
BLOCK_BYTES = 2 << 20
#: Perfect difference sets, by period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9)}
_NO_ID = np.iinfo(np.int64).min
#: What a block is told: a shared anchor (a), a copy (a: doc_id, b: mark of the text), removed windows (a: document in
#: the block, b: first start, c: number of starts).
ANCHOR, COPY, REMOVED = 0, 1, 2
_TOLD = ["block", "kind", "a", "b", "c"]
_TOLD_TYPES = "block long, kind int, a long, b long, c long"
_HALF = (1 << 32) - 1


def cover(window: int) -> tuple[int, tuple[int, ...]]:
    """The period and the cover for a window: the anchor keeps at least a third of the window."""
    period = max(p for p in COVERS if p == 1 or 3 * p <= 2 * (window + 1))
    return period, COVERS[period]


def _told(told: pa.Table, kind: int, column: str) -> np.ndarray:
    return told.column(column).to_numpy()[told.column("kind").to_numpy() == kind]


class Block:
    """The documents of one block in a fixed order, as joined words with word bounds."""

    def __init__(self, table: pa.Table, told: pa.Table, window: int):
        ids = [_NO_ID if i is None else i for i in table.column("doc_id").to_pylist()]
        texts = [t or "" for t in table.column("text").to_pylist()]
        self.order = sorted(range(len(ids)), key=lambda k: (ids[k], texts[k]))
        self.ids = np.array([ids[k] for k in self.order], np.int64)
        copies, marks = set(zip(*(_told(told, COPY, c).tolist() for c in "ab"), strict=True)), table.column("mark").to_pylist()
        self.copy = [(ids[k], marks[k]) in copies for k in self.order]
        self.words = [normal_bytes(texts[k]) for k in self.order]
        self.bounds = [word_bounds(w) for w in self.words]
        self.window = window
        self.period, held = cover(window)
        self.held = np.zeros(self.period, bool)
        self.held[list(held)] = True

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every anchor: hash, document (number in the block), word position."""
        size, hashes, rows, places = self.window - self.period + 1, [], [], []
        for row, (words, (starts, ends)) in enumerate(zip(self.words, self.bounds, strict=True)):
            if self.copy[row] or len(starts) < self.window:
                continue
            at = np.arange(len(starts) - size + 1)
            at = at[self.held[at % self.period]]
            digest = xxhash.xxh3_64_intdigest
            hashes += [digest(words[a:b]) for a, b in zip(starts[at].tolist(), ends[at + size - 1].tolist(), strict=True)]
            rows.append(np.full(len(at), row, np.int64))
            places.append(at)
        whole = np.concatenate if rows else lambda _: np.empty(0, np.int64)
        return np.array(hashes, np.uint64).view(np.int64), whole(rows), whole(places)

    def windows(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every window that holds a shared anchor: 128-bit hash (two columns), document, start."""
        hashes, rows, places = self.anchors()
        order = np.sort(hashes)
        again = order[1:][order[1:] == order[:-1]]
        hit = np.isin(hashes, np.concatenate([again, shared]))
        digests, found_rows, found = [], [], []
        rows, places = rows[hit], places[hit]
        cut = np.flatnonzero(np.diff(rows)) + 1
        for at in np.split(np.arange(len(rows)), cut) if len(rows) else ():
            row = int(rows[at[0]])
            words, (starts, ends) = self.words[row], self.bounds[row]
            last = len(starts) - self.window
            # A window from s holds the anchor at p if s <= p < s + period.
            mark = np.zeros(len(starts) + 1, np.int64)
            np.add.at(mark, np.maximum(places[at] - self.period + 1, 0), 1)
            np.add.at(mark, places[at] + 1, -1)
            held = np.flatnonzero(np.cumsum(mark)[: last + 1] > 0)
            digest = xxhash.xxh3_128_digest
            digests += [digest(words[a:b]) for a, b in zip(starts[held].tolist(), ends[held + self.window - 1].tolist(), strict=True)]
            found_rows.append(np.full(len(held), row, np.int64))
            found.append(held)
        if not found:
            return np.empty((0, 2), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        return np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2), np.concatenate(found_rows), np.concatenate(found)


def _runs(rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (row, start) as runs of consecutive starts: row, first start, number."""
    order = np.lexsort((starts, rows))
    rows, starts = rows[order], starts[order]
    new = np.concatenate([[True], (np.diff(rows) != 0) | (np.diff(starts) != 1)]) if len(rows) else np.empty(0, bool)
    first = np.flatnonzero(new)
    return rows[first], starts[first], np.diff(np.concatenate([first, [len(rows)]]))


def _block_number(table: pa.Table) -> int:
    return table.column("block")[0].as_py()


def anchors_of_block(window: int):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        hashes = np.unique(Block(table, told, window).anchors()[0])
        return pa.table({"anchor": hashes, "block": np.full(len(hashes), _block_number(table), np.int64)})

    return run


def _answers(block: np.ndarray, kind: int, a: np.ndarray, b: np.ndarray | None = None, c: np.ndarray | None = None) -> pa.RecordBatch:
    none = np.zeros(len(block), np.int64)
    columns = [block, np.full(len(block), kind, np.int32), a, none if b is None else b, none if c is None else c]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], _TOLD)


def shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor: tell the blocks of those with an equal neighbour."""
    held, held_block, sent = np.empty(0, np.int64), np.empty(0, np.int64), False
    for batch in batches:
        if batch.num_rows:
            anchor, block = np.concatenate([held, ints(batch, "anchor")]), np.concatenate([held_block, ints(batch, "block")])
            same = anchor[1:] == anchor[:-1]
            keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            # The first row is the last one of the batch before; it goes out here only if it has not yet.
            keep[0] &= not sent
            sent = bool(len(same) and same[-1]) or (sent and len(anchor) == 1)
            held, held_block = anchor[-1:], block[-1:]
            yield _answers(block[keep], ANCHOR, anchor[keep])


_WINDOW_COLUMNS = ["k1", "k2", "doc_id", "place", "owner"]


def _window_rows(k1: np.ndarray, k2: np.ndarray, ids: np.ndarray, row: np.ndarray, start: np.ndarray, block: int, run: np.ndarray) -> pa.RecordBatch:
    """place: document in the block and start; owner: block and number of starts (0: a window to be judged)."""
    columns = [k1, k2, ids, row << 32 | start, block << 32 | run]
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c, np.int64)) for c in columns], _WINDOW_COLUMNS)


def windows_of_block(window: int):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        block = Block(table, told, window)
        number = _block_number(table)
        keys, rows, starts = block.windows(_told(told, ANCHOR, "a"))
        ids = block.ids[rows]
        order = np.lexsort((starts, ids, keys[:, 1], keys[:, 0]))
        keys, rows, starts, ids = keys[order], rows[order], starts[order], ids[order]
        new = np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]) if len(rows) else np.empty(0, bool)
        first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(rows) else np.empty(0, np.int64)
        later = (ids != ids[first]) | (starts != starts[first])
        one = ~later
        ask = _window_rows(keys[one, 0], keys[one, 1], ids[one], rows[one], starts[one], number, np.zeros(one.sum(), np.int64))
        # What the block itself knows to be removed passes through, under a key that spreads it.
        row, start, n = _runs(rows[later], starts[later])
        spread = (row * 1_000_003 + start + number) * -7046029254386353131
        none = np.zeros(len(row), np.int64)
        return pa.Table.from_batches([ask, _window_rows(spread, none, none, row, start, number, n)])

    return run


def later_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (k1, k2, judged or known, doc_id, start): tell of known runs, and of equal windows but the earliest."""
    k1 = k2 = doc = start = None
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, d, place, owner = (ints(batch, c) for c in _WINDOW_COLUMNS)
        s, run = place & _HALF, owner & _HALF
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | ((run[1:] > 0) != (run[:-1] > 0))])
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        d0, s0 = d[first], s[first]
        if k1 is not None and (a[0], b[0]) == (k1, k2) and not run[0]:
            ahead = first == 0
            d0, s0 = np.where(ahead, doc, d0), np.where(ahead, start, s0)
        keep = (run > 0) | (d != d0) | (s != s0)
        yield _answers(owner[keep] >> 32, REMOVED, place[keep] >> 32, s[keep], np.maximum(run[keep], 1))
        if not run[-1]:
            k1, k2, doc, start = a[-1], b[-1], d0[-1], s0[-1]
        else:
            k1 = None


def kept_of_block(window: int):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        block = Block(table, told, window)
        rows, starts, runs = (_told(told, REMOVED, c) for c in "abc")
        order = np.argsort(rows, kind="stable")
        rows, starts, runs = rows[order], starts[order], runs[order]
        edge = np.searchsorted(rows, np.arange(len(block.ids) + 1))
        out = {"doc_id": [], "text": [], "n_words": [], "n_removed": [], "removed": []}
        for row, words in enumerate(block.words):
            first, n = block.bounds[row][0], len(block.bounds[row][0])
            mine = slice(edge[row], edge[row + 1])
            mark = np.zeros(n + 1, np.int64)
            np.add.at(mark, starts[mine], 1)
            np.add.at(mark, starts[mine] + runs[mine] + window - 1, -1)
            gone = np.full(n, n >= window) if block.copy[row] else np.cumsum(mark)[:n] > 0
            change = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            spans = change.reshape(-1, 2)
            parts, at = [], 0
            for a, b in [*spans.tolist(), (n, n)]:
                if a > at:
                    parts.append(words[first[at] : block.bounds[row][1][a - 1]])
                at = b
            out["doc_id"].append(None if block.ids[row] == _NO_ID else int(block.ids[row]))
            out["text"].append(b" ".join(parts))
            out["n_words"].append(n)
            out["n_removed"].append(int(gone.sum()))
            out["removed"].append([{"start": a, "end": b} for a, b in spans.tolist()])
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        table = pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))
        return table.set_column(1, "text", table.column("text").cast(pa.string()))

    return run


def whole_copies(dealt: DataFrame) -> DataFrame:
    """Rows for the blocks: documents whose whole text stands under a smaller doc_id too."""
    known = F.col("doc_id").isNotNull()
    keyed = dealt.where(F.col("text").isNotNull()).select("block", "doc_id", "mark", F.sha2("text", 256).alias("sha"))
    first = keyed.groupBy(F.col("sha").alias("same")).agg(F.min(F.struct(known.alias("known"), F.col("doc_id").alias("id"))).alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = keyed.join(first, F.col("sha") == F.col("same")).where(~F.col("doc_id").eqNullSafe(F.col("first.id")))
    return copies.select("block", F.lit(COPY).alias("kind"), F.coalesce(F.col("doc_id"), F.lit(_NO_ID)).alias("a"), F.col("mark").alias("b"), F.lit(0).cast("long").alias("c"))


def deduplicated(documents: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, text (kept words joined by one space), n_words, n_removed, removed (word spans) for each document."""
    spark = documents.sparkSession
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = read.select("doc_id", "text", F.xxhash64("text").alias("mark"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("long").alias("block"))
    copies = stored(whole_copies(dealt), "copies")
    parts = partitions(spark)
    blocked = dealt.groupBy("block")

    anchors = blocked.cogroup(copies.groupBy("block")).applyInArrow(anchors_of_block(window), "anchor long, block long")
    shared = anchors.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(shared_anchors, _TOLD_TYPES)

    columns = ", ".join(f"{c} long" for c in _WINDOW_COLUMNS)
    asked = blocked.cogroup(shared.unionByName(copies).groupBy("block")).applyInArrow(windows_of_block(window), columns)
    known = F.col("owner").bitwiseAND(F.lit(_HALF)) > 0
    later = (
        asked.repartition(parts, "k1", "k2").sortWithinPartitions("k1", "k2", known, "doc_id", F.col("place").bitwiseAND(F.lit(_HALF))).mapInArrow(later_windows, _TOLD_TYPES)
    )
    kept = "doc_id long, text string, n_words long, n_removed long, removed array<struct<start:long,end:long>>"
    return blocked.cogroup(later.unionByName(copies).groupBy("block")).applyInArrow(kept_of_block(window), kept)
