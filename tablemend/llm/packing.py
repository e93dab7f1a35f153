"""Best-fit packing planned on a histogram of lengths.

Documents become token pieces of at most one sequence. Their lengths are counted, best fit is run once over the counts
(longest length first, each batch of equal lengths into the open sequences it fills best), and each piece then takes
the planned place of its rank within its length. The plan's size depends on the sequence length, not on the documents.

Ranks are counted within lanes: a length with many pieces has as many lanes as it needs to keep a lane near
`LANE_ROWS` rows, so no length meets in one task. Histogram (one row per length), lane counts (one row per lane, that is per
`LANE_ROWS` pieces) and the plan come to the driver.

Defined cases: a NULL text is empty and gives one piece of the end token; a NULL id is a value like any other; equal
rows give equal pieces with places of their own; an empty table gives no piece; other columns are not read. The file's
special tokens inside a text are the ids that the tokenizer gives them.
"""

from __future__ import annotations

import os
import re
import string
import struct
import zlib
from bisect import bisect_left, insort
from collections import defaultdict, deque
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablemend.llm.common import ints, regrouped, stored

LENGTH = 1024
END_ID = 2
LANE_ROWS = 100_000
#: Texts that a worker remembers (some 60 MB); beyond it, those not met for longest go.
CACHED = 300_000
#: New chunks encoded as one text; a text of its own for each costs several times as much.
JOINED = 256
#: Text cut and counted at once: the more, the fewer chunks are looked up.
BATCH_BYTES = 16 << 20
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: A space before white space or the end, where a text is not cut.
_LOOSE = re.compile(r" (?:[\s\x1c-\x1f]|\Z)")
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
#: Marks of ASCII, Latin-1 and general punctuation.
_STARTS = " " + string.ascii_letters
_MARKS = re.escape(string.punctuation) + "¡-©«-±´¶-¸»¿×÷‐-‧"
#: The byte-level tokenizer's pattern for texts of these letters and marks, ASCII digits, spaces and line feeds.
_PIECE = re.compile(rf" ?[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[{_MARKS}]+|[ \n]+(?![^ \n])|[ \n]+")
_ENCODERS: dict[str, Encoder] = {}


def packed_ids(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def chunks_of(text: str) -> list[str]:
    """The text cut at the spaces that stand before other than white space; joined by spaces it is the text."""
    chunks = text.split(" ")
    if _LOOSE.search(text):
        tight = chunks[:1]
        for c in chunks[1:]:
            if not c or c[0].isspace():
                tight[-1] += " " + c
            else:
                tight.append(c)
        return tight
    return chunks


def byte_letters() -> np.ndarray:
    """The code point with which byte-level vocabularies write each byte; byte 0, which no piece holds, stays as it is."""
    points = np.arange(256, dtype="<u2")
    written = [n for n in range(256) if 33 <= n <= 126 or 161 <= n <= 172 or n >= 174]
    unwritten = np.setdiff1d(points, written)
    points[unwritten] = 256 + np.arange(len(unwritten))
    points[0] = 0
    return points


def numbered(lists: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct chunks, a space before each; the chunks of all lists as their numbers; and where each list starts."""
    found = lists.flatten().dictionary_encode()
    return [" " + c for c in found.dictionary.to_numpy(zero_copy_only=False).tolist()], found.indices.to_numpy(), lists.offsets.to_numpy()


def numbered_chunks(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The chunks of the texts, cut as `chunks_of` does, numbered."""
    lists = pc.split_pattern(texts, " ")
    chunks, codes, starts = numbered(lists)
    loose = np.array([c == " " or c[1].isspace() for c in chunks])[codes]
    loose[starts[:-1]] = False
    if loose.any():
        loose = np.logical_or.reduceat(loose, starts[:-1])
        tight = pa.array([chunks_of(t.as_py()) if x else [] for t, x in zip(texts, loose.tolist(), strict=True)], lists.type)
        return numbered(pc.if_else(pa.array(loose), tight, lists))
    return chunks, codes, starts


class Encoder:
    """Token ids as little-endian bytes; a chunk (a space and what follows up to the next) is looked up once per batch.

    The byte-level tokenizer never joins a space before other than white space with what stands before it, so the ids of
    a text are those of its chunks, one after the other; a space before white space or the end stays within its
    chunk. A new chunk of common letters and marks is cut by the tokenizer's own pattern, and the file's model encodes
    each new piece. Other chunks are encoded joined into texts, and the ids cut where a token starts with a space. Texts
    with the file's special tokens are encoded whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Joined chunks must not spell a special token that none of their texts has.
        self.joined = 1 if any(" " in s for s in self.special) else JOINED
        cut = self.tokenizer.pre_tokenizer
        self.byte_level = self.tokenizer.normalizer is None and isinstance(cut, pre_tokenizers.ByteLevel) and cut.use_regex and not cut.add_prefix_space
        self.model, self.byte_letters = self.tokenizer.model, byte_letters()
        vocab = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocab.values()) + 1, bool)
        self.spaced[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        found = []
        for at in range(0, len(texts), 4096):
            found += [packed_ids(e.ids) for e in self.tokenizer.encode_batch_fast(texts[at : at + 4096], add_special_tokens=False)]
        return found

    def encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of pieces that the pattern does not cut, from the model alone."""
        if not pieces:
            return {}
        written = self.byte_letters[np.frombuffer("\0".join(pieces).encode(), np.uint8)].tobytes().decode("utf-16-le").split("\0")
        tokenize, ids, ends = self.model.tokenize, [], [0]
        for piece in written:
            ids += [t.id for t in tokenize(piece)]
            ends.append(4 * len(ids))
        packed = np.array(ids, "<u4").tobytes()
        return {p: packed[a:b] for p, (a, b) in zip(pieces, pairwise(ends), strict=True)}

    def encode_joined(self, chunks: list[str]) -> dict[str, bytes]:
        """The ids of chunks that start with a space and hold no other."""
        found = {}
        for at in range(0, len(chunks), self.joined):
            some = chunks[at : at + self.joined]
            ids = self.encode(["".join(some)])[0]
            starts = np.flatnonzero(self.spaced[np.frombuffer(ids, "<u4")]) * 4
            found.update(zip(some, (ids[a:b] for a, b in pairwise([*starts.tolist(), len(ids)])), strict=True))
        return found

    def recalled(self, texts: list[str]) -> list[str]:
        """Those of the texts that are not remembered; the others are remembered anew."""
        missing = [t for t, ids in zip(texts, map(self.known.get, texts), strict=True) if ids is None]
        again = {t: ids for t, ids in zip(missing, map(self.older.get, missing), strict=True) if ids is not None}
        self.known.update(again)
        return [t for t in missing if t not in again] if again else missing

    def learn(self, texts: list[str]) -> None:
        """Remember the ids of these texts without special tokens."""
        missing = self.recalled(texts)
        for at in range(0, len(missing), 1 << 16):
            words, cut, tight, other = [], [], [], []
            for t in missing[at : at + (1 << 16)]:
                if self.byte_level and t.isascii() and t[1:].isalpha() and t[0] in _STARTS:
                    words.append(t)
                elif self.byte_level and t and len("".join(pieces := _PIECE.findall(t))) == len(t):
                    cut.append((t, pieces))
                else:
                    (tight if t.rfind(" ") == 0 else other).append(t)
            self.known.update(self.encode_pieces(self.recalled(list(set(words).union(*(pieces for _, pieces in cut))))))
            self.known.update([(t, b"".join([self.known[p] for p in pieces])) for t, pieces in cut if len(pieces) > 1])
            self.known.update(self.encode_joined(tight))
            self.known.update(zip(other, self.encode(other), strict=True))

    def __call__(self, texts: list[str] | pa.Array) -> Iterator[bytes]:
        """The ids of each text."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        if not len(texts):
            return
        if len(self.known) > CACHED // 2:
            self.known, self.older = {}, self.known
        special = np.zeros(len(texts), bool)
        for s in self.special:
            special |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        whole = iter(self.encode(texts.filter(pa.array(special)).to_pylist()))
        if special.any():
            texts = pc.if_else(pa.array(special), "", texts)
        chunks, codes, starts = numbered_chunks(texts)
        # The first chunk of a text has no space before it; its place among the others holds nothing.
        first = [chunks[k][1:] for k in codes[starts[:-1]].tolist()]
        codes = codes.copy()
        codes[starts[:-1]] = len(chunks)
        self.learn(chunks)
        self.learn(list(set(first)))
        ids = pa.array([*map(self.known.__getitem__, chunks), b""], pa.large_binary()).take(pa.array(codes))
        ends = np.frombuffer(ids.buffers()[1], np.int64)[starts].tolist()
        joined = memoryview(ids.buffers()[2] or b"")
        for c, (a, b), x in zip(first, pairwise(ends), special.tolist(), strict=True):
            yield next(whole) if x else self.known[c] + joined[a:b]


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cuts(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full ones, and before them what is left over."""
    rest = n % length
    return ([(0, rest)] if rest else []) + [(s, length) for s in range(rest, n, length)]


def token_pieces(documents: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids for every piece of every document."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path), np.array([end_id], "<u4").tobytes()
        for batch in regrouped(batches, "text", BATCH_BYTES):
            out = defaultdict(list)
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(pc.fill_null(batch.column(1), "")), strict=True):
                ids = memoryview(ids + end)
                for k, (s, n) in enumerate(cuts(len(ids) // 4, length)):
                    part = ids[4 * s : 4 * (s + n)]
                    for name, value in (("doc_id", doc_id), ("piece", k), ("start", s), ("length", n), ("ids_crc32", zlib.crc32(part))):
                        out[name].append(value)
                    if with_ids:
                        out["ids"].append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [pa.array(out["doc_id"], pa.int64()), pa.array(out["piece"], pa.int32()), *(pa.array(out[c], pa.int64()) for c in ("start", "length", "ids_crc32"))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(out["ids"], pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(pieces, _PIECES + (", ids array<int>" if with_ids else ""))


def best_fit(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Plan rows (piece length, first rank, pieces, first sequence, offset): consecutive ranks go to consecutive sequences.

    Longest pieces first; a batch goes to the open sequences with the least room that holds it, else new ones are
    opened, each taking as many of the batch as fit. Open sequences are kept as runs of equal room, never one by one.
    """
    plan: list[tuple[int, int, int, int, int]] = []
    runs: dict[int, deque[tuple[int, int]]] = defaultdict(deque)
    rooms: list[int] = []
    opened = 0

    def keep(room: int, first: int, n: int) -> None:
        if room and n:
            if not runs[room]:
                insort(rooms, room)
            runs[room].append((first, n))

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect_left(rooms, size)
            room, first, n = length, opened, left
            if at < len(rooms):
                room = rooms[at]
                first, n = runs[room].popleft()
                if not runs[room]:
                    rooms.pop(at)
            # A sequence takes as many as fit: after the first it is the one with the least room that holds the next.
            each = room // size
            full = min(n, left // each)
            rest = left - full * each if full < n else 0
            for new, holds in ((full, each), (1 if rest else 0, rest)):
                if new:
                    for k in range(holds):
                        plan.append((size, rank, new, first, length - room + k * size))
                        rank += new
                    keep(room - holds * size, first, new)
                    first, n, left = first + new, n - new, left - new * holds
            if room == length:
                opened = first
            else:
                keep(room, first, n)
    return plan


def placed(pieces: DataFrame, length: int = LENGTH, lane_rows: int = LANE_ROWS) -> DataFrame:
    """Add sequence_id and offset to stored pieces."""
    counts = {int(r["length"]): r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = best_fit(counts, length)
    lanes = {size: -(-n // lane_rows) for size, n in counts.items()}
    per_length = F.array(*[F.lit(lanes.get(k, 1)) for k in range(length + 1)])
    laned = pieces.withColumn("lane", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.get(per_length, F.col("length").cast("int"))).cast("int"))
    base, seen = {}, defaultdict(int)
    for r in sorted(laned.groupBy("length", "lane").agg(F.count("*").alias("n")).collect()):
        base[r["length"], r["lane"]] = seen[r["length"]]
        seen[r["length"]] += r["n"]
    # One number for (length, rank): ranks of a length stay below the span.
    span = max(counts.values(), default=0) + 1
    lane_keys = np.array(sorted(base), np.int64).reshape(-1, 2)
    lane_base = np.array([base[tuple(k)] for k in lane_keys.tolist()], np.int64)
    most = max(lanes.values(), default=1)
    lane_key = lane_keys[:, 0] * most + lane_keys[:, 1]
    steps = np.array(sorted(plan), np.int64).reshape(-1, 5)
    step_key = steps[:, 0] * span + steps[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                size = ints(batch, "length")
                rank = lane_base[np.searchsorted(lane_key, size * most + ints(batch, "lane"))] + ints(batch, "n") - 1
                step = np.searchsorted(step_key, size * span + rank, side="right") - 1
                keep = batch.select(kept)
                yield pa.RecordBatch.from_arrays(
                    [*keep.columns, pa.array(steps[step, 3] + rank - steps[step, 1]), pa.array(steps[step, 4])], [*kept, "sequence_id", "offset"]
                )

    kept = pieces.columns
    within = Window.partitionBy("length", "lane").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = laned.withColumn("n", F.row_number().over(within))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def packed(documents: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenize, store the pieces, and place every piece in a sequence."""
    return placed(stored(token_pieces(documents, path, length, end_id, with_ids), "pieces"), length)
