"""Alignment of two tokenizers over the bytes of a text, by pointer jumping.

Both tokenizers cut the same bytes (a space and the text). Tokens of the two that share bytes belong together; where both end,
a group ends. Every token points to the token of the other side that overlaps it and reaches farthest right, the last one of a group to
itself; doubling all pointers at once (pointer = pointer of pointer) takes them to the group's last token in as many steps as the
logarithm of the longest chain, and that token labels the group.

Texts are cut at single spaces between other than white space: there no token of either side goes on, so each chunk is aligned
once per worker and remembered, all new chunks of a batch in one vectorised run. A text with a chunk whose tokens do not give its bytes is aligned whole, or
has no tokens if the whole does not match either.

Counts over the corpus: each row counts once for an id pair that it holds linked. Pairs of the `HEAVY` largest counts at most, cut at
a count, are known to every task, as are the highest counts of the A ids (bounded by the vocabulary); the occurrences of the other
pairs, which no count makes hot, are joined by pair. Encoded rows are stored once, so texts are encoded once.

Defined cases: NULL and empty texts, and texts whose tokens of either side do not join to their bytes, have no tokens: zeros, and an empty
digest; repeated rows count each; a NULL id is a value like any other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.llm.common import regrouped, stored

#: Chunks that a worker remembers (some 200 MB); beyond it, the older half goes.
CACHED = 400_000
HEAVY = 200_000
#: Is any space of a text not a place to cut? Few texts have one; the others are cut at every space.
_LOOSE = re.compile("[\\s▁] |^ | \\s| $")
#: A space after other than white space (or the mark that stands for a space in pieces) and before other than white space.
_TIGHT = re.compile("(?<=[^\\s▁]) (?=\\S)")
#: An id pair is one number: the A id times this, plus the B id.
WIDTH = 1 << 20
_BAD = ("", b"", 0, 0, 0, -1)
#: Chunks that are encoded as one text: what holds at the cuts of a text holds between chunks too.
JOINED = 1024


def byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: printable Latin-1 letters stand for themselves, the others for letters from 256 on, in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def successors(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """For the A tokens and, behind them, the B tokens: the farthest-right overlapping token, or itself at a group's end."""
    n = len(a_end)
    last_b = np.searchsorted(b_start, a_end, side="left") - 1
    last_a = np.searchsorted(a_start, b_end, side="left") - 1
    own = n + np.arange(len(b_end))
    return np.concatenate([n + last_b, np.where(a_end[last_a] > b_end, last_a, own)])


def terminals(pointer: np.ndarray) -> np.ndarray:
    """Where every pointer ends, by doubling."""
    while True:
        twice = pointer[pointer]
        if np.array_equal(twice, pointer):
            return pointer
        pointer = twice


class Aligner:
    """Groups, links and sizes of texts, with a memory of chunks."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        numbers = range(max(len(self.bytes_a), len(self.bytes_b)))
        self.names = [str(i) + mark for i in numbers for mark in ",|;"]
        self.name_size = np.array([len(n) for n in self.names], np.int64)
        # A piece with a space behind other letters would reach over the cuts.
        pieces = (self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.known: dict[str, tuple] = {}

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def aligned(self, texts: list[str]) -> list[tuple]:
        """(groups, packed links, A tokens, B tokens, groups, 1) of each text, which a space is put before; _BAD where the bytes differ."""
        found: list[tuple] = [_BAD] * len(texts)
        plain = [k for k, t in enumerate(texts) if self.cuts and t and not t[-1].isspace() and "▁" not in t]
        alone = set(range(len(texts))).difference(plain)
        waiting = [[k] for k in alone] + [plain[at : at + JOINED] for at in range(0, len(plain), JOINED)]
        while waiting:
            whole, a_lists, b_lists, again = [], [], [], []
            for unit in waiting:
                text = " ".join([texts[k] for k in unit])
                a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
                if b"".join(map(self.bytes_a.__getitem__, a)) == (" " + text).encode() == b"".join(map(self.bytes_b.__getitem__, b)):
                    whole += unit
                    a_lists.append(a)
                    b_lists.append(b)
                elif len(unit) > 1:
                    again += [unit[: len(unit) // 2], unit[len(unit) // 2 :]]
            if whole:
                sizes = np.array([len(texts[k].encode()) + 1 for k in whole], np.int64)
                for k, row in zip(whole, self._groups(a_lists, b_lists, sizes), strict=True):
                    found[k] = row
            waiting = again
        return found

    def _groups(self, a_lists: list[list[int]], b_lists: list[list[int]], sizes: np.ndarray) -> Iterator[tuple]:
        """Align tokens of the same bytes, all at once; a row for each text, whose sizes in bytes are given."""
        a, b = (np.concatenate([np.array(ids, np.int64) for ids in lists]) for lists in (a_lists, b_lists))
        a_end, b_end = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        a_start, b_start = a_end - self.size_a[a], b_end - self.size_b[b]
        last = terminals(successors(a_start, a_end, b_start, b_end))
        # Groups in order of their bytes; within one, A tokens come first.
        order = np.argsort(2 * last + (np.arange(len(last)) >= len(a)), kind="stable")
        group, second = last[order], order >= len(a)
        same, across = group[1:] == group[:-1], second[1:] != second[:-1]
        named = 3 * np.concatenate([a, b])[order] + np.append(np.where(same, np.where(across, 1, 0), 2), 2)
        text = "".join(map(self.names.__getitem__, named.tolist()))
        letters = np.concatenate([[0], np.cumsum(self.name_size[named])])
        # Overlapping pairs: from the first B token that ends behind an A token's start to the last that starts before its end.
        low, high = np.searchsorted(b_end, a_start, side="right"), np.searchsorted(b_start, a_end, side="left")
        held = high - low
        of = np.repeat(np.arange(len(a)), held)
        other = np.arange(len(of)) - np.repeat(np.cumsum(held) - held, held) + low[of]
        pairs = (a[of] * WIDTH + b[other]).tobytes()
        pair_ends = np.concatenate([[0], np.cumsum(held)])
        ends = np.cumsum(sizes)
        a_bound, b_bound = (np.concatenate([[0], np.searchsorted(e, ends, side="right")]) for e in (a_end, b_end))
        if (a_end[a_bound[1:] - 1] != ends).any() or (b_end[b_bound[1:] - 1] != ends).any():
            raise ValueError("a token reaches over the end of a text")
        heads = np.concatenate([[0], np.cumsum(np.append(~same, True))])
        bound = a_bound + b_bound
        places, links = letters[bound].tolist(), (8 * pair_ends[a_bound]).tolist()
        counts = zip(np.diff(a_bound).tolist(), np.diff(b_bound).tolist(), np.diff(heads[bound]).tolist(), strict=True)
        for k, (n_a, n_b, n_groups) in enumerate(counts):
            yield text[places[k] : places[k + 1] - 1], pairs[links[k] : links[k + 1]], n_a, n_b, n_groups, 1

    def _chunks(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        return _TIGHT.split(text) if _LOOSE.search(text) else text.split(" ")

    def __call__(self, texts: list[str | None]) -> Iterator[tuple]:
        """As `aligned`, for whole texts put together from chunks."""
        cut = [self._chunks(t) if t else [] for t in texts]
        wanted = set().union(*cut)
        missing = [c for c in wanted if c not in self.known]
        if len(self.known) + len(missing) > CACHED:
            self.known = dict(islice(self.known.items(), len(self.known) // 2, None))
            missing = [c for c in wanted if c not in self.known]
        self.known.update(zip(missing, self.aligned(missing), strict=True))
        for text, chunks in zip(texts, cut, strict=True):
            rows = [self.known[c] for c in chunks]
            if len(rows) == 1:
                yield rows[0]
            elif not rows:
                yield _BAD
            else:
                groups, pairs, n_a, n_b, n_groups, fine = zip(*rows, strict=True)
                yield (";".join(groups), b"".join(pairs), sum(n_a), sum(n_b), sum(n_groups), 1) if min(fine) > 0 else self.aligned([text])[0]


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner."""
    return Aligner(path_a, path_b)


_ROW = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def encoded(documents: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """A row for each document: sizes, digest, distinct id pairs with the times each is linked and, if asked for, the groups as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(path_a, path_b)
        for batch in regrouped(batches, "text", 4 << 20):
            digests, groups, sizes, pairs, times = [], [], [], [], []
            for text, links, n_a, n_b, n_groups, _ in align(batch.column(2).to_pylist()):
                found, number = np.unique(np.frombuffer(links, np.int64), return_counts=True)
                pairs.append(found)
                times.append(number)
                sizes.append((n_a, n_b, n_groups, len(links) // 8))
                digests.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
                if with_groups:
                    groups.append(text)
            bounds = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in pairs])]), pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(x), kind)) for x, kind in ((pairs, pa.int64()), (times, pa.int32()))]
            numbers = [pa.array(c, pa.int64()) for c in zip(*sizes, strict=True)]
            columns = [batch.column(0), batch.column(1), *numbers, pa.array(digests), *lists, *([pa.array(groups)] if with_groups else [])]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"{_ROW}, pairs array<long>, times array<int>" + (", groups string" if with_groups else "")
    names = [c.split()[0] for c in schema.split(", ")]
    source = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, schema)


def heavy_pairs(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs with the largest counts, sorted, with their counts, and the least count among them; at most so many."""
    step = F.floor(F.log2("docs") * 8).cast("int")
    # At most eight rows for every doubling of the count.
    sizes = sorted(((r["step"], r["n"]) for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    least, held = None, 0
    for level, n in sizes:
        held += n
        if held > most:
            break
        least = level
    if least is None:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    table = counts.where(step >= least).toArrow()
    pairs, docs = table.column("pair").to_numpy(), table.column("docs").to_numpy()
    order = np.argsort(pairs)
    return pairs[order], docs[order]


def scored(rows: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """The rows of `encoded` with n_best and count_sum, from counts over all of them."""
    counts = stored(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs")), "pair-counts")
    best_of = counts.groupBy(F.expr(f"pair div {WIDTH}").alias("a")).agg(F.max("docs").alias("best"))
    # One row for each id of the A vocabulary at most.
    top = {r["a"]: r["best"] for r in best_of.collect()}
    best = np.zeros(max(top, default=0) + 1, np.int64)
    best[list(top)] = list(top.values())
    pairs, docs = heavy_pairs(counts, heavy)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("pairs"))
            held = lists.flatten().to_numpy()
            times = batch.column(batch.schema.get_field_index("times")).flatten().to_numpy().astype(np.int64)
            of = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            place = np.minimum(np.searchsorted(pairs, held), max(len(pairs) - 1, 0))
            known = pairs[place] == held if len(pairs) else np.zeros(len(held), bool)
            number = docs[place[known]]
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], of[known], times[known] * (number == best[held[known] // WIDTH]))
            np.add.at(sums[1], of[known], times[known] * number)
            rest = np.concatenate([[0], np.cumsum(np.bincount(of[~known], minlength=batch.num_rows))])
            others = [pa.ListArray.from_arrays(pa.array(rest, pa.int32()), pa.array(v[~known])) for v in (held, times)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], *map(pa.array, sums), *others], names)

    schema = f"{_ROW}, n_best long, count_sum long, pairs array<long>, times array<long>"
    names = [c.split()[0] for c in schema.split(", ")]
    told = stored(rows.select(*[c.split()[0] for c in _ROW.split(", ")], "pairs", "times").mapInArrow(look_up, schema), "pair-sums")
    rare = told.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    highest = best_of.withColumnRenamed("a", "of_a")
    counted = counts.join(highest, F.expr(f"pair div {WIDTH}") == F.col("of_a")).select("pair", "docs", (F.col("docs") == F.col("best")).cast("long").alias("is_best"))
    added = rare.join(counted, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("is_best")).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    whole = told.drop("pairs", "times").unionByName(added, allowMissingColumns=True)
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    summed = whole.groupBy("row").agg(*[F.max(c).alias(c) for c in kept], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return summed.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def alignments(documents: DataFrame, path_a: str, path_b: str, heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    return scored(stored(encoded(documents, path_a, path_b), "alignments"), heavy)
