"""SimHash near-duplicates with Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into three segments (22, 21 and 21 bits). Two fingerprints with at most 4 differing bits
have two segments with at most 2 differing bits each: whatever the worst segment has, the other two share at most 2. Each
segment, filled up to 23 bits, is decoded by the perfect Golay code: every vector is within 3 bits of one codeword, so
the vector halfway between two that differ in at most 2 bits has a codeword within 4 bits of both. The indices of all
codewords within 4 bits (one, or six) therefore share one for such a pair. Keys join the indices of two segments; pairs of
fingerprints with an equal key are verified.

Only distinct fingerprints are joined; copies follow by their fingerprint. A key's fingerprints give a spanning
forest of their links, never all pairs, and a key with more of them than a task should compare is compared in
pairs of blocks.

Defined cases: a NULL or empty text has no shingle and fingerprint zero, linked like any other; a text of fewer words than
a shingle is one shingle; NULL ids are passed over by the smallest id (NULL if a component has no other); repeated rows
share a component; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.llm.common import components, ints, partitions, regrouped, stored, word_bounds

SHINGLE = 4
SEED = 42
RADIUS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
#: Shingles of one text that are hashed at once.
AT_ONCE = 1 << 18
#: Fingerprints of one key that one task compares.
BUCKET = 8192
#: Fixed value: a generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b110001110101
_BIT = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text; A-Z are lower-cased, words end at ASCII white space."""
    words = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    starts, ends = word_bounds(words)
    if not len(starts):
        return 0
    if len(starts) > shingle:
        starts, ends = starts[: len(starts) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts = np.zeros((8, 256), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), AT_ONCE):
        piece = slice(at, at + AT_ONCE)
        hashes = np.array([digest(words[a:b], SEED) for a, b in zip(starts[piece].tolist(), ends[piece].tolist(), strict=True)], "<u8")
        cells = hashes.view(np.uint8).reshape(-1, 8) + np.arange(8) * 256
        counts += np.bincount(cells.ravel(), minlength=2048).reshape(8, 256)
    ones = (counts @ _BIT).ravel()
    return int(sum(1 << k for k in np.flatnonzero(2 * ones > len(starts)).tolist()))


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, bits) for every document; bits is the fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regrouped(batches, "text"):
            bits = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], ["doc_id", "bits"])

    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(run, "doc_id long, bits long")


def _syndrome(vectors: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit vectors by the generator."""
    rest = vectors.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        rest ^= ((rest >> bit) & 1) * (GENERATOR << (bit - 11))
    return rest


def golay_errors() -> np.ndarray:
    """For each of the 2048 syndromes, the error patterns of at most 4 bits: one or six, filled up with -1."""
    found: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        masks = np.array([sum(1 << b for b in c) for c in combinations(range(23), weight)], np.int64)
        for mask, syndrome in zip(masks.tolist(), _syndrome(masks).tolist(), strict=True):
            found[syndrome].append(mask)
    table = np.full((2048, 6), -1, np.int64)
    for k, masks in enumerate(found):
        table[k, : len(masks)] = masks
    return table


def codeword_indices(vectors: np.ndarray, errors: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of the codewords within 4 bits of 23-bit vectors: rows of six, filled up with -1."""
    near = errors[_syndrome(vectors)]
    return np.where(near < 0, -1, (vectors[:, None] ^ near) >> 11)


def fuzzy_keys(bits: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, position in bits): every key of every fingerprint."""
    values = bits.view(np.uint64)
    near = [codeword_indices(((values >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64), errors) for at, n in SEGMENTS]
    keys, owners = [], []
    for number, (a, b) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        both = (near[a][:, :, None] >= 0) & (near[b][:, None, :] >= 0)
        joined = (number << 24) | (near[a][:, :, None] << 12) | near[b][:, None, :]
        keys.append(joined[both])
        owners.append(np.nonzero(both)[0])
    return np.concatenate(keys), np.concatenate(owners)


def keyed(distinct: DataFrame) -> DataFrame:
    """(key, bits): every fingerprint under each of its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        errors = golay_errors()
        for batch in batches:
            bits = ints(batch, "bits")
            for at in range(0, len(bits), 1000):
                keys, owners = fuzzy_keys(bits[at : at + 1000], errors)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(bits[at : at + 1000][owners])], ["key", "bits"])

    return distinct.select("bits").mapInArrow(run, "key long, bits long")


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(bits: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (at most one less than the fingerprints) that connect what links within the radius connect."""
    left, links = bits, []
    while len(left) > 1:
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            near = _apart(left, np.int64(front[-1])) <= radius
            here = front.pop()
            if near.any():
                links += [(here, int(x)) for x in left[near]]
                front += left[near].tolist()
                left = left[~near]
    return links


def bipartite_forest(one: np.ndarray, other: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links between two blocks that connect what all links between them connect."""
    links: list[tuple[int, int]] = []
    sides = [one, other]
    while len(sides[0]) and len(sides[1]):
        front, sides[0] = [(0, int(sides[0][0]))], sides[0][1:]
        while front:
            side, here = front.pop()
            near = _apart(sides[1 - side], np.int64(here)) <= radius
            links += [(here, int(x)) for x in sides[1 - side][near]]
            front += [(1 - side, int(x)) for x in sides[1 - side][near]]
            sides[1 - side] = sides[1 - side][~near]
    return links


def linked(batches: Iterator[pa.RecordBatch], radius: int, bucket: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: links (a, b, NULL), and the rows (bits, NULL, key) of keys that are too large."""
    names = ["a", "b", "key"]

    def rows(a, b, key) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(key, pa.int64())], names)

    def compared(key: np.ndarray, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole groups. Small groups by shifts over all of them; what is linked more than once, as a forest."""
        edge = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
        size = np.diff(edge)
        of = np.repeat(np.arange(len(size)), size)
        hit_a, hit_b, hit_of = [], [], []
        small = size[of] <= 32
        for shift in range(1, 32):
            near = np.flatnonzero((of[shift:] == of[:-shift]) & small[shift:])
            if not len(near):
                break
            near = near[_apart(bits[near], bits[near + shift]) <= radius]
            hit_a.append(bits[near])
            hit_b.append(bits[near + shift])
            hit_of.append(of[near])
        links: list[tuple[int, int]] = []
        if hit_of:
            groups = np.concatenate(hit_of)
            once = np.bincount(groups, minlength=len(size))[groups] == 1
            if once.any():
                yield rows(np.concatenate(hit_a)[once], np.concatenate(hit_b)[once], np.full(once.sum(), None))
            for g in np.unique(groups[~once]).tolist():
                links += forest(bits[edge[g] : edge[g + 1]], radius)
        for g in np.flatnonzero(size > 32).tolist():
            links += forest(bits[edge[g] : edge[g + 1]], radius)
        if links:
            a, b = zip(*links, strict=True)
            yield rows(a, b, [None] * len(a))

    held_key, held_bits, oversize = np.empty(0, np.int64), np.empty(0, np.int64), None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, bits = np.concatenate([held_key, ints(batch, "key")]), np.concatenate([held_bits, ints(batch, "bits")])
        tail = int(np.searchsorted(key, key[-1]))
        if oversize is not None:
            out = key == oversize
            if out.any():
                yield rows(bits[out], [None] * int(out.sum()), key[out])
            if key[-1] == oversize:
                held_key, held_bits = np.empty(0, np.int64), np.empty(0, np.int64)
                continue
            key, bits, oversize = key[~out], bits[~out], None
            tail = int(np.searchsorted(key, key[-1]))
        yield from compared(key[:tail], bits[:tail])
        held_key, held_bits = key[tail:], bits[tail:]
        if len(held_key) > bucket:
            oversize = held_key[0]
            yield rows(held_bits, [None] * len(held_bits), held_key)
            held_key, held_bits = np.empty(0, np.int64), np.empty(0, np.int64)
    if len(held_key):
        yield from compared(held_key, held_bits)


def links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all that lie within the radius (at most 4)."""
    if radius > RADIUS:
        raise ValueError("the keys find up to 4 differing bits")
    parts = partitions(distinct.sparkSession)
    sorted_keys = keyed(distinct).repartition(parts, "key").sortWithinPartitions("key", "bits")
    found = stored(sorted_keys.mapInArrow(lambda b: linked(b, radius, bucket), "a long, b long, key long"), "simhash-links")
    small = found.where("key IS NULL").select("a", "b")
    large = found.where("key IS NOT NULL").select("key", F.col("a").alias("bits"))
    if large.isEmpty():
        return small
    sizes = large.groupBy("key").agg(F.ceil(F.count("*") / bucket).cast("long").alias("blocks"))
    dealt = large.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("bits"), F.col("blocks")))
    # A row goes to the pairs (block, other) of its key: as many as its key has blocks.
    paired = dealt.select("key", "bits", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")).select(
        "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "bits"
    )

    def compare(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        bits, block = table.column("bits").to_numpy(), table.column("block").to_numpy()
        pairs = forest(bits, radius) if low == high else bipartite_forest(bits[block == low], bits[block == high], radius)
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})

    return small.unionByName(paired.groupBy("key", "low", "high").applyInArrow(compare, "a long, b long"))


def _component_of(rows: DataFrame, radius: int) -> DataFrame:
    """(b, component): every distinct fingerprint of stored rows and the fingerprint that names its component."""
    distinct = stored(rows.select("bits").distinct(), "distinct-fingerprints")
    groups = components(links(distinct, radius))
    return distinct.join(groups, distinct["bits"] == groups["node"], "left").select(F.col("bits").alias("b"), F.coalesce("component", "bits").alias("component"))


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (the smallest doc_id reachable) of each document."""
    rows = stored(fingerprints(documents, shingle), "fingerprints")
    least = rows.groupBy(F.col("bits").alias("own")).agg(F.min("doc_id").alias("least"))
    of = _component_of(rows, radius).join(least, F.col("b") == F.col("own")).select("b", "component", "least")
    smallest = of.groupBy("component").agg(F.min("least").alias("component_id"))
    met = rows.join(of.join(smallest, "component").select("b", "component_id"), F.col("bits") == F.col("b"))
    return met.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def without_copies(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component: that with the smallest doc_id (NULL last); columns stay as they are.

    Of rows that repeat this doc_id the one with the smallest hash of its text stays, of equal rows one.
    """
    mark = unused("mark", documents.columns)
    chosen_id, chosen_mark = unused("chosen_id", documents.columns), unused("chosen_mark", documents.columns)
    marked = documents.withColumn(mark, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regrouped(batches, "text"):
            bits = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(bits)], ["doc_id", "mark", "bits"])

    read = marked.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col(mark).alias("mark"))
    rows = stored(read.mapInArrow(run, "doc_id long, mark long, bits long"), "fingerprints")
    key = F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id"), F.col("mark"))
    first = rows.groupBy("bits").agg(F.min(key).alias("key")).join(_component_of(rows, radius), F.col("bits") == F.col("b")).groupBy("component").agg(F.min("key").alias("key"))
    chosen = first.select(F.col("key.doc_id").alias(chosen_id), F.col("key.mark").alias(chosen_mark))
    kept = marked.join(chosen, F.col("doc_id").eqNullSafe(F.col(chosen_id)) & (F.col(mark) == F.col(chosen_mark)), "left_semi")
    return kept.dropDuplicates(["doc_id", mark]).select(*[F.col(f"`{c}`") for c in documents.columns])


def unused(name: str, columns: list[str]) -> str:
    """The name, with as many underscores before it as make it none of the columns."""
    while name.lower() in {c.lower() for c in columns}:
        name = f"_{name}"
    return name
