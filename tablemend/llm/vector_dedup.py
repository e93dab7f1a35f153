"""Near-duplicate vectors by cross-polytope hashing.

A vector is turned by fast Hadamard rotations (three rounds of random signs and a Walsh-Hadamard transform); its hash is the
vertex of the cross-polytope, plus or minus a unit vector, that lies nearest. A key joins the hashes of several rotations, the
label and the vector's length; a vector is at home in one bucket of each table and also visits the next best ones (multiprobe).
Two vectors are a candidate pair if one is at home in a bucket in which the other is at home or visits; every candidate
is verified by its cosine in double precision.

Equal vectors of a label are one class from the start, with their number. Buckets name a leader, the smallest class at home; the
buckets of one leader are one group, so a cluster's many common buckets shrink to few groups, and a class's vector travels once a group.
Groups of more than `BLOCK` classes are cut into blocks and compared in pairs of blocks, one task each. A pair is counted in the
smallest of its common groups only; a task gives one row a class (links and a representative), never pairs.

Hot buckets: a sample of the classes tells which keys hold more than `hot_rows`; their rows get the leader at once and stay spread.
All other buckets pass their task as a sorted stream of (key, class) numbers. Counting the links of one dense group is quadratic in its
distinct vectors, as every one of its links is looked at.

Defined cases: a vector that is NULL, empty, zero or holds NULL or non-finite components, a NULL label or a NULL id link with
nothing; vectors of unlike length do not link; repeated rows are vectors of their own and link with each other; an empty table gives no row;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.llm.common import components, partitions, stored
from tablemend.operators.joins import attach_groups, left_join

COSINE = 0.98
#: At a cosine of just 0.98 a table brings a pair together in about four cases of five, so six tables miss it once in some 15,000.
TABLES, ROTATIONS, PROBES, BEST = 6, 4, 6, 3
BLOCK = 2048
#: Smaller common groups that a matrix of marks holds at once.
SLAB = 256
#: Keys with more rows than this, as far as a sample of one class in SAMPLED tells, are not brought together.
HOT_ROWS, SAMPLED, HOT_KEYS = 1_000_000, 16, 10_000


@cache
def signs(width: int, tables: int, rotations: int) -> np.ndarray:
    """Random signs of every round, rotation and table; the same on every machine."""
    return np.random.default_rng(width).choice(np.array([-1.0, 1.0]), size=(3, tables * rotations, width))


def rotated(vectors: np.ndarray, tables: int, rotations: int) -> np.ndarray:
    """rows x (tables * rotations) x width: the vectors after three rounds of signs and Walsh-Hadamard transform."""
    width = 1 << (vectors.shape[1] - 1).bit_length()
    out = np.zeros((len(vectors), tables * rotations, width))
    out[:, :, : vectors.shape[1]] = vectors[:, None, :]
    for flips in signs(width, tables, rotations):
        out *= flips
        half = 1
        while half < width:
            pairs = out.reshape(len(vectors), tables * rotations, -1, 2, half)
            low = pairs[..., 0, :].copy()
            pairs[..., 0, :] += pairs[..., 1, :]
            np.subtract(low, pairs[..., 1, :], out=pairs[..., 1, :])
            half *= 2
        out /= np.sqrt(width)
    return out


def bucket_codes(vectors: np.ndarray, tables: int, rotations: int, probes: int) -> np.ndarray:
    """rows x tables x (1 + probes): the home bucket of each table, then the next best ones."""
    turned = rotated(vectors, tables, rotations)
    size = np.abs(turned)
    best = min(BEST, size.shape[2])
    near = np.argsort(-size, axis=2, kind="stable")[:, :, :best] if size.shape[2] <= 8 else np.argpartition(-size, best, axis=2)[:, :, :best]
    reach = np.take_along_axis(size, near, 2)
    order = np.argsort(-reach, axis=2, kind="stable")
    near, reach = np.take_along_axis(near, order, 2), np.take_along_axis(reach, order, 2)
    vertex = 2 * near + (np.take_along_axis(turned, near, 2) < 0)
    vertex = vertex.reshape(len(vectors), tables, rotations, best)
    # What a vertex but the nearest costs: how much farther it lies.
    cost = ((reach[:, :, :1] - reach) ** 2).reshape(vertex.shape)
    choices = np.array(list(product(range(best), repeat=rotations)))
    code, total = 0, 0
    for r in range(rotations):
        code = code * (2 * size.shape[2]) + vertex[:, :, r, choices[:, r]]
        total = total + cost[:, :, r, choices[:, r]]
    return np.take_along_axis(code, np.argsort(total, axis=2, kind="stable")[:, :, : 1 + probes], 2)


def mixed(*parts) -> np.ndarray:
    """One 64-bit key from integers, by multiplication and shifts."""
    out = np.uint64(0x9E3779B97F4A7C15)
    for p in parts:
        out = (out ^ np.asarray(p, np.int64).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        out = out ^ (out >> np.uint64(32))
    return out.astype(np.int64)


def classes(embeddings: DataFrame) -> DataFrame:
    """cls, label, embedding, low_id, n: the distinct vectors of each label that take part."""
    number = embeddings.count()
    counted = linkable(embeddings).groupBy("label", "embedding").agg(F.min("vec_id").alias("low_id"), F.count(F.lit(1)).alias("n"))
    # Hashing costs much more than reading: some thousand vectors a task, up to ten thousand tasks.
    spread = counted.repartition(max(partitions(embeddings.sparkSession), min(10_000, number // 8192 + 1)))
    return stored(spread.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")


def is_linkable() -> Column:
    """Does a row have an id, a label and a finite vector that is not zero? Never NULL."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists(e, lambda x: x != 0)
    return F.coalesce(whole, F.lit(False))


def linkable(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, embedding (floats if they are, else doubles) of the rows that can link, without negative zeros."""
    kind = "float" if embeddings.schema["embedding"].dataType.elementType.simpleString() == "float" else "double"
    plain = F.transform("embedding", lambda x: x.cast(kind) + F.lit(0).cast(kind))
    return embeddings.where(is_linkable()).select(F.col("vec_id").cast("long").alias("vec_id"), "label", plain.alias("embedding"))


def by_width(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, their vectors as unit rows) for each length of a list column without NULLs."""
    bounds = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    size = np.diff(bounds)
    for width in np.unique(size):
        rows = np.flatnonzero(size == width)
        found = values[bounds[rows][:, None] + np.arange(width)].astype(np.float64)
        # Divide by the largest part first, so that squares neither overflow nor vanish.
        found /= np.abs(found).max(axis=1, keepdims=True)
        yield rows, found / np.sqrt((found * found).sum(axis=1, keepdims=True))


def bucket_rows(found: DataFrame, hot: dict[int, int], tables: int, rotations: int, probes: int) -> DataFrame:
    """key, home, cls, leader of every bucket that a class is at home in or visits; hot keys are replaced by ones that spread."""
    hot_keys = np.array(sorted(hot), np.int64)
    hot_leaders = np.array([hot[k] for k in hot_keys.tolist()], np.int64)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, labels = part.column(0).to_numpy(), part.column(1).to_numpy()
                for rows, vectors in by_width(part.column(2)):
                    code = bucket_codes(vectors, tables, rotations, probes)
                    keys = mixed(labels[rows][:, None, None], np.int64(vectors.shape[1]), np.arange(tables)[None, :, None], code)
                    home = np.broadcast_to(np.arange(code.shape[2]) == 0, code.shape)
                    owner = np.broadcast_to(ids[rows][:, None, None], code.shape)
                    key, own = keys.ravel(), owner.ravel()
                    leader = np.full(key.size, -1)
                    if len(hot_keys):
                        place = np.minimum(np.searchsorted(hot_keys, key), len(hot_keys) - 1)
                        is_hot = hot_keys[place] == key
                        leader[is_hot] = hot_leaders[place[is_hot]]
                        key = np.where(is_hot, mixed(own, key), key)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(~home.ravel()), pa.array(own), pa.array(leader)], ["key", "visits", "cls", "leader"])

    label = F.xxhash64("label").alias("label")
    return found.select("cls", label, "embedding").mapInArrow(hashed, "key long, visits boolean, cls long, leader long")


def hot_leaders(found: DataFrame, hot_rows: int, sampled: int, **how: int) -> dict[int, int]:
    """Key -> leader of the keys that seem to hold more than so many rows; at most HOT_KEYS."""
    drawn = found.where(F.pmod(F.xxhash64("cls", F.lit("sample")), F.lit(sampled)) == 0)
    counted = bucket_rows(drawn, {}, **how).groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct("visits", "cls")).alias("first"))
    large = counted.where(F.col("rows") * sampled > hot_rows).orderBy(F.col("rows").desc(), "key").limit(HOT_KEYS)
    return {r["key"]: r["first"]["cls"] for r in large.collect()}


def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(leader, cls) from rows sorted by key, those at home first: a bucket's first row leads if it is at home."""
    last, leads = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, visits, cls, leader = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        given = leader >= 0
        first = np.concatenate([[last is None or key[0] != last], key[1:] != key[:-1]])
        run = np.cumsum(first)
        # The leader of the bucket that was open when the batch began comes before those that begin in it.
        heads = np.concatenate([[-1 if leads is None else leads], np.where(visits[first], -1, cls[first])])
        follows = ~given & ~first & (heads[run] >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([leader[given], heads[run[follows]]])), pa.array(np.concatenate([cls[given], cls[follows]]))], ["leader", "cls"])
        last, leads = key[-1], heads[-1]


def linked(unit: np.ndarray, block: np.ndarray, cross: bool, weight: np.ndarray, common: list[tuple[np.ndarray, np.ndarray]], cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each row of a group, weighted by the class sizes, and the row that stands for its local component.

    In a pair of blocks only pairs across count. `common` lists, in slabs, (row, column) for each smaller group, a column, that several
    rows are in too: pairs with a smaller common group are counted there.
    """
    n = len(unit)
    links, root = np.zeros(n, np.int64), np.arange(n)
    for at in range(0, n, 512):
        near = unit[at : at + 512] @ unit.T >= cosine
        rows = np.arange(at, min(at + 512, n))
        near[rows - at, rows] = False
        if cross:
            near &= block[rows][:, None] != block[None, :]
        # Any link joins components; only links without a smaller common group are counted.
        for r in np.flatnonzero(near.any(axis=1)):
            joined = np.unique(root[np.append(np.flatnonzero(near[r]), at + r)])
            if len(joined) > 1:
                root[np.isin(root, joined)] = joined[0]
        for row, column in common if near.any() else ():
            marks = np.zeros((n, SLAB), np.float32)
            marks[row, column] = 1
            near &= (marks[rows] @ marks.T) == 0
        links[rows] = near @ weight
    return links, root


def common_groups(of: np.ndarray, names: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, column) of the names that several rows hold, in slabs of SLAB columns."""
    _, place, times = np.unique(names, return_inverse=True, return_counts=True)
    several = np.cumsum(times > 1) - 1
    keep = (times > 1)[place]
    row, column = of[keep], several[place[keep]]
    return [(row[column // SLAB == k], column[column // SLAB == k] % SLAB) for k in np.unique(column // SLAB)]


def compared(cosine: float):
    """Rows sorted by group and pair of blocks -> (cls, root, links), a row for each class of a group that has a link there."""

    def group(table: pa.Table) -> pa.RecordBatch | None:
        column = table.column("embedding").combine_chunks()
        (_, unit), = by_width(column)
        cls, weight = table.column("cls").to_numpy(), table.column("n").to_numpy()
        lists = table.column("leaders").combine_chunks()
        of = np.repeat(np.arange(len(cls)), np.diff(lists.offsets.to_numpy()))
        values = lists.flatten().to_numpy()
        smaller = values < table.column("leader")[0].as_py()
        cross = table.column("low")[0].as_py() != table.column("high")[0].as_py()
        links, root = linked(unit, table.column("block").to_numpy(), cross, weight, common_groups(of[smaller], values[smaller]), cosine)
        told = np.flatnonzero((links > 0) | (root != np.arange(len(cls))))
        return pa.RecordBatch.from_arrays([pa.array(cls[told]), pa.array(cls[root[told]]), pa.array(links[told])], ["cls", "root", "links"]) if len(told) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*open_rows, batch])
            names = np.stack([table.column(c).to_numpy() for c in ("leader", "low", "high")])
            starts = np.flatnonzero(np.concatenate([[True], (names[:, 1:] != names[:, :-1]).any(axis=0)]))
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                if (found := group(table.slice(a, b - a))) is not None:
                    yield found
            open_rows = table.slice(starts[-1]).to_batches()
        if open_rows and (found := group(pa.Table.from_batches(open_rows))) is not None:
            yield found

    return run


def class_links(found: DataFrame, cosine: float, block: int, hot_rows: int, sampled: int, **how: int) -> DataFrame:
    """(cls, root, links), stored: several rows a class may have, one for each of its groups."""
    keyed = bucket_rows(found, hot_leaders(found, hot_rows, sampled, **how), **how)
    sorted_rows = keyed.repartition("key").sortWithinPartitions("key", "visits", "cls")
    follow = sorted_rows.mapInArrow(led, "leader long, cls long").distinct()
    groups = stored(follow.union(follow.select("leader", F.col("leader").alias("cls"))).distinct(), "vector-groups")
    # A class has at most as many groups as it is in buckets.
    leaders = groups.groupBy("cls").agg(F.collect_set("leader").alias("leaders"))
    vectors = found.select("cls", "embedding", "n").join(leaders, "cls")
    parts = F.ceil(F.col("size") / block).cast("int")
    sized = attach_groups(groups, ["leader"], {"size": F.count(F.lit(1))}).where("size > 1")
    placed = sized.withColumn("block", F.pmod(F.xxhash64("cls"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    placed = placed.select("cls", "leader", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    rows = placed.join(vectors, "cls").repartition("leader", "low", "high").sortWithinPartitions("leader", "low", "high")
    rows = rows.select("leader", "low", "high", "block", "cls", "n", "leaders", "embedding")
    return stored(rows.mapInArrow(compared(cosine), "cls long, root long, links long"), "vector-links")


def near_duplicates(
    embeddings: DataFrame, cosine: float = COSINE, tables: int = TABLES, rotations: int = ROTATIONS, probes: int = PROBES,
    block: int = BLOCK, hot_rows: int = HOT_ROWS, sampled: int = SAMPLED,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    found = classes(embeddings)
    links = class_links(found, cosine, block, hot_rows, sampled, tables=tables, rotations=rotations, probes=probes)
    grouped = components(links.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    direct = links.groupBy("cls").agg(F.sum("links").alias("links"))
    told = found.join(direct, "cls", "left").join(grouped.withColumnRenamed("node", "cls"), "cls", "left").where("n > 1 OR component IS NOT NULL")
    told = attach_groups(told.withColumn("component", F.coalesce("component", "cls")), ["component"], {"component_id": F.min("low_id")})
    names = [F.xxhash64("label", "embedding").alias("__h1"), F.xxhash64(F.lit(1), "label", "embedding").alias("__h2")]
    told = told.select(*names, (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")

    able = linkable(embeddings).select("vec_id", *names)
    joined = left_join(able, told, ["__h1", "__h2"], right_unique=True)
    id_ = F.col("vec_id")
    linked_rows = joined.select(id_, F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", id_).alias("component_id"))
    alone = embeddings.where(~is_linkable()).select(id_.cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), id_.cast("long").alias("component_id"))
    return linked_rows.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
