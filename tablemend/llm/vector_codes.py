"""Vector codes by product quantisation, with k-means over anchors-hierarchy metric trees.

Vectors become integers and are cut into equal parts; each part position has a codebook. Vectors lie in blocks, and a block has one metric
tree a part position, built middle-out: the square root of a set's size of anchors are found, each new one being the point farthest from its
anchor, which takes over the points that are nearer to it (a point nearer to its anchor than half the way to the new one is not looked at); the
anchors are joined upwards, the pair with the smallest common ball first, and cut downwards the same way. Every ball caches the sum and the number of its parts.

A round hands the codebook down each tree. A ball inherits its parent's list of candidate entries and strikes out those that lie farther
from its centre than the nearest one by more than its diameter, as they can be nearest to none of its parts; a ball with one entry left is wholly owned and
gives its cached sum and number. Only parts in leaf balls that are not owned are compared with the entries left. All sums and squared
distances are whole numbers, so results depend neither on the blocks nor on the order of rows; ball bounds leave room for rounding.

Blocks with their trees are stored once, one row each, and read once a round; a round sends at most entries x positions sums a task
to a combined aggregation, and a codebook of entries x parts x width numbers comes to the driver. Vectors are never shuffled.

Defined cases: a vector that is NULL or holds NULL or non-finite components is left out, also one of another length than the most frequent
length that can be cut into the parts; a NULL id counts as the largest; repeated ids count as vectors of their own (in order of their
components when the first entries are taken); fewer vectors than entries make a smaller codebook; an empty table gives no rows; other columns are not read. A component
beyond 2^19 stops the job, as squared distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.llm.common import stored
from tablemend.operators.guards import fail_if
from tablemend.operators.joins import attach_groups

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors in a block, and parts in a ball that is not cut further.
BLOCK, LEAF = 1024, 12
LARGEST = 1 << 19
#: Room for rounding in ball bounds, as a share of the numbers compared and of the largest coordinate.
ROOM = 1e-9


def squares(points: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", points, points)


def lengths(points: np.ndarray) -> np.ndarray:
    return np.sqrt(squares(points))


def anchored(points: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut every group into about the square root of its size of anchors, all groups in step; points are sorted by group.

    Returns the anchor of each point, and pivot point and group of each anchor.
    """
    size = np.bincount(group, minlength=groups)
    wanted = np.ceil(np.sqrt(size)).astype(np.int64)
    first = np.cumsum(size) - size
    pivots, owners = [first], [np.arange(groups)]
    anchor, distance = group.copy(), lengths(points - points[first[group]])
    number, step = groups, 1
    while True:
        # The farthest point of each group becomes an anchor, unless all points are on their pivots.
        far = np.flatnonzero(distance == np.maximum.reduceat(distance, first)[group])
        far = far[np.concatenate([[True], group[far][1:] != group[far][:-1]])]
        far = far[(wanted[group[far]] > step) & (distance[far] > 0)]
        if not len(far):
            return anchor, np.concatenate(pivots), np.concatenate(owners)
        new = np.full(groups, -1)
        new[group[far]] = np.arange(len(far))
        pivot_points = np.concatenate(pivots)
        # Points nearer to their anchor than half its distance to the new one cannot change.
        candidates = np.flatnonzero(new[group] >= 0)
        gap = lengths(points[pivot_points[anchor[candidates]]] - points[far[new[group[candidates]]]])
        candidates = candidates[distance[candidates] > gap * (0.5 - ROOM)]
        reach = lengths(points[candidates] - points[far[new[group[candidates]]]])
        nearer = reach < distance[candidates]
        moved = candidates[nearer]
        anchor[moved], distance[moved] = number + new[group[moved]], reach[nearer]
        pivots.append(far)
        owners.append(group[far])
        number, step = number + len(far), step + 1


class Forest:
    """Metric trees, one for each set of points, as arrays over balls; `left` is -1 in a leaf.

    Each ball caches number and sum of its points; `member` lists the points of leaf ball i at start[i]:end[i].
    """

    def __init__(self, points: np.ndarray, group: np.ndarray, groups: int):
        self.points = points
        self.used = 0
        room, width = 2 * len(points), points.shape[1]
        self.left, self.right, self.start, self.end, self.count = (np.zeros(room, np.int64) for _ in range(5))
        self.centre, self.radius, self.sums = np.zeros((room, width)), np.zeros(room), np.zeros((room, width), np.int64)
        self.member = np.empty(0, np.int64)
        self.roots = self._build(np.arange(len(points)), group, groups)
        for name in ("left", "right", "start", "end", "count", "centre", "radius", "sums"):
            setattr(self, name, getattr(self, name)[: self.used])

    def _add(self, **values) -> np.ndarray:
        """New balls; what is not given is 0."""
        new = np.arange(self.used, self.used + len(values["radius"]))
        self.used += len(new)
        for name, value in values.items():
            getattr(self, name)[new] = value
        return new

    def _build(self, rows: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
        """The root balls of groups of points: anchors, cut further where large, then joined pair by pair."""
        points = self.points[rows].astype(np.float64)
        anchor, pivot, owner = anchored(points, group, groups)
        reach = np.zeros(len(pivot))
        np.maximum.at(reach, anchor, lengths(points - points[pivot[anchor]]))
        size = np.bincount(anchor, minlength=len(pivot))
        node = np.full(len(pivot), -1)
        large = (size > LEAF) & (reach > 0) & (np.bincount(owner, minlength=groups)[owner] > 1)
        inside = large[anchor]
        if inside.any():
            number = np.cumsum(large) - 1
            deeper = np.flatnonzero(inside)
            deeper = deeper[np.argsort(anchor[deeper], kind="stable")]
            node[large] = self._build(rows[deeper], number[anchor[deeper]], int(large.sum()))
        small = np.flatnonzero(~large)
        order = np.flatnonzero(~inside)
        order = order[np.argsort(anchor[order], kind="stable")]
        end = len(self.member) + np.cumsum(size[small])
        self.member = np.concatenate([self.member, rows[order]])
        sums = np.zeros((len(pivot), points.shape[1]), np.int64)
        np.add.at(sums, anchor, self.points[rows])
        node[small] = self._add(
            centre=points[pivot[small]], radius=reach[small] * (1 + ROOM), left=-1, right=-1, start=end - size[small], end=end, count=size[small], sums=sums[small]
        )
        return self._joined(node, owner, groups)

    def _joined(self, node: np.ndarray, owner: np.ndarray, groups: int) -> np.ndarray:
        """Join the balls of each group until one is left, the pair with the smallest common ball first; all groups in step."""
        order = np.argsort(owner, kind="stable")
        size = np.bincount(owner, minlength=groups)
        slot = np.arange(len(order)) - np.repeat(np.cumsum(size) - size, size)
        table = np.full((groups, size.max()), -1)
        table[owner[order], slot] = node[order]
        width = table.shape[1]
        common = np.full((groups, width, width), np.inf)
        for i in range(width):
            self._measure(common, table, np.arange(groups), np.full(groups, i))
        while True:
            flat = common.reshape(groups, -1)
            best = flat.argmin(axis=1)
            open_ = np.flatnonzero(np.isfinite(flat[np.arange(groups), best]))
            if not len(open_):
                return table[np.arange(groups), (table >= 0).argmax(axis=1)]
            i, j = best[open_] // width, best[open_] % width
            a, b = table[open_, i], table[open_, j]
            centre, radius = self._common(a, b)
            table[open_, i] = self._add(centre=centre, radius=radius, left=a, right=b, count=self.count[a] + self.count[b], sums=self.sums[a] + self.sums[b])
            table[open_, j] = -1
            common[open_, j, :] = common[open_, :, j] = np.inf
            self._measure(common, table, open_, i)

    def _common(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The smallest ball around pairs of balls."""
        way = self.centre[b] - self.centre[a]
        gap = lengths(way)
        radius = np.maximum(np.maximum(self.radius[a], self.radius[b]), (gap + self.radius[a] + self.radius[b]) / 2)
        share = np.clip((radius - self.radius[a]) / np.where(gap > 0, gap, 1), 0, 1)
        # A ball that holds the other stays as it is.
        share = np.where(radius <= self.radius[a], 0.0, np.where(radius <= self.radius[b], 1.0, share))
        return self.centre[a] + way * share[:, None], radius * (1 + ROOM)

    def _measure(self, common: np.ndarray, table: np.ndarray, groups: np.ndarray, i: np.ndarray) -> None:
        """Radius of the common ball of slot i with every other slot of its group."""
        own, other = table[groups, i], table[groups]
        gap = np.sqrt(((self.centre[other] - self.centre[own][:, None, :]) ** 2).sum(axis=2))
        a, b = self.radius[own][:, None], self.radius[other]
        found = np.maximum(np.maximum(a, b), (gap + a + b) / 2)
        found[(other < 0) | (own < 0)[:, None] | (np.arange(table.shape[1])[None, :] == i[:, None])] = np.inf
        common[groups, i, :] = common[groups, :, i] = found


def spread_lists(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists of these sizes laid end to end: the list and the place in it of every element."""
    of = np.repeat(np.arange(len(size)), size)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)


class Walk:
    """One codebook handed down the trees of a block: balls wholly owned, and single points with their entry."""

    def __init__(self, tree: dict[str, np.ndarray], books: np.ndarray):
        self.tree = tree
        self.books = books
        entries = books.shape[1]
        scale = ROOM * (1 + max(np.abs(books).max(), np.abs(tree["centre"]).max()))
        ball, part = tree["roots"], np.arange(len(books))
        lists = np.tile(np.arange(entries), len(books))
        size = np.full(len(books), entries)
        owned, points = [], []
        while len(ball):
            of, _ = spread_lists(size)
            gap = lengths(self.books[part[of], lists] - tree["centre"][ball[of]])
            nearest = np.minimum.reduceat(gap, np.cumsum(size) - size)
            room = (nearest + 2 * tree["radius"][ball]) * (1 + ROOM) + scale
            keep = gap <= room[of]
            lists, size = lists[keep], np.bincount(of[keep], minlength=len(ball))
            starts = np.cumsum(size) - size
            sole = size == 1
            owned.append((ball[sole], part[sole], lists[starts[sole]]))
            leaf = ~sole & (tree["left"][ball] < 0)
            points.append(self._points(ball[leaf], part[leaf], starts[leaf], size[leaf], lists))
            inner = np.flatnonzero(~sole & ~leaf)
            # Both children inherit the list that is left.
            twice = np.concatenate([inner, inner])
            of, place = spread_lists(size[twice])
            lists = lists[starts[twice][of] + place]
            ball, part, size = np.concatenate([tree["left"][ball[inner]], tree["right"][ball[inner]]]), part[twice], size[twice]
        self.owned = [np.concatenate(x) for x in zip(*owned, strict=True)]
        self.single = [np.concatenate(x) for x in zip(*points, strict=True)]

    def _points(self, ball, part, starts, size, lists) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(point, part, entry) of the points of leaf balls, compared with the entries left; ties go to the lower entry."""
        held = self.tree["end"][ball] - self.tree["start"][ball]
        leaf, place = spread_lists(held)
        point = self.tree["member"][self.tree["start"][ball][leaf] + place]
        of, place = spread_lists(size[leaf])
        entry = lists[starts[leaf][of] + place]
        if not len(point):
            return point, part[leaf], point
        squared = squares(self.books[part[leaf][of], entry] - self.tree["points"][point[of]])
        first = np.cumsum(size[leaf]) - size[leaf]
        best = np.minimum.reduceat(squared, first)
        lowest = np.minimum.reduceat(np.where(squared == best[of], entry, np.iinfo(np.int64).max), first)
        return point, part[leaf], lowest

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        """Number and sums by part and entry: cached ones of owned balls, and single points."""
        parts, entries, width = self.books.shape
        number, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        ball, part, entry = self.owned
        np.add.at(number, part * entries + entry, self.tree["count"][ball])
        np.add.at(sums, part * entries + entry, self.tree["sums"][ball])
        point, part, entry = self.single
        np.add.at(number, part * entries + entry, 1)
        np.add.at(sums, part * entries + entry, self.tree["points"][point])
        return number, sums

    def entries(self) -> np.ndarray:
        """The entry of every point: an owned ball's for all below it."""
        found = np.empty(len(self.tree["points"]), np.int64)
        ball, _, entry = self.owned
        while len(ball):
            leaf = self.tree["left"][ball] < 0
            of, place = spread_lists((self.tree["end"] - self.tree["start"])[ball[leaf]])
            found[self.tree["member"][self.tree["start"][ball[leaf]][of] + place]] = entry[leaf][of]
            inner = ball[~leaf]
            ball, entry = np.concatenate([self.tree["left"][inner], self.tree["right"][inner]]), np.tile(entry[~leaf], 2)
        point, _, entry = self.single
        found[point] = entry
        return found


#: What a block row holds of its trees, as arrays laid end to end: numbers of balls and points are small, and so are components.
_TREE = {"roots": np.int32, "left": np.int32, "right": np.int32, "start": np.int32, "end": np.int32, "member": np.int32, "count": np.int32, "sums": np.int64, "centre": np.float64, "radius": np.float64}
_BLOCK = "ids array<long>, points binary, " + ", ".join(f"{name} binary" for name in _TREE)


def usable(embeddings: DataFrame) -> Column:
    """Is the vector there and all its components finite? Never NULL."""
    return F.coalesce(F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))), F.lit(False))


def whole_numbers(embeddings: DataFrame, parts: int) -> DataFrame | None:
    """vec_id, label, embedding as integers of the vectors that take part; None without any."""
    kept = embeddings.where(usable(embeddings)).select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    sizes = kept.groupBy(F.size("embedding").alias("width")).count().where((F.col("width") > 0) & (F.col("width") % parts == 0))
    most = sizes.orderBy(F.col("count").desc(), F.col("width").desc()).first()
    if most is None:
        return None
    kept = kept.where(F.size("embedding") == most["width"])
    kept = kept.where(fail_if(F.exists("embedding", lambda x: F.abs(x) > LARGEST), f"a component is beyond {LARGEST}"))
    return kept.withColumn("embedding", F.transform("embedding", lambda x: F.floor(x * SCALE)))


def blocks(vectors: DataFrame, parts: int, block: int) -> DataFrame:
    """Blocks of vectors with their ids, labels and trees, one row each, stored."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                column = part.column(2)
                numbers = column.flatten().to_numpy().reshape(part.num_rows, -1)
                yield block_row(part.column(0), part.column(1), numbers, parts)

    label = vectors.schema["label"].dataType.simpleString()
    return stored(vectors.mapInArrow(build, f"labels array<{label}>, {_BLOCK}"), "vector-blocks")


def block_row(ids: pa.Array, labels: pa.Array, numbers: np.ndarray, parts: int) -> pa.RecordBatch:
    """One row: the vectors part by part, and a tree for each part position."""
    n = len(numbers)
    points = np.ascontiguousarray(numbers.reshape(n, parts, -1).transpose(1, 0, 2)).reshape(parts * n, -1)
    forest = Forest(points, np.repeat(np.arange(parts), n), parts)
    lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), c) for c in (labels, ids)]
    held = [pa.array([getattr(forest, name).astype(kind).tobytes()], pa.binary()) for name, kind in _TREE.items()]
    return pa.RecordBatch.from_arrays([*lists, pa.array([points.astype(np.int32).tobytes()], pa.binary()), *held], ["labels", "ids", "points", *_TREE])


def trees(batch: pa.RecordBatch, width: int) -> Iterator[dict[str, np.ndarray]]:
    """The trees of each block row of a batch."""
    names = batch.schema.names
    for row in range(batch.num_rows):
        tree = {name: np.frombuffer(batch.column(names.index(name))[row].as_buffer(), kind) for name, kind in _TREE.items()}
        tree["points"] = np.frombuffer(batch.column(names.index("points"))[row].as_buffer(), np.int32)
        for name in ("points", "sums", "centre"):
            tree[name] = tree[name].reshape(-1, width)
        yield tree


def first_books(vectors: DataFrame, parts: int, entries: int) -> np.ndarray:
    """parts x entries x width: the parts of the vectors with the smallest ids."""
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    whole = np.array([r["embedding"] for r in rows], np.int64)
    return np.ascontiguousarray(whole.reshape(len(rows), parts, -1).transpose(1, 0, 2))


def improved(found: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all blocks."""
    parts, entries, width = books.shape

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        for batch in batches:
            for tree in trees(batch, width):
                n, s = Walk(tree, books).totals()
                number, sums = number + n, sums + s
        slot = np.flatnonzero(number)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(number[slot]), *(pa.array(sums[slot, d]) for d in range(width))], ["slot", "number", *(f"s{d}" for d in range(width))])

    told = found.select("points", *_TREE).mapInArrow(count, "slot long, number long, " + ", ".join(f"s{d} long" for d in range(width)))
    rows = told.groupBy("slot").agg(F.sum("number").alias("number"), *[F.sum(f"s{d}").alias(f"s{d}") for d in range(width)]).collect()
    new = books.reshape(parts * entries, width).copy()
    for r in rows:
        new[r["slot"]] = [r[f"s{d}"] // r["number"] for d in range(width)]
    return new.reshape(books.shape)


def fitted(found: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    for _ in range(rounds):
        books = improved(found, books)
    return books


def encoded(found: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, entries (one number a part position), error of every vector."""
    parts, _, width = books.shape
    label = found.schema["labels"].dataType.elementType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, tree in enumerate(trees(batch, width)):
                entry = Walk(tree, books).entries().reshape(parts, -1)
                gap = tree["points"].reshape(parts, -1, width) - books[np.arange(parts)[:, None], entry]
                codes = pa.ListArray.from_arrays(pa.array(np.arange(0, entry.size + 1, parts), pa.int32()), pa.array(entry.T.ravel().astype(np.int32)))
                # The block's row lists hold all of its vectors.
                ids, labels = (batch.column(batch.schema.get_field_index(c)).slice(row, 1).flatten() for c in ("ids", "labels"))
                yield pa.RecordBatch.from_arrays([ids, labels, codes, pa.array((gap * gap).sum(axis=(0, 2)))], ["vec_id", "label", "entries", "error"])

    return found.mapInArrow(assign, f"vec_id long, label {label}, entries array<int>, error long")


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK) -> tuple[DataFrame, np.ndarray] | None:
    """(vec_id, label, entries, error) of all vectors, and the codebooks; None without vectors."""
    vectors = whole_numbers(embeddings, parts)
    if vectors is None:
        return None
    found = blocks(vectors, parts, block)
    books = fitted(found, first_books(vectors, parts, entries), rounds)
    return encoded(found, books), books


def digests(embeddings: DataFrame, **how: int) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    told = compressed(embeddings, **how)
    if told is None:
        return embeddings.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    codes, books = told
    hexed = F.array_join(F.transform("entries", lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")
    rows = attach_groups(codes.select("vec_id", "label", hexed.alias("code"), "error"), ["label"], {"label_error": F.sum("error")})
    return rows.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
