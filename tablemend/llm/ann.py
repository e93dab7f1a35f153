"""Nearest neighbours by an inverted multi-index.

Vectors are cut into two halves, each quantised by its own centroids; a cell is a pair of centroids. A query visits the
cells by the sum of its halves' distances, with a heap over pairs (the multi-sequence order), until they hold the
share of all vectors that the calibration found to reach the wanted recall; what lies in them is ranked again by the
exact inner product in double precision.

Centroids are fitted on at most `FIT_ROWS` vectors drawn by a hash of the id, and the share is calibrated on the same sample
against brute force. All vectors are indexed and all queries answered. The number of vectors in each cell (at most K x K
numbers) is known to the driver. Vectors lie in tasks by their first centroid, cut into chunks of bounded size, so a
centroid or a group of copies that holds a third of all vectors is spread over tasks. Queries are dealt into blocks of about `QUERIES`, and a
chunk meets each block in a task of its own, so no task grows with the number of queries; it answers each with at most `top` rows.

Defined cases: vectors that are NULL, empty, zero, of another length than most of the sample, or with NULL or non-finite parts
take no part; so do NULL ids; repeated rows are candidates of their own (a query is never its own id's candidate) and ask
once; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablemend.llm.common import stored

CENTROIDS = 64
FIT_ROWS = 10_000
TOP = 20
RECALL = 0.97
CHUNK = 4096
#: Queries that one task holds beside a chunk, and that a chunk answers at once.
QUERIES = 8192
AT_ONCE = 512


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part, as floats if they are, else as doubles."""
    kind = embeddings.schema["embedding"].dataType.elementType.simpleString()
    e = F.col("embedding")
    read = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), e if kind == "float" else e.cast("array<double>").alias("embedding"))
    finite = F.forall(e, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return read.where(F.col("vec_id").isNotNull() & e.isNotNull() & finite & F.exists(e, lambda x: x != 0))


def _kind(vectors: DataFrame) -> str:
    return vectors.schema["embedding"].dataType.simpleString()


def k_means(points: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Centroids from the first k distinct points; empty ones stay where they are."""
    distinct = np.unique(points, axis=0)
    centroids = distinct[np.random.default_rng(0).permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        nearest = nearest_centroid(points, centroids)
        n = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, less the points' own squares, which are equal for all centroids."""
    return (centroids * centroids).sum(axis=1) - 2 * points @ centroids.T


def nearest_centroid(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return distances(points, centroids).argmin(axis=1)


@dataclass
class Index:
    """Centroids of both halves, how many vectors each cell holds, and how many a query wants to see."""

    first: np.ndarray
    second: np.ndarray
    held: np.ndarray | None = None
    wanted: int = 0

    @property
    def width(self) -> int:
        return self.first.shape[1] + self.second.shape[1]

    def halves(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return points[:, : self.first.shape[1]], points[:, self.first.shape[1] :]

    def cells(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each half."""
        a, b = self.halves(points)
        return nearest_centroid(a, self.first), nearest_centroid(b, self.second)

    def order(self, query: np.ndarray) -> Iterator[tuple[int, int]]:
        """Cells by the sum of the halves' distances: the multi-sequence order, with a heap."""
        a, b = self.halves(query[None])
        da, db = distances(a, self.first)[0], distances(b, self.second)[0]
        ia, ib = np.argsort(da, kind="stable").tolist(), np.argsort(db, kind="stable").tolist()
        sa, sb = [float(da[i]) for i in ia], [float(db[i]) for i in ib]
        # reached[r]: how far row r of the ordered pairs has gone; a pair is pushed once both its predecessors are out.
        reached = [0] * len(ia)
        heap = [(sa[0] + sb[0], 0, 0)]
        while heap:
            _, r, c = heapq.heappop(heap)
            yield ia[r], ib[c]
            reached[r] = c + 1
            if r + 1 < len(ia) and reached[r + 1] == c:
                heapq.heappush(heap, (sa[r + 1] + sb[c], r + 1, c))
            if c + 1 < len(ib) and (r == 0 or reached[r - 1] > c + 1):
                heapq.heappush(heap, (sa[r] + sb[c + 1], r, c + 1))

    def visited(self, query: np.ndarray) -> dict[int, list[int]]:
        """Second centroids to look into, by first centroid."""
        found: dict[int, list[int]] = {}
        seen = 0
        held = self.held
        for i, j in self.order(query):
            if held[i, j]:
                found.setdefault(i, []).append(j)
                seen += int(held[i, j])
                if seen >= self.wanted:
                    break
        return found


def calibrated_share(index: Index, points: np.ndarray, top: int, recall: float, queries: int = 200) -> float:
    """The share of the vectors that must be seen so that the sample's nearest are found with the wanted recall."""
    a, b = index.cells(points)
    held = np.zeros((len(index.first), len(index.second)), np.int64)
    np.add.at(held, (a, b), 1)
    needed = []
    for q in np.random.default_rng(1).permutation(len(points))[:queries]:
        score = points @ points[q]
        score[q] = -np.inf
        nearest = np.argpartition(-score, min(top, len(points) - 1) - 1)[:top]
        rank, seen = np.zeros_like(held), 0
        for i, j in index.order(points[q]):
            seen += held[i, j]
            rank[i, j] = seen
        needed += rank[a[nearest], b[nearest]].tolist()
    return float(np.quantile(needed, recall)) / len(points) if needed else 1.0


def fit(vectors: DataFrame, centroids: int = CENTROIDS, fit_rows: int = FIT_ROWS, top: int = TOP, recall: float = RECALL) -> tuple[Index, float] | None:
    """The index without its counts, and the share to see; None without vectors."""
    number = vectors.count()
    part = min(1.0, fit_rows / max(1, number))
    drawn = vectors.where(F.pmod(F.xxhash64("vec_id", F.lit("fit")), F.lit(1 << 62)) < int(part * (1 << 62)))
    # About fit_rows rows, which a bound on the parameter bounds.
    rows = drawn.collect() or vectors.limit(1).collect()
    if not rows:
        return None
    width = Counter(len(r["embedding"]) for r in rows).most_common(1)[0][0]
    points = np.array([r["embedding"] for r in sorted(rows, key=lambda r: (r["vec_id"], r["embedding"])) if len(r["embedding"]) == width])
    half = max(1, width // 2)
    index = Index(k_means(points[:, :half], centroids), k_means(points[:, half:], centroids) if width > half else np.zeros((1, 0)))
    return index, calibrated_share(index, points, top, recall) if len(points) > top else 1.0


def indexed(vectors: DataFrame, index: Index) -> DataFrame:
    """vec_id, embedding, and the cell (c1, c2) of every vector."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                c1, c2 = index.cells(matrix(batch.column(1), index.width))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(c1.astype(np.int32)), pa.array(c2.astype(np.int32))], ["vec_id", "embedding", "c1", "c2"])

    return vectors.mapInArrow(assign, f"vec_id long, embedding {_kind(vectors)}, c1 int, c2 int")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def nearest_in_chunk(queries: pa.Table, entries: pa.Table, width: int, seconds: int, top: int) -> pa.Table:
    """The best entries of a chunk for each of its queries, among the cells that the query visits."""
    points, ids, cell = matrix(entries.column("embedding"), width), entries.column("vec_id").to_numpy(), entries.column("c2").to_numpy()
    out_q, out_v, out_s = [], [], []
    for at in range(0, queries.num_rows, AT_ONCE):
        part = queries.slice(at, AT_ONCE).combine_chunks()
        q, q_ids = matrix(part.column("query"), width), part.column("query_id").to_numpy()
        visits = part.column("cells").combine_chunks()
        wanted = np.zeros((len(q), seconds), bool)
        wanted[np.repeat(np.arange(len(q)), np.diff(visits.offsets.to_numpy())), visits.flatten().to_numpy()] = True
        score = np.where(wanted[:, cell] & (q_ids[:, None] != ids[None, :]), q @ points.T, -np.inf)
        # Matrix products may round equal vectors differently: take all near the bound, and rank by exact sums.
        bound = -np.partition(-score, min(top, score.shape[1]) - 1, axis=1)[:, min(top, score.shape[1]) - 1]
        for row in range(len(q)):
            near = np.flatnonzero((score[row] >= bound[row] - 1e-9 * (1 + abs(bound[row]))) & (score[row] > -np.inf)) if np.isfinite(bound[row]) else np.flatnonzero(score[row] > -np.inf)
            exact = (points[near] * q[row]).sum(axis=1)
            order = np.lexsort((ids[near], -exact))[:top]
            out_q += [int(q_ids[row])] * len(order)
            out_v += ids[near][order].tolist()
            out_s += exact[order].tolist()
    return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_s, pa.float64())})


def search(embeddings: DataFrame, is_query: Column, top: int = TOP, centroids: int = CENTROIDS, recall: float = RECALL, fit_rows: int = FIT_ROWS, chunk: int = CHUNK, share: float | None = None, at_most: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest vectors of every row that is_query (over vec_id) holds for."""
    spark = embeddings.sparkSession
    vectors = usable(embeddings)
    fitted = fit(vectors, centroids, fit_rows, top, recall)
    columns = "query_id long, rank int, vec_id long, score double"
    if fitted is None:
        return spark.createDataFrame([], columns)
    index, needed = fitted
    width, seconds = index.width, len(index.second)
    entries = stored(indexed(vectors.where(F.size("embedding") == width), index), "ann-index")
    # At most K x K rows.
    counts = entries.groupBy("c1", "c2").count().collect()
    index.held = np.zeros((len(index.first), seconds), np.int64)
    for r in counts:
        index.held[r["c1"], r["c2"]] = r["count"]
    total = int(index.held.sum())
    index.wanted = max(4 * top, int(np.ceil((needed if share is None else share) * total)))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = matrix(batch.column(1), width)
            for at in range(0, batch.num_rows, 256):
                owners, firsts, cells = [], [], []
                for row in range(at, min(at + 256, batch.num_rows)):
                    for i, js in index.visited(q[row]).items():
                        owners.append(row)
                        firsts.append(i)
                        cells.append(js)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owners)), batch.column(1).take(pa.array(owners)), pa.array(firsts, pa.int32()), pa.array(cells, pa.list_(pa.int32()))], ["query_id", "query", "c1", "cells"])

    # A first centroid has as many chunks as keep each near the chunk size.
    chunks = F.array(*[F.lit(int(-(-n // chunk)) or 1) for n in index.held.sum(axis=1).tolist()])
    of = F.get(chunks, F.col("c1"))
    dealt = entries.withColumn("chunk", F.pmod(F.xxhash64("vec_id", "embedding"), of).cast("int"))
    asked = entries.where(is_query).select("vec_id", "embedding").distinct().repartition(max(1, min(512, total // 2000 + 1)), "vec_id").mapInArrow(route, f"query_id long, query {_kind(entries)}, c1 int, cells array<int>")
    # A query goes to every chunk of the centroids it visits, and a chunk to every block of queries.
    blocks = max(1, -(-entries.where(is_query).count() // at_most))
    spread = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0), of - 1))).withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(q: pa.Table, e: pa.Table) -> pa.Table:
        if not q.num_rows or not e.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return nearest_in_chunk(q, e, width, seconds, top)

    found = spread.groupBy("c1", "chunk", "block").cogroup(dealt.groupBy("c1", "chunk", "block")).applyInArrow(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
