"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into two halves and each half is quantised to the nearest of
its own centroids; a pair of centroids is a cell, and every vector is listed in
its cell. A query sorts the centroids of either half by distance and walks the
pairs by summed distance with a heap, cell by cell, until the cells hold enough
entries; all entries of the cells walked are ranked by exact distance.

The lists lie in blocks, small cells together and large ones dealt by id over
several, and a query is sent to the blocks of the cells that it walked only.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import gather, staged

CENTROIDS = 64  # of each half: 4096 cells
SAMPLE = 20_000  # vectors that the centroids are fitted on, at most
BLOCK = 4_000  # vectors of a block
QUERY_BLOCK = 20_000  # queries that one task takes


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec as array<double>) of the vectors that take part."""
    vec = F.col("vec")
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
            .where(F.col("vec_id").isNotNull() & vec.isNotNull() & (F.size(vec) > 0))
            .where(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
            .where(F.exists(vec, lambda x: x != 0)))


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 20) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centroids = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = nearest(x, centroids)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return squared(x, centroids).argmin(1)


class Index:
    """Two codebooks (bounded by CENTROIDS) and the number of vectors of each cell."""

    def __init__(self, books: list[np.ndarray], sizes: dict[int, int]):
        self.books, self.sizes = books, sizes
        self.half = books[0].shape[1]

    @staticmethod
    def fit(sample: np.ndarray, centroids: int) -> list[np.ndarray]:
        half = max(1, sample.shape[1] // 2)
        return [kmeans(h, centroids, i) for i, h in enumerate((sample[:, :half], sample[:, half:]))]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, :self.half], x[:, self.half:]

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances to the centroids of either half."""
        return tuple(squared(h, book) for h, book in zip(self.halves(x), self.books))

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = (d.argmin(1) for d in self.distances(x))
        return a * len(self.books[1]) + b

    def reach(self, da: np.ndarray, db: np.ndarray, enough: int) -> float:
        """Walk the centroid pairs by summed distance (multi-sequence, with a heap) until their
        cells hold ``enough`` vectors; the summed distance of the last pair."""
        oa, ob = np.argsort(da), np.argsort(db)
        a, b = da[oa].tolist(), db[ob].tolist()
        heap, pushed, found, far = [(a[0] + b[0], 0, 0)], {(0, 0)}, 0, np.inf
        while heap and found < enough:
            far, i, j = heapq.heappop(heap)
            found += self.sizes.get(int(oa[i]) * len(b) + int(ob[j]), 0)
            for p, q in ((i + 1, j), (i, j + 1)):
                if p < len(a) and q < len(b) and (p, q) not in pushed:
                    pushed.add((p, q))
                    heapq.heappush(heap, (a[p] + b[q], p, q))
        return far * (1 + 1e-9) if found >= enough else np.inf  # rounding must not lose the last pair


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def packed(df: DataFrame, dim: int) -> DataFrame:
    """(vec_id, vec as bytes) of the vectors of the index's dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array([v.tobytes() for v in flat], pa.binary())],
                                             names=["vec_id", "vec"])
    return df.where(F.size("vec") == dim).mapInArrow(run, "vec_id long, vec binary")


def blocks_of(sizes: dict[int, int], cells: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The first block of each cell's list and in how many blocks it lies: neighbouring cells share a block until
    it is full, a cell larger than a block has as many of its own as it needs."""
    first, many, at, room = np.zeros(cells, np.int64), np.ones(cells, np.int64), 0, block
    for c in range(cells):
        n = sizes.get(c, 0)
        if n > room and room < block:
            at, room = at + 1, block
        first[c], many[c] = at, max(1, -(-n // block))
        if many[c] > 1:
            at, room = at + int(many[c]), block
        else:
            room -= n
    return first, many


def search(df: DataFrame, k: int = 10, query_every: int = 100, candidates: float = 0.6,
           id_col: str = "vec_id", vec_col: str = "embedding", centroids: int = CENTROIDS) -> DataFrame:
    """The ``k`` nearest other vectors of each vector whose id is divisible by ``query_every``.

    Every vector is indexed; the codebooks are fitted on at most SAMPLE vectors,
    chosen by a hash of the id. A query looks at cells that hold the share
    ``candidates`` of all vectors, and k + 1 vectors at least. Vectors that are null,
    empty, all zero, of another dimension than the most frequent one of the
    sample, or hold null or non-finite values take no part; neither do rows
    without id. Equal vectors are ranked by id; a repeated id's rows are
    candidates each. An empty table gives no rows; other columns are ignored.

    Returns query_id, rank (from 1), vec_id, score (Euclidean distance in double precision).
    """
    spark = df.sparkSession
    rows = usable(df, id_col, vec_col)
    ddl = "query_id long, rank int, vec_id long, score double"
    sample = [r["vec"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()]
    if not sample:
        return spark.createDataFrame([], ddl)
    dims = np.bincount([len(v) for v in sample])
    dim = int(dims.argmax())
    books = spark.sparkContext.broadcast(Index.fit(np.array([v for v in sample if len(v) == dim]), centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cells = Index(books.value, {}).cells(matrix(b.column("vec"), dim))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells.astype(np.int32))],
                                                 names=["vec_id", "vec", "cell"])

    listed = staged(packed(rows, dim).mapInArrow(assign, "vec_id long, vec binary, cell int"), "multi-index")
    sizes = {r["cell"]: r["count"] for r in listed.groupBy("cell").count().collect()}  # CENTROIDS**2 at most
    total = sum(sizes.values())
    enough = max(k + 1, int(np.ceil(candidates * total)))
    lots = -(-total // (query_every * QUERY_BLOCK))
    walker = spark.sparkContext.broadcast((books.value, sizes))
    lists = spark.sparkContext.broadcast(blocks_of(sizes, len(books.value[0]) * len(books.value[1]), BLOCK))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, many = lists.value
        for b in batches:
            cell = b.column("cell").to_numpy()
            spread = (b.column("vec_id").to_numpy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            block = first[cell] + (spread.astype(np.int64) % many[cell])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(block)], names=["vec_id", "vec", "cell", "block"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (first, many) = Index(*walker.value), lists.value
        listed = np.zeros(len(first), bool)
        listed[list(own.sizes)] = True
        for b in batches:
            if b.num_rows:
                to = []
                reach = []
                for x, y in zip(*own.distances(matrix(b.column("vec"), dim))):
                    reach.append(own.reach(x, y, enough))
                    walked = np.flatnonzero(((x[:, None] + y).ravel() <= reach[-1]) & listed)
                    to.append(np.unique(gather(first[walked], many[walked])))
                n = [len(t) for t in to]
                yield pa.RecordBatch.from_arrays(
                    [*b.take(pa.array(np.repeat(np.arange(b.num_rows), n))).columns,
                     pa.array(np.repeat(np.array(reach), n)), pa.array(np.concatenate(to).astype(np.int64))],
                    names=["query_id", "query", "reach", "block"])

    def rank(queries: pa.Table, entries: pa.Table) -> pa.Table:
        own, out = Index(*walker.value), [[], [], []]
        if len(queries) and len(entries):
            ids, x = entries.column("vec_id").to_numpy(), matrix(entries.column("vec"), dim)
            ca, cb = np.divmod(entries.column("cell").to_numpy(), len(own.books[1]))
            asked = matrix(queries.column("query"), dim)
            for q, v, reach, da, db in zip(queries.column("query_id").to_pylist(), asked,
                                           queries.column("reach").to_pylist(), *own.distances(asked)):
                at = np.flatnonzero((da[ca] + db[cb] <= reach) & (ids != q))  # entries of the cells walked
                if not len(at):
                    continue
                d = np.sqrt(((x[at] - v) ** 2).sum(axis=1))
                some = min(k, len(d)) - 1
                near = np.flatnonzero(d <= np.partition(d, some)[some])
                near = near[np.lexsort((ids[at][near], d[near]))][:k]
                out[0] += [q] * len(near)
                out[1] += ids[at][near].tolist()
                out[2] += d[near].tolist()
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                        names=["query_id", "vec_id", "score"])

    probes = (listed.where(F.col("vec_id") % query_every == 0).select("vec_id", "vec")
              .mapInArrow(probe, "query_id long, query binary, reach double, block long")
              .withColumn("lot", F.pmod(F.xxhash64("query_id"), F.lit(lots)).cast("int")))
    entries = (listed.mapInArrow(place, "vec_id long, vec binary, cell int, block long")
               .withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1)))))
    found = (probes.groupBy("block", "lot").cogroup(entries.groupBy("block", "lot"))
             .applyInArrow(rank, "query_id long, vec_id long, score double"))
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return (found.withColumn("rank", best).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
