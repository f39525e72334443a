"""Hard-negative mining with cover trees over norm-augmented candidates.

A candidate y gets one component more, sqrt(M^2 - |y|^2) with M the largest norm, so that all candidates lie on
a sphere and an anchor q (with 0 there) has |q - y|^2 = |q|^2 + M^2 - 2 q.y: bounds on distances are bounds on
inner products. The top level of the tree are pivots, the cells around them and each cell's covering radius; a
cell's rows are dealt to blocks by id, and each block's part of the tree is grown by one task: a node's children
are a net of its points at half its covering radius, until a net would hold much of the points. Anchors are sent
only to the blocks of cells that may hold what they look for, descend their trees best bound first, skip nodes
whose bounds lie outside all windows, and compute the products in the leaves exactly.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

SAMPLE = 4096  # rows, chosen by a hash of the id, that pivots and first bounds come from
PIVOTS = 64
BLOCK = 4000  # rows of a block, on average
LOT = 20_000  # anchors that a task takes, on average
LEAF = 32  # points that need no further split
COVER = 0.5  # of a child's covering radius to its parent's, at most

TREE = ["ids", "labels", "vecs", "centre", "radius", "first", "many", "low", "high", "mask"]
TREE_DDL = "cell int, split int, " + ", ".join(f"{c} binary" for c in TREE)


def usable(df: DataFrame, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """(vec_id, label, vec as array<long>) of the rows that take part: floor(256 x) of each component."""
    vec = F.col("vec")
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                      F.col(vec_col).cast("array<double>").alias("vec"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vec.isNotNull())
            .where(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
            .withColumn("vec", F.transform(vec, lambda x: F.floor(256 * x))))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dim)


class Space:
    """Distances between norm-augmented candidates, and what they say about inner products."""

    def __init__(self, dim: int, largest: int):
        self.dim, self.largest = dim, largest  # largest squared norm

    def augmented(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        return np.column_stack([x, np.sqrt(np.maximum(self.largest - (x * x).sum(1), 0))])

    @staticmethod
    def distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
        return np.sqrt(((points - centre) ** 2).sum(1))

    def products(self, x: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact inner products."""
        if self.largest < 1 << 52:  # every partial sum is an exact double
            return np.rint(x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
        return x @ q

    def bounds(self, centres: np.ndarray, radius: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of ``q`` with any candidate within ``radius`` of each centre."""
        q = q.astype(np.float64)
        size = q @ q + self.largest
        d = np.sqrt(np.maximum(size - 2 * (centres @ q), 0))
        slack = 1e-6 * size + 1  # beyond all rounding
        return (size - (d + radius) ** 2) / 2 - slack, (size - np.maximum(d - radius, 0) ** 2) / 2 + slack


def bits(labels: np.ndarray) -> np.ndarray:
    return np.uint64(1) << (labels % 64).astype(np.uint64)


def grow(ids: np.ndarray, labels: np.ndarray, vecs: np.ndarray, space: Space) -> dict[str, np.ndarray]:
    """The tree over some rows: nodes in arrays, a node's children side by side, a leaf's rows too."""
    points = space.augmented(vecs)
    mask = bits(labels)
    nodes: list[list] = []  # centre, radius, first child, children, first row, end of rows, labels
    order: list[np.ndarray] = []
    placed = 0

    def node(centre: int, rows: np.ndarray, away: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        nodes.append([centre, away.max() * (1 + 1e-9), 0, 0, 0, 0, np.bitwise_or.reduce(mask[rows])])
        return len(nodes) - 1, rows, away
    everything = np.arange(len(ids))
    todo = [node(0, everything, space.distances(points, points[0]))]
    while todo:
        at, rows, away = todo.pop()
        own = nodes[at]
        split = len(rows) > LEAF and own[1] > 0
        if split:
            centres, near, owner = [own[0]], away.copy(), np.zeros(len(rows), np.int64)
            while near.max() > COVER * own[1] and 4 * len(centres) <= len(rows):
                far = rows[near.argmax()]
                d = space.distances(points[rows], points[far])
                closer = d < near
                near[closer], owner[closer] = d[closer], len(centres)
                centres.append(int(far))
            split = near.max() <= COVER * own[1]
        if split:
            own[2], own[3] = len(nodes), len(centres)
            todo += [node(c, rows[owner == k], near[owner == k]) for k, c in enumerate(centres)]
        else:
            order.append(rows)
            own[4], own[5] = placed, placed + len(rows)
            placed += len(rows)
    order = np.concatenate(order)
    place = np.empty(len(order), np.int64)
    place[order] = everything
    columns = list(zip(*nodes))
    return {"ids": ids[order], "labels": labels[order], "vecs": vecs[order], "centre": place[list(columns[0])],
            "radius": np.array(columns[1], np.float64), "mask": np.array(columns[6], np.uint64),
            **{name: np.array(columns[k], np.int64) for name, k in (("first", 2), ("many", 3), ("low", 4), ("high", 5))}}


class Tree:
    KINDS = {"radius": np.float64, "mask": np.uint64}

    def __init__(self, row: dict, space: Space):
        self.space = space
        for name in TREE:
            setattr(self, name, np.frombuffer(row[name], self.KINDS.get(name, np.int64)))
        self.vecs = self.vecs.reshape(-1, space.dim)
        self.centres = self.vecs[self.centre].astype(np.float64)

    def descend(self, q: np.ndarray, wanted: Callable, leaf: Callable) -> None:
        """Visit the leaves that ``wanted(least, greatest, mask)`` doesn't rule out, greatest bound first."""
        heap: list[tuple] = []

        def push(nodes: np.ndarray) -> None:
            least, greatest = self.space.bounds(self.centres[nodes], self.radius[nodes], q)
            for k in np.flatnonzero(wanted(least, greatest, self.mask[nodes])):
                heapq.heappush(heap, (-greatest[k], least[k], int(nodes[k])))
        push(np.array([0]))
        while heap:
            greatest, least, at = heapq.heappop(heap)
            if not wanted(least, -greatest, self.mask[at]):  # what was found since may rule it out
                continue
            if self.many[at]:
                push(np.arange(self.first[at], self.first[at] + self.many[at]))
            else:
                leaf(slice(self.low[at], self.high[at]))


def first_rows(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` rows that come first: higher score, then smaller id."""
    if len(score) > k:
        some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        return some[np.lexsort((ids[some], -score[some]))][:k]
    return np.lexsort((ids, -score))


class Best:
    """The first ``k`` rows found so far whose scores lie in a window."""

    def __init__(self, k: int, low: int, high: int):
        self.k, self.low, self.high = k, low, high
        self.score, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def floor(self) -> int:
        """What a row must score to be among them."""
        return max(self.low, int(self.score[-1])) if len(self.score) == self.k else self.low

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        some = (score >= self.floor()) & (score <= self.high)
        if some.any():
            score, ids = np.concatenate([self.score, score[some]]), np.concatenate([self.ids, ids[some]])
            first = first_rows(score, ids, self.k)
            self.score, self.ids = score[first], ids[first]


LOWEST, HIGHEST = -(1 << 62), 1 << 62


def positives_in(tree: Tree, anchor: int, label: int, q: np.ndarray, k: int, floor: int) -> Best:
    best, bit = Best(k, floor, HIGHEST), bits(np.array([label]))[0]

    def leaf(rows: slice) -> None:
        some = np.flatnonzero((tree.labels[rows] == label) & (tree.ids[rows] != anchor))
        best.add(tree.space.products(tree.vecs[rows][some], q), tree.ids[rows][some])
    tree.descend(q, lambda least, greatest, mask: (greatest >= best.floor()) & ((mask & bit) != 0), leaf)
    return best


def negatives_in(tree: Tree, anchor: int, label: int, q: np.ndarray, windows: list[Best]) -> list[Best]:
    def wanted(least, greatest, mask):
        some = False
        for w in windows:
            some = some | ((greatest >= w.floor()) & (least <= w.high))
        return some

    def leaf(rows: slice) -> None:
        some = np.flatnonzero((tree.labels[rows] != label) & (tree.ids[rows] != anchor))
        score, ids = tree.space.products(tree.vecs[rows][some], q), tree.ids[rows][some]
        for w in windows:
            w.add(score, ids)
    tree.descend(q, wanted, leaf)
    return windows


def window(positive: int, low: int, high: int) -> tuple[int, int]:
    """Scores s with low * positive <= 100 s <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


def mine(df: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, anchor_every: int = 100,
         id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None) -> DataFrame:
    """The first ``negatives`` rows of another label for each anchor and each of its first ``positives`` rows of its
    own label whose score lies between ``low`` and ``high`` percent of the positive's.

    Anchors are the rows whose id is divisible by ``anchor_every``. A component x counts as floor(256 x), a score
    is the inner product with the anchor, higher ones come first, then smaller ids. Rows with a null id, label or
    vector, with null or non-finite components, or of another dimension than most rows (the larger of two equally
    frequent ones) take no part. Rows with an anchor's own id are not its candidates; other repeated ids are
    candidates each, and of an anchor's repeated rows the one with the least label, then vector, asks. Equal
    vectors and tied scores are ranked by id. Where a positive's score is negative no row fits. Squared norms of
    2^62 or more raise an error. An empty table gives no rows; other columns are ignored.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    spark = df.sparkSession
    ddl = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = usable(df, id_col, vec_col, F.col("label") if label is None else label)
    norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    shape = (rows.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n"), F.max(norm).alias("largest"))
             .orderBy(F.desc("n"), F.desc("dim")).first())
    if shape is None or shape["dim"] == 0:
        return spark.createDataFrame([], ddl)
    if shape["largest"] >= 2.0 ** 62:
        raise ValueError("hard negatives: components too large for 64-bit inner products")
    dim, space = shape["dim"], Space(shape["dim"], int(shape["largest"]))
    rows = rows.where(F.size("vec") == dim)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    near = (np.array([r["vec_id"] for r in sample], np.int64), np.array([r["label"] for r in sample], np.int64),
            np.array([r["vec"] for r in sample], np.int64))
    points = space.augmented(near[2])
    pivots, away = [0], space.distances(points, points[0])
    while len(pivots) < PIVOTS and away.max() > 0:  # farthest first: a net of the sample
        pivots.append(int(away.argmax()))
        away = np.minimum(away, space.distances(points, points[pivots[-1]]))
    pivots = near[2][pivots]
    base = spark.sparkContext.broadcast((dim, space.largest, pivots))  # plain values: executors have no copy of the package

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *space, pivots = base.value
        space = Space(*space)
        centres = space.augmented(pivots)
        for b in batches:
            if b.num_rows:
                x = b.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, space.dim)
                to = np.column_stack([space.distances(space.augmented(x), c) for c in centres])
                cell = to.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id"), b.column("label"), pa.array([v.tobytes() for v in x], pa.binary()),
                     pa.array(cell.astype(np.int32)), pa.array(to[np.arange(len(x)), cell])],
                    names=["vec_id", "label", "vec", "cell", "away"])

    listed = staged(rows.mapInArrow(assign, "vec_id long, label long, vec binary, cell int, away double"), "cells")
    cells = {r["cell"]: (r["n"], r["away"]) for r in
             listed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("away")).collect()}  # PIVOTS rows
    splits = {c: -(-n // BLOCK) for c, (n, _) in cells.items()}

    def build(key: tuple, block: pa.Table) -> pa.Table:
        order = np.lexsort((block.column("vec_id").to_numpy(),))
        block = block.take(pa.array(order))
        tree = grow(block.column("vec_id").to_numpy(), block.column("label").to_numpy(),
                    matrix(block.column("vec"), base.value[0]), Space(*base.value[:2]))
        return pa.table([pa.array([k.as_py()], pa.int32()) for k in key]
                        + [pa.array([tree[c].tobytes()], pa.binary()) for c in TREE], names=["cell", "split", *TREE])

    of_cell = F.element_at(F.create_map(*[F.lit(x) for kv in splits.items() for x in kv]), F.col("cell"))
    trees = staged(listed.withColumn("split", F.pmod(F.xxhash64("vec_id"), of_cell).cast("int"))
                   .groupBy("cell", "split").applyInArrow(build, TREE_DDL), "cover-trees")
    anchors = listed.where(F.col("vec_id") % anchor_every == 0).groupBy("vec_id").agg(
        F.min(F.struct("label", "vec")).alias("own")).select(F.col("vec_id").alias("anchor_id"), "own.*")
    lots = -(-sum(n for n, _ in cells.values()) // (anchor_every * LOT))
    top = spark.sparkContext.broadcast((near, cells, splits))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each anchor to the blocks of the cells that its windows, or its positives, may lie in."""
        space, pivots = Space(*base.value[:2]), base.value[2]
        (ids, labels, vecs), cells, splits = top.value
        held = np.array(sorted(cells), np.int64)
        radius = np.array([cells[c][1] for c in sorted(cells)]) * (1 + 1e-9)
        centres = pivots[held].astype(np.float64)
        for b in batches:
            found = [], [], [], []
            for k, q in enumerate(matrix(b.column("vec"), space.dim)):
                anchor, label = b.column("anchor_id")[k].as_py(), b.column("label")[k].as_py()
                least, greatest = space.bounds(centres, radius, q)
                score = space.products(vecs, q)
                sought = b.column("scores")[k].as_py()
                if sought is None:
                    some = (labels == label) & (ids != anchor)
                    wins = [Best(positives, LOWEST, HIGHEST)]
                else:
                    some = (labels != label) & (ids != anchor)
                    wins = [Best(negatives, *window(s, low, high)) for s in sought]
                for w in wins:
                    w.add(score[some], ids[some])
                floors = [w.floor() for w in wins]
                to = np.zeros(len(held), bool)
                for w, f in zip(wins, floors):
                    to |= (greatest >= f) & (least <= w.high) & (w.low <= w.high)
                for c in held[to].tolist():
                    for s in range(splits[c]):
                        for column, value in zip(found, (k, c, s, floors)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*b.take(pa.array(found[0], pa.int64())).columns, pa.array(found[1], pa.int32()),
                 pa.array(found[2], pa.int32()), pa.array(found[3], pa.list_(pa.int64()))],
                names=["anchor_id", "label", "vec", "scores", "cell", "split", "floors"])

    def asked(queries: DataFrame) -> DataFrame:
        sent = queries.mapInArrow(route, "anchor_id long, label long, vec binary, scores array<long>, cell int, split int, "
                                         "floors array<long>")
        return sent.withColumn("lot", F.pmod(F.xxhash64("anchor_id"), F.lit(lots)).cast("int")) \
            .groupBy("cell", "split", "lot")

    held = trees.withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1)))).groupBy("cell", "split", "lot")

    def search(queries: pa.Table, block: pa.Table) -> pa.Table:
        out = [], [], [], []
        if queries.num_rows and block.num_rows:
            tree = Tree(block.select(TREE).to_pylist()[0], Space(*base.value[:2]))
            vecs = matrix(queries.column("vec").combine_chunks(), tree.space.dim)
            for q, asks in zip(vecs, queries.drop_columns(["vec"]).to_pylist()):
                who = asks["anchor_id"], asks["label"], q
                if asks["scores"] is None:
                    bests = [positives_in(tree, *who, positives, asks["floors"][0])]
                else:
                    bests = [Best(negatives, max(f, window(s, low, high)[0]), window(s, low, high)[1])
                             for s, f in zip(asks["scores"], asks["floors"])]
                    bests = negatives_in(tree, *who, bests)
                for place, best in enumerate(bests):
                    for column, values in zip(out, ([asks["anchor_id"]] * len(best.ids), [place] * len(best.ids),
                                                    best.ids.tolist(), best.score.tolist())):
                        column += values
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
                         pa.array(out[3], pa.int64())], names=["anchor_id", "place", "vec_id", "score"])

    found_ddl = "anchor_id long, place int, vec_id long, score long"

    def ranked(found: DataFrame, k: int) -> DataFrame:
        by = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)

    none = F.lit(None).cast("array<long>")
    own = staged(ranked(asked(anchors.withColumn("scores", none)).cogroup(held).applyInArrow(search, found_ddl), positives)
                 .groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("own")),
                 "positives")
    queries = anchors.join(own, "anchor_id").withColumn("scores", F.col("own.score"))
    away = ranked(asked(queries.select("anchor_id", "label", "vec", "scores")).cogroup(held).applyInArrow(search, found_ddl),
                  negatives)
    mine = F.get(F.col("own"), F.col("place"))
    return (away.join(own, "anchor_id")
            .select("anchor_id", mine["vec_id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                    F.col("vec_id").alias("negative_id"), mine["score"].alias("positive_score"),
                    F.col("score").alias("negative_score")))


def relabelled(label: Column, vec_id: Column) -> Column:
    """The query's labels: every seventh row's is one further on, modulo ten."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
