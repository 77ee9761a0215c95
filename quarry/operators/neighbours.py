"""Exact k-nearest-neighbour join by a tree of boxes and distance bounds.

1. Rows with equal features are one point (with its ``k + 1`` smallest keys),
   on both sides: copies neither repeat work nor make a group hot.
2. A bounded sample of points gives a tree of median cuts.  Points of a leaf
   are stored in blocks of bounded size, each with the box that it fills.
3. A query's ``k + 1``-th distance is at most the ``k + 1``-th smallest of
   (distance to a pivot + distance from that pivot to one of its nearest
   points).  It first meets the block at its own place: the ``k + 1``-th
   distance there is a closer bound.  Only blocks whose box lies within it can hold
   nearer points, and the query is sent to these alone.
4. Queries of a block are packed and joined to it; each pair of a pack and a
   block is one small matrix of distances, of which the best ``k + 1`` rows of
   a query are kept.  The best of all blocks of a query are its neighbours,
   ties to the smaller key.

No pair is formed that the bounds exclude, none is dropped, and no group is
gathered: hot blocks meet their queries pack by pack.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.staged import written

PIVOTS = 64               # most pivots; they and ``k + 1`` distances of each are sent to every task
SAMPLE = 131_072          # most points that the tree is cut from
BLOCK = 2048              # points of a block, queries of a pack
MOST_BLOCKS = 32_768      # about how many boxes are sent to every task; blocks get larger instead
SLACK = 1e-9              # relative allowance for rounding in the bounds


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances, added dimension by dimension."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return out


def _points(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    v = F.array(*[F.col(f"`{c}`").cast("double") + F.lit(0.0) for c in features])          # -0.0 and 0.0 are one value
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), v.alias("v"))
    return rows.where(F.col("id").isNotNull() & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))))


def _pivots(points: DataFrame, dim: int) -> np.ndarray:
    n = points.count()
    m = int(min(PIVOTS, max(1, n ** 0.5)))
    return np.array([r.v for r in points.orderBy(F.xxhash64("v"), "v").select("v").limit(m).collect()], np.float64).reshape(-1, dim)


def _radii(points: DataFrame, pivots: np.ndarray, k: int) -> np.ndarray:
    """For each cell its ``k + 1`` least distances of rows to the pivot."""
    dim = pivots.shape[1]

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(pivots), k + 1), np.inf)
        for batch in batches:
            far = squared_distances(_matrix(batch.column("v"), dim), pivots)
            cell = far.argmin(axis=1)
            held = np.asarray(batch.column("ids").value_lengths())
            d = np.repeat(np.sqrt(far[np.arange(len(cell)), cell]), held)
            of = np.repeat(cell, held)
            for c in np.unique(of):
                best[c] = np.sort(np.concatenate([best[c], d[of == c]]))[:k + 1]
        cells = np.flatnonzero(np.isfinite(best[:, 0]))
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array([x[np.isfinite(x)].tolist() for x in best[cells]], pa.list_(pa.float64()))],
                                         names=["cell", "d"])

    each = points.mapInArrow(least, "cell int, d array<double>").select("cell", F.explode("d").alias("d"))
    order = Window.partitionBy("cell").orderBy("d")
    best = np.full((len(pivots), k + 1), np.inf)
    for r in each.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).collect():       # pivots x (k + 1) numbers
        best[r.cell, r.n - 1] = r.d
    return best


def _reach(far: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """An upper bound of each query's (k + 1)-th distance."""
    k = radii.shape[1]
    bounds = (far[:, :, None] + radii[None]).reshape(len(far), -1)
    return np.partition(bounds, k - 1, axis=1)[:, k - 1]


@dataclass
class _Tree:
    """Median cuts as a full binary tree (children of i: 2 i + 1, 2 i + 2), the
    boxes of its nodes, and the blocks of each leaf, which follow each other."""
    depth: int
    axis: np.ndarray
    cut: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    first: np.ndarray | None = None       # of a leaf: its first block and how many
    many: np.ndarray | None = None
    block: np.ndarray | None = None       # of a block: number, box and points
    box_low: np.ndarray | None = None
    box_high: np.ndarray | None = None
    held: np.ndarray | None = None

    @staticmethod
    def of(sample: np.ndarray, leaves: int) -> _Tree:
        depth = max(0, int(np.ceil(np.log2(max(1, leaves)))))
        axis, cut = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, np.inf)
        mine = {0: sample}
        for i in range(len(axis)):
            x = mine.pop(i)
            if len(x) > 1:
                axis[i] = int((x.max(axis=0) - x.min(axis=0)).argmax())
                at = x[:, axis[i]]
                cut[i] = np.partition(at, (len(at) - 1) // 2)[(len(at) - 1) // 2]
                right = at > cut[i]
            else:
                right = np.zeros(len(x), bool)
            mine[2 * i + 1], mine[2 * i + 2] = x[~right], x[right]
        return _Tree(depth, axis, cut)

    def leaf(self, v: np.ndarray) -> np.ndarray:
        """The leaf at the place of each row; once boxes are known, one with points."""
        node = np.zeros(len(v), np.int64)
        every = np.arange(len(v))
        for _ in range(self.depth):
            right = v[every, self.axis[node]] > self.cut[node]
            if self.low is not None:
                right = np.where(np.isinf(self.low[2 * node + 1, 0]), True, np.where(np.isinf(self.low[2 * node + 2, 0]), False, right))
            node = 2 * node + 1 + right
        return node - len(self.axis)

    def fill(self, boxes: list) -> None:
        """Takes (block, leaf, low, high, points), ordered by leaf and block."""
        dim, leaves = len(boxes[0].low), len(self.axis) + 1
        leaf = np.array([b.leaf for b in boxes], np.int64)
        self.block = np.array([b.block for b in boxes], np.int64)
        self.box_low, self.box_high = np.array([b.low for b in boxes], np.float64), np.array([b.high for b in boxes], np.float64)
        self.held = np.array([b.points for b in boxes], np.int64)
        self.first, self.many = np.searchsorted(leaf, np.arange(leaves)), np.bincount(leaf, minlength=leaves)
        self.low, self.high = np.full((2 * leaves - 1, dim), np.inf), np.full((2 * leaves - 1, dim), -np.inf)
        np.minimum.at(self.low, leaf + leaves - 1, self.box_low)
        np.maximum.at(self.high, leaf + leaves - 1, self.box_high)
        for i in range(leaves - 2, -1, -1):
            self.low[i] = np.minimum(self.low[2 * i + 1], self.low[2 * i + 2])
            self.high[i] = np.maximum(self.high[2 * i + 1], self.high[2 * i + 2])

    def home(self, v: np.ndarray) -> np.ndarray:
        """Position of the nearest block of each row's leaf."""
        leaf = self.leaf(v)
        best, near = self.first[leaf].copy(), np.full(len(v), np.inf)
        for j in range(int(self.many[leaf].max(initial=0))):
            who = np.flatnonzero(self.many[leaf] > j)
            at = self.first[leaf[who]] + j
            d = _box_distance(v[who], self.box_low[at], self.box_high[at])
            better = d < near[who]
            best[who[better]], near[who[better]] = at[better], d[better]
        return best

    def within(self, v: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, block position) of every block whose box is no further than ``reach``."""
        most = reach * reach * (1 + SLACK)
        who, node = np.arange(len(v)), np.zeros(len(v), np.int64)
        for _ in range(self.depth):
            who, node = np.concatenate([who, who]), np.concatenate([2 * node + 1, 2 * node + 2])
            near = _box_distance(v[who], self.low[node], self.high[node]) <= most[who]
            who, node = who[near], node[near]
        leaf = node - len(self.axis)
        times = self.many[leaf]
        at = np.repeat(self.first[leaf] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        who = np.repeat(who, times)
        near = _box_distance(v[who], self.box_low[at], self.box_high[at]) <= most[who]
        return who[near], at[near]

    def bound(self, v: np.ndarray, at: int, k: int) -> np.ndarray:
        """An upper bound of each row's (k + 1)-th distance if block ``at`` has
        too few points: the far corners of enough blocks around it."""
        middle = (self.box_low + self.box_high) / 2
        order = np.argsort(((middle - middle[at]) ** 2).sum(axis=1), kind="stable")
        enough = int(np.searchsorted(np.cumsum(self.held[order]), k + 1)) + 1
        if enough > len(order):
            return np.full(len(v), np.inf)
        far = np.zeros(len(v))
        for i in order[:enough]:
            far = np.maximum(far, (np.maximum(np.abs(v - self.box_low[i]), np.abs(v - self.box_high[i])) ** 2).sum(axis=1))
        return np.sqrt(far)


def _box_distance(v: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each row to its box (infinite for an empty one)."""
    out = np.maximum(np.maximum(low - v, v - high), 0.0)
    return (out * out).sum(axis=1)


def _tree(points: DataFrame, n: int, dim: int, size: int) -> _Tree:
    """Cut from a sample by hash, about 8 points a leaf or all of them."""
    share = min(1.0, SAMPLE / n)
    chosen = points.select("v").where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) <= int(share * (1 << 30)))
    sample = np.array([r.v for r in chosen.collect()], np.float64).reshape(-1, dim)
    return _Tree.of(sample, min(-(-n // size), max(1, len(sample) // 8)))


def _blocks(points: DataFrame, tree: _Tree, dim: int, size: int) -> DataFrame:
    """Blocks of the points: number, leaf, box, how many, and the points, their
    keys and how many each has."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(tree.leaf(_matrix(batch.column("v"), dim)).astype(np.int32)), batch.column("v"),
                                              batch.column("ids")], names=["leaf", "v", "ids"])

    dealt = points.mapInArrow(deal, "leaf int, v array<double>, ids array<long>")
    ranged = dealt.repartitionByRange("leaf", "v").sortWithinPartitions("leaf", "v")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            leaf = np.asarray(batch.column("leaf"))
            v, ids = _matrix(batch.column("v"), dim), batch.column("ids")
            edge = [0, *(np.flatnonzero(np.diff(leaf)) + 1).tolist(), len(leaf)]
            cuts = sorted({c for a, b in zip(edge[:-1], edge[1:], strict=True) for c in (*range(a, b, size), b)})
            out = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = ids.slice(a, b - a)
                out.append((number, int(leaf[a]), v[a:b].min(axis=0).tolist(), v[a:b].max(axis=0).tolist(), b - a, v[a:b].tobytes(),
                            np.asarray(own.flatten(), np.int64).tobytes(), np.asarray(own.value_lengths(), np.int32).tobytes()))
                number += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)],
                                                 names=["block", "leaf", "low", "high", "points", "data", "ids", "counts"])

    return ranged.mapInArrow(pack, "block long, leaf long, low array<double>, high array<double>, points long, data binary, ids binary, counts binary")


_FOUND = "q long, v array<double>, reach double, near array<struct<distance:double,neighbour:long>>"


def _searched(sent: DataFrame, blocks: DataFrame, dim: int, k: int, tree: _Tree | None) -> DataFrame:
    """Queries (block, q, v, reach) in their blocks: the best ``k + 1`` rows of
    each block within reach.  With ``tree`` the reach is replaced by what the
    block itself gives."""
    # by range, so that the queries of one hot block lie in several tasks
    ordered = sent.repartitionByRange("block", "q").sortWithinPartitions("block")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = np.asarray(batch.column("block"))
            edge = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            cuts = sorted({c for a, b in zip(edge[:-1], edge[1:], strict=True) for c in (*range(a, b, BLOCK), b)})
            q, v, reach = np.asarray(batch.column("q")), _matrix(batch.column("v"), dim), np.asarray(batch.column("reach"))
            out = [(int(block[a]), q[a:b].tobytes(), v[a:b].tobytes(), reach[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["block", "q", "v", "reach"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                q, reach = np.frombuffer(row["q"], np.int64), np.frombuffer(row["reach"], np.float64)
                v, points = (np.frombuffer(row[c], np.float64).reshape(-1, dim) for c in ("v", "data"))
                ids, count = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["counts"], np.int32).astype(np.int64)
                begin = np.cumsum(count) - count
                few = tree is not None and len(points) <= k
                at = int(np.flatnonzero(tree.block == row["block"])[0]) if few else -1
                for a in range(0, len(q), 256):
                    part = v[a:a + 256]
                    d = squared_distances(part, points)
                    most = reach[a:a + 256] ** 2 * (1 + SLACK)
                    if len(points) > k:
                        most = np.minimum(most, np.partition(d, k, axis=1)[:, k])
                    far = np.minimum(reach[a:a + 256], tree.bound(part, at, k)) if few else np.sqrt(most)
                    who, which = np.nonzero(d <= most[:, None])
                    times = count[which]
                    row_of, dist = np.repeat(who, times), np.repeat(d[who, which], times)
                    key = ids[np.repeat(begin[which] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))]
                    best = np.lexsort((key, dist, row_of))
                    row_of, dist, key = row_of[best], dist[best], key[best]
                    start = np.searchsorted(row_of, np.arange(len(part)))
                    keep = np.arange(len(row_of)) - start[row_of] <= k
                    ends = np.concatenate([[0], np.cumsum(np.bincount(row_of[keep], minlength=len(part)))])
                    near = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                        [pa.array(dist[keep]), pa.array(key[keep])], names=["distance", "neighbour"]))
                    spots = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * dim, pa.int32()), pa.array(part.ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(q[a:a + 256]), spots, pa.array(far), near], names=["q", "v", "reach", "near"])

    packs = written(ordered.mapInArrow(pack, "block long, q binary, v binary, reach binary"))
    return packs.join(blocks.select("block", "data", "ids", "counts"), "block").mapInArrow(search, _FOUND)


def nearest_neighbours(queries: DataFrame, rows: DataFrame, key: str, features: Sequence[str], k: int) -> DataFrame:
    """The ``k`` rows nearest to every query (squared Euclidean distance over
    ``features``; ties to the smaller key; a row with the query's own key is
    left out): ``key``, ``rank`` int from 1, ``neighbour`` long and
    ``distance`` double.  All of them, if there are fewer.

    Keys are integers, unique on each side.  Rows without a key or with a
    null, NaN or infinite feature take no part.  Other columns are ignored.
    """
    spark = rows.sparkSession
    dim = len(features)
    first = Window.partitionBy("v").orderBy("id")
    points = written(_points(rows, key, features).withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
                     .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    asked = _points(queries, key, features)
    places = written(asked.select("v").distinct().withColumn("q", F.monotonically_increasing_id()))
    n = points.count()
    if not n:
        return spark.createDataFrame([], f"`{key}` long, rank int, neighbour long, distance double")
    size = max(BLOCK, 2 * (k + 1), n // MOST_BLOCKS)
    tree = _tree(points, n, dim, size)
    blocks = written(_blocks(points, tree, dim, size))
    tree.fill(blocks.select("block", "leaf", "low", "high", "points").orderBy("leaf", "block").collect())     # one row a block

    pivots = _pivots(points, dim)
    radii = _radii(points, pivots, k)

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), dim)
            reach = [_reach(np.sqrt(squared_distances(v[a:a + 256], pivots)), radii) for a in range(0, len(v), 256)]
            yield pa.RecordBatch.from_arrays([pa.array(tree.block[tree.home(v)]), batch.column("q"), batch.column("v"),
                                              pa.array(np.concatenate([*reach, np.zeros(0)]) * (1 + SLACK))], names=["block", "q", "v", "reach"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                v, reach = _matrix(part.column("v"), dim), np.asarray(part.column("reach"))
                who, at = tree.within(v, reach)
                more = at != tree.home(v)[who]
                who, at = pa.array(who[more]), at[more]
                yield pa.RecordBatch.from_arrays([pa.array(tree.block[at]), *[part.column(c).take(who) for c in ("q", "v", "reach")]],
                                                 names=["block", "q", "v", "reach"])

    sent = "block long, q long, v array<double>, reach double"
    near = written(_searched(places.mapInArrow(at_home, sent), blocks, dim, k, tree))
    around = written(near.select("q", "v", "reach").mapInArrow(others, sent))
    more = _searched(around, blocks, dim, k, None).where(F.size("near") > 0)
    of = near.select("q", "v", "near").unionByName(more.select("q", "v", "near"))
    best = of.groupBy("q").agg(F.any_value("v").alias("v"), F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near"))
    mine = asked.join(best, "v").select("id", F.posexplode("near").alias("n", "near")).where(F.col("near.neighbour") != F.col("id"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("n"))
    out = mine.withColumn("rank", rank).where(F.col("rank") <= k)
    return out.select(F.col("id").alias(key), F.col("rank").cast("int").alias("rank"), F.col("near.neighbour").alias("neighbour"),
                      F.col("near.distance").alias("distance"))


def neighbour_votes(train: DataFrame, test: DataFrame, key: str, label: str, features: Sequence[str], ks: Sequence[int]) -> DataFrame:
    """Nearest-neighbour classifiers for every ``k`` of a grid from one
    join: key, ``k``, ``label`` of the test row and ``p``, the share of label 1
    among its ``k`` nearest training rows (of all, if there are fewer)."""
    near = nearest_neighbours(test, train, key, features, max(ks))
    known = train.select(F.col(key).cast("long").alias("neighbour"), F.col(label).cast("double").alias("__y"))
    wide = near.join(known, "neighbour").groupBy(key).agg(*[F.avg(F.when(F.col("rank") <= k, F.col("__y"))).alias(f"__p{k}") for k in ks])
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"__p{k}").alias("p")) for k in ks]))
    votes = wide.select(key, pairs.alias("v")).select(key, "v.k", "v.p")
    return votes.join(test.select(F.col(key).cast("long").alias(key), F.col(label).alias("label")), key)
