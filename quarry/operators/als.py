"""Alternating least squares in few blocks.

``pyspark.ml``'s ALS deals users and items over ten blocks and sends, in every
half of an iteration, each factor to every block that needs it: nearly all ten
where entities have many ratings.  Fewer blocks send less, but its starting
factors are drawn block by block.  Here it draws them as ever (a fit of no
iterations), and the iterations run in ``blocks`` blocks: the same normal
equations in double precision, factors kept in single.

The ratings are laid out once for each side, in bundles of whole entities;
their partners are numbered by their place among the factors that the block
receives.  A task holds the factors it receives and one bundle of ratings.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

BUNDLE = 1 << 20          # ratings of one bundle
START_BLOCKS = 10         # blocks in which the starting factors are drawn


def _block(ids: np.ndarray, blocks: int) -> np.ndarray:
    mixed = ids.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)


def _packed(ids: np.ndarray, factors: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """Ids and factors in fewer bytes, nothing lost: ids as differences, the
    factors' signs and exponents, which repeat, compressed apart from the rest."""
    steps = np.diff(ids, prepend=np.int32(0)).astype(np.int32).view(np.uint8).reshape(-1, 4)
    planes = np.ascontiguousarray(factors.T, np.dtype("<f4")).reshape(-1).view(np.uint8).reshape(-1, 4)
    return len(ids), zlib.compress(steps.T.tobytes(), 1), zlib.compress(planes[:, 3].tobytes(), 1), planes[:, :3].T.tobytes()


def _unpacked(n: int, steps: bytes, top: bytes, rest: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.ascontiguousarray(np.frombuffer(zlib.decompress(steps), np.uint8).reshape(4, n).T).reshape(-1).view(np.int32)
    high = np.frombuffer(zlib.decompress(top), np.uint8)
    planes = np.empty((len(high), 4), np.uint8)
    planes[:, 3] = high
    planes[:, :3] = np.frombuffer(rest, np.uint8).reshape(3, len(high)).T
    return np.cumsum(ids, dtype=np.int32), planes.reshape(-1).view(np.dtype("<f4")).reshape(-1, n).T


def _same(block: int) -> int:
    return block


def _bundles(batches: Iterable[pa.RecordBatch], blocks: int, most: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, partner, rating), sorted by id, as bundles of about ``most``
    ratings: one row per block.  An entity of more ratings comes in pieces."""
    held: list[list[np.ndarray]] = []
    busy = None

    def packed(rows: list[np.ndarray], whole: bool) -> Iterator[dict[str, Any]]:
        at = _block(rows[0], blocks)
        for b in np.unique(at):
            of, partner, rating = (c[at == b] for c in rows)
            ids, sizes = np.unique(of, return_counts=True)
            yield {"block": int(b), "whole": whole, "ids": ids.tobytes(), "sizes": sizes.astype(np.int32).tobytes(),
                   "partners": partner.tobytes(), "ratings": rating.tobytes()}

    def cut(last: bool) -> Iterator[dict[str, Any]]:
        nonlocal held, busy
        rows = [np.concatenate(c) for c in zip(*held, strict=True)]
        if busy is not None:
            n = int(np.searchsorted(rows[0], busy, "right"))
            if n:
                yield from packed([c[:n] for c in rows], False)
            rows = [c[n:] for c in rows]
            if len(rows[0]):
                busy = None
        if len(rows[0]):
            n = len(rows[0]) if last else int(np.searchsorted(rows[0], rows[0][-1]))
            if n:
                yield from packed([c[:n] for c in rows], True)
            elif len(rows[0]) >= most:
                busy = rows[0][0]
                yield from packed(rows, False)
                n = len(rows[0])
            rows = [c[n:] for c in rows]
        held = [rows]

    schema = pa.schema([("block", pa.int32()), ("whole", pa.bool_())] + [
        (c, pa.binary()) for c in ("ids", "sizes", "partners", "ratings")])
    n = 0
    for batch in batches:
        held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "partner", "rating")])
        n += batch.num_rows
        if n >= most:
            yield pa.RecordBatch.from_pylist(list(cut(False)), schema)
            n = len(held[0][0])
    if held:
        yield pa.RecordBatch.from_pylist(list(cut(True)), schema)


def _laid(ratings: DataFrame, of: str, partner: str, blocks: int, most: int) -> RDD:
    """(block, bundle) of one side, in the partition of the block."""
    rows = ratings.select(F.col(of).alias("id"), F.col(partner).alias("partner"), "rating")
    rows = rows.repartition("id").sortWithinPartitions("id").mapInArrow(
        partial(_bundles, blocks=blocks, most=most),
        "block int, whole boolean, ids binary, sizes binary, partners binary, ratings binary")

    def bundle(r):
        return r.block, (r.whole, np.frombuffer(r.ids, np.int32), np.frombuffer(r.sizes, np.int32),
                         np.frombuffer(r.partners, np.int32), np.frombuffer(r.ratings, np.float32))

    return rows.rdd.map(bundle).partitionBy(blocks, _same).mapPartitions(iter, preservesPartitioning=True)


def _wanted(sizes: np.ndarray, partners: np.ndarray, blocks: int) -> np.ndarray:
    """The blocks of an entity's partners as bits."""
    bits = np.int64(1) << _block(partners, blocks)
    return np.bitwise_or.reduceat(bits, np.cumsum(sizes) - sizes)


def _needs(row: tuple, blocks: int) -> Iterator[tuple]:
    """The ids of a bundle for every block whose partners need them."""
    _, ids, sizes, partners, _ = row[1]
    yield from _routed((0, (ids, _wanted(sizes, partners, blocks), np.zeros((len(ids), 0), np.float32))), blocks)


def _routed(row: tuple, blocks: int) -> Iterator[tuple]:
    ids, bits, factors = row[1]
    for b in range(blocks):
        at = (bits >> b) & 1 == 1
        if at.any():
            yield b, _packed(ids[at], factors[at])


def _received(rows: Iterable[tuple]) -> Iterator[Any]:
    """What a block is sent as one table in the order of the ids, once; then
    the block's bundles."""
    ids, factors, table = [], [], None
    for _, part in rows:
        if len(part) == 4:
            some, of = _unpacked(*part)
            ids.append(some)
            factors.append(of)
            continue
        if table is None:
            known, at = np.unique(np.concatenate(ids), return_index=True)
            table = known, np.concatenate(factors)[at]
            ids, factors = [], []
            yield table
        yield part


def _numbered(rows: Iterable[tuple], block_of: Callable[[np.ndarray], np.ndarray], blocks: int) -> Iterator[tuple]:
    """The bundles with places of the partners among the received ids."""
    parts = _received(rows)
    known = next(parts, (None,))[0]
    for whole, ids, sizes, partners, ratings in parts:
        places = np.searchsorted(known, partners).astype(np.int32)
        yield int(block_of(ids[:1])[0]), (whole, ids, sizes, places, ratings, _wanted(sizes, partners, blocks))


def _begun(rows: Iterable[tuple]) -> Iterator[tuple]:
    """The received factors of the bundles' own ids."""
    parts = _received(rows)
    known, factors = next(parts, (None, None))
    for _, ids, _, _, _, bits in parts:
        yield 0, (ids, bits, factors[np.searchsorted(known, ids)])


def _moments(table: np.ndarray, sizes: np.ndarray, places: np.ndarray, ratings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of x x' and of x times the rating; entities of as many ratings together."""
    rank = table.shape[1]
    xx, xy = np.empty((len(sizes), rank, rank)), np.empty((len(sizes), rank))
    order = np.argsort(sizes, kind="stable")
    first = np.cumsum(sizes) - sizes
    for group in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
        at = first[group][:, None] + np.arange(sizes[group[0]])
        x = table[places[at]].astype(np.float64)
        turned = x.transpose(0, 2, 1)
        xx[group] = turned @ x
        xy[group] = (turned @ ratings[at].astype(np.float64)[:, :, None])[:, :, 0]
    return xx, xy


def _solved(rows: Iterable[tuple], reg: float) -> Iterator[tuple]:
    """Least squares of every entity of the block, penalised by its ratings."""
    def solve(xx, xy, n):
        return np.linalg.solve(xx + (n * reg)[:, None, None] * np.eye(xx.shape[1]), xy[:, :, None])[:, :, 0].astype(np.float32)

    parts = _received(rows)
    table = next(parts, (None, None))[1]
    pieces: dict[int, list] = {}
    for whole, ids, sizes, places, ratings, bits in parts:
        xx, xy = _moments(table, sizes, places, ratings)
        if whole:
            yield 0, (ids, bits, solve(xx, xy, sizes))
        elif int(ids[0]) in pieces:
            p = pieces[int(ids[0])]
            p[:] = p[0] + xx, p[1] + xy, p[2] + sizes.astype(np.int64), p[3] | bits
        else:
            pieces[int(ids[0])] = [xx, xy, sizes.astype(np.int64), bits]
    for i, (xx, xy, n, bits) in pieces.items():
        yield 0, (np.array([i], np.int32), bits, solve(xx, xy, n))


def _sent(rows: RDD, bundles: RDD, blocks: int) -> RDD:
    """Per block first what it is sent, then its bundles; these stay in place."""
    sent = rows.partitionBy(blocks, _same).mapPartitions(iter, preservesPartitioning=True)
    return rows.context.union([sent, bundles])


def _factor_rows(batches: Iterable[pa.RecordBatch], rank: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, factors in zip(batch.column(0), batch.column(1), strict=True):
            of = pa.array(np.frombuffer(ids.as_buffer(), np.int32))
            flat = pa.array(np.frombuffer(factors.as_buffer(), np.float32))
            ends = pa.array(np.arange(0, len(flat) + 1, rank, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([of, pa.ListArray.from_arrays(ends, flat)], ["id", "features"])


def _id_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids in batch.column(0):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(ids.as_buffer(), np.int32))], ["id"])


def _start_rows(batches: Iterable[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        factors = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        at = _block(ids, blocks)
        some = np.unique(at)
        yield pa.RecordBatch.from_arrays([
            pa.array(some.astype(np.int32)),
            pa.array([ids[at == b].tobytes() for b in some], pa.binary()),
            pa.array([factors[at == b].tobytes() for b in some], pa.binary())], ["block", "ids", "factors"])


def fit(ratings: DataFrame, user: str, item: str, rating: str, rank: int, max_iter: int, reg: float, seed: int,
        checkpoint_interval: int, blocks: int, bundle: int = BUNDLE) -> ALSModel:
    spark = ratings.sparkSession
    folder = ensure_checkpoint_dir(spark).rstrip("/")
    als = ALS(rank=rank, maxIter=0, regParam=reg, userCol=user, itemCol=item, ratingCol=rating, coldStartStrategy="drop",
              seed=seed, numUserBlocks=START_BLOCKS, numItemBlocks=START_BLOCKS)
    if max_iter == 0:
        return als.fit(ratings)
    # ALS's own checks of ids and ratings, on the ends of their values (a null is the least)
    ends = [F.struct(*[f(F.struct(c))[c].alias(c) for c in (user, item, rating)]) for f in (F.min, F.max)]
    ends = spark.createDataFrame(ratings.agg(F.array(*ends).alias("ends")).select(F.inline("ends")).collect(), ratings.select(user, item, rating).schema)
    als.fit(ends)
    plain = ratings.select(F.col(user).cast("int").alias("u"), F.col(item).cast("int").alias("i"), F.col(rating).cast("float").alias("rating"))
    by_user, by_item = (_laid(plain, a, b, blocks, bundle).persist(StorageLevel.MEMORY_AND_DISK) for a, b in (("u", "i"), ("i", "u")))
    # the starting factors depend on the users alone
    known = spark.createDataFrame(by_user.map(lambda row: (row[1][1].tobytes(),)), "ids binary").mapInArrow(_id_rows, "id int")
    least = ends.limit(1).select(item, rating)
    start = als.fit(known.withColumnRenamed("id", user).crossJoin(F.broadcast(least)))
    needs, routed = partial(_needs, blocks=blocks), partial(_routed, blocks=blocks)
    numbered = partial(_numbered, block_of=partial(_block, blocks=blocks), blocks=blocks)
    users = _sent(by_item.flatMap(needs), by_user, blocks).mapPartitions(numbered, preservesPartitioning=True)
    items = _sent(by_user.flatMap(needs), by_item, blocks).mapPartitions(numbered, preservesPartitioning=True)
    kept = [x.persist(StorageLevel.MEMORY_AND_DISK) for x in (users, items)]
    for x in kept:
        x.count()
    by_user.unpersist()
    by_item.unpersist()

    drawn = start.userFactors.mapInArrow(partial(_start_rows, blocks=blocks), "block int, ids binary, factors binary").rdd.map(
        lambda r: (r.block, _packed(np.frombuffer(r.ids, np.int32), np.frombuffer(r.factors, np.float32).reshape(-1, rank))))
    of_users = _sent(drawn, users, blocks).mapPartitions(_begun)
    solved = partial(_solved, reg=reg)
    for k in range(max_iter):
        of_items = _sent(of_users.flatMap(routed), items, blocks).mapPartitions(solved)
        if k == max_iter - 1:
            kept.append(of_items.persist(StorageLevel.MEMORY_AND_DISK))
        of_users = _sent(of_items.flatMap(routed), users, blocks).mapPartitions(solved)
        if checkpoint_interval > 0 and (k + 1) % checkpoint_interval == 0 and k < max_iter - 1:
            of_users.persist(StorageLevel.MEMORY_AND_DISK).checkpoint()
            of_users.count()
            kept.append(of_users)

    path = f"{folder}/als-{uuid.uuid4().hex}"
    start.save(path)
    for name, factors in (("userFactors", of_users), ("itemFactors", of_items)):
        rows = spark.createDataFrame(factors.map(lambda p: (p[1][0].tobytes(), p[1][2].tobytes())), "ids binary, factors binary")
        rows.mapInArrow(partial(_factor_rows, rank=rank), "id int, features array<float>").write.mode("overwrite").parquet(f"{path}/{name}")
    for x in kept:
        x.unpersist()
    return ALSModel.load(path)
