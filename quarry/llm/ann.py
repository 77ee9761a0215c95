"""Approximate nearest neighbours with randomly rotated one-bit codes.

A vector is padded with zeros to a multiple of 64 dimensions, turned by one
random rotation and stored as the signs of its coordinates (one packed bit
each) with two correction scalars: its length (as a logarithm, so that no
finite vector overflows) and the inner product of the unit vector with its
code.  A query is turned likewise and its coordinates are rounded to
``QUERY_BITS`` bits; its inner product with a code is a weighted sum of bit
counts of the packed words.  That estimates the inner product with the vector,
with an error bound that holds with high probability; per block of rows only
vectors whose upper bound reaches the ``k``-th best lower bound are reranked
by the exact inner product of the original vectors.

The index holds every row.  Queries are a stated set; they are broadcast in
blocks of bounded size (``QUERY_BLOCK`` vectors); each block scans the index
once and its result is written before the next one starts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import python_pass, written

BITS = 64                 # least length of a code, a multiple of 64; else the vectors' dimension rounded up to one
QUERY_BITS = 6            # bits of a query's coordinate
ERROR = 1.9               # width of the error bound in standard deviations of the estimate
ROWS = 8192               # vectors of an index block
QUERY_BLOCK = 8192        # queries that are broadcast together (bounds the driver's share)
TOGETHER = 256            # queries that meet an index block at a time


def rotation(bits: int, seed: int = 17) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))
    return q * np.sign(np.diag(r))


def code_bits(dim: int, bits: int = BITS) -> int:
    return max(bits, -(-dim // 64) * 64)


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, logarithms (base 2) of the lengths, and inner products
    of unit vector and code."""
    unit, length = directions(vectors)
    turned = unit @ turn[:vectors.shape[1]]
    return np.packbits(turned > 0, axis=1), length, np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[0])


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and the logarithms (base 2) of the lengths, for any finite
    vectors but zero: nothing overflows or vanishes on the way."""
    most = np.abs(vectors).max(axis=1, keepdims=True)
    part, power = np.frexp(vectors)
    even = np.ldexp(part, np.maximum(power - np.frexp(most)[1], -2000))
    norm = np.linalg.norm(even, axis=1)
    return even / norm[:, None], np.frexp(most)[1][:, 0] + np.log2(norm)


def query_planes(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Turned unit queries with coordinates rounded to ``QUERY_BITS`` bits:
    the packed bits of each weight (weights by queries by 64-bit words), the
    least value and the step of each query."""
    low = turned.min(axis=1, keepdims=True)
    step = np.maximum(turned.max(axis=1, keepdims=True) - low, 1e-300) / ((1 << QUERY_BITS) - 1)
    level = np.rint((turned - low) / step).astype(np.uint8)
    planes = [np.packbits(level >> j & 1, axis=1).view(np.uint64) for j in range(QUERY_BITS)]
    return np.stack(planes), low, step


def _valid(vectors: list, dim: int | None) -> np.ndarray:
    """Which vectors take part: not null or zero, no null or non-finite part."""
    ok = np.zeros(len(vectors), bool)
    for i, v in enumerate(vectors):
        if v is not None and len(v) and (dim is None or len(v) == dim):
            ok[i] = all(x is not None for x in v) and bool(np.isfinite(a := np.asarray(v, np.float64)).all()) and bool(a.any())
    return ok


def build_index(rows: DataFrame, dim: int, id_col: str = "vec_id", vector_col: str = "embedding", bits: int = BITS) -> DataFrame:
    """Every valid row in blocks of at most ``ROWS``: ids, original vectors
    (double), packed codes, norms and corrections as binary columns."""
    width = code_bits(dim, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(width)
        ids: list[np.ndarray] = []
        vectors: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            i, v = np.concatenate(ids), np.concatenate(vectors)
            code, norm, fit = encode(v, turn)
            ids.clear()
            vectors.clear()
            return pa.RecordBatch.from_arrays([pa.array([len(i)], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (i, v, code, norm, fit))],
                                              names=["n", "ids", "vectors", "codes", "norms", "fits"])

        for batch in batches:
            raw = batch.column("v").to_pylist()
            ok = np.flatnonzero(_valid(raw, dim))
            own = np.asarray(batch.column("id"))
            for a in range(0, len(ok), ROWS):
                part = ok[a:a + ROWS]
                ids.append(own[part].astype(np.int64))
                vectors.append(np.asarray([raw[j] for j in part], np.float64).reshape(-1, dim))
                if sum(map(len, ids)) >= ROWS:
                    yield block()
        if ids:
            yield block()

    plain = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id is not null")
    return python_pass(plain, run, "n int, ids binary, vectors binary, codes binary, norms binary, fits binary")


def search_block(block: dict, qid: np.ndarray, q: np.ndarray, turn: np.ndarray, k: int, width_of_bound: float = ERROR) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The ``k`` nearest rows of an index block for each query."""
    dim, width = q.shape[1], turn.shape[0]
    ids = np.frombuffer(block["ids"], np.int64)
    vectors = np.frombuffer(block["vectors"], np.float64).reshape(-1, dim)
    codes = np.frombuffer(block["codes"], np.uint64).reshape(-1, width // 64)
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    length, fit = np.frombuffer(block["norms"], np.float64), np.frombuffer(block["fits"], np.float64)
    # of unit queries, and of rows as parts of the longest one: the order and the choice are the same
    norm = np.exp2(length - length.max(initial=-np.inf))
    scale = norm / fit / np.sqrt(width)
    spread = norm * np.sqrt(np.maximum(1 - fit * fit, 0)) / fit * width_of_bound / np.sqrt(width - 1)
    units = directions(q)[0] if len(q) else q
    for a in range(0, len(q), TOGETHER):
        part = q[a:a + TOGETHER]
        planes, low, step = query_planes(units[a:a + TOGETHER] @ turn[:dim])
        bits = np.zeros((len(part), len(ids)), np.int32)
        for j, plane in enumerate(planes):
            for w in range(plane.shape[1]):
                bits += np.bitwise_count(plane[:, w, None] & codes[None, :, w]).astype(np.int32) << j
        # sum of coordinate times sign, the signs being twice the bits less one
        whole = low[:, 0] * width + step[:, 0] * np.stack([np.bitwise_count(p).sum(axis=1, dtype=np.int64) << j for j, p in enumerate(planes)]).sum(axis=0)
        estimate = (2 * (low * ones + step * bits) - whole[:, None]) * scale
        # rounding a coordinate errs by a twelfth of its step squared on the average
        error = spread[None, :] + step * np.sqrt(width / 12) * width_of_bound * scale
        own = qid[a:a + TOGETHER, None] == ids[None, :]
        estimate[own] = -np.inf
        lower = estimate - error
        n = len(ids)
        least = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(part), -np.inf)
        near = (estimate + error >= least[:, None]) & ~own
        for i in range(len(part)):
            hit = np.flatnonzero(near[i])
            with np.errstate(over="ignore", invalid="ignore"):
                score = np.einsum("ij,j->i", vectors[hit], part[i])
            top = np.lexsort((ids[hit], -score))[:k]
            yield int(qid[a + i]), ids[hit][top], score[top]


def search(index: DataFrame, queries: DataFrame, dim: int, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           bits: int = BITS, error: float = ERROR) -> DataFrame:
    """The ``k`` nearest index rows of each query row, its own id left out.

    Returns query_id, ``rank`` int from 1, the neighbour's id and ``score``
    (inner product in double precision), nearest first, ties to the smaller
    id; all candidates if there are fewer than ``k``.  Vectors that are null,
    zero, of another length, or hold null or non-finite components take no
    part on either side, nor do rows without an id.  Repeated rows are
    candidates each; a repeated query id counts once (its largest vector by
    component order).  Other columns are ignored; an empty table gives an
    empty result.
    """
    spark = index.sparkSession
    width = code_bits(dim, bits)
    asked = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    asked = written(asked.where("id is not null and v is not null").groupBy("id").agg(F.max("v").alias("v")))
    n = asked.count()
    blocks = max(1, -(-n // QUERY_BLOCK))
    # a hash spreads the ids evenly; half as many again as the mean is the bound of a block
    placed = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    found = spark.createDataFrame([], "query_id long, rank int, id long, score double")
    for b in range(blocks):
        got = placed.where(F.col("block") == b).select("id", "v").collect()      # about QUERY_BLOCK rows
        raw = [r.v for r in got]
        ok = np.flatnonzero(_valid(raw, dim))
        qid = np.array([got[i].id for i in ok], np.int64)
        q = np.array([raw[i] for i in ok], np.float64).reshape(-1, dim)
        sent = spark.sparkContext.broadcast((qid, q))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            qid, q = sent.value
            turn = rotation(width)
            for batch in batches:
                for block in batch.to_pylist():
                    out = list(search_block(block, qid, q, turn, k, error))
                    if out:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1].tolist() for o in out], pa.list_(pa.int64())),
                             pa.array([o[2].tolist() for o in out], pa.list_(pa.float64()))], names=["query_id", "ids", "scores"])

        each = python_pass(index, run, "query_id long, ids array<long>, scores array<double>").select(
            "query_id", F.explode(F.arrays_zip("scores", "ids")).alias("c"))
        order = Window.partitionBy("query_id").orderBy(F.desc("c.scores"), "c.ids")
        ranked = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        # written, so that the next block's queries take this one's place on the driver and in the workers
        found = found.unionByName(written(ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("c.ids").alias("id"),
                                                        F.col("c.scores").alias("score"))))
        sent.destroy()
    return found.withColumnRenamed("id", id_col)


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            bits: int = BITS, error: float = ERROR) -> DataFrame:
    """Index ``rows`` (all of them, in the dimension most of them have) and
    search ``queries``; see ``search``.  A larger ``error`` reranks more."""
    sizes = rows.where(F.size(vector_col) > 0).groupBy(F.size(vector_col).alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = int(sizes.d) if sizes else 1
    index = written(build_index(rows, dim, id_col, vector_col, bits))
    return search(index, queries, dim, k, id_col, vector_col, bits, error)
