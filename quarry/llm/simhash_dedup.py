"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets a nonzero vector of r + 1 bits; table v (one per
nonzero vector v, 2^(r+1) - 1 tables) keeps the positions whose vector has odd
overlap with v.  The positions in which two fingerprints within distance r
differ span at most r dimensions, so some v is orthogonal to all of them and
the two agree on everything that table v keeps: no near pair is missed.

Equal fingerprints are one node.  A table's bucket of nodes is linked by a
spanning forest of its near pairs, never by all pairs.  A bucket with more
nodes than ``BUCKET`` is not gathered: its nodes are dealt again by the same
covering on the positions that the table dropped (its nodes agree on the
others), which keeps every near pair of the bucket, until buckets are small or
so few positions are left that the bucket cannot be large.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import blank_table, python_pass, released, slices, utf8, word_spans, written

SHINGLE, RADIUS, SEED = 3, 3, 42
BUCKET = 2048             # nodes that are compared in one group
FREE = 10                 # positions left: at most 2^10 nodes in a bucket
CHUNK = 1 << 16           # shingles in work at a time

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = np.arange(97, 123)
_BLANK = blank_table()


# ---------------------------------------------------------------- fingerprints
def _fingerprint(norm: bytes, starts: list[int], ends: list[int], size: int) -> int:
    """Majority bits of the shingles of one text (words joined by one blank)."""
    n = len(starts)
    if not n:
        return 0
    total, votes = max(1, n - size + 1), np.zeros(64, np.int64)
    for a in range(0, total, CHUNK):
        b = min(total, a + CHUNK)
        last = ends[a + size - 1:b + size - 1] if n >= size else ends[-1:]
        digest = xxhash.xxh64_intdigest
        h = np.array([digest(norm[s:e], SEED) for s, e in zip(starts[a:b], last, strict=True)], np.uint64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > total, bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``fp`` long (the 64 bits, signed) per row of ``docs``; null texts and
    texts without a word have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            raw, offsets = utf8(part.column("text"))
            raw = _LOWER[raw]
            starts, ends, row = word_spans(raw, offsets, _BLANK)
            edge = np.searchsorted(row, np.arange(len(offsets)))
            # the words of a slice, one blank after each: a shingle is a span of it
            length = ends - starts
            at = np.cumsum(length + 1) - (length + 1)
            norm = np.full(int((length + 1).sum()), 32, np.uint8)
            if len(starts):
                inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
                norm[np.repeat(at, length) + inside] = raw[np.repeat(starts, length) + inside]
            blob, first, last = norm.tobytes(), at.tolist(), (at + length).tolist()
            out = [_fingerprint(blob, first[a:b], last[a:b], shingle) for a, b in zip(edge[:-1], edge[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.array(out, np.uint64).view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return python_pass(rows, run, "id long, fp long").withColumnRenamed("id", id_col)


# ---------------------------------------------------------------- covering
def covering_masks(radius: int, positions: int, rng_seed: int = 9) -> list[int]:
    """Masks over the 64 positions (only those set in ``positions`` count):
    any ``radius`` of them are dropped together by some mask."""
    dim = radius + 1
    where = [i for i in range(64) if positions >> i & 1]
    vectors = np.arange(1, 1 << dim)
    rng = np.random.default_rng(rng_seed + len(where))
    given = np.resize(vectors, len(where))
    rng.shuffle(given)
    masks = []
    for v in range(1, 1 << dim):
        masks.append(sum(1 << i for i, g in zip(where, given, strict=True) if bin(int(g) & v).count("1") & 1))
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_forest(values: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links between distinct bit vectors within ``radius`` that join the same
    vectors as all near pairs do: one fewer than the vectors of a component.
    A vector is compared with those that no link has reached yet."""
    left = np.arange(len(values))
    a: list[int] = []
    b: list[int] = []
    while len(left) > 1:
        open_ = [int(left[0])]
        left = left[1:]
        while open_ and len(left):
            x = open_.pop()
            near = np.bitwise_count(values[left] ^ values[x]) <= radius
            if near.any():
                hits = left[near].tolist()
                a += [x] * len(hits)
                b += hits
                open_ += hits
                left = left[~near]
    return a, b


def _link_sorted(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of every bucket of a partition that is sorted by bucket key; the
    last bucket of a batch waits for the next batch (buckets are bounded)."""
    keys, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def links(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        edge = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1 if len(keys) else 0))
        size = np.diff(np.append(edge, len(keys)))
        two = edge[size == 2]
        two = two[np.bitwise_count(values[two] ^ values[two + 1]) <= radius]
        a, b = [values[two]], [values[two + 1]]
        for start, n in zip(edge[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            part = values[start:start + n]
            i, j = near_forest(part, radius)
            a.append(part[i])
            b.append(part[j])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.concatenate([keys, np.asarray(batch.column("key"))])
        values = np.concatenate([values, np.asarray(batch.column("fp")).view(np.uint64)])
        whole = int(np.searchsorted(keys, keys[-1]))
        if whole:
            yield links(keys[:whole], values[:whole])
            keys, values = keys[whole:], values[whole:]
    if len(keys):
        yield links(keys, values)


def near_links(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect the same
    nodes as all pairs within ``radius`` bits do."""
    spark = nodes.sparkSession
    found = spark.createDataFrame([], "a long, b long")
    rows = nodes.select("fp", F.lit(0).cast("long").alias("key"), F.lit(0).alias("path"))
    paths = {0: (1 << 64) - 1}                       # positions on which a bucket's nodes may still differ
    while True:
        table, below = [], {}
        for path, positions in paths.items():
            for v, mask in enumerate(covering_masks(radius, positions), 1):
                at = (path << (radius + 1)) + v
                table.append((path, at, _signed(mask)))
                below[at] = positions & ~mask
        if len(paths) == 1:
            at = F.explode(F.array(*[F.struct(F.lit(a).alias("at"), F.lit(m).alias("mask")) for _, a, m in table]))
            tables = rows.select("fp", "key", at.alias("t")).select("fp", "key", "t.at", "t.mask")
        else:                                        # 225 or 3375 rows
            tables = rows.join(F.broadcast(spark.createDataFrame(table, "path int, at int, mask long")), "path")
        dealt = tables.select("fp", F.xxhash64("key", "at", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), F.col("at").alias("path"))
        sizes = written(dealt.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
        last = max(bin(p).count("1") for p in below.values()) <= FREE
        small = dealt.join(sizes if last else sizes.where(F.col("n") <= bucket), "key").select("key", "fp")
        found = found.unionByName(small.repartition("key").sortWithinPartitions("key", "fp")
                                  .mapInArrow(lambda batches: released(_link_sorted(batches, radius)), "a long, b long"))
        if last or sizes.where(F.col("n") > bucket).isEmpty():
            return found
        rows = written(dealt.join(sizes.where(F.col("n") > bucket), "key").select("fp", "key", "path"))
        paths = below


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node, root being the smallest node that it
    can reach: alternating large and small stars, each round written out."""
    pairs = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that both sides of the joins are dealt for them alone and Spark can split a hot node
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = written(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        lower = written(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(lower.select("u", F.col("m").alias("v"))).distinct())
        pairs = written(small)
        now = tuple(pairs.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")).first())
        if now == seen:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = now


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, id_col: str = "doc_id",
                    text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links of ``radius`` or
    fewer differing bits.

    Null, empty and blank texts have fingerprint zero and link like any other.
    Repeated rows keep a row each and are in one class.  Rows without an id get
    the class of their fingerprint (null if no row of the class has an id).
    Other columns are ignored; an empty table gives an empty result.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle).select(F.col(id_col).alias("id"), "fp"))
    nodes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(near_links(nodes.select("fp"), radius, bucket))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted)
    classes = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    named = rooted.join(classes, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                         "component_id")
