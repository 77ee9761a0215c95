"""Join operators.

Join strategy is left to the planner: with AQE on, a side that turns out
small at run time is broadcast, otherwise both sides shuffle on the key and
skewed partitions are split.  Explicit broadcasts are used only for sides
with a bound known in advance (fixed dimensions, a single target's
raters after a size check)."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage, ship

PIECE = 1 << 16           # characters of a text that are in work at a time
SLOTS = 17, 30            # least and most bits of a slot number in the filter of wanted passages
PROBES = 1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
HEAD = 12                 # characters of a longer passage that are looked up first
_BASE = 0x9E3779B97F4A7C15


def enrich(df: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]], how: str = "left") -> DataFrame:
    """Repeated left-join enrichment chain."""
    out = df
    for dim, on in dims:
        out = out.join(dim, list(on), how)
    return out


def lookup_dimension(df: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Join a dimension (names for ids).  Whether it is broadcast is
    left to the planner, which knows its size in bytes when it runs."""
    return df.join(dim, on, "left")


def self_reference_fill(df: DataFrame, key: str, ref: str, cols: Sequence[str]) -> DataFrame:
    """Rows that point at another row (``ref`` = that row's ``key``)
    take their ``cols`` from it when their own are missing."""
    src = df.select(F.col(key).alias("_rk"), *[F.col(c).alias(f"_r_{c}") for c in cols])
    j = df.join(src, F.col(ref) == F.col("_rk"), "left")
    return j.select(*[F.coalesce(F.col(f"_r_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def prefix_match(posts: DataFrame, candidates: DataFrame, handle: str, text: str, key: str,
                 prefix_len: int = 30) -> DataFrame:
    """D8, as its SQL has it: resolve each post to the earliest candidate with
    the same handle and the same first ``prefix_len`` characters.  Candidates
    that hold them at a later place are found by ``containment_match``.

    An equi-join on (handle, prefix) does the matching, so the candidate
    set per post is never enumerated; the earliest match per post is a
    partial ``min`` aggregate."""
    p = posts.select(key, handle, F.substring(text, 1, prefix_len).alias("_pre"))
    c = candidates.select(F.col(key).alias("_cid"), F.col(handle).alias("_h"),
                          F.substring(text, 1, prefix_len).alias("_cpre"))
    j = p.join(c, (F.col(handle) == F.col("_h")) & (F.col("_pre") == F.col("_cpre")) & (F.col("_cid") != F.col(key)))
    return j.groupBy(key).agg(F.min("_cid").alias("matched_id"))


class _Passages:
    """Filter of passages of given lengths, looked up at every place of a text
    by a rolling hash over its characters: ``PROBES`` bits stand for a passage,
    and as many for the first ``HEAD`` characters of a longer one, so that most
    places are settled by one look for all lengths."""

    def __init__(self, lengths: Sequence[int], bits: int):
        self.lengths, self.shift = sorted(n for n in lengths if n), np.uint64(64 - bits)
        self.overlap = max(self.lengths, default=1) - 1
        self.up, self.down = (self._powers(b) for b in (_BASE, pow(_BASE, -1, 1 << 64)))

    def _powers(self, base: int) -> np.ndarray:
        p = np.full(PIECE + self.overlap + 1, base, np.uint64)
        p[0] = 1
        return np.cumprod(p, dtype=np.uint64)

    def _sums(self, text: str) -> np.ndarray:
        x = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * self.up[:len(x)], dtype=np.uint64)])

    def _hashes(self, sums: np.ndarray, at: np.ndarray, n: int, salt: np.ndarray) -> np.ndarray:
        h = (sums[at + n] - sums[at]) * self.down[at] ^ salt
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)

    def slots(self, passage: str, salt: int) -> list[int]:
        """The slots that are set for a wanted passage."""
        sums, first, n, of = self._sums(passage), np.zeros(1, np.int64), len(passage), np.array([salt % (1 << 64)], np.uint64)
        made = [self._hashes(sums, first, m, of)[0] for m in ({n, HEAD} if n > HEAD else {n} if n else ())]
        return [int((h * np.array([p], np.uint64))[0] >> self.shift) for h in made for p in PROBES]

    def found(self, pieces: Sequence[str], salts: Sequence[int], filled: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(length, places in the joined pieces whose passage lies within its
        piece and passes the filter).  Pieces are looked up together, at most
        ``PIECE`` places and an overlap, so that short texts cost no more a
        character than long ones."""
        sums = self._sums("".join(pieces))
        many = np.array([len(p) for p in pieces])
        ends, salt = np.repeat(np.cumsum(many), many), np.repeat(np.array([s % (1 << 64) for s in salts], np.uint64), many)

        def passed(at: np.ndarray, n: int) -> np.ndarray:
            at = at[at + n <= ends[at]]
            h = self._hashes(sums, at, n, salt[at])
            for p in PROBES:
                slot = (h * np.uint64(p)) >> self.shift
                keep = np.flatnonzero(filled[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
                at, h = at[keep], h[keep]
            return at

        every = np.arange(len(ends))
        heads = passed(every, HEAD) if self.overlap >= HEAD else every
        for n in self.lengths:
            yield n, passed(heads if n > HEAD else every, n)


def containment_match(posts: DataFrame, candidates: DataFrame, handle: str, text: str, key: str,
                      prefix_len: int = 30) -> DataFrame:
    """D8, as the reference has it: resolve each post to the earliest other
    candidate with the same handle whose text contains, at any place, the
    post's first ``prefix_len`` characters (all of a shorter post).

    Every place of every candidate's whole text is looked up in a filter of
    the wanted passages (a bit set of bounded size, one pass in numpy); only
    passages that it lets through become rows, and an equi-join on (handle,
    passage) settles them exactly.  The two smallest ids of a passage answer
    every post that begins with it, so no pair of posts is formed."""
    spark = posts.sparkSession
    ship(spark)
    wanted = posts.select(F.col(key).alias("_id"), F.col(handle).alias("_h"), F.substring(text, 1, prefix_len).alias("_pre"))
    wanted = wanted.where("_h is not null and _pre is not null")
    keys = cut_lineage(wanted.select("_h", "_pre").distinct())
    lengths = [r[0] for r in keys.select(F.char_length("_pre")).distinct().collect()]       # at most prefix_len + 1
    if not lengths:
        return wanted.limit(0).select(F.col("_id").alias(key), F.col("_id").alias("matched_id"))
    low, high = SLOTS
    bits = min(high, max(low, (128 * keys.count()).bit_length()))
    passages = _Passages(lengths, bits)

    def slots_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [slot for t, salt in zip(*(c.to_pylist() for c in batch.columns), strict=True) for slot in passages.slots(t, salt)]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.int64())], names=["slot"])

    salt = F.xxhash64("_h").alias("salt")
    # the bitmap functions count from 1
    taken = keys.select("_pre", salt).mapInArrow(slots_of, "slot long").select((F.col("slot") + 1).alias("slot"))
    taken = taken.groupBy(F.bitmap_bucket_number("slot").alias("part"))
    filled = np.zeros((1 << bits) // 8, np.uint8)
    for part, some in taken.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot"))).toLocalIterator():
        at = (part - 1) * len(some)
        here = filled[at:at + len(some)]
        here |= np.frombuffer(some, np.uint8)[:len(here)]
    seen = spark.sparkContext.broadcast(filled)

    def packs(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[str], list[int]]]:
        """Rows, pieces of their texts and salts, as many as are looked up together."""
        pack, size = ([], [], []), 0
        for i, (t, salt) in enumerate(zip(batch.column("text").to_pylist(), batch.column("salt").to_pylist(), strict=True)):
            for a in range(0, len(t), PIECE):
                piece = t[a:a + PIECE + passages.overlap]
                if size + len(piece) > PIECE + passages.overlap:
                    yield pack
                    pack, size = ([], [], []), 0
                for one, value in zip(pack, (i, piece, salt), strict=True):
                    one.append(value)
                size += len(piece)
        if size:
            yield pack

    def passages_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [(i, "") for i in range(batch.num_rows)] if 0 in lengths else []
            for found in itertools.chain([whole], (held(*pack) for pack in packs(batch))):
                of = pa.array([i for i, _ in found], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("_cid").take(of), batch.column("_h").take(of), pa.array([t for _, t in found], pa.string())],
                                                 names=["_cid", "_h", "_pre"])

    def held(of: list[int], pieces: list[str], salts: list[int]) -> set[tuple[int, str]]:
        text, starts, got = "".join(pieces), np.cumsum([0, *map(len, pieces)]), set()
        for n, places in passages.found(pieces, salts, seen.value):
            which = np.searchsorted(starts, places, side="right") - 1
            got.update((of[k], text[i:i + n]) for k, i in zip(which.tolist(), places.tolist(), strict=True))
        return got

    rows = candidates.select(F.col(key).alias("_cid"), F.col(handle).alias("_h"), F.col(text).alias("text"))
    rows = rows.where("_cid is not null and _h is not null and text is not null").withColumn("salt", F.xxhash64("_h"))
    found = rows.mapInArrow(passages_of, rows.select("_cid", "_h").schema.add("_pre", "string"))
    order = Window.partitionBy("_h", "_pre").orderBy("_cid")
    two = found.withColumn("_n", F.dense_rank().over(order)).where("_n <= 2")
    best = cut_lineage(two.groupBy("_h", "_pre").agg(F.min("_cid").alias("_first"), F.max("_cid").alias("_second")))
    out = wanted.join(best, ["_h", "_pre"]).withColumn("_m", F.when(F.col("_first") != F.col("_id"), F.col("_first")).otherwise(F.col("_second")))
    return out.where("_m <> _id").groupBy(F.col("_id").alias(key)).agg(F.min("_m").alias("matched_id"))


def complete_dimension(dim: DataFrame, facts: DataFrame, key: str, first_col: str, help_pred: Column) -> DataFrame:
    """Add default rows for keys seen only in the facts; the arm of a
    new key is inferred from whether it ever received help."""
    new = (facts.join(dim.select(key), key, "left_anti")
           .groupBy(key).agg(F.min(first_col).alias("first_session"), F.bool_or(help_pred).alias("_help")))
    new = new.select(key, F.when(F.col("_help"), 1).otherwise(0).alias("arm"), "first_session",
                     F.lit(True).alias("inferred"))
    old = dim.select(key, "arm", F.lit(None).cast("timestamp_ntz").alias("first_session"), F.lit(False).alias("inferred"))
    return old.unionByName(new)


def backfill_from_facts(dim: DataFrame, facts: DataFrame, key: str, col: str, fact_col: str) -> DataFrame:
    """Fill a missing date from the earliest related fact."""
    first = facts.groupBy(key).agg(F.min(fact_col).alias("_first"))
    return dim.join(first, key, "left").select(
        *[F.coalesce(F.col(col), F.col("_first")).alias(col) if c == col else F.col(c) for c in dim.columns])


def bind_columns(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Column-bind by an explicit row key (never by position)."""
    return a.join(b, key, "inner")
