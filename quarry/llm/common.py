"""Shared small helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import uuid
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

BLANKS = "\\x20\\x09-\\x0D"   # the white space of every contract: space and U+0009..U+000D


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and
    read back: cuts lineage, survives lost executors, is computed once."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Passes over whole texts get batches of at most ``BATCH_ROWS`` rows, so
    that what is in flight between Spark and a Python worker stays small.  A
    session that has set another length than Spark's default keeps it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; when they are through, the worker's free memory goes back
    to the system (Spark keeps workers for later passes)."""
    yield from batches
    _POWERS.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):      # another C library
            pass


def python_pass(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with bounded batches and memory."""
    bounded_batches(df.sparkSession)
    return df.mapInArrow(lambda batches: released(fn(batches)), schema)


CARRIED = ["kept", "body"]


def kept_columns(docs: DataFrame, keep: list[str], text_col: str, *more: Column) -> tuple[DataFrame, list]:
    """Rows with ``text`` and the other columns to carry along as the struct
    ``kept`` (``body``: the text once more only if it is to be carried but is
    no string, else null), and the columns to select afterwards.  ``more`` are
    columns beside these; names of ``docs`` cannot clash with theirs."""
    text = F.col(f"`{text_col}`")
    own = text_col in keep and docs.select(text).schema[0].dataType.simpleString() == "string"
    others = [F.col(f"`{c}`") for c in keep if not (own and c == text_col)] or [F.lit(None).cast("int").alias("none")]
    rows = docs.select(F.struct(*others).alias("kept"), text.cast("string").alias("text"), F.lit(own).alias("own"), *more)
    back = [F.col("body").alias(c) if own and c == text_col else F.col("kept").getField(c).alias(c) for c in keep]
    return rows.withColumn("body", F.lit(None).cast("string")), back


def carried(part: pa.RecordBatch) -> list[pa.Array]:
    """The columns ``CARRIED`` of a pass over ``kept_columns``."""
    own = part.num_rows and part.column("own")[0].as_py()
    return [part.column("kept"), part.column("text") if own else pa.nulls(part.num_rows, pa.string())]


class Known(dict):
    """Answers of ``answer`` for the keys seen, a bounded number of them: at
    ``most`` entries all but the first ``keep`` go (the first keys that a
    stream of words shows are its frequent ones).  Keys longer than
    ``longest`` are answered but not kept."""

    def __init__(self, answer: Callable, most: int, keep: int, longest: int):
        super().__init__()
        self.answer, self.most, self.keep, self.longest = answer, most, keep, longest

    def __missing__(self, key):
        got = self.answer(key)
        if len(key) <= self.longest:
            self[key] = got
        return got

    def bound(self) -> None:
        if len(self) > self.most:
            self.trim()

    def trim(self) -> None:
        if len(self) > self.keep:
            first = dict(islice(self.items(), self.keep))
            self.clear()
            self.update(first)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the ``text`` column of a slice holds about
    ``max_bytes`` (one row at least): the working set of a task stays bounded
    whatever Spark's batch length is."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        group = (np.cumsum(lengths) - lengths) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(a, b - a)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets (null: empty)."""
    col = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


BATCH_ROWS = 1000
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i in [0, n); base is odd."""
    size = max(1 << 16, -(-int(n) // (1 << 16)) * (1 << 16))
    if base in _POWERS and len(_POWERS[base][0]) >= size:
        return _POWERS[base]
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    _POWERS[base] = tuple(out)
    return _POWERS[base]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), in place where possible."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_BASE = 0x9E3779B97F4A7C15


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, independent of its place in ``raw``."""
    up, down = powers(BYTE_BASE, len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def place_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span: the sum of a mixed value of every byte
    with its place in the span, so that no algebra of the bytes (as that of a
    polynomial modulo 2**64) makes two different spans meet."""
    at = np.arange(len(raw), dtype=np.int64)
    first = np.zeros(len(raw), np.int64)
    first[starts] = starts
    place = (at - np.maximum.accumulate(first)).astype(np.uint64)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(mix((place << np.uint64(8) | raw) * np.uint64(BYTE_BASE) + np.uint64(BYTE_BASE)), out=total[1:])
    return mix(total[ends] - total[starts] + (ends - starts).astype(np.uint64))


def word_spans(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the words of every row; ``separator``
    is a table of 256 booleans.  A word never crosses a row boundary."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~separator[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(raw), bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(len(raw), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def blank_table() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[0x20, 9, 10, 11, 12, 13]] = True
    return t
