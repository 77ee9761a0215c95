"""Packing of token sequences by Karmarkar-Karp multiway differencing.

Documents are encoded where they are read; nothing but the pieces leaves a
task.  A document's full windows are cut off as they are; the rests of a block
of documents are spread over k windows by differencing: every rest starts as a
partition of k windows with one filled, and the two partitions with the
largest imbalance are merged again and again, the fullest windows of one onto
the emptiest of the other.  k starts at the least number that could hold the
block and rises whenever a window exceeds the capacity.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import bpe
from quarry.llm.common import python_pass, slices

WINDOW = 4096
BLOCK = 2048              # rests that are differenced together


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window of each size, by multiway differencing over ``k`` windows."""
    n = len(sizes)
    if k <= 1:
        return np.zeros(n, np.int64)
    sums: list[np.ndarray | None] = []
    for s in sizes.tolist():
        first = np.zeros(k, np.int64)
        first[-1] = s
        sums.append(first)
    made: list[tuple[int, int, np.ndarray]] = []      # left, right, order of the merged windows
    heap = [(-s, i) for i, s in enumerate(sizes.tolist())]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = sums[a] + sums[b][::-1]
        order = np.argsort(total, kind="stable")
        total = total[order]
        total -= total[0]
        sums[a] = sums[b] = None
        sums.append(total)
        made.append((a, b, order.astype(np.int32)))
        heapq.heappush(heap, (-int(total[-1]), len(sums) - 1))
    window = np.zeros(n, np.int64)
    places = {heap[0][1]: np.arange(k)}
    for node in range(n + len(made) - 1, n - 1, -1):
        a, b, order = made[node - n]
        here = places.pop(node)
        left = np.empty(k, np.int64)
        left[order] = here                            # window j of the left part lies where order == j
        for child, at in ((a, left), (b, left[::-1])):
            if child < n:
                window[child] = at[-1]
            else:
                places[child] = at
    return window


def windows_of(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window numbers with no window above ``capacity`` (sizes are below it)."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, k)
        most = np.bincount(window, weights=sizes, minlength=k).max()
        if most <= capacity:
            return window
        # so many more that windows as uneven as these would fit, one at least
        room = max(1.0, capacity - (most - sizes.sum() / k))
        k = min(len(sizes), max(k + 1, int(np.ceil(sizes.sum() / room))))


def _pack_block(lengths: list[int], capacity: int, first_sequence: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(row, start, length, sequence, offset) of each piece; the next sequence."""
    pieces, rest_row, rest = [], [], []
    seq = first_sequence
    for row, n in enumerate(lengths):
        for start in range(0, n - n % capacity, capacity):
            pieces.append((row, start, capacity, seq, 0))
            seq += 1
        if n % capacity:
            rest_row.append(row)
            rest.append(n % capacity)
    if rest:
        window = windows_of(np.asarray(rest, np.int64), capacity)
        used = {w: i for i, w in enumerate(sorted(set(window.tolist())))}
        fill = [0] * len(used)
        for row, size, w in zip(rest_row, rest, window.tolist(), strict=True):
            j = used[w]
            pieces.append((row, lengths[row] - size, size, seq + j, fill[j]))
            fill[j] += size
        seq += len(used)
    return pieces, seq


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = WINDOW, block: int = BLOCK,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of encoded documents in sequences of at most ``capacity`` ids.

    Returns per piece: id, ``start`` (ids of the document before it),
    ``length``, ``ids`` binary (little-endian unsigned 32-bit), ``doc_tokens``
    (with the end id), ``sequence_id`` and ``offset``.  Every id of a document
    and its end id lie in exactly one piece; the pieces of a sequence fill it
    from 0 without gaps.  Null and empty texts are one end id.  Repeated rows
    and null ids are packed like any other row; other columns are ignored.  An
    empty table gives no piece.  A task holds one block of rests (at most
    ``block`` documents or 64 MB of ids) at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.encoder(vocabulary)
        end = np.asarray([end_id], "<u4").tobytes()
        seq = TaskContext.get().partitionId() << 40
        ids: list[int | None] = []
        blobs: list[bytes] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal seq, ids, blobs, held
            lengths = [len(b) // 4 for b in blobs]
            pieces, seq = _pack_block(lengths, capacity, seq)
            for a in range(0, len(pieces), 4096):
                part = pieces[a:a + 4096]
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[p[0]] for p in part], pa.int64()),
                    pa.array([p[1] for p in part], pa.int64()), pa.array([p[2] for p in part], pa.int64()),
                    pa.array([blobs[p[0]][4 * p[1]:4 * (p[1] + p[2])] for p in part], pa.binary()),
                    pa.array([lengths[p[0]] for p in part], pa.int64()),
                    pa.array([p[3] for p in part], pa.int64()), pa.array([p[4] for p in part], pa.int64())],
                    names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            ids, blobs, held = [], [], 0

        for part in slices(batches, "text"):
            for doc, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                ids.append(doc)
                blobs.append(enc.encode_bytes(text or "") + end)
                held += len(blobs[-1])
                if len(ids) >= block or held >= 64 << 20:
                    yield from flush()
        if ids:
            yield from flush()
        enc.table.trim()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = python_pass(rows, run, "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)


def assemble(pieces: DataFrame, capacity: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """One row per sequence: ``ids`` binary padded to ``capacity`` (not where
    the length is a power of two) and ``n_tokens``.  A sequence has at most
    ``capacity`` ids, so its group is bounded."""
    parts = pieces.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("n_tokens"))
    joined = F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    pad = F.unhex(F.lit(int(pad_id).to_bytes(4, "little").hex()))
    whole = F.expr("cast(n_tokens as int)").bitwiseAND(F.expr("cast(n_tokens as int) - 1")) == 0
    missing = F.when(whole, 0).otherwise(F.lit(capacity) - F.col("n_tokens")).cast("int")
    padded = F.concat(joined, F.aggregate(F.array_repeat(pad, missing), F.lit(b""), lambda acc, p: F.concat(acc, p)))
    return parts.select("sequence_id", "n_tokens", padded.alias("ids"))
