"""Removal of long repeated passages by prefix-partitioned suffix trees.

A repeat is a window of ``WINDOW`` words that also starts in a document with a
smaller id.  Every window is assigned to one of its own word n-grams, the one
with the least hash (its anchor), so equal windows have equal anchors.
Neighbouring windows with the same anchor form a segment; about one word in
twenty is an anchor.

1. Anchors that occur in one document only drop out (one aggregate).
2. Equal segments are one node with the smallest id that has it: a segment
   that a smaller document also has is a repeat as a whole.
3. Segments of one anchor that differ (the edges of repeats) are compared
   window by window.  Their window suffixes, which all pass through the
   anchor's words, are one subtree: its nodes at the depths 1, 2, 4 .. 32 and
   ``WINDOW`` words are named by doubling, and a node at the last depth gives
   the smallest id of its leaves.  Chains of such deep nodes are the maximal
   repeats.
4. An anchor with more than ``GROUP`` different segments is not gathered: its
   suffixes are partitioned by a longer prefix, all ``WINDOW`` words, and
   each such node keeps only its smallest id (aggregated before the shuffle).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import CARRIED, blank_table, carried, kept_columns, mix, place_hashes, powers, python_pass, slices, utf8, word_spans, written

WINDOW = 50
GRAM = 12                 # words of an anchor
GROUP = 2000              # different segments of one anchor that share a tree
TREE_BYTES = 1 << 20      # text of segments that are named together
NO_ID = (1 << 63) - 1     # stands for a missing id: larger than any other

_BLANK = blank_table()
_BASE_A, _BASE_B, _BASE_C = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB
_POS = 28                 # bits of a word's place within a slice of texts


def _sequence_hashes(words: np.ndarray, first: np.ndarray, last: np.ndarray, base: int) -> np.ndarray:
    """Hashes of the word sequences [first, last), independent of their place."""
    up, down = powers(base, len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:len(words)], out=total[1:])
    return mix((total[last] - total[first]) * down[first])


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width`` neighbours, by doubling."""
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(values) - width + 1], out[width - have:]) if width > have else out


def _segments(raw: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> dict[str, np.ndarray]:
    """Segments of a slice of texts: row, first word in the text, number of
    windows, anchor key and a hash of the segment's words."""
    starts, ends, row = word_spans(raw, offsets, _BLANK)
    n = len(starts)
    if n < window:
        return {}
    words = place_hashes(raw, starts, ends)
    at = np.arange(n - gram + 1)
    grams = _sequence_hashes(words, at, at + gram, _BASE_A)
    low = np.uint64((1 << _POS) - 1)
    least = _sliding_min((grams & ~low) | at.astype(np.uint64), window - gram + 1)
    place = np.flatnonzero(row[:n - window + 1] == row[window - 1:])
    if not len(place):
        return {}
    anchor = (least[place] & low).astype(np.int64)
    new = np.ones(len(place), bool)
    new[1:] = (np.diff(place) != 1) | (np.diff(anchor) != 0)
    edge = np.flatnonzero(new)
    first, count = place[edge], np.diff(np.append(edge, len(place)))
    begin = np.searchsorted(row, row[first])
    return {"row": row[first], "start": (first - begin).astype(np.int32), "windows": count.astype(np.int32),
            "anchor": grams[anchor[edge]].view(np.int64),
            "segment": _sequence_hashes(words, first, first + count + window - 1, _BASE_B).view(np.int64)}


def _emit(columns: list[tuple[str, pa.Array]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c for _, c in columns], names=[n for n, _ in columns])


def _taken(column: pa.Array, rows: np.ndarray) -> pa.Array:
    return column.take(pa.array(rows))


def _runs(ids: np.ndarray, texts: pa.Array, starts: np.ndarray, hit: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Runs of neighbouring hit windows: id, text digest, first word, windows.
    ``place`` is each window's segment row; ``starts`` its first word."""
    at = np.flatnonzero(hit)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(place[at]) != 0)
    edge = np.flatnonzero(new)
    size = np.diff(np.append(edge, len(at)))
    lead = at[edge]
    return _emit([("id", pa.array(ids[place[lead]])), ("body", _taken(texts, place[lead])),
                  ("start", pa.array(starts[lead].astype(np.int32))), ("windows", pa.array(size.astype(np.int32)))])


def _names(words: np.ndarray, length: int) -> np.ndarray:
    """Equal numbers for equal word sequences of ``length`` at each place:
    the nodes of the suffix tree at that depth, by doubling."""
    _, name = np.unique(words, return_inverse=True)
    have = 1

    def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64), return_inverse=True)[1]

    while 2 * have <= length:
        name = joined(name[:-have], name[have:])
        have *= 2
    if have < length:
        step = length - have
        name = joined(name[:-step], name[step:])
    return name


def _window_places(begin: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segment row and first word of every window of the given segments."""
    seg = np.repeat(np.arange(len(windows)), windows)
    inside = np.arange(len(seg)) - np.repeat(np.cumsum(windows) - windows, windows)
    return seg, begin[seg] + inside


def _tree(part: pa.RecordBatch, window: int) -> pa.RecordBatch:
    """Repeats within the subtrees of whole anchor groups."""
    raw, offsets = utf8(part.column("text"))
    starts, ends, row = word_spans(raw, offsets, _BLANK)
    ids, texts = np.asarray(part.column("id")), part.column("body")
    first, windows = np.asarray(part.column("start")), np.asarray(part.column("windows"))
    name = _names(place_hashes(raw, starts, ends), window)
    seg, place = _window_places(np.searchsorted(row, np.arange(part.num_rows)), windows)
    node = name[place]
    least = np.full(int(node.max(initial=-1)) + 1, NO_ID, np.int64)
    np.minimum.at(least, node, ids[seg])
    inside = place - np.searchsorted(row, seg)
    return _runs(ids, texts, first[seg] + inside, least[node] < ids[seg], seg)


def find_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """Runs of repeated windows (id, body, start, windows) of ``docs`` with
    columns id long (not null), body binary (a digest of the text, to tell rows
    with one id apart) and text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            s = _segments(*utf8(part.column("text")), window, gram)
            if s:
                yield _emit([("id", pa.array(np.asarray(part.column("id"))[s["row"]])), ("body", _taken(part.column("body"), s["row"])),
                             *((k, pa.array(s[k])) for k in ("start", "windows", "anchor", "segment"))])

    every = python_pass(docs, scan, "id long, body binary, start int, windows int, anchor long, segment long")
    # both sides of a join are dealt for it alone, so that Spark can split a hot key: aggregates are written first
    shared = written(every.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("anchor"))
    rows = written(every.join(shared, "anchor"))
    nodes = written(rows.groupBy("anchor", "segment").agg(F.min("id").alias("least")))
    several = written(nodes.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    placed = rows.join(nodes, ["anchor", "segment"])
    whole = placed.where("least < id").select("id", "body", "start", "windows")

    # one bearer of each segment of a mixed anchor: the rows with the smallest id
    mixed = placed.where("least = id").select("anchor", "id", "body", "start", "windows").join(several, "anchor")
    wanted = mixed.groupBy("id", "body").agg(F.collect_list(F.struct("anchor", "start", "windows", "kinds")).alias("wanted"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            raw, offsets = utf8(part.column("text"))
            starts, ends, row = word_spans(raw, offsets, _BLANK)
            begin = np.searchsorted(row, np.arange(part.num_rows))
            lists = part.column("wanted")
            size = np.asarray(lists.value_lengths())
            of = np.repeat(np.arange(part.num_rows), size)
            got = {k: np.asarray(lists.flatten().field(k)) for k in ("anchor", "start", "windows", "kinds")}
            a = begin[of] + got["start"]
            blob = raw.tobytes()
            text = [blob[x:y].decode() for x, y in zip(starts[a].tolist(), ends[a + got["windows"] + window - 2].tolist(), strict=True)]
            yield _emit([("anchor", pa.array(got["anchor"])), ("id", pa.array(np.asarray(part.column("id"))[of])),
                         ("body", _taken(part.column("body"), of)), ("start", pa.array(got["start"])),
                         ("windows", pa.array(got["windows"])), ("kinds", pa.array(got["kinds"])), ("text", pa.array(text, pa.string()))])

    bearers = python_pass(docs.join(wanted, ["id", "body"]).select("id", "body", "text", "wanted"), fetch,
                          "anchor long, id long, body binary, start int, windows int, kinds long, text string")
    bearers = written(bearers)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def whole_groups(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            table = pa.Table.from_batches(held).combine_chunks().to_batches()
            if not table:
                return
            part = table[0]
            keys = np.asarray(part.column("anchor"))
            cut = part.num_rows if last else int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield _tree(part.slice(0, cut), window)
            held = [part.slice(cut)]

        size = 0
        for part in slices(batches, "text"):
            held.append(part)
            size += part.nbytes
            if size >= TREE_BYTES:
                yield from whole_groups(False)
                size = sum(h.nbytes for h in held)
        if held:
            yield from whole_groups(True)

    trees = python_pass(bearers.where(F.col("kinds") <= group).drop("kinds").repartition("anchor").sortWithinPartitions("anchor"),
                        grow, "id long, body binary, start int, windows int")

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            raw, offsets = utf8(part.column("text"))
            starts, ends, row = word_spans(raw, offsets, _BLANK)
            words = place_hashes(raw, starts, ends)
            first = np.searchsorted(row, np.arange(part.num_rows))
            seg, place = _window_places(first, np.asarray(part.column("windows")))
            yield _emit([("id", pa.array(np.asarray(part.column("id"))[seg])), ("body", _taken(part.column("body"), seg)),
                         ("start", pa.array((np.asarray(part.column("start"))[seg] + place - first[seg]).astype(np.int32))),
                         ("a", pa.array(_sequence_hashes(words, place, place + window, _BASE_B).view(np.int64))),
                         ("b", pa.array(_sequence_hashes(words, place, place + window, _BASE_C).view(np.int64)))])

    hot = python_pass(bearers.where(F.col("kinds") > group), suffixes, "id long, body binary, start int, a long, b long")
    deep = written(hot.groupBy("a", "b").agg(F.min("id").alias("least")))
    long_prefixes = hot.join(deep, ["a", "b"]).where("least < id").select("id", "body", "start", F.lit(1).alias("windows"))
    return whole.unionByName(trees).unionByName(long_prefixes)


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group: int = GROUP,
                   id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` without the words that a repeated window covers.

    Returns the id (or the columns named in ``keep``) with ``n_words``,
    ``n_removed`` and ``kept_text`` (the kept words, one blank between).
    Windows are judged on the input.  Null and blank texts have no word; texts
    of fewer than ``window`` words lose none.  Rows that share an id are one
    document to the rule (neither is smaller), each with its own result row;
    rows without an id count as larger than any other.  Other columns are
    ignored, whatever their names; an empty table gives an empty result.
    """
    kept = [id_col] if keep is None else list(keep)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # 128 bits of the text: rows that share an id and this digest are copies of one row, with the same cuts
    key = [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32)).alias("digest")]
    runs = find_repeats(docs.select(*key, text.alias("text")).withColumnRenamed("digest", "body"), window, gram, group)
    cut = runs.groupBy("id", "body").agg(F.collect_list(F.struct("start", "windows")).alias("cut")).withColumnRenamed("body", "digest")
    held, back = kept_columns(docs, kept, text_col, *key)
    rows = held.join(cut, ["id", "digest"], "left")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            raw, offsets = utf8(part.column("text"))
            starts, ends, row = word_spans(raw, offsets, _BLANK)
            begin = np.searchsorted(row, np.arange(part.num_rows + 1))
            lists = part.column("cut")
            change = np.zeros(len(starts) + 1, np.int64)
            size = np.asarray(lists.value_lengths().fill_null(0))
            of = np.repeat(np.arange(part.num_rows), size)
            flat = lists.flatten()
            a = begin[of] + np.asarray(flat.field("start"))
            np.add.at(change, a, 1)
            np.add.at(change, a + np.asarray(flat.field("windows")) + window - 1, -1)
            gone = np.cumsum(change)[:-1] > 0
            left = np.flatnonzero(~gone)
            # the kept words of all rows, one blank after each
            length = ends[left] - starts[left]
            at = np.cumsum(length + 1) - (length + 1)
            out = np.full(int((length + 1).sum()), 32, np.uint8)
            if len(left):
                inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
                out[np.repeat(at, length) + inside] = raw[np.repeat(starts[left], length) + inside]
            edge = np.searchsorted(row[left], np.arange(part.num_rows + 1))
            at = np.append(at, len(out))
            blob = out.tobytes()
            texts = [blob[at[x]:max(at[x], at[y] - 1)].decode() for x, y in zip(edge[:-1], edge[1:], strict=True)]
            words = np.diff(begin)
            yield _emit([*zip(CARRIED, carried(part), strict=True), ("n_words", pa.array(words.astype(np.int64))),
                         ("n_removed", pa.array((words - np.diff(edge)).astype(np.int64))), ("kept_text", pa.array(texts, pa.string()))])

    plain = rows.select(*CARRIED, "text", "own", "cut")
    schema = plain.select(*CARRIED).schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")
    out = python_pass(plain, strip, schema)
    return out.select(*back, "n_words", "n_removed", "kept_text")
