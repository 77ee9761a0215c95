"""Ranked lexical search with bit-sliced Bloom signatures.

The documents of a block are the columns of bit matrices: each term of a
document sets a few hashed rows in its column, once more for every power of
two that its count reaches.  A query term's rows, combined by AND, are a
bitmap of the documents that may hold it (never one too few), and those of its
higher powers bound how often.  The weighted sum of a query's bitmaps is then
an upper bound of every document's score.  Documents whose bound is below the
``k``-th best score found so far cannot be among the best; all others are
scored exactly from their texts, best bounds first.

Queries are a stated set: they are broadcast in blocks of bounded bytes.  Each
block reads the documents twice: once to count (documents, terms, documents
that hold each query term), once to rank.  A task returns its best ``k`` rows
of each query, so only these are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import mix, python_pass, slices, span_hashes, utf8, word_spans, written

TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ITEM_BYTES = 1 << 19      # about this many bytes of query terms are broadcast together
TEXT_BYTES = 1 << 21      # text of a block of documents
CELLS = 1 << 22           # query terms times documents of a block
ROWS = 3                  # hashed rows of a term
BITS = 8                  # rows of a matrix per term of its fullest document
POWERS = 4                # a term sets rows for counts of 1, 2, 4 and 8

_SPLIT = np.ones(256, bool)
_SPLIT[0x80:] = False
for _c in "0123456789" + UPPER + LOWER:
    _SPLIT[ord(_c)] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class Vocabulary:
    """The query terms of a block; finds them among words, exactly."""

    def __init__(self, terms: list[bytes]):
        self.raw = np.frombuffer(b"".join(terms), np.uint8)
        size = np.array([len(t) for t in terms], np.int64)
        end = np.cumsum(size)
        self.hash = span_hashes(self.raw, end - size, end) if terms else np.zeros(0, np.uint64)
        self.order = np.argsort(self.hash, kind="stable")
        self.sorted, self.start, self.size = self.hash[self.order], end - size, size
        self.alike = int(np.unique(self.hash, return_counts=True)[1].max(initial=0))      # terms that share a hash

    def find(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The number of the term that each word is, else -1."""
        out = np.full(len(starts), -1, np.int64)
        left = np.searchsorted(self.sorted, hashes, "left")
        for step in range(self.alike):
            at = np.minimum(left + step, len(self.sorted) - 1)
            term = self.order[at]
            who = np.flatnonzero((left + step < len(self.sorted)) & (self.sorted[at] == hashes) & (ends - starts == self.size[term]))
            size = self.size[term[who]]
            inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            same = raw[np.repeat(starts[who], size) + inside] == self.raw[np.repeat(self.start[term[who]], size) + inside]
            good = who[np.logical_and.reduceat(same, np.cumsum(size) - size)] if len(who) else who
            out[good] = term[good]
        return out


def _words(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw, offsets = utf8(part.column("text"))
    raw = _FOLD[raw]
    return raw, *word_spans(raw, offsets, _SPLIT)


def _parts(batches: Iterator[pa.RecordBatch], terms: int) -> Iterator[pa.RecordBatch]:
    """Blocks of bounded text and of bounded documents times query terms."""
    most = max(1, CELLS // max(1, terms))
    for part in slices(batches, "text", TEXT_BYTES):
        for a in range(0, part.num_rows, most):
            yield part.slice(a, most)


def statistics(docs: DataFrame, vocabulary: Vocabulary) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms with repeats, and the documents that hold
    each term of the vocabulary, over all rows of ``docs`` (column text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, terms, df = 0, 0, np.zeros(len(vocabulary.size), np.int64)
        for part in _parts(batches, 1):
            raw, starts, ends, row = _words(part)
            holding, terms = holding + len(np.unique(row)), terms + len(row)
            term = vocabulary.find(raw, starts, ends, span_hashes(raw, starts, ends))
            hit = term >= 0
            pairs = np.unique(row[hit] * len(df) + term[hit])
            df += np.bincount(pairs % len(df), minlength=len(df))
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], seen]).astype(np.int64)),
                                          pa.array(np.concatenate([[holding, terms], df[seen]]).astype(np.int64))], names=["term", "n"])

    got = {r.term: r.n for r in python_pass(docs, count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}   # bounded by the vocabulary
    return got.get(-1, 0), got.get(-2, 0), np.array([got.get(t, 0) for t in range(len(vocabulary.size))], np.int64)


def _row_of(hashes: np.ndarray, power: int, i: int, size: int) -> np.ndarray:
    """Matrix row ``i`` of a term at a power (``size`` is a power of two)."""
    return (mix(hashes + np.uint64((0x9E3779B97F4A7C15 * (POWERS * i + power + 1)) & (2 ** 64 - 1))) & np.uint64(size - 1)).astype(np.int64)


class Signatures:
    """The bit-sliced signatures of a block, one matrix per size of document
    (so that short and long ones are equally dense)."""

    def __init__(self, row: np.ndarray, hashes: np.ndarray, docs: int):
        order = np.lexsort((hashes, row))
        row, hashes = row[order], hashes[order]
        new = np.ones(len(row), bool)
        new[1:] = (np.diff(row) != 0) | (np.diff(hashes) != 0)
        first = np.flatnonzero(new)
        self.row, self.hash, tf = row[first], hashes[first], np.diff(np.append(first, len(row)))
        self.most = np.zeros(docs, np.int64)                      # the largest count of any term of a document
        np.maximum.at(self.most, self.row, tf)
        entries = np.bincount(self.row, weights=np.minimum(np.floor(np.log2(tf)), POWERS - 1) + 1, minlength=docs)
        size = 1 << np.ceil(np.log2(np.maximum(entries * BITS, 64))).astype(np.int64)
        self.matrices = []
        for s in np.unique(size[self.most > 0]).tolist():
            own = np.flatnonzero((size == s) & (self.most > 0))
            column = np.full(docs, -1)
            column[own] = np.arange(len(own))
            here = column[self.row] >= 0
            bits = np.zeros((s, len(own)), bool)
            for power in range(POWERS):
                enough = here & (tf >= 1 << power)
                for i in range(ROWS):
                    bits[_row_of(self.hash[enough], power, i, s), column[self.row[enough]]] = True
            self.matrices.append((own, np.packbits(bits, axis=1)))

    def bitmaps(self, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """Per matrix its documents, and per power the bitmap (terms by
        documents) of those that may hold each term so often."""
        for own, slices_ in self.matrices:
            maps = []
            for power in range(POWERS):
                both = slices_[_row_of(hashes, power, 0, len(slices_))]
                for i in range(1, ROWS):
                    both &= slices_[_row_of(hashes, power, i, len(slices_))]
                maps.append(np.unpackbits(both, axis=1, count=len(own)).astype(bool))
            yield own, maps


def _impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def bounds(signatures: Signatures, vocabulary: Vocabulary, m: np.ndarray, docs: int) -> np.ndarray:
    """Upper bounds of the impact of each term in each document."""
    out = np.zeros((len(vocabulary.size), docs))
    for own, maps in signatures.bitmaps(vocabulary.hash):
        most = np.maximum(signatures.most[own], 1)
        least = np.zeros(len(own), np.int64)
        held = maps[0]
        for power in range(POWERS):
            held = held & maps[power]
            top = _impact(most if power == POWERS - 1 else np.minimum(most, (2 << power) - 1), m[own])
            out[:, own] += held * (top - least)
            least = top
    return out


def length_term(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """A document's m = 100 - 50 + (50 * n * N) div L, exact at any size."""
    if 50 * int(n.max(initial=0)) * documents < 1 << 63:
        return 50 + 50 * n * documents // terms
    return np.array([50 + 50 * int(x) * documents // terms for x in n], np.int64)


class _Block:
    """Exact counts of the query terms in the documents that are scored."""

    def __init__(self, part: pa.RecordBatch, vocabulary: Vocabulary, documents: int, terms: int):
        self.vocabulary = vocabulary
        self.raw, self.starts, self.ends, self.row = _words(part)
        self.docs = part.num_rows
        self.edge = np.searchsorted(self.row, np.arange(self.docs + 1))
        self.hashes = span_hashes(self.raw, self.starts, self.ends)
        self.m = length_term(np.diff(self.edge), documents, terms)
        self.tf = np.zeros((len(vocabulary.size), self.docs), np.int32)
        self.read = np.zeros(self.docs, bool)

    def upper(self) -> np.ndarray:
        return bounds(Signatures(self.row, self.hashes, self.docs), self.vocabulary, self.m, self.docs)

    def score(self, terms: np.ndarray, weights: np.ndarray, docs: np.ndarray) -> np.ndarray:
        fresh = docs[~self.read[docs]]
        if len(fresh):
            size = self.edge[fresh + 1] - self.edge[fresh]
            at = np.repeat(self.edge[fresh] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            term = self.vocabulary.find(self.raw, self.starts[at], self.ends[at], self.hashes[at])
            hit = term >= 0
            np.add.at(self.tf, (term[hit], self.row[at][hit]), 1)
            self.read[fresh] = True
        return weights @ _impact(self.tf[np.ix_(terms, docs)].astype(np.int64), self.m[docs])


class _Best:
    """The best ``k`` (score, document) so far of one query: higher scores
    first, then smaller ids, rows without an id last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id, self.none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        held = score >= self.least()
        s, i, n = (np.concatenate([a, b[held]]) for a, b in ((self.score, score), (self.id, ids), (self.none, none)))
        top = np.lexsort((i, n, -s))[:self.k]
        self.score, self.id, self.none = s[top], i[top], n[top]


def _rank_block(docs: DataFrame, items: list[np.ndarray], vocabulary: Vocabulary, weights: np.ndarray,
                documents: int, terms: int, k: int) -> DataFrame:
    """The best ``k`` documents of each task for each query (its number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k) for _ in items]
        for part in _parts(batches, len(vocabulary.size)):
            block = _Block(part, vocabulary, documents, terms)
            upper = block.upper()
            ids, none = np.asarray(part.column("id").fill_null(0)), np.asarray(part.column("id").is_null())
            for held, own in zip(best, items, strict=True):
                w = weights[own]
                bound = w.astype(np.float64) @ upper[own] * (1 + 1e-12)      # rounding never lowers a bound
                open_ = np.flatnonzero(bound >= held.least())
                open_ = open_[np.argsort(-bound[open_], kind="stable")]
                size = k
                while len(open_):
                    now, open_ = open_[:size], open_[size:]
                    held.add(block.score(own, w, now), ids[now], none[now])
                    open_, size = open_[bound[open_] >= held.least()], 2 * size
        rows = [(j, held) for j, held in enumerate(best) if len(held.score)]
        if rows:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([np.full(len(h.score), j, np.int64) for j, h in rows])),
                pa.array(np.concatenate([h.id for _, h in rows]), mask=np.concatenate([h.none for _, h in rows])),
                pa.array(np.concatenate([h.score for _, h in rows]))], names=["item", "id", "score"])

    return python_pass(docs, run, "item long, id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", item_col: str = "item_id",
                   text_col: str = "text", item_text_col: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The ``k`` best documents of each item: item id, ``rank`` int from 1,
    document id and ``score`` long.

    Terms are maximal runs of ASCII letters and digits and of characters
    beyond ASCII, A-Z lower-cased; whole texts count, null has none.  A term
    weighs floor(1000 ln((2N + 2) / (2 df + 1))); a document's score adds, for
    every term of the item once, its weight times
    (10^9 tf) div (1000 tf + 20 m) with m = 50 + (50 n N) div L.  Documents
    with score 0 are not returned.  Equal scores: smaller id first, rows
    without an id last.  Repeated document rows are ranked each; rows that
    share an item id (a missing one too) are one item with the terms of all of
    them.  Other columns are ignored, whatever their names; no item, no
    document or no term gives an empty result.
    """
    spark = docs.sparkSession
    text = F.translate(F.col(f"`{item_text_col}`").cast("string"), UPPER, LOWER)
    asked = items.select(F.col(f"`{item_col}`").alias("item"), F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))).alias("term"))
    asked = written(asked.distinct())
    total = asked.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    blocks = max(1, -(-total // item_bytes))
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = items.schema[item_col].dataType.simpleString()
    best = spark.createDataFrame([], f"item {kind}, id long, score long")
    for b in range(blocks):
        got = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()           # about ``item_bytes`` of terms
        if not got:
            continue
        terms = sorted({r.term for r in got})
        number = {t: i for i, t in enumerate(terms)}
        by_item: dict = {}
        for r in got:
            by_item.setdefault(r.item, []).append(number[r.term])
        names = list(by_item)
        vocabulary = Vocabulary([t.encode() for t in terms])
        n, length, df = statistics(plain.select("text"), vocabulary)
        if not length:
            break
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        sent = [np.array(sorted(t), np.int64) for t in by_item.values()]
        found = written(_rank_block(plain, sent, vocabulary, weights, n, length, k))
        name = spark.createDataFrame(list(enumerate(names)), f"number long, item {kind}")
        named = found.withColumnRenamed("item", "number").join(F.broadcast(name), "number")       # one row per item of the block
        best = best.unionByName(named.select("item", "id", "score"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
