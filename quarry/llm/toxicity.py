"""Toxicity by a convolutional text classifier trained in numpy.

A word is the sum of two hashed embeddings, one of the word and one of its
first bytes (inflected insults share a stem).  Filters of several widths slide
over the words, max pooling keeps each filter's strongest place in the whole
text, and a logistic layer turns these into a score.  Decision thresholds are
calibrated by language, told from function words of the text, on every labelled
row that is neither held out nor trained on, and mapped to one common cut, so
that a score of ``CUT`` or more means label 1 everywhere.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import CARRIED, carried, kept_columns, python_pass, slices, span_hashes, utf8, word_spans, written
from quarry.llm.training import sample_per_class

BUCKETS = 1 << 15
DIM, FILTERS, WIDTHS = 12, 8, (1, 2, 3)
STEM = 4                  # bytes of a word's stem
PER_CLASS = 2000          # labelled texts per class that are learned from, about
TRAIN_CHARS = 200_000     # longer texts are not trained on (the others whole); the bound of the sample's size
EPOCHS, BATCH = 12, 64
SEEN = 1                  # training texts in which a word must occur to have an embedding
CUT = 0.7
FOLDS = 5                 # one of so many folds of the labelled rows is never trained on
CUTS = np.linspace(0.2, 0.99, 80)      # thresholds that are compared
WORDS = 1 << 16           # words in work at a time

# Function words by which a text's language is told when thresholds are chosen.
FUNCTION_WORDS = {
    "en": "the of and to in that is was for with as on be at by this",
    "de": "der die und den von zu das mit sich des auf für ist im dem nicht",
    "fr": "le les et des un une du dans est pour qui au sur pas avec par",
    "es": "el los las y que en una por con para del se lo como más su",
}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = np.arange(97, 123)
_BREAK = np.ones(256, bool)
_BREAK[128:] = False
_BREAK[[*range(48, 58), *range(97, 123)]] = False


@dataclass
class Words:
    word: np.ndarray       # bucket per word
    stem: np.ndarray
    row: np.ndarray
    rows: int

    @cached_property
    def edge(self) -> np.ndarray:
        """Where each row's words begin, and the end."""
        return np.searchsorted(self.row, np.arange(self.rows + 1))


def words_of(raw: np.ndarray, offsets: np.ndarray) -> Words:
    low = _LOWER[raw]
    starts, ends, row = word_spans(low, offsets, _BREAK)
    mask = np.uint64(BUCKETS - 1)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, len(offsets) - 1)
    word = span_hashes(low, starts, ends) & mask
    stem = (span_hashes(low, starts, np.minimum(ends, starts + STEM)) >> np.uint64(20)) & mask
    return Words(word.astype(np.int64), stem.astype(np.int64), row, len(offsets) - 1)


def _language_table() -> np.ndarray:
    """Language number + 1 of each word bucket (0: none)."""
    table = np.zeros(BUCKETS, np.int64)
    for i, words in enumerate(FUNCTION_WORDS.values()):
        blob = [w.encode() for w in words.split()]
        offsets = np.concatenate([[0], np.cumsum([len(b) for b in blob])])
        table[words_of(np.frombuffer(b"".join(blob), np.uint8), offsets).word] = i + 1
    return table


class ToxicityModel:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.word = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
        self.stem = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
        self.filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.out_bias = np.float32(0)
        self.constant: float | None = None
        self.cuts = np.full(len(FUNCTION_WORDS) + 1, 0.5)
        self.languages = _language_table()
        self.known = {"word": np.ones(BUCKETS, bool), "stem": np.ones(BUCKETS, bool)}
        self._tables: tuple[np.ndarray, np.ndarray] | None = None

    # ------------------------------------------------------------------ scoring
    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Each bucket's part of every filter and place: the convolution is
        then a sum of looked-up rows, the same numbers as sliding filters."""
        if self._tables is None:
            flat = np.concatenate([f[j] for f in self.filters for j in range(len(f))], axis=1)
            self._tables = self.word @ flat, self.stem @ flat
        return self._tables

    def pooled(self, words: Words) -> np.ndarray:
        """Strongest response of each filter in each whole text (at least 0)."""
        best = np.zeros((words.rows, len(WIDTHS) * FILTERS), np.float32)
        word_part, stem_part = self.tables()
        reach = max(WIDTHS) - 1
        n = len(words.row)
        for a in range(0, n, WORDS):
            b = min(n, a + WORDS + reach)
            part = word_part[words.word[a:b]] + stem_part[words.stem[a:b]]
            row = words.row[a:b]
            column = 0
            for k, w in enumerate(WIDTHS):
                m = b - a - w + 1
                if m <= 0:
                    column += w
                    continue
                total = part[:m, column * FILTERS:(column + 1) * FILTERS].copy()
                for j in range(1, w):
                    total += part[j:m + j, (column + j) * FILTERS:(column + j + 1) * FILTERS]
                column += w
                total += self.bias[k * FILTERS:(k + 1) * FILTERS]
                if w > 1:
                    total[row[:m] != row[w - 1:]] = 0     # no filter spans two texts
                first = np.flatnonzero(np.diff(row[:m], prepend=-1))
                peak = np.maximum.reduceat(total, first, axis=0)
                at = row[first]
                here = best[at, k * FILTERS:(k + 1) * FILTERS]
                best[at, k * FILTERS:(k + 1) * FILTERS] = np.maximum(here, peak)
        return best

    def language(self, words: Words) -> np.ndarray:
        """Language number + 1 with the most function words, 0 if none."""
        lang = self.languages[words.word]
        hit = np.flatnonzero(lang)
        kinds = len(FUNCTION_WORDS) + 1
        votes = np.bincount(words.row[hit] * kinds + lang[hit], minlength=words.rows * kinds).reshape(words.rows, kinds)
        return votes.argmax(axis=1)

    def raw_scores(self, words: Words) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.pooled(words) @ self.out + self.out_bias).astype(float)))

    def scores(self, words: Words) -> np.ndarray:
        """Scores in [0, 1] with the language's threshold mapped to ``CUT``."""
        if self.constant is not None:
            return np.full(words.rows, self.constant)
        raw, cut = self.raw_scores(words), self.cuts[self.language(words)]
        return np.where(raw < cut, raw / cut * CUT, CUT + (raw - cut) / (1 - cut) * (1 - CUT))

    # ------------------------------------------------------------------ training
    def forget_rare(self, words: Words) -> None:
        """Words of fewer than ``SEEN`` training texts say nothing: their
        embeddings are zero and stay so, like those of words never seen."""
        for name, ids in (("word", words.word), ("stem", words.stem)):
            pairs = np.unique(words.row.astype(np.int64) * BUCKETS + ids)
            self.known[name] = np.bincount(pairs % BUCKETS, minlength=BUCKETS) >= SEEN
            getattr(self, name)[~self.known[name]] = 0

    def step(self, words: Words, rows: np.ndarray, y: np.ndarray, state: dict, rate: float) -> None:
        """One Adagrad step on the texts ``rows`` (their words are contiguous)."""
        spans = [(int(words.edge[r]), int(words.edge[r + 1])) for r in rows]
        at = np.concatenate([np.arange(a, b) for a, b in spans]) if spans else np.zeros(0, int)
        new_row = np.repeat(np.arange(len(rows)), [b - a for a, b in spans])
        emb = self.word[words.word[at]] + self.stem[words.stem[at]]
        best = np.zeros((len(rows), len(self.out)), np.float32)
        where = np.full(best.shape, -1)
        for k, w in enumerate(WIDTHS):
            m = len(at) - w + 1
            if m <= 0:
                continue
            total = emb[:m] @ self.filters[k][0]
            for j in range(1, w):
                total += emb[j:m + j] @ self.filters[k][j]
            total += self.bias[k * FILTERS:(k + 1) * FILTERS]
            if w > 1:
                total[new_row[:m] != new_row[w - 1:]] = -1
            edge = np.append(np.flatnonzero(np.diff(new_row[:m], prepend=-1)), m)
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                top = total[a:b].argmax(axis=0)
                v = total[a:b][top, np.arange(FILTERS)]
                cols = np.arange(k * FILTERS, (k + 1) * FILTERS)
                best[new_row[a], cols] = np.maximum(v, 0)
                where[new_row[a], cols] = np.where(v > 0, top + a, -1)
        p = 1 / (1 + np.exp(-(best @ self.out + self.out_bias)))
        g = ((p - y) / len(rows)).astype(np.float32)
        grad_out, grad_pool = best.T @ g + 1e-4 * self.out, np.outer(g, self.out)
        grad_bias = np.where(where >= 0, grad_pool, 0).sum(axis=0)
        emb_at, emb_grad = [], []
        grad_f = [np.zeros_like(f) for f in self.filters]
        for k, w in enumerate(WIDTHS):
            for f in range(FILTERS):
                c = k * FILTERS + f
                ok = np.flatnonzero(where[:, c] >= 0)
                if not len(ok):
                    continue
                for j in range(w):
                    place, part = where[ok, c] + j, grad_pool[ok, c][:, None]
                    grad_f[k][j, :, f] += (emb[place] * part).sum(axis=0)
                    emb_at.append(place)
                    emb_grad.append(part * self.filters[k][j, :, f])

        def move(name: str, value: np.ndarray, grad: np.ndarray) -> None:
            state[name] = state.get(name, 1e-8) + grad * grad
            value -= rate * grad / np.sqrt(state[name])

        move("out", self.out, grad_out)
        move("bias", self.bias, grad_bias)
        for k in range(len(WIDTHS)):
            move(f"f{k}", self.filters[k], grad_f[k])
        state["ob"] = state.get("ob", 1e-8) + float(g.sum()) ** 2
        self.out_bias -= np.float32(rate * float(g.sum()) / np.sqrt(state["ob"]))
        if emb_at:
            place, grad = np.concatenate(emb_at), np.concatenate(emb_grad)
            for name, table, ids in (("word", self.word, words.word[at][place]), ("stem", self.stem, words.stem[at][place])):
                known = self.known[name][ids]
                uniq, inv = np.unique(ids[known], return_inverse=True)
                total = np.zeros((len(uniq), DIM), np.float32)
                np.add.at(total, inv, grad[known])
                past = state.setdefault(name, np.full(BUCKETS, 1e-8, np.float32))
                past[uniq] += (total * total).mean(axis=1)
                table[uniq] -= rate * total / np.sqrt(past[uniq])[:, None]
        self._tables = None


def _words_in_parts(blobs: list[bytes], part: int = 256) -> Words:
    """The words of all texts, a bounded number of texts at a time."""
    made = []
    for a in range(0, len(blobs), part):
        some = blobs[a:a + part]
        made.append(words_of(np.frombuffer(b"".join(some), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in some])])))
        made[-1].row = made[-1].row + a
    return Words(*(np.concatenate([getattr(m, k) for m in made]).astype(np.int32) for k in ("word", "stem", "row")), len(blobs))


def fit(texts: list[str], labels: list[int], seed: int = 5) -> ToxicityModel:
    """Train on all the texts; the thresholds stay at one half."""
    model = ToxicityModel(seed)
    y = np.asarray(labels, np.float32)
    if not len(y) or y.min() == y.max():
        model.constant = float(y[0]) if len(y) else 0.0
        return model
    words = _words_in_parts([t.encode() for t in texts])
    rng = np.random.default_rng(seed)
    train = rng.permutation(len(y))
    model.forget_rare(words)
    state: dict = {}
    for epoch in range(EPOCHS):
        rng.shuffle(train)
        for a in range(0, len(train), BATCH):
            rows = np.sort(train[a:a + BATCH])
            model.step(words, rows, y[rows], state, 0.1 if epoch < EPOCHS // 2 else 0.03)
    return model


def cuts_of(counts: Iterable[tuple[int, int, bool, int, int]]) -> np.ndarray:
    """The threshold of each told language with the best F1, from counts of
    rows by (language, label, trained on, number of ``CUTS`` reached).  Rows
    that were trained on are not judged: those of their language and label that
    were not stand for them, so the mix of labels is that of all rows."""
    kinds = len(FUNCTION_WORDS) + 1
    rows = np.zeros((kinds, 2, 2, len(CUTS) + 1))
    for lang, y, trained, reached, n in counts:
        rows[lang, y, int(trained), reached] += n
    fresh, total = rows[:, :, 0], rows.sum(axis=(2, 3))

    def cut_of(fresh: np.ndarray, total: np.ndarray) -> float | None:
        seen = fresh.sum(axis=1)
        if seen.sum() < 20 or not seen.all():
            return None
        hit = np.cumsum(fresh[:, ::-1], axis=1)[:, -2::-1] * (total / seen)[:, None]     # rows that reach each cut
        f1 = 2 * hit[1] / (hit.sum(axis=0) + total[1])
        flat = np.flatnonzero(f1 >= f1.max() - 1e-9)
        return float(CUTS[flat[len(flat) // 2]])                     # the middle of the best cuts

    every = cut_of(fresh.sum(axis=0), total.sum(axis=0)) or 0.5
    return np.array([cut_of(fresh[k], total[k]) or every for k in range(kinds)])


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(3)) == 1


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Fit on a bounded sample (``PER_CLASS`` labelled texts per class, about)
    of rows that are not held out, then choose the thresholds on all the other
    rows that are not held out, among them one fold that is never sampled.
    Labels other than 0 and 1 are left out, and so are rows without an id (a
    label cannot be joined to them); of rows that repeat an id one is trained
    on; labels that disagree count as 1."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    marks = written(marks.where(F.col("y").isin(0, 1) & ~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y")))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(F.length("text") <= TRAIN_CHARS)

    def sampled(some: DataFrame) -> list:
        # at most about 2 x PER_CLASS rows, one of each id: their number is bounded by the sample
        picked = sample_per_class(some, ["id"], "y", PER_CLASS, 2)
        one = rows.join(F.broadcast(picked), "id").groupBy("id", "y").agg(F.min("text").alias("text"))
        return sorted(one.select("id", "text", "y").collect(), key=lambda r: (r.id, r.text))

    got = sampled(marks.where(F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(FOLDS)) != 0))
    if len({r.y for r in got}) < 2:        # so few rows of a class that the fold may hold them all
        got = sampled(marks)
    model = fit([r.text for r in got], [r.y for r in got])
    if model.constant is None:
        trained = docs.sparkSession.createDataFrame([(i,) for i in sorted({r.id for r in got})], marks.select("id").schema)
        model.cuts = cuts_of(_reached(docs, marks, trained, model, id_col, text_col))
    return model


def _reached(docs: DataFrame, marks: DataFrame, trained: DataFrame, model: ToxicityModel, id_col: str, text_col: str) -> list:
    """Counts of all rows of ``marks`` as ``cuts_of`` takes them.  Whole texts
    are scored where they are read; only ids and small numbers are joined."""
    rows = docs.where(~held_out(F.col(id_col))).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    model.tables()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = words_of(*utf8(part.column("text")))
            reached = np.searchsorted(CUTS, model.raw_scores(words), "right")
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(model.language(words).astype(np.int32)), pa.array(reached.astype(np.int32))],
                                             names=["id", "lang", "reached"])

    told = python_pass(rows, run, rows.select("id").schema.add("lang", "integer").add("reached", "integer"))
    known = F.broadcast(trained.withColumn("known", F.lit(True)))          # bounded by the sample
    judged = told.join(marks, "id").join(known, "id", "left").withColumn("trained", F.col("known").isNotNull())
    return [tuple(r) for r in judged.groupBy("lang", "y", "trained", "reached").count().collect()]


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``score`` (0 to 1) and ``predicted`` (1 if the score is ``CUT`` or more)
    of every whole text.  Without ``keep`` the result has the id and these;
    ``keep`` names columns of ``docs`` to carry along instead.  Null and empty
    texts are scored like a text without a word.  If all training labels agree,
    that label is every score; with none it is 0.  Repeated rows and null ids
    keep a row each; an empty table gives an empty result."""
    kept = [id_col] if keep is None else list(keep)
    plain, back = kept_columns(docs, kept, text_col)
    model.tables()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            s = np.clip(model.scores(words_of(*utf8(part.column("text")))), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([*carried(part), pa.array(s), pa.array((s >= CUT).astype(np.int32))],
                                             names=[*CARRIED, "score", "predicted"])

    schema = plain.select(*CARRIED).schema.add("score", "double").add("predicted", "integer")
    out = python_pass(plain, run, schema)
    return out.select(*back, "score", "predicted")
