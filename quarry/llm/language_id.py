"""Language identification by error-correcting output codes.

Every learned language has a codeword.  One binary classifier per bit (log
odds of hashed byte bigrams and trigrams between the languages with bit 1 and
those with bit 0) gives the bit's margin as the mean over a text's n-grams.
Decoding weighs each bit's logistic loss by how well that bit separates the
training sample and takes the codeword with the least loss; a small gap to the
runner-up marks the text as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import CARRIED, carried, kept_columns, python_pass, slices, utf8
from quarry.llm.training import sample_per_class

BUCKETS = 1 << 15
PER_LANGUAGE = 400        # training texts per language, about
TRAIN_CHARS = 200_000     # longer texts are not learned from (the others whole); the bound of the sample's size
MAX_LANGUAGES = 4096      # more are an error
AMBIGUOUS = 0.10          # lead of the best codeword over the next, as a share of probability
CHUNK = 1 << 18           # bytes of a text that are in work at a time
UNKNOWN = "und"
LETTER = r"\p{L}"

# lower case for A-Z; every other ASCII byte that is no letter is one blank
_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[:128] = 32
_CLEAN[65:91] = np.arange(97, 123)
_CLEAN[97:123] = np.arange(97, 123)


def codewords(n: int) -> np.ndarray:
    """``n`` codewords as +1 and -1: all splits for up to five classes, else
    random balanced columns with a minimum distance that is searched for."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= 5:
        bits = (1 << (n - 1)) - 1
        code = np.empty((n, bits), np.int8)
        code[0] = 1
        for j in range(bits):
            for i in range(1, n):
                code[i, j] = 1 if (j >> (i - 1)) & 1 else -1
        return code
    bits = 15 + 4 * int(np.ceil(np.log2(n)))
    rng, best, best_gap = np.random.default_rng(11), None, -1
    for _ in range(40):
        code = np.empty((n, bits), np.int8)
        for j in range(bits):
            code[:, j] = rng.permutation(np.where(np.arange(n) < n // 2, 1, -1))
        dots = code.astype(int) @ code.T
        gap = (bits - (dots - 10 * bits * np.eye(n, dtype=int)).max()) // 2
        if gap > best_gap:
            best, best_gap = code, gap
    return best


def _grams(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigram that ends at each byte, and of the bigram (the
    first two bytes take blanks before the text)."""
    x = np.empty(len(raw) + 2, np.uint32)
    x[:2] = 32
    x[2:] = _CLEAN[raw]
    two = x[1:-1] << np.uint32(8) | x[2:]
    three = x[:-2] << np.uint32(16) | two
    shift = np.uint32(32 - 15)
    return (three * np.uint32(2654435761)) >> shift, ((two + np.uint32(0x1000000)) * np.uint32(2246822519)) >> shift


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray       # languages x bits
    weights: np.ndarray    # buckets x bits
    scale: np.ndarray      # per bit: margins to logits
    trust: np.ndarray      # per bit: weight of its loss

    def margins(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean log odds per row and bit; long texts in chunks."""
        out = np.zeros((len(offsets) - 1, self.weights.shape[1]))
        row = 0
        while row < len(offsets) - 1:
            end = row + 1
            while end < len(offsets) - 1 and offsets[end + 1] - offsets[row] <= CHUNK:
                end += 1
            for a in range(offsets[row], max(offsets[end], offsets[row] + 1), CHUNK):
                b = min(a + CHUNK, offsets[end])
                if a >= b:
                    continue
                three, two = _grams(raw[a:b])
                per = self.weights[three] + self.weights[two]
                inner = np.maximum(offsets[row:end], a) - a
                full = np.flatnonzero(offsets[row + 1:end + 1] > np.maximum(offsets[row:end], a))
                sums = np.add.reduceat(per, inner[full], axis=0, dtype=np.float32) if len(full) else 0
                out[row + full] += sums
            row = end
        size = np.maximum(np.diff(offsets), 1)[:, None]
        return out / (2 * size)

    def predict(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language number, its probability and whether it is ambiguous."""
        n = len(offsets) - 1
        if len(self.languages) < 2:
            return np.zeros(n, int), np.full(n, 1.0 if self.languages else 0.0), np.zeros(n, bool)
        logits = self.margins(raw, offsets) * self.scale
        loss = np.zeros((n, len(self.languages)))
        for i, word in enumerate(self.code):
            loss[:, i] = (np.logaddexp(0, -logits * word) * self.trust).sum(axis=1)
        p = np.exp(loss.min(axis=1, keepdims=True) - loss)
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        top = p[np.arange(n), best]
        rest = p.copy()
        rest[np.arange(n), best] = -1
        return best, top, top - rest.max(axis=1) < AMBIGUOUS


def fit(texts: list[str], languages: list[str]) -> LanguageModel:
    """Fit from training texts; languages in alphabetical order."""
    names = sorted(set(languages))
    code = codewords(len(names))
    if len(names) < 2:
        return LanguageModel(names, code, np.zeros((BUCKETS, 1), np.float32), np.ones(1), np.ones(1))
    counts = np.full((len(names), BUCKETS), 0.0)
    where = {x: i for i, x in enumerate(names)}
    for t, lang in zip(texts, languages, strict=True):
        for g in _grams(np.frombuffer(t.encode(), np.uint8)):
            counts[where[lang]] += np.bincount(g, minlength=BUCKETS)
    share = (counts + 0.05) / (counts + 0.05).sum(axis=1, keepdims=True)      # each language weighs the same
    weights = np.empty((BUCKETS, code.shape[1]), np.float32)
    for j in range(code.shape[1]):
        weights[:, j] = np.log(share[code[:, j] > 0].mean(axis=0)) - np.log(share[code[:, j] < 0].mean(axis=0))
    model = LanguageModel(names, code, weights, np.ones(code.shape[1]), np.ones(code.shape[1]))
    blobs = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blobs])])
    margins = model.margins(np.frombuffer(b"".join(blobs), np.uint8), offsets)
    signs = code[[where[x] for x in languages]].astype(float)
    model.scale = 4.0 / np.maximum(np.abs(margins).mean(axis=0), 1e-6)
    right = (margins * signs > 0).mean(axis=0)
    model.trust = np.maximum(2 * right - 1, 0.05)
    model.trust /= model.trust.mean()
    return model


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Fit on a bounded sample (``PER_LANGUAGE`` whole texts per language,
    about) of rows with a language that are not held out, chosen by a hash of
    id and text: rows without an id and rows that repeat one are drawn like
    any other, copies of a row count once."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.coalesce(~held_out(F.col("id")), F.lit(True)))
    rows = rows.where(F.length("text") <= TRAIN_CHARS)
    picked = sample_per_class(rows, ["id", "text"], "lang", PER_LANGUAGE, MAX_LANGUAGES)
    got = picked.where(F.col("text").rlike(LETTER)).select("text", "lang").collect()
    got.sort(key=lambda r: (r.lang, r.text))
    return fit([r.text for r in got], [r.lang for r in got])


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """``lang_pred``, ``score`` (0 to 1) and ``ambiguous`` for every whole text.

    Without ``keep`` the result has the id and these; ``keep`` names columns of
    ``docs`` to carry along instead of the id alone.  Null texts and texts
    without a letter are ``und`` with score 0, not ambiguous; so is every text
    if no language was learned.  Repeated rows and null ids keep a row each;
    an empty table gives an empty result.
    """
    kept = [id_col] if keep is None else list(keep)
    plain, back = kept_columns(docs, kept, text_col)
    plain = plain.withColumn("letters", F.coalesce(F.col("text").rlike(LETTER), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            best, p, unsure = model.predict(*utf8(part.column("text")))
            letters = np.asarray(part.column("letters").to_pylist(), bool) & bool(model.languages)
            names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*carried(part), pa.array(names, pa.string()), pa.array(np.where(letters, p, 0.0)), pa.array(unsure & letters)],
                names=[*CARRIED, "lang_pred", "score", "ambiguous"])

    schema = plain.select(*CARRIED).schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    out = python_pass(plain, run, schema)
    return out.select(*back, "lang_pred", "score", "ambiguous")
