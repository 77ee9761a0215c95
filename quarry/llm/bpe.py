"""BPE encoding and decoding with forced boundaries.

A byte pair that occurs inside no vocabulary token can never be merged over,
so every such pair is a certain cut: the bytes before and after it are encoded
independently and the ids concatenated.  White space occurs in no token of the
word vocabulary, so each blank is such a cut; inside a run of ASCII letters the
pairs found by scanning the vocabulary are cuts too.  Fragments repeat, so a
task encodes each distinct one once (a table of bounded size) and a text of any
length is the concatenation of its fragments.

Words end in a mark (``end_of_word_suffix``) that only the last fragment of a
word may take; the others are encoded by the same vocabulary and merges
without the mark.  The tokenizers library encodes a fragment; nothing is
trained.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Known, python_pass, slices

FRAGMENTS = 600_000       # fragments in a task's table at most
FREQUENT = 150_000        # of these, those that stay when it is full and from task to task
LONG = 64                 # longer fragments are encoded but not kept
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_ASCII_CONTROL_BLANKS = "\x1c\x1d\x1e\x1f"     # blank to str.split, not to the vocabulary's pattern
_OTHER_SPLIT = re.compile(r"[^ \t\n\r\x0b\x0c]+")
# a run of Latin-1 letters (one word to the vocabulary's pattern, unchanged by
# NFC) and ASCII punctuation behind it but apostrophes (the pattern's next word)
_PLAIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


# Fixed value: the word pattern of the vocabulary file.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def forced_pairs(vocab: dict[str, int], suffix: str = "") -> set[str]:
    """Pairs of lower-case ASCII letters that lie inside no token."""
    inside: set[str] = set()
    for token in vocab:
        t = token[:-len(suffix)] if suffix and token.endswith(suffix) else token
        inside.update(t[i:i + 2] for i in range(len(t) - 1))
    return {a + b for a in _LETTERS for b in _LETTERS} - inside


class WordBpe:
    """Encoder of a lower-casing word-end vocabulary, cut at forced boundaries."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.open = models.BPE(vocab=model["vocab"], merges=merges)      # inside a word: no end mark
        self.special = [a["content"] for a in spec["added_tokens"]]
        self.strings = {i: t for t, i in self.whole.get_vocab(with_added_tokens=True).items()}
        pairs = forced_pairs(model["vocab"], self.suffix) if self.suffix else set()
        by_first: dict[str, str] = {}
        for p in sorted(pairs):
            by_first[p[0]] = by_first.get(p[0], "") + p[1]
        self.cuts = re.compile("|".join(f"(?<={a})(?=[{b}])" for a, b in by_first.items()), re.I | re.A) if by_first else None
        self.model = self.whole.model
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.visible = {b: 256 + i for i, b in enumerate(hidden)}          # byte-level stand-ins of other bytes
        # the short way for plain words holds for the pattern that it was read from
        self.plain = bool(self.suffix) and json.dumps(spec["pre_tokenizer"]).count(json.dumps(WORD_PATTERN)) == 1
        self.rare = re.compile("[" + "".join(by_first) + "]") if by_first else None      # letters before which a cut can fall
        self.table = Known(self._ids, FRAGMENTS, FREQUENT, LONG)

    def _ids(self, fragment: str) -> bytes:
        """Ids of one fragment: cut on at its own forced pairs, word by word."""
        word = _PLAIN_WORD.fullmatch(fragment) if self.plain else None
        if word is None:
            return _packed(self.whole.encode(fragment, add_special_tokens=False).ids)
        letters, stops = word.groups()
        letters = letters.lower()
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(self.visible)
        if self.rare is not None and self.rare.search(letters):
            *parts, letters = self.cuts.split(letters)
            ids = [t.id for part in parts for t in self.open.tokenize(part)] + [t.id for t in self.model.tokenize(letters)]
        else:
            ids = [t.id for t in self.model.tokenize(letters)]
        if stops:
            ids += [t.id for t in self.model.tokenize(stops)]
        return _packed(ids)

    def fragments(self, text: str) -> list[str]:
        """The text cut at every blank (blanks are in no token)."""
        return _OTHER_SPLIT.findall(text) if any(c in text for c in _ASCII_CONTROL_BLANKS) else text.split()

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        out = b"".join(map(self.table.__getitem__, self.fragments(text)))
        self.table.bound()
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """As the library does without a decoder: token strings, one space between."""
        return " ".join(map(self.strings.__getitem__, ids))


_PACK = [struct.Struct(f"<{n}I").pack for n in range(33)]


def _packed(ids: list[int]) -> bytes:
    return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else np.asarray(ids, "<u4").tobytes()


_ENCODERS: dict[str, WordBpe] = {}


def encoder(path: str) -> WordBpe:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordBpe(path)
    return _ENCODERS[path]


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                     keep_ids: bool = True) -> DataFrame:
    """Encode every whole text and decode it again.

    Returns id, ``n_tokens`` long, ``ids`` binary (little-endian unsigned
    32-bit; only with ``keep_ids``), ``ids_sha256`` and ``decoded_sha256``.
    Special-token strings in a text become their ids, as in the library.  Null
    and empty texts have no ids and decode to an empty text.  Repeated rows and
    null ids keep a row each; other columns are ignored, whatever their names.
    An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        strings = Known(lambda ids: enc.decode(np.frombuffer(ids, "<u4").tolist()), FRAGMENTS // 2, FREQUENT // 2, 4 * LONG)
        for part in slices(batches, "text"):
            counts, ids, id_sha, text_sha = [], [], [], []
            for text in part.column("text").to_pylist():
                encoded = list(map(enc.table.__getitem__, enc.fragments(text or "")))
                blob = b"".join(encoded)
                counts.append(len(blob) // 4)
                id_sha.append(hashlib.sha256(blob).hexdigest())
                decoded = " ".join(filter(None, map(strings.__getitem__, encoded)))
                text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                if keep_ids:
                    ids.append(blob)
                enc.table.bound()
                strings.bound()
            cols = [part.column("id"), pa.array(counts, pa.int64())]
            names = ["id", "n_tokens"]
            if keep_ids:
                cols.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays([*cols, pa.array(id_sha), pa.array(text_sha)], names=[*names, "ids_sha256", "decoded_sha256"])
        enc.table.trim()

    schema = "id long, n_tokens long, " + ("ids binary, " if keep_ids else "") + "ids_sha256 string, decoded_sha256 string"
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return python_pass(rows, run, schema).withColumnRenamed("id", id_col)
