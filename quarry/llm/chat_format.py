"""Chat formatting at token level.

Every text is encoded on its own by a reversible byte-level vocabulary, where
its row lies; reserved ids (above the vocabulary, so no text can produce them)
are spliced around the segments, and the loss mask and all offsets follow from
prefix sums of the segment lengths.  Control strings that occur inside a text
are escaped reversibly before it is encoded, so the rendered text is
unambiguous too.

Template (markers are one reserved id each)::

    <s>  [INST] user [/INST]  assistant </s>  <<SYS>> system <</SYS>>
         <|role|> any other role <|body|> text </s>

A conversation is written as chunks of bounded length in order, so one of any
length passes through a task as a stream.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Known, python_pass, slices

CHUNK = 1 << 15           # tokens of a written chunk
FRAGMENTS, FREQUENT, LONG = 150_000, 40_000, 64

# The control strings of the template, in the order of their ids.
MARKERS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>", "<|body|>"]
ESCAPED = [*MARKERS, "<|endoftext|>"]

_ESCAPE = re.compile("|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in ESCAPED))
_UNESCAPE = re.compile("|".join(f"{re.escape(c[0])}\\\\+{re.escape(c[1:])}" for c in ESCAPED))
_CHUNKS = re.compile(r"[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+")
# one blank, a run of Latin-1 letters (one word to the pattern) and ASCII
# punctuation behind it but apostrophes (the pattern's next word)
_PLAIN_WORD = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_OTHER_BLANK = re.compile(r"[^\S \t\r\n]")


def escape(text: str) -> str:
    """One more backslash behind the first character of every control string
    (with any number of them there), so that none is left."""
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[0][0] + m[0][2:], text)


def _alphabet() -> dict[str, int]:
    """Bytes of the printable stand-ins of byte-level vocabularies: a visible
    Latin-1 character stands for itself, the others in turn for the characters
    from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """The bytes of every id, and the reserved ids above them."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        alphabet = _alphabet()
        tokens = spec["model"]["vocab"] | {a["content"]: a["id"] for a in spec["added_tokens"]}
        added = {a["content"] for a in spec["added_tokens"]}
        self.size = max(tokens.values()) + 1
        self.bytes: list[bytes] = [b""] * self.size
        for token, i in tokens.items():
            self.bytes[i] = token.encode() if token in added else bytes(alphabet[c] for c in token)
        self.marker = {m: self.size + i for i, m in enumerate(MARKERS)}
        self.name = {i: m for m, i in self.marker.items()}

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode()


class Coder:
    """Encoder of a reversible byte-level vocabulary."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.vocabulary = vocabulary_of(path)
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.tok.encode_special_tokens = True
        self.visible = {b: ord(c) for c, b in _alphabet().items()}
        self.pieces = Known(self._ids, FRAGMENTS, FREQUENT, LONG)

    def _ids(self, piece: str) -> bytes:
        word = _PLAIN_WORD.fullmatch(piece)
        if word is None:
            ids = self.tok.encode(piece, add_special_tokens=False).ids
        else:
            parts = [p.encode().decode("latin-1").translate(self.visible) for p in word.groups() if p]
            ids = [t.id for p in parts for t in self.tok.model.tokenize(p)]
        return np.asarray(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.  The pattern before
        the merges never joins a non-blank with blanks after it, so the text is
        cut before each run of blanks and each distinct piece encoded once.  A
        text with other than the four usual blanks is not cut."""
        parts = [text] if _OTHER_BLANK.search(text) else _CHUNKS.findall(text)
        out = b"".join(map(self.pieces.__getitem__, parts))
        self.pieces.bound()
        return out


@functools.cache
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


@functools.cache
def coder(path: str) -> Coder:
    return Coder(path)


def _segment(c: Vocabulary, role: str, role_ids: bytes, body: bytes) -> tuple[bytes, int, int]:
    """A turn's ids with its markers, and where its text lies among them."""
    mark = lambda name: np.asarray([c.marker[name]], "<u4").tobytes()
    if role == "user":
        head, tail = mark("[INST]"), mark("[/INST]")
    elif role == "system":
        head, tail = mark("<<SYS>>"), mark("<</SYS>>")
    elif role == "assistant":
        head, tail = b"", mark("</s>")
    else:
        head, tail = mark("<|role|>") + role_ids + mark("<|body|>"), mark("</s>")
    return head + body + tail, len(head) // 4, len(body) // 4


def format_conversations(turns: DataFrame, vocabulary: str, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Formatted conversations, cut into chunks of at most ``chunk`` tokens.

    Returns conv id, ``start`` long (tokens before the chunk), ``ids`` binary
    (little-endian unsigned 32-bit), ``mask`` binary (a byte per token, 1 where
    the loss counts: the text of an assistant turn) and ``n_turns`` int (turns
    that begin in the chunk).  The chunks of a conversation lie in one
    partition, in order.  Turns go by turn number (null first), then role and
    text; a repeated row is a turn of its own.  A null role is an empty name, a
    null text an empty text, a null conversation id a conversation.  Other
    columns are ignored; an empty table gives an empty result.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(vocabulary)
        for part in slices(batches, "text"):
            roles = part.column("role").to_pylist()
            bodies = [c.encode(escape(t)) for t in part.column("text").to_pylist()]
            names = [c.encode(escape(r)) for r in roles]
            made = [_segment(c.vocabulary, r, n, b) for r, n, b in zip(roles, names, bodies, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("conv"), part.column("turn"), part.column("role"), pa.array([m[0] for m in made], pa.binary()),
                 pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.int64())],
                names=["conv", "turn", "role", "ids", "before", "length"])
        c.pieces.trim()

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = vocabulary_of(vocabulary)
        begin = np.asarray([c.marker["<s>"]], "<u4").tobytes()
        out: list[tuple] = []
        conv, opened = None, False
        ids, mask, start, turns = bytearray(), bytearray(), 0, 0

        def write(all_of_it: bool) -> None:
            nonlocal start, turns
            while len(mask) > chunk or all_of_it and mask:
                n = min(chunk, len(mask))
                out.append((conv, start, bytes(ids[:4 * n]), bytes(mask[:n]), turns))
                del ids[:4 * n], mask[:n]
                start, turns = start + n, 0

        def rows() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [()] * 5
            batch = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(
                cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32()), strict=True)],
                names=["conv", "start", "ids", "mask", "n_turns"])
            out.clear()
            return batch

        for batch in slices(batches, "ids"):
            for who, role, seg, before, length in zip(*(batch.column(x).to_pylist() for x in ("conv", "role", "ids", "before", "length")), strict=True):
                if not opened or who != conv:
                    write(True)
                    conv, opened, start, turns = who, True, 0, 0
                    ids += begin
                    mask += b"\0"
                loss = b"\1" if role == "assistant" else b"\0"
                ids += seg
                mask += b"\0" * before + loss * length + b"\0" * (len(seg) // 4 - before - length)
                turns += 1
                write(False)
            if out:
                yield rows()
        write(True)
        if out:
            yield rows()

    rows = turns.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    coded = python_pass(rows, encode, "conv long, turn long, role string, ids binary, before long, length long")
    dealt = coded.repartition("conv").sortWithinPartitions("conv", "turn", "role", "ids")
    return python_pass(dealt, assemble, "conv long, start long, ids binary, mask binary, n_turns int").withColumnRenamed("conv", conv_col)


class _Reader:
    """Reads one conversation back from its tokens, chunk by chunk."""

    def __init__(self, c: Vocabulary):
        self.c = c
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0
        self.role, self.kind, self.parts, self.masked = None, "assistant", [], []

    def feed(self, ids: np.ndarray, mask: np.ndarray) -> None:
        at = 0
        for stop in np.flatnonzero(ids >= self.c.size).tolist():
            self._text(ids[at:stop], mask[at:stop])
            self._mark(self.c.name[int(ids[stop])])
            at = stop + 1
        self._text(ids[at:], mask[at:])

    def _text(self, ids: np.ndarray, mask: np.ndarray) -> None:
        if len(ids):
            self.parts.append(ids)
            if mask.any():
                self.masked.append(ids[mask == 1])

    def _whole(self) -> str:
        raw = b"".join(self.c.bytes[i] for p in self.parts for i in p.tolist()).decode()
        self.parts = []
        self.chars += len(raw)
        return raw

    def _mark(self, name: str) -> None:
        self.chars += len(name)
        if name == "<|body|>":
            self.role = unescape(self._whole())
        elif name in ("[/INST]", "<</SYS>>", "</s>"):
            text = unescape(self._whole())
            role = {"[/INST]": "user", "<</SYS>>": "system"}.get(name, self.role if self.role is not None else "assistant")
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
            if self.masked:
                loss = unescape(b"".join(self.c.bytes[i] for p in self.masked for i in p.tolist()).decode())
                self.loss.update(loss.encode())
                self.loss_chars += len(loss)
                self.masked = []
            self.role = None

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(chunks: DataFrame, vocabulary: str, conv_col: str = "conv_id") -> DataFrame:
    """What the formatted tokens say, one row per conversation: ``n_turns``,
    ``turns_sha256`` (role, line feed, text, line feed per turn),
    ``loss_chars`` and ``loss_sha256`` of the text under the mask, unescaped,
    and ``formatted_chars`` of the rendered text with its markers.  ``chunks``
    must come from ``format_conversations`` in this plan (in order)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = vocabulary_of(vocabulary)
        conv, reader, out = None, None, []

        def rows() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            batch = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(
                cols, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)],
                names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            out.clear()
            return batch

        for batch in batches:
            for who, start, ids, mask in zip(*(batch.column(x).to_pylist() for x in ("conv", "start", "ids", "mask")), strict=True):
                if reader is None or start == 0:
                    if reader is not None:
                        out.append((conv, *reader.row()))
                    conv, reader = who, _Reader(c)
                reader.feed(np.frombuffer(ids, "<u4"), np.frombuffer(mask, np.uint8))
            if out:
                yield rows()
        if reader is not None:
            out.append((conv, *reader.row()))
            yield rows()

    plain = chunks.select(F.col(conv_col).alias("conv"), "start", "ids", "mask")
    return python_pass(plain, run, "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long") \
        .withColumnRenamed("conv", conv_col)
