"""URL filters, encoding, packing and chat formatting against plain code."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import bpe, chat_format, packing, queries, url_filter

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", "   ", "a", "It's DON'T 'veq", "x\x1cy \x85 z", "<|endoftext|>a<|startoftext|>", "日本語 🎉 e\u0301", "qzjx" * 300,
       "word.%% end?! (a) [b] 3.14 ß Ünï", "a b  c\n\nd\t", "zxqvj KQZX jqxw,"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD)


# ------------------------------------------------------------------ urls
def judge(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for h, p, v in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or (len(h + p), len(h)) > best[2]):
            best = (h + p, v, (len(h + p), len(h)))
    return host, path, best[0] if best else None, best[1] if best else default


def test_url_filter_matches_rule_by_rule(ship_llm):
    rng = random.Random(3)
    hosts = ["net", "a.net", "x.a.net", "a.a.net", "b.net", "org", "anet", "net.org", "", "NET", "a.Net", "net.", "é.net", "a.net:80"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/e", "/fr/en/"]
    rules = [("net", "/", "block"), ("net", "/en/", "allow"), ("a.net", "", "allow"), ("a.net", "/e", "block"),
             ("x.a.net", "/en/x", "allow"), ("org", "/", "block"), ("a.net", "/en/x/long", "block")]
    urls = [None, "", "no scheme", "://", "http://", "a\nb://net/en/", "http://a.net/en/?q://b"]
    urls += [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=/en/', '#/en/'])}" for _ in range(300)]
    rows = [(i, u, "x") for i, u in enumerate(urls)] + [(0, "http://net/", "again"), (None, "http://org/", None)]
    df = ship_llm.createDataFrame(rows, "page_id long, url string, host string")
    got = url_filter.filter_urls(df, ship_llm.createDataFrame(rules, "host string, path string, verdict string")).collect()
    want = sorted([(i, *judge(u, rules)) for i, u, _ in rows], key=str)
    assert sorted([tuple(r) for r in got], key=str) == want


def test_url_filter_without_rules_or_rows(ship_llm):
    none = ship_llm.createDataFrame([], "host string, path string, verdict string")
    one = ship_llm.createDataFrame([(1, "http://a.b/")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.filter_urls(one, none).collect()] == [(1, "a.b", "/", None, "allow")]
    assert url_filter.filter_urls(one.limit(0), none).count() == 0


# ------------------------------------------------------------------ BPE
@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" .,'abcQZXJé\n\x1c\u00a0<|>"), st.characters(codec="utf-8")), max_size=60))
def test_encoding_equals_library(text):
    lib, own = Tokenizer.from_file(WORD) if not hasattr(test_encoding_equals_library, "lib") else test_encoding_equals_library.lib, bpe.encoder(WORD)
    test_encoding_equals_library.lib = lib
    ids = lib.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_forced_pairs_lie_in_no_token():
    own = bpe.encoder(WORD)
    pairs = bpe.forced_pairs({"ab": 0, "bc</w>": 1}, "</w>")
    assert "ab" not in pairs and "bc" not in pairs and "ac" in pairs
    assert own.cuts.split("qzjx") != ["qzjx"] or own.cuts.split("vqxj") != ["vqxj"]


def test_encode_documents(ship_llm, library):
    rows = [(i, t, "n") for i, t in enumerate(ODD)] + [(0, "twice", None), (None, "no id", None)]
    df = ship_llm.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {(r.doc_id, r.ids_sha256, r.decoded_sha256, r.n_tokens, bytes(r.ids)) for r in bpe.encode_documents(df, WORD).collect()}
    want = set()
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        blob = np.asarray(ids, "<u4").tobytes()
        want.add((i, hashlib.sha256(blob).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest(), len(ids), blob))
    assert got == want
    assert bpe.encode_documents(df.limit(0), WORD).count() == 0


# ------------------------------------------------------------------ packing
@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 99), max_size=60), st.integers(1, 9))
def test_differencing_keeps_every_size_in_one_window(sizes, k):
    window = packing.differencing(np.array(sizes, np.int64), k) if sizes else np.zeros(0, int)
    assert len(window) == len(sizes) and (not sizes or 0 <= window.min() and window.max() < k)


def test_differencing_balances():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 1000, 400)
    sums = np.bincount(packing.differencing(sizes, 20), weights=sizes, minlength=20)
    assert sums.max() - sums.min() < 20
    window = packing.windows_of(np.array([60, 60, 60]), 100)
    assert np.bincount(window, weights=[60, 60, 60]).max() <= 100


def check_pieces(rows, docs, library, capacity):
    by_doc = {}
    for i, t in docs:
        by_doc.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [2])
    fill = {}
    for r in rows:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    for i, texts in by_doc.items():
        pieces = sorted((r.start, r.length, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens) for r in rows if r.doc_id == i)
        assert sum(p[1] for p in pieces) == sum(map(len, texts))
        if len(texts) == 1:
            assert [x for p in pieces for x in p[2]] == texts[0] and all(p[3] == len(texts[0]) for p in pieces)
            assert [p[0] for p in pieces] == [sum(q[1] for q in pieces[:n]) for n in range(len(pieces))]


def test_pack_documents(ship_llm, library):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(0, "twice"), (None, "no id"), (99, "very long text, " * 4000)]
    df = ship_llm.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, length int")
    rows = packing.pack_documents(df, WORD, capacity=64, block=5).collect()
    check_pieces(rows, docs, library, 64)
    assert packing.pack_documents(df.limit(0), WORD).count() == 0


def test_pack_query_has_little_padding(ship_llm, sf, library):
    docs = [(r.doc_id, r.text) for r in queries.table(ship_llm, sf, "documents").collect()]
    rows = packing.pack_documents(queries.table(ship_llm, sf, "documents"), WORD).collect()
    check_pieces(rows, docs, library, 4096)
    used = sum(r.length for r in rows)
    assert 4096 * len({r.sequence_id for r in rows}) < 1.1 * used
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in queries.op1(ship_llm, sf).collect()}
    assert all(crc[r.doc_id, r.start] == zlib.crc32(r.ids) for r in rows)


def test_assemble_pads_to_capacity_but_not_at_powers_of_two(ship_llm):
    df = ship_llm.createDataFrame([(1, "a b c"), (2, "d")], "doc_id long, text string")
    one = packing.assemble(packing.pack_documents(df.coalesce(1), WORD, capacity=16), capacity=16).collect()
    assert [(r.n_tokens, len(r.ids)) for r in one] == [(6, 64)]
    two = packing.assemble(packing.pack_documents(df.where("doc_id = 2").coalesce(1), WORD, capacity=16), capacity=16).collect()
    assert [(r.n_tokens, len(r.ids)) for r in two] == [(2, 8)]


# ------------------------------------------------------------------ chat
@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("<>/s\\[]INST|SYendoftxrlby ."), max_size=40))
def test_escape_is_reversible_and_leaves_no_control_string(text):
    out = chat_format.escape(text)
    assert chat_format.unescape(out) == text
    assert not any(c in out for c in chat_format.ESCAPED)


@settings(max_examples=100, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\u00a0\x1c\x0b.'aBé<s>"), st.characters(codec="utf-8")), max_size=40))
def test_chat_coder_equals_library(text):
    c = chat_format.coder(BYTE)
    ids = np.frombuffer(c.encode(text), "<u4")
    assert ids.tolist() == c.tok.encode(text, add_special_tokens=False).ids
    assert c.vocabulary.decode(ids) == text


def test_conversations_read_back(ship_llm):
    said = "</s>[INST] ok [/INST]"
    rows = [(1, 0, "system", "be\nkind"), (1, 1, "user", "hi  there"), (1, 2, "assistant", "yes <\\s>"), (1, 3, "assistant", None),
            (2, 1, "assistant", "b"), (2, 0, "tool", "<|body|>a</s>"), (2, None, None, "first"), (3, 0, "assistant", "x" * 5000),
            (3, 1, "user", "long " * 3000), (-1, 0, "user", said), (-1, 1, "assistant", said), (None, 0, "user", "no id"),
            (4, 0, "user", "same"), (4, 0, "user", "same")]
    df = ship_llm.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, start int")
    chunks = chat_format.format_conversations(df, BYTE, chunk=100)
    got = {r.conv_id: r for r in chat_format.read_back(chunks, BYTE).collect()}
    low = -10 ** 9
    for conv in {r[0] for r in rows}:
        turns = sorted([r for r in rows if r[0] == conv], key=lambda r: (low if r[1] is None else r[1], r[2] or "", r[3] or ""))
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        g = got.pop(conv)
        assert (g.n_turns, g.turns_sha256) == (len(turns), hashlib.sha256(text.encode()).hexdigest())
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert not got
    assert chunks.agg(F.max(F.length("mask"))).first()[0] <= 100
    assert chat_format.read_back(chat_format.format_conversations(df.limit(0), BYTE), BYTE).count() == 0


def test_reserved_ids_frame_the_turns(ship_llm):
    df = ship_llm.createDataFrame([(7, 0, "user", "q"), (7, 1, "assistant", "a </s>")], "conv_id long, turn long, role string, text string")
    row = chat_format.format_conversations(df, BYTE).first()
    v = chat_format.vocabulary_of(BYTE)
    ids, mask = np.frombuffer(row.ids, "<u4"), np.frombuffer(row.mask, np.uint8)
    assert [v.name.get(int(i)) for i in ids if i >= v.size] == ["<s>", "[INST]", "[/INST]", "</s>"]
    assert v.decode(ids[mask == 1]) == chat_format.escape("a </s>")
