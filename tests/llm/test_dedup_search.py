"""Near-duplicates, substring removal, fingerprints and nearest neighbours
against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import ann, common, fingerprints, queries, simhash_dedup, substring_dedup

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------ SimHash near-duplicates
def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def simhash(text):
    w = WORDS.findall(lower(text))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(values, radius):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def near_texts(rng, n):
    base = [" ".join(rng.choice(["Alpha", "beta", "GAMMA", "délta", "eps"]) + str(rng.randrange(40)) for _ in range(60)) for _ in range(4)]
    out = []
    for _ in range(n):
        w = rng.choice(base).split()
        if rng.random() < 0.6:
            w[rng.randrange(len(w))] = "x" + str(rng.randrange(9))
        out.append(rng.choice([" ", "\t", "\n"]).join(w))
    return out


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 4), st.integers(0, 10 ** 6))
def test_some_mask_drops_any_few_positions(radius, seed):
    rng = random.Random(seed)
    masks = simhash_dedup.covering_masks(radius, (1 << 64) - 1)
    assert len(masks) == 2 ** (radius + 1) - 1
    differ = sum(1 << b for b in rng.sample(range(64), radius))
    assert any(m & differ == 0 for m in masks)


@pytest.mark.parametrize("bucket", [2048, 3])
def test_near_duplicates_equal_brute_force(ship_llm, bucket):
    rng = random.Random(5)
    texts = near_texts(rng, 60) + [None, "", " \t", "One", "one", "one two", "É x", "long word " * 3000]
    rows = [(i * 3 + 1, t, "f") for i, t in enumerate(texts)] + [(1, texts[0], "again"), (None, texts[1], "no id")]
    rng.shuffle(rows)
    df = ship_llm.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash_dedup.near_duplicates(df, bucket=bucket).collect()
    values = [simhash(r[1]) for r in rows]
    label = classes(values, 3)
    least = {}
    for r, c in zip(rows, label, strict=True):
        if r[0] is not None:
            least[c] = min(least.get(c, 10 ** 9), r[0])
    want = sorted([(r[0], f"{v:016x}", least.get(c)) for r, v, c in zip(rows, values, label, strict=True)], key=str)
    assert sorted([tuple(g) for g in got], key=str) == want
    assert simhash_dedup.near_duplicates(df.limit(0)).count() == 0


def test_split_buckets_keep_every_link(ship_llm):
    rng = random.Random(8)
    values = set()
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(60):
            values.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))))
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = ship_llm.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r.node: r.root for r in simhash_dedup.components(simhash_dedup.near_links(nodes, bucket=8)).collect()}
    got, want = {}, {}
    for v, s, c in zip(values, signed, classes(values, 3), strict=True):
        got.setdefault(roots.get(s, s), set()).add(v)
        want.setdefault(c, set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain(ship_llm):
    links = ship_llm.createDataFrame([(i, i + 1) for i in range(60)] + [(200, 100), (200, 300)], "a long, b long")
    got = {r.node: r.root for r in simhash_dedup.components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100}


# ------------------------------------------------------------------ substring removal
def remove(rows, window):
    first, words = {}, []
    for i, t in rows:
        w = WORDS.findall(t or "")
        words.append(w)
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            first[k] = min(first.get(k, 1 << 63), 1 << 62 if i is None else i)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < (1 << 62 if i is None else i):
                gone[p:p + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def passages(rng, docs):
    common = [[f"w{rng.randrange(50)}" for _ in range(rng.randrange(5, 40))] for _ in range(4)]
    out = []
    for _ in range(docs):
        w = []
        for _ in range(rng.randrange(5)):
            w += rng.choice(common) if rng.random() < 0.6 else [f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(20))]
        out.append(rng.choice([" ", "\n", " \t "]).join(w))
    return out


@pytest.mark.parametrize("group", [2000, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(ship_llm, seed, group):
    rng = random.Random(seed)
    rows = [(i, t) for i, t in enumerate(passages(rng, 80))]
    rows += [(100, None), (101, ""), (102, "a b c"), (103, "w1 " * 300), (104, "w1 " * 20), (5, rows[6][1]), (7, rows[7][1]), (None, rows[8][1]),
             (None, rows[8][1]), (105, "é x y " * 30)]
    rng.shuffle(rows)
    df = ship_llm.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, kept string")
    got = substring_dedup.remove_repeats(df, window=12, gram=5, group=group)
    assert sorted([tuple(r) for r in got.collect()], key=str) == sorted(remove(rows, 12), key=str)


def test_repeats_of_the_sample_table(ship_llm, sf):
    rows = [(r.doc_id, r.text) for r in queries.table(ship_llm, sf, "documents").collect()]
    want = {i: (n, gone, hashlib.sha256(t.encode()).hexdigest()) for i, n, gone, t in remove(rows, 50)}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op5(ship_llm, sf).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 0
    empty = queries.table(ship_llm, sf, "documents").limit(0)
    assert substring_dedup.remove_repeats(empty).count() == 0


# ------------------------------------------------------------------ fingerprints
def term_fingerprint(text):
    w = [x for x in re.split(r"[ \t-\r]+", (text or "").lower()) if x]
    votes, weight = [0] * 64, 0
    for a, b in zip(w, w[1:] + [None] * bool(w), strict=True):
        h, n = xxhash.xxh64_intdigest(a.encode(), 42), len(a)
        if b is not None:
            h, n = xxhash.xxh64_intdigest(b.encode(), h), n + len(b)
        weight += n
        votes = [v + n * (h >> i & 1) for i, v in enumerate(votes)]
    return sum(1 << i for i, v in enumerate(votes) if 2 * v > weight) if w else 0


def edits(rows):
    rows = sorted(rows, reverse=True)
    for k, (i, t) in enumerate(rows):
        nxt, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        e = t[:len(t) - half] + nxt[:half]
        a, b, c = map(term_fingerprint, (t, e, nxt))
        yield (i, len(t), hashlib.sha256(e.encode()).hexdigest(), f"{a:016x}", f"{b:016x}", 1 - bin(a ^ b).count("1") / 64, 1 - bin(a ^ c).count("1") / 64)


def test_fingerprints_equal_brute_force(ship_llm, sf):
    texts = ["", "  ", "a", "A", "a b", "b a  c\n", "Ünï cöde \U0001f389 x", "long text " * 5000, "a b"]
    rows = [(i * 7 - 9, t) for i, t in enumerate(texts)]
    df = ship_llm.createDataFrame([(i, t or None, "x") for i, t in rows] + [(-2, None, "smaller"), (None, "no id", "x")],
                                  "doc_id long, text string, fp string")
    rows = [(i, "" if i == -2 else t) for i, t in rows]
    got = fingerprints.fingerprint_edits(df).collect()
    assert sorted(tuple(r) for r in got) == sorted(edits(rows))
    one = ship_llm.createDataFrame([(1, "abcd")], "doc_id long, text string")
    assert [tuple(r) for r in fingerprints.fingerprint_edits(one).collect()] == list(edits([(1, "abcd")]))
    assert fingerprints.fingerprint_edits(df.limit(0)).count() == 0
    real = [(r.doc_id, r.text) for r in queries.table(ship_llm, sf, "documents").collect()]
    assert sorted(tuple(r) for r in queries.op8(ship_llm, sf).collect()) == sorted(edits(real))


def test_block_tables_find_all_within_the_radius(ship_llm):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(20)]
    near = [v ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for v in base for _ in range(5)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    a = ship_llm.createDataFrame([(signed(v),) for v in base] + [(None,), (signed(base[0]),)], "fp long")
    b = ship_llm.createDataFrame([(signed(v),) for v in near], "fp long")
    for radius, blocks in ((3, None), (2, 6)):
        got = {(r.query_fp, r.fp, r.distance) for r in fingerprints.within_radius(a, b, radius, blocks).collect()}
        want = {(signed(x), signed(y), d) for x in base for y in near if (d := bin(x ^ y).count("1")) <= radius}
        assert got == want and want


# ------------------------------------------------------------------ nearest neighbours
def nearest(rows, queries_, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 8 and None not in v
            and np.isfinite(np.array(v, float)).all() and any(v)]
    ids, m = np.array([g[0] for g in good]), np.array([g[1] for g in good])
    for q in sorted(set(queries_)):
        for v in [x for i, x in good if i == q][:1]:
            s = m @ v
            s = np.where(ids == q, -np.inf, s)
            top = [t for t in np.lexsort((ids, -s))[:k] if s[t] > -np.inf]
            for rank, t in enumerate(top, 1):
                yield q, rank, int(ids[t]), float(s[t])


def test_nearest_equals_brute_force_on_small_input(ship_llm):
    rng = np.random.default_rng(4)
    rows = [(i, [int(x) / 2 for x in rng.integers(-9, 10, 8)]) for i in range(150)]      # exact in binary: ties are ties
    rows += [(200 + i, rows[3][1]) for i in range(40)]
    rows += [(300, None), (301, [0.0] * 8), (302, [1.0] * 7 + [None]), (303, [float("nan")] * 8), (304, [float("inf")] * 8), (305, []), (306, [1.0]),
             (None, rows[0][1])]
    df = ship_llm.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    asked = [0, 20, 40, 60, 200, 220, 300, 301]
    got = sorted(tuple(r) for r in ann.nearest(df, df.where(df.vec_id.isin(asked)), 20, error=50.0).collect())
    want = sorted(nearest(rows, asked, 20))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])
    few = ship_llm.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in ann.nearest(few, few.where("vec_id = 0"), 20).collect()] == [(0, 1, 1, 2.5)]
    assert ann.nearest(df.limit(0), df.limit(0), 20).count() == 0


def test_recall_on_the_sample_table(ship_llm, sf):
    rows = [(r.vec_id, r.embedding) for r in queries.table(ship_llm, sf, "embeddings").collect()]
    ids, m = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got = {}
    for r in queries.op7(ship_llm, sf).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = m @ m[q]
        s[q] = -np.inf
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        hit, total = hit + len(best & got[int(ids[q])]), total + len(best)
    assert hit / total >= 0.9


def test_error_bound_holds_for_most_vectors():
    rng = np.random.default_rng(6)
    v, q = rng.normal(size=(4000, 64)), rng.normal(size=64)
    turn = ann.rotation(256)
    code, norm, fit = ann.encode(v, turn)
    signs = np.unpackbits(code, axis=1) * 2.0 - 1
    norm = 2 ** norm
    estimate = (q @ turn[:64]) @ signs.T * norm / fit / 16
    bound = norm * np.sqrt(1 - fit * fit) / fit * ann.ERROR / np.sqrt(255) * np.linalg.norm(q)
    assert (np.abs(estimate - v @ q) <= bound).mean() > 0.9


def test_any_finite_norm_keeps_its_neighbours(ship_llm):
    rng = np.random.default_rng(9)
    v = rng.normal(size=(600, 64)) * 10.0 ** rng.choice([-150, -20, 0, 20, 150], size=(600, 1))
    df = ship_llm.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, 600, 20)) and all(len(g) == 20 for g in got.values())
    hit = 0
    for q, found in got.items():
        s = v @ v[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(600), -s))[:20].tolist()
        hit += len(set(best) & {i for _, i, _ in found})
        assert [i for _, i, _ in sorted(found)] == sorted([i for _, i, _ in found], key=lambda i: (-s[i], i))
    assert hit >= 0.9 * 20 * 30
    huge = ship_llm.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(rng.normal(size=(60, 8)) * 1e20)], "vec_id long, embedding array<float>")
    assert ann.nearest(huge, huge.where("vec_id % 20 = 0"), 20).count() == 60


def test_query_planes_give_the_product_with_a_code():
    rng = np.random.default_rng(3)
    t, code = rng.normal(size=(5, 128)), rng.integers(0, 2, (7, 128))
    planes, low, step = ann.query_planes(t)
    rounded = low + step * sum((np.unpackbits(p.view(np.uint8), axis=1).astype(float) * 2 ** j for j, p in enumerate(planes)))
    assert np.abs(rounded - t).max() <= step.max() / 2 + 1e-9
    words = np.packbits(code, axis=1).view(np.uint64)
    bits = sum(np.bitwise_count(p[:, None, :] & words[None]).sum(axis=2).astype(float) * 2 ** j for j, p in enumerate(planes))
    assert np.allclose(low * code.sum(axis=1) + step * bits, rounded @ code.T)


# ------------------------------------------------------------------ rows that share an id, words that share a hash
def test_rows_of_one_id_with_many_texts(ship_llm):
    rng = random.Random(31)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(None, f"{rng.randrange(10 ** 9)} a") for _ in range(30000)] + [(7, f"{rng.randrange(10 ** 9)} b") for _ in range(30000)]
    rows += [(1, passage), (None, "start " + passage), (7, passage + " end"), (7, passage + " end"), (7, "x " * 60)]
    df = ship_llm.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.remove_repeats(df).where("n_words > 2").collect()
    assert sorted([tuple(r) for r in got], key=str) == sorted(
        [(1, 60, 0, passage), (None, 61, 60, "start"), (7, 61, 60, "end"), (7, 61, 60, "end"), (7, 60, 0, "x " * 59 + "x")], key=str)


def test_texts_behind_one_old_hash_keep_their_own_cuts(ship_llm):
    """Texts of one id whose 32-bit row hashes meet; one of them is cut."""
    words = [f"w{i}" for i in range(50)]
    many = ship_llm.range(150000).selectExpr("id", "concat(id, ' z') AS text").selectExpr("text", "hash(text) AS h")
    twins = many.groupBy("h").agg({"text": "collect_list"}).where("size(`collect_list(text)`) > 1").limit(3).collect()
    assert twins
    rows = [(1, " ".join(words))] + [(i, t) for r in twins for i in (None, 5) for t in r[1]] + [(5, " ".join(words) + " tail")]
    got = substring_dedup.remove_repeats(ship_llm.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted([(r.doc_id, r.kept_text) for r in got], key=str) == sorted(
        [(i, "tail" if t.endswith("tail") else t) for i, t in rows], key=str)


def test_words_of_one_polynomial_hash_differ(ship_llm):
    a, b = "x", "y"
    for _ in range(10):
        a, b = a + b, b + a
    head = " ".join(f"h{i}" for i in range(49))
    df = ship_llm.createDataFrame([(1, f"{head} {a}"), (2, f"{head} {b}"), (3, f"{head} {b} c")], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(df).collect()}
    assert got == {1: 0, 2: 0, 3: 50}
    raw = np.frombuffer(f"{a} {b}".encode(), np.uint8)
    h = common.place_hashes(raw, np.array([0, len(a) + 1]), np.array([len(a), len(raw)]))
    assert h[0] != h[1]
