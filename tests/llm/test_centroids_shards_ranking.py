"""Centroid clustering, sharding and ranked search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import centroids, ranking, sharding


# ------------------------------------------------------------------ centroid clustering
def kmeans(rows, k, rounds, dim, scale):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    points = [[centroids.scaled(x, scale) for x in v] for _, v in kept]
    key = [("~" if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept]
    at = [points[i] for i in sorted(range(len(kept)), key=key.__getitem__)[:k]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c, strict=True)), j) for j, c in enumerate(at))

    for _ in range(rounds):
        own = [nearest(p)[1] for p in points]
        at = [[sum(x) // own.count(j) for x in zip(*[p for p, o in zip(points, own, strict=True) if o == j], strict=True)]
              if j in own else c for j, c in enumerate(at)]
    last = [nearest(p) for p in points]
    total = sum(d for d, _ in last)
    sums = [sum(d for d, o in last if o == j) for j in range(len(at))]
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    fits = (lambda x: x if x < 1 << 63 else None)
    return sorted([(i, o, fits(d), fits(sums[o]), fits(total), name[o]) for (i, _), (d, o) in zip(kept, last, strict=True)], key=str)


def odd_vectors(rng, n, dim, size):
    rows = [(i, [rng.gauss(0, size) for _ in range(dim)]) for i in range(n)]
    rows += rows[:3] + [(None, rows[4][1]), (5, rows[6][1]), (900, [0.0] * dim), (901, None), (902, []), (903, [1.0] * (dim - 1)),
                        (904, [None] + [1.0] * (dim - 1)), (905, [float("nan")] * dim), (906, [float("-inf")] * dim)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [0.05, 30.0, 1e9, 1e30])
def test_clusters_equal_brute_force(ship_llm, size):
    rows = odd_vectors(random.Random(3), 60, 4, size)
    df = ship_llm.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, id string")
    got = centroids.cluster_vectors(df, k=7, rounds=3, dim=4).collect()
    assert sorted([tuple(r) for r in got], key=str) == kmeans(rows, 7, 3, 4, 256)


def test_few_or_no_vectors(ship_llm):
    df = ship_llm.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    got = centroids.cluster_vectors(df, k=5, rounds=2, dim=2).collect()
    assert sorted((r.vec_id, r.cluster, r.distance, r.inertia) for r in got) == [(1, 0, 0, 0), (2, 0, 0, 0)]
    assert centroids.cluster_vectors(df, dim=3).collect() == []
    assert centroids.cluster_vectors(df.limit(0)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_orchard_skips_and_settles_ties():
    rng = np.random.default_rng(1)
    at = rng.integers(-1000, 1000, (30, 2))
    at[7] = at[3]
    points = np.concatenate([rng.integers(-1000, 1000, (500, 2)), at, (at[:10] + at[10:20]) // 2])
    gap = ((points[:, None] - at[None]) ** 2).sum(axis=2)
    cluster, far, measured = centroids.orchard(points, at.astype(object))
    assert (cluster == gap.argmin(axis=1)).all() and (far == gap.min(axis=1)).all()
    assert measured < 0.7 * gap.size


def test_limbs_add_up():
    for v in ([0, -1, 5], [2 ** 70, -2 ** 90, 2 ** 31], [-2 ** 31, 2 ** 31 - 1, 7]):
        parts = centroids._limbs(v)
        assert [sum(p[j] << 32 * i for i, p in enumerate(parts)) for j in range(3)] == v
        assert all(-2 ** 63 <= x < 2 ** 63 for p in parts for x in p)


# ------------------------------------------------------------------ shards
def cut_by_sorting(points, goal):
    rows = sorted(points)
    sums = [0]
    for r in rows:
        sums.append(sums[-1] + r[2])
    best = min(range(len(sums)), key=lambda i: (abs(sums[i] - goal), i))
    return {r[:2] for r in rows[:best]}


@pytest.mark.parametrize("most", [4, 40, 1 << 12])
def test_weighted_medians_equal_sorting(ship_llm, most):
    rng = random.Random(2)
    nodes = {0: [], 3: [], 5: []}
    for i in range(300):
        nodes[0].append((rng.choice([1.0, 2.0, 2.0, 5.5, -1e300]), rng.getrandbits(64) - 2 ** 63, rng.randrange(1, 50)))
        nodes[3].append((rng.gauss(0, 1e6), i, rng.randrange(1, 9) ** 4))
    nodes[5] = [(7.0, 1, 10), (7.0, 2, 1)]
    df = ship_llm.createDataFrame([(n, *p) for n, ps in nodes.items() for p in ps], "node int, x double, h long, weight long")
    goals = {n: sum(p[2] for p in ps) * f for (n, ps), f in zip(nodes.items(), (0.5, 2 / 3, 0.5), strict=True)}
    sizes = {n: (len(ps), min(p[0] for p in ps), max(p[0] for p in ps)) for n, ps in nodes.items()}
    cuts = sharding.weighted_cuts(df, goals, sizes, most)
    for n, ps in nodes.items():
        assert {p[:2] for p in ps if p[:2] < cuts[n]} == cut_by_sorting(ps, goals[n])


def sharded(ship_llm, rows, **how):
    df = ship_llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, size string, shard double, `key` long")
    out = [r.asDict() for r in sharding.shard_documents(df, **how).collect()]
    want = [(r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows]
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=str) == sorted(want, key=str)
    for s in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    assert all(r["law"] == "bytes" and r["grown_shard"] is None for r in out)
    return out


@pytest.mark.parametrize(("shards", "most"), [(8, 1 << 12), (5, 24), (1, 24)])
def test_shards_have_near_equal_bytes(ship_llm, shards, most):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("abé ") for _ in range(rng.randrange(1, 200))), rng.choice(["en", "fr", None]),
             "hot" if rng.random() < 0.4 else f"s{rng.randrange(9)}", "x", float("nan"), 1) for i in range(900)]
    rows += [(2000 + i, "copy " * 20, "en", f"s{i % 9}", None, None, None) for i in range(450)]            # a third of the bytes
    rows += [(5000 + i, f"pair {i // 2} " * 9, rng.choice(["en", "de"]), f"s{i % 7}", "y", 0.5, 2) for i in range(60)]
    rows += [(None, None, None, None, None, None, None), (None, "", "en", "s1", None, None, None), (7, None, "en", None, "", 1.0, 3), rows[0], rows[0]]
    rng.shuffle(rows)
    out = sharded(ship_llm, rows, shards=shards, most=most)
    total, largest = sum(r["size"] for r in out), max(r["size"] for r in out)
    part = [sum(r["size"] for r in out if r["shard"] == s) for s in range(shards)]
    assert max(abs(p - total / shards) for p in part) <= 2 * max(largest, 0.02 * total / shards)
    where = {}
    for r in out:
        where.setdefault((r["size"], r["text_crc32"]), []).append(r["shard"])
    light = [w for (size, _), w in where.items() if size * len(w) <= max(largest, 0.02 * total / shards)]
    assert all(len(set(w)) == 1 for w in light) and any(len(w) > 1 for w in light)


def test_splits_follow_one_dimension(ship_llm):
    rows = [(i, f"text {i:03d}", "en", f"s{i:03d}", None, None, None) for i in range(160)]
    out = sharded(ship_llm, rows, shards=8)
    assert [r["shard"] for r in sorted(out, key=lambda r: r["doc_id"])] == [i // 20 for i in range(160)]


def test_few_rows_and_none(ship_llm):
    out = sharded(ship_llm, [(1, "a", "en", "s", None, None, None), (2, "bb", "en", "s", None, None, None)], shards=8)
    assert len({r["shard"] for r in out}) == 2
    docs = ship_llm.createDataFrame([], "doc_id long, text string")
    assert sharding.shard_documents(docs).collect() == []


# ------------------------------------------------------------------ ranked search
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def rank(docs, items, k):
    count = [(i, Counter(terms_of(t))) for i, t in docs]
    n, length = sum(bool(c) for _, c in count), sum(c.total() for _, c in count)
    df = Counter(t for _, c in count for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms_of(t))
    out = []
    for item, terms in asked.items():
        w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in terms}
        found = []
        for i, c in count:
            m = 50 + 50 * c.total() * n // length if length else 0
            s = sum(w[t] * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def prose(rng, n):
    words = [f"{rng.choice(['Wort', 'mot', 'ñan', 'x'])}{i}" for i in range(300)]
    texts = []
    for _ in range(n):
        size = rng.choice([1, 5, 30, 30, 200])
        texts.append(rng.choice([" ", ", ", "\n\x00"]).join(words[min(299, int(rng.expovariate(0.02)))] for _ in range(size)))
    return texts


@pytest.mark.parametrize(("k", "item_bytes"), [(5, 1 << 19), (50, 200), (1, 1 << 19)])
def test_ranking_equals_brute_force(ship_llm, k, item_bytes):
    rng = random.Random(11)
    texts = prose(rng, 150)
    docs = list(enumerate(texts)) + [(1, texts[0]), (900, texts[3]), (901, texts[3]), (None, texts[3]), (None, None), (902, ""), (903, " .,!"),
                                     (904, "wort1 " * 30000 + "ENDE"), (905, "Ünï Mot2 _mot2-MOT2")]
    items = [(i, t) for i, t in enumerate(rng.sample(texts, 12))] + [(3, "ende"), (50, None), (51, ""), (52, "nowhere"), (None, "mot2 ünï"), (53, "Ünï ÜNÏ")]
    rng.shuffle(docs)
    df = ship_llm.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score long").repartition(3)
    asked = ship_llm.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, `rank` string")
    got = ranking.rank_documents(df, asked, k=k, item_bytes=item_bytes).collect()
    assert sorted([tuple(r) for r in got], key=str) == rank(docs, items, k)


def test_ranking_of_nothing(ship_llm):
    docs = ship_llm.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    items = ship_llm.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranking.rank_documents(docs.limit(0), items).collect() == []
    assert ranking.rank_documents(docs, items.limit(0)).collect() == []
    assert ranking.rank_documents(docs.where("text is null"), items).collect() == []
    assert [tuple(r) for r in ranking.rank_documents(docs, items).collect()] == rank([(1, "a"), (2, None)], [(1, "a b")], 50)


def test_bounds_hold_and_leave_documents_out():
    rng = random.Random(12)
    part = pa.RecordBatch.from_pydict({"text": prose(rng, 400), "id": list(range(400))})
    vocabulary = ranking.Vocabulary([t.encode() for t in sorted(set(terms_of(" ".join(prose(rng, 8)))))])
    block = ranking._Block(part, vocabulary, 400, 20000)
    upper = block.upper()
    every = np.arange(len(vocabulary.size))
    exact = np.array([block.score(every, np.eye(len(every), dtype=np.int64)[t], np.arange(400)) for t in every])
    assert (upper >= exact).all()
    assert upper.sum() < 2 * exact.sum() and ((exact == 0) & (upper > 0)).sum() < 0.05 * (exact == 0).sum()


def test_words_with_equal_hashes_are_told_apart():
    zero, one = "x", "y"                            # such strings have equal polynomial hashes modulo 2^64
    for _ in range(11):
        zero, one = zero + one, one + zero
    raw = np.frombuffer((zero + " " + one).encode(), np.uint8)
    starts, ends = np.array([0, len(zero) + 1]), np.array([len(zero), len(raw)])
    hashes = np.full(2, 7, np.uint64)
    vocabulary = ranking.Vocabulary([zero.encode(), one.encode()])
    vocabulary.sorted[:], vocabulary.alike = 7, 2
    assert vocabulary.find(raw, starts, ends, hashes).tolist() == [0, 1]
    assert ranking.Vocabulary([one.encode()]).find(raw, starts, ends, ranking.span_hashes(raw, starts, ends)).tolist()[1] == 0
