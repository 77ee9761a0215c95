"""Isotonic fits against the sequential pooling of violators."""

import random

import pytest

from quarry.operators import isotonic


def pooled(points):
    """Blocks [lo, hi, weight, sum] of sorted (p, w, s), one after the other."""
    out = []
    for p, w, s in points:
        out.append([p, p, w, s])
        while len(out) > 1 and out[-2][3] * out[-1][2] >= out[-1][3] * out[-2][2]:
            _, hi, w2, s2 = out.pop()
            out[-1][1:] = [hi, out[-1][2] + w2, out[-1][3] + s2]
    return out


def value(blocks, p):
    if not blocks:
        return None
    if p < blocks[0][0]:
        return blocks[0][3] / blocks[0][2]
    for i, (lo, hi, w, s) in enumerate(blocks):
        if i + 1 == len(blocks) or p < blocks[i + 1][0]:
            if p <= hi or i + 1 == len(blocks):
                return s / w
            n = blocks[i + 1]
            return s / w + (p - hi) / (n[0] - hi) * (n[3] / n[2] - s / w)


def table(points):
    sums = {}
    for p, y in points:
        w, s = sums.get(p, (0, 0))
        sums[p] = (w + 1, s + y)
    return [(p, *sums[p]) for p in sorted(sums)]


@pytest.mark.parametrize("segment,shape", [(4, "rising"), (7, "noise"), (4, "falling"), (5, "steep"), (10_000, "rising")])
def test_blocks_equal_the_sequential_fit(spark, monkeypatch, segment, shape):
    monkeypatch.setattr(isotonic, "SEGMENT", segment)
    rng = random.Random(segment)
    chance = {"rising": lambda p: p, "noise": lambda p: 0.4, "falling": lambda p: 1 - p, "steep": lambda p: p ** 6}[shape]
    rows = []
    for fit in (0, 3):
        for _ in range(700):
            p = rng.randrange(400) / 400 if fit else rng.random()
            rows.append((fit, p, int(rng.random() < chance(p))))
        rows += [(fit, 0.5, i % 3 // 2) for i in range(300)]                       # one hot score
    df = spark.createDataFrame([(f, p, 1.0, float(y)) for f, p, y in rows] + [(0, None, 1.0, 1.0)], "fit int, p double, w double, s double").repartition(6)
    got = isotonic.isotonic_blocks(df).collect()
    for fit in (0, 3):
        mine = sorted((r.p_lo, r.p_hi, r.value) for r in got if r.fit == fit)
        want = [(lo, hi, s / w) for lo, hi, w, s in pooled(table([(p, y) for f, p, y in rows if f == fit]))]
        merged = []
        for lo, hi, v in mine:                                                     # a tie may lie in two equal blocks
            if merged and merged[-1][2] == v:
                merged[-1][1] = hi
            else:
                merged.append([lo, hi, v])
        assert [tuple(m) for m in merged] == want


def test_convex_diagram_keeps_every_vertex(spark, monkeypatch):
    monkeypatch.setattr(isotonic, "SEGMENT", 16)
    df = spark.range(500).selectExpr("0 AS fit", "CAST(id AS DOUBLE) AS p", "1D AS w", "CAST(id * id AS DOUBLE) AS s")
    assert sorted((r.p_lo, r.p_hi, r.value) for r in isotonic.isotonic_blocks(df).collect()) == [(float(i), float(i), float(i * i)) for i in range(500)]


def test_out_of_fold_values_nulls_and_empty(spark, monkeypatch):
    monkeypatch.setattr(isotonic, "SEGMENT", 8)
    rng = random.Random(2)
    rows = [(i % 3, rng.randrange(90) / 100 + 0.03, int(rng.random() < 0.5)) for i in range(400)] + [(0, 2.0, 1), (1, -1.0, 0)]
    odd = [(1, None, 1), (2, float("nan"), 0), (0, 0.25, None)]
    df = spark.createDataFrame(rows + odd, "f int, score double, y int")
    got = isotonic.out_of_fold_calibration(df, "y", "score", "f", 3).collect()
    assert len(got) == len(rows) + 3
    fits = {k: pooled(table([(p, y) for f, p, y in rows if f != k])) for k in range(3)}
    for r in got:
        if r.p is None:
            assert r.calibrated is None
        else:
            assert abs(r.calibrated - value(fits[r.fold], r.p)) < 1e-12
    assert isotonic.out_of_fold_calibration(df.where("f > 9"), "y", "score", "f", 3).count() == 0
    alone = isotonic.out_of_fold_calibration(df.where("f = 1"), "y", "score", "f", 3).collect()
    assert {r.calibrated for r in alone} == {None}
