"""Pairs above a similarity and a co-rater threshold, against brute force."""

import math
import random
from collections import defaultdict

import pytest

from quarry.operators import recommend


def brute(rows, min_score, min_common):
    seen = defaultdict(list)
    for e, u, r in rows:
        if None not in (e, u, r):
            seen[e, u].append(r)
    of = defaultdict(dict)
    for (e, u), rs in seen.items():
        of[e][u] = sum(rs) / len(rs)
    out = {}
    for a in of:
        for b in of:
            common = of[a].keys() & of[b].keys()
            if a < b and len(common) > min_common:
                xx, yy = (math.sqrt(sum(of[e][u] ** 2 for u in common)) for e in (a, b))
                if xx and yy:
                    score = round(sum(of[a][u] * of[b][u] for u in common) / (xx * yy), 6)
                    if score > min_score:
                        out[a, b] = len(common), score
    return out


@pytest.mark.parametrize("min_score,min_common", [(0.9, 0), (0.5, 2), (0.9, 10), (-1.0, 25), (0.0, 1000)])
def test_pairs_equal_brute_force(spark, min_score, min_common):
    rng = random.Random(min_common)
    rows = [(rng.randrange(40), int(300 * rng.random() ** 2), float(rng.randrange(1, 6))) for _ in range(1500)]
    rows += [(e, 999, 3.0) for e in range(40)]                                     # a rater of every entity
    rows += [(100, u, 4.0) for u in range(60)] + [(101, u, 4.0) for u in range(30, 90)] + [(102, u, 0.0) for u in range(60)]
    rows += [(None, 1, 1.0), (1, None, 1.0), (1, 2, None), (100, 5, 2.0)]
    df = spark.createDataFrame(rows, "thing long, person long, rating double").repartition(5)
    got = {(r.a, r.b): (r.n_common, r.score) for r in recommend.similar_pairs(df, "thing", "person", min_score, min_common).collect()}
    want = brute(rows, min_score, min_common)
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 2e-6 for k in want)


def test_clashing_names_and_empty(spark):
    df = spark.createDataFrame([(1, 7, 2.0), (2, 7, 2.0), (2, 8, 1.0)], "u long, e long, r double")
    assert [tuple(r) for r in recommend.similar_pairs(df, "u", "e", 0.5, 0, "r").collect()] == [(1, 2, 1, 1.0)]
    assert recommend.similar_pairs(df.where("u > 5"), "u", "e", 0.5, 0, "r").count() == 0


@pytest.mark.parametrize("min_common", [0, 1, 3])
def test_busy_raters_and_split_entities(spark, monkeypatch, min_common):
    """Busy raters are left out, lists cut and partners dealt: no pair is lost."""
    monkeypatch.setattr(recommend, "HOT", 5)
    monkeypatch.setattr(recommend, "LOAD", 20)
    rng = random.Random(5)
    rows = [(f"e{rng.randrange(30)}", int(60 * rng.random() ** 3), float(rng.randrange(1, 6))) for _ in range(400)]
    df = spark.createDataFrame(rows, "thing string, person long, rating double").repartition(4)
    got = {(r.a, r.b): (r.n_common, r.score) for r in recommend.similar_pairs(df, "thing", "person", 0.2, min_common).collect()}
    want = brute(rows, 0.2, min_common)
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 2e-6 for k in want)


def test_pairs_below_the_threshold_are_not_written(spark, monkeypatch):
    """600 raters of 40 things each meet in 468,000 pairs, of which none is asked for."""
    rows = spark.range(24_000).selectExpr("cast(pmod(xxhash64(id), 100000) AS long) AS thing", "id % 600 AS person", "1.0D AS rating")
    sizes, plain = [], recommend.written

    def counted(df):
        out = plain(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(recommend, "written", counted)
    assert recommend.similar_pairs(rows, "thing", "person", 0.5, 3).count() == 0
    assert max(sizes) <= 24_000
