"""Exact neighbour join, apportioning and oversampling against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import neighbours, sampling

F2 = ["a", "b"]


def brute(queries, rows, k):
    out = []
    for i, a, b in queries:
        near = sorted((((a - x) ** 2 + (b - y) ** 2), j) for j, x, y in rows if j != i)[:k]
        out += [(i, r, j, d) for r, (d, j) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 4])
def test_neighbours_equal_brute_force(spark, k, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = random.Random(k)
    rows = [(i, float(rng.randrange(12)), rng.gauss(0, 3)) for i in range(250)]
    rows += [(1000 + i, 2.0, 2.0) for i in range(120)]                                  # one hot point
    rows += [(2000 + i, 5.0 + (-1) ** i, 40.0) for i in range(12)] + [(3000, 1e6, -1e6), (3001, -0.0, 0.0), (3002, 0.0, -0.0)]
    bad = [(4000, None, 1.0), (4001, float("nan"), 1.0), (4002, float("inf"), 1.0), (None, 1.0, 1.0)]
    asked = rows[::3] + [(9000, 2.0, 2.0), (9001, 100.0, 100.0)]
    kind = "id long, a double, b double, distance string"
    df = spark.createDataFrame([(*r, "x") for r in rows + bad], kind).repartition(3)
    qs = spark.createDataFrame([(*r, "x") for r in asked + bad], kind)
    got = sorted(tuple(r) for r in neighbours.nearest_neighbours(qs, df, "id", F2, k).collect())
    assert got == brute(asked, rows, k)


def test_fewer_rows_than_neighbours_and_none(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 3.0, 4.0)], "id long, a double, b double")
    assert sorted(tuple(r) for r in neighbours.nearest_neighbours(df, df, "id", F2, 5).collect()) == [(1, 1, 2, 25.0), (2, 1, 1, 25.0)]
    assert neighbours.nearest_neighbours(df, df.limit(0), "id", F2, 5).count() == 0
    assert neighbours.nearest_neighbours(df.limit(0), df, "id", F2, 5).count() == 0


def test_bounds_leave_most_pairs_out(spark):
    """Points on a line: a query meets the blocks around it only."""
    rng = random.Random(3)
    df = spark.createDataFrame([(i, rng.uniform(0, 1000), 0.0) for i in range(4000)], "id long, a double, b double")
    points = neighbours._points(df, "id", F2).withColumn("ids", F.array("id"))
    pivots = neighbours._pivots(points, 2)
    radii = neighbours._radii(points, pivots, 5)
    import numpy as np
    v = np.array([r.v for r in points.select("v").collect()])
    far = np.sqrt(neighbours.squared_distances(v, pivots))
    reach = neighbours._reach(far, radii)
    exact = np.sort(np.abs(v[:, None, 0] - v[None, :, 0]), axis=1)[:, 5]
    assert (reach >= exact - 1e-9).all() and np.median(reach) < 100


def test_a_query_meets_few_blocks(spark, monkeypatch):
    """In four dimensions, too, a query is sent to the blocks around it only."""
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    rng = random.Random(4)
    rows = [(i, *(rng.random() for _ in range(4))) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double").repartition(4)
    visits, plain = [], neighbours.written

    def counted(table):
        out = plain(table)
        if dict(out.dtypes).get("q") == "binary":
            visits.append(out.agg(F.sum(F.length("q") / 8)).first()[0] or 0)
        return out

    monkeypatch.setattr(neighbours, "written", counted)
    got = neighbours.nearest_neighbours(df.where("id < 2000"), df, "id", list("abcd"), 5)
    assert sum(visits) < 15 * 2000
    at = {r[0]: r[1:] for r in rows}
    for i in (0, 777, 1999):
        want = sorted((sum((x - y) ** 2 for x, y in zip(at[i], v, strict=True)), j) for j, v in at.items() if j != i)[:5]
        near = got.where(F.col("id") == i).orderBy("rank").collect()
        assert [r.neighbour for r in near] == [j for _, j in want] and [r.distance for r in near] == pytest.approx([d for d, _ in want])


@pytest.mark.parametrize("k", [3, 40])
def test_neighbours_over_blocks_smaller_than_k(spark, monkeypatch, k):
    """Blocks with too few points take their bound from those around them."""
    monkeypatch.setattr(neighbours, "BLOCK", 2)
    monkeypatch.setattr(neighbours, "SAMPLE", 100)
    rng = random.Random(k)
    rows = [(i, rng.randrange(-99, 99) / 8, float(rng.randrange(3))) for i in range(300)] + [(1000 + i, 50.0 + i, 0.0) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, a double, b double").repartition(3)
    got = sorted(tuple(r) for r in neighbours.nearest_neighbours(df, df, "id", F2, k).collect())
    assert got == brute(rows, rows, k)


def test_shares_add_up(spark):
    rows = [(1, 3), (2, 3), (3, 1), (4, 0), (5, None), (6, 3)]
    df = spark.createDataFrame(rows, "id long, w int")
    got = {r.id: r.share for r in sampling.apportion(df, "id", "w", 7).collect()}
    assert got == {1: 2, 2: 2, 3: 1, 4: 0, 5: 0, 6: 2}                # quotas 2.1, 2.1, 0.7, 2.1: the rest goes to 3
    big = {r.id: r.share for r in sampling.apportion(df, "id", "w", 10 ** 17 + 1).collect()}
    assert sum(big.values()) == 10 ** 17 + 1 and big[1] - big[6] in (0, 1)
    assert {r.share for r in sampling.apportion(df.where("id > 3 and id < 6"), "id", "w", 9).collect()} == {0}


def cases(spark, rows):
    return spark.createDataFrame(rows, "id long, y int, a double, b double")


def test_smote_fills_the_smaller_class(spark, monkeypatch):
    monkeypatch.setattr(sampling, "CHUNK", 3)
    rng = random.Random(1)
    rows = [(i, 0, rng.random(), rng.random()) for i in range(100)] + [(200 + i, 1, rng.random(), 5 + rng.random()) for i in range(7)]
    rows += [(300, 1, None, 1.0), (301, None, 1.0, 1.0)]
    made = sampling.smote(cases(spark, rows), "id", "y", F2, k=3).collect()
    per = Counter(r.id for r in made)
    assert len(made) == 93 and set(per) == set(range(200, 207)) and max(per.values()) - min(per.values()) == 1
    assert all(sorted(r.draw for r in made if r.id == i) == list(range(n)) for i, n in per.items())
    at = {r[0]: r[2:] for r in rows if r[1] == 1}
    near = {}
    for q, _, j, _ in brute([r for r in [(i, *v) for i, v in at.items() if None not in v]], [(i, *v) for i, v in at.items() if None not in v], 3):
        near.setdefault(q, []).append(j)
    for r in made:                           # on the line to one of the three neighbours
        s = at[r.id]
        assert any(abs((r.a - s[0]) * (at[j][1] - s[1]) - (r.b - s[1]) * (at[j][0] - s[0])) < 1e-9 for j in near[r.id])
    assert sampling.smote(cases(spark, rows), "id", "y", F2, minority=0).count() == 0
    alone = sampling.smote(cases(spark, rows[:5] + [(200, 1, 0.5, 0.25)]), "id", "y", F2).collect()
    assert len(alone) == 4 and {(r.id, r.a, r.b) for r in alone} == {(200, 0.5, 0.25)}


def test_seeds_of_the_variants(spark):
    # on a line: 1 is safe, 2 lies among the others (noise), 3 and 4 are in danger
    rows = [(1, 1, 0.0, 0.0), (5, 1, 0.1, 0.0), (6, 1, 0.2, 0.0), (2, 1, 50.0, 0.0), (3, 1, 10.0, 0.0), (4, 1, 10.4, 0.0)]
    rows += [(100 + i, 0, 50.1 + i / 10, 0.0) for i in range(5)] + [(200 + i, 0, 11.0 + i, 0.0) for i in range(6)]
    df = cases(spark, rows)
    made = sampling.borderline_smote(df, "id", "y", F2, k=2, m=2).collect()
    assert Counter(r.id for r in made) == {3: 3, 4: 2}
    # majority rows among the two nearest: 2 has 2, 3 has 1, 4 has 1
    hard = sampling.adaptive_sampling(df, "id", "y", F2, k=2).collect()
    assert Counter(r.id for r in hard) == {2: 3, 3: 1, 4: 1}
    soft = sampling.margin_smote(df, "id", "y", F2, k=2, m=2).collect()
    assert len(soft) == 5 and 2 not in {r.id for r in soft}
    assert sampling.margin_smote(df.where("y = 0"), "id", "y", F2).count() == 0


def test_votes_of_neighbours(spark):
    train = cases(spark, [(1, 1, 0.0, 0.0), (2, 0, 1.0, 0.0), (3, 0, 2.0, 0.0), (4, 1, 9.0, 0.0)])
    test = cases(spark, [(10, 1, 0.1, 0.0), (11, 0, 8.0, 0.0)])
    got = {(r.id, r.k): r.p for r in neighbours.neighbour_votes(train, test, "id", "y", F2, [1, 3, 9]).collect()}
    assert got == {(10, 1): 1.0, (10, 3): pytest.approx(1 / 3), (10, 9): 0.5, (11, 1): 1.0, (11, 3): pytest.approx(1 / 3), (11, 9): 0.5}
