"""ALS in few blocks: the factors of pyspark.ml's ALS, with less shuffle."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS

from quarry.operators import als, recommend


def ratings(spark, people, things, n, seed=3):
    rng = random.Random(seed)
    rows = [(7 * rng.randrange(people), 1000 - 3 * rng.randrange(things), float(rng.randrange(0, 6))) for _ in range(n)]
    rows += [(-5, 1000 - 3 * k, 2.5) for k in range(things)]           # a user of every thing
    rows += [(7, 1, 4.0)] * 3 + [(2 ** 31 - 1, -2 ** 31, 3.0)]         # copies, widest ids
    return spark.createDataFrame(rows, "person int, thing int, rating double").repartition(5)


def factors(df):
    return {r.id: np.array(r.features, np.float64) for r in df.collect()}


@pytest.mark.parametrize("blocks,bundle", [(3, 1 << 20), (2, 7)])
def test_factors_are_those_of_als(spark, blocks, bundle):
    df = ratings(spark, 60, 40, 900)
    mine = als.fit(df, "person", "thing", "rating", 4, 4, 0.1, 42, 2, blocks, bundle)
    other = ALS(rank=4, maxIter=4, regParam=0.1, userCol="person", itemCol="thing", ratingCol="rating", seed=42, coldStartStrategy="drop").fit(df)
    for a, b in ((mine.userFactors, other.userFactors), (mine.itemFactors, other.itemFactors)):
        a, b = factors(a), factors(b)
        assert a.keys() == b.keys()
        for k in b:
            np.testing.assert_allclose(a[k], b[k], rtol=1e-4, atol=1e-4)
    users = recommend.most_rated(df, "person", 3)
    got, want = ([tuple(r)[:3] for r in recommend.recommend_for(m, users, 5).orderBy("person", "rank").collect()] for m in (mine, other))
    assert got == want
    assert (mine.rank, mine.getUserCol(), mine.getItemCol(), mine.getColdStartStrategy()) == (4, "person", "thing", "drop")


def test_no_iterations_give_the_starting_users(spark):
    df = ratings(spark, 30, 20, 300)
    mine = recommend.fit_als(df, "person", "thing", rank=4, max_iter=0)
    other = ALS(rank=4, maxIter=0, userCol="person", itemCol="thing", ratingCol="rating", seed=42).fit(df)
    for a, b in ((mine.userFactors, other.userFactors), (mine.itemFactors, other.itemFactors)):
        a, b = factors(a), factors(b)
        assert a.keys() == b.keys() and all(np.array_equal(a[k], b[k]) for k in b)


@pytest.mark.parametrize("row", [(None, 1, 1.0), (1, None, 1.0), (1, 1, None), (1, 1, math.nan)])
def test_rows_are_checked_as_before(spark, row):
    df = ratings(spark, 10, 10, 50).union(spark.createDataFrame([row], "person int, thing int, rating double"))
    with pytest.raises(Exception, match="(?i)null"):
        recommend.fit_als(df, "person", "thing", rank=2, max_iter=1)


def test_an_iteration_sends_a_factor_to_few_blocks(spark, monkeypatch):
    """Every user has rated things of every block: pyspark's ALS sends each
    factor to ten blocks, these at most to ``blocks``."""
    sent = spark.sparkContext.accumulator(0)
    routed = als._routed

    def counted(row, blocks):
        for b, part in routed(row, blocks):
            sent.add(part[0])
            yield b, part

    df = ratings(spark, 60, 40, 3000).where("person between 0 and 1000 and thing > 1").cache()
    n = df.select("person").distinct().count() + df.select("thing").distinct().count()
    monkeypatch.setattr(als, "_routed", counted)
    recommend.fit_als(df, "person", "thing", rank=2, max_iter=2, checkpoint_interval=0)
    assert 0 < sent.value <= 3 * n * 3                                 # two iterations and the look-up of ids


def test_packing_loses_nothing():
    rng = np.random.default_rng(0)
    ids = np.array([2 ** 31 - 1, -2 ** 31, 0, 5, 4], np.int32)
    x = rng.normal(size=(5, 3)).astype(np.float32)
    x[0] = np.nan, -0.0, np.inf
    a, b = als._unpacked(*als._packed(ids, x))
    assert np.array_equal(a, ids) and b.tobytes() == x.tobytes()
    a, b = als._unpacked(*als._packed(ids, np.zeros((5, 0), np.float32)))
    assert np.array_equal(a, ids) and b.shape == (5, 0)
