"""Chained imputation: against a plain loop, and rounds that read no rows."""

from __future__ import annotations

import numpy as np
import pytest

from quarry.operators.models import chained_imputation


def plain(x: np.ndarray, rounds: int) -> np.ndarray:
    gone = np.isnan(x)
    x = np.where(gone, np.nanmean(x, axis=0), x)
    for _ in range(rounds):
        for c in range(x.shape[1]):
            a = np.column_stack([np.ones(len(x)), np.delete(x, c, axis=1)])
            b = np.linalg.lstsq(a[~gone[:, c]], x[~gone[:, c], c], rcond=None)[0]
            x[gone[:, c], c] = a[gone[:, c]] @ b
    return x


def test_rounds_run_on_moments_and_equal_a_plain_loop(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4)) * [1.0, 50.0, 1e4, 0.01] + [0.0, 7.0, 1e5, 1.0]
    x[rng.random(x.shape) < 0.2] = np.nan
    rows = [(i % 250, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double").coalesce(1)
    sc = spark.sparkContext
    sc.setJobGroup("impute", "impute")
    try:
        got = chained_imputation(df, ["a", "b", "c", "d"], rounds=15)
        jobs = len(sc.statusTracker().getJobIdsForGroup("impute"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert got.columns == df.columns and jobs <= 8
    out = np.array([r[1:] for r in got.collect()], float)
    assert np.allclose(out, plain(x.copy(), 15), rtol=1e-8, atol=1e-10)


def test_constant_and_dependent_columns(spark):
    rows = [(float(i), 2.0 * i, 3.0) for i in range(20)] + [(None, 8.0, 3.0), (5.0, None, None), (None, None, None)]
    out = [tuple(r) for r in chained_imputation(spark.createDataFrame(rows, "a double, b double, c double").coalesce(1), ["a", "b", "c"]).collect()]
    assert out[20] == pytest.approx((4.0, 8.0, 3.0)) and out[21] == pytest.approx((5.0, 10.0, 3.0))
    assert out[22][2] == pytest.approx(3.0) and all(v is not None for v in out[22])


def test_a_column_without_values_is_an_error(spark):
    with pytest.raises(ValueError):
        chained_imputation(spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double"), ["a", "b"])
