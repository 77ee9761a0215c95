"""Stacked linear classifiers: optimality conditions by plain numpy, each
setting as when fitted alone, AUC by counting pairs."""

import math
import random

import numpy as np
import pytest

from quarry.operators import linear_grid as lg

X = ["a", "b", "c"]
GRID = [lg.Setting("log", "l1", 0.01), lg.Setting("log", "l2", 0.5, per_total=True), lg.Setting("squared_hinge", "l1", 0.02),
        lg.Setting("log", "l1", 1e-3, weight0=0.05, weight1=0.95), lg.Setting("squared_hinge", "l2", 1e-4, weight0=0.7, weight1=0.3)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(600):
        a, b, c = rng.gauss(10, 3), rng.random(), rng.gauss(0, 100)
        y = int(rng.random() < 1 / (1 + math.exp(-(0.4 * (a - 10) - 2 * b + 1))))
        out.append((i, a, b, c, y, i % 3 + 1, (i // 3) % 3 + 1))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    bad = [(9000, None, 1.0, 1.0, 1, 1, 1), (9001, float("nan"), 1.0, 1.0, 0, 1, 1), (9002, 1.0, float("inf"), 1.0, 0, 1, 1), (9003, 1.0, 1.0, 1.0, None, 1, 1)]
    return spark.createDataFrame([*rows, *bad], "id long, a double, b double, c double, y int, f1 int, f2 int").repartition(5)


def _subgradient(s, x, y, w):
    """Largest violation of the optimality conditions, from the definition."""
    z = w[0] + x @ w[1:]
    weight = np.where(y == 1, s.weight1, s.weight0)
    if s.loss == "log":
        d = 1 / (1 + np.exp(-z)) - y
    else:
        side = 2 * y - 1
        d = -2 * side * np.maximum(0, 1 - side * z)
    total = weight.sum()
    g = np.concatenate([[weight @ d], x.T @ (weight * d)]) / total
    rate = 1 / (s.strength * total) if s.per_total else s.strength
    worst = [abs(g[0])]
    for v, b in zip(g[1:], w[1:]):
        if s.penalty == "l2":
            worst.append(abs(v + rate * b))
        else:
            worst.append(abs(v + rate * np.sign(b)) if b else max(0.0, abs(v) - rate))
    return max(worst)


def test_every_setting_is_optimal_and_as_when_alone(table, rows):
    fits = lg.fit_grid(table, X, "y", GRID)
    x = np.array([r[1:4] for r in rows])
    x, y = (x - x.mean(axis=0)) / x.std(axis=0), np.array([r[4] for r in rows])
    for i, (s, f) in enumerate(zip(GRID, fits)):
        assert (f.setting, f.repeat, f.fold, f.converged) == (i, -1, -1, True)
        assert _subgradient(s, x, y, f.scaled) < 1e-8
        alone = lg.fit_grid(table, X, "y", [s])[0]
        assert np.allclose(alone.beta, f.beta, rtol=1e-7, atol=1e-10)
    assert fits[0].scaled[3] == 0.0                                              # noise is left out under l1


def test_folds_leave_their_rows_out_and_scores_come_from_the_other_rows(spark, table, rows):
    grid = GRID[:2]
    fits = lg.fit_grid(table, X, "y", grid, ["f1", "f2"], 3)
    assert len(fits) == 12 and all(f.converged for f in fits)
    one = next(f for f in fits if (f.setting, f.repeat, f.fold) == (1, 1, 2))
    x, y = np.array([r[1:4] for r in rows]), np.array([r[4] for r in rows])
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    keep = np.array([r[6] != 2 for r in rows])
    assert _subgradient(grid[1], x[keep], y[keep], one.scaled) < 1e-8
    got = {(r.loss, r.penalty): r for r in lg.grid_report(lg.grid_scores(table, X, "y", grid, fits, ["f1", "f2"]), grid).collect()}
    for i, s in enumerate(grid):
        aucs, briers = [], []
        for f in (f for f in fits if f.setting == i):
            mine = [r for r in rows if r[5 + f.repeat] == f.fold]
            z = [f.beta[0] + np.dot(f.beta[1:], r[1:4]) for r in mine]
            pos, neg = [v for v, r in zip(z, mine) if r[4]], [v for v, r in zip(z, mine) if not r[4]]
            aucs.append(sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg)))
            briers.append(np.mean([(1 / (1 + math.exp(-v)) - r[4]) ** 2 for v, r in zip(z, mine)]))
        r = got[s.loss, s.penalty]
        assert (r.n_fits, r.n_scored) == (6, 1200)
        assert abs(r.roc_auc - np.mean(aucs)) < 2e-6 and abs(r.brier - np.mean(briers)) < 2e-6


def test_constant_features_empty_tables_and_unknown_settings(spark, table):
    flat = table.selectExpr("a", "2.0D AS b", "y")
    f, = lg.fit_grid(flat, ["a", "b"], "y", GRID[:1])
    assert f.converged and f.beta[2] == 0.0
    f, = lg.fit_grid(flat.where("a > 1e9"), ["a", "b"], "y", GRID[:1])
    assert not f.converged and not f.beta.any()
    assert lg.grid_report(lg.grid_scores(flat.where("a > 1e9"), ["a", "b"], "y", GRID[:1], [f]), GRID[:1]).count() == 0
    with pytest.raises(ValueError):
        lg.Setting("hinge")


def test_scores_are_sorted_once_and_ties_cross_batches(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(rng.choice([0.0, -0.0, 0.1, 0.5, 2.0]) if i % 3 else rng.random(), 1.5, int(rng.random() < 0.4)) for i in range(400)]
    table = spark.createDataFrame(rows, "a double, b double, y int").repartition(3)
    grid = [lg.Setting("log", "l1", 0.01), lg.Setting("log", "l2", 0.01)]
    betas = [np.array([0.2, -1.0, 0.0]), np.zeros(3)]                                # scores with ties; all equal
    fits = [lg.Fit(i, -1, -1, b, b, 0.0, True) for i, b in enumerate(betas)]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        scores = lg.grid_scores(table, ["a", "b"], "y", grid, fits)
        writes, written = [], lg.written
        monkeypatch.setattr(lg, "written", lambda df: writes.append(1) or written(df))
        got = {r.penalty: r for r in lg.grid_report(scores, grid).collect()}
    finally:
        spark.conf.set(key, was)
    assert not writes                                                                # the scores are not written again
    for s, b in zip(grid, betas):
        z = [(b[0] + b[1] * r[0], r[2]) for r in rows]
        pos, neg = [v for v, y in z if y], [v for v, y in z if not y]
        auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        brier = np.mean([(1 / (1 + math.exp(-v)) - y) ** 2 for v, y in z])
        r = got[s.penalty]
        assert (r.n_fits, r.n_scored) == (1, 400) and abs(r.roc_auc - auc) < 2e-6 and abs(r.brier - brier) < 2e-6


def test_fits_outside_folds_need_no_passes_of_their_own(spark, monkeypatch):
    table = spark.range(0, 60_000, 1, 4).selectExpr(
        "pmod(xxhash64(id), 1000) / 100D AS a", "pmod(xxhash64(id, 1), 1000) / 1000D AS b", "cast(pmod(xxhash64(id, 2), 10) + 1 AS int) AS f1",
        "cast(pmod(xxhash64(id, 3), 100) < 20 + 3 * (pmod(xxhash64(id), 1000) / 100) AS int) AS y").cache()
    asked, sums = [], lg._sums
    monkeypatch.setattr(lg, "_sums", lambda *a: asked.extend(t[1:3] for t in a[-1]) or sums(*a))
    grid = [lg.Setting("log", "l1", 1e-3), lg.Setting("log", "l2", 1e-3, weight0=0.2, weight1=0.8), lg.Setting("squared_hinge", "l1", 1e-3)]
    fits = lg.fit_grid(table, ["a", "b"], "y", grid, ["f1"], 10)
    assert len(fits) == 30 and all(f.converged for f in fits)
    assert set(asked) == {(-1, -1)}
    for k in (1, 10):
        alone = lg.fit_grid(table.where(f"f1 <> {k}"), ["a", "b"], "y", [lg.Setting("log", "l2", 1e-9, weight0=0.2, weight1=0.8), lg.Setting("squared_hinge", "l2", 1e-9)])
        free = lg.fit_grid(table, ["a", "b"], "y", [lg.Setting("log", "l2", 1e-9, weight0=0.2, weight1=0.8), lg.Setting("squared_hinge", "l2", 1e-9)], ["f1"], 10)
        for i, f in enumerate(alone):
            assert np.allclose(f.beta, next(g for g in free if (g.setting, g.fold) == (i, k)).beta, rtol=1e-7, atol=1e-9)


def test_scores_are_packed_and_ranges_add_up(spark, rows, table, monkeypatch):
    monkeypatch.setattr(lg, "RANGE_ROWS", 60)
    monkeypatch.setattr(lg, "SCORED", 50)
    grid = GRID[:2]
    fits = [lg.Fit(i, 0, k, b, b, 0.0, True) for i, b in enumerate([np.array([0.1, 0.3, -1.0, 0.0]), np.array([0.1, 0.0, 0.0, 0.0])]) for k in (1, 2, 3)]
    scores = lg.grid_scores(table, X, "y", grid, fits, ["f1"])
    packed = scores.groupBy("setting").count().collect()
    assert max(r["count"] for r in packed) < 300                                 # not a row a score
    assert scores.select("range").distinct().count() > 2
    got = {r.penalty: r for r in lg.grid_report(scores, grid).collect()}
    aucs = []
    for f in fits[:3]:
        z = [(f.beta[0] + np.dot(f.beta[1:], r[1:4]), r[4]) for r in rows if r[5] == f.fold]
        pos, neg = [v for v, y in z if y], [v for v, y in z if not y]
        aucs.append(sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg)))
    assert abs(got["l1"].roc_auc - np.mean(aucs)) < 2e-6 and got["l2"].roc_auc == 0.5
    assert got["l1"].n_scored == got["l2"].n_scored == 600
