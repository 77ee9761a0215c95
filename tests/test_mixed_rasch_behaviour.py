"""Mixed models, the conditional Rasch fit and behaviour patterns against
plain references."""

import itertools
import random

import numpy as np
import pytest

from quarry.operators import behaviour, mixed, rasch


# ------------------------------------------------------------------ mixed models
def test_random_slope_recovers_planted_variances(spark):
    rng = np.random.default_rng(2)
    low = np.linalg.cholesky(np.array([[4.0, 0.6], [0.6, 0.5]]))
    rows = []
    for g in range(300):
        u = low @ rng.normal(size=2)
        rows += [(g, float(x), float(2 + 0.5 * x + u[0] + u[1] * (x - 1) + rng.normal())) for x in rng.normal(1, 1, 12)]
    df = spark.createDataFrame([*rows, (1, None, 3.0), (None, 1.0, None)], "g int, x double, y double")
    r = mixed.random_slope(df, "g", "y", "x").first()
    assert abs(r.slope - 0.5) < 0.15 and abs(r.intercept - 2) < 0.4
    assert abs(r.var_intercept - 4) < 1 and abs(r.var_slope - 0.5) < 0.15 and abs(r.cov - 0.6) < 0.3 and abs(r.var_resid - 1) < 0.1
    assert r.icc == pytest.approx(r.var_intercept / (r.var_intercept + r.var_resid)) and (r.groups, r.n) == (300, 3600)
    # the likelihood is the normal one of every group at these values, and no small change raises it
    x, y, g = (np.array([t[i] for t in rows]) for i in (1, 2, 0))
    x = x - x.mean()

    def loglik(t):
        out = 0.0
        for k in range(300):
            z = np.column_stack([np.ones((g == k).sum()), x[g == k]])
            s = z @ np.array([[t[2], t[3]], [t[3], t[4]]]) @ z.T + t[5] * np.eye(len(z))
            e = y[g == k] - z @ t[:2]
            out -= 0.5 * (len(z) * np.log(2 * np.pi) + np.linalg.slogdet(s)[1] + e @ np.linalg.solve(s, e))
        return out

    mx = float(np.mean([t[1] for t in rows]))
    t = np.array([r.intercept + r.slope * mx, r.slope, r.var_intercept, r.cov, r.var_slope, r.var_resid])
    top = loglik(t)
    assert r.loglik == pytest.approx(top, rel=1e-6)
    assert all(loglik(t + d * e) <= top + 1e-2 for e in np.eye(6) for d in (0.02, -0.02))
    assert mixed.random_slope(df.limit(0), "g", "y", "x").count() == 0


def test_random_user_intercept_is_near_the_integrated_likelihood(spark):
    rng = np.random.default_rng(5)
    rows, users = [], 60
    u = rng.normal(0, 1.2, users)
    for g in range(users):
        for _ in range(20):
            s, f, k = int(rng.integers(0, 6)), int(rng.integers(0, 4)), "ab"[int(rng.integers(0, 2))]
            p = 1 / (1 + np.exp(-(u[g] + (0.5 if k == "a" else -0.4) + 0.2 * s - 0.1 * f)))
            rows.append((f"u{g}", k, s, f, int(rng.random() < p)))
    m = mixed.factor_mixed_model(spark.createDataFrame(rows, "u string, k string, s int, f int, y int"), "u", "k", "s", "f", "y")
    fit, effects = m["fit"].first(), {r.k: r for r in m["effects"].collect()}
    assert fit.n == 1200 and fit.k == 7 and m["users"].count() == users
    assert fit.aic == pytest.approx(14 - 2 * fit.loglik, abs=1e-4) and fit.bic == pytest.approx(7 * np.log(1200) - 2 * fit.loglik, abs=1e-4)
    # likelihood integrated by quadrature, at the fitted values and at its own maximum (a few Newton steps)
    z = [np.array([r[i] for r in rows], float) for i in (2, 3)]
    z = [(v - v.mean()) / v.std(ddof=1) for v in z]
    b = np.array([r[1] == "b" for r in rows])
    x = np.zeros((1200, 6))
    for j, v in enumerate((np.ones(1200), *z)):
        x[~b, j], x[b, 3 + j] = v[~b], v[b]
    y, g = np.array([r[4] for r in rows], float), np.array([int(r[0][1:]) for r in rows])
    nodes, w = np.polynomial.hermite_e.hermegauss(40)

    def loglik(t):
        eta = (x @ t[:6])[:, None] + np.exp(t[6]) * nodes
        out = np.zeros((users, 40))
        np.add.at(out, g, y[:, None] * eta - np.logaddexp(0, eta))
        top = out.max(axis=1)
        return (top + np.log(np.exp(out - top[:, None]) @ (w / w.sum()))).sum()

    at = np.array([*[effects[k][c] for k in "ab" for c in ("easiness", "on_success", "on_failure")], 0.5 * np.log(fit.var_user)])
    best = at.copy()
    for _ in range(15):
        grad = np.array([(loglik(best + 1e-4 * e) - loglik(best - 1e-4 * e)) / 2e-4 for e in np.eye(7)])
        best = best + np.clip(grad / 150, -0.2, 0.2)
    assert fit.loglik == pytest.approx(loglik(at), rel=5e-3)
    assert loglik(best) - loglik(at) < 3 and abs(fit.loglik - loglik(best)) < 0.005 * abs(loglik(best))


# ------------------------------------------------------------------ Rasch
def test_conditional_likelihood_equals_enumeration():
    eps = np.exp(-np.array([0.3, -1.0, 0.5, 0.2]))
    log, one, two = rasch.conditional_terms(eps)
    for r in range(5):
        sets = [c for c in itertools.combinations(range(4), r)]
        weight = np.array([np.prod(eps[list(c)]) for c in sets])
        assert np.isclose(np.exp(log[r]), weight.sum())
        for i in range(4):
            assert np.isclose(one[r, i], weight[[i in c for c in sets]].sum() / weight.sum())
            for j in range(4):
                assert np.isclose(two[r, i, j], weight[[i in c and j in c for c in sets]].sum() / weight.sum())


def rasch_answers(rng, users, b, bend=0.0):
    rows = []
    for u in range(users):
        theta = rng.gauss(0, 1)
        rows += [(u, f"q{i}", int(rng.random() < 1 / (1 + np.exp(-(theta - x - bend * theta * i))))) for i, x in enumerate(b)]
    return rows


def conditional(rows, b, names):
    """Log-likelihood of the answers given each user's number right."""
    out, per = 0.0, {}
    for u, q, y in rows:
        per.setdefault(u, {})[q] = y
    for answers in per.values():
        own = [names.index(q) for q in answers]
        r = sum(answers.values())
        total = sum(np.exp(-sum(b[i] for i in c)) for c in itertools.combinations(own, r))
        out += -sum(b[names.index(q)] * y for q, y in answers.items()) - np.log(total)
    return out


def test_rasch_difficulties_maximise_the_conditional_likelihood(spark):
    rng = random.Random(4)
    rows = [r for r in rasch_answers(rng, 250, [-1.0, 0.0, 0.4, 0.9]) if rng.random() < 0.9]          # some answers are missing
    rows += [(u, "all", 1) for u in range(100)]
    df = spark.createDataFrame(rows, "u int, q string, y int")
    got = {r["item"]: (r.difficulty, r.std_error) for r in rasch.rasch_conditional(df, "u", "q", "y").collect()}
    assert sorted(got) == ["q0", "q1", "q2", "q3"]
    names = sorted(got)
    b = np.array([got[n][0] for n in names])
    kept = [r for r in rows if r[1] != "all"]
    top = conditional(kept, b, names)
    assert abs(b.sum()) < 1e-9 and all(conditional(kept, b + d * e, names) < top for e in np.eye(4) for d in (0.05, -0.05))
    assert all(0.05 < s < 0.5 for _, s in got.values()) and np.abs(b - (np.array([-1.0, 0.0, 0.4, 0.9]) - 0.075)).max() < 0.5


def test_split_groups(spark):
    rng = random.Random(6)
    b = [-1.0, 0.0, 0.4, 0.9, -0.3, 0.2, -0.8, 0.6]
    good = spark.createDataFrame(rasch_answers(rng, 400, b), "u int, q string, y int")
    bad = spark.createDataFrame(rasch_answers(rng, 400, b, bend=0.6), "u int, q string, y int")
    fine, broken = (rasch.rasch_split_test(d, "u", "q", "y").first() for d in (good, bad))
    assert fine["items"] == 8 and fine.df == 7 and fine.lr >= 0 and fine.p > 0.01
    assert broken.lr > fine.lr and broken.p < 0.01
    assert rasch.rasch_split_test(good.limit(0), "u", "q", "y").count() == 0


# ------------------------------------------------------------------ behaviour patterns
def plain_machine(seq, n, first, last):
    streaks = spins = drops = skip = 0
    found = False
    for i in range(len(seq) - n + 1):
        x = seq[i:i + n]
        back, away = x[-1] == first, x[-2] != last
        if skip:
            if back and not found:
                found, drops = True, drops + away
            skip -= 1
            found = found and skip > 0
            continue
        up, spin = x == list(range(x[0], x[0] + n)), len(set(x)) == 1
        drops += not up and back and away
        streak = up
        if not up and not spin and last in x:
            p = x.index(last)
            streak = x == [*range(last - p, last + 1), *range(first, first + n - p - 1)]
        streaks, spins = streaks + streak, spins + spin
        if streak or spin:
            skip = n - 1
    return streaks, spins, drops


def walk(rng, size, last):
    seq = [1]
    while len(seq) < size:
        r = rng.random()
        seq.append(seq[-1] % last + 1 if r < 0.6 else seq[-1] if r < 0.8 else rng.choice([1, 1, rng.randrange(1, last + 1)]))
    return seq


def test_stretches_compose():
    rng = random.Random(1)
    for _ in range(400):
        seq, n = walk(rng, rng.randrange(2, 60), 6), rng.randrange(2, 6)
        full = np.array([seq[i:i + n] for i in range(len(seq) - n + 1)], np.int64).reshape(-1, n)
        want = plain_machine(seq, n, 1, 6)
        assert behaviour.stretch(full, 1, 6, [0])[0][1:] == want
        state, total, i = 0, np.zeros(3, int), 0
        while i < len(full):
            j = i + rng.randrange(1, 8)
            state, *counts = behaviour.stretch(full[i:j], 1, 6, range(2 * n - 1))[state]
            total, i = total + counts, j
        assert tuple(total) == want


@pytest.mark.parametrize("held", [7, 100_000])
def test_behaviour_of_users_over_several_ranges(spark, monkeypatch, held):
    monkeypatch.setattr(behaviour, "STRETCH", held)
    rng = random.Random(2)
    seqs = {1: walk(rng, 900, 10), 2: walk(rng, 2, 10), 3: [1] * 50, 4: list(range(1, 11)) * 4, None: walk(rng, 40, 10)}
    rows = [(u, i, x, "o") for u, s in seqs.items() for i, x in enumerate(s)] + [(9, 0, None, "o")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "user int, at int, step int, s string")
    got = {(r.user, r.lookback): (r.streaks, r.wheelspins, r.dropouts)
           for r in behaviour.behaviour_patterns(df, "user", ["at"], "step", range(2, 11), partitions=6).collect()}
    assert got == {(u, n): plain_machine(s, n, 1, 10) for u, s in seqs.items() for n in range(2, 11)}
