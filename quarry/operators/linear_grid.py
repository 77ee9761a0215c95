"""Grids of linear classifiers, all settings and folds trained by the same passes.

A fit is one setting (loss, penalty, strength, class weights) on the rows
outside one fold of one repeat.  Each round is one pass over the rows: every
partition adds up loss, gradient and curvature of all fits that still move,
Spark sums these vectors, and the driver takes a proximal Newton step per fit
(coordinate descent on the quadratic model, halved while the penalised loss
does not fall enough).  Fits outside folds need no passes of their own: one
pass adds up, per fold, the derivatives of every setting's loss at its fit on
all rows, and a fit is trained on their series.  What the series may leave out
is bounded; a fit whose bound is above the tolerance goes on by passes.  The
driver holds the sums, (features + 4)^4 / 24 numbers a setting and fold, and
never a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement
from math import factorial, prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.columns import r6
from quarry.operators.staged import written

LOSSES, PENALTIES = ("log", "squared_hinge"), ("l1", "l2")
TOGETHER = 24             # fits of one loss whose sums are formed together
CHUNK = 16_384            # rows whose sums are formed together
SCORED = 131_072          # rows that are scored and sorted together
RANGE_ROWS = 1 << 20      # scores of a fit that a task holds, on average
FIFTH = 0.1310            # above all values of the log loss's fifth derivative


@dataclass(frozen=True)
class Setting:
    """The weighted mean loss plus ``strength`` times the sum of |b| (l1) or
    half the sum of b^2 (l2) is made least; the intercept is not penalised.
    With ``per_total`` the strength is divided by the weight of the rows and
    inverted, so it multiplies the summed loss."""

    loss: str = "log"
    penalty: str = "l1"
    strength: float = 1e-4
    per_total: bool = False
    weight0: float = 1.0
    weight1: float = 1.0

    def __post_init__(self) -> None:
        if self.loss not in LOSSES or self.penalty not in PENALTIES or self.strength <= 0 or min(self.weight0, self.weight1) < 0:
            raise ValueError(f"no such setting: {self}")

    def rate(self, total: float) -> float:
        return 1.0 / (self.strength * total) if self.per_total else self.strength


@dataclass
class Fit:
    """One fitted model: ``beta`` is intercept and slopes of the features as
    they are in the table; ``scaled`` those of the standardised ones."""

    setting: int
    repeat: int
    fold: int
    scaled: np.ndarray
    beta: np.ndarray
    objective: float
    converged: bool


def _points(df: DataFrame, features: Sequence[str], label: str, folds: Sequence[str]) -> DataFrame:
    """Complete rows as features x0 .., y and folds f0 ..; others take no part."""
    x = [F.col(f"`{c}`").cast("double").alias(f"x{j}") for j, c in enumerate(features)]
    rows = df.select(*x, F.col(f"`{label}`").cast("double").alias("y"), *[F.col(f"`{c}`").cast("int").alias(f"f{r}") for r, c in enumerate(folds)])
    whole = F.col("y").isin(0.0, 1.0)
    for j in range(len(x)):
        whole = whole & F.col(f"x{j}").isNotNull() & (F.abs(f"x{j}") < F.lit(float("inf")))
    for r in range(len(folds)):
        whole = whole & F.col(f"f{r}").isNotNull()
    return rows.where(whole)


def _arrays(batch: pa.RecordBatch, dim: int, repeats: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and folds with a row each, labels."""
    column = [np.asarray(c) for c in batch.columns]
    return (np.array(column[:dim], np.float64).reshape(dim, batch.num_rows), column[dim],
            np.array(column[dim + 1:], np.int32).reshape(repeats, batch.num_rows))


def _scaled(x: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    """Ones and the standardised features."""
    return np.concatenate([np.ones((1, x.shape[1])), (x - mean[:, None]) / sd[:, None]])


def _chunks(batches: Iterator[pa.RecordBatch], dim: int, repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for a in range(0, batch.num_rows, CHUNK):
            yield _arrays(batch.slice(a, CHUNK), dim, repeats)


def _loss_terms(loss: str, z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss of each row with its first and second derivative by the score."""
    if loss == "log":
        e = np.exp(-np.abs(z))
        p = np.where(z >= 0.0, 1.0, e) / (1.0 + e)
        return np.log1p(e) + np.maximum(z, 0.0) - y * z, p - y, p * (1.0 - p)
    side = 2.0 * y - 1.0
    short = np.maximum(0.0, 1.0 - side * z)
    return short * short, -2.0 * side * short, 2.0 * (short > 0)


def _long(acc: np.ndarray) -> pa.RecordBatch:
    n, size = acc.shape
    return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(n, dtype=np.int32), size)),
                                       pa.array(np.tile(np.arange(size, dtype=np.int32), n)), pa.array(acc.ravel())], names=["trial", "pos", "v"])


def _added(points: DataFrame, run, n: int, size: int) -> np.ndarray:
    """The sum over the partitions of what ``run`` makes of each by ``_long``."""
    got = np.zeros((n, size))
    for r in points.mapInArrow(run, "trial int, pos int, v double").groupBy("trial", "pos").agg(F.sum("v").alias("v")).collect():
        got[r.trial, r.pos] = r.v
    return got


def _sums(points: DataFrame, mean: np.ndarray, sd: np.ndarray, repeats: int,
          trials: Sequence[tuple[Setting, int, int, np.ndarray]]) -> list[np.ndarray]:
    """Per trial: weight, loss, gradient and curvature over its rows, by one pass."""
    dim = len(mean)
    upper = np.triu_indices(dim + 1)
    size = 2 + (dim + 1) + len(upper[0])
    of_loss = [[i for i, t in enumerate(trials) if t[0].loss == loss] for loss in LOSSES]
    parts = [of[a:a + TOGETHER] for of in of_loss for a in range(0, len(of), TOGETHER)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((len(trials), size))
        for x, y, folds in _chunks(batches, dim, repeats):
            x = _scaled(x, mean, sd)
            products = np.array([x[a] * x[b] for a, b in zip(*upper)])
            for part in parts:
                some = [trials[i] for i in part]
                w = np.where(y == 1.0, [[t[0].weight1] for t in some], [[t[0].weight0] for t in some])
                for j, (_, repeat, fold, _) in enumerate(some):
                    if repeat >= 0:
                        w[j] *= folds[repeat] != fold
                value, first, second = _loss_terms(some[0][0].loss, np.array([t[3] for t in some]) @ x, y)
                acc[part] += np.column_stack([w.sum(axis=1), (w * value).sum(axis=1), (w * first) @ x.T, (w * second) @ products.T])
        yield _long(acc)

    return list(_added(points, run, len(trials), size))


def _step(w: np.ndarray, g: np.ndarray, h: np.ndarray, rate: float, penalty: str) -> np.ndarray:
    """The step that makes the quadratic model with its penalty least."""
    free = np.concatenate([[0.0], np.full(len(w) - 1, rate)])
    h = h + np.eye(len(w)) * 1e-12
    if penalty == "l2":
        return -np.linalg.solve(h + np.diag(free), g + free * w)
    d = np.zeros(len(w))
    slope = g.copy()                                        # gradient of the quadratic at w + d
    for _ in range(10_000):
        most = 0.0
        for j in range(len(w)):
            at = w[j] + d[j] - slope[j] / h[j, j]
            move = np.sign(at) * max(abs(at) - free[j] / h[j, j], 0.0) - (w[j] + d[j])
            if move:
                d[j] += move
                slope += h[:, j] * move
                most = max(most, abs(move))
        if most < 1e-13 * (1.0 + np.abs(w + d).max()):
            break
    return d


def _penalty(s: Setting, w: np.ndarray, rate: float) -> float:
    return rate * (np.abs(w[1:]).sum() if s.penalty == "l1" else 0.5 * (w[1:] @ w[1:]))


def _unmet(s: Setting, w: np.ndarray, g: np.ndarray, rate: float) -> float:
    """How far ``w`` is from the optimality conditions (0: least)."""
    if s.penalty == "l2":
        return float(np.abs(g + rate * np.concatenate([[0.0], w[1:]])).max())
    to = w[1:] - g[1:]
    kept = np.sign(to) * np.maximum(np.abs(to) - rate, 0.0)
    return float(max(abs(g[0]), np.abs(w[1:] - kept).max(initial=0.0)))


def _train(points: DataFrame, mean: np.ndarray, sd: np.ndarray, settings: Sequence[Setting], repeats: int, jobs: Sequence[tuple],
           begin: dict[int, np.ndarray], rounds: int, tol: float, near: dict[tuple, np.ndarray] | None = None,
           sums: Callable | None = None) -> tuple[dict, dict, dict]:
    """The fits ``jobs`` from ``near`` or else their setting's ``begin``:
    slopes, what is held of each, and whether it converged.  ``sums`` gives the
    sums of trials and their jobs, without it a pass over the rows."""
    dim = len(mean)
    at = {j: (near or {}).get(j, begin[j[0]]) for j in jobs}  # accepted
    held: dict[tuple, tuple] = {}                           # objective, gradient, step, share of it, expected fall
    trial, done = dict(at), {}
    upper = np.triu_indices(dim + 1)
    for _ in range(rounds):
        live = [j for j in jobs if j not in done]
        if not live:
            break
        asked = [(settings[j[0]], j[1], j[2], trial[j]) for j in live]
        for j, v in zip(live, sums(asked, live) if sums else _sums(points, mean, sd, repeats, asked)):
            s, total = settings[j[0]], v[0]
            if total <= 0:
                at[j], done[j] = np.zeros(dim + 1), False
                continue
            rate = s.rate(total)
            objective = v[1] / total + _penalty(s, trial[j], rate)
            if j in held:
                before, g, d, share, fall = held[j]
                if objective > before + 1e-4 * share * fall + 1e-15 * abs(before):
                    share /= 2
                    held[j] = before, g, d, share, fall
                    trial[j] = at[j] + share * d
                    if share < 1e-9:
                        done[j] = _unmet(s, at[j], g, rate) < 1e-6
                    continue
            at[j], g = trial[j], v[2:3 + dim] / total
            h = np.zeros((dim + 1, dim + 1))
            h[upper] = v[3 + dim:] / total
            h = h + np.triu(h, 1).T
            d = _step(at[j], g, h, rate, s.penalty)
            fall = g @ d + _penalty(s, at[j] + d, rate) - _penalty(s, at[j], rate)
            held[j] = objective, g, d, 1.0, min(fall, 0.0)
            trial[j] = at[j] + d
            if _unmet(s, at[j], g, rate) < tol:
                done[j] = True
    return at, held, done


def _terms(dim: int) -> list[list[tuple[int, ...]]]:
    """The products of columns 0 .. ``dim`` of each degree from 0 to 4."""
    return [list(combinations_with_replacement(range(dim + 1), m)) for m in range(5)]


def _higher(loss: str, z: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Loss of each row and its derivatives by the score, of the log loss up to the fourth."""
    value, first, second = _loss_terms(loss, z, y)
    if loss != "log":
        return [value, first, second]
    p = first + y
    return [value, first, second, second * (1.0 - 2.0 * p), second * (1.0 - 6.0 * second)]


class _Series:
    """Every setting's loss near ``begin``, per repeat and fold, as a power
    series: of the log loss up to the fourth degree, of the squared hinge the
    quadratic of the rows that are short at ``begin``.

    ``sums`` gives what ``_sums`` gives of the rows outside a fold.  For the
    squared hinge it is exact: a row whose margin is further from 1 than the
    score can move does not change sides, and one pass puts the others right.
    For the log loss ``bound`` is what a part of the gradient may be off."""

    def __init__(self, points: DataFrame, mean: np.ndarray, sd: np.ndarray, repeats: int, n_folds: int, settings: Sequence[Setting], begin: Sequence[np.ndarray]):
        self.points, self.mean, self.sd, self.repeats, self.settings, self.begin = points, mean, sd, repeats, settings, begin
        dim = len(mean)
        terms = _terms(dim)
        self.powers = [np.array([[t.count(a) for a in range(dim + 1)] for t in of]) for of in terms]
        self.orders = [np.array([prod(factorial(q) for q in row) for row in of.tolist()]) for of in self.powers]
        ends = np.cumsum([1] + [len(t) for t in terms])
        self.place = [slice(a, b) for a, b in zip(ends, ends[1:])]      # after the weight; a bound's sum follows
        size, of_loss = int(ends[-1]) + 1, [[i for i, s in enumerate(settings) if s.loss == loss] for loss in LOSSES]
        of_loss, folds_of = [of for of in of_loss if of], n_folds + 1   # 0: rows of no fold that is asked for
        weights, betas = [(s.weight0, s.weight1) for s in settings], np.array(begin)
        index = [{t: k for k, t in enumerate(of)} for of in terms]
        steps = [[(index[m - 1][t[:-1]], t[-1]) for t in terms[m]] for m in range(1, 5)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc = np.zeros((repeats, folds_of, len(settings), size))
            for x, y, folds in _chunks(batches, dim, repeats):
                x = _scaled(x, mean, sd)
                far = (x * x).sum(axis=0) ** 2.5
                parts = []
                for some in of_loss:
                    w = np.where(y == 1.0, [[weights[i][1]] for i in some], [[weights[i][0]] for i in some])
                    parts.append([w, *[w * v for v in _higher(settings[some[0]].loss, betas[some] @ x, y)]])
                for r in range(repeats):
                    of = np.where((folds[r] > 0) & (folds[r] < folds_of), folds[r], 0)
                    order = np.argsort(of, kind="stable")
                    xs, ends = x[:, order], np.searchsorted(of[order], np.arange(folds_of + 1))
                    power = [np.ones((1, len(y)))]
                    for step in steps:
                        power.append(np.empty((len(step), len(y))))
                        for k, (a, b) in enumerate(step):
                            np.multiply(power[-2][a], xs[b], out=power[-1][k])
                    for some, (w, value, *rest) in zip(of_loss, parts, strict=True):
                        w, value, rest = w[:, order], value[:, order], [v[:, order] for v in rest]
                        for k in range(folds_of):
                            rows = slice(ends[k], ends[k + 1])
                            got = [w[:, rows].sum(axis=1), value[:, rows].sum(axis=1), *[v[:, rows] @ power[m][:, rows].T for m, v in enumerate(rest, 1)]]
                            got = np.column_stack(got)
                            acc[r, k, some, :got.shape[1]] += got
                            acc[r, k, some, -1] += w[:, rows] @ far[order[rows]]
            yield _long(acc.reshape(-1, size))

        got = _added(points, run, repeats * folds_of * len(settings), size).reshape(repeats, folds_of, len(settings), size)
        self.outside = {(i, r, k): got[r, :, i].sum(axis=0) - got[r, k, i] for i in range(len(settings)) for r in range(repeats) for k in range(1, folds_of)}

    def bound(self, job: tuple, beta: np.ndarray) -> float:
        v = self.outside[job]
        return float(FIFTH / 24 * np.linalg.norm(beta - self.begin[job[0]]) ** 4 * v[-1] / v[0]) if v[0] > 0 else 0.0

    def _at(self, job: tuple, beta: np.ndarray) -> np.ndarray:
        """Weight, loss, gradient and curvature of the series."""
        d, v = beta - self.begin[job[0]], self.outside[job]
        n, top = len(d), 5 if self.settings[job[0]].loss == "log" else 3
        e, c = np.concatenate(self.powers[1:top]), np.concatenate([v[p] for p in self.place[1:top]]) / np.concatenate(self.orders[1:top])
        unit, pairs = np.eye(n, dtype=int), np.triu_indices(n)

        def at(lower: np.ndarray) -> np.ndarray:
            return np.prod(d ** np.maximum(e - lower, 0), axis=1)

        loss = v[1] + c @ at(np.zeros(n, int))
        g = [(c * e[:, a]) @ at(unit[a]) for a in range(n)]
        h = [(c * e[:, a] * (e[:, b] - (a == b))) @ at(unit[a] + unit[b]) for a, b in zip(*pairs)]
        return np.concatenate([[v[0], loss], g, h])

    def sums(self, trials: Sequence[tuple], jobs: Sequence[tuple]) -> list[np.ndarray]:
        out = [self._at(j, t[3]) for j, t in zip(jobs, trials)]
        moved = [i for i, t in enumerate(trials) if t[0].loss != "log" and (t[3] != self.begin[jobs[i][0]]).any()]
        if moved:
            for i, v in zip(moved, self._sides([jobs[i] for i in moved], [trials[i][3] for i in moved])):
                out[i] = out[i] + v
        return out

    def _sides(self, jobs: Sequence[tuple], betas: Sequence[np.ndarray]) -> np.ndarray:
        """What rows that change sides between ``begin`` and ``betas`` add to the sums."""
        mean, sd, repeats, settings, dim = self.mean, self.sd, self.repeats, self.settings, len(self.mean)
        upper = np.triu_indices(dim + 1)
        size = 2 + (dim + 1) + len(upper[0])
        of_setting = {i: [t for t, j in enumerate(jobs) if j[0] == i] for i in sorted({j[0] for j in jobs})}
        begin = {i: self.begin[i] for i in of_setting}
        reach = {i: max(np.linalg.norm(betas[t] - begin[i]) for t in some) for i, some in of_setting.items()}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc = np.zeros((len(jobs), size))
            for x, y, folds in _chunks(batches, dim, repeats):
                x = _scaled(x, mean, sd)
                side, length = 2.0 * y - 1.0, np.sqrt((x * x).sum(axis=0))
                for i, some in of_setting.items():
                    short = 1.0 - side * (begin[i] @ x)
                    near = np.flatnonzero(np.abs(short) <= length * reach[i] * (1.0 + 1e-9) + 1e-9)
                    if not len(near):
                        continue
                    xs, s = x[:, near], side[near]
                    now = 1.0 - s * (np.array([betas[t] for t in some]) @ xs)
                    w = np.where(y[near] == 1.0, settings[i].weight1, settings[i].weight0) * ((now > 0) * 1.0 - (short[near] > 0))
                    w = w * np.array([folds[jobs[t][1], near] != jobs[t][2] for t in some])
                    acc[some] += np.column_stack([np.zeros(len(some)), (w * now * now).sum(axis=1), (w * -2.0 * s * now) @ xs.T,
                                                  (w * 2.0) @ (xs[upper[0]] * xs[upper[1]]).T])
            yield _long(acc)

        return _added(self.points, run, len(jobs), size)


def fit_grid(df: DataFrame, features: Sequence[str], label: str, settings: Sequence[Setting], folds: Sequence[str] = (),
             n_folds: int = 0, rounds: int = 100, tol: float = 1e-9) -> list[Fit]:
    """Every setting fitted on all rows (``folds`` empty: repeat and fold are
    -1) or, for each column of ``folds`` and each of its folds 1 ..
    ``n_folds``, on the rows outside that fold.

    Rows with a null or non-finite feature, a label other than 0 or 1 or no
    fold take no part.  A fit without rows keeps zeros and is not converged;
    a constant feature gets slope 0.  Fits on all rows begin at their setting's
    best intercept, those outside folds where the fit on all rows ends."""
    points = written(_points(df, features, label, folds))
    dim = len(features)
    stat = points.agg(F.count("y").alias("n"), F.sum("y").alias("n1"),
                      *[f(F.col(f"x{j}")).alias(f"{n}{j}") for j in range(dim) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([stat[f"m{j}"] or 0.0 for j in range(dim)])
    sd = np.array([stat[f"s{j}"] or 1.0 for j in range(dim)])

    n1, rows = stat["n1"] or 0.0, (points, mean, sd, settings, len(folds))
    begin = {i: np.concatenate([[_intercept(s, stat["n"] - n1, n1)], np.zeros(dim)]) for i, s in enumerate(settings)}
    jobs = [(i, -1, -1) for i in begin]
    at, held, done = _train(*rows, jobs, begin, rounds, tol)
    if folds:
        begin = {i: at[i, -1, -1] for i in begin}
        jobs = [(i, r, k) for i in range(len(settings)) for r in range(len(folds)) for k in range(1, n_folds + 1)]
        series = _Series(points, mean, sd, len(folds), n_folds, settings, list(begin.values()))
        at, held, done = _train(*rows, jobs, begin, rounds, tol / 2, sums=series.sums)
        left = [j for j in jobs if settings[j[0]].loss == "log" and not (done.get(j) and series.bound(j, at[j]) <= tol / 2)]
        # what moved too far for the series may have left it altogether
        near = {j: at[j] for j in left if done.get(j) and series.bound(j, at[j]) < 1e-2}
        for had, new in zip((at, held, done), _train(*rows, left, begin, rounds, tol, near)):
            for j in left:
                had.pop(j, None)
            had.update(new)
    out = []
    for j in jobs:
        slopes = at[j][1:] / sd
        beta = np.concatenate([[at[j][0] - slopes @ mean], slopes])
        out.append(Fit(*j, at[j], beta, held[j][0] if j in held else float("nan"), done.get(j, False)))
    return out


def _intercept(s: Setting, n0: float, n1: float) -> float:
    """The intercept that is best without slopes; 0 if a class has no weight."""
    w0, w1 = s.weight0 * n0, s.weight1 * n1
    if w0 <= 0 or w1 <= 0:
        return 0.0
    return float(np.log(w1 / w0)) if s.loss == "log" else (w1 - w0) / (w1 + w0)


def coefficient_table(spark, settings: Sequence[Setting], fits: Sequence[Fit], features: Sequence[str]) -> DataFrame:
    rows = [(f.setting, f.repeat, f.fold, settings[f.setting].loss, settings[f.setting].penalty, float(settings[f.setting].strength),
             float(settings[f.setting].weight0), term, float(b), f.converged) for f in fits for term, b in zip(["(Intercept)", *features], f.beta)]
    return spark.createDataFrame(rows, "setting int, repeat int, fold int, loss string, penalty string, strength double, weight0 double, "
                                       "term string, estimate double, converged boolean")


def _cuts(points: DataFrame, beta: dict[tuple, np.ndarray], n: int, dim: int) -> dict[tuple, np.ndarray]:
    """Per fit, scores that part its rows evenly, more or less, into ranges
    of about ``RANGE_ROWS``.  They say which task ranks a row, not its rank:
    the scores of some rows are enough."""
    ranges = -(-n // RANGE_ROWS // max(1, len({k for _, r, k in beta if r >= 0})))
    if ranges < 2:
        return {key: np.zeros(0) for key in beta}
    step = max(1, n // 20_000)

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = pa.array(np.arange(0, batch.num_rows, step))
            yield pa.RecordBatch.from_arrays([c.take(at) for c in batch.columns[:dim]], names=[f"x{j}" for j in range(dim)])

    x = points.select(*[f"x{j}" for j in range(dim)]).mapInArrow(some, ", ".join(f"x{j} double" for j in range(dim))).toPandas().to_numpy()
    with np.errstate(all="ignore"):
        return {key: np.unique(np.nan_to_num(np.quantile(b[0] + x @ b[1:], np.arange(1, ranges) / ranges))) for key, b in beta.items()}


def _counted(score: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted scores as bytes; where most repeat, the distinct ones and how often each comes."""
    first = np.flatnonzero(np.r_[True, score[1:] != score[:-1]][:len(score)])
    if 2 * len(first) > len(score):
        return score.tobytes(), b""
    return score[first].tobytes(), np.diff(np.r_[first, len(score)]).tobytes()


_SCORES = [("setting", pa.int32()), ("repeat", pa.int32()), ("fold", pa.int32()), ("range", pa.int32()), ("t", pa.int64()), ("pos", pa.int64()),
           ("off", pa.float64()), ("score1", pa.binary()), ("often1", pa.binary()), ("score0", pa.binary()), ("often0", pa.binary())]


def grid_scores(df: DataFrame, features: Sequence[str], label: str, settings: Sequence[Setting], fits: Sequence[Fit],
                folds: Sequence[str] = ()) -> DataFrame:
    """The rows' scores by each setting, packed: (setting, repeat, fold, range,
    t, pos, off, score1, often1, score0, often0).  A row holds the sorted scores
    of up to ``SCORED`` rows in one range of scores, those of label 1 apart: ``t``
    rows, ``pos`` of them with label 1, ``off`` the squared errors of the chances.
    With ``folds`` a row is scored by the fit that did not see it, once a
    repeat; the score is the linear predictor."""
    points = written(_points(df, features, label, folds))
    dim, repeats = len(features), len(folds)
    beta = {(f.setting, f.repeat, f.fold): f.beta for f in fits}
    cuts = _cuts(points, beta, points.count(), dim) if beta else {}
    groups: dict[tuple, list] = {}
    for key in beta:
        groups.setdefault(key[1:], []).append(key)
    log = {i for i, s in enumerate(settings) if s.loss == "log"}

    def packed(key, score: np.ndarray, y: np.ndarray) -> Iterator[tuple]:
        with np.errstate(over="ignore"):
            off = (1.0 / (1.0 + np.exp(-score)) - y) ** 2 if key[0] in log else np.zeros(len(y))
        one, zero = np.sort(score[y == 1.0]), np.sort(score[y != 1.0])
        ends1, ends0 = (np.r_[0, np.searchsorted(v, cuts[key]), len(v)] for v in (one, zero))
        for i in range(len(ends1) - 1):
            v1, v0 = one[ends1[i]:ends1[i + 1]], zero[ends0[i]:ends0[i + 1]]
            if len(v1) + len(v0):
                yield *key, i, len(v1) + len(v0), len(v1), float(off.sum()) if not i else 0.0, *_counted(v1), *_counted(v0)
            elif not i:
                yield *key, i, 0, 0, float(off.sum()), b"", b"", b"", b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def scored() -> Iterator[pa.RecordBatch]:
            x, y, of = (np.concatenate(v, axis=-1) for v in zip(*held, strict=True))
            for (repeat, fold), keys in groups.items():
                mine = slice(None) if repeat < 0 else np.flatnonzero(of[repeat] == fold)
                xs, ys, rows = x[:, mine], y[mine], []
                for key in keys if len(ys) else ():
                    score = np.full(len(ys), beta[key][0])       # term by term: equal rows get equal scores
                    for j in range(dim):
                        score += xs[j] * beta[key][1 + j]
                    rows += packed(key, score + 0.0, ys)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, (_, kind) in zip(zip(*rows, strict=True), _SCORES, strict=True)],
                                                     names=[n for n, _ in _SCORES])

        for batch in batches:
            if batch.num_rows:
                held.append(_arrays(batch, dim, repeats))
            if sum(len(h[1]) for h in held) >= SCORED:
                yield from scored()
                held = []
        if held:
            yield from scored()

    return points.mapInArrow(run, "setting int, repeat int, fold int, range int, t long, pos long, off double, "
                                  "score1 binary, often1 binary, score0 binary, often0 binary")


def _merged(scores: list, often: list) -> tuple[np.ndarray, np.ndarray]:
    """Sorted scores of several packed rows, and how many rows come before each place."""
    score = np.concatenate([np.frombuffer(v) for v in scores])
    if not any(often):
        return np.sort(score), np.arange(len(score) + 1)
    n = np.concatenate([np.frombuffer(o, np.int64) if o else np.ones(len(v) // 8, np.int64) for v, o in zip(scores, often, strict=True)])
    order = np.argsort(score, kind="stable")
    return score[order], np.r_[0, np.cumsum(n[order])]


def _wins(table: pa.Table) -> pa.Table:
    """Of one range of a fit's scores: twice the pairs in which label 1 has the
    larger score, a tie counting half."""
    (one, upto1), (zero, upto0) = (_merged(table[f"score{v}"].to_pylist(), table[f"often{v}"].to_pylist()) for v in (1, 0))
    below = upto0[np.searchsorted(zero, one, "left")] + upto0[np.searchsorted(zero, one, "right")]
    u = int((np.diff(upto1) * below).sum())
    sums = [pc.sum(table["t"]).as_py(), pc.sum(table["pos"]).as_py(), u, pc.sum(table["off"]).as_py()]
    return pa.table({**{c: table[c].slice(0, 1) for c in ("setting", "repeat", "fold", "range")},
                     **{c: pa.array([v], kind) for c, v, kind in zip(("t", "pos", "u", "off"), sums, (pa.int64(),) * 3 + (pa.float64(),), strict=True)}})


def grid_report(scores: DataFrame, settings: Sequence[Setting]) -> DataFrame:
    """ROC AUC and (log loss only) Brier score of every setting,
    averaged over the folds of all repeats.  A fold with one class has no AUC
    and does not count in that average.  A task ranks one range of a fit's
    scores; pairs of different ranges follow from the ranges' counts."""
    by = ["setting", "repeat", "fold"]
    before = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = scores.groupBy(*by, "range").applyInArrow(_wins, "setting int, repeat int, fold int, range int, t long, pos long, u long, off double")
    ranges = ranges.withColumn("below", F.coalesce(F.sum(F.col("t") - F.col("pos")).over(before), F.lit(0).cast("long")))
    n1, n0 = F.sum("pos"), F.sum("t") - F.sum("pos")
    auc = F.sum(F.col("u") + 2 * F.col("pos") * F.col("below")) / F.nullif(2.0 * n1 * n0, F.lit(0.0))
    per = ranges.groupBy(*by).agg(F.sum("t").alias("n"), auc.alias("auc"), (F.sum("off") / F.sum("t")).alias("brier"))
    names = scores.sparkSession.createDataFrame(
        [(i, s.loss, s.penalty, float(s.strength), float(s.weight0)) for i, s in enumerate(settings)],
        "setting int, loss string, penalty string, strength double, weight0 double")
    out = per.groupBy("setting").agg(F.count(F.lit(1)).alias("n_fits"), F.sum("n").alias("n_scored"), F.avg("auc").alias("auc"), F.avg("brier").alias("brier"))
    return out.join(names, "setting").select("loss", "penalty", "strength", "weight0", "n_fits", "n_scored", r6("auc").alias("roc_auc"),
                                             r6(F.when(F.col("loss") == "log", F.col("brier"))).alias("brier"))
