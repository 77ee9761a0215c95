"""Mixed models: per-user effects live in tables, the driver holds the fixed
effects and a few variances."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import r6
from quarry.operators.staged import written

MOST_SKILLS = 500         # three fixed effects each; their matrix is solved on the driver
RIDGE = 1e-8              # keeps effects finite that the data do not tell (a skill without one kind of answer)


# ------------------------------------------------------------------ random intercept and slope
def _em_step(per: DataFrame, t: np.ndarray, fixed: tuple) -> tuple[np.ndarray, float]:
    """One EM step from ``t`` = (a, b, log l11, l21, log l22, log s2), where
    the effects' covariance is L L'; also the log-likelihood at ``t``."""
    a, b, s2 = float(t[0]), float(t[1]), float(np.exp(t[5]))
    low = np.array([[np.exp(t[2]), 0.0], [t[3], np.exp(t[4])]])
    cov = low @ low.T
    inv = np.linalg.inv(cov)
    n, sx, sxx, sy, sxy, syy = (F.col(c) for c in ("n", "sx", "sxx", "sy", "sxy", "syy"))
    a11, a12, a22 = n / s2 + float(inv[0, 0]), sx / s2 + float(inv[0, 1]), sxx / s2 + float(inv[1, 1])
    x = per.withColumns({"det": a11 * a22 - a12 * a12, "a11": a11, "a12": a12, "a22": a22,
                         "r1": sy - a * n - b * sx, "r2": sxy - a * sx - b * sxx,
                         "rr": syy - 2 * a * sy - 2 * b * sxy + a * a * n + 2 * a * b * sx + b * b * sxx})
    x = x.withColumns({"v11": F.col("a22") / F.col("det"), "v12": -F.col("a12") / F.col("det"), "v22": F.col("a11") / F.col("det")})
    r1, r2, v11, v12, v22 = (F.col(c) for c in ("r1", "r2", "v11", "v12", "v22"))
    x = x.withColumns({"u1": (v11 * r1 + v12 * r2) / s2, "u2": (v12 * r1 + v22 * r2) / s2})
    u1, u2 = F.col("u1"), F.col("u2")
    got = x.agg(F.sum(u1 * u1 + v11), F.sum(u1 * u2 + v12), F.sum(u2 * u2 + v22),
                F.sum(F.col("rr") - 2 * (u1 * r1 + u2 * r2) + u1 * u1 * n + 2 * u1 * u2 * sx + u2 * u2 * sxx + v11 * n + 2 * v12 * sx + v22 * sxx),
                F.sum(n * u1 + sx * u2), F.sum(sx * u1 + sxx * u2), F.sum(F.log("det")), F.sum(F.col("rr") - (u1 * r1 + u2 * r2))).first()
    groups, rows, cross, sums = fixed
    loglik = -0.5 * (rows * math.log(2 * math.pi) + rows * math.log(s2) + groups * math.log(np.linalg.det(cov)) + got[6] + got[7] / s2)
    beta = np.linalg.solve(cross, sums - np.array([got[4], got[5]]))
    new = np.array([[got[0], got[1]], [got[1], got[2]]]) / groups
    new += np.eye(2) * 1e-10 * max(1e-10, np.trace(new))
    root = np.linalg.cholesky(new)
    return np.array([*beta, math.log(root[0, 0]), root[1, 0], math.log(root[1, 1]), math.log(max(got[3] / rows, 1e-300))]), loglik


def random_slope(df: DataFrame, group: str, y: str, x: str, rounds: int = 40, tol: float = 1e-7) -> DataFrame:
    """Linear mixed model y = a + b x + u_g + v_g x + e with a random
    intercept and slope per group, correlated, by maximum likelihood.

    One aggregate makes six sums per group; every EM step is one aggregate
    over that table with 2 x 2 algebra in expressions.  Pairs of steps are
    extrapolated (a squared step along the log variances), and an
    extrapolation that lowers the likelihood is dropped.  ``x`` is centred at
    its mean: the intercept's variance and the intraclass correlation are
    those there.  Rows with a null are left out."""
    d = df.select(F.col(group).alias("g"), F.col(y).cast("double").alias("y"), F.col(x).cast("double").alias("x")).dropna()
    base = d.agg(F.count("*").alias("n"), F.avg("x").alias("mx"), F.var_pop("y").alias("vy"), F.var_pop("x").alias("vx")).first()
    spark = df.sparkSession
    schema = ("intercept double, slope double, var_intercept double, cov double, var_slope double, var_resid double, icc double, "
              "loglik double, groups long, n long")
    if not base["n"] or not base["vx"] or not base["vy"]:
        return spark.createDataFrame([], schema)
    d = d.withColumn("x", F.col("x") - base["mx"])
    per = written(d.groupBy("g").agg(F.count("*").cast("double").alias("n"), F.sum("x").alias("sx"), F.sum(F.col("x") * F.col("x")).alias("sxx"),
                                     F.sum("y").alias("sy"), F.sum(F.col("x") * F.col("y")).alias("sxy"), F.sum(F.col("y") * F.col("y")).alias("syy")))
    s = per.agg(F.count("*"), F.sum("n"), F.sum("sx"), F.sum("sxx"), F.sum("sy"), F.sum("sxy")).first()
    fixed = (s[0], s[1], np.array([[s[1], s[2]], [s[2], s[3]]]), np.array([s[4], s[5]]))
    half = math.log(math.sqrt(base["vy"] / 3))
    beta = np.linalg.solve(fixed[2], fixed[3])
    t = np.array([*beta, half, 0.0, half - 0.5 * math.log(base["vx"]), 2 * half])
    best = -math.inf
    for _ in range(rounds):
        one, here = _em_step(per, t, fixed)
        two, _ = _em_step(per, one, fixed)
        r, v = one - t, (two - one) - (one - t)
        done = abs(here - best) < tol * (1 + abs(here)) and np.abs(r).max() < 1e-3
        best = here
        if done:
            break
        step = -max(1.0, float(np.linalg.norm(r) / max(np.linalg.norm(v), 1e-300)))
        far = t - 2 * step * r + step * step * v
        # bounded, so that an extrapolation cannot leave the numbers' range
        far = np.clip(far, two - 5, two + 5)
        after, there = _em_step(per, far, fixed)
        t = after if math.isfinite(there) and there >= here else two
    low = np.array([[np.exp(t[2]), 0.0], [t[3], np.exp(t[4])]])
    cov, s2 = low @ low.T, float(np.exp(t[5]))
    row = (float(t[0] - t[1] * base["mx"]), float(t[1]), float(cov[0, 0]), float(cov[0, 1]), float(cov[1, 1]), s2,
           float(cov[0, 0] / (cov[0, 0] + s2)), float(best), int(s[0]), int(s[1]))
    return spark.createDataFrame([row], schema)


# ------------------------------------------------------------------ logistic model with a random intercept
def _outer(per: DataFrame, skills: int, var: float) -> tuple[np.ndarray, np.ndarray]:
    """Sums over users of C C' / H and C g / H (C: weights of the fixed
    effects in the user's rows)."""
    size = 3 * skills

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column("cells")
            of = np.repeat(np.arange(batch.num_rows), np.asarray(cells.value_lengths()))
            flat = cells.flatten()
            c = np.zeros((batch.num_rows, size))
            at = np.asarray(flat.field("skill"))
            for j, name in enumerate(("w", "ws", "wf")):
                c[of, 3 * at + j] = np.asarray(flat.field(name))
            h = np.asarray(batch.column("W")) + 1 / var
            g = np.asarray(batch.column("E")) - np.asarray(batch.column("u")) / var
            total += (c / h[:, None]).T @ np.column_stack([c, g])
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    out = np.zeros((size, size + 1))
    for r in per.select("u", "W", "E", "cells").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = r.v
    return out[:, :-1], out[:, -1]


def factor_mixed_model(att: DataFrame, user: str, skill: str, success: str, failure: str, y: str, rounds: int = 20, tol: float = 1e-4) -> dict:
    """Performance factor model with a random intercept per user:
    logit P(y) = u + easiness of the skill + its slope on prior successes
    + its slope on prior failures (both as z-scores), u normal.

    Block Newton: a pass joins the rows to the table of user effects and sums,
    per user and skill, the weights and residuals.  Eliminating the users'
    blocks leaves a small system of fixed effects for the driver; the users'
    steps follow from it as a table.  The variance moves by scoring on the
    effects' normal approximation.  Returns ``fit`` (one row with the Laplace
    log-likelihood, AIC, BIC and variance), ``effects`` (per skill) and
    ``users`` (user, effect).  Rows with a null are left out; more than
    ``MOST_SKILLS`` skills are an error."""
    spark = att.sparkSession
    rows = att.select(F.col(user).alias("user"), F.col(skill).alias("level"), F.col(success).cast("double").alias("s"),
                      F.col(failure).cast("double").alias("f"), F.col(y).cast("double").alias("y")).dropna()
    scale = rows.agg(*[F.coalesce(fn(c), F.lit(0.0)) for c in ("s", "f") for fn in (F.avg, F.stddev)]).first()
    levels = sorted(r[0] for r in rows.select("level").distinct().limit(MOST_SKILLS + 1).collect())
    if len(levels) > MOST_SKILLS:
        raise ValueError(f"more than {MOST_SKILLS} values of {skill}")
    kind = rows.select("level").schema["level"].dataType.simpleString()
    names = F.broadcast(spark.createDataFrame(list(zip(levels, range(len(levels)), strict=True)), f"level {kind}, skill int"))
    z = [(F.col(c) - m) / (d or 1.0) for c, m, d in (("s", scale[0], scale[1]), ("f", scale[2], scale[3]))]
    rows = written(rows.join(names, "level").select("user", "skill", z[0].alias("s"), z[1].alias("f"), "y"))
    k, n = len(levels), rows.count()
    beta, var = np.zeros(3 * k), 1.0
    users = rows.select("user").distinct().withColumn("u", F.lit(0.0))
    moved, loglik, per = math.inf, -math.inf, None
    for turn in range(rounds + 1):
        now = spark.createDataFrame([(i, *map(float, beta[3 * i:3 * i + 3])) for i in range(k)], "skill int, b0 double, b1 double, b2 double")
        eta = F.col("b0") + F.col("b1") * F.col("s") + F.col("b2") * F.col("f") + F.col("u")
        x = rows.join(users, "user").join(F.broadcast(now), "skill").withColumn("eta", F.greatest(F.least(eta, F.lit(30.0)), F.lit(-30.0)))
        x = x.withColumn("p", 1 / (1 + F.exp(-F.col("eta"))))
        x = x.withColumns({"wt": F.col("p") * (1 - F.col("p")), "e": F.col("y") - F.col("p"), "ll": F.col("y") * F.col("eta") - F.log1p(F.exp("eta"))})
        w, s, f, e = (F.col(c) for c in ("wt", "s", "f", "e"))
        cell = x.groupBy("user", "skill").agg(F.first("u").alias("u"), F.sum(w).alias("w"), F.sum(w * s).alias("ws"), F.sum(w * f).alias("wf"),
                                              F.sum(w * s * s).alias("wss"), F.sum(w * s * f).alias("wsf"), F.sum(w * f * f).alias("wff"),
                                              F.sum(e).alias("e"), F.sum(e * s).alias("es"), F.sum(e * f).alias("ef"), F.sum("ll").alias("ll"))
        each = [c for c in cell.columns if c not in ("user", "u")]
        # a user's list has one entry per skill
        per = written(cell.groupBy("user").agg(F.first("u").alias("u"), F.sum("w").alias("W"), F.sum("e").alias("E"), F.sum("ll").alias("ll"),
                                               F.collect_list(F.struct(*each)).alias("cells")))
        sums = per.agg(F.sum("ll"), F.sum(F.col("u") * F.col("u")), F.sum(F.log1p(var * F.col("W"))), F.count("*")).first()
        if not sums[3]:
            break
        loglik = sums[0] - sums[1] / (2 * var) - 0.5 * sums[2]
        if moved < tol or turn == rounds:
            break
        system, right = np.zeros((3 * k, 3 * k)), np.zeros(3 * k)
        for r in per.select(F.inline("cells")).groupBy("skill").agg(*[F.sum(c).alias(c) for c in each if c != "skill"]).collect():   # one row a skill
            at = slice(3 * r.skill, 3 * r.skill + 3)
            system[at, at] = [[r.w, r.ws, r.wf], [r.ws, r.wss, r.wsf], [r.wf, r.wsf, r.wff]]
            right[at] = r.e, r.es, r.ef
        across, gained = _outer(per, k, var)
        step = np.clip(np.linalg.solve(system - across + RIDGE * max(1.0, np.trace(system)) * np.eye(3 * k), right - gained), -3, 3)
        beta = beta + step
        # the users' steps, given that of the fixed effects
        parts = F.array(*[F.array(*[F.lit(float(v)) for v in step[3 * i:3 * i + 3]]) for i in range(k)])
        told = F.aggregate("cells", F.lit(0.0), lambda acc, c: acc + c["w"] * parts[c["skill"]][0] + c["ws"] * parts[c["skill"]][1] + c["wf"] * parts[c["skill"]][2])
        move = (F.col("E") - F.col("u") / var - told) / (F.col("W") + 1 / var)
        users = per.select("user", (F.col("u") + F.greatest(F.least(move, F.lit(3.0)), F.lit(-3.0))).alias("u"), "W")
        # scoring for the variance: effects without shrinkage are normal with variance var + 1 / W
        v = 1 / F.col("W")
        free = F.col("u") * (1 + v / var)
        got = users.agg(F.sum((free * free / (var + v) - 1) / (var + v)), F.sum(1 / ((var + v) * (var + v)))).first()
        new = min(max(var + got[0] / got[1], var / 4, 1e-6), var * 4)
        moved = max(float(np.abs(step).max()), abs(new - var) / var)
        var = new
        users = users.drop("W")
    size = 3 * k + 1
    fit = spark.createDataFrame([(n, size, float(loglik), float(2 * size - 2 * loglik), float(size * math.log(n) - 2 * loglik), float(var))] if n else [],
                                "n long, k int, loglik double, aic double, bic double, var_user double")
    effects = spark.createDataFrame([(levels[i], *map(float, beta[3 * i:3 * i + 3])) for i in range(k)],
                                    f"`{skill}` {kind}, easiness double, on_success double, on_failure double")
    return {"fit": fit.select("n", "k", *[r6(c).alias(c) for c in ("loglik", "aic", "bic", "var_user")]), "effects": effects,
            "users": per.select(F.col("user").alias(user), F.col("u").alias("effect"))}
