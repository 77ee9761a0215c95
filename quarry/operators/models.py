"""Model fitting on Spark: pyspark.ml estimators where they exist, and
EM / moment fits written as DataFrame aggregates where they do not.

Every fit scans the data with Spark; the driver only holds parameter
vectors and small matrices (k x k for k features or classes)."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage
from quarry.functions.columns import r6
from quarry.operators.aggregate import with_total
from quarry.operators.isotonic import out_of_fold_calibration
from quarry.operators.staged import for_lookup, written

TASK_ROWS = 262_144       # rows that a task of a fit holds, at most


def hash_split(df: DataFrame, key: F.Column, frac: float = 0.5, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Deterministic split by a hash of the row key (independent of the
    partitioning, unlike ``randomSplit``)."""
    u = (F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1_000_003)) / 1_000_003.0)
    x = df.withColumn("_u", u)
    return x.filter(F.col("_u") < frac).drop("_u"), x.filter(F.col("_u") >= frac).drop("_u")


def for_fits(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """These columns of ``df`` for many passes: computed and written once, and
    dealt evenly where a task would hold more than ``TASK_ROWS`` rows."""
    rows = written(df.select(*dict.fromkeys(columns)))
    parts = -(-rows.count() // TASK_ROWS)
    return cut_lineage(rows.repartition(parts)) if parts > rows.rdd.getNumPartitions() else rows


def elastic_net(df: DataFrame, label: str, features: Sequence[str], key: F.Column,
                max_iter: int = 10, reg: float = 0.3, mix: float = 0.8) -> DataFrame:
    """O1: elastic-net linear regression fitted on one half, predictions
    next to labels on the other half."""
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    train, test = hash_split(df.select(label, *features, key.alias("_k")), F.col("_k"))
    lr = LinearRegression(maxIter=max_iter, regParam=reg, elasticNetParam=mix, labelCol=label)
    model = Pipeline(stages=[va, lr]).fit(train)
    return model.transform(test).select(F.col(label).alias("label"), r6("prediction").alias("prediction"))


def ols_table(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """O2: least squares with dummy-coded categorical terms (first level
    alphabetically is the reference); coefficient, standard error, t and p
    from the normal-equation solver's summary."""
    stages, cols = [], list(numeric)
    for c in categorical:
        stages += [StringIndexer(inputCol=c, outputCol=f"{c}_ix", stringOrderType="alphabetAsc", handleInvalid="skip"),
                   OneHotEncoder(inputCol=f"{c}_ix", outputCol=f"{c}_oh", dropLast=False)]
    x = Pipeline(stages=stages).fit(df).transform(df) if stages else df
    names = list(numeric)
    for c in categorical:
        lv = sorted([r[0] for r in df.select(c).distinct().collect() if r[0] is not None])
        # drop the reference level (first) by slicing the one-hot vector
        arr = vector_to_array(F.col(f"{c}_oh"))
        for i, level in enumerate(lv[1:], start=1):
            x = x.withColumn(f"{c}={level}", arr[i])
            names.append(f"{c}={level}")
        cols = names
    va = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip")
    lr = LinearRegression(solver="normal", labelCol=label)
    m = lr.fit(va.transform(x))
    s = m.summary
    rows = [(n, float(b), float(se), float(t), float(p)) for n, b, se, t, p in
            zip(names + ["(Intercept)"], list(m.coefficients) + [m.intercept], s.coefficientStandardErrors,
                s.tValues, s.pValues)]
    return df.sparkSession.createDataFrame(rows, "term string, estimate double, std_error double, t double, p double")


def one_vs_rest_logit(df: DataFrame, cls: str, features: Sequence[str]) -> DataFrame:
    """O3: one binomial GLM per class level (that level vs the rest)."""
    spark = df.sparkSession
    levels = [r[0] for r in df.select(cls).distinct().orderBy(cls).collect()]
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    base = va.transform(df)
    rows = []
    for lv in levels:
        d = base.withColumn("_y", (F.col(cls) == lv).cast("double"))
        m = GeneralizedLinearRegression(family="binomial", link="logit", labelCol="_y").fit(d)
        for n, b in zip(list(features) + ["(Intercept)"], list(m.coefficients) + [m.intercept]):
            rows.append((str(lv), n, float(b)))
    return spark.createDataFrame(rows, "class string, term string, estimate double")


def random_intercept(df: DataFrame, group: str, y: str, x: str, iters: int = 50, tol: float = 1e-8) -> DataFrame:
    """Linear mixed model y = a + b x + u_g + e with a random
    intercept per group, fitted by EM on per-group sufficient statistics.

    Each iteration is one ``groupBy(group)`` aggregate of residual sums and
    one global aggregate; the driver keeps five scalars.  Returns the fixed
    effects, variance components and the intraclass correlation."""
    d = df.select(group, F.col(y).cast("double").alias("y"), F.col(x).cast("double").alias("x")).dropna()
    base = d.agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"),
                 F.covar_pop("x", "y").alias("cxy"), F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy")).first()
    b = base["cxy"] / base["vx"] if base["vx"] else 0.0
    a = base["my"] - b * base["mx"]
    s2e, s2u = base["vy"] / 2, base["vy"] / 2
    per = d.groupBy(group).agg(F.count(F.lit(1)).alias("ng"), F.sum("y").alias("sy"), F.sum("x").alias("sx"),
                               F.sum(F.col("x") * F.col("x")).alias("sxx"), F.sum(F.col("x") * F.col("y")).alias("sxy"),
                               F.sum(F.col("y") * F.col("y")).alias("syy")).cache()
    n = base["n"]
    for _ in range(iters):
        ng = F.col("ng")
        rsum = F.col("sy") - a * ng - b * F.col("sx")
        shrink = s2u / (s2u + s2e / ng)
        u = shrink * rsum / ng
        vu = s2u * (s2e / ng) / (s2u + s2e / ng)
        # sum of squared residuals given u: sum (y - a - b x - u)^2 = syy - 2a sy - 2b sxy + ... expanded
        rss = (F.col("syy") - 2 * a * F.col("sy") - 2 * b * F.col("sxy") + a * a * ng + 2 * a * b * F.col("sx")
               + b * b * F.col("sxx") - 2 * u * rsum + ng * u * u + ng * vu)
        st = per.agg(F.sum(u * u + vu).alias("suu"), F.sum(rss).alias("rss"), F.count(F.lit(1)).alias("G"),
                     F.sum(u * ng).alias("su"), F.sum(u * F.col("sx")).alias("sux")).first()
        s2u_new = st["suu"] / st["G"]
        s2e_new = st["rss"] / n
        # fixed effects given u: regress (y - u) on x
        sy_adj = base["my"] * n - st["su"]
        sxy_adj = (base["cxy"] + base["mx"] * base["my"]) * n - st["sux"]
        sxx = (base["vx"] + base["mx"] ** 2) * n
        sx = base["mx"] * n
        b_new = (n * sxy_adj - sx * sy_adj) / (n * sxx - sx * sx)
        a_new = (sy_adj - b_new * sx) / n
        done = abs(s2u_new - s2u) + abs(s2e_new - s2e) + abs(b_new - b) < tol
        a, b, s2u, s2e = a_new, b_new, s2u_new, s2e_new
        if done:
            break
    per.unpersist()
    icc = s2u / (s2u + s2e)
    return df.sparkSession.createDataFrame(
        [(float(a), float(b), float(s2u), float(s2e), float(icc))],
        "intercept double, slope double, var_group double, var_resid double, icc double")


def rasch_pairs(first: DataFrame, user: str, item: str, correct: str) -> DataFrame:
    """O6 (step 1): for every item pair (i, j), the number of users right on
    i and wrong on j.  One row per (user, item) goes in; pairs are formed
    within a user's *item* list, which the quiz bounds (not the data)."""
    r = first.filter(F.col(correct) == 1).select(user, F.col(item).alias("item_i"))
    w = first.filter(F.col(correct) == 0).select(user, F.col(item).alias("item_j"))
    return r.join(w, user).groupBy("item_i", "item_j").agg(F.count(F.lit(1)).alias("n_ij"))


def rasch_difficulty(pairs: DataFrame) -> DataFrame:
    """O6 (step 2): pairwise difficulty: mean over j of log(n_ji / n_ij)."""
    a = pairs.select("item_i", "item_j", "n_ij")
    b = pairs.select(F.col("item_j").alias("item_i"), F.col("item_i").alias("item_j"), F.col("n_ij").alias("n_ji"))
    j = a.join(b, ["item_i", "item_j"])
    return j.groupBy(F.col("item_i").alias("item")).agg(r6(F.avg(F.log(F.col("n_ji") / F.col("n_ij")))).alias("difficulty"))


def _profile_stats(items: list[str], states: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """Per-partition E-step for every start: responsibilities in numpy, one
    vector of sums per start (log-likelihood, r_j, r_j x, r_j x^2, entropy)."""
    import pandas as pd

    def run(batches):
        acc = [None] * len(states)
        for pdf in batches:
            x, w = pdf[items].to_numpy(dtype="float64"), pdf["_w"].to_numpy(dtype="float64")
            if not len(w):
                continue
            for s, (mu, var, pi) in enumerate(states):
                logp = (np.log(pi)[None, :] - 0.5 * np.sum(np.log(2 * np.pi * var))
                        - 0.5 * (((x[:, None, :] - mu[None, :, :]) ** 2) / var[None, None, :]).sum(axis=2))
                top = logp.max(axis=1, keepdims=True)
                lse = top[:, 0] + np.log(np.exp(logp - top).sum(axis=1))
                r = np.exp(logp - lse[:, None])
                ent = -(w[:, None] * r * np.log(np.where(r > 0, r, 1.0))).sum()
                r *= w[:, None]
                vec = np.concatenate([[w @ lse], r.sum(axis=0), (r.T @ x).ravel(), (r.T @ (x * x)).ravel(), [ent]])
                acc[s] = vec if acc[s] is None else acc[s] + vec
        for s, vec in enumerate(acc):
            if vec is not None:
                yield pd.DataFrame({"start": s, "pos": np.arange(len(vec)), "v": vec})

    return run


def latent_profiles(df: DataFrame, items: Sequence[str], k: int, iters: int = 500, tol: float = 1e-6,
                    seeds: Sequence[int] = (1, 2, 3)) -> dict:
    """Latent profile analysis (Gaussian mixture, diagonal covariance
    equal across classes) by EM from several seeded starts; the start with the
    largest likelihood is kept.

    Rows are first reduced to distinct answer patterns with their counts and
    written once.  A round is one vectorised E-step over the partitions for
    all starts that still move; Spark sums its vectors, so the driver gets one
    number per parameter and start, whatever the number of partitions.
    Returns log-likelihood, free parameters, AIC, BIC, adjusted BIC, entropy,
    class shares and the parameters (means, variances)."""
    items = list(items)
    x = df.select(*[F.col(c).cast("double").alias(c) for c in items]).dropna()
    x = cut_lineage(x.groupBy(*items).agg(F.count(F.lit(1)).alias("_w")))
    d = len(items)
    w = F.col("_w")
    st = x.agg(F.sum(w).alias("n"), *[(F.sum(F.col(c) * w) / F.sum(w)).alias(f"m_{c}") for c in items],
               *[(F.sum(F.col(c) * F.col(c) * w) / F.sum(w)).alias(f"q_{c}") for c in items]).first()
    n = st.n
    mean = np.array([st[f"m_{c}"] for c in items])
    sd = np.sqrt(np.maximum([st[f"q_{c}"] - st[f"m_{c}"] ** 2 for c in items], 1e-12))
    states = [(mean[None, :] + np.random.default_rng(s).normal(size=(k, d)) * sd[None, :], np.maximum(sd ** 2, 1e-6), np.full(k, 1.0 / k))
              for s in seeds]
    seen: dict[int, tuple[float, float]] = {}                 # log-likelihood and entropy sum per start
    live = list(range(len(states)))
    for _ in range(iters):
        if not live:
            break
        sums = (x.mapInPandas(_profile_stats(items, [states[s] for s in live]), "start int, pos int, v double")
                .groupBy("start", "pos").agg(F.sum("v").alias("v")).collect())
        vec = {s: np.zeros(2 + k + 2 * k * d) for s in live}
        for r in sums:
            vec[live[r.start]][r.pos] = r.v
        moving = []
        for s in live:
            ll, rk = vec[s][0], vec[s][1:1 + k]
            rx, rxx = vec[s][1 + k:1 + k + k * d].reshape(k, d), vec[s][1 + k + k * d:1 + k + 2 * k * d].reshape(k, d)
            before = seen.get(s, (-np.inf, 0.0))[0]
            seen[s] = float(ll), float(vec[s][-1])
            if abs(ll - before) < tol * max(1.0, abs(ll)):
                continue
            moving.append(s)
            mu = rx / np.maximum(rk, 1e-12)[:, None]
            var = np.maximum((rxx - rk[:, None] * mu ** 2).sum(axis=0) / n, 1e-6)
            states[s] = (mu, var, np.maximum(rk / n, 1e-12))
        live = moving
    best = max(seen, key=lambda s: seen[s][0])
    (mu, var, pi), (ll, ent_sum) = states[best], seen[best]
    p = (k - 1) + k * d + d
    entropy = 1.0 - ent_sum / (n * math.log(k)) if k > 1 else 1.0
    return {"k": k, "loglik": ll, "free_params": p, "aic": 2 * p - 2 * ll, "bic": p * math.log(n) - 2 * ll,
            "abic": p * math.log((n + 2) / 24.0) - 2 * ll, "entropy": float(entropy),
            "shares": [float(v) for v in pi], "means": mu.tolist(), "variances": var.tolist()}


def profile_membership(df: DataFrame, items: Sequence[str], fit: dict) -> DataFrame:
    """O7 (posteriors): the rows of ``df`` with ``posterior`` (array, one per
    class) and ``profile`` (0-based class of the largest, null where an item is
    missing), by built-in expressions from the fitted parameters."""
    logs = []
    for share, mean in zip(fit["shares"], fit["means"]):
        e = F.lit(math.log(share))
        for c, m, v in zip(items, mean, fit["variances"]):
            e = e - (F.col(c).cast("double") - m) * (F.col(c).cast("double") - m) / (2 * v)
        logs.append(e)
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    weights = F.transform(F.array(*logs), lambda e: F.exp(e - top))
    whole = df.withColumn("posterior", F.when(logs[0].isNotNull(), weights))
    total = F.aggregate("posterior", F.lit(0.0), lambda a, b: a + b)
    whole = whole.withColumn("posterior", F.transform("posterior", lambda v: v / total))
    return whole.withColumn("profile", (F.array_position("posterior", F.array_max("posterior")) - 1).cast("int"))


def one_factor(df: DataFrame, items: Sequence[str], iters: int = 100) -> DataFrame:
    """One-factor model by principal-axis factoring of the correlation
    matrix (computed on Spark in one aggregate); loadings, composite
    reliability / omega = (sum l)^2 / ((sum l)^2 + sum(1 - l^2))."""
    k = len(items)
    x = df.select(*items).dropna()
    pairs = [(a, b) for i, a in enumerate(items) for b in items[i:]]
    s = x.agg(*[F.corr(a, b).alias(f"c{i}") if a != b else F.lit(1.0).alias(f"c{i}")
                for i, (a, b) in enumerate(pairs)]).first()
    r = np.eye(k)
    for i, (a, b) in enumerate(pairs):
        ia, ib = items.index(a), items.index(b)
        r[ia, ib] = r[ib, ia] = s[f"c{i}"]
    h = 1 - 1 / np.diag(np.linalg.inv(r))          # squared multiple correlations as start
    for _ in range(iters):
        rr = r.copy()
        np.fill_diagonal(rr, h)
        w, v = np.linalg.eigh(rr)
        lam = v[:, -1] * math.sqrt(max(w[-1], 0))
        h_new = lam ** 2
        if np.max(np.abs(h_new - h)) < 1e-8:
            h = h_new
            break
        h = h_new
    lam = lam * np.sign(lam.sum())
    omega = lam.sum() ** 2 / (lam.sum() ** 2 + np.sum(1 - lam ** 2))
    rows = [(c, float(lam[i]), float(omega)) for i, c in enumerate(items)]
    return df.sparkSession.createDataFrame(rows, "item string, loading double, omega double")


def _refill(moments: np.ndarray, c: int) -> np.ndarray:
    """Least squares of column ``c`` on the others from the moments of
    (1, columns): one weight a place, 0 at its own.  A constant column gets
    weight 0, columns that depend on each other the shortest solution."""
    n, mu = moments[0, 0], moments[0, 1:] / moments[0, 0]
    cov = moments[1:, 1:] / n - np.outer(mu, mu)
    size = np.sqrt(np.maximum(np.diag(cov), 0.0))
    use = [o for o in range(len(mu)) if o != c and size[o] > 1e-10]
    out = np.zeros(len(mu) + 1)
    if use:
        corr = cov[np.ix_(use, use)] / np.outer(size[use], size[use])
        out[1 + np.array(use)] = np.linalg.lstsq(corr, cov[use, c] / size[use], rcond=1e-12)[0] / size[use]
    out[0] = mu[c] - out[1:] @ mu
    return out


def chained_imputation(df: DataFrame, cols: Sequence[str], rounds: int = 15) -> DataFrame:
    """Chained-equation imputation: start from column means, then per
    round and column fit a linear regression of the column on the others
    (observed rows) and refill its missing cells.

    A refilled cell is a linear function of the observed cells of its row, the
    same for all rows that miss the same columns.  So the moments of the
    observed cells, per set of missing columns, hold all that the fits need:
    one pass adds them up, the rounds run on them, and a last pass fills the
    cells.  The driver holds a matrix of (columns + 1)^2 numbers per set of
    missing columns that occurs, never a row."""
    cols, p = list(cols), len(cols)
    value = [F.col(f"`{c}`").cast("double") for c in cols]
    stat = df.agg(*[f(v).alias(f"{n}{i}") for i, v in enumerate(value) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([stat[f"m{i}"] for i in range(p)], np.float64)          # null: not a number
    sd = np.array([stat[f"s{i}"] or 1.0 for i in range(p)], np.float64)
    if not (np.isfinite(mean) & np.isfinite(sd)).all():
        raise ValueError("a column without observed values or with values that are not finite")
    z = [F.coalesce((v - float(m)) / float(s), F.lit(0.0)) for v, m, s in zip(value, mean, sd, strict=True)]
    missed = F.lit(0).cast("long")
    for i, v in enumerate(value):
        missed = missed + F.when(v.isNull(), F.lit(1 << i)).otherwise(F.lit(0))
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    rows = df.select(missed.alias("_missed"), *[x.alias(f"z{i}") for i, x in enumerate(z)]).groupBy("_missed").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"z{i}").alias(f"z{i}") for i in range(p)],
        *[F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"z{i}_{j}") for i, j in pairs]).collect()
    moments, fill = {}, {}
    for r in rows:
        m = np.zeros((p + 1, p + 1))
        m[0, 0] = r["n"]
        m[0, 1:] = m[1:, 0] = [r[f"z{i}"] for i in range(p)]
        for i, j in pairs:
            m[i + 1, j + 1] = m[j + 1, i + 1] = r[f"z{i}_{j}"]
        moments[r["_missed"]] = m
        # how (1, columns) come of the observed cells; the column mean is 0
        fill[r["_missed"]] = np.diag([1.0] + [0.0 if r["_missed"] >> i & 1 else 1.0 for i in range(p)])
    for _ in range(rounds):
        for c in range(p):
            gaps = [k for k in fill if k >> c & 1]
            if gaps:
                fit = _refill(sum(fill[k] @ m @ fill[k].T for k, m in moments.items() if not k >> c & 1), c)
                for k in gaps:
                    fill[k][c + 1] = fit @ fill[k]
    table = df.sparkSession.createDataFrame([(k, *[f[i + 1].tolist() for i in range(p)]) for k, f in fill.items()],
                                            "_missed long, " + ", ".join(f"_f{i} array<double>" for i in range(p)))
    # a row per set of missing columns
    x = df.withColumn("_missed", missed).join(F.broadcast(table), "_missed")
    for i, c in enumerate(cols):
        guess = F.get(f"_f{i}", F.lit(0))
        for j in range(p):
            guess = guess + F.get(f"_f{i}", F.lit(j + 1)) * z[j]
        x = x.withColumn(f"_x{i}", F.coalesce(value[i], guess * float(sd[i]) + float(mean[i])))
    filled = {c: F.col(f"_x{i}").alias(c) for i, c in enumerate(cols)}
    return x.select(*[filled.get(c, F.col(f"`{c}`")) for c in df.columns])


def classifier_set(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                   weight: str | None = None) -> DataFrame:
    """Logistic regression, decision tree, random forest, boosted
    trees and linear SVM fitted on ``train`` (optionally class-weighted),
    scored on ``test`` by ROC AUC and (probabilistic models) Brier score."""
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    tr = va.transform(for_fits(train, [*features, label, *([weight] if weight else [])])).withColumn("label", F.col(label).cast("double"))
    te = va.transform(for_fits(test, [*features, label])).withColumn("label", F.col(label).cast("double"))
    kw = {"weightCol": weight} if weight else {}
    models = {
        "logistic": LogisticRegression(maxIter=50, **kw),
        "tree": DecisionTreeClassifier(maxDepth=5, seed=1, **kw),
        "forest": RandomForestClassifier(numTrees=30, maxDepth=6, seed=1, **kw),
        "boosted": GBTClassifier(maxIter=20, maxDepth=4, seed=1, **kw),
        "svm": LinearSVC(maxIter=50, **kw),
    }
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction")
    rows = []
    for name, est in models.items():
        m = est.fit(tr)
        pr = m.transform(te)
        auc = ev.evaluate(pr)
        brier = None
        if "probability" in pr.columns:
            p1 = vector_to_array(F.col("probability"))[1]
            brier = pr.select(F.avg((p1 - F.col("label")) ** 2)).first()[0]
        rows.append((name, float(auc), None if brier is None else float(brier)))
    return train.sparkSession.createDataFrame(rows, "model string, roc_auc double, brier double")


def class_weights(df: DataFrame, label: str, name: str = "w") -> DataFrame:
    """Inverse-frequency class weights (n / (classes * n_class))."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    t = c.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = with_total(c, t).select(label, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(name))
    return df.join(for_lookup(w), label)


def grid_search_cv(df: DataFrame, features: Sequence[str], label: str, fold_col: str) -> DataFrame:
    """Grid search over the regularisation of a logistic model with
    deterministic folds (``foldCol``), scored by ROC AUC."""
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    d = va.transform(for_fits(df, [*features, label, fold_col])).select(
        "features", F.col(label).cast("double").alias("label"), (F.col(fold_col) - 1).alias(fold_col))
    lr = LogisticRegression(maxIter=50)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.01, 0.1]).addGrid(lr.elasticNetParam, [0.0, 0.5]).build()
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(),
                        foldCol=fold_col, numFolds=5, parallelism=2)
    m = cv.fit(d)
    rows = [(float(pm[lr.regParam]), float(pm[lr.elasticNetParam]), float(v))
            for pm, v in zip(grid, m.avgMetrics)]
    return df.sparkSession.createDataFrame(rows, "reg double, mix double, roc_auc double")


def class_weight_grid(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                      weights: Sequence[float] = (0.05, 0.275, 0.5, 0.725, 0.95)) -> DataFrame:
    """A logistic model and a forest for each class weight (class 0
    weighs w, class 1 weighs 1 - w), scored on ``test`` by ROC AUC and Brier."""
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    tr, te = (va.transform(for_fits(d, [*features, label])).select("features", F.col(label).cast("double").alias("label")) for d in (train, test))
    rows = []
    for w in weights:
        weighted = tr.withColumn("w", F.when(F.col("label") == 0, w).otherwise(1.0 - w))
        for name, est in (("logistic", LogisticRegression(maxIter=50, weightCol="w")),
                          ("forest", RandomForestClassifier(numTrees=20, maxDepth=5, seed=1, weightCol="w"))):
            rows.append((name, float(w), *_auc_and_brier(est.fit(weighted).transform(te))))
    return train.sparkSession.createDataFrame(rows, "model string, weight double, roc_auc double, brier double")


def _auc_and_brier(scored: DataFrame) -> tuple[float, float]:
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction").evaluate(scored)
    p1 = vector_to_array(F.col("probability"))[1]
    return float(auc), float(scored.select(F.avg((p1 - F.col("label")) ** 2)).first()[0])


def repeated_grid_search(df: DataFrame, features: Sequence[str], label: str, key: Sequence[str], folds: int = 3, repeats: int = 2,
                         regs: Sequence[float] = (0.0, 0.01, 0.1)) -> DataFrame:
    """Repeated k-fold search over the regularisation of a logistic
    model: each repeat deals the rows into folds by another hash of ``key``.
    Mean ROC AUC and Brier score over all folds and repeats."""
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    dealt = df.withColumns({f"fold{r}": F.pmod(F.xxhash64(*key, F.lit(r)), F.lit(folds)) for r in range(repeats)})
    d = va.transform(for_fits(dealt, [*features, label, *[f"fold{r}" for r in range(repeats)]])).withColumn("label", F.col(label).cast("double"))
    rows = []
    for reg in regs:
        est = LogisticRegression(maxIter=50, regParam=reg)
        got = [_auc_and_brier(est.fit(d.filter(F.col(f"fold{r}") != k)).transform(d.filter(F.col(f"fold{r}") == k)))
               for r in range(repeats) for k in range(folds)]
        rows.append((float(reg), len(got), sum(g[0] for g in got) / len(got), sum(g[1] for g in got) / len(got)))
    return df.sparkSession.createDataFrame(rows, "reg double, n_fits int, roc_auc double, brier double")


def isotonic_calibration(df: DataFrame, y: str, p: str, key: str, folds: int = 5) -> DataFrame:
    """Isotonic regression of outcomes on scores; every row is calibrated
    by the fit of the folds that it is not in (folds by a hash of ``key``)."""
    d = df.withColumn("_fold", F.pmod(F.xxhash64(F.col(key), F.lit("fold")), F.lit(folds)).cast("int"))
    return out_of_fold_calibration(d, y, p, "_fold", folds).select("p", "label", r6("calibrated").alias("calibrated"))


def top_importances(df: DataFrame, features: Sequence[str], label: str, k: int = 10) -> DataFrame:
    """Random-forest feature importances with names, top ``k``."""
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    d = va.transform(for_fits(df, [*features, label])).withColumn("label", F.col(label).cast("double"))
    m = RandomForestClassifier(numTrees=30, maxDepth=6, seed=1).fit(d)
    rows = sorted(((f, float(v)) for f, v in zip(features, m.featureImportances.toArray())), key=lambda t: (-t[1], t[0]))
    return df.sparkSession.createDataFrame(rows[:k], "feature string, importance double")


def breusch_pagan(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """Breusch-Pagan LM = n R^2 of squared residuals on the regressors,
    and the Goldfeld-Quandt F: the rows are halved in the order of the first
    regressor, each half has a fit of its own, and F is the ratio of their
    residual variances (upper over lower)."""
    from quarry.functions.ordered import running_index
    va = VectorAssembler(inputCols=list(xs), outputCol="features", handleInvalid="skip")
    d = va.transform(for_fits(running_index(df.select(y, *xs).dropna(), [], [xs[0], y], "_pos"), [y, *xs, "_pos"]))
    m = LinearRegression(labelCol=y).fit(d)
    r = m.transform(d).withColumn("_e2", (F.col(y) - F.col("prediction")) ** 2)
    aux = LinearRegression(labelCol="_e2", predictionCol="_p2").fit(r)
    n = r.count()
    lm = n * aux.summary.r2

    def variance(half: DataFrame) -> float:
        s = LinearRegression(labelCol=y).fit(half).summary
        return s.meanSquaredError * s.numInstances / (s.numInstances - len(xs) - 1)

    half = n // 2
    gq = variance(d.filter(F.col("_pos") > half)) / variance(d.filter(F.col("_pos") <= half))
    return df.sparkSession.createDataFrame([(int(n), float(lm), float(gq))], "n long, bp_lm double, gq_f double")


def delong(df: DataFrame, y: str, p1: str, p2: str) -> DataFrame:
    """DeLong comparison of two correlated ROC AUCs.  Placement values
    come from mid-ranks (distributed, ``stats.average_ranks``): for a
    positive, V10 = (rank among all - rank among positives) / n0; for a
    negative, V01 = 1 - (rank among all - rank among negatives) / n1."""
    from quarry.functions.dist import norm_two_sided
    from quarry.operators.stats import average_ranks

    x = df.select(F.col(y).cast("int").alias("_y"), F.col(p1).alias("_a"), F.col(p2).alias("_b"),
                  F.monotonically_increasing_id().alias("_id"))
    for s in ("_a", "_b"):
        x = average_ranks(x, s, name=f"_rall{s}").drop("_ties")
        x = average_ranks(x, s, by=["_y"], name=f"_rgrp{s}").drop("_ties")
    n = x.agg(F.sum("_y").alias("n1"), F.sum(1 - F.col("_y")).alias("n0")).first()
    n1, n0 = n["n1"], n["n0"]
    pos, neg = F.col("_y") == 1, F.col("_y") == 0
    v = {}
    for s in ("_a", "_b"):
        v[f"v10{s}"] = F.when(pos, (F.col(f"_rall{s}") - F.col(f"_rgrp{s}")) / n0)
        v[f"v01{s}"] = F.when(neg, 1 - (F.col(f"_rall{s}") - F.col(f"_rgrp{s}")) / n1)
    agg = x.agg(*[F.avg(v[f"v10{s}"]).alias(f"auc{s}") for s in ("_a", "_b")],
                F.var_samp(v["v10_a"]).alias("s10aa"), F.var_samp(v["v10_b"]).alias("s10bb"),
                F.covar_samp(v["v10_a"], v["v10_b"]).alias("s10ab"),
                F.var_samp(v["v01_a"]).alias("s01aa"), F.var_samp(v["v01_b"]).alias("s01bb"),
                F.covar_samp(v["v01_a"], v["v01_b"]).alias("s01ab")).first()
    var = ((agg["s10aa"] + agg["s10bb"] - 2 * agg["s10ab"]) / n1 + (agg["s01aa"] + agg["s01bb"] - 2 * agg["s01ab"]) / n0)
    z = (agg["auc_a"] - agg["auc_b"]) / math.sqrt(var) if var > 0 else float("nan")
    return df.sparkSession.createDataFrame([(float(agg["auc_a"]), float(agg["auc_b"]), float(z), float(norm_two_sided(z)))],
                                           "auc_1 double, auc_2 double, z double, p double")
