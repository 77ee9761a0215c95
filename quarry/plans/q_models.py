"""Model queries (mostly rows-only: fitted parameters have no SQL oracle;
their unit tests check invariants and hand-computed cases)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.columns import r6
from quarry.functions.ordered import running_sums
from quarry.operators import linear_grid, mixed, models, rasch, windows
from quarry.operators.evaluate import stratified_folds
from quarry.operators.staged import written
from quarry.plans.registry import register
from quarry.plans.views import Views
from quarry.plans.views_sql import with_views

CASE_FEATURES = ["quantity", "price", "discount", "tax"]


def _case_key():
    return F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                       F.col("l_partkey").cast("string"), F.col("price").cast("string"), F.col("ts").cast("string"))


def _cases_filled(v: Views):
    c = v.cases
    m = c.agg(F.avg("quantity").alias("_mq"))
    from quarry.operators.aggregate import with_total
    return with_total(c, m).withColumn("quantity", F.coalesce("quantity", "_mq")).drop("_mq")


@register("o1_elastic_net")
def o1_elastic_net(spark, root):
    """Elastic-net regression (10 iterations, reg 0.3, mix 0.8), half/half
    hash split, predictions next to labels."""
    c = Views(spark, root).cases
    return models.elastic_net(c, "price", ["quantity", "discount", "tax"], _case_key())


@register("o2_ols_one_predictor", with_views("cases") + """
SELECT count(*) AS n, round(regr_slope(price, quantity), 6) AS slope, round(regr_intercept(price, quantity), 6) AS intercept,
  round(regr_r2(price, quantity), 6) AS r2 FROM cases WHERE price IS NOT NULL AND quantity IS NOT NULL""")
def o2_ols_one_predictor(spark, root):
    c = Views(spark, root).cases.dropna(subset=["price", "quantity"])
    return c.agg(F.count(F.lit(1)).alias("n"), r6(F.regr_slope("price", "quantity")).alias("slope"),
                 r6(F.regr_intercept("price", "quantity")).alias("intercept"), r6(F.regr_r2("price", "quantity")).alias("r2"))


@register("o2_ols_categorical")
def o2_ols_categorical(spark, root):
    c = Views(spark, root).cases.dropna(subset=["quantity"]).withColumn("stratum", F.col("stratum").cast("string"))
    return models.ols_table(c, "price", ["quantity", "discount"], ["stratum"])


@register("o3_one_vs_rest_logit")
def o3_one_vs_rest_logit(spark, root):
    return models.one_vs_rest_logit(Views(spark, root).survey, "klass", ["platform", "i1", "i2", "i3"])


@register("o4_factor_model")
def o4_factor_model(spark, root):
    """First-try success by skill and prior answers, with a random intercept
    per learner: log-likelihood, AIC, BIC and the learners' variance."""
    return _factor_model(spark, root)["fit"]


@register("o4_factor_effects")
def o4_factor_effects(spark, root):
    """The skills' easiness and slopes of the same model."""
    e = _factor_model(spark, root)["effects"]
    return e.select("question", *[r6(c).alias(c) for c in ("easiness", "on_success", "on_failure")])


def _factor_model(spark, root):
    a = Views(spark, root).attempts.select("user_id", "question", "ts", "event_id", "correct", (1 - F.col("correct")).alias("failure"))
    a = running_sums(a, ["user_id", "question"], ["ts", "event_id"], {"correct": "prior_success", "failure": "prior_failure"}, exclusive=True)
    return mixed.factor_mixed_model(a, "user_id", "question", "prior_success", "prior_failure", "correct")


@register("o5_random_slope")
def o5_random_slope(spark, root):
    """Answer time over the step's number with a random intercept and slope
    per learner."""
    r = mixed.random_slope(Views(spark, root).attempts, "user_id", "time_s", "k")
    return r.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in r.dtypes])


@register("o5_t23_mixed_model_icc")
def o5_t23_mixed_model_icc(spark, root):
    return models.random_intercept(Views(spark, root).attempts, "user_id", "time_s", "k")


_FIRST_SQL = """
, f AS (SELECT user_id, question, correct FROM (SELECT *, row_number() OVER (PARTITION BY user_id, question ORDER BY ts, event_id) AS rk
   FROM attempts) WHERE rk = 1),
pairs AS (SELECT r.question AS item_i, w.question AS item_j, count(*) AS n_ij
   FROM f r JOIN f w ON r.user_id = w.user_id AND r.correct = 1 AND w.correct = 0 GROUP BY 1, 2)"""


def _first_attempts(v: Views):
    from quarry.operators.aggregate import first_per_group
    return first_per_group(v.attempts, ["user_id", "question"], ["ts", "event_id"], ["correct"])


@register("o6_rasch_pair_counts", with_views("attempts") + _FIRST_SQL + " SELECT * FROM pairs")
def o6_rasch_pair_counts(spark, root):
    return models.rasch_pairs(_first_attempts(Views(spark, root)), "user_id", "question", "correct")


@register("o6_rasch_difficulty", with_views("attempts") + _FIRST_SQL + """
SELECT a.item_i AS item, round(avg(ln(b.n_ij / a.n_ij)), 6) AS difficulty FROM pairs a
JOIN pairs b ON a.item_i = b.item_j AND a.item_j = b.item_i GROUP BY 1""")
def o6_rasch_difficulty(spark, root):
    p = models.rasch_pairs(_first_attempts(Views(spark, root)), "user_id", "question", "correct")
    return models.rasch_difficulty(p)


@register("o6_rasch_conditional")
def o6_rasch_conditional(spark, root):
    """Item difficulties by conditional maximum likelihood (first answers)."""
    b = rasch.rasch_conditional(_first_attempts(Views(spark, root)), "user_id", "question", "correct")
    return b.select("item", *[r6(c).alias(c) for c in ("difficulty", "std_error")])


@register("o6_rasch_split_test")
def o6_rasch_split_test(spark, root):
    """Do the difficulties hold below and above the mean score?"""
    return rasch.rasch_split_test(_first_attempts(Views(spark, root)), "user_id", "question", "correct")


@register("o7_latent_profiles")
def o7_latent_profiles(spark, root):
    """Latent profiles for k = 2..5 on six survey items."""
    s = Views(spark, root).survey
    rows = []
    for k in (2, 3, 4, 5):
        r = models.latent_profiles(s, [f"i{i}" for i in range(1, 7)], k)
        rows.append((k, r["loglik"], r["free_params"], r["aic"], r["bic"], r["abic"], r["entropy"],
                     "/".join(f"{x:.3f}" for x in r["shares"])))
    return spark.createDataFrame(rows, "k int, loglik double, free_params int, aic double, bic double, abic double, "
                                       "entropy double, shares string")


@register("o7_profile_membership")
def o7_profile_membership(spark, root):
    """The three-class fit joined back: each user's class and its posterior."""
    s = Views(spark, root).survey
    items = [f"i{i}" for i in range(1, 7)]
    m = models.profile_membership(s, items, models.latent_profiles(s, items, 3))
    return m.select("user_id", "profile", r6(F.array_max("posterior")).alias("posterior"))


@register("o8_one_factor")
def o8_one_factor(spark, root):
    return models.one_factor(Views(spark, root).survey, [f"i{i}" for i in range(1, 7)])


@register("o9_chained_imputation")
def o9_chained_imputation(spark, root):
    c = Views(spark, root).cases.select("l_orderkey", "l_linenumber", *CASE_FEATURES)
    c = c.withColumn("tax", F.when(F.col("l_linenumber") == 3, F.lit(None)).otherwise(F.col("tax")))
    return models.chained_imputation(c, CASE_FEATURES, rounds=15)


def _split(v: Views):
    c = _cases_filled(v)
    return models.hash_split(c, _case_key(), 0.7, seed=3)


@register("o12_classifier_set")
def o12_classifier_set(spark, root):
    train, test = _split(Views(spark, root))
    return models.classifier_set(train, test, CASE_FEATURES, "y")


# Strengths, penalties and class weights of the searched grids.
_WEIGHTS = [0.05, 0.275, 0.5, 0.725, 0.95]
LINEAR_GRID = [linear_grid.Setting("log", p, c, per_total=True) for c in (1e-6, 1e-5, 1e-4, 1e-3) for p in ("l1", "l2")] + [
    linear_grid.Setting(loss, "l1", 1e-4, weight0=w, weight1=1.0 - w) for loss in ("log", "squared_hinge") for w in _WEIGHTS]


@register("o12_linear_grid")
def o12_linear_grid(spark, root):
    """The linear classifiers of all grids, fitted together on 70 % of the
    cases and scored on the others."""
    train, test = _split(Views(spark, root))
    fits = linear_grid.fit_grid(train, CASE_FEATURES, "y", LINEAR_GRID)
    return linear_grid.grid_report(linear_grid.grid_scores(test, CASE_FEATURES, "y", LINEAR_GRID, fits), LINEAR_GRID)


@register("o12_linear_grid_coefficients")
def o12_linear_grid_coefficients(spark, root):
    train, _ = _split(Views(spark, root))
    fits = linear_grid.fit_grid(train, CASE_FEATURES, "y", LINEAR_GRID)
    table = linear_grid.coefficient_table(spark, LINEAR_GRID, fits, CASE_FEATURES)
    return table.select("loss", "penalty", "strength", "weight0", "term", r6("estimate").alias("estimate"), "converged")


@register("o13_class_weighted")
def o13_class_weighted(spark, root):
    train, test = _split(Views(spark, root))
    train = models.class_weights(train, "y", "w")
    return models.classifier_set(train, test, CASE_FEATURES, "y", weight="w")


@register("o13_class_weight_grid")
def o13_class_weight_grid(spark, root):
    train, test = _split(Views(spark, root))
    return models.class_weight_grid(train, test, CASE_FEATURES, "y")


@register("o14_repeated_grid_search")
def o14_repeated_grid_search(spark, root):
    key = ["l_orderkey", "l_linenumber", "l_partkey", "price", "ts"]
    return models.repeated_grid_search(_cases_filled(Views(spark, root)), CASE_FEATURES, "y", key)


@register("o14_repeated_linear_grid")
def o14_repeated_linear_grid(spark, root):
    """All settings by two repeats of ten stratified folds, trained together;
    every case is scored by the fits that did not see it."""
    c = _cases_filled(Views(spark, root))
    tie = ["l_orderkey", "l_linenumber", "l_partkey", "price", "ts"]
    folds = ["fold_0", "fold_1"]
    for r, name in enumerate(folds):
        c = stratified_folds(c, "y", F.concat_ws("/", F.lit(r), _case_key()), 10, tie=tie).withColumnRenamed("fold", name)
    c = written(c.select("y", *CASE_FEATURES, *folds))
    fits = linear_grid.fit_grid(c, CASE_FEATURES, "y", LINEAR_GRID, folds, 10)
    return linear_grid.grid_report(linear_grid.grid_scores(c, CASE_FEATURES, "y", LINEAR_GRID, fits, folds), LINEAR_GRID)


@register("o14_grid_search_cv")
def o14_grid_search_cv(spark, root):
    c = _cases_filled(Views(spark, root))
    f = stratified_folds(c, "stratum", _case_key(), 5, tie=["l_orderkey", "l_linenumber", "l_partkey", "price", "ts"])
    return models.grid_search_cv(f, CASE_FEATURES, "y", "fold")


@register("o19_isotonic_calibration")
def o19_isotonic_calibration(spark, root):
    return models.isotonic_calibration(Views(spark, root).scored, "y", "p", "doc_id")


@register("o20_feature_importances")
def o20_feature_importances(spark, root):
    return models.top_importances(_cases_filled(Views(spark, root)), CASE_FEATURES, "y", 3)


@register("o22_next_step_model")
def o22_next_step_model(spark, root):
    """Next-step correctness from sliding windows of the two previous steps
    (the re-aimed sequence model), scored on a hash hold-out."""
    v = Views(spark, root)
    s = windows.sliding_sequences(v.attempts, ["user_id"], ["ts", "event_id"], ["question", "correct"], 3)
    feats = s.select("user_id", "event_id",
                     F.col("seq")[0]["question"].alias("q1"), F.col("seq")[0]["correct"].cast("double").alias("c1"),
                     F.col("seq")[1]["question"].alias("q2"), F.col("seq")[1]["correct"].cast("double").alias("c2"),
                     F.col("seq")[2]["question"].alias("q3"), F.col("seq")[2]["correct"].alias("y"))
    from quarry.operators.recode import dummies
    levels = ["click", "error", "purchase", "signup", "view"]
    for q in ("q1", "q2", "q3"):
        feats = dummies(feats, q, levels)
    cols = ["c1", "c2"] + [f"{q}_{lv}" for q in ("q1", "q2", "q3") for lv in levels]
    train, test = models.hash_split(feats, F.col("event_id"), 0.7, seed=5)
    return models.classifier_set(train, test, cols, "y")


@register("t16_heteroscedasticity")
def t16_heteroscedasticity(spark, root):
    return models.breusch_pagan(Views(spark, root).cases, "price", ["quantity", "discount"])


@register("t20_delong")
def t20_delong(spark, root):
    s = Views(spark, root).scored.withColumn("p2", ((F.col("doc_id") * 37) % 101 + 0.5) / 101)
    return models.delong(s, "y", "p", "p2")
