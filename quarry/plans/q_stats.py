"""Statistical tests, effect sizes, scale reliability and the scoring of
predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.columns import r6
from quarry.operators import evaluate, stats
from quarry.operators import sequences
from quarry.plans.registry import register
from quarry.plans.views import Views
from quarry.plans.views_sql import with_views

ITEMS10 = [f"i{i}" for i in range(1, 11)]


def _two_sample_sql(src: str, grp_a: str, grp_b: str, value: str, where: str = "TRUE") -> str:
    return f"""
, s AS (SELECT count(CASE WHEN {grp_a} THEN 1 END) AS n1, avg(CASE WHEN {grp_a} THEN {value} END) AS m1,
   var_samp(CASE WHEN {grp_a} THEN {value} END) AS v1, count(CASE WHEN {grp_b} THEN 1 END) AS n2,
   avg(CASE WHEN {grp_b} THEN {value} END) AS m2, var_samp(CASE WHEN {grp_b} THEN {value} END) AS v2
  FROM {src} WHERE ({grp_a} OR {grp_b}) AND {value} IS NOT NULL AND {where})"""


@register("t1_t_test", with_views("admissions") + _two_sample_sql("admissions", "dead", "NOT dead", "weight_kg") + """
SELECT n1, n2, round(m1, 6) AS mean1, round(m2, 6) AS mean2,
  round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)), 6) AS t_pooled,
  round(CAST(n1 + n2 - 2 AS DOUBLE), 6) AS df_pooled, round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 6) AS t_welch,
  round((v1 / n1 + v2 / n2) * (v1 / n1 + v2 / n2) / ((v1 / n1) * (v1 / n1) / (n1 - 1) + (v2 / n2) * (v2 / n2) / (n2 - 1)), 6) AS df_welch
FROM s""")
def t1_t_test(spark, root):
    return stats.t_test_stats_only(Views(spark, root).admissions, "dead", "weight_kg", True, False)


@register("t1_t_test_pvalues")
def t1_t_test_pvalues(spark, root):
    """Rows-only: t statistics with two-sided Student-t p-values."""
    return stats.t_test(Views(spark, root).admissions, "dead", "weight_kg", True, False)


_PREPOST_SQL = """
, s AS (SELECT user_id, session, sum(correct) * 100.0 / count(*) AS pct FROM attempts GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY session) AS cycle FROM s),
pp AS (SELECT user_id, avg(CASE WHEN cycle = 1 THEN pct END) AS pre, avg(CASE WHEN cycle = 2 THEN pct END) AS post
  FROM r GROUP BY user_id)"""


def _prepost(v: Views):
    from quarry.operators import reshape, windows
    s = v.attempts.groupBy("user_id", "session").agg((F.sum("correct") * 100.0 / F.count(F.lit(1))).alias("pct"))
    s = windows.running_index(s, ["user_id"], ["session"], "cycle")
    w = reshape.long_to_wide(s, ["user_id"], "cycle", "pct", [1, 2], "avg", prefix="c")
    return w.select("user_id", F.col("c1").alias("pre"), F.col("c2").alias("post"))


@register("t2_paired_difference", with_views("attempts") + _PREPOST_SQL + """
, d AS (SELECT post - pre AS d FROM pp WHERE post - pre IS NOT NULL)
SELECT count(*) AS n, round(avg(d), 6) AS mean_diff, round(stddev_samp(d), 6) AS sd_diff,
  round(avg(d) / (stddev_samp(d) / sqrt(count(*))), 6) AS t,
  round(avg(d) - 1.96 * stddev_samp(d) / sqrt(count(*)), 6) AS lo, round(avg(d) + 1.96 * stddev_samp(d) / sqrt(count(*)), 6) AS hi FROM d""")
def t2_paired_difference(spark, root):
    return stats.paired_difference(_prepost(Views(spark, root)), "pre", "post")


@register("t3_t5_cohens_d", with_views("survey") + _two_sample_sql("survey", "platform = 0", "platform = 1", "i1") + """
, d AS (SELECT n1, n2, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)) AS d FROM s)
SELECT round(d, 6) AS d, round(sqrt((n1 + n2) / (n1 * n2) + d * d / (2 * (n1 + n2))), 6) AS se,
  round(d - 1.96 * sqrt((n1 + n2) / (n1 * n2) + d * d / (2 * (n1 + n2))), 6) AS lo,
  round(d + 1.96 * sqrt((n1 + n2) / (n1 * n2) + d * d / (2 * (n1 + n2))), 6) AS hi,
  round(d / sqrt((n1 + n2) / (n1 * n2) + d * d / (2 * (n1 + n2))), 6) AS z FROM d""")
def t3_t5_cohens_d(spark, root):
    return stats.cohens_d(Views(spark, root).survey, "platform", "i1", 0, 1)


@register("t4_morris_g", with_views("attempts", "profiles") + _PREPOST_SQL + """
, j AS (SELECT pp.*, p.arm FROM pp JOIN profiles p USING (user_id) WHERE p.arm IN (0, 1) AND pre IS NOT NULL AND post IS NOT NULL),
st AS (SELECT count(CASE WHEN arm = 1 THEN 1 END) AS nt, count(CASE WHEN arm = 0 THEN 1 END) AS nc,
  avg(CASE WHEN arm = 1 THEN post END) AS mt1, avg(CASE WHEN arm = 1 THEN pre END) AS mt0,
  avg(CASE WHEN arm = 0 THEN post END) AS mc1, avg(CASE WHEN arm = 0 THEN pre END) AS mc0,
  var_samp(CASE WHEN arm = 1 THEN post END) AS vt1, var_samp(CASE WHEN arm = 1 THEN pre END) AS vt0,
  var_samp(CASE WHEN arm = 0 THEN post END) AS vc1, var_samp(CASE WHEN arm = 0 THEN pre END) AS vc0 FROM j),
e AS (SELECT *, sqrt(((nc - 1) * vc1 + (nc - 1) * vc0 + (nt - 1) * vt1 + (nt - 1) * vt0) / (2 * (nt + nc - 2))) AS s,
  1 - 3 / (4 * (2 * nc + 2 * nt - 4) - 1) AS c, (mt1 - mt0) - (mc1 - mc0) AS d FROM st)
SELECT nt, nc, round(c * d / s, 6) AS g, round(c, 6) AS cp, round(s, 6) AS sd, round(d / sqrt(s * s / nt + s * s / nc), 6) AS t FROM e""")
def t4_morris_g(spark, root):
    v = Views(spark, root)
    j = _prepost(v).join(v.profiles.select("user_id", "arm"), "user_id")
    return stats.morris_g(j, "arm", "pre", "post", 1, 0)


_RANKS_SQL = """
, c AS (SELECT v, count(*) AS t FROM x GROUP BY v),
r AS (SELECT v, t, coalesce(sum(t) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (t + 1) / 2.0 AS rank FROM c),
ts AS (SELECT sum(t * t * t - t) AS tie_sum FROM r)"""


@register("t8_mann_whitney", with_views("survey") + """
, x AS (SELECT platform AS g, i1 AS v FROM survey WHERE platform IN (0, 1) AND i1 IS NOT NULL)""" + _RANKS_SQL + """
, s AS (SELECT count(CASE WHEN g = 0 THEN 1 END) AS n1, count(CASE WHEN g = 1 THEN 1 END) AS n2, sum(CASE WHEN g = 0 THEN rank END) AS r1
  FROM x JOIN r USING (v))
SELECT n1, n2, round(r1 - n1 * (n1 + 1) / 2, 6) AS u1, round(n1 * n2 - (r1 - n1 * (n1 + 1) / 2), 6) AS u2,
  round(((r1 - n1 * (n1 + 1) / 2) - n1 * n2 / 2.0) / sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - tie_sum / ((n1 + n2) * (n1 + n2 - 1)))), 6) AS z
FROM s, ts""")
def t8_mann_whitney(spark, root):
    return stats.mann_whitney(Views(spark, root).survey, "platform", "i1", 0, 1)


@register("t9_kruskal_wallis", with_views("survey") + """
, x AS (SELECT klass AS g, i1 AS v FROM survey WHERE klass IS NOT NULL AND i1 IS NOT NULL)""" + _RANKS_SQL + """
, per AS (SELECT g, count(*) AS n, sum(rank) AS rs FROM x JOIN r USING (v) GROUP BY g),
s AS (SELECT CAST(sum(n) AS BIGINT) AS nn, sum(rs * rs / n) AS q, count(*) AS k FROM per)
SELECT k, nn AS n, round((12.0 / (nn * (nn + 1)) * q - 3 * (nn + 1)) / (1 - tie_sum / (nn * nn * nn - nn)), 6) AS h, k - 1 AS dof
FROM s, ts""")
def t9_kruskal_wallis(spark, root):
    return stats.kruskal_wallis(Views(spark, root).survey, "klass", "i1")


def _anova_sql(x: str) -> str:
    return f"""
, x AS ({x}),
per AS (SELECT g, count(*) AS n, avg(v) AS m, var_samp(v) AS var FROM x GROUP BY g),
gm AS (SELECT avg(v) AS gm FROM x),
s AS (SELECT sum(n * (m - gm) * (m - gm)) AS ssb, sum(coalesce((n - 1) * var, 0.0)) AS ssw, count(*) AS k,
      CAST(sum(n) AS BIGINT) AS nn FROM per, gm)
SELECT round(ssb, 6) AS ss_between, round(ssw, 6) AS ss_within, k - 1 AS df_between, nn - k AS df_within,
  round((ssb / (k - 1)) / (ssw / (nn - k)), 6) AS f FROM s"""


@register("t13_anova", with_views("attempts") + _anova_sql(
    "SELECT question AS g, time_s AS v FROM attempts WHERE time_s IS NOT NULL AND question IS NOT NULL"))
def t13_anova(spark, root):
    return stats.anova_oneway(Views(spark, root).attempts, "question", "time_s")


@register("t10_levene", with_views("survey") + """
, med AS (SELECT klass, quantile_cont(i2, 0.5) AS md FROM survey WHERE i2 IS NOT NULL GROUP BY 1)""" + _anova_sql(
    "SELECT s.klass AS g, abs(s.i2 - med.md) AS v FROM survey s JOIN med USING (klass) WHERE s.i2 IS NOT NULL"))
def t10_levene(spark, root):
    return stats.levene(Views(spark, root).survey, "klass", "i2")


@register("t11_jarque_bera", with_views("admissions") + """
, m AS (SELECT avg(weight_kg) AS mu, count(weight_kg) AS n FROM admissions),
c AS (SELECT max(n) AS n, avg((weight_kg - mu) * (weight_kg - mu)) AS m2, avg(power(weight_kg - mu, 3)) AS m3,
         avg(power(weight_kg - mu, 4)) AS m4 FROM admissions, m WHERE weight_kg IS NOT NULL)
SELECT n, round(m3 / power(m2, 1.5), 6) AS skewness, round(m4 / (m2 * m2) - 3, 6) AS excess_kurtosis,
  round(n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4.0), 6) AS jb FROM c""")
def t11_jarque_bera(spark, root):
    return stats.jarque_bera(Views(spark, root).admissions, "weight_kg")


@register("t12_chi_square", with_views("attempts") + """
, cells AS (SELECT question AS r, feedback AS c, count(*) AS o FROM attempts GROUP BY 1, 2),
rt AS (SELECT r, sum(o) AS rt FROM cells GROUP BY 1), ct AS (SELECT c, sum(o) AS ct FROM cells GROUP BY 1),
tot AS (SELECT sum(o) AS nt, count(DISTINCT r) AS nr, count(DISTINCT c) AS nc FROM cells)
SELECT round(sum(o * o / (rt * ct / nt)) - max(nt), 6) AS chi2, max((nr - 1) * (nc - 1)) AS dof
FROM cells JOIN rt USING (r) JOIN ct USING (c), tot""")
def t12_chi_square(spark, root):
    return stats.chi_square(Views(spark, root).attempts, "question", "feedback")


@register("t15_pearson_by_group", with_views("attempts") + """
SELECT question, round(corr(time_s, k), 6) AS r, count(*) AS n FROM attempts GROUP BY 1""")
def t15_pearson_by_group(spark, root):
    a = Views(spark, root).attempts
    return a.groupBy("question").agg(r6(F.corr("time_s", "k")).alias("r"), F.count(F.lit(1)).alias("n"))


@register("t17_vif_two", with_views("cases") + """
SELECT round(corr(price, discount), 6) AS r, round(1 / (1 - corr(price, discount) * corr(price, discount)), 6) AS vif FROM cases""")
def t17_vif_two(spark, root):
    return stats.vif_two(Views(spark, root).cases, "price", "discount")


@register("t17_vif", with_views("cases") + """
, x AS (SELECT corr(price, discount) AS ab, corr(price, quantity) AS ac, corr(discount, quantity) AS bc FROM cases
        WHERE price IS NOT NULL AND discount IS NOT NULL AND quantity IS NOT NULL),
d AS (SELECT *, 1 + 2 * ab * ac * bc - ab * ab - ac * ac - bc * bc AS det FROM x)
SELECT 'price' AS feature, round((1 - bc * bc) / det, 6) AS vif FROM d
UNION ALL SELECT 'discount', round((1 - ac * ac) / det, 6) FROM d
UNION ALL SELECT 'quantity', round((1 - ab * ab) / det, 6) FROM d""")
def t17_vif(spark, root):
    return stats.vif(Views(spark, root).cases, ["price", "discount", "quantity"])


@register("t19_sample_size", with_views("signs") + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(ceil(1.96 * 1.96 * 0.5 * 0.5 / (0.05 * 0.05) / (count({c}) * 1.0 / count(*))) AS BIGINT) AS n_required FROM signs"
    for c in ("floppy", "convulsions", "indrawing", "grunting", "jaundice")) + ")")
def t19_sample_size(spark, root):
    from quarry.operators.aggregate import missingness
    m = missingness(Views(spark, root).signs, ["floppy", "convulsions", "indrawing", "grunting", "jaundice"])
    comp = 1 - F.col("pct_missing") / 100.0
    return m.select("column", F.ceil(stats.sample_size_proportion(F.lit(0.5), 0.05, 1.96, comp)).alias("n_required"))


@register("t21_cronbach_alpha", with_views("survey") + f"""
, x AS (SELECT * FROM survey WHERE {" AND ".join(f"{c} IS NOT NULL" for c in ITEMS10)})
SELECT 10 AS k, round(10.0 / 9.0 * (1 - ({" + ".join(f"var_samp({c})" for c in ITEMS10)}) / var_samp({" + ".join(ITEMS10)})), 6) AS alpha FROM x""")
def t21_cronbach_alpha(spark, root):
    return stats.cronbach_alpha(Views(spark, root).survey, ITEMS10)


@register("t22_item_total", with_views("survey") + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS item, round(corr({c}, ({' + '.join(ITEMS10)}) - {c}), 6) AS r_item_rest FROM survey" for c in ITEMS10) + ")")
def t22_item_total(spark, root):
    return stats.item_total(Views(spark, root).survey, ITEMS10)


@register("t6_bootstrap_interval")
def t6_bootstrap_interval(spark, root):
    """Rows-only: percentile bootstrap (1000 resamples of 83 per arm) of the
    pre/post/control effect size."""
    v = Views(spark, root)
    j = _prepost(v).join(v.profiles.select("user_id", "arm"), "user_id")
    return stats.bootstrap_effect(j, "arm", "pre", "post", 1, 0, seed=7)


@register("t14_pairwise_bh")
def t14_pairwise_bh(spark, root):
    """Rows-only: pairwise Mann-Whitney between survey classes with
    Benjamini-Hochberg adjusted p-values."""
    return stats.pairwise_mann_whitney_bh(Views(spark, root).survey, "klass", "i1")


# ----------------------------------------------------------------- scoring predictions

@register("o16_scoring_report", with_views("scored") + """
SELECT lang, count(*) AS n, round(avg((p - y) * (p - y)), 6) AS brier,
  CAST(sum(CASE WHEN p >= 0.5 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp, CAST(sum(CASE WHEN p >= 0.5 AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN p < 0.5 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  round(sum(CASE WHEN p >= 0.5 AND y = 1 THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END), 0), 6) AS precision,
  round(sum(CASE WHEN p >= 0.5 AND y = 1 THEN 1 ELSE 0 END) / nullif(sum(y), 0), 6) AS recall,
  round(2.0 * sum(CASE WHEN p >= 0.5 AND y = 1 THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END) + sum(y), 0), 6) AS f1,
  round(-avg(y * ln(greatest(least(p, 1 - 1e-15), 1e-15)) + (1 - y) * ln(1 - greatest(least(p, 1 - 1e-15), 1e-15))), 6) AS log_loss
FROM scored GROUP BY lang""")
def o16_scoring_report(spark, root):
    return evaluate.scoring_report(Views(spark, root).scored, "y", "p", ["lang"])


@register("o17_calibration_bins", with_views("scored") + """
SELECT CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(p), 6) AS mean_p, round(avg(y), 6) AS frac_pos
FROM scored GROUP BY 1""")
def o17_calibration_bins(spark, root):
    return evaluate.calibration(Views(spark, root).scored, "y", "p", 10)


@register("o18_roc_pr_auc", with_views("scored") + """
, c AS (SELECT p, count(*) AS t, sum(y) AS pos FROM scored GROUP BY p),
r AS (SELECT p, t, pos, coalesce(sum(t) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (t + 1) / 2.0 AS rank,
   sum(pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
   sum(t - pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM c),
s AS (SELECT sum(pos) AS n1, sum(t) - sum(pos) AS n0, sum(pos * rank) AS r1, sum(pos / (SELECT sum(pos) FROM c) * tp / (tp + fp)) AS ap FROM r)
SELECT round((r1 - n1 * (n1 + 1) / 2) / (n1 * n0), 6) AS roc_auc, round(ap, 6) AS pr_auc FROM s""")
def o18_roc_pr_auc(spark, root):
    return evaluate.roc_pr_auc(Views(spark, root).scored, "y", "p")


@register("e42_brier_by_group", with_views("scored") + """
SELECT source, count(*) AS n, round(avg((p - y) * (p - y)), 6) AS brier FROM scored GROUP BY 1""")
def e42_brier_by_group(spark, root):
    s = Views(spark, root).scored
    return s.groupBy("source").agg(F.count(F.lit(1)).alias("n"), r6(F.avg((F.col("p") - F.col("y")) ** 2)).alias("brier"))


@register("o15_stratified_folds", with_views("cases") + """
SELECT l_orderkey, l_linenumber, l_partkey, stratum, CAST(ntile(5) OVER (PARTITION BY stratum ORDER BY md5(CAST(l_orderkey AS VARCHAR) || ':' ||
  CAST(l_linenumber AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR) || ':' || CAST(price AS VARCHAR) || ':' || CAST(ts AS VARCHAR)),
  l_orderkey, l_linenumber, l_partkey, price, ts) AS INTEGER) AS fold FROM cases""")
def o15_stratified_folds(spark, root):
    c = Views(spark, root).cases
    key = F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                      F.col("l_partkey").cast("string"), F.col("price").cast("string"), F.col("ts").cast("string"))
    f = evaluate.stratified_folds(c, "stratum", key, 5, tie=["l_orderkey", "l_linenumber", "l_partkey", "price", "ts"])
    return f.select("l_orderkey", "l_linenumber", "l_partkey", "stratum", "fold")


@register("o15_site_holdout", with_views("cases") + """
, s AS (SELECT DISTINCT stratum, site FROM cases WHERE site IS NOT NULL),
h AS (SELECT stratum, arg_min(site, md5(CAST(site AS VARCHAR))) AS site FROM s GROUP BY 1)
SELECT c.stratum, h.site, count(CASE WHEN c.site = h.site THEN 1 END) AS n_held, count(CASE WHEN c.site <> h.site THEN 1 END) AS n_train
FROM cases c JOIN h ON c.stratum = h.stratum GROUP BY 1, 2""")
def o15_site_holdout(spark, root):
    c = Views(spark, root).cases
    held = evaluate.hold_out_sites(c, "stratum", "site").withColumnRenamed("site", "held_site")
    j = c.join(held, "stratum")
    return j.groupBy("stratum", F.col("held_site").alias("site")).agg(
        F.count(F.when(F.col("site") == F.col("held_site"), 1)).alias("n_held"),
        F.count(F.when(F.col("site") != F.col("held_site"), 1)).alias("n_train"))


@register("e46_opportunity_curve", with_views("attempts", "profiles") + """
, o AS (SELECT a.correct, a.k, p.arm, p.experience, row_number() OVER (PARTITION BY a.user_id, a.question ORDER BY a.ts, a.event_id) AS opportunity
  FROM attempts a JOIN profiles p USING (user_id))
SELECT CAST(opportunity AS INTEGER) AS opportunity, CAST(arm AS INTEGER) AS klass, count(*) AS n, round(avg(k / 100.0), 6) AS mean_prediction,
  round(quantile_cont(k / 100.0, 0.5), 6) AS median_prediction, round(avg(correct), 6) AS mean_correct FROM o GROUP BY 1, 2""")
def e46_opportunity_curve(spark, root):
    """The curve by opportunity and learner class: predictions and outcomes."""
    from quarry.operators import windows
    from quarry.operators.aggregate import quantiles_by
    v = Views(spark, root)
    a = windows.running_index(v.attempts.select("user_id", "question", "ts", "event_id", "k", "correct"), ["user_id", "question"],
                              ["ts", "event_id"], "opportunity")
    j = a.join(v.profiles.select("user_id", F.col("arm").alias("klass")), "user_id").withColumn("p", F.col("k") / 100.0)
    med = quantiles_by(j, ["opportunity", "klass"], "p", probs=(0.5,), names=("median_prediction",))
    g = j.groupBy("opportunity", "klass").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("p")).alias("mean_prediction"),
                                              r6(F.avg("correct")).alias("mean_correct"))
    return g.join(med, ["opportunity", "klass"]).select("opportunity", "klass", "n", "mean_prediction",
                                                        r6("median_prediction").alias("median_prediction"), "mean_correct")


@register("o21_model_rollup", with_views("scored") + """
, per AS (SELECT lang, source, avg((p - y) * (p - y)) AS brier FROM scored GROUP BY 1, 2)
SELECT lang, count(*) AS n_runs, round(avg(brier), 6) AS mean, round(min(brier), 6) AS min, round(max(brier), 6) AS max FROM per GROUP BY 1""")
def o21_model_rollup(spark, root):
    s = Views(spark, root).scored
    per = s.groupBy("lang", "source").agg(F.avg((F.col("p") - F.col("y")) ** 2).alias("brier"))
    return evaluate.rollup(per, ["lang"], "brier")


@register("e46_decay_curve", with_views("attempts", "profiles") + """
, g AS (SELECT a.user_id, p.arm, a.correct, date_diff('microsecond', lag(a.ts) OVER (PARTITION BY a.user_id, a.question ORDER BY a.ts, a.event_id), a.ts) / 60000000.0 AS gap
  FROM attempts a JOIN profiles p USING (user_id))
SELECT CAST(floor(ln(gap)) AS BIGINT) AS log_gap_bin, arm, count(*) AS n, round(avg(correct), 6) AS mean_correct,
  round(quantile_cont(correct, 0.5), 6) AS median_correct FROM g WHERE gap > 0 GROUP BY 1, 2""")
def e46_decay_curve(spark, root):
    from quarry.functions import ordered
    from quarry.functions.columns import minutes_between
    from quarry.operators.aggregate import quantiles_by
    v = Views(spark, root)
    j = v.attempts.join(v.profiles.select("user_id", "arm"), "user_id").select("user_id", "question", "ts", "event_id",
                                                                               "arm", "correct")
    g = ordered.lag(j, ["user_id", "question"], ["ts", "event_id"], ["ts"]) \
        .withColumn("gap", minutes_between(F.col("ts_prev"), F.col("ts"))).filter(F.col("gap") > 0) \
        .withColumn("log_gap_bin", F.floor(F.log("gap")))
    m = g.groupBy("log_gap_bin", "arm").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("correct")).alias("mean_correct"))
    q = quantiles_by(g, ["log_gap_bin", "arm"], "correct", probs=(0.5,), names=("median_correct",))
    return m.join(q, ["log_gap_bin", "arm"]).select("log_gap_bin", "arm", "n", "mean_correct",
                                                  r6("median_correct").alias("median_correct"))


__all__ = ["sequences"]


@register("e21_correlation_pvalues")
def e21_correlation_pvalues(spark, root):
    """Rows-only: survey item correlations with p-values, non-significant
    cells zeroed."""
    return stats.correlation_pvalues(Views(spark, root).survey, [f"i{i}" for i in range(1, 6)])


@register("t7_median_difference_interval")
def t7_median_difference_interval(spark, root):
    """Rows-only: distribution-free 95% interval for the median difference
    of an item between platforms (no pair enumeration; unit-tested against
    brute force)."""
    return stats.median_difference_interval(Views(spark, root).survey, "platform", "i1", 0, 1)
