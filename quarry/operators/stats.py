"""Statistical tests and effect sizes.

The data work (counts, sums, ranks, sums of squares) is a Spark aggregate;
test statistics are column arithmetic on the one-row (or one-row-per-group)
result.  p-values need special functions (normal, Student t, F,
chi-square tails); those are evaluated by small vectorised pandas UDFs over
the already aggregated rows (``functions.dist``), never over the raw data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage
from quarry.functions.columns import r6
from quarry.operators.aggregate import with_total


def funnel_limits(df: DataFrame, group: str, flag: str) -> DataFrame:
    """Per group rate with pooled proportion and 95% / 99.8% normal
    funnel limits."""
    g = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(flag).cast("int")).alias("d"))
    p = g.agg((F.sum("d") / F.sum("n")).alias("p0"))
    x = with_total(g, p)
    se = F.sqrt(F.col("p0") * (1 - F.col("p0")) / F.col("n"))
    return x.select(group, "n", F.col("d").cast("long").alias("events"), r6(F.col("d") / F.col("n")).alias("rate"),
                    r6("p0").alias("pooled"),
                    r6(F.col("p0") - 1.959964 * se).alias("lo95"), r6(F.col("p0") + 1.959964 * se).alias("hi95"),
                    r6(F.col("p0") - 3.090232 * se).alias("lo998"), r6(F.col("p0") + 3.090232 * se).alias("hi998"))


def two_sample_summary(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """Per-arm n, mean and sample variance as one row (a_*, b_*)."""
    x = df.filter(F.col(group).isin(a, b) & F.col(value).isNotNull())
    return x.agg(
        F.count(F.when(F.col(group) == a, 1)).alias("n1"),
        F.avg(F.when(F.col(group) == a, F.col(value))).alias("m1"),
        F.var_samp(F.when(F.col(group) == a, F.col(value))).alias("v1"),
        F.count(F.when(F.col(group) == b, 1)).alias("n2"),
        F.avg(F.when(F.col(group) == b, F.col(value))).alias("m2"),
        F.var_samp(F.when(F.col(group) == b, F.col(value))).alias("v2"),
    )


def t_test(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """Pooled and Welch two-sample t statistics with degrees of freedom
    (and two-sided p-values from the Student t tail)."""
    from quarry.functions.dist import t_sf2

    s = two_sample_summary(df, group, value, a, b)
    n1, n2, m1, m2, v1, v2 = (F.col(c) for c in ("n1", "n2", "m1", "m2", "v1", "v2"))
    sp = ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
    t_pooled = (m1 - m2) / F.sqrt(sp * (1 / n1 + 1 / n2))
    df_pooled = n1 + n2 - 2
    se2 = v1 / n1 + v2 / n2
    t_welch = (m1 - m2) / F.sqrt(se2)
    df_welch = se2 * se2 / ((v1 / n1) * (v1 / n1) / (n1 - 1) + (v2 / n2) * (v2 / n2) / (n2 - 1))
    out = s.select(n1.alias("n1"), n2.alias("n2"), r6(m1).alias("mean1"), r6(m2).alias("mean2"),
                   t_pooled.alias("t_pooled"), df_pooled.cast("double").alias("df_pooled"),
                   t_welch.alias("t_welch"), df_welch.alias("df_welch"))
    return out.select("n1", "n2", "mean1", "mean2", r6("t_pooled").alias("t_pooled"), r6("df_pooled").alias("df_pooled"),
                      r6("t_welch").alias("t_welch"), r6("df_welch").alias("df_welch"),
                      r6(t_sf2(F.col("t_pooled"), F.col("df_pooled"))).alias("p_pooled"),
                      r6(t_sf2(F.col("t_welch"), F.col("df_welch"))).alias("p_welch"))


def t_test_stats_only(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """T1 without p-values (pure SQL-expressible part)."""
    return t_test(df, group, value, a, b).drop("p_pooled", "p_welch")


def paired_difference(df: DataFrame, before: str, after: str) -> DataFrame:
    """Mean paired difference, SD, t and a 95% normal interval."""
    d = F.col(after) - F.col(before)
    g = df.filter(d.isNotNull()).agg(F.count(F.lit(1)).alias("n"), F.avg(d).alias("mean_diff"),
                                     F.stddev_samp(d).alias("sd_diff"))
    se = F.col("sd_diff") / F.sqrt("n")
    return g.select("n", r6("mean_diff").alias("mean_diff"), r6("sd_diff").alias("sd_diff"),
                    r6(F.col("mean_diff") / se).alias("t"),
                    r6(F.col("mean_diff") - 1.96 * se).alias("lo"), r6(F.col("mean_diff") + 1.96 * se).alias("hi"))


def cohens_d(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """Cohen's d with pooled SD, its SE, 95% interval and z."""
    s = two_sample_summary(df, group, value, a, b)
    n1, n2, m1, m2, v1, v2 = (F.col(c) for c in ("n1", "n2", "m1", "m2", "v1", "v2"))
    sp = F.sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2))
    d = (m1 - m2) / sp
    se = F.sqrt((n1 + n2) / (n1 * n2) + d * d / (2 * (n1 + n2)))
    return s.select(r6(d).alias("d"), r6(se).alias("se"), r6(d - 1.96 * se).alias("lo"),
                    r6(d + 1.96 * se).alias("hi"), r6(d / se).alias("z"))


def _morris(x: DataFrame, is_t, pre: str, post: str, keys: Sequence[str] = ()) -> DataFrame:
    """Effect size of Morris with the pooled variance of all four samples,
    bias correction and t, per ``keys``."""
    aggs = [F.count(F.when(is_t, 1)).alias("nt"), F.count(F.when(~is_t, 1)).alias("nc"),
            F.avg(F.when(is_t, F.col(post) - F.col(pre))).alias("dt"), F.avg(F.when(~is_t, F.col(post) - F.col(pre))).alias("dc")]
    aggs += [F.var_samp(F.when(who, F.col(c))).alias(f"v{w}{i}") for w, who in (("t", is_t), ("c", ~is_t)) for i, c in enumerate((pre, post))]
    s = x.groupBy(*keys).agg(*aggs) if keys else x.agg(*aggs)
    nt, nc = F.col("nt"), F.col("nc")
    sd = F.sqrt(((nc - 1) * (F.col("vc0") + F.col("vc1")) + (nt - 1) * (F.col("vt0") + F.col("vt1"))) / (2 * (nt + nc - 2)))
    cp = 1 - 3 / (4 * (2 * nt + 2 * nc - 4) - 1)
    change = F.col("dt") - F.col("dc")
    return s.select(*keys, "nt", "nc", (cp * change / sd).alias("g"), cp.alias("cp"), sd.alias("sd"),
                    (change / F.sqrt(sd * sd / nt + sd * sd / nc)).alias("t"))


def morris_g(df: DataFrame, group: str, pre: str, post: str, treat, control) -> DataFrame:
    """T4: pre/post/control effect size, the pooled standard deviation over
    the four samples (pre and post of both arms), the small-sample correction
    c_p = 1 - 3 / (4 (2 n_t + 2 n_c - 4) - 1) and the t statistic.  Rows
    without a pre or post score are left out."""
    x = df.filter(F.col(group).isin(treat, control) & F.col(pre).isNotNull() & F.col(post).isNotNull())
    s = _morris(x, F.col(group) == treat, pre, post)
    return s.select("nt", "nc", *[r6(c).alias(c) for c in ("g", "cp", "sd", "t")])


def average_ranks(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Mid-ranks with ties averaged: rank + (ties - 1) / 2.

    Computed on the distinct (value, count) table: the count of smaller
    values gives the rank.  With no grouping the cumulative count runs
    through ``ordered.global_cumsum`` (range-partitioned, not one task);
    the ranks are joined back on the value."""
    from quarry.functions.ordered import global_cumsum, running_sum

    cnt = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_t"))
    if by:
        below = running_sum(cnt, list(by), [value], "_t", "_below", exclusive=True)
    else:
        below = global_cumsum(cnt, [value], ["_t"], exclusive=True, suffix="_below") \
            .withColumnRenamed("_t_below", "_below")
    ranks = below.withColumn(name, F.col("_below") + (F.col("_t") + 1) / 2.0)
    return df.join(ranks.select(*by, value, name, F.col("_t").alias("_ties")), [*by, value])


def mann_whitney(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """Mann-Whitney U with tie-corrected normal z."""
    x = df.filter(F.col(group).isin(a, b))
    r = average_ranks(x, value)
    ties = r.groupBy(value).agg(F.first("_ties").alias("t"))
    tie_sum = ties.agg(F.sum(F.col("t") ** 3 - F.col("t")).alias("tie_sum"))
    s = r.agg(F.count(F.when(F.col(group) == a, 1)).alias("n1"), F.count(F.when(F.col(group) == b, 1)).alias("n2"),
              F.sum(F.when(F.col(group) == a, F.col("rank"))).alias("r1"))
    s = with_total(s, tie_sum)
    n1, n2 = F.col("n1"), F.col("n2")
    u1 = F.col("r1") - n1 * (n1 + 1) / 2
    n = n1 + n2
    sigma = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.col("tie_sum") / (n * (n - 1))))
    return s.select("n1", "n2", r6(u1).alias("u1"), r6(n1 * n2 - u1).alias("u2"),
                    r6((u1 - n1 * n2 / 2.0) / sigma).alias("z"))


def kruskal_wallis(df: DataFrame, group: str, value: str) -> DataFrame:
    """Kruskal-Wallis H with tie correction."""
    r = average_ranks(df.filter(F.col(group).isNotNull()), value)
    per = r.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum("rank").alias("rs"))
    ties = r.groupBy(value).agg(F.first("_ties").alias("t")).agg(F.sum(F.col("t") ** 3 - F.col("t")).alias("ts"))
    s = per.agg(F.sum("n").alias("N"), F.sum(F.col("rs") * F.col("rs") / F.col("n")).alias("q"),
                F.count(F.lit(1)).alias("k"))
    s = with_total(s, ties)
    N = F.col("N")
    h = 12.0 / (N * (N + 1)) * F.col("q") - 3 * (N + 1)
    c = 1 - F.col("ts") / (N * N * N - N)
    return s.select(F.col("k").alias("k"), N.alias("n"), r6(h / c).alias("h"), (F.col("k") - 1).alias("dof"))


def anova_oneway(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way ANOVA F from between / within sums of squares."""
    x = df.filter(F.col(value).isNotNull() & F.col(group).isNotNull())
    per = x.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("m"),
                               F.var_samp(value).alias("v"))
    grand = x.agg(F.avg(value).alias("gm"))
    t = with_total(per, grand)
    s = t.agg(F.sum(F.col("n") * (F.col("m") - F.col("gm")) ** 2).alias("ssb"),
              F.sum(F.coalesce((F.col("n") - 1) * F.col("v"), F.lit(0.0))).alias("ssw"),
              F.count(F.lit(1)).alias("k"), F.sum("n").alias("N"))
    dfb = F.col("k") - 1
    dfw = F.col("N") - F.col("k")
    return s.select(r6("ssb").alias("ss_between"), r6("ssw").alias("ss_within"), dfb.alias("df_between"),
                    dfw.alias("df_within"), r6((F.col("ssb") / dfb) / (F.col("ssw") / dfw)).alias("f"))


def levene(df: DataFrame, group: str, value: str) -> DataFrame:
    """Brown-Forsythe / Levene (median-centred): ANOVA F on absolute
    deviations from the group median."""
    from quarry.operators.aggregate import quantiles_by
    med = quantiles_by(df, [group], value, probs=(0.5,), names=("_med",))
    dev = df.join(med, group).withColumn("_absdev", F.abs(F.col(value) - F.col("_med")))
    return anova_oneway(dev, group, "_absdev")


def jarque_bera(df: DataFrame, value: str) -> DataFrame:
    """Jarque-Bera normality statistic from skewness and kurtosis."""
    s = df.agg(F.count(value).alias("n"), F.skewness(value).alias("s"), F.kurtosis(value).alias("k"))
    jb = F.col("n") / 6.0 * (F.col("s") ** 2 + (F.col("k") ** 2) / 4.0)
    return s.select("n", r6("s").alias("skewness"), r6("k").alias("excess_kurtosis"), r6(jb).alias("jb"))


def chi_square(df: DataFrame, row: str, column: str) -> DataFrame:
    """Chi-square statistic of independence with degrees of freedom.

    Uses sum((o - e)^2 / e) = sum(o^2 / e) - N, where the sum runs over the
    observed cells only, so the empty cells of the grid never need to be
    materialised."""
    cells = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("_o"))
    rows = cells.groupBy(row).agg(F.sum("_o").alias("_rt"))
    cols = cells.groupBy(column).agg(F.sum("_o").alias("_ct"))
    tot = cells.agg(F.sum("_o").alias("_nt"), F.countDistinct(row).alias("_nr"), F.countDistinct(column).alias("_nc"))
    e = with_total(cells.join(rows, row).join(cols, column), tot)
    ex = F.col("_rt") * F.col("_ct") / F.col("_nt")
    s = e.agg(F.sum(F.col("_o") * F.col("_o") / ex).alias("_q"), F.first("_nt").alias("_nt"),
              F.first("_nr").alias("_nr"), F.first("_nc").alias("_nc"))
    return s.select(r6(F.col("_q") - F.col("_nt")).alias("chi2"),
                    ((F.col("_nr") - 1) * (F.col("_nc") - 1)).alias("dof"))


def cronbach_alpha(df: DataFrame, items: Sequence[str]) -> DataFrame:
    """Item-wise Cronbach alpha over complete responses."""
    x = df.dropna(subset=list(items))
    total = None
    for c in items:
        total = F.col(c) if total is None else total + F.col(c)
    s = x.agg(*[F.var_samp(c).alias(f"v{i}") for i, c in enumerate(items)], F.var_samp(total).alias("vt"))
    k = len(items)
    sv = None
    for i in range(k):
        sv = F.col(f"v{i}") if sv is None else sv + F.col(f"v{i}")
    return s.select(F.lit(k).alias("k"), r6(F.lit(k / (k - 1)) * (1 - sv / F.col("vt"))).alias("alpha"))


def item_total(df: DataFrame, items: Sequence[str]) -> DataFrame:
    """Corrected item-total correlation (item vs. sum of the others)."""
    total = None
    for c in items:
        total = F.col(c) if total is None else total + F.col(c)
    x = df.dropna(subset=list(items)).withColumn("_tot", total)
    s = x.agg(*[F.corr(F.col(c), F.col("_tot") - F.col(c)).alias(c) for c in items])
    arr = F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).alias("r")) for c in items])
    return s.select(F.explode(arr).alias("s")).select("s.item", r6("s.r").alias("r_item_rest"))


def benjamini_hochberg(df: DataFrame, p: str, name: str = "p_adj") -> DataFrame:
    """T14 (step): BH adjusted p = min over larger ranks of p*m/rank, capped
    at 1.  Runs on a table of test results (one row per comparison)."""
    m = F.count(F.lit(1)).over(Window.partitionBy())
    w = Window.orderBy(F.col(p).desc()).rowsBetween(Window.unboundedPreceding, 0)
    rk = F.row_number().over(Window.orderBy(p))
    x = df.withColumn("_m", m).withColumn("_r", rk)
    return (x.withColumn(name, F.least(F.lit(1.0), F.min(F.col(p) * F.col("_m") / F.col("_r")).over(w)))
            .drop("_m", "_r"))


def vif_two(df: DataFrame, a: str, b: str) -> DataFrame:
    """T17 for two features: 1 / (1 - r^2)."""
    s = df.agg(F.corr(a, b).alias("r"))
    return s.select(r6("r").alias("r"), r6(1 / (1 - F.col("r") ** 2)).alias("vif"))


def vif(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Variance inflation factors, the diagonal of the inverse of the
    features' correlation matrix.  One aggregate over the complete rows gives
    the matrix (one number per pair of features), which is inverted here."""
    import numpy as np
    rows = df.select(*features).dropna()
    pairs = [(i, j) for i in range(len(features)) for j in range(i)]
    got = rows.agg(*[F.corr(features[i], features[j]).alias(f"r{i}_{j}") for i, j in pairs]).first()
    m = np.eye(len(features))
    for i, j in pairs:
        m[i, j] = m[j, i] = got[f"r{i}_{j}"]
    out = [(f, round(float(v), 6)) for f, v in zip(features, np.diag(np.linalg.inv(m)), strict=True)]
    return df.sparkSession.createDataFrame(out, "feature string, vif double")


def sample_size_proportion(p: Column, margin: float, z: float = 1.96, completeness: Column | None = None) -> Column:
    """n = z^2 p (1-p) / e^2, inflated by 1 / completeness."""
    n = (z * z) * p * (1 - p) / (margin * margin)
    return n / completeness if completeness is not None else n


def bootstrap_effect(df: DataFrame, group: str, pre: str, post: str, treat, control, replicates: int = 1000,
                     per_arm: int = 83, seed: int = 0, probs=(0.025, 0.5, 0.975)) -> DataFrame:
    """Percentile bootstrap of the pre/post/control effect size (T4).

    Rows get a dense index per arm (``ordered.running_index``); draw ``j`` of
    replicate ``r`` takes index ``pmod(xxhash64(seed, r, arm, j), n)``, so
    draws are repeatable and are made row by row from a range of
    replicates x 2 x per_arm numbers.  They join the sample on (arm, index);
    the replicates' effects are one aggregate, the interval one percentile."""
    from quarry.functions.ordered import running_index
    from quarry.operators.aggregate import with_total

    x = df.filter(F.col(group).isin(treat, control) & F.col(pre).isNotNull() & F.col(post).isNotNull())
    x = x.select((F.col(group) == treat).alias("_t"), F.col(pre).cast("double").alias("_pre"), F.col(post).cast("double").alias("_post"))
    x = running_index(x, ["_t"], ["_pre", "_post"], "_idx")
    sizes = x.groupBy("_t").agg(F.count(F.lit(1)).alias("_n"))
    n = F.col("id")
    draws = df.sparkSession.range(replicates * 2 * per_arm).select(
        F.floor(n / (2 * per_arm)).alias("rep"), (n % 2 == 0).alias("_t"), F.floor(n % (2 * per_arm) / 2).alias("j"))
    draws = draws.join(sizes, "_t").select(
        "rep", "_t", (F.pmod(F.xxhash64(F.lit(seed), "rep", "_t", "j"), F.col("_n")) + 1).alias("_idx"))
    effects = _morris(draws.join(x, ["_t", "_idx"]), F.col("_t"), "_pre", "_post", ["rep"])
    q = effects.agg(F.percentile("g", F.array(*[F.lit(p) for p in probs])).alias("q"), F.count(F.lit(1)).alias("replicates"))
    out = with_total(q, _morris(x, F.col("_t"), "_pre", "_post").select(F.col("g").alias("observed")))
    return out.select("replicates", r6("observed").alias("observed"),
                      *[r6(F.col("q")[i]).alias(f"q{int(p * 1000):03d}") for i, p in enumerate(probs)])


def pairwise_mann_whitney_bh(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mann-Whitney z and two-sided normal p for every pair of groups,
    with Benjamini-Hochberg adjusted p-values.  Groups are the distinct values
    of a low-cardinality column (classes).

    The data are read once, into counts by value and class; one running sum
    over the distinct values per class serves all pairs, and one aggregate
    gives every pair's U and tie sum."""
    from quarry.functions.dist import norm_sf2
    from quarry.functions.ordered import global_cumsum

    counts = cut_lineage(df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
                         .groupBy(group, value).agg(F.count(F.lit(1)).alias("_c")))
    levels = [r[0] for r in counts.select(group).distinct().orderBy(group).collect()]
    wide = counts.groupBy(F.col(value).alias("_v")).agg(
        *[F.coalesce(F.sum(F.when(F.col(group) == g, F.col("_c"))), F.lit(0).cast("long")).alias(f"_c{i}") for i, g in enumerate(levels)])
    cum = global_cumsum(wide, ["_v"], [f"_c{i}" for i in range(len(levels))], exclusive=True, suffix="_below")
    pairs = [(i, j) for i in range(len(levels)) for j in range(i + 1, len(levels))]
    aggs = [F.sum(f"_c{i}").alias(f"n{i}") for i in range(len(levels))]
    for i, j in pairs:
        t = F.col(f"_c{i}") + F.col(f"_c{j}")
        aggs += [F.sum(F.col(f"_c{i}") * (F.col(f"_c{j}_below") + F.col(f"_c{j}") / 2)).alias(f"u{i}_{j}"),
                 F.sum((t * t * t - t).cast("double")).alias(f"t{i}_{j}")]
    one = cum.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(str(levels[i])).alias("a"), F.lit(str(levels[j])).alias("b"), F.col(f"n{i}").alias("n1"),
                              F.col(f"n{j}").alias("n2"), F.col(f"u{i}_{j}").alias("u"), F.col(f"t{i}_{j}").alias("t")) for i, j in pairs])
    each = one.select(F.explode(rows).alias("r")).select("r.*")
    n1, n2 = F.col("n1"), F.col("n2")
    n = n1 + n2
    sigma = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.col("t") / (n * (n - 1))))
    out = each.select("a", "b", r6((F.col("u") - n1 * n2 / 2.0) / sigma).alias("z")).withColumn("p", norm_sf2(F.col("z")))
    return benjamini_hochberg(out, "p").select("a", "b", "z", r6("p").alias("p"), r6("p_adj").alias("p_adj"))


def correlation_pvalues(df: DataFrame, cols: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Pearson r of every column pair with its two-sided p-value
    (t = r sqrt((n - 2) / (1 - r^2)), n - 2 degrees of freedom); cells with
    p > alpha are zeroed."""
    from quarry.functions.dist import t_sf2
    from quarry.operators.aggregate import correlation_pairs

    c = correlation_pairs(df, cols)
    t = F.col("r") * F.sqrt((F.col("n") - 2) / (1 - F.col("r") * F.col("r")))
    out = c.withColumn("p", t_sf2(t, F.col("n") - 2))
    return out.select("var_a", "var_b", "n", "r", r6("p").alias("p"),
                      F.when(F.col("p") <= alpha, F.col("r")).otherwise(F.lit(0.0)).alias("r_significant"))


def _smallest_difference_above(x_idx: DataFrame, y: DataFrame, lo: float) -> float:
    """The smallest y_j - x_i strictly above ``lo``: for each y_j the largest
    x_i < y_j - lo is the k-th smallest x, k = number of x below y_j - lo
    (merged cumulative count), fetched by an equi-join on the dense index."""
    from quarry.functions.ordered import global_cumsum
    u = x_idx.select("v", F.lit(1).alias("is_x")).unionByName(
        y.select((F.col("v") - F.lit(lo)).alias("v"), F.lit(0).alias("is_x"), F.col("v").alias("y")),
        allowMissingColumns=True)
    # x before y on ties is excluded: order (v, is_x desc) puts y first at equal values
    c = global_cumsum(u, ["v", F.col("is_x").desc()], ["is_x"], exclusive=True, suffix="_before")
    k = c.filter(F.col("is_x") == 0).select("y", F.col("is_x_before").cast("long").alias("_k")).filter(F.col("_k") >= 1)
    j = k.join(x_idx.select(F.col("_k"), F.col("v").alias("x")), "_k")
    return float(j.agg(F.min(F.col("y") - F.col("x"))).first()[0])


def median_difference_interval(df: DataFrame, group: str, value: str, a, b, z: float = 1.959964,
                               iters: int = 80) -> DataFrame:
    """Distribution-free interval for the median of all differences
    y_j - x_i (y from group ``b``, x from ``a``): the K-th smallest and
    (nm - K + 1)-th smallest differences, K from the normal approximation
    of the rank-sum distribution.

    The n x m differences are never formed: each order statistic is found
    by bisection on the value, counting pairs at or below a candidate with
    one merged sort of the distinct values with their counts, then made
    exact by looking up the smallest actual difference above the final lower
    bound."""
    from quarry.functions.ordered import running_index

    x = df.filter((F.col(group) == a) & F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    y = df.filter((F.col(group) == b) & F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    sx = x.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    sy = y.agg(F.count(F.lit(1)).alias("m"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    n, m = sx["n"], sy["m"]
    k = int(math.floor(n * m / 2.0 - z * math.sqrt(n * m * (n + m + 1) / 12.0)))
    k = max(k, 1)
    # distinct values with their counts: every pass sorts these, not the rows
    xw = cut_lineage(x.groupBy("v").agg(F.count(F.lit(1)).alias("w")))
    yw = cut_lineage(y.groupBy("v").agg(F.count(F.lit(1)).alias("w")))
    x_idx = running_index(xw.select("v"), [], ["v"], "_k")

    from quarry.functions.ordered import running_sum

    def counts_at(cands: list[float]) -> list[int]:
        # every candidate in one pass: rows are repeated per candidate inside
        # the row (explode of a literal array), counts partitioned by candidate
        arr = F.array(*[F.struct(F.lit(i).alias("cid"), F.lit(float(d)).alias("d")) for i, d in enumerate(cands)])
        zero = F.lit(0).cast("long")
        xs = xw.select(F.explode(arr).alias("c"), "v", "w").select("c.cid", "v", F.lit(1).alias("is_x"), F.col("w").alias("wx"), zero.alias("wy"))
        ys = yw.select(F.explode(arr).alias("c"), "v", "w").select("c.cid", (F.col("v") - F.col("c.d")).alias("v"), F.lit(0).alias("is_x"),
                                                                   zero.alias("wx"), F.col("w").alias("wy"))
        c = running_sum(xs.unionByName(ys), ["cid"], ["v", "is_x"], "wx", "_before", exclusive=True)
        got = {r["cid"]: int(r["c"]) for r in c.filter(F.col("is_x") == 0).groupBy("cid")
               .agg(F.sum(F.col("wy") * (F.lit(n) - F.col("_before"))).alias("c")).collect()}
        return [got.get(i, 0) for i in range(len(cands))]

    def kth_many(ranks: list[int], ways: int = 16) -> dict[int, float]:
        bounds = {r: [sy["lo"] - sx["hi"] - 1.0, sy["hi"] - sx["lo"]] for r in ranks}
        for _ in range(iters):
            live = [r for r in ranks if bounds[r][1] - bounds[r][0] > 1e-12 * max(1.0, abs(bounds[r][1]))]
            if not live:
                break
            cands, owner = [], []
            for r in live:
                lo, hi = bounds[r]
                for j in range(1, ways + 1):
                    cands.append(lo + (hi - lo) * j / (ways + 1))
                    owner.append(r)
            cnt = counts_at(cands)
            for r in live:
                lo, hi = bounds[r]
                for d, c, o in zip(cands, cnt, owner):
                    if o != r:
                        continue
                    if c >= r:
                        hi = min(hi, d)
                    else:
                        lo = max(lo, d)
                bounds[r] = [lo, hi]
        return {r: _smallest_difference_above(x_idx, yw.select("v"), bounds[r][0]) for r in ranks}

    nm = n * m
    mids = [(nm + 1) // 2] if nm % 2 == 1 else [nm // 2, nm // 2 + 1]
    got = kth_many(sorted({k, nm - k + 1, *mids}))
    lower, upper = got[k], got[nm - k + 1]
    med = got[mids[0]] if len(mids) == 1 else (got[mids[0]] + got[mids[1]]) / 2.0
    return df.sparkSession.createDataFrame([(int(n), int(m), int(k), float(med), float(lower), float(upper))],
                                           "n long, m long, k long, median_diff double, lo double, hi double")
