"""Rows-only operators: p-values, tests, EM fits, folds, graph search."""

import math

from pyspark.sql import functions as F

from quarry.functions import dist


def test_distribution_tails():
    assert abs(dist.t_two_sided(2.0, 10) - 0.0733880) < 1e-6
    assert abs(dist.norm_two_sided(1.959964) - 0.05) < 1e-6
    assert abs(dist.chi2_upper(3.841459, 1) - 0.05) < 1e-6
    assert abs(dist.f_upper(4.964603, 1, 10) - 0.05) < 1e-5


def test_mann_whitney_against_hand_count(spark):
    from quarry.operators.stats import mann_whitney
    a, b = [1.0, 2.0, 3.0, 3.0], [3.0, 4.0, 5.0]
    df = spark.createDataFrame([(0, x) for x in a] + [(1, x) for x in b], "g int, v double")
    r = mann_whitney(df, "g", "v", 0, 1).first()
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert abs(r["u1"] - u) < 1e-9 and r["n1"] == 4 and r["n2"] == 3


def test_chi_square_matches_full_grid(spark):
    from quarry.operators.stats import chi_square
    rows = [("a", "x")] * 10 + [("a", "y")] * 5 + [("b", "y")] * 7
    df = spark.createDataFrame(rows, "r string, c string")
    obs = {("a", "x"): 10, ("a", "y"): 5, ("b", "x"): 0, ("b", "y"): 7}
    n = 22
    rt = {"a": 15, "b": 7}
    ct = {"x": 10, "y": 12}
    exp = sum((obs[(i, j)] - rt[i] * ct[j] / n) ** 2 / (rt[i] * ct[j] / n) for i in rt for j in ct)
    assert abs(chi_square(df, "r", "c").first()["chi2"] - round(exp, 6)) < 1e-6


def test_latent_profiles_recover_two_groups(spark):
    from quarry.operators.models import latent_profiles
    rows = [(float(i % 3), float(i % 2)) for i in range(100)] + [(10.0 + i % 3, 10.0 + i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double")
    r = latent_profiles(df, ["a", "b"], 2, seeds=(3, 4))
    assert abs(sum(r["shares"]) - 1) < 1e-9
    assert sorted(round(s, 3) for s in r["shares"]) == [0.375, 0.625]
    assert r["entropy"] > 0.99
    from quarry.operators.models import profile_membership
    m = profile_membership(df.unionByName(spark.createDataFrame([(None, 1.0)], "a double, b double")), ["a", "b"], r).collect()
    low = {x.profile for x in m if x.a is not None and x.a < 5}
    assert len(low) == 1 and {x.profile for x in m if x.a is not None and x.a > 5} == {0, 1} - low
    assert [x.profile for x in m if x.a is None] == [None]
    assert all(abs(sum(x.posterior) - 1) < 1e-9 for x in m if x.a is not None)


def test_stratified_folds_cover_and_balance(spark):
    from quarry.operators.evaluate import stratified_folds
    df = spark.range(0, 103).select("id", (F.col("id") % 3).alias("s"))
    f = stratified_folds(df, "s", F.col("id").cast("string"), 5, tie=["id"])
    assert f.count() == 103 and f.select("id").distinct().count() == 103
    sizes = {(r["s"], r["fold"]): r["count"] for r in f.groupBy("s", "fold").count().collect()}
    for s in range(3):
        vals = [sizes.get((s, k), 0) for k in range(1, 6)]
        assert max(vals) - min(vals) <= 1


def test_hop_distance_small_graph(spark):
    from quarry.operators.graph import hop_distance
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (1, 5), (5, 4), (6, 7)], "src long, dst long")
    visited, info = hop_distance(e, 1, 10, target=4)
    d = {r["node"]: r["dist"] for r in visited.collect()}
    assert d == {1: 0, 2: 1, 5: 1, 3: 2, 4: 2}
    assert info["found_at"] == 2 and info["hits"] == 1


def test_random_intercept_icc_bounds(spark):
    from quarry.operators.models import random_intercept
    rows = [(g, float(x), float(3 + 2 * x + g * 1.5 + ((x * 7 + g) % 5) * 0.1)) for g in range(8) for x in range(10)]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    r = random_intercept(df, "g", "y", "x").first()
    assert abs(r["slope"] - 2.0) < 0.05 and 0.9 < r["icc"] <= 1.0


def test_merge_phrases_greedy(spark):
    from quarry.operators.text import merge_at_positions, phrase_positions
    rows = [(1, ["a", "b", "c", "b", "c", "d"]), (2, ["x", "a"]), (3, []), (4, ["a", "a", "a", "a", "a"]), (5, ["a", "b"])]
    df = spark.createDataFrame(rows, "id int, t array<string>")
    phrases = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("a", "a")], "a string, b string")
    taken = phrase_positions(df, "id", F.col("t"), phrases)
    out = df.join(taken, "id", "left").select("id", merge_at_positions(F.col("t"), F.col("cand")).alias("m")).collect()
    assert {r.id: r.m for r in out} == {1: ["a_b", "c", "b_c", "d"], 2: ["x", "a"], 3: [], 4: ["a_a", "a_a", "a"], 5: ["a_b"]}


def test_bootstrap_is_reproducible(spark):
    from quarry.operators.stats import bootstrap_effect
    df = spark.range(0, 200).select((F.col("id") % 2).alias("g"), (F.col("id") % 17).cast("double").alias("pre"),
                                    (F.col("id") * 7 % 19 + F.col("id") % 2 * 4).cast("double").alias("post"))
    a = bootstrap_effect(df, "g", "pre", "post", 1, 0, replicates=60, per_arm=40, seed=1).first()
    b = bootstrap_effect(df, "g", "pre", "post", 1, 0, replicates=60, per_arm=40, seed=1).first()
    assert a == b and a["replicates"] == 60 and a["q025"] <= a["observed"] <= a["q975"]


def test_morris_g_by_hand(spark):
    from quarry.operators.stats import morris_g
    rows = [(1, 1.0, 4.0), (1, 2.0, 6.0), (1, 3.0, 5.0), (0, 2.0, 3.0), (0, 4.0, 4.0), (0, 3.0, 5.0), (0, 5.0, None)]
    r = morris_g(spark.createDataFrame(rows, "g int, pre double, post double"), "g", "pre", "post", 1, 0).first()
    # four samples of three, each of variance 1: s = 1; change 3 in one arm, 1 in the other; c = 1 - 3 / (4 * 8 - 1)
    assert (r.nt, r.nc, r.sd) == (3, 3, 1.0)
    assert abs(r.cp - (1 - 3 / 31)) < 1e-6 and abs(r.g - 2 * (1 - 3 / 31)) < 1e-6 and abs(r.t - 2 / (2 / 3) ** 0.5) < 1e-6


def test_antibiotic_doses_by_hand(spark):
    from quarry.operators.recode import gentamicin_class, penicillin_class
    od = "Once per day/once daily(OD)"
    rows = [(7, 3.0, 18.0, od, "Correct"), (7, 3.0, 27.0, od, "Correct"), (7, 3.0, 17.9, od, "Under"), (8, 3.0, 27.1, od, "Over"),
            (6, 2.0, 8.0, od, "Correct"), (6, 2.0, 12.0, od, "Correct"), (0, 2.0, 7.9, od, "Under"), (0, 2.0, 12.1, od, "Over"),
            (3, 1.0, 2.4, od, "Correct"), (3, 1.0, 3.6, od, "Correct"), (3, 1.0, 2.3, od, "Under"), (3, 1.0, 3.0, "STAT", "Over"),
            (3, 1.0, 2.0, "STAT", "Over"), (None, 1.0, 2.0, od, None)]
    df = spark.createDataFrame(rows, "age int, w double, dose double, freq string, want string")
    got = df.withColumn("got", gentamicin_class(*[F.col(c) for c in ("age", "w", "dose", "freq")])).collect()
    assert [r.got for r in got] == [r.want for r in got]
    bd, qid, tid, one = "BD/twice a day/12hrly", "QID/4 times a day/6hrly", "TID/TDS/three times a day/8hrly", "OD/once a day/24hrly"
    rows = [(7, 40000.0, bd, "Correct"), (7, 60000.0, bd, "Correct"), (7, 39999.0, bd, "Under"), (7, 60001.0, bd, "Over"),
            (7, 50000.0, one, "Under"), (7, 50000.0, "STAT", "Under"), (7, 50000.0, tid, "Over"), (7, 30000.0, qid, "Over"),
            (8, 50000.0, qid, "Correct"), (8, 50000.0, bd, "Under"), (8, 39000.0, qid, "Under"), (8, 61000.0, bd, "Over"), (None, 1.0, bd, None)]
    df = spark.createDataFrame(rows, "age int, dose double, freq string, want string")
    got = df.withColumn("got", penicillin_class(F.col("age"), F.lit(1.0), F.col("dose"), F.col("freq"))).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_correlation_pvalue_known_case(spark):
    from quarry.operators.stats import correlation_pvalues
    # x and a noisy copy; compare with the closed-form t-test p-value
    rows = [(float(i), float(i) + (7.0 if i % 2 else -7.0)) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double")
    r = correlation_pvalues(df, ["a", "b"]).first()
    t = r["r"] * math.sqrt(18 / (1 - r["r"] ** 2))
    assert abs(r["p"] - dist.t_two_sided(t, 18)) < 1e-6
    assert r["r_significant"] == (r["r"] if r["p"] <= 0.05 else 0.0)


def test_median_difference_interval_matches_brute_force(spark):
    from quarry.operators.stats import median_difference_interval
    xs = [1.0, 2.5, 2.5, 4.0, 7.0, 3.0, 9.5, 0.5]
    ys = [3.0, 4.5, 6.0, 2.0, 8.0, 8.0, 5.5]
    df = spark.createDataFrame([(0, v) for v in xs] + [(1, v) for v in ys], "g int, v double")
    r = median_difference_interval(df, "g", "v", 0, 1).first()
    diffs = sorted(y - x for x in xs for y in ys)
    k = r["k"]
    assert r["lo"] == diffs[k - 1] and r["hi"] == diffs[len(diffs) - k]
    nm = len(diffs)
    med = diffs[nm // 2] if nm % 2 else (diffs[nm // 2 - 1] + diffs[nm // 2]) / 2
    assert r["median_diff"] == med


def test_vif_equals_regression_on_the_others(spark):
    import numpy as np
    from quarry.operators.stats import vif
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3))
    x[:, 2] += x[:, 0] - 0.5 * x[:, 1]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    got = {r.feature: r.vif for r in vif(df, ["a", "b", "c"]).collect()}
    for i, f in enumerate("abc"):
        others = np.column_stack([np.ones(200), np.delete(x, i, axis=1)])
        resid = x[:, i] - others @ np.linalg.lstsq(others, x[:, i], rcond=None)[0]
        assert abs(got[f] - 1 / (resid.var() / x[:, i].var())) < 1e-4


def test_goldfeld_quandt_fits_each_half(spark):
    import numpy as np
    from quarry.operators.models import breusch_pagan
    rng = np.random.default_rng(4)
    x = np.sort(rng.uniform(1, 5, 100))
    y = 2 * x + rng.normal(size=100) * x
    got = breusch_pagan(spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double"), "y", ["x"]).first()

    def s2(a, b):
        m = np.column_stack([np.ones(len(a)), a])
        r = b - m @ np.linalg.lstsq(m, b, rcond=None)[0]
        return (r @ r) / (len(a) - 2)

    assert abs(got.gq_f - s2(x[50:], y[50:]) / s2(x[:50], y[:50])) < 1e-3


def test_hop_distance_counts_every_edge_into_the_target(spark):
    from quarry.operators.graph import hop_distance
    e = spark.createDataFrame([(1, 2), (1, 3), (2, 9), (3, 9), (9, 1), (2, 3)], "src long, dst long")
    visited, info = hop_distance(e, 1, 10, target=9)
    assert info == {"rounds": 2, "hits": 2, "found_at": 2} and visited.count() == 4
    assert hop_distance(e, 77, 10)[0].count() == 1


def test_only_rows_at_the_ends_of_folds_are_ordered(spark, monkeypatch):
    from pyspark.sql import Window

    from quarry.functions import ordered
    from quarry.operators.evaluate import stratified_folds
    df = spark.range(0, 3000).selectExpr("id", "id % 2 AS stratum", "id % 7 AS tie").union(spark.sql("SELECT 9000L, CAST(NULL AS LONG), 1L"))
    df = df.union(df.where("id < 40"))                                             # rows that come twice
    seen, real = [], ordered.running_index
    monkeypatch.setattr(ordered, "running_index", lambda d, *a, **k: seen.append(d.count()) or real(d, *a, **k))
    got = stratified_folds(df, "stratum", F.col("id").cast("string"), 5, tie=["tie"])
    w = Window.partitionBy("stratum").orderBy(F.md5(F.col("id").cast("string")), "tie")
    want = df.where("stratum IS NOT NULL").withColumn("fold", F.ntile(5).over(w))
    assert got.columns == ["stratum", "id", "tie", "fold"]
    assert sorted(map(tuple, got.select("id", "fold").collect())) == sorted(map(tuple, want.select("id", "fold").collect()))
    assert sum(seen) < 100
    same = spark.range(0, 50).selectExpr("0 AS stratum", "'a' AS k")                # one key: all rows are ordered
    assert sorted(r["count"] for r in stratified_folds(same, "stratum", F.col("k"), 4).groupBy("fold").count().collect()) == [12, 12, 13, 13]
