"""Learning-app queries: attempt sequences, sessions, completion, feedback,
spacing, gains, funnels, transitions and calendar histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.columns import minutes_between, r6
from quarry.operators import aggregate as agg
from quarry.operators import cohort, reshape, sequences, windows
from quarry.plans.registry import register
from quarry.plans.views import Views
from quarry.plans.views_sql import with_views

ORDER = ["ts", "event_id"]
COMPLETE_AT = 3          # distinct questions that make a session complete
FINISHED_PLAYS = 8       # completed plays that count as "finished"

_ROLLUP_SQL = """
SELECT user_id, session, round(sum(time_s), 6) AS total_time,
  CAST(sum(CASE WHEN feedback = 1 THEN 1 ELSE 0 END) AS BIGINT) AS help_count,
  count(*) AS n_tries, count(DISTINCT question) AS n_questions,
  CAST(sum(CASE WHEN try_no = 1 THEN correct ELSE 0 END) AS BIGINT) AS score
FROM attempts GROUP BY user_id, session"""

_FLAGS_SQL = f"""
, s AS (SELECT user_id, session, count(DISTINCT question) >= {COMPLETE_AT} AS session_complete FROM attempts GROUP BY 1, 2),
p AS (SELECT user_id, CAST(sum(CAST(session_complete AS INTEGER)) AS BIGINT) AS complete_plays FROM s GROUP BY 1),
flags AS (SELECT s.*, p.complete_plays FROM s LEFT JOIN p USING (user_id))"""


def _tries(spark, root):
    return Views(spark, root).tries


def _att(spark, root):
    return Views(spark, root).attempts


@register("f1_opportunity", with_views("attempts") + """
SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS opportunity
FROM attempts""")
def f1_opportunity(spark, root):
    return windows.running_index(_att(spark, root).select("user_id", "ts", "event_id"), ["user_id"], ORDER, "opportunity") \
        .select("user_id", "event_id", "opportunity")


@register("f2_running_score", with_views("attempts") + """
SELECT user_id, event_id, CAST(sum(correct) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_correct FROM attempts""")
def f2_running_score(spark, root):
    a = _att(spark, root).select("user_id", "ts", "event_id", "correct")
    return windows.running_total(a, ["user_id"], ORDER, "correct", "cum_correct") \
        .select("user_id", "event_id", "cum_correct")


@register("f3_prior_counts", with_views("attempts") + """
SELECT user_id, event_id, question,
  CAST(coalesce(sum(correct) OVER w, 0) AS BIGINT) AS prior_success,
  CAST(coalesce(sum(1 - correct) OVER w, 0) AS BIGINT) AS prior_failure
FROM attempts WINDOW w AS (PARTITION BY user_id, question ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def f3_prior_counts(spark, root):
    from quarry.functions import ordered
    a = _att(spark, root).select("user_id", "question", "ts", "event_id", "correct", (1 - F.col("correct")).alias("failure"))
    a = ordered.running_sums(a, ["user_id", "question"], ORDER, {"correct": "prior_success", "failure": "prior_failure"}, exclusive=True)
    return a.select("user_id", "event_id", "question", "prior_success", "prior_failure")


@register("f4_lag_diff", with_views("attempts") + """
SELECT user_id, event_id, lag(time_s) OVER w AS prev_time, round(time_s - lag(time_s) OVER w, 6) AS time_diff
FROM attempts WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def f4_lag_diff(spark, root):
    a = windows.lag_diff(_att(spark, root).select("user_id", "ts", "event_id", "time_s"), ["user_id"], ORDER, "time_s", "prev_time", "time_diff")
    return a.select("user_id", "event_id", "prev_time", r6("time_diff").alias("time_diff"))


@register("e28_session_rollup", with_views("attempts") + _ROLLUP_SQL)
def e28_session_rollup(spark, root):
    return sequences.session_rollup(_tries(spark, root))


@register("f5_session_gaps", with_views("attempts") + f""", s AS ({_ROLLUP_SQL}),
g AS (SELECT user_id, session, date_diff('microsecond', lag(session) OVER w, session) / 60000000.0
        + lag(total_time) OVER w / 60.0 AS gap FROM s WINDOW w AS (PARTITION BY user_id ORDER BY session))
SELECT user_id, session, round(gap, 6) AS gap_min,
  CASE WHEN gap >= 1440 THEN 'Distributed' WHEN gap >= 60 THEN 'Spaced' WHEN gap IS NOT NULL THEN 'Massed' ELSE 'None' END AS gap_type,
  round(ln(coalesce(gap, 0.01)), 6) AS gap_log FROM g""")
def f5_session_gaps(spark, root):
    s = sequences.session_rollup(_tries(spark, root))
    return windows.session_gaps(s, ["user_id"], "session", "total_time", "session") \
        .select("user_id", "session", "gap_min", "gap_type", "gap_log")


@register("f6_normalised_gain", with_views("attempts") + f""", s AS ({_ROLLUP_SQL}),
g AS (SELECT user_id, session, score, lag(score) OVER (PARTITION BY user_id ORDER BY session) AS prev_score FROM s)
SELECT user_id, session, score, prev_score,
  round(CASE WHEN prev_score IS NULL OR score IS NULL THEN NULL
    WHEN prev_score = score AND (prev_score = 0 OR prev_score = 5) THEN 0.0
    WHEN score >= prev_score THEN (score - prev_score) / (5 - prev_score)
    ELSE (score - prev_score) / prev_score END, 6) AS gain FROM g""")
def f6_normalised_gain(spark, root):
    s = sequences.session_rollup(_tries(spark, root))
    s = windows.lag_diff(s, ["user_id"], ["session"], "score", "prev_score", "_d")
    return s.select("user_id", "session", "score", "prev_score",
                    r6(windows.normalised_gain("prev_score", "score", 5)).alias("gain"))


@register("f7_cumulative_share", with_views("attempts") + """
, c AS (SELECT question, count(*) AS n FROM attempts GROUP BY 1)
SELECT question, n, CAST(sum(n) OVER (ORDER BY question ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_n,
  round(sum(n) OVER (ORDER BY question ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0 / sum(n) OVER (), 6) AS cum_pct
FROM c""")
def f7_cumulative_share(spark, root):
    c = agg.count_by(_att(spark, root), ["question"])
    return windows.cumulative_share(c, ["question"], "n")


@register("f18_change_share", with_views("attempts") + """
, c AS (SELECT question, count(*) AS n FROM attempts GROUP BY 1),
d AS (SELECT question, n, round(sum(n) OVER (ORDER BY question ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0 / sum(n) OVER (), 6) AS cum_pct FROM c)
SELECT question, cum_pct, round(cum_pct - lag(cum_pct) OVER (ORDER BY question), 6) AS change_pct FROM d""")
def f18_change_share(spark, root):
    from pyspark.sql import Window
    c = windows.cumulative_share(agg.count_by(_att(spark, root), ["question"]), ["question"], "n")
    # the aggregated table has one row per category: an unpartitioned window is bounded
    w = Window.orderBy("question")
    return c.select("question", "cum_pct", r6(F.col("cum_pct") - F.lag("cum_pct").over(w)).alias("change_pct"))


@register("e29_completion", with_views("attempts") + _FLAGS_SQL + " SELECT * FROM flags")
def e29_completion(spark, root):
    return sequences.completion_flags(_att(spark, root), COMPLETE_AT)


@register("e44_adoption_funnel", with_views("attempts") + _FLAGS_SQL + """
SELECT count(*) AS started, count(CASE WHEN p >= 1 THEN 1 END) AS finished_once,
  count(CASE WHEN p >= 2 THEN 1 END) AS finished_repeatedly
FROM (SELECT user_id, max(complete_plays) AS p FROM flags GROUP BY 1)""")
def e44_adoption_funnel(spark, root):
    return sequences.adoption_funnel(sequences.completion_flags(_att(spark, root), COMPLETE_AT))


@register("e43_dropout_depth", with_views("attempts") + _FLAGS_SQL + f"""
, fin AS (SELECT DISTINCT user_id FROM flags WHERE complete_plays >= {FINISHED_PLAYS})
SELECT user_id, count(DISTINCT question) AS questions_reached, round(sum(time_s), 6) AS time_spent,
  round(sum(CASE WHEN try_no = 1 THEN correct ELSE 0 END) / count(CASE WHEN try_no = 1 THEN 1 END), 6) AS first_try_share
FROM attempts a WHERE NOT EXISTS (SELECT 1 FROM fin WHERE fin.user_id = a.user_id) GROUP BY user_id""")
def e43_dropout_depth(spark, root):
    a = _tries(spark, root)
    flags = sequences.completion_flags(a, COMPLETE_AT)
    fin = flags.filter(F.col("complete_plays") >= FINISHED_PLAYS).select("user_id").distinct()
    return sequences.dropout_depth(a, fin)


@register("e30_two_level_mean", with_views("attempts") + """
SELECT user_id, count(*) AS n_sessions, round(avg(m), 6) AS mean_session_time
FROM (SELECT user_id, session, avg(time_s) AS m FROM attempts GROUP BY 1, 2) GROUP BY user_id""")
def e30_two_level_mean(spark, root):
    s = _att(spark, root).groupBy("user_id", "session").agg(F.avg("time_s").alias("m"))
    return s.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_sessions"), r6(F.avg("m")).alias("mean_session_time"))


@register("e24_user_rollup", with_views("attempts") + """
SELECT user_id, min(session) AS first_session,
  array_to_string(list_sort(list_distinct(list(CAST(feedback AS VARCHAR)))), '') AS feedback_kinds,
  bool_or(feedback = 1) AS any_help, count(*) AS n_attempts
FROM attempts GROUP BY user_id""")
def e24_user_rollup(spark, root):
    a = _att(spark, root)
    first = a.groupBy("user_id").agg(F.min("session").alias("first_session"), F.count(F.lit(1)).alias("n_attempts"),
                                     F.bool_or(F.col("feedback") == 1).alias("any_help"),
                                     F.concat_ws("", F.sort_array(F.collect_set(F.col("feedback").cast("string"))))
                                     .alias("feedback_kinds"))
    return first


@register("e22_distinct_concat", with_views("attempts") + """
SELECT user_id, array_to_string(list_sort(list_distinct(list(question))), ',') AS questions FROM attempts GROUP BY 1""")
def e22_distinct_concat(spark, root):
    return agg.distinct_concat(_att(spark, root), ["user_id"], "question", "questions", ",")


@register("e23_any_flag", with_views("attempts") + """
SELECT user_id, session, bool_or(correct = 1 AND try_no = 1) AS any_first_try_right FROM attempts GROUP BY 1, 2""")
def e23_any_flag(spark, root):
    return agg.any_flag(_tries(spark, root), ["user_id", "session"],
                        (F.col("correct") == 1) & (F.col("try_no") == 1), "any_first_try_right")


@register("e32_feedback_success", with_views("attempts") + """
SELECT a.question, a.feedback, count(*) AS n, count(b.correct) AS n_next,
  CAST(coalesce(sum(b.correct), 0) AS BIGINT) AS n_success, round(sum(b.correct) / count(b.correct), 6) AS success_rate
FROM attempts a LEFT JOIN attempts b ON a.user_id = b.user_id AND a.session = b.session AND a.question = b.question
  AND b.try_no = a.try_no + 1
GROUP BY 1, 2""")
def e32_feedback_success(spark, root):
    a = sequences.next_try_success(_tries(spark, root), ["user_id", "session", "question"])
    return a.groupBy("question", "feedback").agg(
        F.count(F.lit(1)).alias("n"), F.count("next_correct").alias("n_next"),
        F.coalesce(F.sum("next_correct"), F.lit(0)).alias("n_success"),
        r6(F.sum("next_correct") / F.count("next_correct")).alias("success_rate"))


@register("e33_help_ratio_by_arm", with_views("attempts", "profiles") + f""", s AS ({_ROLLUP_SQL}),
h AS (SELECT p.arm, s.help_count / s.n_tries AS ratio FROM s JOIN profiles p ON s.user_id = p.user_id)
SELECT arm, count(ratio) AS n, round(avg(ratio), 6) AS mean, round(stddev_samp(ratio), 6) AS sd,
  round(stddev_samp(ratio) / sqrt(count(ratio)), 6) AS se,
  round(avg(ratio) - 1.96 * stddev_samp(ratio) / sqrt(count(ratio)), 6) AS lo,
  round(avg(ratio) + 1.96 * stddev_samp(ratio) / sqrt(count(ratio)), 6) AS hi
FROM h GROUP BY arm""")
def e33_help_ratio_by_arm(spark, root):
    v = Views(spark, root)
    s = sequences.session_rollup(v.tries).withColumn("ratio", F.col("help_count") / F.col("n_tries"))
    h = s.join(v.profiles.select("user_id", "arm"), "user_id")
    return agg.describe_by(h, ["arm"], "ratio")


@register("e35_hour_weekday_histogram", with_views("attempts") + """
SELECT CAST(hour(ts) AS INTEGER) AS hour, dayname(ts) AS weekday, count(*) AS n FROM attempts GROUP BY 1, 2""")
def e35_hour_weekday_histogram(spark, root):
    a = _att(spark, root)
    return a.groupBy(F.hour("ts").alias("hour"), F.date_format("ts", "EEEE").alias("weekday")) \
        .agg(F.count(F.lit(1)).alias("n"))


@register("e35_first_seen_per_date", with_views("attempts") + """
SELECT first_date, count(*) AS new_users FROM (SELECT user_id, min(CAST(ts AS DATE)) AS first_date FROM attempts GROUP BY 1) GROUP BY 1""")
def e35_first_seen_per_date(spark, root):
    f = _att(spark, root).groupBy("user_id").agg(F.min(F.to_date("ts")).alias("first_date"))
    return f.groupBy("first_date").agg(F.count(F.lit(1)).alias("new_users"))


@register("e36_allocation_ratio", with_views("attempts", "profiles") + """
, j AS (SELECT hour(a.ts) AS hour, p.arm FROM attempts a JOIN profiles p ON a.user_id = p.user_id),
c AS (SELECT CAST(hour AS INTEGER) AS hour, count(CASE WHEN arm = 0 THEN 1 END) AS n_arm0, count(CASE WHEN arm = 1 THEN 1 END) AS n_arm1 FROM j GROUP BY 1)
SELECT hour, n_arm0, n_arm1, round(coalesce(n_arm1 / nullif(n_arm0, 0), 0), 6) AS ratio FROM c""")
def e36_allocation_ratio(spark, root):
    v = Views(spark, root)
    j = v.attempts.join(v.profiles.select("user_id", "arm"), "user_id").select(F.hour("ts").alias("hour"), "arm")
    w = j.groupBy("hour").pivot("arm", [0, 1]).agg(F.count(F.lit(1)))
    w = w.select("hour", F.coalesce(F.col("0"), F.lit(0)).alias("n_arm0"), F.coalesce(F.col("1"), F.lit(0)).alias("n_arm1"))
    return w.withColumn("ratio", r6(F.coalesce(F.col("n_arm1") / F.when(F.col("n_arm0") != 0, F.col("n_arm0")), F.lit(0.0))))


@register("e37_transitions", with_views("attempts") + """
, p AS (SELECT question AS from_state, lead(question) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_state FROM attempts),
c AS (SELECT from_state, next_state, count(*) AS n FROM p WHERE next_state IS NOT NULL GROUP BY 1, 2)
SELECT from_state, next_state, n, round(n / sum(n) OVER (PARTITION BY from_state), 6) AS rate FROM c""")
def e37_transitions(spark, root):
    return windows.step_transitions(_att(spark, root), ["user_id"], ORDER, "question")


@register("e45_pre_post_scores", with_views("attempts") + """
, s AS (SELECT user_id, session, sum(correct) * 100.0 / count(*) AS pct FROM attempts GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY session) AS cycle FROM s)
SELECT user_id, round(avg(CASE WHEN cycle = 1 THEN pct END), 6) AS pre, round(avg(CASE WHEN cycle = 2 THEN pct END), 6) AS post
FROM r GROUP BY user_id""")
def e45_pre_post_scores(spark, root):
    s = _att(spark, root).groupBy("user_id", "session").agg((F.sum("correct") * 100.0 / F.count(F.lit(1))).alias("pct"))
    s = windows.running_index(s, ["user_id"], ["session"], "cycle")
    w = reshape.long_to_wide(s, ["user_id"], "cycle", "pct", [1, 2], "avg", prefix="c")
    return w.select("user_id", r6("c1").alias("pre"), r6("c2").alias("post"))


@register("f11_latest_value", with_views("attempts") + """
SELECT user_id, time_s FROM (SELECT user_id, time_s, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk
  FROM attempts) WHERE rk = 1""")
def f11_latest_value(spark, root):
    return windows.latest_value(_att(spark, root), ["user_id"], "time_s", ORDER)


@register("e6_first_attempt_per_user", with_views("attempts") + """
SELECT user_id, event_id, question, correct FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rk
  FROM attempts) WHERE rk = 1""")
def e6_first_attempt_per_user(spark, root):
    return agg.first_per_group(_att(spark, root), ["user_id"], ORDER, ["event_id", "question", "correct"])


@register("f12_repair_repeats", with_views("attempts") + """
SELECT user_id, event_id, CAST(row_number() OVER w AS INTEGER) AS repeat_no,
  session + coalesce(sum(CAST(ceil(time_s) AS BIGINT) + 3) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * INTERVAL 1 SECOND AS fixed_start
FROM attempts WINDOW w AS (PARTITION BY user_id, session ORDER BY ts, event_id)""")
def f12_repair_repeats(spark, root):
    r = windows.repair_repeats(_att(spark, root), ["user_id"], ORDER, "session", "time_s")
    return r.select("user_id", "event_id", "repeat_no", "fixed_start")


def _seq_text(c):
    return F.array_join(F.transform(F.col(c), lambda x: F.concat(x["question"], F.lit(":"), x["correct"].cast("string"))), ",")


@register("f13_sliding_sequences", with_views("attempts") + """
SELECT user_id, event_id, array_to_string(s, ',') AS seq_text FROM (
  SELECT user_id, event_id, list(question || ':' || CAST(correct AS VARCHAR)) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS s FROM attempts) WHERE len(s) = 3""")
def f13_sliding_sequences(spark, root):
    s = windows.sliding_sequences(_att(spark, root), ["user_id"], ORDER, ["question", "correct"], 3)
    return s.select("user_id", "event_id", _seq_text("seq").alias("seq_text"))


LOOKBACKS = range(3, 11)


@register("f14_lagged_views", with_views("attempts") + " SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT user_id, event_id, {n} AS lookback, array_to_string(s, ',') AS seq_text FROM (
  SELECT user_id, event_id, list(question || ':' || CAST(correct AS VARCHAR)) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS s FROM attempts) WHERE len(s) = {n}""" for n in LOOKBACKS) + ")")
def f14_lagged_views(spark, root):
    s = windows.sequences_up_to(_att(spark, root), ["user_id"], ORDER, ["question", "correct"], list(LOOKBACKS))
    return s.select("user_id", "event_id", F.col("length").alias("lookback"), _seq_text("seq").alias("seq_text"))


@register("f20_next_step_pairs", with_views("attempts") + """
SELECT user_id, event_id, array_to_string(s[1:2], ',') AS features, CAST(split_part(s[3], ':', 2) AS INTEGER) AS label FROM (
  SELECT user_id, event_id, list(question || ':' || CAST(correct AS VARCHAR)) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS s FROM attempts) WHERE len(s) = 3""")
def f20_next_step_pairs(spark, root):
    s = windows.sliding_sequences(_att(spark, root), ["user_id"], ORDER, ["question", "correct"], 3)
    feats = F.slice("seq", 1, 2)
    txt = F.array_join(F.transform(feats, lambda x: F.concat(x["question"], F.lit(":"), x["correct"].cast("string"))), ",")
    return s.select("user_id", "event_id", txt.alias("features"), F.element_at("seq", -1)["correct"].alias("label"))


@register("f17_capped_gaps_wide", with_views("attempts") + """
, g AS (SELECT user_id, question, least(CAST(ceil(date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) / 60000000.0) AS BIGINT), 10080) AS gap FROM attempts)
SELECT user_id, round(avg(CASE WHEN question = 'click' THEN gap END), 6) AS click, round(avg(CASE WHEN question = 'error' THEN gap END), 6) AS error,
  round(avg(CASE WHEN question = 'purchase' THEN gap END), 6) AS purchase, round(avg(CASE WHEN question = 'signup' THEN gap END), 6) AS signup,
  round(avg(CASE WHEN question = 'view' THEN gap END), 6) AS view FROM g GROUP BY user_id""")
def f17_capped_gaps_wide(spark, root):
    from quarry.functions import ordered
    a = ordered.lag(_att(spark, root).select("user_id", "question", "ts", "event_id"), ["user_id"], ORDER, ["ts"])
    g = a.select("user_id", "question",
                 F.least(F.ceil(minutes_between(F.col("ts_prev"), F.col("ts"))), F.lit(10080)).alias("gap"))
    levels = ["click", "error", "purchase", "signup", "view"]
    wide = reshape.long_to_wide(g, ["user_id"], "question", "gap", levels, "avg")
    return wide.select("user_id", *[r6(c).alias(c) for c in levels])


@register("f19_learning_curve", with_views("attempts", "profiles") + """
, o AS (SELECT a.correct, p.arm, row_number() OVER (PARTITION BY a.user_id, a.question ORDER BY a.ts, a.event_id) AS opportunity
  FROM attempts a JOIN profiles p ON a.user_id = p.user_id)
SELECT CAST(opportunity AS INTEGER) AS opportunity, arm, count(*) AS n, round(avg(correct), 6) AS mean_correct FROM o GROUP BY 1, 2""")
def f19_learning_curve(spark, root):
    v = Views(spark, root)
    a = windows.running_index(v.attempts.select("user_id", "question", "ts", "event_id", "correct"), ["user_id", "question"], ORDER, "opportunity")
    j = a.join(v.profiles.select("user_id", "arm"), "user_id")
    return j.groupBy("opportunity", "arm").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("correct")).alias("mean_correct"))


@register("c5_c6_semi_anti", with_views("attempts", "profiles") + """
SELECT 'in_arm1' AS part, count(*) AS n FROM attempts a WHERE EXISTS (SELECT 1 FROM profiles p WHERE p.user_id = a.user_id AND p.arm = 1)
UNION ALL
SELECT 'not_arm1', count(*) FROM attempts a WHERE NOT EXISTS (SELECT 1 FROM profiles p WHERE p.user_id = a.user_id AND p.arm = 1)""")
def c5_c6_semi_anti(spark, root):
    v = Views(spark, root)
    arm1 = v.profiles.filter(F.col("arm") == 1)
    a = cohort.semi_filter(v.attempts, arm1, ["user_id"]).agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("in_arm1"))
    b = cohort.anti_filter(v.attempts, arm1, ["user_id"]).agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("not_arm1"))
    return a.unionByName(b).select("part", "n")


@register("c8_crossover_exclusion", with_views("attempts", "profiles") + """
, j AS (SELECT a.*, p.arm FROM attempts a JOIN profiles p ON a.user_id = p.user_id),
bad AS (SELECT user_id FROM j WHERE arm = 0 INTERSECT SELECT user_id FROM j WHERE feedback = 1 AND correct = 0 AND try_no > 2)
SELECT user_id, count(*) AS n FROM j WHERE user_id NOT IN (SELECT user_id FROM bad) GROUP BY user_id""")
def c8_crossover_exclusion(spark, root):
    v = Views(spark, root)
    j = v.tries.join(v.profiles.select("user_id", "arm"), "user_id")
    kept = cohort.crossover_exclusion(j, "user_id", F.col("arm") == 0,
                                      (F.col("feedback") == 1) & (F.col("correct") == 0) & (F.col("try_no") > 2))
    return agg.count_by(kept, ["user_id"])


@register("c9_min_history", with_views("attempts") + """
SELECT user_id, count(*) AS n FROM attempts GROUP BY user_id HAVING count(*) >= 70""")
def c9_min_history(spark, root):
    return agg.count_by(cohort.min_history(_att(spark, root), ["user_id"], 70), ["user_id"])


@register("d13_complete_profiles", with_views("attempts", "profiles") + """
, reg AS (SELECT user_id, arm FROM profiles WHERE cadre IS NOT NULL),
seen AS (SELECT user_id, min(session) AS first_session, bool_or(feedback = 1) AS got_help FROM attempts a
  WHERE NOT EXISTS (SELECT 1 FROM reg WHERE reg.user_id = a.user_id) GROUP BY 1)
SELECT user_id, arm, NULL::TIMESTAMP AS first_session, false AS inferred FROM reg
UNION ALL SELECT user_id, CASE WHEN got_help THEN 1 ELSE 0 END, first_session, true FROM seen""")
def d13_complete_profiles(spark, root):
    from quarry.operators import joins
    v = Views(spark, root)
    reg = v.profiles.filter(F.col("cadre").isNotNull()).select("user_id", "arm")
    return joins.complete_dimension(reg, v.attempts, "user_id", "session", F.col("feedback") == 1)


@register("d14_backfill_date", with_views("attempts", "profiles") + """
, reg AS (SELECT user_id, CASE WHEN user_id % 3 = 0 THEN NULL ELSE TIMESTAMP '2023-12-01 00:00:00' END AS registered FROM profiles),
f AS (SELECT user_id, min(session) AS first_session FROM attempts GROUP BY 1)
SELECT r.user_id, coalesce(r.registered, f.first_session) AS registered FROM reg r LEFT JOIN f USING (user_id)""")
def d14_backfill_date(spark, root):
    from quarry.operators import joins
    v = Views(spark, root)
    reg = v.profiles.select("user_id", F.when(F.col("user_id") % 3 == 0, F.lit(None))
                            .otherwise(F.to_timestamp_ntz(F.lit("2023-12-01 00:00:00"))).alias("registered"))
    return joins.backfill_from_facts(reg, v.attempts, "user_id", "registered", "session")


@register("o23_weighted_user_split", with_views("attempts") + """
, w AS (SELECT user_id, count(*) AS weight FROM attempts GROUP BY 1),
k AS (SELECT user_id, weight, -ln((CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) + 1.0) / 4294967297.0) / weight AS key FROM w)
SELECT user_id, weight, round(key, 9) AS key FROM (SELECT *, row_number() OVER (ORDER BY key, user_id) AS i, count(*) OVER () AS n FROM k)
WHERE i <= floor(0.8 * n)""")
def o23_weighted_user_split(spark, root):
    w = _att(spark, root).groupBy("user_id").agg(F.count(F.lit(1)).alias("weight"))
    k = w.withColumn("key", sequences.weighted_sample_key(F.col("user_id"), F.col("weight")))
    return sequences.weighted_share(k, ["key", "user_id"], 0.8).select("user_id", "weight", F.round("key", 9).alias("key"))


# ----------------------------------------------------------------- dates

@register("k1_multi_format_parse", with_views("attempts") + """
, t AS (SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
   WHEN event_id % 3 = 1 THEN strftime(ts, '%d/%m/%Y %H:%M') ELSE 'not a date' END AS raw FROM attempts)
SELECT event_id, raw, coalesce(try_strptime(raw, '%Y-%m-%d %H:%M:%S'), try_strptime(raw, '%d/%m/%Y %H:%M')) AS parsed FROM t""")
def k1_multi_format_parse(spark, root):
    from quarry.operators import dates
    a = _att(spark, root)
    raw = (F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
           .when(F.col("event_id") % 3 == 1, F.date_format("ts", "dd/MM/yyyy HH:mm")).otherwise(F.lit("not a date")))
    t = a.select("event_id", raw.alias("raw"))
    return t.withColumn("parsed", dates.parse_any("raw", ["yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm"]))


@register("k3_calendar_parts", with_views("attempts") + """
SELECT event_id, CAST(date_trunc('month', ts) AS DATE) AS month, CAST(date_trunc('quarter', ts) AS DATE) AS quarter,
  CAST(year(ts) AS INTEGER) AS year, CAST(dayofyear(ts) AS INTEGER) AS doy, CAST(hour(ts) AS INTEGER) AS hour,
  dayname(ts) AS weekday, monthname(ts) AS month_name FROM attempts""")
def k3_calendar_parts(spark, root):
    from quarry.operators import dates
    return dates.calendar_parts(_att(spark, root).select("event_id", "ts"), "ts").drop("ts")


@register("k4_rebuild_timestamp", with_views("attempts") + """
SELECT event_id, CAST(make_date(year(ts), 1, 1) AS TIMESTAMP) + (dayofyear(ts) - 1) * INTERVAL 1 DAY + hour(ts) * INTERVAL 1 HOUR AS rebuilt
FROM attempts""")
def k4_rebuild_timestamp(spark, root):
    from quarry.operators import dates
    a = _att(spark, root)
    return a.select("event_id", dates.from_day_hour(F.year("ts"), F.dayofyear("ts"), F.hour("ts")).alias("rebuilt"))


@register("k6_minutes_between_sessions", with_views("attempts") + """
, s AS (SELECT user_id, session, min(ts) AS started, row_number() OVER (PARTITION BY user_id ORDER BY session) AS cycle
  FROM attempts GROUP BY 1, 2)
SELECT user_id, CAST(ceil(date_diff('microsecond', max(CASE WHEN cycle = 1 THEN started END), max(CASE WHEN cycle = 2 THEN started END)) / 60000000.0) AS BIGINT) AS minutes_between
FROM s GROUP BY user_id""")
def k6_minutes_between_sessions(spark, root):
    s = _att(spark, root).groupBy("user_id", "session").agg(F.min("ts").alias("started"))
    s = windows.running_index(s, ["user_id"], ["session"], "cycle")
    w = reshape.long_to_wide(s, ["user_id"], "cycle", "started", [1, 2], "max", prefix="c")
    return w.select("user_id", F.ceil(minutes_between("c1", "c2")).alias("minutes_between"))


@register("k7_saturdays_in_range", with_views("attempts") + """
SELECT CAST(d AS DATE) AS saturday FROM (SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS d FROM attempts)
WHERE dayofweek(d) = 6""")
def k7_saturdays_in_range(spark, root):
    from quarry.operators import dates
    return dates.weekdays_in_range(_att(spark, root), "ts", 7, "saturday")


@register("a8_packed_records", with_views("attempts") + """
, p AS (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN question || ',' || CAST(try_no AS VARCHAR)
   ELSE question || ',' || CAST(try_no AS VARCHAR) || ',' || CAST(time_s AS VARCHAR) || ',' || CAST(correct AS VARCHAR) || ',' || CAST(feedback AS VARCHAR) END AS packed FROM attempts),
s AS (SELECT event_id, string_split(packed, ',') AS f FROM p)
SELECT event_id, f[1] AS question, TRY_CAST(f[2] AS INTEGER) AS try_no, TRY_CAST(f[3] AS DOUBLE) AS time_s,
  TRY_CAST(f[4] AS INTEGER) AS correct, TRY_CAST(f[5] AS INTEGER) AS feedback FROM s WHERE len(f) > 4""")
def a8_packed_records(spark, root):
    from quarry.sources import readers
    a = _tries(spark, root)
    short = F.concat_ws(",", "question", F.col("try_no").cast("string"))
    full = F.concat_ws(",", "question", F.col("try_no").cast("string"), F.col("time_s").cast("string"),
                       F.col("correct").cast("string"), F.col("feedback").cast("string"))
    p = a.select("event_id", F.when(F.col("event_id") % 13 == 0, short).otherwise(full).alias("packed"))
    return readers.parse_packed(p, "packed", [("question", "string"), ("try_no", "int"), ("time_s", "double"),
                                              ("correct", "int"), ("feedback", "int")], keep=["event_id"])
