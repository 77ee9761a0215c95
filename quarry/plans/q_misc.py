"""Remaining rows of the inventory: more dosing profiles, quantisation,
residual trimming, summary cells, run and pattern detection, clock repair,
topics, phrase merging, text scans and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.columns import level_rank, r6
from quarry.operators import cohort, recode, sequences, stats, topics
from quarry.operators import text as tx
from quarry.operators.aggregate import with_total
from quarry.operators.staged import written
from quarry.plans.registry import register
from quarry.plans.views import Views
from quarry.plans.views_sql import with_views
from quarry.sources import readers

@register("b18_penicillin_class", with_views("admissions") + """
, d AS (SELECT adm_id, age_days, (price % 300) * 1000 / weight_kg AS kg,
  CASE adm_id % 5 WHEN 0 THEN 'OD' WHEN 1 THEN 'STAT' WHEN 2 THEN 'BD' WHEN 3 THEN 'TID' ELSE 'QID' END AS f FROM admissions)
SELECT adm_id, CASE WHEN age_days <= 7 THEN
    CASE WHEN kg > 60000 OR f IN ('TID', 'QID') THEN 'Over' WHEN kg < 40000 OR f IN ('OD', 'STAT') THEN 'Under' ELSE 'Correct' END
  ELSE CASE WHEN kg > 60000 THEN 'Over' WHEN kg < 40000 OR f <> 'QID' THEN 'Under' ELSE 'Correct' END END AS pen_class
FROM d""")
def b18_penicillin_class(spark, root):
    a = Views(spark, root).admissions
    labels = [recode.PEN_ONCE, recode.PEN_STAT, recode.PEN_BD, recode.PEN_TID, recode.PEN_QID]
    freq = F.get(F.array(*[F.lit(x) for x in labels]), (F.col("adm_id") % 5).cast("int"))
    return a.select("adm_id", recode.penicillin_class(F.col("age_days"), F.col("weight_kg"), (F.col("price") % 300) * 1000, freq).alias("pen_class"))


@register("b21_ordered_category", with_views("admissions") + """
SELECT adm_id, priority, CAST(list_position(['5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH', '1-URGENT'], priority) AS INTEGER) AS urgency_level
FROM admissions""")
def b21_ordered_category(spark, root):
    a = Views(spark, root).admissions
    # Declared level order, least urgent first.
    levels = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]
    return a.select("adm_id", "priority", level_rank("priority", levels).alias("urgency_level"))


@register("b32_time_quantisation", with_views("attempts") + """
SELECT event_id, CAST(ceil(time_s / 3) AS BIGINT) AS time_step, CAST(floor(CAST(k AS DOUBLE) / 100 * 10) AS BIGINT) / 10.0 AS score_tenths
FROM attempts""")
def b32_time_quantisation(spark, root):
    a = Views(spark, root).attempts
    return a.select("event_id", F.ceil(F.col("time_s") / 3).alias("time_step"),
                    (F.floor(F.col("k").cast("double") / 100 * 10) / 10.0).alias("score_tenths"))


@register("c10_residual_trim", with_views("cases") + """
, c AS (SELECT price, quantity FROM cases WHERE price IS NOT NULL AND quantity IS NOT NULL),
f AS (SELECT regr_slope(price, quantity) AS b, regr_intercept(price, quantity) AS a FROM c),
r AS (SELECT price - (a + b * quantity) AS resid FROM c, f),
s AS (SELECT avg(resid) AS m, stddev_samp(resid) AS sd FROM r)
SELECT count(*) AS n_kept, round(avg(resid), 6) AS mean_resid FROM r, s WHERE abs((resid - m) / sd) <= 2.5""")
def c10_residual_trim(spark, root):
    c = Views(spark, root).cases.dropna(subset=["price", "quantity"]).select("price", "quantity")
    fit = c.agg(F.regr_slope("price", "quantity").alias("_b"), F.regr_intercept("price", "quantity").alias("_a"))
    r = with_total(c, fit).select((F.col("price") - (F.col("_a") + F.col("_b") * F.col("quantity"))).alias("resid"))
    kept = cohort.residual_trim(r, "resid", 2.5)
    return kept.agg(F.count(F.lit(1)).alias("n_kept"), r6(F.avg("resid")).alias("mean_resid"))


@register("c10_leverage_trim", with_views("cases") + """
, c AS (SELECT price, quantity FROM cases WHERE price IS NOT NULL AND quantity IS NOT NULL),
f AS (SELECT regr_slope(price, quantity) AS b, regr_intercept(price, quantity) AS a FROM c),
r AS (SELECT quantity, price - (a + b * quantity) AS resid FROM c, f),
s AS (SELECT count(*) AS n, avg(quantity) AS mx, var_pop(quantity) AS vx, avg(resid) AS m, stddev_samp(resid) AS sd FROM r)
SELECT count(*) AS n_kept, round(avg(quantity), 6) AS mean_quantity FROM r, s
WHERE abs((resid - m) / sd) <= 2.5 AND 1.0 / n + (quantity - mx) * (quantity - mx) / (vx * n) <= 1.9 * 2 / n""")
def c10_leverage_trim(spark, root):
    c = Views(spark, root).cases.filter(F.col("price").isNotNull() & F.col("quantity").isNotNull())
    fit = c.agg(F.regr_slope("price", "quantity").alias("_b"), F.regr_intercept("price", "quantity").alias("_a"))
    r = with_total(c, fit).select("quantity", (F.col("price") - (F.col("_a") + F.col("_b") * F.col("quantity"))).alias("resid"))
    kept = cohort.leverage_trim(r, "quantity", "resid", 2.5, 1.9)
    return kept.agg(F.count(F.lit(1)).alias("n_kept"), r6(F.avg("quantity")).alias("mean_quantity"))


@register("e41_n_pct_cells", with_views("profiles") + """
, c AS (SELECT coalesce(cadre, 'NA') AS cadre, arm, count(*) AS n FROM profiles GROUP BY 1, 2),
t AS (SELECT arm, sum(n) AS tot FROM c GROUP BY 1),
x AS (SELECT c.cadre, c.arm, CAST(c.n AS VARCHAR) || ' (' || CAST(round(c.n * 100.0 / t.tot, 1) AS VARCHAR) || '%)' AS cell FROM c JOIN t USING (arm))
SELECT cadre, max(CASE WHEN arm = 0 THEN cell END) AS arm0, max(CASE WHEN arm = 1 THEN cell END) AS arm1 FROM x GROUP BY 1""")
def e41_n_pct_cells(spark, root):
    p = Views(spark, root).profiles.withColumn("cadre", F.coalesce("cadre", F.lit("NA")))
    c = p.groupBy("cadre", "arm").agg(F.count(F.lit(1)).alias("n"))
    t = c.groupBy("arm").agg(F.sum("n").alias("tot"))
    x = c.join(t, "arm").withColumn("cell", F.concat(F.col("n").cast("string"), F.lit(" ("),
                                                     F.round(F.col("n") * 100.0 / F.col("tot"), 1).cast("string"),
                                                     F.lit("%)")))
    w = x.groupBy("cadre").pivot("arm", [0, 1]).agg(F.max("cell"))
    return w.select("cadre", F.col("0").alias("arm0"), F.col("1").alias("arm1"))


@register("e31_summary_by_arm")
def e31_summary_by_arm(spark, root):
    """Rows-only: 'mean (SD, N)' per arm for several measures with a Welch
    p-value column."""
    v = Views(spark, root)
    s = sequences.session_rollup(v.tries).join(v.profiles.select("user_id", "arm"), "user_id")
    out = None
    for m in ("total_time", "n_tries", "score"):
        g = s.groupBy("arm").agg(F.avg(m).alias("mu"), F.stddev_samp(m).alias("sd"), F.count(m).alias("n"))
        cell = F.format_string("%.2f (%.2f, %d)", "mu", "sd", "n")
        w = g.groupBy().pivot("arm", [0, 1]).agg(F.first(cell)).withColumnRenamed("0", "arm0").withColumnRenamed("1", "arm1")
        p = stats.t_test(s, "arm", m, 0, 1).select("p_welch")
        row = with_total(w, p).withColumn("measure", F.lit(m))
        out = row if out is None else out.unionByName(row)
    return out.select("measure", "arm0", "arm1", "p_welch")


@register("e40_job_counters", with_views("edges") + """
SELECT count(*) AS n_edges, count(DISTINCT src) AS n_nodes, CAST(sum(CASE WHEN src < 1000000000 THEN 1 ELSE 0 END) AS BIGINT) AS n_supplier_edges
FROM edges""")
def e40_job_counters(spark, root):
    """Counters the scripts kept in accumulators (which double count when
    tasks are retried), computed as one aggregate in the same pass."""
    e = Views(spark, root).edges
    return e.agg(F.count(F.lit(1)).alias("n_edges"), F.countDistinct("src").alias("n_nodes"),
                 F.sum(F.when(F.col("src") < 1_000_000_000, 1).otherwise(0)).alias("n_supplier_edges"))


_ISLANDS_SQL = """
, y AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY ts, event_id)
          - row_number() OVER (PARTITION BY {by}, state ORDER BY ts, event_id) AS grp FROM x),
runs AS (SELECT {by}, state, grp, count(*) AS len FROM y GROUP BY ALL)"""


LOOKBACKS = range(3, 11)


def _islands(df, by, state, lookbacks=LOOKBACKS):
    """Runs of equal state per entity (gaps and islands), via two running
    indices from one placement of the rows; returns run lengths and, for
    each lookback, the count of non-overlapping windows of that length per
    run."""
    from quarry.functions.ordered import Running, running
    b = running(df.select(*by, state, "ts", "event_id"), by, ["ts", "event_id"], [Running("_i1"), Running("_i2", within=(state,))])
    runs = b.groupBy(*by, state, (F.col("_i1") - F.col("_i2")).alias("_grp")).agg(F.count(F.lit(1)).alias("len"))
    each = runs.withColumn("lookback", F.explode(F.array(*[F.lit(n) for n in lookbacks])))
    return each.withColumn("windows", F.floor(F.col("len") / F.col("lookback")))


@register("f15_run_detection", with_views("attempts") + """
, x AS (SELECT user_id, ts, event_id, CASE WHEN (k % 100) / 100.0 > 0.7 THEN 'hi' WHEN (k % 100) / 100.0 < 0.4 THEN 'lo' ELSE 'mid' END AS state
  FROM attempts)""" + _ISLANDS_SQL.format(by="user_id") + """
SELECT user_id, lookback, CAST(sum(CASE WHEN state = 'hi' THEN len // lookback ELSE 0 END) AS BIGINT) AS mastery_windows,
  CAST(sum(CASE WHEN state = 'lo' THEN len // lookback ELSE 0 END) AS BIGINT) AS wheelspin_windows
FROM runs, (SELECT CAST(unnest(range(3, 11)) AS INTEGER) AS lookback) GROUP BY 1, 2""")
def f15_run_detection(spark, root):
    a = Views(spark, root).attempts
    p = (F.col("k") % 100) / 100.0
    x = a.select("user_id", "ts", "event_id", F.when(p > 0.7, "hi").when(p < 0.4, "lo").otherwise("mid").alias("state"))
    runs = _islands(x, ["user_id"], "state")
    return runs.groupBy("user_id", "lookback").agg(
        F.sum(F.when(F.col("state") == "hi", F.col("windows")).otherwise(0)).alias("mastery_windows"),
        F.sum(F.when(F.col("state") == "lo", F.col("windows")).otherwise(0)).alias("wheelspin_windows"))


@register("f16_behaviour_patterns", with_views("attempts") + """
, x AS (SELECT user_id, question, ts, event_id, CASE WHEN correct = 1 THEN 'right' ELSE 'wrong' END AS state FROM attempts)
""" + _ISLANDS_SQL.format(by="user_id, question") + """,
last AS (SELECT user_id, correct = 0 AS dropped FROM (SELECT user_id, correct, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk FROM attempts) WHERE rk = 1),
p AS (SELECT user_id, lookback, CAST(sum(CASE WHEN state = 'right' THEN len // lookback ELSE 0 END) AS BIGINT) AS streaks,
        CAST(sum(CASE WHEN state = 'wrong' THEN len // lookback ELSE 0 END) AS BIGINT) AS wheelspins
      FROM runs, (SELECT CAST(unnest(range(3, 11)) AS INTEGER) AS lookback) GROUP BY 1, 2)
SELECT p.user_id, p.lookback, p.streaks, p.wheelspins, last.dropped FROM p JOIN last USING (user_id)""")
def f16_behaviour_patterns(spark, root):
    from quarry.operators.windows import latest_value
    a = Views(spark, root).attempts
    x = a.select("user_id", "question", "ts", "event_id",
                 F.when(F.col("correct") == 1, "right").otherwise("wrong").alias("state"))
    runs = _islands(x, ["user_id", "question"], "state")
    p = runs.groupBy("user_id", "lookback").agg(
        F.sum(F.when(F.col("state") == "right", F.col("windows")).otherwise(0)).alias("streaks"),
        F.sum(F.when(F.col("state") == "wrong", F.col("windows")).otherwise(0)).alias("wheelspins"))
    last = latest_value(a, ["user_id"], "correct", ["ts", "event_id"]).select("user_id", (F.col("correct") == 0).alias("dropped"))
    return p.join(last, "user_id")


STEP_ORDER = ["view", "click", "signup", "purchase", "error"]         # the steps of a scenario, first to last


@register("f16_behaviour_machine", with_views("attempts") + """
, s AS (SELECT user_id, list_position(['view', 'click', 'signup', 'purchase', 'error'], question) AS step, ts, event_id FROM attempts),
q AS (SELECT user_id, list(step ORDER BY ts, event_id) AS seq FROM s WHERE step IS NOT NULL GROUP BY user_id),
w AS MATERIALIZED (
  SELECT user_id, n, i, seq[i:i + n - 1] AS x FROM q CROSS JOIN (SELECT CAST(unnest(range(3, 11)) AS INTEGER) AS n)
  CROSS JOIN LATERAL (SELECT unnest(range(1, len(seq) - n + 2)) AS i)),
m AS MATERIALIZED (
  SELECT user_id, n, i, x[n] = 1 AS back, x[n - 1] <> 5 AS away, len(list_distinct(x)) = 1 AS spin,
         x = list_transform(range(0, n), lambda j: x[1] + j) AS plain, list_position(x, 5) AS p, x FROM w),
t AS MATERIALIZED (
  SELECT user_id, n, i, back, away, spin, plain, plain OR (NOT spin AND p > 0 AND x = list_transform(range(1, n + 1),
         lambda j: CASE WHEN j <= p THEN 5 - p + j ELSE j - p END)) AS streak FROM m),
r AS (
  WITH RECURSIVE z AS (
    SELECT user_id, n, CAST(0 AS BIGINT) AS i, 0 AS skip, false AS found, CAST(0 AS BIGINT) AS streaks, CAST(0 AS BIGINT) AS spins, CAST(0 AS BIGINT) AS drops
    FROM q CROSS JOIN (SELECT CAST(unnest(range(3, 11)) AS INTEGER) AS n)
    UNION ALL
    SELECT z.user_id, z.n, t.i,
      CASE WHEN skip > 0 THEN skip - 1 WHEN streak OR spin THEN z.n - 1 ELSE 0 END,
      CASE WHEN skip > 1 THEN found OR back ELSE false END,
      streaks + CASE WHEN skip = 0 AND streak THEN 1 ELSE 0 END,
      spins + CASE WHEN skip = 0 AND spin THEN 1 ELSE 0 END,
      drops + CASE WHEN back AND away AND (CASE WHEN skip > 0 THEN NOT found ELSE NOT plain END) THEN 1 ELSE 0 END
    FROM z JOIN t ON t.user_id = z.user_id AND t.n = z.n AND t.i = z.i + 1)
  SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY user_id, n ORDER BY i DESC) = 1)
SELECT user_id, n AS lookback, streaks, spins AS wheelspins, drops AS dropouts FROM r""")
def f16_behaviour_machine(spark, root):
    """Streaks, wheel-spins and drop-outs with skip-ahead after a match, over
    each learner's steps, windows of 3 to 10."""
    from quarry.operators.behaviour import behaviour_patterns
    step = F.nullif(F.array_position(F.array(*[F.lit(x) for x in STEP_ORDER]), F.col("question")), F.lit(0))
    a = Views(spark, root).attempts.withColumn("step", step)
    return behaviour_patterns(a, "user_id", ["ts", "event_id"], "step", LOOKBACKS, 1, len(STEP_ORDER))


@register("k2_clock_repair", with_views("attempts") + r"""
, r AS (SELECT event_id, CASE event_id % 5
    WHEN 0 THEN CAST(hour(ts) AS VARCHAR) || '.' || lpad(CAST(minute(ts) AS VARCHAR), 2, '0')
    WHEN 1 THEN lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || lpad(CAST(minute(ts) AS VARCHAR), 2, '0')
    WHEN 2 THEN CAST(CASE WHEN hour(ts) % 12 = 0 THEN 12 ELSE hour(ts) % 12 END AS VARCHAR) || ':' || lpad(CAST(minute(ts) AS VARCHAR), 2, '0') || CASE WHEN hour(ts) >= 12 THEN 'pm' ELSE 'am' END
    WHEN 3 THEN CAST(hour(ts) AS VARCHAR) || 'h' ELSE 'n/a' END AS raw FROM attempts),
a AS (SELECT event_id, raw, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(raw)), '[.h]', ':', 'g'),
        '^(\d{1,2})(\d{2})$', '\1:\2'), '^(\d{1,2})$', '\1:00'), ':$', ':00') AS t FROM r),
b AS (SELECT event_id, raw, ends_with(t, 'pm') AS pm, regexp_replace(t, '\s*(am|pm)$', '') AS t FROM a),
c AS (SELECT event_id, raw, pm, TRY_CAST(nullif(regexp_extract(t, '^(\d{1,2}):(\d{2})$', 1), '') AS INTEGER) AS hh,
        TRY_CAST(nullif(regexp_extract(t, '^(\d{1,2}):(\d{2})$', 2), '') AS INTEGER) AS mm FROM b),
d AS (SELECT event_id, raw, CASE WHEN pm AND hh < 12 THEN hh + 12 ELSE hh END AS hh, mm FROM c)
SELECT event_id, raw, CASE WHEN hh BETWEEN 0 AND 23 AND mm BETWEEN 0 AND 59 THEN printf('%02d:%02d', hh, mm) END AS clock FROM d""")
def k2_clock_repair(spark, root):
    from quarry.operators.dates import repair_clock
    a = Views(spark, root).attempts
    h, m = F.hour("ts"), F.minute("ts")
    mm = F.lpad(m.cast("string"), 2, "0")
    raw = (F.when(F.col("event_id") % 5 == 0, F.concat(h.cast("string"), F.lit("."), mm))
           .when(F.col("event_id") % 5 == 1, F.concat(F.lpad(h.cast("string"), 2, "0"), mm))
           .when(F.col("event_id") % 5 == 2, F.concat(F.when(h % 12 == 0, 12).otherwise(h % 12).cast("string"), F.lit(":"), mm,
                                                      F.when(h >= 12, "pm").otherwise("am")))
           .when(F.col("event_id") % 5 == 3, F.concat(h.cast("string"), F.lit("h"))).otherwise(F.lit("n/a")))
    r = a.select("event_id", raw.alias("raw"))
    return r.select("event_id", "raw", repair_clock("raw").alias("clock"))


# ----------------------------------------------------------------- topics and phrases

from quarry.plans.q_text import _W, STOP_WORDS  # noqa: E402


@register("l3_doc_term_matrix", f"""
WITH t AS (SELECT doc_id, unnest({_W}) AS w FROM documents),
n AS (SELECT doc_id, w, count(*) AS n FROM t WHERE w NOT IN ({", ".join(repr(x) for x in STOP_WORDS)}) GROUP BY 1, 2),
k AS (SELECT w FROM n GROUP BY 1 HAVING count(*) >= 3),
c AS (SELECT doc_id, count(*) AS n_terms, CAST(sum(n) AS BIGINT) AS n_tokens FROM n JOIN k USING (w) GROUP BY 1)
SELECT doc_id, coalesce(n_terms, 0) AS n_terms, coalesce(n_tokens, 0) AS n_tokens FROM documents LEFT JOIN c USING (doc_id)""")
def l3_doc_term_matrix(spark, root):
    """Per document, distinct dictionary terms and their total count."""
    d = Views(spark, root).t.documents
    counts = topics.term_counts(d, "doc_id", "text", STOP_WORDS)
    per = counts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("n").alias("n_tokens"))
    zero = F.lit(0).cast("long")
    return d.select("doc_id").join(per, "doc_id", "left").select(
        "doc_id", F.coalesce("n_terms", zero).alias("n_terms"), F.coalesce("n_tokens", zero).alias("n_tokens"))


@register("l4_l7_l8_lda_topics")
def l4_l7_l8_lda_topics(spark, root):
    """Rows-only: topic model (k=5, seed 7): top 10 terms per topic and the
    number of documents whose dominant topic it is."""
    counts = topics.term_counts(Views(spark, root).t.documents, "doc_id", "text", STOP_WORDS)
    model = topics.fit_topics(counts, "doc_id", [topics.Setting(5)])
    dom = topics.document_topics(model).groupBy("topic").agg(F.count(F.lit(1)).alias("n_docs"))
    return topics.top_terms(model, 10).select("topic", "rank", "weight", "term").join(dom, "topic", "left")


# shares of the corpus and topic counts that are tried
TOPIC_GRID = [(k, share) for share in (0.55, 0.7, 0.85, 1.0) for k in range(2, 11)]


@register("l5_l6_topic_grid")
def l5_l6_topic_grid(spark, root):
    """Rows-only: topic count x corpus fraction grid scored by the mean NPMI
    coherence of its topics' top terms, with its last perplexity bound.  All
    settings are trained by the same passes (fractions by hash)."""
    counts = topics.term_counts(Views(spark, root).t.documents, "doc_id", "text", STOP_WORDS)
    model = topics.fit_topics(counts, "doc_id", [topics.Setting(k, share) for k, share in TOPIC_GRID])
    coherence = topics.npmi_coherence(model.counts, "doc_id", topics.top_terms(model, 10), ["k", "share", "topic"])
    last = spark.createDataFrame([(s.k, s.share, p) for s, p in zip(model.settings, (model.perplexity or [[None] * len(TOPIC_GRID)])[-1], strict=True)],
                                 "k int, share double, perplexity double")
    return (coherence.groupBy("k", "share").agg(r6(F.avg("coherence")).alias("coherence")).join(last, ["k", "share"])
            .select("k", F.col("share").alias("fraction"), "coherence", r6("perplexity").alias("perplexity")))


@register("l2_merge_phrases", f"""
WITH t AS (SELECT doc_id, {_W} AS w FROM documents),
u AS (SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM t) GROUP BY 1),
v AS (SELECT count(*) AS "V" FROM u),
p AS (SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: {{'i': i, 'a': w[i], 'b': w[i + 1]}})) AS p FROM t WHERE len(w) >= 2),
b AS (SELECT p.a AS a, p.b AS b, count(*) AS n_ab FROM p GROUP BY 1, 2 HAVING count(*) >= 3),
s AS (SELECT b.a, b.b FROM b JOIN u ua ON ua.w = b.a JOIN u ub ON ub.w = b.b, v
      WHERE round((b.n_ab - 3) * v."V" / (ua.n * ub.n), 6) > 40),
h AS (SELECT doc_id, p.i AS i, p.i - row_number() OVER (PARTITION BY doc_id ORDER BY p.i) AS run FROM p JOIN s ON p.a = s.a AND p.b = s.b),
m AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, i - min(i) OVER (PARTITION BY doc_id, run) AS k FROM h) WHERE k % 2 = 0 GROUP BY 1)
SELECT t.doc_id, CAST(len(t.w) AS INTEGER) AS n_tokens, CAST(len(t.w) - coalesce(m.n, 0) AS INTEGER) AS n_merged
FROM t LEFT JOIN m USING (doc_id)""")
def l2_merge_phrases(spark, root):
    """Documents with detected phrases merged greedily (left to right, no
    overlap)."""
    d = Views(spark, root).t.documents
    phrases = tx.bigram_phrases(d, "doc_id", "text", 3, 40.0)
    toks = d.select("doc_id", tx.words("text").alias("t"))
    cand = tx.phrase_positions(toks, "doc_id", F.col("t"), phrases)
    j = toks.join(cand, "doc_id", "left")
    merged = tx.merge_at_positions(F.col("t"), F.col("cand"))
    return j.select("doc_id", F.size("t").alias("n_tokens"), F.size(merged).alias("n_merged"))


# ----------------------------------------------------------------- scans and sinks

@register("a1_a6_text_scans")
def a1_a6_text_scans(spark, root):
    """Rows-only: the driver tables written in the text layouts the analyses
    read ('::'-delimited ratings, whitespace ratings, adjacency lines,
    quoted names, header CSV, headerless matrix, nested JSON trees) to a
    fresh folder under the checkpoint folder and scanned back."""
    from pyspark.sql import types as T

    from quarry.streaming.statuses import scratch
    v = Views(spark, root)
    base = scratch(spark, "scans")
    r = written(v.ratings)          # joined and averaged once for both layouts
    r.select(F.concat_ws("::", "user_id", "item_id", "rating")).write.text(f"{base}/ratings_colon")
    r.select(F.concat_ws(" ", "user_id", "item_id", "rating")).write.text(f"{base}/ratings_ws")
    e = v.edges
    # adjacency lines, a node's neighbours spread over hash buckets (several lines per node)
    e.groupBy("src", F.pmod(F.xxhash64("dst"), F.lit(16)).alias("_b")) \
        .agg(F.concat_ws(" ", F.col("src").cast("string"), F.concat_ws(" ", F.collect_list(F.col("dst").cast("string")))).alias("v")) \
        .select("v").write.text(f"{base}/adjacency")
    v.t.supplier.select(F.format_string('%d "%s"', "s_suppkey", "s_name")).write.text(f"{base}/names")
    v.admissions.select("adm_id", "hospital", "weight_kg").write.option("header", True).csv(f"{base}/csv")
    v.survey.select(F.concat_ws(" ", *[F.col(f"i{i}").cast("string") for i in range(1, 7)], "user_id")).write.text(f"{base}/matrix")
    rec = F.to_json(F.struct(F.col("question").alias("q"), F.col("time_s").cast("string").alias("t")))
    v.attempts.select(F.to_json(F.create_map(F.col("user_id").cast("string"),
                                             F.to_json(F.create_map(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), rec)))).alias("v")) \
        .write.text(f"{base}/tree")
    schema3 = T.StructType([T.StructField("user", T.LongType()), T.StructField("item", T.LongType()),
                            T.StructField("rating", T.DoubleType())])
    counts = [
        ("a1_colon", readers.read_delimited(spark, f"{base}/ratings_colon", schema3, sep="::").count()),
        ("a1_whitespace", readers.read_delimited(spark, f"{base}/ratings_ws", schema3, sep="whitespace").count()),
        ("a2_adjacency", readers.read_adjacency(spark, f"{base}/adjacency").count()),
        ("a3_quoted_names", readers.read_quoted_names(spark, f"{base}/names").count()),
        ("a4_csv_header", readers.read_csv_header(spark, f"{base}/csv").count()),
        ("a5_matrix", readers.read_matrix(spark, f"{base}/matrix", {0: ("i1", "int"), 6: ("user_id", "long")}).count()),
        ("a6_tree", readers.flatten_tree(spark, f"{base}/tree", "q string, t string").count()),
    ]
    return spark.createDataFrame(counts, "scan string, n_rows long")


@register("a10_a13_sinks_and_stages")
def a10_a13_sinks_and_stages(spark, root):
    """Rows-only: CSV overwrite and append, parquet sink, a materialise-or-
    load stage (second call reads the stored table) and grid resumption."""
    from quarry.streaming.statuses import scratch
    v = Views(spark, root)
    base = scratch(spark, "sinks")
    rates = v.admissions.groupBy("hospital").agg(F.count(F.lit(1)).alias("n"))
    readers.write_csv(rates, f"{base}/csv")
    readers.write_csv(rates, f"{base}/csv", mode="append")
    readers.write_table(rates, f"{base}/parquet", partition_by=["hospital"])
    built = readers.stage(spark, f"{base}/stage", lambda: rates)
    again = readers.stage(spark, f"{base}/stage", lambda: rates.limit(0))
    grid = spark.range(0, 6).select(F.col("id").alias("param")).withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(1, 6)])))
    done = grid.filter(F.col("param") < 2)
    todo = readers.resume_grid(done, grid, ["param", "fold"])
    counts = [("csv_rows", spark.read.option("header", True).csv(f"{base}/csv").count()),
              ("parquet_rows", spark.read.parquet(f"{base}/parquet").count()),
              ("stage_rows", built.count()), ("stage_reloaded_rows", again.count()), ("grid_left", todo.count())]
    return spark.createDataFrame(counts, "item string, n long")
