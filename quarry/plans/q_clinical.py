"""Clinical-quality queries: recodes, cohorts, prescription error rates,
mortality and diagnosis tables, documentation scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.columns import cut, month_start, quarter_start, r6, row_mean, row_sum, rules
from quarry.operators import aggregate as agg
from quarry.operators import cohort, recode, reshape, windows
from quarry.plans.registry import register
from quarry.plans.views import Views
from quarry.plans.views_sql import with_views

DOSE_LEVELS = {"under": "Under", "over": "Over", "correct": "Correct"}

# Weight bands (kg) and labels of the clinical report.
WEIGHT_BREAKS = [0.0, 1.0, 1.5, 2.5, 5.0]
WEIGHT_LABELS = ["<1kg", "1-1.5kg", "1.5-2.5kg", ">2.5kg"]
DX_COLS = ["dx_sepsis", "dx_prematurity", "dx_jaundice", "dx_asphyxia"]


def _monthly_rates(v: Views):
    a = v.admissions.select("hospital", month_start("adm_date").alias("month"), "dose_class")
    out = agg.class_rates(a, ["hospital", "month"], "dose_class", DOSE_LEVELS)
    return out.withColumn("error_rate", r6((F.col("n_under") + F.col("n_over")) / F.col("denom")))


_RATES_SQL = """
SELECT hospital, CAST(date_trunc('month', adm_date) AS DATE) AS month, count(*) AS denom,
  CAST(sum(CASE WHEN dose_class = 'Under' THEN 1 ELSE 0 END) AS BIGINT) AS n_under,
  CAST(sum(CASE WHEN dose_class = 'Over' THEN 1 ELSE 0 END) AS BIGINT) AS n_over,
  CAST(sum(CASE WHEN dose_class = 'Correct' THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
  round(sum(CASE WHEN dose_class = 'Under' THEN 1 ELSE 0 END) / count(*), 6) AS under_rate,
  round(sum(CASE WHEN dose_class = 'Over' THEN 1 ELSE 0 END) / count(*), 6) AS over_rate,
  round(sum(CASE WHEN dose_class = 'Correct' THEN 1 ELSE 0 END) / count(*), 6) AS correct_rate,
  round(sum(CASE WHEN dose_class <> 'Correct' THEN 1 ELSE 0 END) / count(*), 6) AS error_rate
FROM admissions GROUP BY 1, 2"""


@register("e14_dose_error_rates", with_views("admissions") + _RATES_SQL)
def e14_dose_error_rates(spark, root):
    return _monthly_rates(Views(spark, root))


def _relative(v: Views):
    return windows.relative_period(_monthly_rates(v), ["hospital"], "month", last=24)


_REL_SQL = f""", rates AS ({_RATES_SQL}),
rel AS (SELECT *, CAST(row_number() OVER (PARTITION BY hospital ORDER BY month)
                   - count(*) OVER (PARTITION BY hospital) AS INTEGER) AS rel_period FROM rates)
"""


@register("f8_relative_month", with_views("admissions") + _REL_SQL + "SELECT * FROM rel WHERE rel_period > -24")
def f8_relative_month(spark, root):
    return _relative(Views(spark, root))


@register("f9_last_periods", with_views("admissions") + f""", rates AS ({_RATES_SQL}),
r AS (SELECT *, row_number() OVER (PARTITION BY hospital ORDER BY month DESC) AS rk FROM rates)
SELECT * EXCLUDE (rk), CAST(row_number() OVER (PARTITION BY hospital ORDER BY month) AS INTEGER) AS period_idx
FROM r WHERE rk <= 25 AND rk > 1""")
def f9_last_periods(spark, root):
    return windows.last_periods(_monthly_rates(Views(spark, root)), ["hospital"], "month", 25)


@register("f10_pooled_band", with_views("admissions") + _REL_SQL + """
SELECT rel_period, round(quantile_cont(error_rate, 0.25), 6) AS q1,
  round(quantile_cont(error_rate, 0.5), 6) AS median, round(quantile_cont(error_rate, 0.75), 6) AS q3
FROM rel WHERE rel_period > -24 GROUP BY rel_period""")
def f10_pooled_band(spark, root):
    rel = _relative(Views(spark, root))
    q = agg.quantiles_by(rel, ["rel_period"], "error_rate")
    return q.select("rel_period", *[r6(c).alias(c) for c in ("q1", "median", "q3")])


@register("e8_quartiles_by_site", with_views("admissions") + """
SELECT hospital, round(quantile_cont(weight_kg, 0.25), 6) AS q1, round(quantile_cont(weight_kg, 0.5), 6) AS median,
  round(quantile_cont(weight_kg, 0.75), 6) AS q3 FROM admissions GROUP BY hospital""")
def e8_quartiles_by_site(spark, root):
    q = agg.quantiles_by(Views(spark, root).admissions, ["hospital"], "weight_kg")
    return q.select("hospital", *[r6(c).alias(c) for c in ("q1", "median", "q3")])


_WBAND_SQL = """CASE WHEN weight_kg > 0 AND weight_kg <= 1 THEN '<1kg' WHEN weight_kg > 1 AND weight_kg <= 1.5 THEN '1-1.5kg'
  WHEN weight_kg > 1.5 AND weight_kg <= 2.5 THEN '1.5-2.5kg' WHEN weight_kg > 2.5 AND weight_kg <= 5 THEN '>2.5kg' END"""


@register("e16_mortality_by_site_band", with_views("admissions") + f"""
SELECT hospital, {_WBAND_SQL} AS weight_band, count(*) AS n, CAST(sum(CAST(dead AS INTEGER)) AS BIGINT) AS events,
  round(sum(CAST(dead AS INTEGER)) / count(*), 6) AS rate
FROM admissions GROUP BY 1, 2""")
def e16_mortality_by_site_band(spark, root):
    a = Views(spark, root).admissions.withColumn("weight_band", cut("weight_kg", WEIGHT_BREAKS, WEIGHT_LABELS))
    return agg.rate_with_total(a, ["hospital", "weight_band"], "dead")


@register("b24_weight_band", with_views("admissions") + f"""
SELECT adm_id, weight_kg, {_WBAND_SQL} AS weight_band FROM admissions""")
def b24_weight_band(spark, root):
    a = Views(spark, root).admissions
    return a.select("adm_id", "weight_kg", cut("weight_kg", WEIGHT_BREAKS, WEIGHT_LABELS).alias("weight_band"))


@register("e25_top_diagnoses", with_views("admissions") + """
SELECT label, n FROM (
  SELECT 'dx_sepsis' AS label, CAST(sum(CAST(dx_sepsis AS INTEGER)) AS BIGINT) AS n FROM admissions UNION ALL
  SELECT 'dx_prematurity', CAST(sum(CAST(dx_prematurity AS INTEGER)) AS BIGINT) FROM admissions UNION ALL
  SELECT 'dx_jaundice', CAST(sum(CAST(dx_jaundice AS INTEGER)) AS BIGINT) FROM admissions UNION ALL
  SELECT 'dx_asphyxia', CAST(sum(CAST(dx_asphyxia AS INTEGER)) AS BIGINT) FROM admissions)
ORDER BY n DESC, label LIMIT 3""")
def e25_top_diagnoses(spark, root):
    return agg.top_labels(Views(spark, root).admissions, DX_COLS, 3)


@register("e26_diagnosis_combinations", with_views("admissions") + """
, grid AS (SELECT a.x AS dx_sepsis, b.x AS dx_prematurity, c.x AS dx_jaundice, d.x AS dx_asphyxia
  FROM (VALUES (true), (false)) a(x), (VALUES (true), (false)) b(x), (VALUES (true), (false)) c(x), (VALUES (true), (false)) d(x)),
cnt AS (SELECT dx_sepsis, dx_prematurity, dx_jaundice, dx_asphyxia, count(*) AS n FROM admissions GROUP BY ALL),
tot AS (SELECT count(*) AS t FROM admissions)
SELECT g.dx_sepsis, g.dx_prematurity, g.dx_jaundice, g.dx_asphyxia,
  coalesce(nullif(concat_ws('&', CASE WHEN g.dx_sepsis THEN 'dx_sepsis' END, CASE WHEN g.dx_prematurity THEN 'dx_prematurity' END,
     CASE WHEN g.dx_jaundice THEN 'dx_jaundice' END, CASE WHEN g.dx_asphyxia THEN 'dx_asphyxia' END), ''), 'none') AS combination,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n, round(coalesce(c.n, 0) * 100.0 / tot.t, 6) AS pct
FROM grid g LEFT JOIN cnt c USING (dx_sepsis, dx_prematurity, dx_jaundice, dx_asphyxia), tot""")
def e26_diagnosis_combinations(spark, root):
    return agg.exact_combinations(Views(spark, root).admissions, DX_COLS)


@register("e27_top_priority_per_year", with_views("admissions") + """
, c AS (SELECT CAST(year(adm_date) AS INTEGER) AS year, priority, count(*) AS n FROM admissions GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY n DESC, priority) AS rk,
        sum(n) OVER (PARTITION BY year) AS tot FROM c)
SELECT year, CASE WHEN rk <= 3 THEN priority ELSE 'Other' END AS priority, CAST(sum(n) AS BIGINT) AS n,
  round(sum(n) / max(tot), 6) AS share
FROM r GROUP BY 1, 2""")
def e27_top_priority_per_year(spark, root):
    a = Views(spark, root).admissions.select(F.year("adm_date").alias("year"), "priority")
    return agg.top_k_with_other(a, "year", "priority", 3)


@register("e27_top_priority_per_month", with_views("admissions") + """
, c AS (SELECT CAST(date_trunc('month', adm_date) AS DATE) AS month, priority, count(*) AS n FROM admissions GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY n DESC, priority) AS rk, sum(n) OVER (PARTITION BY month) AS tot FROM c),
t AS (SELECT month, CASE WHEN rk <= 4 THEN priority ELSE 'Other' END AS priority, sum(n) AS n, sum(n) / max(tot) AS share FROM r GROUP BY 1, 2),
g AS (SELECT m.month, l.priority FROM (SELECT DISTINCT month FROM t) m, (SELECT DISTINCT priority FROM t) l)
SELECT g.month, g.priority, CAST(coalesce(t.n, 0) AS BIGINT) AS n, round(coalesce(t.share, 0), 6) AS share
FROM g LEFT JOIN t ON g.month = t.month AND g.priority = t.priority""")
def e27_top_priority_per_month(spark, root):
    from quarry.functions.columns import month_start
    a = Views(spark, root).admissions.select(month_start("adm_date").alias("month"), "priority")
    return agg.top_k_with_other(a, "month", "priority", 4, fill_zero=True)


_ATTRITION = [
    ("admitted", "true"),
    ("has_discharge", "discharge_time IS NOT NULL"),
    ("weight_in_range", "weight_kg BETWEEN 1 AND 4"),
    ("alive", "NOT dead"),
]


def _attrition_sql():
    parts = []
    for i, (name, _) in enumerate(_ATTRITION):
        conj = " AND ".join(f"({p})" for _, p in _ATTRITION[: i + 1])
        parts.append(f"SELECT {i + 1} AS step, '{name}' AS name, "
                     f"CAST(sum(CASE WHEN {conj} THEN 1 ELSE 0 END) AS BIGINT) AS n_left FROM admissions")
    return " UNION ALL ".join(parts)


@register("c3_cohort_attrition", with_views("admissions") + _attrition_sql())
def c3_cohort_attrition(spark, root):
    steps = [(name, F.expr(pred)) for name, pred in _ATTRITION]
    return cohort.attrition(Views(spark, root).admissions, steps)


@register("c4_date_order_valid", with_views("admissions") + """
SELECT adm_id, CASE WHEN discharge_time IS NULL THEN NULL
  WHEN adm_time - age_days * INTERVAL 1 DAY <= adm_time AND adm_time <= discharge_time THEN true ELSE false END AS dates_valid
FROM admissions""")
def c4_date_order_valid(spark, root):
    a = Views(spark, root).admissions
    birth = F.timestamp_add("DAY", -F.col("age_days"), F.col("adm_time"))
    return a.select("adm_id", cohort.date_order_valid(birth, F.col("adm_time"), F.col("discharge_time"))
                    .alias("dates_valid"))


@register("k5_length_of_stay", with_views("admissions") + """
SELECT adm_id, least(CAST(date_diff('day', CAST(adm_time AS DATE), CAST(discharge_time AS DATE)) AS INTEGER), 2500) AS los,
  CASE WHEN los > 0 AND los <= 7 THEN '1-7' WHEN los > 7 AND los <= 28 THEN '8-28'
       WHEN los > 28 AND los <= 2500 THEN '>28' END AS los_band
FROM admissions""")
def k5_length_of_stay(spark, root):
    a = Views(spark, root).admissions
    los = F.least(F.datediff(F.to_date("discharge_time"), F.to_date("adm_time")), F.lit(2500))
    return a.select("adm_id", los.alias("los")).withColumn(
        "los_band", cut("los", [0, 7, 28, 2500], ["1-7", "8-28", ">28"]))


@register("b5_nullify_codes", with_views("signs") + """
SELECT adm_id, CASE WHEN floppy IN ('-1','Empty','empty','__NA','nan','-999') THEN NULL ELSE floppy END AS floppy,
  CASE WHEN convulsions IN ('-1','Empty','empty','__NA','nan','-999') THEN NULL ELSE convulsions END AS convulsions,
  CASE WHEN indrawing IN ('-1','Empty','empty','__NA','nan','-999') THEN NULL ELSE indrawing END AS indrawing,
  CASE WHEN grunting IN ('-1','Empty','empty','__NA','nan','-999') THEN NULL ELSE grunting END AS grunting,
  CASE WHEN jaundice IN ('-1','Empty','empty','__NA','nan','-999') THEN NULL ELSE jaundice END AS jaundice
FROM signs""")
def b5_nullify_codes(spark, root):
    return recode.nullify(Views(spark, root).signs)


_SIGN_COLS = ["floppy", "convulsions", "indrawing", "grunting", "jaundice"]


def _bool_sql(c):
    return (f"CASE WHEN {c} IS NULL OR {c} IN ('-1','Empty','empty','__NA','nan','-999') THEN NULL "
            f"ELSE {c} = 'Yes' END")


@register("b9_yes_no_flags", with_views("signs") + "SELECT adm_id, "
          + ", ".join(f"{_bool_sql(c)} AS {c}" for c in _SIGN_COLS) + " FROM signs")
def b9_yes_no_flags(spark, root):
    return recode.booleans_from_text(Views(spark, root).signs, _SIGN_COLS)


@register("b10_composite_sign", with_views("signs") + f"""
, b AS (SELECT adm_id, {_bool_sql('floppy')} AS f, {_bool_sql('convulsions')} AS c, {_bool_sql('indrawing')} AS i FROM signs)
SELECT adm_id, CASE WHEN f OR c OR i THEN true WHEN (NOT f) OR (NOT c) OR (NOT i) THEN false END AS severe FROM b""")
def b10_composite_sign(spark, root):
    b = recode.booleans_from_text(Views(spark, root).signs, _SIGN_COLS)
    return b.select("adm_id", recode.composite_sign(F.col("floppy"), F.col("convulsions"),
                                                    F.col("indrawing")).alias("severe"))


@register("b11_apgar_recode", with_views("admissions") + """
SELECT adm_id, apgar, CASE apgar WHEN 9 THEN 12 WHEN 8 THEN 10 WHEN 7 THEN 9 WHEN 6 THEN 7 ELSE apgar END AS apgar_recoded
FROM admissions""")
def b11_apgar_recode(spark, root):
    from quarry.functions.columns import value_map
    a = Views(spark, root).admissions
    # The recode table, applied as one simultaneous map.
    return a.select("adm_id", "apgar",
                    value_map("apgar", {9: 12, 8: 10, 7: 9, 6: 7}).cast("int").alias("apgar_recoded"))


@register("b8_ordered_rules", with_views("admissions") + """
SELECT adm_id, CASE WHEN dead THEN 'died' WHEN apgar < 4 THEN 'severe' WHEN weight_kg < 1.5 THEN 'low weight'
  ELSE 'routine' END AS triage FROM admissions""")
def b8_ordered_rules(spark, root):
    a = Views(spark, root).admissions
    # later rules win: 'died' overrides 'severe' overrides 'low weight'
    tri = rules("routine", [(F.col("weight_kg") < 1.5, "low weight"), (F.col("apgar") < 4, "severe"),
                            (F.col("dead"), "died")])
    return a.select("adm_id", tri.alias("triage"))


@register("b12_b13_weight_clean", with_views("admissions") + """
, w AS (SELECT adm_id, CASE WHEN adm_id % 4 = 0 THEN weight_kg * 1000 ELSE weight_kg END AS raw_weight FROM admissions)
SELECT adm_id, raw_weight, CASE WHEN raw_weight > 100 THEN raw_weight / 1000.0 ELSE raw_weight END AS weight_norm,
  CASE WHEN (CASE WHEN raw_weight > 100 THEN raw_weight / 1000.0 ELSE raw_weight END) BETWEEN 0.8 AND 4.5
       THEN (CASE WHEN raw_weight > 100 THEN raw_weight / 1000.0 ELSE raw_weight END) END AS weight_checked,
  least(raw_weight, 4000.0) AS weight_capped
FROM w""")
def b12_b13_weight_clean(spark, root):
    a = Views(spark, root).admissions
    raw = F.when(F.col("adm_id") % 4 == 0, F.col("weight_kg") * 1000).otherwise(F.col("weight_kg"))
    w = a.select("adm_id", raw.alias("raw_weight"))
    norm = recode.grams_to_kg("raw_weight")
    return w.select("adm_id", "raw_weight", norm.alias("weight_norm"),
                    recode.range_or_null(norm, 0.8, 4.5).alias("weight_checked"),
                    F.least(F.col("raw_weight"), F.lit(4000.0)).alias("weight_capped"))


@register("b14_assembled_times", with_views("admissions") + """
, t AS (SELECT adm_id, adm_date, discharge_time,
   CASE WHEN adm_id % 5 = 0 THEN NULL ELSE lpad(CAST(adm_id % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(adm_id % 60 AS VARCHAR), 2, '0') END AS adm_clock
  FROM admissions),
u AS (SELECT *, CAST(strptime(strftime(adm_date, '%Y-%m-%d') || ' ' || coalesce(adm_clock, '09:00'), '%Y-%m-%d %H:%M') AS TIMESTAMP) AS adm_ts FROM t)
SELECT adm_id, adm_ts, round(date_diff('microsecond', adm_ts, discharge_time) / 3600000000.0, 6) AS hours_to_discharge FROM u""")
def b14_assembled_times(spark, root):
    from quarry.functions.columns import hours_between
    a = Views(spark, root).admissions
    clock = F.when(F.col("adm_id") % 5 == 0, F.lit(None)).otherwise(
        F.concat(F.lpad((F.col("adm_id") % 24).cast("string"), 2, "0"), F.lit(":"),
                 F.lpad((F.col("adm_id") % 60).cast("string"), 2, "0")))
    t = a.select("adm_id", "discharge_time", recode.assemble_timestamp("adm_date", clock).alias("adm_ts"))
    return t.select("adm_id", "adm_ts", r6(hours_between("adm_ts", "discharge_time")).alias("hours_to_discharge"))


@register("b15_fluid_dose_class", with_views("admissions") + """
, f AS (SELECT adm_id, weight_kg, (price % 400) AS volume_ml, CAST(6 + adm_id % 19 AS DOUBLE) AS duration_h FROM admissions),
g AS (SELECT *, volume_ml / (weight_kg * 24 / duration_h) AS ml_per_kg_day FROM f)
SELECT adm_id, round(ml_per_kg_day, 6) AS ml_per_kg_day,
  CASE WHEN ml_per_kg_day > 180 THEN 'Over' WHEN ml_per_kg_day < 60 THEN 'Under'
       WHEN ml_per_kg_day IS NOT NULL THEN 'Correct' END AS fluid_class FROM g""")
def b15_fluid_dose_class(spark, root):
    a = Views(spark, root).admissions
    f = a.select("adm_id", "weight_kg", (F.col("price") % 400).alias("volume_ml"),
                 (F.lit(6) + F.col("adm_id") % 19).cast("double").alias("duration_h"))
    rate = F.col("volume_ml") / (F.col("weight_kg") * 24 / F.col("duration_h"))
    return f.select("adm_id", r6(rate).alias("ml_per_kg_day"), recode.dose_class(rate, 60.0, 180.0).alias("fluid_class"))


@register("b16_feed_frequency", with_views("admissions") + """
, f AS (SELECT adm_id, CASE adm_id % 4 WHEN 0 THEN 'hrly' WHEN 1 THEN '2hrly' WHEN 2 THEN ' 3hrly ' ELSE 'stat' END AS freq_text FROM admissions),
g AS (SELECT adm_id, freq_text, regexp_replace(lower(trim(freq_text)), '^hrly$', '1hrly') AS t FROM f)
SELECT adm_id, freq_text, CASE WHEN TRY_CAST(regexp_extract(t, '^(\\d+)\\s*hrly$', 1) AS DOUBLE) > 0
  THEN 24.0 / TRY_CAST(regexp_extract(t, '^(\\d+)\\s*hrly$', 1) AS DOUBLE) END AS feeds_per_day FROM g""")
def b16_feed_frequency(spark, root):
    a = Views(spark, root).admissions
    txt = (F.when(F.col("adm_id") % 4 == 0, "hrly").when(F.col("adm_id") % 4 == 1, "2hrly")
           .when(F.col("adm_id") % 4 == 2, " 3hrly ").otherwise("stat"))
    return a.select("adm_id", txt.alias("freq_text")).withColumn(
        "feeds_per_day", recode.frequency_per_day("freq_text"))


@register("b17_gentamicin_class", with_views("admissions") + """
, d AS (SELECT adm_id, age_days, weight_kg, (price % 50) / 3.0 / weight_kg AS kg,
  CASE WHEN adm_id % 3 = 0 THEN 'Twice per day' ELSE 'Once per day/once daily(OD)' END AS freq FROM admissions),
p AS (SELECT *, CASE WHEN age_days >= 7 THEN 6 WHEN weight_kg >= 2 THEN 4 ELSE 2.4 END AS lo,
  CASE WHEN age_days >= 7 THEN 9 WHEN weight_kg >= 2 THEN 6 ELSE 3.6 END AS hi FROM d)
SELECT adm_id, CASE WHEN kg > hi OR freq <> 'Once per day/once daily(OD)' THEN 'Over' WHEN kg < lo THEN 'Under' ELSE 'Correct' END AS genta_class
FROM p""")
def b17_gentamicin_class(spark, root):
    a = Views(spark, root).admissions
    freq = F.when(F.col("adm_id") % 3 == 0, "Twice per day").otherwise(recode.ONCE_DAILY)
    return a.select("adm_id", recode.gentamicin_class(F.col("age_days"), F.col("weight_kg"), (F.col("price") % 50) / 3.0, freq).alias("genta_class"))


@register("b19_well_documented", with_views("admissions") + """
SELECT adm_id, (discharge_time IS NOT NULL AND weight_kg IS NOT NULL AND (CASE WHEN adm_id % 6 = 0 THEN NULL ELSE apgar END) IS NOT NULL) AS well_documented
FROM admissions""")
def b19_well_documented(spark, root):
    a = Views(spark, root).admissions
    ap = F.when(F.col("adm_id") % 6 == 0, F.lit(None)).otherwise(F.col("apgar"))
    return a.select("adm_id", recode.well_documented(["discharge_time", "weight_kg", ap]).alias("well_documented"))


@register("b20_category_codes", with_views("admissions") + """
SELECT adm_id, priority, CAST(dense_rank() OVER (ORDER BY priority) - 1 AS INTEGER) AS priority_code FROM admissions""")
def b20_category_codes(spark, root):
    a = Views(spark, root).admissions.select("adm_id", "priority")
    return recode.category_codes(a, "priority", "priority_code").select("adm_id", "priority", "priority_code")


@register("b22_b23_dummies", with_views("profiles") + """
SELECT user_id,
  CASE WHEN cadre = 'BUILDING' THEN 1 ELSE 0 END AS cadre_BUILDING,
  CASE WHEN cadre = 'FURNITURE' THEN 1 ELSE 0 END AS cadre_FURNITURE,
  CASE WHEN cadre = 'HOUSEHOLD' THEN 1 ELSE 0 END AS cadre_HOUSEHOLD,
  CASE WHEN cadre = 'MACHINERY' THEN 1 ELSE 0 END AS cadre_MACHINERY,
  CASE WHEN cadre IS NULL THEN 1 ELSE 0 END AS cadre_nan
FROM profiles""")
def b22_b23_dummies(spark, root):
    p = Views(spark, root).profiles.select("user_id", "cadre")
    levels = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return recode.dummies(p, "cadre", levels, reference="AUTOMOBILE", missing_indicator=True).drop("cadre")


@register("b25_price_terciles", with_views("admissions") + """
, e AS (SELECT quantile_cont(price, 0.0) AS e0, quantile_cont(price, 1/3) AS e1, quantile_cont(price, 2/3) AS e2,
          quantile_cont(price, 1.0) AS e3 FROM admissions)
SELECT adm_id, price, CASE WHEN price >= e0 AND price <= e1 THEN 'low' WHEN price > e1 AND price <= e2 THEN 'mid'
  WHEN price > e2 AND price <= e3 THEN 'high' END AS price_band FROM admissions, e""")
def b25_price_terciles(spark, root):
    a = Views(spark, root).admissions.select("adm_id", "price")
    return recode.qcut(a, "price", 3, ["low", "mid", "high"], "price_band")


_AGE_SQL = """CASE WHEN age_days >= 0 AND age_days <= 1 THEN '0-1 day' WHEN age_days > 1 AND age_days <= 7 THEN '2-7 days'
  WHEN age_days > 7 AND age_days <= 28 THEN 'Age >7 days' END"""


@register("b26_age_band", with_views("admissions") + f"""
, a AS (SELECT adm_id, CASE WHEN adm_id % 9 = 0 THEN NULL ELSE age_days END AS age_days, gest_weeks, weight_kg FROM admissions)
SELECT adm_id, coalesce({_AGE_SQL}, CASE WHEN gest_weeks < 28 THEN '0-1 day' END,
  CASE WHEN weight_kg < 1 THEN '0-1 day' END, 'Unknown') AS age_band FROM a""")
def b26_age_band(spark, root):
    a = Views(spark, root).admissions
    age = F.when(F.col("adm_id") % 9 == 0, F.lit(None)).otherwise(F.col("age_days"))
    # Age band labels of the clinical report.
    band = cut(age, [0, 1, 7, 28], ["0-1 day", "2-7 days", "Age >7 days"], include_lowest=True)
    out = F.coalesce(band, F.when(F.col("gest_weeks") < 28, F.lit("0-1 day")),
                     F.when(F.col("weight_kg") < 1, F.lit("0-1 day")), F.lit("Unknown"))
    return a.select("adm_id", out.alias("age_band"))


@register("b27_temperature_band", with_views("admissions") + """
SELECT adm_id, temp_c, CASE WHEN temp_c < 32 THEN 'Severe hypothermia' WHEN temp_c >= 32 AND temp_c <= 35.9 THEN 'Moderate hypothermia'
  WHEN temp_c >= 36 AND temp_c <= 36.4 THEN 'Mild hypothermia' WHEN temp_c >= 36.5 AND temp_c <= 37.5 THEN 'Normal'
  WHEN temp_c > 37.5 THEN 'Fever' END AS temp_band FROM admissions""")
def b27_temperature_band(spark, root):
    a = Views(spark, root).admissions
    t = F.col("temp_c")
    # closed bands with gaps (35.9-36.0, 36.4-36.5 fall through to null)
    band = (F.when(t < 32, "Severe hypothermia").when(t.between(32, 35.9), "Moderate hypothermia")
            .when(t.between(36, 36.4), "Mild hypothermia").when(t.between(36.5, 37.5), "Normal")
            .when(t > 37.5, "Fever"))
    return a.select("adm_id", "temp_c", band.alias("temp_band"))


@register("b28_row_sums", with_views("weights_wide") + """
SELECT adm_id,
  CAST(coalesce(CAST(weight_1 IS NOT NULL AS INTEGER), 0) + CAST(weight_2 IS NOT NULL AS INTEGER) + CAST(weight_3 IS NOT NULL AS INTEGER)
   + CAST(weight_4 IS NOT NULL AS INTEGER) + CAST(weight_5 IS NOT NULL AS INTEGER) + CAST(weight_6 IS NOT NULL AS INTEGER)
   + CAST(weight_7 IS NOT NULL AS INTEGER) AS INTEGER) AS n_measured,
  coalesce(weight_1, 0) + coalesce(weight_2, 0) + coalesce(weight_3, 0) + coalesce(weight_4, 0) + coalesce(weight_5, 0)
   + coalesce(weight_6, 0) + coalesce(weight_7, 0) AS weight_sum,
  round((coalesce(weight_1, 0) + coalesce(weight_2, 0) + coalesce(weight_3, 0) + coalesce(weight_4, 0) + coalesce(weight_5, 0)
   + coalesce(weight_6, 0) + coalesce(weight_7, 0)) / nullif(CAST(weight_1 IS NOT NULL AS INTEGER) + CAST(weight_2 IS NOT NULL AS INTEGER)
   + CAST(weight_3 IS NOT NULL AS INTEGER) + CAST(weight_4 IS NOT NULL AS INTEGER) + CAST(weight_5 IS NOT NULL AS INTEGER)
   + CAST(weight_6 IS NOT NULL AS INTEGER) + CAST(weight_7 IS NOT NULL AS INTEGER), 0), 6) AS weight_mean
FROM weights_wide""")
def b28_row_sums(spark, root):
    from quarry.functions.columns import row_count_nonnull
    w = Views(spark, root).weights_wide
    cols = [f"weight_{i}" for i in range(1, 8)]
    return w.select("adm_id", row_count_nonnull(cols).alias("n_measured"),
                    row_sum(cols, as_int=False).alias("weight_sum"), r6(row_mean(cols)).alias("weight_mean"))


@register("b30_b31_log_and_z", with_views("admissions") + """
, s AS (SELECT avg(price) AS m, stddev_pop(price) AS sp, stddev_samp(price) AS ss FROM admissions)
SELECT adm_id, round(ln(coalesce(CASE WHEN adm_id % 8 = 0 THEN NULL ELSE weight_kg END, 0.01)), 6) AS log_weight,
  round((price - m) / sp, 6) AS price_z_pop, round((price - m) / ss, 6) AS price_z_samp
FROM admissions, s""")
def b30_b31_log_and_z(spark, root):
    a = Views(spark, root).admissions
    w = F.when(F.col("adm_id") % 8 == 0, F.lit(None)).otherwise(F.col("weight_kg"))
    a = a.select("adm_id", "price", r6(recode.log_floor(w)).alias("log_weight"))
    z0 = recode.standardise(a, ["price"], ddof=0, suffix="_z_pop")
    z1 = recode.standardise(z0, ["price"], ddof=1, suffix="_z_samp")
    return z1.select("adm_id", "log_weight", r6("price_z_pop").alias("price_z_pop"),
                     r6("price_z_samp").alias("price_z_samp"))


@register("b33_unit_formula", with_views("admissions") + """
SELECT adm_id, round(temp_c * 10, 6) AS temp_tenths, round(temp_c * 10 * 0.1 * (9.0 / 5.0) + 32.0, 6) AS temp_f FROM admissions""")
def b33_unit_formula(spark, root):
    a = Views(spark, root).admissions
    tenths = F.col("temp_c") * 10
    return a.select("adm_id", r6(tenths).alias("temp_tenths"), r6(tenths * 0.1 * (9.0 / 5.0) + 32.0).alias("temp_f"))


# Documentation sections and their fields (from the fixture view).
SECTIONS = {
    "admission": ["adm_time", "hospital", "ward"],
    "vitals": ["temp_c", "weight_kg", "apgar_doc"],
    "outcome": ["discharge_time", "status"],
    "monitoring": ["dx_sepsis", "dx_jaundice"],
}


def _doc_scores(v: Views):
    a = v.admissions.withColumn("apgar_doc", F.when(F.col("adm_id") % 6 == 0, F.lit(None)).otherwise(F.col("apgar")))
    return recode.section_scores(a, SECTIONS, conditional={"outcome": F.col("status") != "O"},
                                 summed=["monitoring"])


_DOC_SQL = """
, a AS (SELECT *, CASE WHEN adm_id % 6 = 0 THEN NULL ELSE apgar END AS apgar_doc FROM admissions),
s AS (SELECT adm_id, hospital, adm_date,
  CAST(adm_time IS NOT NULL AS INTEGER) + CAST(hospital IS NOT NULL AS INTEGER) + CAST(ward IS NOT NULL AS INTEGER) AS admission_score, 3 AS admission_denom,
  CAST(temp_c IS NOT NULL AS INTEGER) + CAST(weight_kg IS NOT NULL AS INTEGER) + CAST(apgar_doc IS NOT NULL AS INTEGER) AS vitals_score, 3 AS vitals_denom,
  CASE WHEN status <> 'O' THEN CAST(discharge_time IS NOT NULL AS INTEGER) + CAST(status IS NOT NULL AS INTEGER) END AS outcome_score,
  CASE WHEN status <> 'O' THEN 2 END AS outcome_denom,
  coalesce(CAST(dx_sepsis AS INTEGER), 0) + coalesce(CAST(dx_jaundice AS INTEGER), 0) AS monitoring_score, 2 AS monitoring_denom
 FROM a)"""


@register("b29_documentation_scores", with_views("admissions") + _DOC_SQL + """
SELECT adm_id, admission_score, admission_denom, vitals_score, vitals_denom, outcome_score, outcome_denom,
  monitoring_score, monitoring_denom FROM s""")
def b29_documentation_scores(spark, root):
    cols = ["adm_id"] + [f"{s}_{k}" for s in SECTIONS for k in ("score", "denom")]
    return _doc_scores(Views(spark, root)).select(*cols)


@register("e15_documentation_rate", with_views("admissions") + _DOC_SQL + """
, l AS (SELECT hospital, CAST(date_trunc('quarter', adm_date) AS DATE) AS quarter, 'admission' AS section, admission_score AS score, admission_denom AS denom FROM s
  UNION ALL SELECT hospital, CAST(date_trunc('quarter', adm_date) AS DATE), 'vitals', vitals_score, vitals_denom FROM s
  UNION ALL SELECT hospital, CAST(date_trunc('quarter', adm_date) AS DATE), 'outcome', outcome_score, outcome_denom FROM s
  UNION ALL SELECT hospital, CAST(date_trunc('quarter', adm_date) AS DATE), 'monitoring', monitoring_score, monitoring_denom FROM s)
SELECT hospital, quarter, section, CAST(sum(score) AS BIGINT) AS score, CAST(sum(denom) AS BIGINT) AS denom,
  round(sum(score) / sum(denom), 6) AS rate FROM l GROUP BY 1, 2, 3""")
def e15_documentation_rate(spark, root):
    s = _doc_scores(Views(spark, root)).withColumn("quarter", quarter_start("adm_date"))
    long = reshape.unpivot_pairs(s, ["hospital", "quarter"], {k: (f"{k}_score", f"{k}_denom") for k in SECTIONS},
                                 "section", ("score", "denom"))
    g = long.groupBy("hospital", "quarter", "section").agg(F.sum("score").alias("score"), F.sum("denom").alias("denom"))
    return g.select("hospital", "quarter", "section", F.col("score").cast("long").alias("score"),
                    F.col("denom").cast("long").alias("denom"), r6(F.col("score") / F.col("denom")).alias("rate"))


@register("e17_missingness", with_views("signs") + """
SELECT * FROM (
  SELECT 'floppy' AS "column", CAST(count(*) - count(floppy) AS BIGINT) AS n_missing, round((count(*) - count(floppy)) * 100.0 / count(*), 6) AS pct_missing FROM signs UNION ALL
  SELECT 'convulsions', CAST(count(*) - count(convulsions) AS BIGINT), round((count(*) - count(convulsions)) * 100.0 / count(*), 6) FROM signs UNION ALL
  SELECT 'indrawing', CAST(count(*) - count(indrawing) AS BIGINT), round((count(*) - count(indrawing)) * 100.0 / count(*), 6) FROM signs UNION ALL
  SELECT 'grunting', CAST(count(*) - count(grunting) AS BIGINT), round((count(*) - count(grunting)) * 100.0 / count(*), 6) FROM signs UNION ALL
  SELECT 'jaundice', CAST(count(*) - count(jaundice) AS BIGINT), round((count(*) - count(jaundice)) * 100.0 / count(*), 6) FROM signs)""")
def e17_missingness(spark, root):
    return agg.missingness(Views(spark, root).signs, _SIGN_COLS)


@register("t18_funnel_limits", with_views("admissions") + """
, g AS (SELECT hospital, count(*) AS n, sum(CAST(dead AS INTEGER)) AS d FROM admissions GROUP BY 1),
p AS (SELECT sum(d) / sum(n) AS p0 FROM g)
SELECT hospital, n, CAST(d AS BIGINT) AS events, round(d / n, 6) AS rate, round(p0, 6) AS pooled,
  round(p0 - 1.959964 * sqrt(p0 * (1 - p0) / n), 6) AS lo95, round(p0 + 1.959964 * sqrt(p0 * (1 - p0) / n), 6) AS hi95,
  round(p0 - 3.090232 * sqrt(p0 * (1 - p0) / n), 6) AS lo998, round(p0 + 3.090232 * sqrt(p0 * (1 - p0) / n), 6) AS hi998
FROM g, p""")
def t18_funnel_limits(spark, root):
    from quarry.operators import stats
    return stats.funnel_limits(Views(spark, root).admissions, "hospital", "dead")
