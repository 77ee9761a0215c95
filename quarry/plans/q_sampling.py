"""Neighbour and oversampling queries over the clinical admissions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.columns import r6
from quarry.operators import neighbours, sampling
from quarry.plans.registry import register
from quarry.plans.views import Views
from quarry.plans.views_sql import with_views

FEATURES = ["weight_kg", "gest_weeks", "apgar", "temp_c"]

_NEAR_SQL = ", " + """a AS (
  SELECT adm_id AS id, dx_asphyxia AS y, CAST(weight_kg AS DOUBLE) AS f1, CAST(gest_weeks AS DOUBLE) AS f2, CAST(apgar AS DOUBLE) AS f3,
         CAST(temp_c AS DOUBLE) AS f4 FROM admissions
  WHERE dx_asphyxia IS NOT NULL AND weight_kg IS NOT NULL AND gest_weeks IS NOT NULL AND apgar IS NOT NULL AND temp_c IS NOT NULL),
pairs AS (
  SELECT s.id, n.id AS neighbour, n.y AS same,
         (s.f1 - n.f1) * (s.f1 - n.f1) + (s.f2 - n.f2) * (s.f2 - n.f2) + (s.f3 - n.f3) * (s.f3 - n.f3) + (s.f4 - n.f4) * (s.f4 - n.f4) AS d
  FROM a s JOIN a n ON s.y AND s.id <> n.id),
any_near AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, neighbour) <= 10),
near AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, neighbour) AS rank FROM pairs WHERE same QUALIFY rank <= 10),
lack AS (SELECT greatest(0, count(*) FILTER (NOT y) - count(*) FILTER (y)) AS t FROM a)"""

_DRAW_SQL = """,
quota AS (SELECT id, w * t // sum(w) OVER () AS low, w * t % sum(w) OVER () AS rest, t FROM seeds CROSS JOIN lack),
shares AS (SELECT id, CAST(low + CASE WHEN row_number() OVER (ORDER BY rest DESC, id) <= t - sum(low) OVER () THEN 1 ELSE 0 END AS BIGINT) AS share FROM quota),
draws AS (SELECT id, unnest(range(share)) AS draw FROM shares),
digests AS (SELECT id, draw, md5(id || ':' || draw) AS h FROM draws),
picks AS (SELECT id, draw, ('0x' || substr(h, 1, 8))::BIGINT % 10 + 1 AS rank, ('0x' || substr(h, 9, 8))::BIGINT / 4294967296.0 AS part FROM digests)
SELECT p.id AS adm_id, p.draw, """ + ", ".join(
    f"round(s.f{i} + p.part * (n.f{i} - s.f{i}), 6) AS {c}" for i, c in enumerate(FEATURES, 1)) + """
FROM picks p JOIN near USING (id, rank) JOIN a s ON s.id = p.id JOIN a n ON n.id = near.neighbour"""


def _admissions(spark, root):
    a = Views(spark, root).admissions
    return a.select("adm_id", a.dx_asphyxia.cast("int").alias("asphyxia"), *FEATURES)


def _rounded(made):
    return made.select("adm_id", "draw", *[r6(c).alias(c) for c in FEATURES])


@register("o10_nearest_neighbours", with_views("admissions") + _NEAR_SQL + """
SELECT id AS adm_id, CAST(rank AS INTEGER) AS rank, neighbour, round(d, 6) AS distance FROM near""")
def o10_nearest_neighbours(spark, root):
    """The ten nearest minority admissions of every minority admission."""
    rows = _admissions(spark, root).where("asphyxia = 1")
    near = neighbours.nearest_neighbours(rows, rows, "adm_id", FEATURES, 10)
    return near.withColumn("distance", r6("distance"))


@register("o10_smote", with_views("admissions") + _NEAR_SQL + ", seeds AS (SELECT id, 1 AS w FROM a WHERE y)" + _DRAW_SQL)
def o10_smote(spark, root):
    """New rows that bring the smaller outcome to the size of the other."""
    return _rounded(sampling.smote(_admissions(spark, root), "adm_id", "asphyxia", FEATURES))


@register("o11_borderline_smote", with_views("admissions") + _NEAR_SQL + """,
seeds AS (SELECT id, 1 AS w FROM (SELECT id, count(*) FILTER (NOT same) AS against, count(*) AS n FROM any_near GROUP BY id)
          WHERE 2 * against >= n AND against < n)""" + _DRAW_SQL)
def o11_borderline_smote(spark, root):
    return _rounded(sampling.borderline_smote(_admissions(spark, root), "adm_id", "asphyxia", FEATURES))


@register("o11_adaptive_sampling", with_views("admissions") + _NEAR_SQL + """,
seeds AS (SELECT id, w FROM (SELECT id, count(*) FILTER (NOT same) AS w FROM any_near GROUP BY id) WHERE w > 0)""" + _DRAW_SQL)
def o11_adaptive_sampling(spark, root):
    return _rounded(sampling.adaptive_sampling(_admissions(spark, root), "adm_id", "asphyxia", FEATURES))


@register("o11_margin_smote")
def o11_margin_smote(spark, root):
    """Seeds from the margin of a linear classifier (unit-tested; SQL has no
    classifier)."""
    return _rounded(sampling.margin_smote(_admissions(spark, root), "adm_id", "asphyxia", FEATURES))


KS = [1, 4, 8, 16, 32]


@register("o12_nearest_neighbour_grid", with_views("admissions") + """, a AS (
  SELECT adm_id AS id, dx_asphyxia AS y, CAST(weight_kg AS DOUBLE) AS f1, CAST(gest_weeks AS DOUBLE) AS f2, CAST(apgar AS DOUBLE) AS f3,
         CAST(temp_c AS DOUBLE) AS f4 FROM admissions
  WHERE dx_asphyxia IS NOT NULL AND weight_kg IS NOT NULL AND gest_weeks IS NOT NULL AND apgar IS NOT NULL AND temp_c IS NOT NULL),
pairs AS (
  SELECT s.id, s.y, CAST(n.y AS INTEGER) AS vote, n.id AS neighbour,
         (s.f1 - n.f1) * (s.f1 - n.f1) + (s.f2 - n.f2) * (s.f2 - n.f2) + (s.f3 - n.f3) * (s.f3 - n.f3) + (s.f4 - n.f4) * (s.f4 - n.f4) AS d
  FROM a s JOIN a n ON s.id % 10 = 0 AND n.id % 10 <> 0),
near AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, neighbour) AS rank FROM pairs QUALIFY rank <= 32),
votes AS (SELECT id, y, k, avg(vote) FILTER (rank <= k) AS p FROM near CROSS JOIN (SELECT unnest([1, 4, 8, 16, 32]) AS k) GROUP BY id, y, k)
SELECT CAST(k AS INTEGER) AS k, count(*) AS n, round(avg(CAST((p >= 0.5) = y AS INTEGER)), 6) AS accuracy,
       round(avg((p - CAST(y AS INTEGER)) * (p - CAST(y AS INTEGER))), 6) AS brier FROM votes GROUP BY k""")
def o12_nearest_neighbour_grid(spark, root):
    """The neighbour classifiers of the grid, fitted on nine tenths of the
    admissions and scored on the others."""
    a = _admissions(spark, root)
    votes = neighbours.neighbour_votes(a.where("adm_id % 10 <> 0"), a.where("adm_id % 10 = 0"), "adm_id", "asphyxia", FEATURES, KS)
    return votes.groupBy("k").agg(F.count("*").alias("n"), r6(F.avg(((F.col("p") >= 0.5).cast("int") == F.col("label")).cast("int"))).alias("accuracy"),
                                  r6(F.avg((F.col("p") - F.col("label")) ** 2)).alias("brier"))
