"""Synthetic minority oversampling: plain, borderline, adaptive, and from the
support vectors of a linear margin.

All of them draw new rows between a seed (a minority row) and one of its ``k``
nearest minority neighbours (exact, ``neighbours.py``).  They differ in which
seeds draw how often.  ``apportion`` deals the number of wanted rows over
weighted seeds so that the counts add up exactly.  Draws come from a digest of
the seed's key and the draw's number, so a lost task draws the same again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.ordered import running_index
from quarry.operators.neighbours import nearest_neighbours
from quarry.operators.staged import written

CHUNK = 4096              # draws of a seed that are listed in one row


def apportion(seeds: DataFrame, key: str, weight: str, total: int, name: str = "share") -> DataFrame:
    """``seeds`` with ``name`` long: ``total`` dealt in proportion to the
    non-negative integer ``weight`` by largest remainders (ties to the smaller
    key), exactly.  Null weights count as 0; if all are 0 every share is 0."""
    w = F.coalesce(F.col(weight), F.lit(0)).cast("decimal(18,0)")
    whole = int(seeds.agg(F.sum(w)).first()[0] or 0)
    if not whole:
        return seeds.withColumn(name, F.lit(0).cast("long"))
    product = w * F.lit(total).cast("decimal(18,0)")
    quota = seeds.withColumn("__floor", _div(product, whole)).withColumn(
        "__rest", product - F.col("__floor") * F.lit(whole).cast("decimal(18,0)"))
    quota = written(quota)
    left = total - int(quota.agg(F.sum("__floor")).first()[0])
    ranked = running_index(quota.select(key, "__rest"), [], [F.desc("__rest"), F.col(key)], "__place").select(key, "__place")
    return quota.join(ranked, key).withColumn(name, (F.col("__floor") + F.when(F.col("__place") <= left, 1).otherwise(0)).cast("long")).drop(
        "__floor", "__rest", "__place")


def _div(product: Column, whole: int) -> Column:
    """Whole quotient of exact decimals."""
    by = F.lit(whole).cast("decimal(18,0)")
    return ((product - F.pmod(product, by)) / by).cast("decimal(38,0)")


def _draw(key: Column, number: Column) -> tuple[Column, Column]:
    """Two numbers in [0, 2^32) from a digest of key and draw."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), number.cast("string")).cast("binary"))
    return tuple(F.conv(F.substring(digest, a, 8), 16, 10).cast("long") for a in (1, 9))


def _made(seeds: DataFrame, minority: DataFrame, near: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """The drawn rows of ``seeds`` (key, features, share, step): key, ``draw``
    long and the features.  Both joins are on unique keys; a seed's draws are
    listed in chunks, so a seed that draws a third of all rows is dealt."""
    listed = near.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "neighbour"))), lambda x: x["neighbour"]).alias("__near"))
    own = seeds.where("share > 0").join(listed, key, "left")
    parts = own.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("share") - 1) / CHUNK))))
    parts = parts.repartition(F.col(key), F.col("__chunk"))
    last = F.least(F.col("share"), (F.col("__chunk") + 1) * CHUNK) - 1
    drawn = parts.withColumn("draw", F.explode(F.sequence(F.col("__chunk") * CHUNK, last)))
    pick, part = _draw(F.col(key), F.col("draw"))
    size = F.size("__near")
    drawn = drawn.withColumn("__to", F.when(size > 0, F.get("__near", F.pmod(pick, F.when(size > 0, size))))).withColumn("__part", part / F.lit(2.0 ** 32))
    other = minority.select(F.col(key).alias("__to"), *[F.col(c).cast("double").alias(f"__to_{c}") for c in features])
    met = drawn.join(other, "__to", "left")
    # a seed without any neighbour repeats itself
    new = [(F.col(c).cast("double") + F.col("step") * F.col("__part") * (F.coalesce(F.col(f"__to_{c}"), F.col(c).cast("double")) - F.col(c).cast("double"))).alias(c)
           for c in features]
    return met.select(F.col(key), F.col("draw").cast("long").alias("draw"), *new)


def _classes(df: DataFrame, key: str, label: str, features: Sequence[str], minority: int) -> tuple[DataFrame, int]:
    """The complete rows (key, ``y`` true for the minority, features), written
    once, and how many the minority lacks."""
    rows = df.select(F.col(key).cast("long").alias(key), (F.col(label) == minority).alias("y"), *[F.col(c).cast("double").alias(c) for c in features])
    rows = written(rows.dropna())
    n = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    return rows, max(0, n.get(False, 0) - n.get(True, 0))


def _majority_near(rows: DataFrame, key: str, features: Sequence[str], m: int) -> DataFrame:
    """Minority rows with ``against``: how many of the ``m`` nearest rows of
    all are of the majority (and ``of``: of how many)."""
    near = nearest_neighbours(rows.where("y"), rows, key, features, m)
    other = rows.select(F.col(key).alias("neighbour"), F.col("y").alias("same"))
    return near.join(other, "neighbour").groupBy(key).agg(F.sum((~F.col("same")).cast("int")).alias("against"), F.count("*").alias("of"))


def _drawn(rows: DataFrame, seeds: DataFrame, key: str, features: Sequence[str], k: int) -> DataFrame:
    minority = rows.where("y")
    near = nearest_neighbours(seeds.where("share > 0"), minority, key, features, k)
    return _made(seeds, minority, near, key, features)


def smote(df: DataFrame, key: str, label: str, features: Sequence[str], minority: int = 1, k: int = 10) -> DataFrame:
    """As many new minority rows as it lacks to the size of the others,
    every minority row drawing equally often (largest remainders): seed
    ``key``, ``draw`` from 0 and the features.

    Keys are unique integers; rows without a key, a label or a feature take
    no part.  A lone minority row repeats itself; nothing is made if the
    minority is none or not the smaller class."""
    rows, lack = _classes(df, key, label, features, minority)
    seeds = apportion(rows.where("y").withColumn("__w", F.lit(1)), key, "__w", lack).withColumn("step", F.lit(1.0))
    return _drawn(rows, seeds, key, features, k)


def borderline_smote(df: DataFrame, key: str, label: str, features: Sequence[str], minority: int = 1, k: int = 10, m: int = 10) -> DataFrame:
    """Like ``smote``, but only rows in danger draw: at least half of
    their ``m`` nearest rows, though not all, are of the majority."""
    rows, lack = _classes(df, key, label, features, minority)
    danger = _majority_near(rows, key, features, m).where("2 * against >= of AND against < of").select(key, F.lit(1).alias("__w"))
    seeds = apportion(rows.where("y").join(danger, key), key, "__w", lack).withColumn("step", F.lit(1.0))
    return _drawn(rows, seeds, key, features, k)


def adaptive_sampling(df: DataFrame, key: str, label: str, features: Sequence[str], minority: int = 1, k: int = 10) -> DataFrame:
    """Like ``smote``, but a row draws in proportion to the majority rows
    among its ``k`` nearest rows."""
    rows, lack = _classes(df, key, label, features, minority)
    hard = _majority_near(rows, key, features, k).where("against > 0").select(key, F.col("against").alias("__w"))
    seeds = apportion(rows.where("y").join(hard, key), key, "__w", lack).withColumn("step", F.lit(1.0))
    return _drawn(rows, seeds, key, features, k)


def margin_smote(df: DataFrame, key: str, label: str, features: Sequence[str], minority: int = 1, k: int = 10, m: int = 10,
                 out_step: float = 0.5) -> DataFrame:
    """Seeds are the minority rows at or inside the margin of a linear
    support vector classifier, except noise (all ``m`` nearest rows are of the
    majority).  Seeds in danger draw towards a neighbour, safe ones away from
    it (``out_step`` as far)."""
    rows, lack = _classes(df, key, label, features, minority)
    if not lack or rows.where("y").isEmpty():
        return _made(rows.where("false").withColumns({"share": F.lit(0).cast("long"), "step": F.lit(1.0)}), rows.where("y"),
                     rows.select(key, F.lit(1).alias("rank"), F.col(key).alias("neighbour")).where("false"), key, features)
    vectors = VectorAssembler(inputCols=list(features), outputCol="__raw").transform(rows.withColumn("label", F.col("y").cast("double")))
    scaled = StandardScaler(inputCol="__raw", outputCol="features", withMean=True).fit(vectors).transform(vectors)
    fit = LinearSVC(maxIter=50, regParam=0.01).fit(scaled)
    margin = vector_to_array(F.col("rawPrediction"))[1]
    support = fit.transform(scaled.where("y")).where(margin <= 1).select(key)
    kind = _majority_near(rows, key, features, m).where("against < of")
    chosen = support.join(kind, key).select(key, F.lit(1).alias("__w"), F.when(F.expr("2 * against >= of"), 1.0).otherwise(-out_step).alias("step"))
    seeds = apportion(rows.where("y").join(chosen, key), key, "__w", lack)
    return _drawn(rows, seeds, key, features, k)
