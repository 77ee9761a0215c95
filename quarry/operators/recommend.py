"""Recommendation operators: co-rater cosine similarity to targets, ALS.

Similarity is computed *to a set of targets*, never as all pairs within a
user: the targets' ratings are joined to the full ratings on the shared
rater, so each rating row meets each target it co-occurs with once and the
work is linear in the data for a bounded target set.  A user holding a
third of all ratings therefore costs a third of the rows, not the square.
The targets' ratings are broadcast after a size check; beyond the bound
the join shuffles and AQE splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import r6
from quarry.functions.ordered import running_index
from quarry.operators.staged import written


def similarity_to_targets(ratings: DataFrame, targets: DataFrame, entity: str, rater: str,
                          rating: str = "rating") -> DataFrame:
    """Cosine over co-raters (raw ratings, not centred) between each
    target entity and every other entity, with the co-rater count.

    ``targets`` holds one column named like ``entity``.  Output:
    (target, partner, n_common, score)."""
    t = ratings.join(targets.select(F.col(entity)), entity, "left_semi") \
        .select(F.col(entity).alias("target"), F.col(rater), F.col(rating).alias("_r1"))
    other = ratings.select(F.col(entity).alias("partner"), F.col(rater), F.col(rating).alias("_r2"))
    pairs = other.join(t, rater).filter(F.col("partner") != F.col("target"))
    g = pairs.groupBy("target", "partner").agg(
        F.count(F.lit(1)).alias("n_common"),
        F.sum(F.col("_r1") * F.col("_r2")).alias("_xy"),
        F.sum(F.col("_r1") * F.col("_r1")).alias("_xx"),
        F.sum(F.col("_r2") * F.col("_r2")).alias("_yy"))
    return g.select("target", "partner", "n_common", r6(F.col("_xy") / F.sqrt(F.col("_xx") * F.col("_yy"))).alias("score"))


def similar_to_target(ratings: DataFrame, targets: DataFrame, entity: str, rater: str,
                      min_score: float, min_common: int, k: int = 5) -> DataFrame:
    """Partners above the score and co-count thresholds, top ``k`` per
    target by score (partner id breaks ties)."""
    from pyspark.sql import Window
    s = similarity_to_targets(ratings, targets, entity, rater)
    s = s.filter((F.col("score") > min_score) & (F.col("n_common") > min_common))
    w = Window.partitionBy("target").orderBy(F.desc("score"), F.col("partner"))
    return s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


HOT = 4096                # entities of a rater above which it is busy; entities of one list
LOAD = 1 << 20            # listed partners that one row gathers, on average


def similar_pairs(ratings: DataFrame, entity: str, rater: str, min_score: float, min_common: int, rating: str = "rating") -> DataFrame:
    """Every pair of entities with more than ``min_common`` co-raters
    and a cosine over them above ``min_score``: (a, b, n_common, score), a < b.

    A pair needs t = min_common + 1 common raters.  Every rater's entities are
    listed, every entity gathers the lists of its raters, and a partner listed
    often enough is a candidate: no pair is a row of a shuffle.  An entity
    leaves out its busiest raters, as many as it has of more than ``HOT``
    entities, at most t - 1.  With the raters in one order, the busiest last, a
    pair that leaves out at most s raters on either side still meets t - s
    times, so a rater of a third of all rows lists nothing when t > 1.
    Lists are cut to ``HOT`` entities, and the partners of an entity that
    gathers more than ``LOAD`` are dealt by hash.  Candidates are counted
    exactly.  Each (entity, rater) is one row (several: averaged); rows with a
    null take no part.  With ``min_common`` 0 every pair with a common rater is
    asked for and formed."""
    t = max(1, min_common + 1)
    r = ratings.select(F.col(entity).alias("e"), F.col(rater).alias("u"), F.col(rating).cast("double").alias("r")).dropna()
    r = written(r.groupBy("e", "u").agg(F.avg("r").alias("r")))
    raters = r.groupBy("u").agg(F.count(F.lit(1)).alias("f"))
    enough = r.groupBy("e").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= t)
    kept = written(r.join(enough, "e").join(raters, "u").select("e", "u", "r", "n", "f"))
    # how many busy raters an entity leaves out, and which
    busy = written(kept.where(F.col("f") > HOT).select("e", "u", "f"))
    out = busy.groupBy("e").agg(F.least(F.count(F.lit(1)), F.lit(t - 1)).cast("int").alias("s"))
    late = running_index(busy, ["e"], [F.desc("f"), F.desc("u")], "pos").where(F.col("pos") <= t - 1).select("e", "u")
    mine = kept.select("e", "u", "f").join(late, ["e", "u"], "left_anti").join(out, "e", "left").select("e", "u", "f", F.coalesce("s", F.lit(0)).alias("s"))
    mine = written(mine)
    place = F.pmod(F.xxhash64("e"), F.ceil(F.col("f") / HOT))
    lists = mine.groupBy("u", F.col("s").alias("s_b"), place.alias("place")).agg(F.collect_list("e").alias("of"))
    load = mine.groupBy("e").agg(F.ceil(F.sum("f") / LOAD).alias("parts")).where(F.col("parts") > 1)
    met = mine.select(F.col("e").alias("a"), "u", "s").join(lists, "u")
    met = met.select("a", F.greatest("s", "s_b").alias("s"), F.filter("of", lambda b: b > F.col("a")).alias("of")).where(F.size("of") > 0)
    dealt = met.join(load.withColumnRenamed("e", "a"), "a", "left").withColumn("part", F.explode(F.when(
        F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))))
    dealt = dealt.withColumn("of", F.when(F.col("parts").isNull(), F.col("of")).otherwise(
        F.filter("of", lambda b: F.pmod(F.xxhash64(b), F.col("parts")) == F.col("part"))))
    gathered = dealt.groupBy("a", "s", "part").agg(F.sort_array(F.flatten(F.collect_list("of"))).alias("of"))
    # a partner that is listed t - s times: equal to the one t - s - 1 places before
    back = F.lit(t - 1) - F.col("s")
    often = F.filter("of", lambda b, i: (i >= back) & (F.get("of", i - back) == b))
    found = gathered.select("a", F.explode(F.array_distinct(often)).alias("b"))
    likely = written(found.distinct()).join(enough.select(F.col("e").alias("a"), F.col("n").alias("n_a")), "a").join(
        enough.select(F.col("e").alias("b"), F.col("n").alias("n_b")), "b")
    first = F.col("n_a") <= F.col("n_b")
    likely = likely.select("a", "b", F.when(first, F.col("a")).otherwise(F.col("b")).alias("e"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("o"))
    one = kept.select("e", "u", F.col("r").alias("x"))
    other = kept.select(F.col("e").alias("o"), "u", F.col("r").alias("y"))
    g = likely.join(one, "e").join(other, ["o", "u"]).groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("n_common"), F.sum(F.col("x") * F.col("y")).alias("xy"),
        F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("y") * F.col("y")).alias("yy"))
    norm = F.sqrt(F.col("xx") * F.col("yy"))
    g = g.where(F.col("n_common") >= t).select("a", "b", "n_common", r6(F.col("xy") / F.nullif(norm, F.lit(0.0))).alias("score"))
    return g.where(F.col("score") > min_score)


def most_rated(ratings: DataFrame, entity: str, k: int = 1) -> DataFrame:
    """The ``k`` entities with the most ratings (smaller id on ties)."""
    c = ratings.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"))
    return c.orderBy(F.desc("_n"), F.col(entity)).limit(k).select(entity)


def fit_als(ratings: DataFrame, user: str, item: str, rating: str = "rating", rank: int = 10,
            max_iter: int = 20, reg: float = 0.1, seed: int = 42, checkpoint_interval: int = 5, blocks: int = 3):
    """Alternating least squares (rank 10, 20 iterations by default), the
    factors of ``pyspark.ml``'s ALS with less shuffle (see ``als``): an
    iteration sends each factor at most ``blocks`` times, by that many tasks.
    Lineage is cut every ``checkpoint_interval`` iterations into the
    session's checkpoint folder."""
    from quarry.operators import als
    return als.fit(ratings, user, item, rating, rank, max_iter, reg, seed, checkpoint_interval, blocks)


def recommend_for(model, users: DataFrame, k: int = 10) -> DataFrame:
    """Top-k items for the given users, exploded to rows."""
    recs = model.recommendForUserSubset(users, k)
    ucol = model.getUserCol() if hasattr(model, "getUserCol") else users.columns[0]
    return (recs.select(ucol, F.posexplode("recommendations").alias("pos", "rec"))
            .select(ucol, (F.col("pos") + 1).alias("rank"), F.col("rec").getField(model.getItemCol()).alias("item"),
                    F.col("rec.rating").alias("predicted")))
