"""Learner-sequence operators: session roll-ups, next-try lookups,
completion, funnels, drop-out depth, pre/post scores, weighted splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import r6


def session_rollup(att: DataFrame, user: str = "user_id", session: str = "session") -> DataFrame:
    """Per (user, session) total time, help count, tries, questions and
    first-try score."""
    return att.groupBy(user, session).agg(
        r6(F.sum("time_s")).alias("total_time"),
        F.sum(F.when(F.col("feedback") == 1, 1).otherwise(0)).alias("help_count"),
        F.count(F.lit(1)).alias("n_tries"),
        F.countDistinct("question").alias("n_questions"),
        F.sum(F.when(F.col("try_no") == 1, F.col("correct")).otherwise(0)).alias("score"),
    )


def next_try_success(att: DataFrame, keys: Sequence[str], try_col: str = "try_no",
                     outcome: str = "correct") -> DataFrame:
    """Attach the outcome of the same key at try + 1 (an equi-join, not
    ``lead``, so a missing try yields null instead of a later one)."""
    nxt = att.select(*keys, (F.col(try_col) - 1).alias(try_col), F.col(outcome).alias("next_" + outcome))
    return att.join(nxt, [*keys, try_col], "left")


def completion_flags(att: DataFrame, n_questions: int, user: str = "user_id",
                     session: str = "session") -> DataFrame:
    """A session is complete when it reaches ``n_questions`` distinct
    questions; per user the number of completed plays."""
    s = att.groupBy(user, session).agg(F.countDistinct("question").alias("_q"))
    s = s.withColumn("session_complete", F.col("_q") >= n_questions)
    plays = s.groupBy(user).agg(F.sum(F.col("session_complete").cast("int")).alias("complete_plays"))
    return s.join(plays, user, "left").drop("_q")


def adoption_funnel(flags: DataFrame, user: str = "user_id") -> DataFrame:
    """Users who started, finished once, finished at least twice (one
    pass of conditional distinct counts)."""
    per = flags.groupBy(user).agg(F.max("complete_plays").alias("p"))
    return per.agg(F.count(F.lit(1)).alias("started"),
                   F.count(F.when(F.col("p") >= 1, 1)).alias("finished_once"),
                   F.count(F.when(F.col("p") >= 2, 1)).alias("finished_repeatedly"))


def dropout_depth(att: DataFrame, finished: DataFrame, user: str = "user_id") -> DataFrame:
    """For users who never finished, how far they got: questions
    reached, time spent and the share right on the first try."""
    left = att.join(finished.select(user), user, "left_anti")
    return left.groupBy(user).agg(
        F.countDistinct("question").alias("questions_reached"),
        r6(F.sum("time_s")).alias("time_spent"),
        r6(F.sum(F.when(F.col("try_no") == 1, F.col("correct")).otherwise(0))
           / F.count(F.when(F.col("try_no") == 1, 1))).alias("first_try_share"),
    )


def weighted_sample_key(key: Column, weight: Column) -> Column:
    """Efraimidis-Spirakis key -ln(u)/w with u from md5(key), so the
    draw is reproducible and needs no driver-side random state."""
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("double")
    u = (h + 1.0) / (4294967296.0 + 1.0)
    return -F.log(u) / weight


def weighted_share(df: DataFrame, order: Sequence[str], share: float) -> DataFrame:
    """The first ``share`` of all rows under ``order`` (a total order),
    by distributed row numbers."""
    from quarry.functions.ordered import running_index
    from quarry.operators.aggregate import with_total
    numbered = with_total(running_index(df, [], list(order), "_i"), df.agg(F.count(F.lit(1)).alias("_n")))
    return numbered.where(F.col("_i") <= F.floor(F.col("_n") * share)).drop("_i", "_n")
