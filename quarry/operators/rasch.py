"""Rasch model by conditional likelihood, and its split-group test.

Given how many items a user answered right, which ones they were does not
depend on the user's ability: the likelihood of the item difficulties needs
only elementary symmetric functions of them.  Spark reduces the answers to
counts of (items answered, number right) and to each item's total; every
Newton pass walks over those counts.  The driver holds one number per item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import r6
from quarry.functions.dist import chi2_sf
from quarry.operators.staged import written

MOST_ITEMS = 62           # items are bits of a long


def symmetric(eps: np.ndarray) -> np.ndarray:
    """Elementary symmetric functions of orders 0 .. n."""
    out = np.zeros(len(eps) + 1)
    out[0] = 1.0
    for i, e in enumerate(eps, 1):
        out[1:i + 1] += e * out[:i].copy()
    return out


def conditional_terms(eps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each number right r = 0 .. n: log of the symmetric function, the
    chance of each item to be right, and of each pair."""
    n = len(eps)
    whole = symmetric(eps)
    one, two = np.zeros((n + 1, n)), np.zeros((n + 1, n, n))
    for i in range(n):
        rest = symmetric(np.delete(eps, i))
        one[1:, i] = eps[i] * rest / whole[1:]
        two[:, i, i] = one[:, i]
        for j in range(i):
            pair = symmetric(np.delete(eps, [j, i]))
            two[2:, i, j] = two[2:, j, i] = eps[i] * eps[j] * pair / whole[2:]
    return np.log(whole), one, two


def _pass(counts: DataFrame, b: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Sums over the counts: log symmetric functions, item chances, and their
    covariances."""
    k = len(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, first, second, known = 0.0, np.zeros(k), np.zeros((k, k)), {}
        for batch in batches:
            for mask, right, n in zip(batch.column("mask").to_pylist(), batch.column("right").to_pylist(), batch.column("n").to_pylist(), strict=True):
                own = [i for i in range(k) if mask >> i & 1]
                if mask not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[mask] = conditional_terms(np.exp(-b[own]))
                log, one, two = known[mask]
                logs += n * log[right]
                first[own] += n * one[right]
                second[np.ix_(own, own)] += n * (two[right] - np.outer(one[right], one[right]))
        flat = np.concatenate([[logs], first, second.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["at", "v"])

    got = np.zeros(1 + k + k * k)
    for r in counts.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        got[r["at"]] = r.v
    return got[0], got[1:1 + k], got[1 + k:].reshape(k, k)


def _fit(counts: DataFrame, totals: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, float]:
    """Difficulties (mean 0), their standard errors and the log-likelihood."""
    b = np.zeros(len(totals))
    for _ in range(rounds):
        logs, first, info = _pass(counts, b)
        step = np.linalg.pinv(info) @ (first - totals)       # the sum of the difficulties is free
        b = b + np.clip(step, -1, 1)
        b -= b.mean()
        if np.abs(step).max() < 1e-8:
            break
    logs, _, info = _pass(counts, b)
    return b, np.sqrt(np.maximum(np.diag(np.linalg.pinv(info)), 0)), float(-(totals @ b) - logs)


def _answers(first: DataFrame, user: str, item: str, correct: str) -> tuple[DataFrame, list]:
    """Per user the bits of the answered and of the right items."""
    rows = first.select(F.col(user).alias("user"), F.col(item).alias("item"), F.col(correct).cast("int").alias("right")).dropna()
    items = sorted(r[0] for r in rows.select("item").distinct().limit(MOST_ITEMS + 1).collect())
    if len(items) > MOST_ITEMS:
        raise ValueError(f"more than {MOST_ITEMS} values of {item}")
    kind = rows.schema["item"].dataType.simpleString()
    bits = F.broadcast(rows.sparkSession.createDataFrame([(x, 1 << i) for i, x in enumerate(items)], f"item {kind}, bit long"))
    per = rows.join(bits, "item").groupBy("user").agg(F.bit_or("bit").alias("mask"), F.bit_or(F.when(F.col("right") == 1, F.col("bit")).otherwise(0)).alias("hits"))
    return written(per), items


def _reduced(per: DataFrame, keep: int) -> DataFrame:
    """``per`` on the items of the bits ``keep``, without users who have all
    or none of their items right (they tell nothing)."""
    out = per.select("user", F.col("mask").bitwiseAND(F.lit(keep).cast("long")).alias("mask"), F.col("hits").bitwiseAND(F.lit(keep).cast("long")).alias("hits"))
    return out.where("hits <> 0 AND hits <> mask").withColumn("right", F.bit_count("hits"))


def _sums(rows: DataFrame, k: int) -> tuple[DataFrame, np.ndarray]:
    counts = written(rows.groupBy("mask", "right").agg(F.count("*").alias("n")))
    got = rows.agg(*[F.sum(F.shiftright("hits", i).bitwiseAND(1)) for i in range(k)]).first()
    return counts, np.array([x or 0 for x in got], float)


def _varied(rows: DataFrame, k: int) -> int:
    """Bits of the items that somebody has right and somebody wrong."""
    seen = rows.agg(F.bit_or("hits"), F.bit_or(F.expr("mask & ~hits"))).first()
    return (seen[0] or 0) & (seen[1] or 0)


def rasch_conditional(first: DataFrame, user: str, item: str, correct: str) -> DataFrame:
    """``item``, ``difficulty`` (mean 0) and ``std_error`` by conditional
    maximum likelihood.  ``first`` has one answer per user and item; users may
    have answered some items only; items that all or none have right have no
    finite difficulty and are left out."""
    per, items = _answers(first, user, item, correct)
    kind = first.schema[item].dataType.simpleString()
    keep, before = (1 << len(items)) - 1, None
    while keep != before:                   # an item left out may leave users without information
        before, keep = keep, _varied(_reduced(per, keep), len(items))
    own = [i for i in range(len(items)) if keep >> i & 1]
    if len(own) < 2:
        return first.sparkSession.createDataFrame([], f"item {kind}, difficulty double, std_error double")
    b, se, _ = _fit(*_compact(_reduced(per, keep), own))
    return first.sparkSession.createDataFrame([(items[i], float(x), float(s)) for i, x, s in zip(own, b, se, strict=True)],
                                              f"item {kind}, difficulty double, std_error double")


def _compact(rows: DataFrame, own: list[int]) -> tuple[DataFrame, np.ndarray]:
    """The counts with the bits of the items ``own`` moved together."""
    def packed(c: str):
        out = F.lit(0).cast("long")
        for to, i in enumerate(own):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(c, i).bitwiseAND(1).cast("long"), to))
        return out

    return _sums(rows.select(packed("mask").alias("mask"), packed("hits").alias("hits"), "right"), len(own))


def rasch_split_test(first: DataFrame, user: str, item: str, correct: str) -> DataFrame:
    """Likelihood-ratio test of equal difficulties in users below and
    above the mean number right: ``items``, ``loglik``, ``loglik_split``,
    ``lr``, ``df`` and ``p``.  Items that do not vary in one of the groups are
    left out of all three fits."""
    spark = first.sparkSession
    per, items = _answers(first, user, item, correct)
    scored = per.withColumn("score", F.bit_count("hits"))
    mean = scored.agg(F.avg("score")).first()[0]
    schema = "items int, loglik double, loglik_split double, lr double, df int, p double"
    if mean is None:
        return spark.createDataFrame([], schema)
    groups = [written(scored.where(c).drop("score")) for c in (F.col("score") <= mean, F.col("score") > mean)]
    keep, before = (1 << len(items)) - 1, None
    while keep != before:
        before = keep
        for g in groups:
            keep &= _varied(_reduced(g, keep), len(items))
    own = [i for i in range(len(items)) if keep >> i & 1]
    if len(own) < 2:
        return spark.createDataFrame([], schema)
    # the same users in all three fits
    parts = [_fit(*_compact(_reduced(g, keep), own))[2] for g in groups]
    whole = _fit(*_compact(_reduced(groups[0].unionByName(groups[1]), keep), own))[2]
    lr = 2 * (sum(parts) - whole)
    row = spark.createDataFrame([(len(own), whole, float(sum(parts)), float(lr), len(own) - 1)], "items int, loglik double, loglik_split double, lr double, df int")
    return row.select("items", r6("loglik").alias("loglik"), r6("loglik_split").alias("loglik_split"), r6("lr").alias("lr"), "df",
                      r6(chi2_sf(F.greatest("lr", F.lit(0.0)), F.col("df").cast("double"))).alias("p"))
