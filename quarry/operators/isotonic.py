"""Isotonic regression without a sequential pass.

The fit is the slope of the greatest convex minorant of the cumulative sums
(weight, sum of outcomes) in the order of the score.

1. Rows become one point per (fit, score); running sums make the diagram.
2. Every task keeps the lower convex hull of the points it reads.  The hull of
   all points only has vertices that are on the hull of any part they are in.
3. If a fit has more than ``SEGMENT`` such vertices, quantiles of their edges'
   slopes are thresholds.  The point where a line of that slope touches the
   diagram is the least of (Y - slope X), an aggregate; there the hull falls
   into independent segments.  A vertex whose own edges cannot meet a segment's
   slopes is left out, so a segment holds about ``SEGMENT`` vertices and a few
   per task, and is finished by one small task.
4. Hull vertices end the blocks; running sums number them.

Sums of whole numbers are exact; otherwise neighbouring blocks are right to the
rounding of the sums.  The driver holds one threshold per ``SEGMENT`` vertices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.ordered import running_sum, running_sums
from quarry.operators.staged import written

SEGMENT = 100_000
_VERTEX = "fit int, p double, x double, y double, into double, out double"


def _hull(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places of the lower hull's vertices; ``x`` is rising."""
    kept: list[int] = []
    for i in range(len(x)):
        while len(kept) > 1:
            a, b = kept[-2], kept[-1]
            if (y[b] - y[a]) * (x[i] - x[b]) < (y[i] - y[b]) * (x[b] - x[a]):
                break
            kept.pop()
        kept.append(i)
    return np.array(kept, np.int64)


def _local_hulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, pd.DataFrame] = {}
    for batch in batches:
        for fit, part in batch.to_pandas().groupby("fit"):
            both = pd.concat([held[fit], part]) if fit in held else part
            both = both.sort_values("x")
            held[fit] = both.iloc[_hull(both["x"].to_numpy(), both["y"].to_numpy())]
    for part in held.values():
        slope = np.diff(part["y"].to_numpy()) / np.diff(part["x"].to_numpy())
        part = part.assign(into=np.concatenate([[-np.inf], slope]), out=np.concatenate([slope, [np.inf]]))
        yield pa.RecordBatch.from_pandas(part[["fit", "p", "x", "y", "into", "out"]], preserve_index=False)


def _touching(vertices: DataFrame, slopes: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Per fit and threshold, the x where a line of that slope touches the diagram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fit, part in batch.to_pandas().groupby("fit"):
                part = part.sort_values("x").drop_duplicates("x")
                x, y = part["x"].to_numpy(), part["y"].to_numpy()
                h = _hull(x, y)
                x, y, cut = x[h], y[h], slopes.get(fit, np.empty(0))
                at = np.searchsorted(np.diff(y) / np.diff(x), cut)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cut), fit, np.int32)), pa.array(np.arange(len(cut), dtype=np.int32)),
                                                  pa.array(x[at]), pa.array(y[at] - cut * x[at])], names=["fit", "cut", "x", "low"])

    got = vertices.mapInArrow(run, "fit int, cut int, x double, low double").groupBy("fit", "cut").agg(F.min_by("x", F.struct("low", "x")).alias("x"))
    out = {fit: np.zeros(len(s)) for fit, s in slopes.items()}
    for r in got.collect():
        out[r.fit][r.cut] = r.x
    return {fit: np.maximum.accumulate(x) for fit, x in out.items()}


def _segments(vertices: DataFrame, slopes: dict[int, np.ndarray], ends: dict[int, np.ndarray]) -> DataFrame:
    """Vertices with the segments whose hull they can be on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fit, part in batch.to_pandas().groupby("fit"):
                cut, end, x = slopes.get(fit, np.empty(0)), ends.get(fit, np.empty(0)), part["x"].to_numpy()
                # by place and by slope, the first and last segment that can hold a vertex
                first = np.maximum(np.searchsorted(end, x, "left"), np.searchsorted(cut, part["into"].to_numpy(), "left"))
                last = np.minimum(np.searchsorted(end, x, "right"), np.searchsorted(cut, part["out"].to_numpy(), "right"))
                # where the line touches, both sides need the vertex
                touch = np.isin(x, end)
                first = np.where(touch, np.searchsorted(end, x, "left"), first)
                last = np.where(touch, np.searchsorted(end, x, "right"), last)
                n = np.maximum(last - first + 1, 0)
                rows = part.iloc[np.repeat(np.arange(len(part)), n)]
                of = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_pandas(rows.assign(segment=of.astype(np.int32))[["fit", "p", "x", "y", "segment"]], preserve_index=False)

    return vertices.mapInArrow(run, "fit int, p double, x double, y double, segment int")


def _finish(part: pd.DataFrame) -> pd.DataFrame:
    part = part.drop_duplicates("x").sort_values("x")
    return part.iloc[_hull(part["x"].to_numpy(), part["y"].to_numpy())][["fit", "p"]]


def isotonic_blocks(rows: DataFrame) -> DataFrame:
    """Blocks of the isotonic fit of ``rows`` (fit int, p double, w double >
    0, s double: weight and weighted sum of outcomes; several rows of one score
    are added up): fit, block (long, from 0 in the order of the score), p_lo,
    p_hi, value.  Rows with a null are left out; no rows, no blocks."""
    points = rows.dropna().groupBy("fit", "p").agg(F.sum("w").alias("w"), F.sum("s").alias("s"))
    summed = written(running_sums(points, ["fit"], ["p"], {"w": "x", "s": "y"}))
    ordered = summed.select("fit", "p", "x", "y").repartitionByRange("fit", "p")
    start = summed.select("fit").distinct().selectExpr("fit", "CAST(NULL AS DOUBLE) AS p", "0D AS x", "0D AS y",
                                                       "CAST('-Infinity' AS DOUBLE) AS into", "CAST('Infinity' AS DOUBLE) AS out")
    vertices = written(ordered.mapInArrow(_local_hulls, _VERTEX).unionByName(start))
    counts = {r.fit: r.n for r in vertices.groupBy("fit").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = max(counts.values(), default=0)
    slopes: dict[int, np.ndarray] = {}
    if most > SEGMENT:
        parts = -(-most // SEGMENT)
        edges = vertices.where(F.col("into") > F.lit(float("-inf")))
        for r in edges.groupBy("fit").agg(F.percentile_approx("into", [i / parts for i in range(1, parts)], 10_000).alias("c")).collect():
            slopes[r.fit] = np.unique(r.c)
    ends = _touching(vertices, slopes) if slopes else {}
    hull = _segments(vertices, slopes, ends).groupBy("fit", "segment").applyInPandas(_finish, "fit int, p double")
    hull = written(hull.where(F.col("p").isNotNull()).distinct().withColumn("end", F.lit(1)))
    marked = summed.select("fit", "p", "w", "s").join(hull, ["fit", "p"], "left").withColumn("end", F.coalesce("end", F.lit(0)))
    numbered = running_sum(marked, ["fit"], ["p"], "end", "block", exclusive=True)
    return numbered.groupBy("fit", "block").agg(F.min("p").alias("p_lo"), F.max("p").alias("p_hi"), (F.sum("s") / F.sum("w")).alias("value"))


def isotonic_values(blocks: DataFrame, asked: DataFrame) -> DataFrame:
    """The distinct (fit, p) of ``asked`` with ``value``: the block's inside a
    block, on the line between neighbours in a gap, the nearest block's outside
    all of them; null for a null score or a fit without blocks."""
    blocks = written(blocks)
    keys = asked.select("fit", "p").distinct()
    starts = blocks.select("fit", F.col("p_lo").alias("p"), F.lit(1).alias("start"))
    events = starts.unionByName(keys.where("p IS NOT NULL").withColumn("start", F.lit(0)))
    placed = running_sum(events, ["fit"], ["p", F.desc("start")], "start", "passed")
    found = written(placed.where("start = 0").select("fit", "p", (F.col("passed") - 1).alias("block")))
    here = blocks.select("fit", "block", F.col("p_hi").alias("end"), F.col("value").alias("v"))
    then = blocks.select("fit", (F.col("block") - 1).alias("block"), F.col("p_lo").alias("next"), F.col("value").alias("v_next"))
    x = found.join(here, ["fit", "block"], "left").join(then, ["fit", "block"], "left")
    part = (F.col("p") - F.col("end")) / (F.col("next") - F.col("end"))
    value = (F.when(F.col("v").isNull(), F.col("v_next"))
             .when((F.col("p") <= F.col("end")) | F.col("v_next").isNull(), F.col("v"))
             .otherwise(F.col("v") + part * (F.col("v_next") - F.col("v"))))
    none = keys.where("p IS NULL").select("fit", "p", F.lit(None).cast("double").alias("value"))
    return x.select("fit", "p", value.alias("value")).unionByName(none)


def out_of_fold_calibration(df: DataFrame, y: str, p: str, fold: str, folds: int) -> DataFrame:
    """(label, p, fold, calibrated): every row with the isotonic fit of
    the folds 0 .. ``folds`` - 1 that it is not in; all fits by the same passes.
    Rows without label are calibrated but not learned from; null and NaN scores
    get null."""
    score = F.col(f"`{p}`").cast("double")
    d = written(df.select(F.col(f"`{y}`").cast("double").alias("label"), F.when(~F.isnan(score), score + F.lit(0.0)).alias("p"), F.col(f"`{fold}`").cast("int").alias("fold")))
    per = d.where("label IS NOT NULL AND p IS NOT NULL").groupBy("fold", "p").agg(F.count(F.lit(1)).cast("double").alias("w"), F.sum("label").alias("s"))
    others = F.array_remove(F.sequence(F.lit(0), F.lit(folds - 1)), F.col("fold"))
    rows = per.select(F.explode(others).alias("fit"), "p", "w", "s")
    values = written(isotonic_values(isotonic_blocks(rows), d.select(F.col("fold").alias("fit"), "p")))
    on = (d.fold == values.fit) & d.p.eqNullSafe(values.p)
    return d.join(values, on, "left").select("label", d.p, "fold", F.col("value").alias("calibrated"))
