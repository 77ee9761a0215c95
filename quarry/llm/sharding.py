"""Shards of near equal bytes by k-d tree partitioning.

Points are the distinct texts, weighted by the bytes of all their copies; a
text whose copies weigh more than ``WHOLE`` of a shard counts as several
points, so that it can be split.  Starting from one node that holds all points
and stands for all shards, every node is split on its widest metadata
dimension (extent within the node over extent in the table) at the weighted
median of its points, or at the share that its two halves' shard counts ask
for, until each node is one shard of about the target bytes.

The medians are found by Spark: each pass counts the bytes in equal steps of
the interval that still holds the cut, for all nodes of a level at once, and
goes on in one step of each; points of equal value are told apart by a hash of
the text.  Only the counts, and at last the few points of the last step, come
to the driver.
"""

from __future__ import annotations

import dataclasses
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import partitions, written

WHOLE = 0.02              # copies of one text that weigh more of a shard than this (and than any one text) are split
STEPS = 1 << 12           # points of last steps that the driver holds for one level (64 of a node at least)
MOST_SHARDS = 1 << 14     # the tree's nodes, one row each, are held by the driver and broadcast
LAW = "bytes"
SHORT, LONG = -(1 << 63), (1 << 63) - 1


def _dimension(kind: T.DataType, column: Column) -> Column:
    """A metadata column as a number: strings by their first six bytes, in
    byte order; missing, NaN: 0."""
    if isinstance(kind, T.StringType):
        head = F.rpad(F.substring(F.hex(column.cast("binary")), 1, 12), 12, "0")
        return F.coalesce(F.conv(head, 16, 10).cast("double"), F.lit(0.0))
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        column = F.unix_micros(column.cast("timestamp"))
    x = F.coalesce(column.cast("double"), F.lit(0.0))
    return F.when(F.isnan(x), 0.0).otherwise(F.greatest(F.least(x, F.lit(1e300)), F.lit(-1e300)))


@dataclasses.dataclass
class _Search:
    """The interval of a node that holds its cut: a range of values, or of
    hashes at one value ``at``."""
    goal: float
    before: int
    n: int
    lo: float
    hi: float
    at: float | None = None
    hlo: int = SHORT
    hhi: int = LONG


def _inside(points: DataFrame, open_: dict[int, _Search]) -> DataFrame:
    """The points of the nodes' intervals (one row per node is broadcast)."""
    table = [(node, s.at is None, s.lo, s.hi, s.at, s.hlo, s.hhi) for node, s in open_.items()]
    kind = "node int, by_value boolean, lo double, hi double, at double, hlo long, hhi long"
    rows = points.join(F.broadcast(points.sparkSession.createDataFrame(table, kind)), "node")
    return rows.where(F.when(F.col("by_value"), F.col("x").between(F.col("lo"), F.col("hi")))
                      .otherwise((F.col("x") == F.col("at")) & F.col("h").between(F.col("hlo"), F.col("hhi"))))


def weighted_cuts(points: DataFrame, goals: dict[int, float], sizes: dict[int, tuple[int, float, float]],
                  most: int = STEPS) -> dict[int, tuple[float, int]]:
    """For each node the key (x, h) at which its points, ordered by (x, h), are
    cut so that the weight in front is as near as possible to its goal.

    ``points`` has node, x, h and weight; ``sizes`` gives each node's number of
    points and its least and largest x."""
    state = {node: _Search(goal, 0, *sizes[node]) for node, goal in goals.items()}
    few = max(min(64, most), most // max(1, len(state)))
    steps = max(64, min(1024, 16 * most // max(1, len(state))))
    while True:
        for s in state.values():
            if s.at is None and s.lo == s.hi:
                s.at = s.lo
        wide = {node: s for node, s in state.items() if s.n > few and s.hlo < s.hhi}
        if not wide:
            break
        part = F.when(F.col("by_value"), (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(
            (F.col("h").cast("double") - F.col("hlo").cast("double")) / F.greatest(F.col("hhi").cast("double") - F.col("hlo").cast("double"), F.lit(1.0)))
        step = F.least(F.floor(part * steps), F.lit(steps - 1))
        counted = _inside(points, wide).groupBy("node", step.alias("step")).agg(
            F.sum("weight").alias("w"), F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"),
            F.min("h").alias("hlo"), F.max("h").alias("hhi")).collect()          # at most ``steps`` rows a node
        by_node: dict[int, list] = {}
        for r in sorted(counted, key=lambda r: (r.node, r.step)):
            by_node.setdefault(r.node, []).append(r)
        for node, s in wide.items():
            for r in by_node[node]:
                if s.before + r.w >= s.goal or r is by_node[node][-1]:
                    break
                s.before += r.w
            s.n = r.n
            if s.at is None:
                s.lo, s.hi = r.lo, r.hi
            else:
                s.hlo, s.hhi = r.hlo, r.hhi
    cuts = {}
    got: dict[int, list] = {}
    for r in _inside(points, state).select("node", "x", "h", "weight").collect():     # at most ``few`` rows a node
        got.setdefault(r.node, []).append((r.x, r.h, r.weight))
    for node, s in state.items():
        rows, total = sorted(got[node]), s.before
        best, cut = abs(total - s.goal), rows[0][:2]
        for i, (x, h, w) in enumerate(rows):
            total += w
            after = rows[i + 1][:2] if i + 1 < len(rows) else (x, h + 1) if h < LONG else (math.nextafter(x, math.inf), SHORT)
            if abs(total - s.goal) < best and after != (x, h):
                best, cut = abs(total - s.goal), after
        cuts[node] = cut
    return cuts


def _grown(points: DataFrame, dims: list[str], shards: int, most: int) -> tuple[DataFrame, int]:
    """``points`` with the shard of each as ``node``, and the tree's levels."""
    tree = points.withColumn("node", F.lit(0))
    spans, levels, whole = {0: shards}, 0, None
    while any(n > 1 for n in spans.values()):
        found = {r.node: r for r in tree.groupBy("node").agg(
            F.count("*").alias("n"), F.sum("weight").alias("w"),
            *[f(d).alias(f"{name}_{d}") for d in dims for name, f in (("lo", F.min), ("hi", F.max))]).collect()}     # one row a node
        if not found:
            break
        whole = whole or {d: found[0][f"hi_{d}"] - found[0][f"lo_{d}"] for d in dims}
        split, goals, sizes = {}, {}, {}
        for node, n in spans.items():
            if n > 1 and node in found:
                r = found[node]
                d = max(dims, key=lambda d: ((r[f"hi_{d}"] - r[f"lo_{d}"]) / whole[d] if whole[d] else 0.0))
                split[node] = (d, (n + 1) // 2)
                goals[node], sizes[node] = r.w * ((n + 1) // 2) / n, (r.n, r[f"lo_{d}"], r[f"hi_{d}"])
        spark = points.sparkSession
        chosen = spark.createDataFrame([(node, d) for node, (d, _) in split.items()], "node int, dim string") if split else None
        if chosen is not None:
            value = F.lit(0.0)
            for d in dims:
                value = F.when(F.col("dim") == d, F.col(d)).otherwise(value)
            keyed = tree.join(F.broadcast(chosen), "node").select("node", value.alias("x"), "h", "weight")
            cuts = weighted_cuts(keyed, goals, sizes, most)
            rows = [(node, d, *cuts[node], node + left) for node, (d, left) in split.items()]
            cut = F.broadcast(spark.createDataFrame(rows, "node int, dim string, cx double, ch long, right int"))    # one row a node
            first = (value < F.col("cx")) | ((value == F.col("cx")) & (F.col("h") < F.col("ch")))
            tree = tree.join(cut, "node", "left").withColumn("node", F.when(first | F.col("cx").isNull(), F.col("node")).otherwise(F.col("right")))
            tree = tree.select(points.columns + ["node"])
        spans = {k: v for node, n in spans.items() for k, v in (((node, (n + 1) // 2), (node + (n + 1) // 2, n // 2)) if n > 1 else ((node, n),))}
        levels += 1
    return tree, levels


def shard_documents(docs: DataFrame, shards: int = 8, dims: tuple[str, ...] = ("source", "lang"), whole: float = WHOLE,
                    id_col: str = "doc_id", text_col: str = "text", most: int = STEPS) -> DataFrame:
    """Every row of ``docs`` in one of ``shards`` shards of near equal bytes.

    ``size`` is the text's UTF-8 bytes (null: none) plus 1.  The dimensions
    are the columns ``dims`` as far as ``docs`` has them (of copies of a text
    the least; numbers, dates and strings are ordered as such, a missing value
    counts as 0 or as an empty string) and the size.  Rows with equal texts
    lie in one shard unless together they weigh more than ``whole`` of a shard
    and more than the largest text: only such groups are split, so a shard's
    bytes differ from an equal share by about that much.

    Returns id, ``size`` long, ``text_crc32`` long, ``law`` (``bytes``),
    ``shard`` int, ``slot`` long (gapless from 0 in its shard) and
    ``grown_shard`` int (null under this law).  Null and empty texts are one
    group; repeated rows and rows without an id keep a row
    each; other columns are ignored, whatever their names; with fewer points
    than shards some stay empty; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    if not 1 <= shards <= MOST_SHARDS:
        raise ValueError(f"shards must lie between 1 and {MOST_SHARDS}")
    text = F.col(f"`{text_col}`").cast("string")
    meta = [c for c in dims if c in docs.columns]
    names = [f"m{i}" for i in range(len(meta))] + ["size"]
    body = F.coalesce(text, F.lit(""))
    rows = written(docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("crc"), F.md5(body.cast("binary")).alias("key"),
        F.monotonically_increasing_id().alias("row"),
        *[_dimension(docs.schema[c].dataType, F.col(f"`{c}`")).alias(n) for c, n in zip(meta, names, strict=False)]))
    facts = [F.sum("size").alias("weight"), *[F.min(F.col(n).cast("double")).alias(n) for n in names]]
    groups = written(rows.groupBy("key").agg(*facts))
    total, largest = groups.agg(F.sum("weight"), F.max("size")).first()
    if total is None:
        return rows.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit(LAW).alias("law"), F.lit(0).alias("shard"),
                           F.col("id").alias("slot"), F.lit(None).cast("int").alias("grown_shard")).limit(0)
    limit = max(largest, whole * total / shards)
    # fewer than shards / whole groups weigh so much: their sum is at most the total
    heavy = F.broadcast(groups.where(F.col("weight") > limit).select("key", F.ceil(F.col("weight") / limit).alias("pieces")))
    dealt = rows.join(heavy, "key", "left").withColumn(
        "piece", F.coalesce(F.pmod(F.xxhash64("row"), F.col("pieces")), F.lit(0))).drop("pieces")
    points = written(groups.join(heavy, "key", "left_anti").withColumn("piece", F.lit(0).cast("long")).unionByName(
        dealt.join(heavy, "key", "left_semi").groupBy("key", "piece").agg(*facts)).withColumn("h", F.xxhash64("key", "piece")))
    tree, _ = _grown(points, names, shards, most)
    parts = partitions(spark)
    placed = written(dealt.join(tree.select("key", "piece", F.col("node").alias("shard")), ["key", "piece"])
                     .select("id", "size", "crc", "shard", "row", F.pmod(F.xxhash64("row"), F.lit(parts)).alias("part")))
    # slots: numbers inside (shard, part), after all earlier parts of the shard; shards x parts counts
    counts = placed.groupBy("shard", "part").count()
    ahead = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select("shard", "part", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "row"))
    out = placed.withColumn("place", inside).join(start, ["shard", "part"])
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit(LAW).alias("law"), F.col("shard").cast("int").alias("shard"),
                      (F.col("start") + F.col("place") - F.lit(1)).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
