"""Graph operators over an edge list ``(src, dst)``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir


def degree(edges: DataFrame, name: str = "degree") -> DataFrame:
    """M2: total degree per node (edges out of the node)."""
    return edges.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias(name))


def most_connected(edges: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """M3: the node with the largest degree (ties to the larger id), with
    its name when a (node, name) table is given."""
    d = degree(edges)
    best = d.agg(F.max(F.struct("degree", "node")).alias("b")).select("b.node", "b.degree")
    return best.join(names, "node", "left") if names is not None else best


def hop_distance(edges: DataFrame, source, max_rounds: int = 10, target=None) -> tuple[DataFrame, dict]:
    """M1: breadth-first hop distance from ``source`` over at most
    ``max_rounds`` rounds, stopping early when the frontier is empty or the
    target has been reached.

    The edges are written once.  Each round joins the last frontier to them,
    counts the edges that reach each node, drops visited nodes and appends
    what is left to the visited table as the next frontier: only new rows are
    written.  The target's hits are the count of its row, so they need no
    pass of their own.  Unreached nodes are simply absent (the reference's
    9999 sentinel is a ``coalesce`` away).
    """
    spark = edges.sparkSession
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/hops-{uuid.uuid4().hex}"
    edges.select("src", "dst").repartition("src").write.parquet(f"{base}/edges")
    e = spark.read.parquet(f"{base}/edges")
    row = "node long, dist int, hits long"
    start = spark.range(1).select(F.lit(source).cast("long").alias("node"), F.lit(0).alias("dist"), F.lit(0).cast("long").alias("hits"))
    start.write.parquet(f"{base}/visited/round=0")
    info = {"rounds": 0, "hits": 0, "found_at": None}
    for r in range(1, max_rounds + 1):
        frontier = spark.read.schema(row).parquet(f"{base}/visited/round={r - 1}")
        visited = spark.read.schema(row).parquet(*[f"{base}/visited/round={i}" for i in range(r)])
        step = frontier.join(e, frontier.node == e.src).groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("hits"))
        new = step.join(visited.select("node"), "node", "left_anti").select("node", F.lit(r).alias("dist"), "hits")
        new.write.parquet(f"{base}/visited/round={r}")
        written = spark.read.schema(row).parquet(f"{base}/visited/round={r}")
        info["rounds"] = r
        if target is not None:
            hit = written.where(F.col("node") == F.lit(target)).select("hits").first()
            if hit is not None:
                info["hits"], info["found_at"] = hit.hits, r
                break
        if written.isEmpty():
            break
    done = spark.read.schema(row).parquet(*[f"{base}/visited/round={i}" for i in range(info["rounds"] + 1)])
    return done.select("node", "dist"), info
