"""Intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read
    back: computed once, cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BROADCAST_BYTES = 32 << 20


def for_lookup(table: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``table`` as the looked-up side of a join with many rows: broadcast if
    its measured bytes are at most ``most``, else to be merged.  Either way
    the planner, which knows the size of neither side where one of them is
    built from rows, cannot choose to broadcast the other side."""
    size = F.lit(0)
    for c in table.columns:
        size = size + F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + F.lit(16)
    measured = table.agg(F.sum(size.cast("long"))).first()[0] or 0
    return F.broadcast(table) if measured <= most else table.hint("merge")
