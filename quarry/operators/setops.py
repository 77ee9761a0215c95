"""Set operations: unions by name, tagged unions, duplicate merging,
dangling-reference cleanup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_tagged(parts: Sequence[tuple[DataFrame, str]], tag: str = "source") -> DataFrame:
    """H1 / H2: union by column name, missing columns filled with null, each
    part tagged with its name."""
    out = None
    for df, name in parts:
        d = df.withColumn(tag, F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def merge_duplicates(df: DataFrame, key: str, max_cols: Sequence[str] = (), first_cols: Sequence[str] = (),
                     order: str | None = None) -> DataFrame:
    """H5: one row per key: counters take their maximum, text fields the
    first non-null value under a declared order (``min_by`` over the
    non-null rows), the order column its minimum."""
    aggs = [F.max(c).alias(c) for c in max_cols]
    for c in first_cols:
        aggs.append(F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c))
    if order is not None:
        aggs.append(F.min(order).alias(order))
    return df.groupBy(key).agg(*aggs)


def drop_dangling(df: DataFrame, known: DataFrame, ref: str, key: str) -> DataFrame:
    """H6: references to ids that do not exist become null."""
    k = known.select(F.col(key).alias("_known")).distinct()
    j = df.join(k, F.col(ref) == F.col("_known"), "left")
    return j.select(*[F.when(F.col("_known").isNull(), F.lit(None)).otherwise(F.col(c)).alias(c) if c == ref
                      else F.col(c) for c in df.columns])
