"""Reshape operators: pivot, unpivot, repeated-measure blocks, fill grids."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def long_to_wide(df: DataFrame, keys: Sequence[str], pivot: str, value: str,
                 levels: Sequence, fn: str = "avg", prefix: str = "") -> DataFrame:
    """Pivot with declared levels (no extra pass to discover them)."""
    agg = {"avg": F.avg, "first": F.first, "sum": F.sum, "max": F.max, "min": F.min}[fn]
    out = df.groupBy(*keys).pivot(pivot, list(levels)).agg(agg(value))
    return out.select(*keys, *[F.col(f"`{lv}`").alias(f"{prefix}{lv}") for lv in levels])


def wide_to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str],
                 var: str = "variable", value: str = "value") -> DataFrame:
    """Unpivot."""
    return df.unpivot(list(ids), list(values), var, value)


def unpivot_pairs(df: DataFrame, ids: Sequence[str], blocks: Mapping[str, Sequence[str]],
                  name: str, fields: Sequence[str]) -> DataFrame:
    """Unpivot several aligned column blocks at once: each block contributes
    one row holding ``fields`` taken from its columns."""
    arr = F.array(*[F.struct(F.lit(b).alias(name), *[F.col(c).alias(f) for c, f in zip(cols, fields)])
                    for b, cols in blocks.items()])
    return df.select(*ids, F.explode(arr).alias("_s")).select(*ids, "_s.*")


def repeated_blocks(df: DataFrame, ids: Sequence[str], stems: Sequence[str],
                    iteration: str = "iteration") -> DataFrame:
    """Wide repeated measures ``stem_<i>`` to long rows (ids, iteration,
    stem...).  The iteration number is read from the column names; the
    blocks are aligned by iteration in one array of structs and exploded,
    so no join is needed.  Rows whose block is entirely null are dropped."""
    its = sorted({int(m.group(1)) for c in df.columns for s in stems
                  if (m := re.fullmatch(rf"{re.escape(s)}_(\d+)", c))})
    structs = []
    for i in its:
        fields = [F.lit(i).alias(iteration)]
        for s in stems:
            c = f"{s}_{i}"
            fields.append((F.col(c) if c in df.columns else F.lit(None)).alias(s))
        structs.append(F.struct(*fields))
    out = df.select(*ids, F.explode(F.array(*structs)).alias("_s")).select(*ids, "_s.*")
    cond = None
    for s in stems:
        t = F.col(s).isNotNull()
        cond = t if cond is None else cond | t
    return out.filter(cond)


def fill_grid(df: DataFrame, keys: Sequence[str], value: str, fill=0) -> DataFrame:
    """I4: complete every combination of the observed key values, missing
    cells filled.  The distinct levels of each key are gathered into one
    row (bounded by the level count, e.g. months x labels) and exploded,
    so the grid is exactly the output asked for."""
    levels = df.agg(*[F.collect_set(k).alias(k) for k in keys])
    grid = levels
    for k in keys:
        grid = grid.withColumn(k, F.explode(k))
    return grid.join(df, list(keys), "left").select(*keys, F.coalesce(F.col(value), fill if isinstance(fill, Column) else F.lit(fill)).alias(value))


def measured_count(df: DataFrame, key: str, value: str) -> DataFrame:
    """Number of measured values per key and a multiple-measure flag."""
    g = df.groupBy(key).agg(F.count(value).alias("n_measured"))
    return g.withColumn("measured_multiple", F.col("n_measured") > 1)
