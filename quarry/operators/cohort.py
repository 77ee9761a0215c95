"""Filters and cohort selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def date_window(df: DataFrame, c: str, start: str | None = None, end: str | None = None,
                closed_end: bool = True) -> DataFrame:
    """Rows whose date lies in [start, end] (or [start, end))."""
    x = F.col(c)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (x >= F.lit(start).cast(df.schema[c].dataType))
    if end is not None:
        e = F.lit(end).cast(df.schema[c].dataType)
        cond = cond & ((x <= e) if closed_end else (x < e))
    return df.filter(cond)


def attrition(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows left after each cumulative filter step, in one pass.

    One aggregate computes every step's count (``sum(when(p1 & ... & pk))``),
    then the single row is unpivoted; the data is scanned once."""
    aggs = []
    conj = None
    for i, (_, pred) in enumerate(steps):
        conj = pred if conj is None else conj & pred
        aggs.append(F.sum(F.when(conj, 1).otherwise(0)).alias(f"s{i}"))
    one = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(name).alias("name"),
                             F.col(f"s{i}").cast("long").alias("n_left"))
                    for i, (name, _) in enumerate(steps)])
    return one.select(F.explode(arr).alias("s")).select("s.*")


def date_order_valid(birth: Column, admitted: Column, discharged: Column) -> Column:
    """C4: birth <= admission <= discharge; null when any date is missing."""
    return (F.when(birth.isNull() | admitted.isNull() | discharged.isNull(), F.lit(None).cast("boolean"))
            .otherwise((birth <= admitted) & (admitted <= discharged)))


def semi_filter(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keep rows whose key appears in ``keys``."""
    return df.join(keys.select(*on), list(on), "left_semi")


def anti_filter(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Drop rows whose key appears in ``keys`` (null-safe, unlike NOT IN)."""
    return df.join(keys.select(*on), list(on), "left_anti")


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``cols``."""
    return df.dropna(subset=list(cols))


def crossover_exclusion(df: DataFrame, user: str, in_group_a: Column, shows_b: Column) -> DataFrame:
    """Drop users assigned to A that show B behaviour."""
    a = df.filter(in_group_a).select(user).distinct()
    b = df.filter(shows_b).select(user).distinct()
    bad = a.intersect(b)
    return df.join(bad, user, "left_anti")


def min_history(df: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """Keep groups with at least ``n`` rows.  Group sizes are a partial
    aggregate joined back, so no group is held in one task."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= n)
    return df.join(sizes.select(*by), list(by), "left_semi")


def residual_trim(df: DataFrame, resid: str, k: float = 2.5) -> DataFrame:
    """Drop rows whose standardised residual exceeds ``k``."""
    from quarry.operators.aggregate import with_total
    s = df.agg(F.avg(resid).alias("_m"), F.stddev_samp(resid).alias("_s"))
    return with_total(df, s).filter(F.abs((F.col(resid) - F.col("_m")) / F.col("_s")) <= k).drop("_m", "_s")


def leverage_trim(df: DataFrame, x: str, resid: str, k: float, times: float) -> DataFrame:
    """Drop rows of a one-regressor fit whose standardised residual
    exceeds ``k`` or whose leverage 1/n + (x - mean)^2 / Sxx exceeds ``times``
    the mean leverage 2/n."""
    from quarry.operators.aggregate import with_total
    s = df.agg(F.count(F.lit(1)).alias("_n"), F.avg(x).alias("_mx"), F.var_pop(x).alias("_vx"),
               F.avg(resid).alias("_m"), F.stddev_samp(resid).alias("_s"))
    hat = 1 / F.col("_n") + (F.col(x) - F.col("_mx")) ** 2 / (F.col("_vx") * F.col("_n"))
    near = (F.abs((F.col(resid) - F.col("_m")) / F.col("_s")) <= k) & (hat <= times * 2 / F.col("_n"))
    return with_total(df, s).filter(near).drop("_n", "_mx", "_vx", "_m", "_s")
