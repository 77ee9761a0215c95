"""Grouped aggregation operators (counts, rates, cross-tabs, summaries).

All of these are hash aggregates with a map-side partial step, so a hot key
only costs one pre-aggregated row per task before the shuffle.  Where a
result must be spread over a small fixed grid (cross-tab cells, Venn
combinations, Likert levels) the grid is built from the data with
``distinct`` and joined, never collected to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.columns import col, r6


def with_total(df: DataFrame, total: DataFrame) -> DataFrame:
    """Attach the columns of a one-row global aggregate to every row.

    ``total`` is a global ``agg`` without grouping keys, so it has exactly
    one row: broadcasting it is bounded by construction."""
    return df.withColumn("_one", F.lit(1)).join(
        F.broadcast(total.withColumn("_one", F.lit(1))), "_one").drop("_one")


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Count rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Total per key."""
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Mean per key (sum and count merged map-side)."""
    return df.groupBy(*keys).agg(F.avg(value).alias(name))


def min_where(df: DataFrame, keys: Sequence[str], value: str, pred: Column, name: str) -> DataFrame:
    """Minimum per key over the rows matching ``pred``."""
    return df.filter(pred).groupBy(*keys).agg(F.min(value).alias(name))


def argmax_record(df: DataFrame, score: str, key: str) -> DataFrame:
    """E5: the single row with the largest (score, key); ties go to the
    larger key.  One global aggregate of a struct: partial per task, then a
    single-row merge."""
    best = df.agg(F.max(F.struct(F.col(score), F.col(key))).alias("b"))
    return best.select(F.col("b")[key].alias(key), F.col("b")[score].alias(score))


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                    cols: Sequence[str]) -> DataFrame:
    """The first row per group under a declared total order.

    ``min_by(struct(cols), struct(order))`` is a partial aggregate: a hot
    group is reduced per task before the shuffle, unlike a window.
    """
    ordkey = F.struct(*[col(o) for o in order])
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), ordkey).alias("_f"))
    return agg.select(*keys, *[F.col("_f")[c].alias(c) for c in cols])


def quantiles_by(df: DataFrame, keys: Sequence[str], value: str,
                 probs: Sequence[float] = (0.25, 0.5, 0.75),
                 names: Sequence[str] = ("q1", "median", "q3"), skew_safe: bool = True) -> DataFrame:
    """Exact interpolated quantiles (R type 7) per group.

    Values are first reduced to (group, value, frequency) by a partial
    aggregate.  With ``skew_safe`` (default) the order statistics are then
    located without gathering a group: cumulative frequencies come from
    ``functions.ordered.running_sum`` (range-partitioned), each group's size
    is an equi-join, and the value holding 0-based rank k is the one whose
    cumulative range [cum - w, cum) contains k, picked by a conditional
    aggregate.  Otherwise Spark's ``percentile`` merges a group's distinct
    values in one task."""
    freq = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_w"))
    if not skew_safe:
        q = F.percentile(F.col(value).cast("double"), F.array(*[F.lit(p) for p in probs]), F.col("_w"))
        out = freq.groupBy(*keys).agg(q.alias("_q"))
        return out.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    from quarry.functions.ordered import running_sum

    cum = running_sum(freq, list(keys), [value], "_w", "_cum")
    sizes = freq.groupBy(*keys).agg(F.sum("_w").alias("_n"))
    x = cum.join(sizes, list(keys)) if keys else with_total(cum, sizes)
    lo_excl = F.col("_cum") - F.col("_w")
    aggs = []
    for i, p in enumerate(probs):
        h = (F.col("_n") - 1) * F.lit(float(p))
        k_lo, k_hi = F.floor(h), F.ceil(h)
        has_lo = (lo_excl <= k_lo) & (k_lo < F.col("_cum"))
        has_hi = (lo_excl <= k_hi) & (k_hi < F.col("_cum"))
        aggs += [F.max(F.when(has_lo, F.col(value).cast("double"))).alias(f"_lo{i}"),
                 F.max(F.when(has_hi, F.col(value).cast("double"))).alias(f"_hi{i}"),
                 F.max(h - k_lo).alias(f"_fr{i}")]
    g = x.groupBy(*keys).agg(*aggs)
    return g.select(*keys, *[(F.col(f"_lo{i}") + F.col(f"_fr{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(n)
                             for i, n in enumerate(names)])


def describe_by(df: DataFrame, keys: Sequence[str], value: str, prefix: str = "") -> DataFrame:
    """N, mean, SD, standard error and a 95% normal interval."""
    p = prefix
    g = df.groupBy(*keys).agg(
        F.count(value).alias(f"{p}n"),
        F.avg(value).alias(f"{p}mean"),
        F.stddev_samp(value).alias(f"{p}sd"),
    )
    se = F.col(f"{p}sd") / F.sqrt(F.col(f"{p}n"))
    return g.select(*keys, f"{p}n", r6(f"{p}mean").alias(f"{p}mean"), r6(f"{p}sd").alias(f"{p}sd"),
                    r6(se).alias(f"{p}se"),
                    r6(F.col(f"{p}mean") - 1.96 * se).alias(f"{p}lo"),
                    r6(F.col(f"{p}mean") + 1.96 * se).alias(f"{p}hi"))


def crosstab_margins(df: DataFrame, row: str, column: str, total: str = "All") -> DataFrame:
    """Long cross-tab with margins (cube + grouping id)."""
    cube = (df.select(F.col(row).cast("string").alias(row), F.col(column).cast("string").alias(column))
            .cube(row, column).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_g")))
    return cube.select(
        F.when(F.col("_g").bitwiseAND(2) == 2, F.lit(total)).otherwise(F.col(row)).alias(row),
        F.when(F.col("_g").bitwiseAND(1) == 1, F.lit(total)).otherwise(F.col(column)).alias(column),
        "n",
    )


def crosstab_share(df: DataFrame, row: str, column: str, normalize: str = "all") -> DataFrame:
    """Cross-tab cells as a share of all rows or of their row."""
    cells = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))
    if normalize == "all":
        # one global total: a single-row aggregate joined back (broadcast, 1 row)
        tot = cells.agg(F.sum("n").alias("_t"))
        out = with_total(cells, tot)
    else:
        tot = cells.groupBy(row).agg(F.sum("n").alias("_t"))
        out = cells.join(tot, row)
    return out.select(row, column, "n", r6(F.col("n") / F.col("_t")).alias("share"))


def share_of_total(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Category counts with percent of the total."""
    cells = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    tot = cells.agg(F.sum(name).alias("_t"))
    return (with_total(cells, tot)
            .select(*keys, name, r6(F.col(name) * 100.0 / F.col("_t")).alias("pct")))


def class_rates(df: DataFrame, keys: Sequence[str], cls: str,
                levels: Mapping[str, str]) -> DataFrame:
    """Per group, the count of each class level, the denominator and
    the rate of each level."""
    aggs = [F.count(F.lit(1)).alias("denom")]
    for name, value in levels.items():
        aggs.append(F.sum(F.when(F.col(cls) == value, 1).otherwise(0)).alias(f"n_{name}"))
    g = df.groupBy(*keys).agg(*aggs)
    rates = [r6(F.col(f"n_{n}") / F.col("denom")).alias(f"{n}_rate") for n in levels]
    return g.select("*", *rates)


def missingness(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and percent per column, one pass, then unpivot."""
    cols = list(cols or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(F.col(c).isNull().cast("int")).alias(f"m{i}") for i, c in enumerate(cols)])
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing"))
                                for i, c in enumerate(cols)])).alias("s")
    return one.select("_n", stack).select(
        F.col("s.column").alias("column"), F.col("s.n_missing").cast("long").alias("n_missing"),
        r6(F.col("s.n_missing") * 100.0 / F.col("_n")).alias("pct_missing"))


def mode_value(df: DataFrame, keys: Sequence[str], value: str, name: str = "mode") -> DataFrame:
    """Most frequent value per group, smallest value on ties."""
    cnt = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    # largest count first, then the smallest value
    agg = cnt.groupBy(*keys).agg(F.min_by(F.col(value), F.struct(-F.col("_c"), F.col(value))).alias(name))
    return agg


def moments(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean, SD, bias-corrected skewness and excess kurtosis (pandas)."""
    g = df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"),
                              F.stddev_samp(value).alias("sd"), F.skewness(value).alias("g1"),
                              F.kurtosis(value).alias("g2"))
    n = F.col("n")
    skew = F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)
    kurt = ((n - 1) / ((n - 2) * (n - 3))) * ((n + 1) * F.col("g2") + 6)
    return g.select(*keys, "n", r6("mean").alias("mean"), r6("sd").alias("sd"),
                    r6(skew).alias("skew"), r6(kurt).alias("kurt"))


def correlation_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)],
                 *[F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).alias(f"n{i}")
                   for i, (a, b) in enumerate(pairs)])
    arr = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                                       F.col(f"c{i}").alias("r"), F.col(f"n{i}").alias("n"))
                              for i, (a, b) in enumerate(pairs)])).alias("s")
    return one.select(arr).select(F.col("s.a").alias("var_a"), F.col("s.b").alias("var_b"),
                                  r6("s.r").alias("r"), F.col("s.n").alias("n"))


def distinct_concat(df: DataFrame, keys: Sequence[str], value: str, name: str, sep: str = "") -> DataFrame:
    """Sorted distinct values of a group joined into one string.  The
    set is bounded by the value domain (arms, flags), not by the group size."""
    return df.groupBy(*keys).agg(
        F.concat_ws(sep, F.sort_array(F.collect_set(F.col(value).cast("string")))).alias(name))


def any_flag(df: DataFrame, keys: Sequence[str], pred: Column, name: str) -> DataFrame:
    """Whether any row of the group matches."""
    return df.groupBy(*keys).agg(F.bool_or(pred).alias(name))


def top_labels(df: DataFrame, flag_cols: Sequence[str], k: int) -> DataFrame:
    """Prevalence of each flag column, top-k by count (name breaks ties)."""
    one = df.agg(*[F.sum(F.col(c).cast("int")).alias(c) for c in flag_cols])
    long = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).cast("long").alias("n"))
                                          for c in flag_cols])).alias("s")).select("s.*")
    return long.orderBy(F.desc("n"), "label").limit(k)


def exact_combinations(df: DataFrame, flag_cols: Sequence[str]) -> DataFrame:
    """Count of rows for every exact on/off combination of the flags
    (including empty ones), with percentages.  The 2^k grid is generated on
    the executors from a one-row frame."""
    k = len(flag_cols)
    counts = df.groupBy(*[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in flag_cols]) \
        .agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(0, 2 ** k).select(
        *[((F.col("id").bitwiseAND(1 << (k - 1 - i))) > 0).alias(c) for i, c in enumerate(flag_cols)])
    tot = counts.agg(F.sum("n").alias("_t"))
    label = F.concat_ws("&", *[F.when(F.col(c), F.lit(c)) for c in flag_cols])
    return (with_total(grid.join(counts, list(flag_cols), "left"), tot)
            .select(*flag_cols,
                    F.when(label == "", F.lit("none")).otherwise(label).alias("combination"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"),
                    r6(F.coalesce(F.col("n"), F.lit(0)) * 100.0 / F.col("_t")).alias("pct")))


def top_k_with_other(df: DataFrame, period: str, label: str, k: int, fill_zero: bool = False) -> DataFrame:
    """Per period, the k most frequent labels and an 'Other' share.

    One aggregate over (period, label), a rank window over the small
    aggregated table, and a second aggregate; no loop over periods.
    ``fill_zero`` adds a zero for each label that is named in some period but
    not in this one."""
    cnt = df.groupBy(period, label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(period).orderBy(F.desc("n"), F.col(label))
    ranked = cnt.withColumn("_rk", F.row_number().over(w)) \
        .withColumn("_tot", F.sum("n").over(Window.partitionBy(period)))
    named = F.when(F.col("_rk") <= k, F.col(label)).otherwise(F.lit("Other"))
    out = (ranked.groupBy(period, named.alias(label))
           .agg(F.sum("n").alias("n"), F.first("_tot").alias("_tot"))
           .select(period, label, F.col("n").cast("long").alias("n"),
                   r6(F.col("n") / F.col("_tot")).alias("share")))
    if not fill_zero:
        return out
    from quarry.operators.reshape import fill_grid
    cells = out.select(period, label, F.struct("n", "share").alias("_c"))
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("share"))
    return fill_grid(cells, [period, label], "_c", none).select(period, label, "_c.n", "_c.share")


def rate_with_total(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Count, events and rate per group."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                              F.sum(F.col(flag).cast("int")).alias("events"))
    return g.select(*keys, "n", F.col("events").cast("long").alias("events"),
                    r6(F.col("events") / F.col("n")).alias("rate"))


def keep_group_best(df: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """Rows equal to their group's maximum score (ties kept).

    Max per group is a partial aggregate joined back on the keys, so a hot
    group is never sorted in one task."""
    best = df.groupBy(*keys).agg(F.max(score).alias("_best"))
    return df.join(best, list(keys)).filter(F.col(score) == F.col("_best")).drop("_best")


def likert_distribution(long: DataFrame, keys: Sequence[str], level: str, levels: Sequence[int]) -> DataFrame:
    """Counts of each response level per group, empty levels as 0.
    The level list is fixed (a scale), the group keys come from the data."""
    cnt = long.groupBy(*keys, level).agg(F.count(F.lit(1)).alias("n"))
    groups = long.select(*keys).distinct()
    grid = groups.withColumn(level, F.explode(F.array(*[F.lit(v) for v in levels])))
    return grid.join(cnt, [*keys, level], "left").select(*keys, level, F.coalesce(F.col("n"), F.lit(0)).alias("n"))
