"""Ordered, per-group operators built on window functions.

Every window takes an explicit total order (a unique tie-break column is
part of ``order``), because Spark rows have no file order.  Windows are
partitioned by an entity key (user, site, item); the one unpartitioned
window (``cumulative_share``) only runs on an already aggregated table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.columns import col, r6, rules


def _w(by: Sequence[str], order: Sequence[str | Column]):
    return Window.partitionBy(*by).orderBy(*[col(o) for o in order])


def running_index(df: DataFrame, by: Sequence[str], order: Sequence[str | Column],
                  name: str = "idx", skew_safe: bool = True) -> DataFrame:
    """1-based running index per group (``cumcount() + 1``).

    ``skew_safe`` (default) computes it with ``functions.ordered`` (range
    partitions, no single task per group); otherwise a plain window."""
    if skew_safe:
        from quarry.functions import ordered
        return ordered.running_index(df, by, order, name).withColumn(name, F.col(name).cast("int"))
    return df.withColumn(name, F.row_number().over(_w(by, order)))


def running_total(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], value: str,
                  name: str, exclusive: bool = False, skew_safe: bool = True) -> DataFrame:
    """Running sum per group; ``exclusive`` excludes the current row
    and yields 0 on the first row.  Integral inputs give a long result."""
    if skew_safe:
        from quarry.functions import ordered
        return ordered.running_sum(df, by, order, value, name, exclusive=exclusive)
    hi = -1 if exclusive else 0
    w = _w(by, order).rowsBetween(Window.unboundedPreceding, hi)
    s = F.sum(value).over(w)
    return df.withColumn(name, F.coalesce(s, F.lit(0)) if exclusive else s)


def lag_diff(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], value: str,
             prev: str, diff: str, skew_safe: bool = True) -> DataFrame:
    """previous value and first difference per group."""
    if skew_safe:
        from quarry.functions import ordered
        out = ordered.lag(df, by, order, [value], suffix="__prev").withColumnRenamed(f"{value}__prev", prev)
    else:
        out = df.withColumn(prev, F.lag(value).over(_w(by, order)))
    return out.withColumn(diff, F.col(value) - F.col(prev))


def session_gaps(df: DataFrame, by: Sequence[str], start: str, duration_s: str,
                 tie: str, mode: str = "reference") -> DataFrame:
    """minutes from the previous session, spacing class and log gap.

    ``mode='reference'`` adds the previous session's duration to the
    start-to-start difference (the published behaviour); ``mode='idle'``
    subtracts it.  The first session gets gap type 'None' and log(0.01).
    """
    from quarry.functions import ordered
    order = [start] if tie == start else [start, tie]
    lagged = ordered.lag(df, by, order, [start, duration_s], suffix="__prev")
    prev_start = F.col(f"{start}__prev")
    prev_dur = F.col(f"{duration_s}__prev") / 60.0
    base = F.timestamp_diff("MICROSECOND", prev_start, F.col(start)) / 60_000_000.0
    gap = base + prev_dur if mode == "reference" else base - prev_dur
    out = lagged.withColumn("gap_min", gap).drop(f"{start}__prev", f"{duration_s}__prev")
    g = F.col("gap_min")
    gtype = rules("None", [(g.isNotNull(), "Massed"), (g >= 60, "Spaced"), (g >= 60 * 24, "Distributed")])
    return (out.withColumn("gap_type", gtype)
            .withColumn("gap_log", r6(F.log(F.coalesce(g, F.lit(0.01)))))
            .withColumn("gap_min", r6(g)))


def normalised_gain(pre: str | Column, post: str | Column, ceiling: float) -> Column:
    """normalised gain (post - pre) / (ceiling - pre), or (post - pre) /
    pre when the score fell; 0 when pre == post at either bound."""
    a, b = col(pre), col(post)
    return (F.when(a.isNull() | b.isNull(), F.lit(None))
            .when((a == b) & ((a == 0) | (a == ceiling)), F.lit(0.0))
            .when(b >= a, (b - a) / (F.lit(ceiling) - a))
            .otherwise((b - a) / a))


def cumulative_share(df: DataFrame, order: Sequence[str | Column], value: str) -> DataFrame:
    """cumulative count and running percent of the final total.

    Runs over an aggregated table (a few hundred category rows): the
    unpartitioned window is bounded by the number of categories."""
    w = Window.orderBy(*[col(o) for o in order]).rowsBetween(Window.unboundedPreceding, 0)
    tot = F.sum(value).over(Window.partitionBy())
    return (df.withColumn("cum_n", F.sum(value).over(w))
            .withColumn("cum_pct", r6(F.col("cum_n") * 100.0 / tot)))


def relative_period(df: DataFrame, by: Sequence[str], order: str, name: str = "rel_period",
                    last: int | None = None) -> DataFrame:
    """F8: period index relative to the newest period of the group
    (0 = newest, -1 = the one before, ...); optionally keep the last N."""
    w = _w(by, [order])
    out = (df.withColumn("_i", F.row_number().over(w))
           .withColumn(name, F.col("_i") - F.max("_i").over(Window.partitionBy(*by)))
           .drop("_i"))
    if last is not None:
        out = out.filter(F.col(name) > -last)
    return out


def last_periods(df: DataFrame, by: Sequence[str], order: str, n: int,
                 name: str = "period_idx", drop_newest: bool = True) -> DataFrame:
    """the last ``n`` periods per group, the newest dropped when asked,
    re-indexed from 1 (oldest kept) upward."""
    w = _w(by, [F.col(order).desc()])
    out = df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
    if drop_newest:
        out = out.filter(F.col("_r") > 1)
    w2 = _w(by, [order])
    return out.drop("_r").withColumn(name, F.row_number().over(w2))


def latest_value(df: DataFrame, by: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """the value of the latest record per group (max_by over a total
    order), as a partial aggregate."""
    return df.groupBy(*by).agg(F.max_by(F.col(value), F.struct(*[F.col(o) for o in order])).alias(value))


def repair_repeats(df: DataFrame, by: Sequence[str], order: Sequence[str], start: str,
                   duration_s: str, pad_s: int = 3) -> DataFrame:
    """records written repeatedly under one session start are moved:
    repeat k starts at the previous start plus ceil(duration) + pad seconds,
    cumulatively.  An exclusive running sum replaces the row loop."""
    from quarry.functions import ordered
    keys = list(by) + [start]
    x = df.withColumn("_step", (F.ceil(F.col(duration_s)) + pad_s).cast("long"))
    x = ordered.running(x, keys, order, [ordered.Running("_off", "_step", exclusive=True), ordered.Running("repeat_no")]) \
        .withColumn("repeat_no", F.col("repeat_no").cast("int"))
    return x.withColumn("fixed_start", F.timestamp_add("SECOND", F.col("_off").cast("long"), F.col(start))) \
        .drop("_step", "_off")


def sliding_sequences(df: DataFrame, by: Sequence[str], order: Sequence[str], fields: Sequence[str],
                      length: int, name: str = "seq", skew_safe: bool = True) -> DataFrame:
    """every window of ``length`` consecutive steps per group, as an
    array of structs (incomplete tail windows dropped).

    ``skew_safe`` (default) looks back over the reversed order in one pass
    (``functions.ordered.lags``), so no group is ever held by one task.
    Otherwise a bounded window frame ``rowsBetween(0, length - 1)`` is used."""
    if not skew_safe:
        w = _w(by, order).rowsBetween(0, length - 1)
        return (df.withColumn(name, F.collect_list(F.struct(*[F.col(f) for f in fields])).over(w))
                .filter(F.size(name) == length))
    return sequences_up_to(df, by, order, fields, [length], name).drop("length")


def sequences_up_to(df: DataFrame, by: Sequence[str], order: Sequence[str], fields: Sequence[str],
                    lengths: Sequence[int], name: str = "seq") -> DataFrame:
    """the sequences of every length in ``lengths`` that begin at each
    step (incomplete ones dropped), from one look ahead of the longest; column
    ``length`` tells them apart."""
    from quarry.functions import ordered
    desc = [F.col(o).desc() for o in order]
    ahead = ordered.lags(df, by, desc, list(fields), max(lengths) - 1, "_ahead")
    whole = ahead.withColumn("_ahead", F.concat(F.array(F.struct(*[F.col(f) for f in fields])), "_ahead"))
    each = whole.withColumn("length", F.explode(F.array(*[F.lit(n) for n in lengths]))).filter(F.size("_ahead") >= F.col("length"))
    return each.withColumn(name, F.slice("_ahead", F.lit(1), F.col("length"))).drop("_ahead")


def step_transitions(df: DataFrame, by: Sequence[str], order: Sequence[str], state: str) -> DataFrame:
    """Step-to-step transition counts with row-normalised rates."""
    from quarry.functions import ordered
    # lead over ascending order = lag over descending order (skew-safe path)
    desc = [(F.col(o) if isinstance(o, str) else o).desc() for o in order]
    nxt = ordered.lag(df.select(*by, *[o for o in order if isinstance(o, str)], state), by, desc, [state],
                      suffix="__next").withColumnRenamed(f"{state}__next", "next_state")
    pairs = (nxt.filter(F.col("next_state").isNotNull())
             .groupBy(F.col(state).alias("from_state"), "next_state").agg(F.count(F.lit(1)).alias("n")))
    tot = pairs.groupBy("from_state").agg(F.sum("n").alias("_t"))
    return pairs.join(tot, "from_state").select("from_state", "next_state", "n",
                                                r6(F.col("n") / F.col("_t")).alias("rate"))


def top_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """Global top-n; ``order`` must end in a unique key."""
    return df.orderBy(*[col(o) for o in order]).limit(n)


def top_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], n: int,
                    name: str = "rank") -> DataFrame:
    """Top-n rows per group by row_number over a total order."""
    return df.withColumn(name, F.row_number().over(_w(by, order))).filter(F.col(name) <= n)
