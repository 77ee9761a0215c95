"""Column-expression builders.

Everything here returns a ``Column`` built from JVM-side functions, so it
stays inside whole-stage code generation.  No Python UDFs.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c: str | Column, digits: int = 6) -> Column:
    """Round a double for stable comparison."""
    return F.round(col(c).cast("double"), digits)


def rules(default: Any, steps: Sequence[tuple[Column, Any]]) -> Column:
    """Ordered conditional update: later rules win.

    Equivalent to applying ``x[pred] <- value`` for each step in order, where
    a null predicate counts as false (data.table semantics).  Built as one
    ``when`` chain that starts from the last rule.
    """
    out = None
    for pred, value in reversed(steps):
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(pred, v) if out is None else out.when(pred, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if out is None else out.otherwise(d)


def first_match(default: Any, steps: Sequence[tuple[Column, Any]]) -> Column:
    """First matching rule wins (``case when``)."""
    return rules(default, list(reversed(list(steps))))


def cut(c: str | Column, breaks: Sequence[float], labels: Sequence[str] | None = None,
        right: bool = True, include_lowest: bool = False) -> Column:
    """Interval binning with R ``cut`` semantics.

    ``right=True`` gives ``(lo, hi]`` bins and the lowest edge is excluded
    unless ``include_lowest``; values outside every bin become null.
    """
    x = col(c)
    n = len(breaks) - 1
    if labels is None:
        labels = [f"({breaks[i]},{breaks[i + 1]}]" if right else f"[{breaks[i]},{breaks[i + 1]})"
                  for i in range(n)]
    out = None
    for i in range(n):
        lo, hi = breaks[i], breaks[i + 1]
        if right:
            cond = (x > lo) & (x <= hi)
            if include_lowest and i == 0:
                cond = (x >= lo) & (x <= hi)
        else:
            cond = (x >= lo) & (x < hi)
            if include_lowest and i == n - 1:
                cond = (x >= lo) & (x <= hi)
        out = F.when(cond, F.lit(labels[i])) if out is None else out.when(cond, F.lit(labels[i]))
    return out


def yes_no(c: str | Column, yes: str = "Yes") -> Column:
    """Text flag to nullable boolean: null stays null."""
    x = col(c)
    return F.when(x.isNull(), F.lit(None).cast("boolean")).otherwise(x == F.lit(yes))


def row_sum(cols: Iterable[str | Column], as_int: bool = True) -> Column:
    """Row-wise sum; booleans count as 0/1, nulls as 0."""
    terms = [F.coalesce(col(c).cast("int" if as_int else "double"), F.lit(0)) for c in cols]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def row_count_nonnull(cols: Iterable[str | Column]) -> Column:
    terms = [F.when(col(c).isNotNull(), 1).otherwise(0) for c in cols]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def row_mean(cols: Sequence[str | Column]) -> Column:
    """Null-aware row mean (``rowMeans(na.rm=TRUE)``); null when all are null."""
    arr = F.filter(F.array(*[col(c).cast("double") for c in cols]), lambda v: v.isNotNull())
    return F.when(F.size(arr) > 0,
                  F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v) / F.size(arr))


def level_rank(c: str | Column, levels: Sequence[str]) -> Column:
    """1-based position of ``c`` in a declared level order, 0 when absent."""
    return F.array_position(F.array(*[F.lit(v) for v in levels]), col(c)).cast("int")


def value_map(c: str | Column, mapping: dict, keep_unmapped: bool = True) -> Column:
    """Simultaneous value recode (one map, never a cascade)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    mapped = F.element_at(m, col(c)) if mapping else F.lit(None)
    return F.coalesce(mapped, col(c)) if keep_unmapped else mapped


def micros_between(a: str | Column, b: str | Column) -> Column:
    """Microseconds from ``a`` to ``b`` (time-zone free on TIMESTAMP_NTZ)."""
    return F.timestamp_diff("MICROSECOND", col(a), col(b))


def hours_between(a: str | Column, b: str | Column) -> Column:
    return micros_between(a, b) / F.lit(3_600_000_000.0)


def minutes_between(a: str | Column, b: str | Column) -> Column:
    return micros_between(a, b) / F.lit(60_000_000.0)


def day_start(ts: str | Column) -> Column:
    """Midnight of a TIMESTAMP_NTZ, still TIMESTAMP_NTZ (no session zone)."""
    return F.to_date(col(ts)).cast("timestamp_ntz")


def month_start(ts: str | Column) -> Column:
    return F.trunc(F.to_date(col(ts)), "MM")


def quarter_start(ts: str | Column) -> Column:
    return F.trunc(F.to_date(col(ts)), "quarter")
