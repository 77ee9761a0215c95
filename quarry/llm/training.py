"""Bounded, repeatable samples for fitting the classifiers on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = 1_000_000


def rank_of(*key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    return F.pmod(F.xxhash64(*key, F.lit("sample")), F.lit(PARTS)) / F.lit(float(PARTS))


def sample_per_class(rows: DataFrame, key: list[str], label: str, per_class: int, max_classes: int) -> DataFrame:
    """At most about ``per_class`` different rows of each class, chosen by a
    hash of the columns ``key`` (rows that agree in them count as one, however
    many they are): one count per class, one filter, and a ``distinct`` of
    what it lets through.  No class is gathered.  More than ``max_classes``
    classes are an error: none is left unlearned silently."""
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().limit(max_classes + 1).collect()}
    if len(counts) > max_classes:
        raise ValueError(f"more than {max_classes} values of {label}")
    if not counts:
        return rows.limit(0)
    share = F.lit(None).cast("double")
    for value, n in counts.items():
        share = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, per_class / n))).otherwise(share)
    return rows.where(rank_of(*[F.col(k) for k in key]) < share).dropDuplicates([*key, label])
