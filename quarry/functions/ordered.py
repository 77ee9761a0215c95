"""Ordered running counts, sums and lags without a single-task window.

A window ``PARTITION BY g ORDER BY o`` puts every row of a group into one
task, and an unpartitioned window puts the whole table there.  When one
group may hold a third of all rows, that task is the job.  The functions
here give the same results at every size, in one way:

1. the rows are dealt by range of (g, o) (a sampled, distributed sort) and
   written once with the number of their range, so a hot group lies in many
   consecutive ranges and the ranges are the same wherever they are read;
2. plain windows over (g, range) count, sum and look back inside a range;
3. only the group that a range begins with can go on from earlier ranges, so
   fewer groups than ranges lie in more than one: their sums per range (at most
   two rows a range, hence broadcast) give what came before.

Several results over one order (``running``) share one placement.

Everything is built-in expressions, so types, nulls and NaN come out as in a
window.  Rows that tie under ``order`` are told apart by a hash of the row.
Step 1 runs when the function is called: the ranges must be fixed before two
branches of a plan can agree on them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

GROUP, PLACE, TIE = "__group", "__place", "__tie"


def _order_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _key(by: Sequence[str]) -> Column:
    """The group as one value: a struct compares nulls as equal."""
    return F.struct(*[F.col(k) for k in by]) if by else F.struct(F.lit(0))


def _placed(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], partitions: int | None) -> DataFrame:
    """The rows with group, range number and tie-break, written once."""
    from quarry.session import ensure_checkpoint_dir

    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    tied = df.withColumn(TIE, F.xxhash64(*hashable))
    ranged = tied.repartitionByRange(n, *[F.col(k) for k in by], *_order_cols(order), F.col(TIE))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ordered-{uuid.uuid4().hex}"
    ranged.withColumn(PLACE, F.spark_partition_id()).write.parquet(path)
    return spark.read.schema(tied.schema.add(PLACE, T.IntegerType())).parquet(path).withColumn(GROUP, _key(by))


def _inside(order: Sequence[str | Column]):
    return Window.partitionBy(GROUP, PLACE).orderBy(*_order_cols(order), F.col(TIE))


def _before(rows: int | None = None):
    """Earlier ranges of a group (the last ``rows`` of them)."""
    first = Window.unboundedPreceding if rows is None else -rows
    return Window.partitionBy(GROUP).orderBy(PLACE).rowsBetween(first, -1)


def _sum_type(df: DataFrame, value: str) -> T.DataType:
    return df.select(F.sum(F.col(value))).schema[0].dataType


def _split(placed: DataFrame) -> DataFrame:
    """Rows of the groups that lie in more than one range.  A boundary between
    ranges is crossed by one group at most: fewer groups than ranges."""
    span = placed.groupBy(GROUP).agg(F.min(PLACE).alias("__lo"), F.max(PLACE).alias("__hi")).where(F.col("__lo") < F.col("__hi"))
    return placed.join(F.broadcast(span.select(GROUP)), GROUP, "left_semi")


@dataclass(frozen=True)
class Running:
    """A running sum of ``value`` (of ones: a position) called ``name``.
    ``within`` narrows the group: rows that agree in these columns too."""
    name: str
    value: str | None = None
    exclusive: bool = False
    within: tuple[str, ...] = ()


def running(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], wanted: Sequence[Running],
            partitions: int | None = None) -> DataFrame:
    """Every ``Running`` of ``wanted`` within ``by`` under ``order`` from one
    placement of the rows (nulls count as 0; the type is that of Spark's
    ``sum``).  Columns of ``df`` that nobody asks for afterwards are best left
    out before: rows are written once."""
    one = "__one"
    placed = _placed(df, by, order, partitions).withColumn(one, F.lit(1).cast("long"))
    split = _split(placed)
    out, sums, parts = placed, [], {}
    for i, r in enumerate(wanted):
        parts.setdefault(r.within, []).append(i)
    value = [F.col(r.value or one) for r in wanted]
    for j, (within, at) in enumerate(parts.items()):
        sub = f"__sub{j}"
        key = F.struct(*[F.col(c) for c in within]) if within else F.lit(0)
        whole = split.withColumn(sub, key).groupBy(GROUP, sub, PLACE).agg(*[F.sum(value[i]).alias(f"__s{i}") for i in at])
        before = Window.partitionBy(GROUP, sub).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, -1)
        offsets = whole.select(GROUP, sub, PLACE, *[F.sum(f"__s{i}").over(before).alias(f"__o{i}") for i in at])
        out = out.withColumn(sub, key)
        inside = Window.partitionBy(GROUP, PLACE, sub).orderBy(*_order_cols(order), F.col(TIE))
        out = out.withColumns({f"__l{i}": F.sum(value[i]).over(
            inside.rowsBetween(Window.unboundedPreceding, -1 if wanted[i].exclusive else 0)) for i in at})
        # without a narrower group two rows a range at most
        out = out.join(offsets if within else F.broadcast(offsets), [GROUP, sub, PLACE], "left")
    for i, r in enumerate(wanted):
        kind = _sum_type(df, r.value) if r.value else T.LongType()
        zero = F.lit(0).cast(kind)
        sums.append((F.coalesce(F.col(f"__l{i}"), zero) + F.coalesce(F.col(f"__o{i}").cast(kind), zero)).cast(kind).alias(r.name))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *sums)


def running_index(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], name: str = "idx",
                  partitions: int | None = None) -> DataFrame:
    """1-based position (long) of each row within its ``by`` group under
    ``order``."""
    return running(df, by, order, [Running(name)], partitions)


def running_sum(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], value: str, name: str,
                exclusive: bool = False, partitions: int | None = None) -> DataFrame:
    """Running sum of ``value`` within ``by`` under ``order`` (nulls count as
    0), in the type of Spark's ``sum``: long for integers, decimal for
    decimals.  ``exclusive`` leaves out the current row."""
    return running(df, by, order, [Running(name, value, exclusive)], partitions)


def running_sums(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], sums: dict[str, str],
                 exclusive: bool = False, partitions: int | None = None) -> DataFrame:
    """``running_sum`` of several columns (value: name) at the cost of one."""
    return running(df, by, order, [Running(n, v, exclusive) for v, n in sums.items()], partitions)


def global_cumsum(df: DataFrame, order: Sequence[str | Column], values: Sequence[str], exclusive: bool = False,
                  suffix: str = "_cum", partitions: int | None = None) -> DataFrame:
    """Running sums over one global order (no grouping), e.g. ranks over the
    distinct values of a score.  Adds ``<value><suffix>`` columns."""
    return running(df, [], order, [Running(f"{v}{suffix}", v, exclusive) for v in values], partitions)


def lags(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], cols: Sequence[str], depth: int, name: str,
         partitions: int | None = None) -> DataFrame:
    """The ``depth`` rows before each row within ``by`` under ``order``, as an
    array of structs of ``cols``, nearest first (shorter at a group's start).
    One pass whatever the depth: the last ``depth`` rows of each range are
    what the next ranges can look back to."""
    placed = _placed(df, by, order, partitions)
    row = F.struct(*[F.col(c) for c in cols])
    # newest first, like the result
    split = _split(placed)
    held = split.select(GROUP, PLACE, row.alias("__row"), F.row_number().over(_inside(order)).alias("__n"),
                        F.count(F.lit(1)).over(Window.partitionBy(GROUP, PLACE)).alias("__of"))
    tail = held.where(F.col("__of") - F.col("__n") < depth).groupBy(GROUP, PLACE).agg(
        F.reverse(F.array_sort(F.collect_list(F.struct("__n", "__row")))).alias("__tail"))
    # ranges of a group from the nearest back; each holds one row at least, so depth ranges are enough
    lists = F.reverse(F.collect_list(F.col("__tail")).over(_before(depth)))
    earlier = tail.select(GROUP, PLACE, F.slice(F.transform(F.flatten(lists), lambda x: x["__row"]), 1, depth).alias("__earlier"))
    near = F.reverse(F.collect_list(row).over(_inside(order).rowsBetween(-depth, -1)))
    # two rows a range at most, each of depth rows
    out = placed.withColumn("__near", near).join(F.broadcast(earlier), [GROUP, PLACE], "left")
    both = F.slice(F.concat("__near", F.coalesce("__earlier", F.array().cast(out.schema["__near"].dataType))), 1, depth)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], both.alias(name))


def lag(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], cols: Sequence[str],
        suffix: str = "_prev", partitions: int | None = None) -> DataFrame:
    """Previous row's value of each column within ``by`` under ``order``
    (null on a group's first row)."""
    out = lags(df, by, order, cols, 1, "__lag", partitions)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[F.get("__lag", F.lit(0))[c].alias(f"{c}{suffix}") for c in cols])
