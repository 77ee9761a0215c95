"""Behaviour patterns in ordered step sequences, as a state machine whose
transitions are composed over ranges of rows.

A sequence holds step numbers ``first`` .. ``last`` in the order they were
taken.  For a window length ``n`` the machine looks at the ``n`` steps from
each row on (rows with fewer are passed over):

* streak: the steps count up by one, from ``last`` on to ``first`` again;
* wheel-spin: all steps are the same;
* drop-out: the window ends with a return to ``first`` from a step other than
  ``last`` (not counted where the window counts up plainly).

After a streak or wheel-spin the next ``n - 1`` rows are skipped: of them only
the first return to ``first`` is looked at for a drop-out.

The state before a row is how many rows are still to be skipped and whether
their return was found: ``2 n - 1`` states.  What a stretch of rows does to
every state is a small table; tables of neighbouring stretches compose.  Rows
are dealt by range of (user, order), each range gives the tables of its users'
stretches, and a user who lies in many ranges is put together from them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.ordered import lags
from quarry.operators.staged import written

Totals = tuple[int, int, int, int]        # state after, streaks, wheel-spins, drop-outs


def state_number(skip: int, found: bool) -> int:
    return 0 if not skip else 2 * skip - 1 + found


def state_of(number: int) -> tuple[int, bool]:
    return ((number + 1) // 2, number % 2 == 0) if number else (0, False)


def _marks(steps: np.ndarray, first: int, last: int) -> tuple[np.ndarray, ...]:
    """Per window (row of ``steps``): streak, wheel-spin, return to the first
    step at its end, whether that return is a drop-out, and plain count-up."""
    n = steps.shape[1]
    plain = (steps == steps[:, :1] + np.arange(n)).all(axis=1)
    spin = (steps == steps[:, :1]).all(axis=1)
    # up to the first ``last`` and on from ``first``
    ten = steps == last
    at = np.where(ten.any(axis=1), ten.argmax(axis=1), n)
    place = np.arange(n)[None, :]
    wrapped = np.where(place <= at[:, None], last - at[:, None] + place, place - at[:, None] + first - 1)
    streak = plain | (ten.any(axis=1) & ~spin & (steps == wrapped).all(axis=1))
    back = steps[:, -1] == first
    return streak, spin, back, steps[:, -2] != last, plain


def stretch(steps: np.ndarray, first: int, last: int, starts: Sequence[int]) -> list[Totals]:
    """What the windows ``steps`` (in order, all full) do to each of the given
    states: the state after and the counts on the way."""
    m, n = steps.shape
    streak, spin, back, away, plain = (x.tolist() for x in _marks(steps, first, last)) if m else ([], [], [], [], [])
    next_back = [m] * (m + 1)
    for i in range(m - 1, -1, -1):
        next_back[i] = i if back[i] else next_back[i + 1]

    def skipping(i: int, rows: int, found: bool) -> tuple[int, bool]:
        """Drop-outs in ``rows`` skipped rows from ``i`` on, and whether the return was found."""
        at = next_back[min(i, m)]
        if found or at >= min(m, i + rows):
            return 0, found
        return int(away[at]), True

    after: list[Totals] = [(0, 0, 0, 0)] * (m + 1)
    for i in range(m - 1, -1, -1):
        drop = int(not plain[i] and back[i] and away[i])
        if not (streak[i] or spin[i]):
            end, s, w, d = after[i + 1]
            after[i] = (end, s, w, d + drop)
            continue
        more, found = skipping(i + 1, n - 1, False)
        left = i + n - m
        end, s, w, d = after[i + n] if left <= 0 else (state_number(left, found), 0, 0, 0)
        after[i] = (end, s + streak[i], w + spin[i], d + drop + more)
    out = []
    for number in starts:
        skip, found = state_of(number)
        more, found = skipping(0, skip, found)
        end, s, w, d = after[skip] if skip <= m else (state_number(skip - m, found), 0, 0, 0)
        out.append((end, s, w, d + more))
    return out


def behaviour_patterns(df: DataFrame, user: str, order: Sequence[str | Column], step: str, lengths: Sequence[int] = range(3, 11),
                       first: int = 1, last: int = 10, partitions: int | None = None) -> DataFrame:
    """F16: per user and window length (``lookback``): ``streaks``,
    ``wheelspins`` and ``dropouts``.  Users with fewer steps than a window have
    zeros.  Steps are integers; rows without a step are left out."""
    lengths = sorted(lengths)
    if lengths[0] < 2:
        raise ValueError("windows have two steps at least")
    rows = df.where(F.col(step).isNotNull()).withColumn("__step", F.col(step).cast("long"))
    columns = [F.col(o) if isinstance(o, str) else o for o in order]
    names = [f"__o{i}" for i in range(len(columns))]
    keyed = rows.select(F.col(user), "__step", *[c.alias(n) for c, n in zip(columns, names, strict=True)], F.monotonically_increasing_id().alias("__row"))
    keyed = written(keyed)                                       # the row numbers that break ties are fixed
    behind = lags(keyed, [user], [F.desc(n) for n in [*names, "__row"]], ["__step"], lengths[-1] - 1, "__next", partitions)
    seen = behind.select(user, *names, "__row", F.concat(F.array("__step"), F.transform("__next", lambda x: x["__step"])).alias("steps"))
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = seen.repartitionByRange(n, user, *names, "__row").sortWithinPartitions(user, *names, "__row").select(user, "steps")

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial, held, opening = TaskContext.get().partitionId(), 0, None, True

        def table(users: pa.Array, steps: list) -> pa.RecordBatch:
            nonlocal serial, opening
            out = []
            for length in lengths:
                full = np.array([s[:length] for s in steps if len(s) >= length], np.int64).reshape(-1, length)
                starts = range(2 * length - 1) if opening else (0,)
                out += [(length, start, *t) for start, t in zip(starts, stretch(full, first, last, starts), strict=True)]
            opening = False
            k, own = len(out), users.slice(0, 1)
            serial += 1
            return pa.RecordBatch.from_arrays([own.take(pa.array([0] * k)), pa.array([(part << 32) + serial] * k), *(
                pa.array(c, pa.int32() if i < 3 else pa.int64()) for i, c in enumerate(zip(*out, strict=True)))],
                names=[user, "place", "lookback", "start", "end", "s", "w", "d"])

        for batch in batches:
            if not batch.num_rows:
                continue
            users, steps = batch.column(user), batch.column("steps").to_pylist()
            values = users.to_pylist()
            edge = [0, *[i for i in range(1, len(values)) if values[i] != values[i - 1]], len(values)]
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                if held is not None and (held[1] != values[a] or len(held[2]) >= STRETCH):
                    # a long stretch is closed as a table: what follows is the next one, from any state
                    same = held[1] == values[a]
                    yield table(held[0], held[2])
                    opening, held = same, None
                if held is None:
                    held = (users.slice(a, 1), values[a], [])
                held[2].extend(steps[a:b])
        if held is not None:
            yield table(held[0], held[2])

    kind = ranged.select(user).schema
    for name, t in (("place", "long"), ("lookback", "integer"), ("start", "integer"), ("end", "integer"), ("s", "long"), ("w", "long"), ("d", "long")):
        kind = kind.add(name, t)
    parts = ranged.mapInArrow(tables, kind)
    entries = F.array_sort(F.collect_list(F.struct("place", "start", "end", "s", "w", "d")))       # a user's ranges, not rows
    zero = F.struct(F.lit(-1).cast("long").alias("place"), F.lit(0).alias("state"), *[F.lit(0).cast("long").alias(c) for c in "swd"])

    def apply(acc: Column, e: Column) -> Column:
        fits = (e["place"] > acc["place"]) & (e["start"] == acc["state"])
        moved = F.struct(e["place"].alias("place"), e["end"].alias("state"), *[(acc[c] + e[c]).alias(c) for c in "swd"])
        return F.when(fits, moved).otherwise(acc)

    total = F.aggregate(entries, zero, apply)
    return parts.groupBy(user, "lookback").agg(total.alias("t")).select(
        user, "lookback", F.col("t.s").alias("streaks"), F.col("t.w").alias("wheelspins"), F.col("t.d").alias("dropouts"))


STRETCH = 100_000         # rows of one user that a task holds before it closes a table
