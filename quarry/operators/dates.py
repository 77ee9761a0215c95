"""Date and time operators (time-zone free: TIMESTAMP_NTZ throughout)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import col, month_start, quarter_start


def parse_any(c: str | Column, formats: Sequence[str]) -> Column:
    """K1: the first format that parses wins; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(col(c), F.lit(f)) for f in formats]).cast("timestamp_ntz")


def repair_clock(c: str | Column) -> Column:
    """K2: free-text clock times ('9.30', '0930', '9:30am', '21h') to 'HH:mm'."""
    t = F.lower(F.trim(col(c)))
    t = F.regexp_replace(t, r"[.h]", ":")
    t = F.regexp_replace(t, r"^(\d{1,2})(\d{2})$", "$1:$2")
    t = F.regexp_replace(t, r"^(\d{1,2})$", "$1:00")
    t = F.regexp_replace(t, r":$", ":00")
    pm = t.endswith("pm")
    t = F.regexp_replace(t, r"\s*(am|pm)$", "")
    hh = F.regexp_extract(t, r"^(\d{1,2}):(\d{2})$", 1).try_cast("int")
    mm = F.regexp_extract(t, r"^(\d{1,2}):(\d{2})$", 2).try_cast("int")
    hh = F.when(pm & (hh < 12), hh + 12).otherwise(hh)
    ok = hh.between(0, 23) & mm.between(0, 59)
    return F.when(ok, F.format_string("%02d:%02d", hh, mm))


def calendar_parts(df: DataFrame, ts: str) -> DataFrame:
    """K3: month, quarter, year, day of year, hour, weekday and month name."""
    return df.select("*", month_start(ts).alias("month"), quarter_start(ts).alias("quarter"),
                     F.year(ts).alias("year"), F.dayofyear(ts).alias("doy"), F.hour(ts).alias("hour"),
                     F.date_format(ts, "EEEE").alias("weekday"), F.date_format(ts, "MMMM").alias("month_name"))


def from_day_hour(year: Column, doy: Column, hour: Column) -> Column:
    """K4: timestamp from (year, day of year, hour)."""
    d = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), doy - 1)
    return F.timestamp_add("HOUR", hour, d.cast("timestamp_ntz"))


def weekdays_in_range(df: DataFrame, ts: str, dow: int, name: str) -> DataFrame:
    """K7: every date with Spark day-of-week ``dow`` (1 = Sunday .. 7 =
    Saturday) between the first and last date of ``ts``.  The range is one
    row; the dates are generated by ``sequence`` + ``explode``."""
    r = df.agg(F.min(F.to_date(ts)).alias("_a"), F.max(F.to_date(ts)).alias("_b"))
    days = r.select(F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 DAY"))).alias(name))
    return days.filter(F.dayofweek(name) == dow)
