"""Projection, schema and recode operators (renames, casts, missing codes,
rule tables, binning, dummies, scores).  Pure column expressions: one
``select`` each, no shuffle."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.columns import col, cut, r6, row_count_nonnull, rules, yes_no

# Missing-value codes seen in the source exports.
MISSING_CODES = ("-1", "Empty", "empty", "__NA", "nan", "-999")


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """B1: bulk rename (names absent from the frame are ignored)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def select_like(df: DataFrame, keep: Sequence[str] = (), contains: str | None = None,
                startswith: str | None = None, regex: str | None = None,
                exclude: str | None = None) -> DataFrame:
    """B2: select columns by name pattern, always keeping ``keep``."""
    def ok(c: str) -> bool:
        hit = ((contains is not None and contains in c) or (startswith is not None and c.startswith(startswith))
               or (regex is not None and re.search(regex, c) is not None))
        return hit and not (exclude is not None and re.search(exclude, c))

    return df.select(*keep, *[c for c in df.columns if c not in keep and ok(c)])


def drop_like(df: DataFrame, regex: str) -> DataFrame:
    """Drop every column whose name matches."""
    return df.drop(*[c for c in df.columns if re.search(regex, c)])


def cast_by_pattern(df: DataFrame, patterns: Sequence[tuple[str, str]],
                    exclude: str | None = None) -> DataFrame:
    """Cast columns by name pattern with ``try_cast`` (bad text -> null);
    the first matching pattern wins; ``exclude`` protects names."""
    out = []
    for c in df.columns:
        target = None
        if not (exclude and re.search(exclude, c)):
            for pat, typ in patterns:
                if re.search(pat, c):
                    target = typ
                    break
        if target == "date":
            out.append(F.try_to_date(F.col(c).cast("string")).alias(c) if hasattr(F, "try_to_date")
                       else F.to_date(F.col(c)).alias(c))
        elif target is not None:
            out.append(F.col(c).try_cast(target).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def nullify(df: DataFrame, codes: Sequence[str] = MISSING_CODES,
            skip: Sequence[str] = ()) -> DataFrame:
    """Turn missing-value codes into null in every string and numeric
    column (date and timestamp columns are skipped, as are ``skip``)."""
    out = []
    num_codes = []
    for c in codes:
        try:
            num_codes.append(float(c))
        except ValueError:
            pass
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in skip:
            out.append(c)
        elif isinstance(f.dataType, T.StringType):
            out.append(F.when(c.isin(*codes), F.lit(None)).otherwise(c).alias(f.name))
        elif isinstance(f.dataType, T.NumericType) and num_codes:
            out.append(F.when(c.isin(*num_codes), F.lit(None)).otherwise(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def sanitise_names(df: DataFrame, label: str | None = None) -> DataFrame:
    """Names with non-word characters replaced by '_', label moved last."""
    cols = [c for c in df.columns if c != label] + ([label] if label else [])
    return df.select(*[F.col(f"`{c}`").alias(re.sub(r"\W+", "_", c).strip("_")) for c in cols])


def dense_row_key(df: DataFrame, order: Sequence[str], name: str = "row_key") -> DataFrame:
    """Dense 1..n row key under a total order, without a single-partition
    window.

    The frame is range-sorted (a distributed sort), each row takes its
    partition id and position, and the small table of per-partition counts
    gives every partition its offset.  The sorted frame is checkpointed
    first so that the counts and the rows cannot diverge on recomputation.
    """
    from quarry.session import cut_lineage

    tagged = (df.orderBy(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = cut_lineage(tagged)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_m0"))
    # one row per partition: bounded by the partition count
    offs = counts.withColumn(
        "_off", F.coalesce(F.sum("_c").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    return (tagged.join(F.broadcast(offs.select("_pid", "_off", "_m0")), "_pid")
            .withColumn(name, F.col("_off") + (F.col("_mid") - F.col("_m0")) + 1)
            .drop("_pid", "_mid", "_off", "_m0"))


def booleans_from_text(df: DataFrame, cols: Sequence[str], yes: str = "Yes",
                       codes: Sequence[str] = MISSING_CODES) -> DataFrame:
    """Yes/No text to nullable booleans (missing codes become null)."""
    out = []
    for c in df.columns:
        if c in cols:
            x = F.when(F.col(c).isin(*codes), F.lit(None)).otherwise(F.col(c))
            out.append(yes_no(x, yes).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def composite_sign(primary: Column, secondary: Column, tertiary: Column) -> Column:
    """Composite of three nullable flags with precedence: any True is
    True; otherwise any False is False; otherwise null."""
    return (F.when(primary | secondary | tertiary, F.lit(True))
            .when((primary == False) | (secondary == False) | (tertiary == False), F.lit(False)))  # noqa: E712


def grams_to_kg(c: str | Column, threshold: float = 100.0) -> Column:
    """Values above ``threshold`` are taken as grams."""
    x = col(c)
    return F.when(x > threshold, x / 1000.0).otherwise(x)


def range_or_null(c: str | Column, lo: float, hi: float) -> Column:
    """Null outside [lo, hi]."""
    x = col(c)
    return F.when(x.between(lo, hi), x)


def assemble_timestamp(date_c: str | Column, time_c: str | Column, default_time: str = "09:00") -> Column:
    """Date + 'HH:mm' text into a timestamp, missing time defaulted."""
    txt = F.concat_ws(" ", F.date_format(col(date_c), "yyyy-MM-dd"),
                      F.coalesce(col(time_c), F.lit(default_time)))
    return F.try_to_timestamp(txt, F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz")


def dose_class(per_kg: Column, lo: Column | float, hi: Column | float) -> Column:
    """Under / Correct / Over against a [lo, hi] band; null stays null."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return rules(None, [(per_kg.isNotNull(), "Correct"), (per_kg < lo_c, "Under"), (per_kg > hi_c, "Over")])


def frequency_per_day(text: str | Column) -> Column:
    """B16: '2hrly' / 'hrly' style text to doses per day (24 / n)."""
    t = F.lower(F.trim(col(text)))
    t = F.regexp_replace(t, r"^hrly$", "1hrly")
    n = F.regexp_extract(t, r"^(\d+)\s*hrly$", 1).try_cast("double")
    return F.when(n > 0, F.lit(24.0) / n)


# Once-daily label, and mg/kg bands of the gentamicin profiles.
ONCE_DAILY = "Once per day/once daily(OD)"
GENTA_BANDS = {"7.5mg": (6.0, 9.0), "5mg": (4.0, 6.0), "3mg": (2.4, 3.6)}
# Frequency labels and the units-per-kg band of both penicillin profiles.
PEN_ONCE, PEN_STAT = "OD/once a day/24hrly", "STAT"
PEN_BD, PEN_TID, PEN_QID = "BD/twice a day/12hrly", "TID/TDS/three times a day/8hrly", "QID/4 times a day/6hrly"
PEN_BAND = (40000.0, 60000.0)


def gentamicin_profile(age_days: Column, weight: Column) -> Column:
    """7.5 mg from 7 days of age, before that 5 mg from 2 kg, else 3 mg."""
    return F.when(age_days >= 7, "7.5mg").when((age_days < 7) & (weight >= 2), "5mg").when((age_days < 7) & (weight < 2), "3mg")


def gentamicin_class(age_days: Column, weight: Column, dose: Column, freq: Column) -> Column:
    """Over above the profile's band or at any but the once-daily
    frequency, else Under below it, else Correct; null without a profile."""
    per_kg, profile = dose / weight, gentamicin_profile(age_days, weight)
    out = None
    for name, (lo, hi) in GENTA_BANDS.items():
        band = (F.when((per_kg > hi) | (freq != ONCE_DAILY), "Over").when(per_kg < lo, "Under")
                .when((per_kg >= lo) & (per_kg <= hi) & (freq == ONCE_DAILY), "Correct"))
        out = F.when(profile == name, band) if out is None else out.when(profile == name, band)
    return out


def penicillin_class(age_days: Column, weight: Column, dose: Column, freq: Column) -> Column:
    """Twice daily up to 7 days of age, four times daily after.  Twice
    daily: Over above the band or at a higher frequency, Under below it or at
    a lower frequency.  Four times daily: Over above the band, Under below it
    or at any other frequency.  Correct within the band at the frequency."""
    per_kg, (lo, hi), f = dose / weight, PEN_BAND, F.trim(freq)
    inside = (per_kg >= lo) & (per_kg <= hi)
    bd = (F.when((per_kg > hi) | f.isin(PEN_TID, PEN_QID), "Over").when(inside & (f == PEN_BD), "Correct")
          .when((per_kg < lo) | f.isin(PEN_ONCE, PEN_STAT), "Under"))
    qid = F.when(per_kg > hi, "Over").when(inside & (f == PEN_QID), "Correct").when((per_kg < lo) | (f != PEN_QID), "Under")
    return F.when(age_days <= 7, bd).when(age_days > 7, qid)


def well_documented(cols: Sequence[str | Column]) -> Column:
    """Every required field present."""
    out = None
    for c in cols:
        t = col(c).isNotNull()
        out = t if out is None else out & t
    return out


def category_codes(df: DataFrame, c: str, name: str) -> DataFrame:
    """0-based alphabetical codes.  Only the distinct values are
    ranked (a table bounded by the category count) and joined back."""
    codes = (df.select(c).filter(F.col(c).isNotNull()).distinct()
             .withColumn(name, (F.dense_rank().over(Window.orderBy(c)) - 1).cast("int")))
    return df.join(codes, c, "left")


def dummies(df: DataFrame, c: str, levels: Sequence[str], reference: str | None = None,
            missing_indicator: bool = False, prefix: str | None = None) -> DataFrame:
    """One 0/1 column per level, the reference level left out;
    optionally a ``<prefix>_nan`` column for nulls."""
    p = prefix or c
    x = F.col(c)
    out = [F.when(x == lv, 1).otherwise(0).alias(f"{p}_{re.sub(r'\W+', '_', str(lv))}")
           for lv in levels if lv != reference]
    if missing_indicator:
        out.append(F.when(x.isNull(), 1).otherwise(0).alias(f"{p}_nan"))
    return df.select("*", *out)


def qcut_edges(df: DataFrame, c: str, q: int) -> DataFrame:
    """B25 (step 1): exact interpolated quantile edges as one row."""
    from quarry.operators.aggregate import quantiles_by
    probs = [i / q for i in range(q + 1)]
    e = quantiles_by(df, [], c, probs=probs, names=[f"_e{i}" for i in range(q + 1)])
    return e.select(F.array(*[F.col(f"_e{i}") for i in range(q + 1)]).alias("_edges"))


def qcut(df: DataFrame, c: str, q: int, labels: Sequence[str], name: str) -> DataFrame:
    """Quantile bins; the minimum is included in the first bin."""
    from quarry.operators.aggregate import with_total

    edges = qcut_edges(df, c, q)
    x = F.col(c)
    e = F.col("_edges")
    expr = None
    for i in range(q):
        cond = (x > e[i]) & (x <= e[i + 1])
        if i == 0:
            cond = (x >= e[0]) & (x <= e[1])
        expr = F.when(cond, F.lit(labels[i])) if expr is None else expr.when(cond, F.lit(labels[i]))
    return with_total(df, edges).withColumn(name, expr).drop("_edges")


def log_floor(c: str | Column, floor: float = 0.01) -> Column:
    """Log with a floor for missing values."""
    return F.log(F.coalesce(col(c).cast("double"), F.lit(floor)))


def standardise(df: DataFrame, cols: Sequence[str], ddof: int = 0, suffix: str = "_z") -> DataFrame:
    """Z-scores; ``ddof=0`` divides by the population SD (scikit
    style), ``ddof=1`` by the sample SD (R ``scale``).  The statistics are
    one global aggregate attached to every row."""
    from quarry.operators.aggregate import with_total

    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[sd(c).alias(f"_s_{c}") for c in cols])
    out = with_total(df, stats)
    for c in cols:
        out = out.withColumn(c + suffix, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}"))
    return out.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def section_scores(df: DataFrame, sections: Mapping[str, Sequence[str]],
                   conditional: Mapping[str, Column] | None = None,
                   summed: Sequence[str] = ()) -> DataFrame:
    """Per row and section, a documentation score and its denominator.

    Most sections count non-null cells; sections in ``summed`` add up TRUE
    values; a section in ``conditional`` only counts (score and
    denominator) on rows where its condition holds, else both are null."""
    conditional = conditional or {}
    out = []
    for s, cols in sections.items():
        if s in summed:
            score = F.lit(0)
            for c in cols:
                score = score + F.coalesce(F.col(c).cast("int"), F.lit(0))
        else:
            score = row_count_nonnull(cols)
        denom = F.lit(len(cols))
        if s in conditional:
            score = F.when(conditional[s], score)
            denom = F.when(conditional[s], denom)
        out += [score.alias(f"{s}_score"), denom.alias(f"{s}_denom")]
    return df.select("*", *out)


__all__ = [n for n in dir() if not n.startswith("_")] + ["cut", "rules", "r6"]
