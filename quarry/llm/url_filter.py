"""URL filters by a sort-merge range join.

A rule is a host and a path prefix with a verdict.  Hosts are written as
reversed labels, each closed by a dot (``blog.example.net`` ->
``net.example.blog.``), so "the host and all its subdomains" is one interval
of keys.  Urls and rules are dealt by key range; each task sweeps its sorted
rows once and keeps the rules whose interval is open on a stack, nested ones
on top.  A wide rule is copied into every range that it overlaps, so no range
needs its neighbours, and the range bounds include the path and a row hash,
so one host with a third of all rows is split like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import partitions

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
SAMPLE_PER_RANGE = 64     # keys sampled per range to place the bounds
BOUND_CHARS = 256         # a bound keeps at most so many characters of a key
TOP = "\U0010ffff"


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _bounds(rows: DataFrame, ranges: int) -> list[bytes]:
    """Range bounds from a sample of bounded size (ranges x 64 short keys)."""
    n = rows.count()
    want = ranges * SAMPLE_PER_RANGE
    if not n or ranges < 2:
        return []
    short = rows.select(F.substring("sort_key", 1, BOUND_CHARS).alias("k"))
    got = sorted(r.k.encode() for r in short.sample(False, min(1.0, 2 * want / n), 7).limit(4 * want).collect())
    return sorted({got[i * len(got) // ranges] for i in range(1, ranges)}) if got else []


def _ranges(bounds: list[bytes], keys: pd.Series) -> np.ndarray:
    if not bounds:
        return np.zeros(len(keys), np.int32)
    edge = np.array(bounds, dtype=object)
    return np.searchsorted(edge, np.array([k.encode() for k in keys], dtype=object), "right").astype(np.int32)


class _Stack:
    """Open rule hosts, outermost first; each holds its path rules by length."""

    def __init__(self) -> None:
        self.open: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []

    def close(self, key: str) -> None:
        while self.open and not key.startswith(self.open[-1][0]):
            self.open.pop()

    def push(self, key: str, path: str, rule: str, verdict: str) -> None:
        if not self.open or self.open[-1][0] != key:
            self.open.append((key, {}, []))
        _, paths, lengths = self.open[-1]
        if path not in paths or verdict == "block":
            paths[path] = (rule, verdict)
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def best(self, path: str) -> tuple[str | None, str | None]:
        found, size = (None, None), -1
        for _, paths, lengths in self.open:
            for n in lengths:
                hit = paths.get(path[:n]) if n <= len(path) else None
                if hit is not None:
                    if len(hit[0]) >= size:
                        found, size = hit, len(hit[0])
                    break
        return found


def _sweep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    stack, here = _Stack(), None
    for frame in frames:
        rules, verdicts, keep = [], [], []
        for where, is_url, key, path, rule, verdict in zip(
                frame["range"], frame["is_url"], frame["key"], frame["path"], frame["rule"], frame["verdict"], strict=True):
            if where != here:
                stack, here = _Stack(), where
            stack.close(key)
            if not is_url:
                stack.push(key, path, rule, verdict)
                continue
            r, v = stack.best(path)
            rules.append(r)
            verdicts.append(v)
        keep = frame[frame["is_url"]]
        yield pd.DataFrame({"id": keep["id"].to_numpy(), "host": keep["host"].to_numpy(), "path": keep["path"].to_numpy(),
                            "rule": pd.Series(rules, dtype=object), "verdict": pd.Series(verdicts, dtype=object)})


def filter_urls(urls: DataFrame, rules: DataFrame, default: str = "allow",
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per url row: id, host, path, the winning rule and the verdict.

    ``urls`` needs ``id_col`` (integer) and ``url_col``; further columns, also
    ones called host, rule or verdict, are ignored.  ``rules`` has host, path
    and verdict (allow or block).  The longest fitting rule wins (host plus
    path, in characters; equal lengths: the narrower host; the same rule
    twice: block).  A null url, or one without ``://``, has an empty host and
    path, fits no rule and gets ``default``; so does every url when there are
    no rules.  Repeated rows and null ids each keep their own result row.  An
    empty table gives an empty result.
    """
    spark = urls.sparkSession
    ranges = partitions(spark)
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    rows = urls.select(F.col(id_col).cast("long").alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("key", host_key(F.col("host")))
    rows = rows.withColumn("sort_key", F.concat_ws("\x00", "key", "path", F.hex(F.xxhash64("id"))))
    bounds = _bounds(rows, ranges)
    given = (rules.where("host is not null and host <> ''")
             .select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                     F.lower("verdict").alias("verdict")).distinct()
             .withColumn("key", host_key(F.col("host"))).withColumn("rule", F.concat("host", "path")))

    def place_urls(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(range=_ranges(bounds, f["sort_key"])).drop(columns="sort_key")

    def place_rules(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            first, last = _ranges(bounds, f["key"]), _ranges(bounds, f["key"] + TOP)
            for a in range(0, len(f), 64):
                part = f.iloc[a:a + 64]
                times = (last - first + 1)[a:a + 64]
                out = part.loc[part.index.repeat(times)].copy()
                out["range"] = np.concatenate([np.arange(x, x + t) for x, t in zip(first[a:a + 64], times, strict=True)]).astype(np.int32)
                yield out

    url_rows = rows.mapInPandas(place_urls, "id long, host string, path string, key string, range int")
    rule_rows = given.mapInPandas(place_rules, "host string, path string, verdict string, key string, rule string, range int")
    columns = ["range", "key", "is_url", "path", "id", "host", "rule", "verdict"]
    both = (url_rows.withColumns({"is_url": F.lit(True), "rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")}).select(columns)
            .unionByName(rule_rows.withColumns({"is_url": F.lit(False), "id": F.lit(None).cast("long")}).select(columns)))
    swept = (both.repartition(ranges, "range").sortWithinPartitions("range", "key", "is_url", "path")
             .mapInPandas(_sweep, "id long, host string, path string, rule string, verdict string"))
    return swept.select(F.col("id").alias(id_col), "host", "path", "rule",
                        F.coalesce("verdict", F.lit(default)).alias("verdict"))
