"""Parquet table access for the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Lazy, per-call cache of ``spark.read.parquet`` handles.

    Reading is lazy in Spark anyway; caching the handle only avoids
    re-listing files when one query uses a table several times.  Column
    pruning and filter push-down still reach the scan because nothing here
    projects or materialises.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._cache[name]

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)
