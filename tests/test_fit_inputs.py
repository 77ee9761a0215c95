"""What model fits read: computed once, dealt evenly, joined without a shuffle by class."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import evaluate, models


def cases(spark, n=3000):
    return spark.range(0, n, 1, 2).selectExpr("id", "cast(id % 7 AS double) AS a", "cast(pmod(xxhash64(id), 100) AS double) AS b",
                                              "cast(pmod(xxhash64(id, 5), 100) < 20 + 5 * (id % 7) AS int) AS y", "id % 4 AS stratum")


@pytest.fixture
def counted(spark):
    """(table, how often its rows were computed): a pass counts what it sees."""
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return lambda df: df.mapInArrow(watch, df.schema), seen


def test_fits_compute_their_rows_once(spark, counted):
    watch, seen = counted
    df = cases(spark, 900)
    got = models.repeated_grid_search(watch(df), ["a", "b"], "y", ["id"], regs=(0.1,)).first()
    assert got.n_fits == 6 and 0.5 < got.roc_auc < 1
    assert seen.value <= 900
    assert models.top_importances(watch(df), ["a", "b"], "y").count() == 2
    assert seen.value <= 2 * 900


def test_rows_are_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr(models, "TASK_ROWS", 250)
    got = models.for_fits(cases(spark).coalesce(1), ["a", "y", "a"])
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert got.columns == ["a", "y"] and sum(sizes) == 3000 and max(sizes) <= 260


def test_classes_and_strata_are_looked_up(spark):
    off = {"spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        for df in (models.class_weights(cases(spark), "y"), evaluate.stratified_folds(cases(spark), "stratum", F.col("id").cast("string"), 3)):
            assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()
            assert df.count() == 3000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
