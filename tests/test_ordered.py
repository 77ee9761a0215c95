"""Distributed running counts / sums equal the window results, also with a
hot group spread over several partitions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions.ordered import global_cumsum, lag, running_index, running_sum


def _data(spark):
    # group 0 holds half of all rows (a hot key)
    return spark.range(0, 4000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 37).alias("g"),
        F.col("id"), ((F.col("id") * 7) % 13).cast("double").alias("v"))


def test_running_index_matches_window(spark):
    df = _data(spark)
    got = running_index(df, ["g"], ["v", "id"], "pos", partitions=7)
    w = Window.partitionBy("g").orderBy("v", "id")
    exp = df.withColumn("pos", F.row_number().over(w))
    assert got.select("id", "pos").exceptAll(exp.select("id", F.col("pos").cast("long").alias("pos"))).count() == 0
    assert got.count() == 4000


def test_running_sum_exclusive(spark):
    df = _data(spark)
    got = running_sum(df, ["g"], ["id"], "v", "s", exclusive=True, partitions=5)
    w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.withColumn("s", F.coalesce(F.sum("v").over(w), F.lit(0.0)))
    assert got.select("id", "s").exceptAll(exp.select("id", "s")).count() == 0


def test_global_cumsum(spark):
    df = _data(spark)
    got = global_cumsum(df, ["id"], ["v"], partitions=6).orderBy("id").select("v_cum").collect()
    vals = [r[0] for r in df.orderBy("id").select("v").collect()]
    acc, exp = 0.0, []
    for x in vals:
        acc += x
        exp.append(acc)
    assert [r[0] for r in got] == exp


def test_dense_row_key(spark):
    from quarry.operators.recode import dense_row_key
    df = _data(spark)
    k = dense_row_key(df, ["v", "id"]).select("row_key").collect()
    assert sorted(r[0] for r in k) == list(range(1, 4001))


def test_lag_matches_window_across_partitions(spark):
    from quarry.functions.ordered import lag
    df = _data(spark)
    got = lag(df, ["g"], ["id"], ["v"], partitions=9)
    w = Window.partitionBy("g").orderBy("id")
    exp = df.withColumn("v_prev", F.lag("v").over(w))
    assert got.select("id", "v_prev").exceptAll(exp.select("id", "v_prev")).count() == 0
    assert got.filter(F.col("v_prev").isNull()).count() == df.select("g").distinct().count()


def test_distributed_quantiles_equal_percentile(spark):
    from quarry.operators.aggregate import quantiles_by
    df = _data(spark).withColumn("v", F.col("v") * 1.5 + (F.col("id") % 3))
    a = quantiles_by(df, ["g"], "v", probs=(0.1, 0.5, 0.9), names=("a", "b", "c"))
    b = quantiles_by(df, ["g"], "v", probs=(0.1, 0.5, 0.9), names=("a", "b", "c"), skew_safe=False)
    ra = {r["g"]: (round(r["a"], 9), round(r["b"], 9), round(r["c"], 9)) for r in a.collect()}
    rb = {r["g"]: (round(r["a"], 9), round(r["b"], 9), round(r["c"], 9)) for r in b.collect()}
    assert ra == rb
    one = quantiles_by(df, [], "v").first()
    two = quantiles_by(df, [], "v", skew_safe=False).first()
    assert [round(x, 9) for x in one] == [round(x, 9) for x in two]


def _typed(spark):
    from decimal import Decimal
    big = 2 ** 53 + 1
    rows = [(g, i, (big + i) if i % 5 else None, float("nan") if i == 7 else (None if i % 4 == 1 else i / 2.0),
             Decimal(i) / 4, i % 2 == 0 if i % 3 else None, None if i % 6 == 0 else f"s{i}") for i in range(120) for g in (None, 1, 2) if (i + (g or 0)) % 3]
    return spark.createDataFrame(rows, "g int, i int, l long, d double, m decimal(20,2), b boolean, s string")


def test_types_nulls_and_nan_are_those_of_a_window(spark):
    from quarry.functions.ordered import lag, lags
    df = _typed(spark)
    w = Window.partitionBy("g").orderBy("i")
    for n in (1, 7):
        for c, zero in (("l", F.lit(0).cast("long")), ("m", F.lit(0).cast("decimal(30,2)")), ("i", F.lit(0).cast("long"))):
            got = running_sum(df, ["g"], ["i"], c, "r", partitions=n)
            want = df.withColumn("r", F.coalesce(F.sum(c).over(w), zero))
            assert got.schema["r"].dataType == want.schema["r"].dataType
            assert got.exceptAll(want).count() == 0 and got.count() == want.count()
        got = running_sum(df, ["g"], ["i"], "d", "r", partitions=n).orderBy("g", "i").select("r").collect()
        want = df.withColumn("r", F.coalesce(F.sum("d").over(w), F.lit(0.0))).orderBy("g", "i").select("r").collect()
        assert [str(round(a.r, 6)) for a in got] == [str(round(a.r, 6)) for a in want]
        cols = ["l", "d", "m", "b", "s"]
        got = lag(df, ["g"], ["i"], cols, partitions=n)
        want = df.select("*", *[F.lag(c).over(w).alias(f"{c}_prev") for c in cols])
        assert got.dtypes == want.dtypes and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        got = lags(df, ["g"], ["i"], ["l", "s"], 5, "p", partitions=n)
        want = df.withColumn("p", F.reverse(F.collect_list(F.struct("l", "s")).over(w.rowsBetween(-5, -1))))
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_ties_and_empty_input(spark):
    df = spark.range(0, 300).select((F.col("id") % 2).alias("v"), F.col("id"))
    got = [r.idx for r in running_index(df, [], ["v"], partitions=6).collect()]
    assert sorted(got) == list(range(1, 301))
    assert running_index(df.limit(0), ["v"], ["id"]).count() == 0
