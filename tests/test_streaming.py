"""Stream = batch: draining landed status files with availableNow gives the
same rows as the batch transformation of the same statuses."""

from pyspark.sql import functions as F

from quarry.plans.views import Views
from quarry.sources.readers import status_rows
from quarry.streaming import statuses as st


def test_status_stream_equals_batch(spark, sf):
    posts = Views(spark, sf).posts
    statuses = st.statuses_from_posts(posts)
    landing = st.scratch(spark, "t-landing")
    st.land(statuses, landing)
    streamed = st.stream_rows(spark, landing, st.scratch(spark, "t-rows"), st.scratch(spark, "t-ckpt"))
    batch = status_rows(spark.read.schema(st.STATUS_SCHEMA).json(landing))
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0


def test_dedup_stream_keeps_one_row_per_id(spark, sf):
    posts = Views(spark, sf).posts
    landing = st.scratch(spark, "t-landing2")
    st.land(st.statuses_from_posts(posts), landing)
    out = st.stream_dedup(spark, landing, st.scratch(spark, "t-dedup"), st.scratch(spark, "t-dedup-ckpt"))
    assert out.count() == out.select("id").distinct().count() == posts.count()


def test_posts_that_repeat_none_are_not_joined(spark):
    """Null keys of a join meet in one task, whatever the number of tasks."""
    n = 4000
    posts = spark.range(n).selectExpr("id", "'h' AS handle", "concat('text ', id) AS text", "'en' AS lang", "timestamp_ntz'2024-01-01' AS ts",
                                      "if(id % 100 = 7, if(id % 200 = 7, id - 7, -1L), NULL) AS retweeted", "id AS likes", "id AS retweets")
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        rows = st.statuses_from_posts(posts)
        assert max(r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()) < 0.6 * n
        got = {r.id: r.retweeted_status and r.retweeted_status.id for r in rows.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i - 7 if i % 200 == 7 else None for i in range(n)}
