"""Structured Streaming: post statuses landing as JSON files.

P1 turns a file stream of status records into post rows (the batch rule of
``sources.readers.status_rows``, applied per micro-batch); P2 suppresses
ids that arrive more than once with a watermark on the post time.  Both
run with ``availableNow`` so a test or a scheduled job drains what has
landed and stops; state and output live under the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir
from quarry.sources.readers import STATUS_SCHEMA, status_rows  # noqa: F401 (re-exported)


def statuses_from_posts(posts: DataFrame) -> DataFrame:
    """Status records (nested JSON layout) for the posts view; a repost
    embeds the status of the post it repeats.  Posts that repeat none are not
    joined: their null keys would all meet in one task."""
    def status(prefix: str):
        def c(name):
            return F.col(f"{prefix}.{name}")
        return F.struct(
            c("id").alias("id"), F.date_format(c("ts"), "yyyy-MM-dd HH:mm:ss").alias("created_at"),
            c("text").alias("full_text"), c("likes").alias("favorite_count"), c("retweets").alias("retweet_count"),
            F.struct(c("handle").alias("screen_name"), (c("id") % 1000).alias("followers_count"),
                     c("lang").alias("location")).alias("user"),
            F.struct(F.transform(F.regexp_extract_all(c("text"), F.lit(r"#([A-Za-z0-9_]+)"), 1),
                                 lambda t: F.struct(t.alias("text"))).alias("hashtags"),
                     F.transform(F.regexp_extract_all(c("text"), F.lit(r"@([A-Za-z0-9_]+)"), 1),
                                 lambda t: F.struct(t.alias("screen_name"))).alias("user_mentions")).alias("entities"))

    s = status("a")
    own = [s[f].alias(f) for f in ("id", "created_at", "full_text", "favorite_count", "retweet_count", "user", "entities")]
    o = posts.alias("o")
    reposts = posts.where(F.col("retweeted").isNotNull()).alias("a").join(o, F.col("a.retweeted") == F.col("o.id"), "left").select(
        *own, F.when(F.col("o.id").isNotNull(), status("o")).alias("retweeted_status"))
    plain = posts.where(F.col("retweeted").isNull()).alias("a").select(*own, F.lit(None).cast(reposts.schema["retweeted_status"].dataType).alias("retweeted_status"))
    return plain.unionByName(reposts)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def land(statuses: DataFrame, path: str) -> None:
    """Write status records as JSON files (the landing zone), one per task."""
    statuses.write.mode("overwrite").json(path)


def stream_rows(spark: SparkSession, landing: str, sink: str, checkpoint: str) -> DataFrame:
    """Drain the landing folder as a stream into post rows (parquet,
    append) and return the sink as a DataFrame."""
    src = spark.readStream.schema(STATUS_SCHEMA).json(landing)
    q = (status_rows(src).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", sink)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)


def stream_dedup(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                 watermark: str | None = None) -> DataFrame:
    """The P1 rows with repeated ids suppressed.

    Without ``watermark`` every id is remembered and no late post is lost.
    With one, ids are forgotten after that much post time (bounded state); a
    post further behind the newest than that is then dropped as late."""
    src = spark.readStream.schema(STATUS_SCHEMA).json(landing)
    rows = status_rows(src).withColumn("event_time", F.to_timestamp("timestamp"))
    if watermark is None:
        dedup = rows.dropDuplicates(["id"]).drop("event_time")
    else:
        dedup = rows.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["id"]).drop("event_time")
    q = (dedup.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", sink)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)
