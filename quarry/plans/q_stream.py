"""Streaming queries: statuses landed as JSON, drained with availableNow."""

from __future__ import annotations

from quarry.plans.registry import register
from quarry.plans.views import Views
from quarry.plans.views_sql import with_views
from quarry.streaming import statuses as st

_ROWS_SQL = """
, p AS (SELECT id, handle, id % 1000 AS init_reach, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp", text, likes, retweets,
   array_to_string(regexp_extract_all(text, '#([A-Za-z0-9_]+)', 1), ' ') AS hashtags,
   array_to_string(regexp_extract_all(text, '@([A-Za-z0-9_]+)', 1), ' ') AS mentions, lang AS location, retweeted FROM posts),
rows AS (
  SELECT id, handle, init_reach, "timestamp", text, likes, retweets, hashtags, mentions, location, CAST(NULL AS BIGINT) AS retweeted
    FROM p WHERE retweeted IS NULL
  UNION ALL
  SELECT id, handle, init_reach, "timestamp", '' AS text, CAST(0 AS BIGINT) AS likes, retweets, hashtags, mentions, location, retweeted
    FROM p WHERE retweeted IS NOT NULL
  UNION ALL
  SELECT o.id, o.handle, o.init_reach, o."timestamp", o.text, o.likes, o.retweets, o.hashtags, o.mentions, o.location, CAST(NULL AS BIGINT)
    FROM p a JOIN p o ON a.retweeted = o.id)"""


def _land(spark, root):
    posts = Views(spark, root).posts
    landing = st.scratch(spark, "landing")
    st.land(st.statuses_from_posts(posts), landing)
    return landing


@register("p1_status_stream", with_views("posts") + _ROWS_SQL + " SELECT * FROM rows")
def p1_status_stream(spark, root):
    landing = _land(spark, root)
    return st.stream_rows(spark, landing, st.scratch(spark, "rows"), st.scratch(spark, "rows-ckpt"))


@register("p2_dedup_stream", with_views("posts") + _ROWS_SQL + " SELECT DISTINCT * FROM rows")
def p2_dedup_stream(spark, root):
    landing = _land(spark, root)
    return st.stream_dedup(spark, landing, st.scratch(spark, "dedup"), st.scratch(spark, "dedup-ckpt"))
