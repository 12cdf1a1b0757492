"""Streaming operators bound to the event table as a batch; the tests run the same operators as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonograin.plans.catalog import query
from sonograin.streaming.islands import session_islands, tumbling
from sonograin.tables import table


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an instant as time column, which streams need."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")).where("ts IS NOT NULL")


@query("""
WITH o AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events WHERE ts IS NOT NULL),
i AS (SELECT *, sum(CASE WHEN p IS NULL OR date_diff('microsecond', p, ts) >= 36000000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS g FROM o)
SELECT user_id, min(ts) AS first_at, max(ts) AS last_at, count(*) AS n FROM i GROUP BY user_id, g
""")
def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session islands of the events per user, ten hours apart."""
    s = session_islands(events(spark, sf_dir), ["user_id"], "ts", "10 hours", "1 day")
    return s.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_at", "last_at")})


@query("SELECT event_type, date_trunc('day', ts) AS from_at, count(*) AS n, CAST(round(sum(value) * 100) AS BIGINT) AS cents FROM events WHERE ts IS NOT NULL GROUP BY 1, 2")
def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and day."""
    t = tumbling(events(spark, sf_dir), ["event_type"], "ts", "1 day", "value", "1 day")
    return t.select("event_type", F.col("from_at").cast("timestamp_ntz").alias("from_at"), "n", F.round(F.col("total") * 100).cast("bigint").alias("cents"))
