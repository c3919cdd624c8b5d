"""Windowed aggregation over events: beyond the reference capabilities, on Structured Streaming's operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import windows
from . import query


@query("SELECT time_bucket(INTERVAL 1 hour, ts)::TIMESTAMP AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def stream_tumbling(t):
    out = windows.tumbling(t.events, "ts", "1 hour", ["event_type"], value="value")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))


@query("""SELECT s::TIMESTAMP AS start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 5 minutes, ts), time_bucket(INTERVAL 5 minutes, ts) - INTERVAL 5 minutes]) AS s FROM events) GROUP BY 1, 2""")
def stream_sliding(t):
    out = windows.sliding(t.events, "ts", "10 minutes", "5 minutes", ["event_type"])
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("""SELECT user_id, count(*) AS n FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events) WHERE p IS NULL OR ts - p >= INTERVAL 6 hours GROUP BY user_id""")
def stream_sessions(t):
    """Sessions of each user with a gap of six hours."""
    return windows.sessions(t.events, "ts", "6 hours", ["user_id"]).groupBy("user_id").agg(F.count("*").alias("n"))
