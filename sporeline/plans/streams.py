"""Queries over streams of events, checked against batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from sporeline.streaming.events import drain, event_stream, upsert_batches


def stream_tumbling(spark, d):
    """Events and values per hour and type."""
    e = event_stream(spark, d).filter("ts is not null").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return drain(e.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_type", "n", "total"), "complete")


def stream_dedup(spark, d):
    """Ids of events, each once however often it was sent."""
    e = event_stream(spark, d).filter("ts is not null")
    twice = e.union(e.filter("event_id % 10 = 0"))
    return drain(twice.withWatermark("ts", "365 days").dropDuplicatesWithinWatermark(["event_id"]).select("event_id", "user_id"))


def stream_upsert(spark, d):
    """The last event of every user, by merging batches."""
    e = event_stream(spark, d).select("user_id", "event_id", "event_type")
    return upsert_batches(e, "user_id", "event_id")


def stream_sessions(spark, d):
    """Sessions of users with gaps of at least a day."""
    e = event_stream(spark, d).filter("ts is not null").withWatermark("ts", "1 day").groupBy(F.session_window("ts", "1 day"), "user_id").agg(F.count("*").alias("n"))
    return drain(e.select("user_id", "n"), "complete")


QUERIES = {f.__name__: f for f in (stream_tumbling, stream_dedup, stream_upsert, stream_sessions)}

SQL = {
    "stream_tumbling": "select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as hour, event_type, count(*) as n, round(sum(value), 2) as total from events where ts is not null group by 1, 2",
    "stream_dedup": "select event_id, user_id from events where ts is not null",
    "stream_upsert": "select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by event_id desc) rn from events) where rn = 1",
    "stream_sessions": "with o as (select user_id, ts, case when lag(ts) over w is null or ts - lag(ts) over w >= interval 1 day then 1 else 0 end st from events where ts is not null window w as (partition by user_id order by ts)), r as (select *, sum(st) over (partition by user_id order by ts rows between unbounded preceding and current row) s from o) select user_id, count(*) as n from r group by user_id, s",
}
