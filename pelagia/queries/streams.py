"""Streaming queries: the driver tables read as streams, run to the end, and what their sinks hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import fresh_path
from ..streaming import jobs
from .registry import query
from .sqlparts import part


def events_stream(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return jobs.stream_table(spark, f"{sf}/events.parquet*", schema).withColumn("ts", F.col("ts").cast("timestamp"))


@query("r01_streaming_dedup", "event_id l, ts z, event_type s, value d4", "SELECT event_id, ts, event_type, value FROM events")
def dedup(spark, sf):
    """Every reading arrives twice, from two overlapping reads; within the watermark it is kept once."""
    path = fresh_path(spark, "stream_dedup")
    twice = events_stream(spark, sf).unionByName(events_stream(spark, sf)).select("event_id", "ts", "event_type", "value")
    jobs.run_available(jobs.deduplicated(twice, ["event_id"], "ts", "1 hour"), f"{path}/checkpoint", path=f"{path}/table")
    return spark.read.parquet(f"{path}/table")


part("p_type_user", "SELECT event_type || '/' || user_id AS k, ts, value, event_id FROM events")


@query("r03_streaming_upsert", "k s, day t, ts z, value d4, event_id l", """
  SELECT k, CAST(ts AS DATE) AS day, ts, value, event_id FROM p_type_user QUALIFY row_number() OVER (PARTITION BY k, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""")
def upsert(spark, sf):
    """Newest row per (type and user, day); the days that a batch touches are copied. A second run brings nothing new and changes nothing."""
    path = fresh_path(spark, "stream_upsert")
    rows = events_stream(spark, sf).select(F.concat_ws("/", "event_type", "user_id").alias("k"), F.to_date("ts").alias("day"), "ts", "value", "event_id")
    sink = jobs.upsert_sink(spark, f"{path}/table", ["k", "day"], ["ts", "event_id"], "day")
    for checkpoint in ("first", "lost and begun anew"):
        jobs.run_available(rows, f"{path}/{checkpoint}", sink, mode="update")
    return jobs.latest_version(spark, f"{path}/table")


part("p_attempts", """SELECT event_type || '/' || (user_id % 30) AS source_identifier, date_trunc('second', ts) AS tm, value > 60 AS success FROM events""")
part("p_successes", """SELECT source_identifier, tm, lag(tm) OVER w AS before, lead(tm) OVER w AS after FROM (SELECT DISTINCT source_identifier, tm FROM p_attempts WHERE success)
  WINDOW w AS (PARTITION BY source_identifier ORDER BY tm)""")


@query("r04_streaming_freshness", "source_identifier s, changed_at z, freshness s, last_successful_fetch_utc z, newest_valid_source_timestamp z", """
  SELECT source_identifier, tm AS changed_at, 'fresh' AS freshness, tm AS last_successful_fetch_utc, tm - INTERVAL 1 HOUR AS newest_valid_source_timestamp
  FROM p_successes WHERE before IS NULL OR tm > before + INTERVAL 2 DAY
  UNION ALL SELECT source_identifier, tm + INTERVAL 2 DAY, 'stale', tm, tm - INTERVAL 1 HOUR FROM p_successes JOIN (SELECT source_identifier, max(tm) AS seen FROM p_attempts GROUP BY 1) USING (source_identifier),
    (SELECT max(tm) - INTERVAL 1 HOUR AS watermark FROM p_attempts)
  WHERE (after IS NULL OR after > tm + INTERVAL 2 DAY) AND (seen > tm + INTERVAL 2 DAY OR watermark > tm + INTERVAL 2 DAY)
  UNION ALL SELECT source_identifier, first_failure, 'failed', NULL, NULL FROM (SELECT source_identifier, min(tm) FILTER (NOT success) AS first_failure, min(tm) FILTER (success) AS first_success
    FROM p_attempts GROUP BY 1) WHERE first_failure <= coalesce(first_success, first_failure)""")
def freshness(spark, sf):
    """Changes of freshness of 150 sources: failures, successes, and time-outs two days after the last success."""
    jobs.with_state_store(spark)
    path = fresh_path(spark, "stream_freshness")
    at = F.date_trunc("second", "ts")
    attempts = events_stream(spark, sf).select(F.concat_ws("/", "event_type", F.col("user_id") % 30).alias("source_identifier"), at.alias("attempted_utc"),
                                               (F.col("value") > 60).alias("success"), (at - F.expr("interval 1 hour")).alias("newest"))
    jobs.run_available(jobs.freshness_transitions(attempts, 2 * 86_400, "1 hour"), f"{path}/checkpoint", path=f"{path}/table")
    return spark.read.parquet(f"{path}/table").withColumnRenamed("at", "changed_at")
