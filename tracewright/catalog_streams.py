"""Streaming queries: each reads the events as a stream to its end, and SQL over the table gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tracewright.catalog import register
from tracewright.plans.bindings import Graph
from tracewright.plans.materialize import shared_dir
from tracewright.streaming import incremental, reminders


def _place(spark) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


@register("SELECT user_id, max(event_id) AS event_id FROM events GROUP BY 1")
def stream_upsert(spark, d):
    """The newest event of each user, upserted batch by batch."""
    at = _place(spark)
    incremental.upsert_batches(incremental.event_stream(spark, d, "events.parquet"), f"{at}/rows", ["user_id"], "event_id", f"{at}/state")
    return incremental.latest_of(spark, f"{at}/rows", ["user_id"], "event_id").select("user_id", "event_id")


_MINUTE = reminders.MINUTE


def _meetings(spark, d):
    """Errors as meetings of some minutes later, all else as acknowledgements; forty users are a channel."""
    e, k = Graph(spark, d).table("events"), F.col("event_id")
    at, meeting = F.col("ts").cast("timestamp"), F.col("event_type") == "error"
    starts = F.timestamp_micros(F.floor(F.unix_micros(at) / _MINUTE) * _MINUTE + (1 + k % 40) * _MINUTE)
    kind = F.when(meeting, "meeting").otherwise("ack")
    return e.select(F.floor(F.col("user_id") / 40).alias("channel"), kind.alias("kind"), at.alias("at"), F.when(meeting, F.concat(F.lit("m"), (k % 5).cast("string"))).alias("title"), F.when(meeting, starts).alias("starts"))


_SENT = f"""
WITH e AS (SELECT user_id // 40 AS channel, event_type = 'error' AS meeting, epoch_us(ts) AS t, 'm' || event_id % 5 AS title, epoch_us(ts) // {_MINUTE} * {_MINUTE} + (1 + event_id % 40) * {_MINUTE} AS starts FROM events),
k AS (SELECT channel, title, starts, min(t) AS known FROM e WHERE meeting GROUP BY 1, 2, 3),
w AS (SELECT *, greatest(-(-known // {_MINUTE}) * {_MINUTE}, starts - 16 * {_MINUTE}) AS f, greatest(-(-known // {_MINUTE}) * {_MINUTE}, starts - 6 * {_MINUTE}) AS s FROM k),
b AS (SELECT channel, title, starts, CASE WHEN f <= starts - 14 * {_MINUTE} THEN f END AS f, CASE WHEN s <= starts - 4 * {_MINUTE} THEN s END AS s FROM w),
n AS (SELECT *, lead(f) OVER (PARTITION BY channel ORDER BY f, starts, title) AS until FROM b WHERE f IS NOT NULL),
a AS (SELECT n.channel, n.title, n.starts, min(e.t) AS acked FROM n JOIN e ON e.channel = n.channel AND NOT e.meeting AND e.t >= f AND (until IS NULL OR e.t < until) GROUP BY 1, 2, 3)
SELECT channel, title, starts, 15 AS reminder, f AS sent_at FROM b WHERE f IS NOT NULL
UNION ALL SELECT channel, title, starts, 5, s FROM b LEFT JOIN a USING (channel, title, starts) WHERE s IS NOT NULL AND (acked IS NULL OR acked > s)
""".replace(f"-(-known // {_MINUTE}) * {_MINUTE}", f"(known + {_MINUTE - 1}) // {_MINUTE} * {_MINUTE}")


@register(_SENT)
def meeting_reminders(spark, d):
    """The reminders of a table of meetings and acknowledgements, as one plan."""
    return reminders.reminders_of(_meetings(spark, d))


@register(_SENT)
def stream_reminders(spark, d):
    """The same from a stream: rows arrive up to half an hour late, in two parts; a last row moves the watermark past all timers."""
    at, schema = _place(spark), "channel long, kind string, at timestamp, title string, starts timestamp"
    rows = _meetings(spark, d).withColumn("arrives", F.unix_micros("at") + F.pmod(F.xxhash64("at", "title"), F.lit(30)) * _MINUTE)
    first, last = rows.agg(F.min("arrives"), F.max("arrives")).first()
    parts = [rows.where((F.col("arrives") >= first + i * (last - first) // 2) & (F.col("arrives") < first + (i + 1) * (last - first) // 2 + (i == 1))) for i in range(2)] if first is not None else []
    end = spark.range(1).select(F.lit(-1).cast("long").alias("channel"), F.lit("ack").alias("kind"), F.timestamp_micros(F.lit((last or 0) + 1440 * _MINUTE)).alias("at"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("timestamp").alias("starts"))
    for part in [*parts, end]:
        part.select("channel", "kind", "at", "title", "starts").write.mode("append").parquet(f"{at}/rows")
        sent = reminders.run_files(spark, f"{at}/rows", at, schema)
    return sent


@register("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_digest(spark, d):
    """Each event once, however often it arrives, and how many each user has of each type."""
    at = _place(spark)
    once = incremental.digest(incremental.event_stream(spark, d, "events.parquet"), ["event_id"], "ts", "3650 days")
    once.select("event_id", "user_id", "event_type").writeStream.format("parquet").option("path", f"{at}/rows").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("event_id long, user_id long, event_type string").parquet(f"{at}/rows").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
