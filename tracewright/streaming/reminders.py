"""Reminders before meetings: a state for each channel with event-time timers, and the same as one batch plan.

Rows are (channel, kind, at, title, starts): a ``meeting`` that becomes known at ``at``, or an
``ack``. The clock ticks by the minute. A meeting is told of once when 16 to 14 minutes are left,
and again when 6 to 4 are left, unless it was acknowledged by then. An acknowledgement holds for the
last first reminder that its channel was sent. A meeting is its title and start, so what was said on
one day says nothing on the next.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MINUTE = 60_000_000  # all times are whole microseconds

# Minutes that are left when the first and the second reminder may be sent.
FIRST, SECOND = (16, 14), (6, 4)
#: Minutes for which a channel remembers; every rule looks back less than a quarter of an hour.
KEPT = 60
OUT = "channel long, title string, starts long, reminder int, sent_at long"


def sending(known: int, starts: int, window: tuple[int, int]) -> int | None:
    """The first full minute of a window at which a meeting is known."""
    at = max(-(-known // MINUTE) * MINUTE, starts - window[0] * MINUTE)
    return at if at <= starts - window[1] * MINUTE else None


def due(meetings: dict[tuple[str, int], int], acks: list[int], now: int) -> list[tuple[str, int, int, int]]:
    """(title, starts, reminder, sent_at) of what is to be sent at the minute ``now``, from what a channel remembers."""
    firsts = sorted((at, starts, title) for (title, starts), known in meetings.items() if (at := sending(known, starts, FIRST)) is not None)
    out = [(title, starts, FIRST[0] - 1, at) for at, starts, title in firsts if at == now]
    told = {acked[1:] for t in acks if t <= now and (acked := max((f for f in firsts if f[0] <= t), default=None))}
    return out + [(title, starts, SECOND[0] - 1, now) for (title, starts), known in meetings.items() if sending(known, starts, SECOND) == now and (starts, title) not in told]


def due_between(meetings: dict[tuple[str, int], int], acks: list[int], after: int, until: int) -> list[tuple[str, int, int, int]]:
    """What ``due`` tells of every minute past ``after`` up to ``until``, in one pass over what a channel remembers."""
    firsts = sorted((at, starts, title) for (title, starts), known in meetings.items() if (at := sending(known, starts, FIRST)) is not None)
    times, told = [f[0] for f in firsts], {}
    for t in acks:
        if place := bisect_right(times, t):
            meeting = firsts[place - 1][1:]
            told[meeting] = min(t, told.get(meeting, t))
    out = [(title, starts, FIRST[0] - 1, at) for at, starts, title in firsts if after < at <= until]
    for (title, starts), known in meetings.items():
        at = sending(known, starts, SECOND)
        if at is not None and after < at <= until and told.get((starts, title), at + 1) > at:
            out.append((title, starts, SECOND[0] - 1, at))
    return out


class Reminders(StatefulProcessor):
    """Meetings and acknowledgements of a channel as they come; all that a minute decides waits for its timer.

    A timer runs when the watermark has passed it, so every row that happened before it is there and
    the order of arrival within the watermark makes no difference. It is set for the next minute at
    which something may be sent, and tells of all minutes that the watermark has passed: a channel
    reads and writes its state once a batch, not once a minute.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.memory = handle.getValueState("memory", "titles array<string>, starts array<long>, known array<long>, acks array<long>, done long")

    def _recall(self) -> tuple[dict[tuple[str, int], int], list[int], int]:
        titles, starts, known, acks, done = self.memory.get() if self.memory.exists() else ([], [], [], [], -(1 << 62))
        return dict(zip(zip(titles, map(int, starts), strict=True), map(int, known), strict=True)), list(map(int, acks)), int(done)

    def _remember(self, meetings: dict[tuple[str, int], int], acks: list[int], done: int) -> None:
        self.memory.update(([m[0] for m in meetings], [m[1] for m in meetings], list(meetings.values()), acks, done))

    def _wake(self, meetings: dict[tuple[str, int], int], done: int) -> None:
        """A timer for the first minute past ``done`` at which something may be sent."""
        minutes = [at for (_, starts), known in meetings.items() for window in (FIRST, SECOND) if (at := sending(known, starts, window)) is not None and at > done]
        if minutes:
            self.handle.registerTimer(min(minutes) // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        meetings, acks, done = self._recall()
        for frame in rows:
            acks += frame[frame["kind"] == "ack"]["us"].astype(int).tolist()
            for title, starts, known in frame[frame["kind"] == "meeting"][["title", "starts", "us"]].itertuples(index=False):
                meeting = (title, int(starts))
                meetings[meeting] = min(int(known), meetings.get(meeting, int(known)))
        self._wake(meetings, done)
        self._remember(meetings, acks, done)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000
        meetings, acks, done = self._recall()
        rows = due_between(meetings, acks, done, now)
        if now > done:
            kept = {m: known for m, known in meetings.items() if m[1] >= now - KEPT * MINUTE}
            self._wake(kept, now)
            self._remember(kept, [t for t in acks if t >= now - KEPT * MINUTE], now)
        yield pd.DataFrame([(key[0], *r) for r in rows], columns=["channel", "title", "starts", "reminder", "sent_at"])

    def close(self) -> None:
        pass


def reminders(rows: DataFrame, late: str = "1 hour") -> DataFrame:
    """The reminders that a stream of rows (with ``at`` as a timestamp) calls for; needs the RocksDB state store."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    seen = rows.withWatermark("at", late).select("channel", "kind", "at", F.unix_micros("at").alias("us"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce(F.unix_micros("starts"), F.lit(0)).alias("starts"))
    return seen.groupBy("channel").transformWithStateInPandas(statefulProcessor=Reminders(), outputStructType=OUT, outputMode="append", timeMode="eventTime")


def _sending(window: tuple[int, int]) -> Column:
    at = F.greatest(F.ceil(F.col("known") / MINUTE) * MINUTE, F.col("starts") - window[0] * MINUTE)
    return F.when(at <= F.col("starts") - window[1] * MINUTE, at)


def reminders_of(rows: DataFrame) -> DataFrame:
    """The same of a table: an acknowledgement belongs to the last first reminder at or before it, found by one window over both."""
    us = rows.select("channel", "kind", F.unix_micros("at").alias("at"), F.coalesce("title", F.lit("")).alias("title"), F.unix_micros("starts").alias("starts"))
    known = us.where("kind = 'meeting'").groupBy("channel", "title", "starts").agg(F.min("at").alias("known"))
    both = known.withColumns({"first": _sending(FIRST), "second": _sending(SECOND)})
    sent = both.where("first is not null").select("channel", F.col("first").alias("t"), F.lit(0).alias("side"), F.struct("starts", "title").alias("m"))
    heard = us.where("kind = 'ack'").select("channel", F.col("at").alias("t"), F.lit(1).alias("side"), F.lit(None).cast("struct<starts:bigint,title:string>").alias("m"))
    before = Window.partitionBy("channel").orderBy("t", "side", "m.starts", "m.title").rowsBetween(Window.unboundedPreceding, 0)
    acked = sent.unionByName(heard).withColumn("of", F.last("m", ignorenulls=True).over(before)).where("side = 1 and of is not null")
    acked = acked.groupBy("channel", "of.starts", "of.title").agg(F.min("t").alias("acked"))
    out = both.join(acked, ["channel", "starts", "title"], "left")
    one = out.where("first is not null").select("channel", "title", "starts", F.lit(FIRST[0] - 1).alias("reminder"), F.col("first").alias("sent_at"))
    two = out.where("second is not null and (acked is null or acked > second)").select("channel", "title", "starts", F.lit(SECOND[0] - 1).alias("reminder"), F.col("second").alias("sent_at"))
    return one.union(two)


def run_files(spark: SparkSession, folder: str, place: str, schema: str) -> DataFrame:
    """Streams what has come into a folder since the last run, and reads back all that was sent."""
    stream = spark.readStream.schema(schema).parquet(folder)
    sent = reminders(stream)
    sent.writeStream.format("parquet").option("path", f"{place}/sent").option("checkpointLocation", f"{place}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(OUT).parquet(f"{place}/sent")
