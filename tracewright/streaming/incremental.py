"""Structured Streaming versions of the incremental steps; each has a batch twin it equals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, folder: str, pattern: str = "*.parquet", files: int = 1) -> DataFrame:
    """Events arriving in a folder as Parquet files whose names match, ``files`` to a batch."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files).parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))  # a watermark needs a time zone


def run_to_end(stream: DataFrame, checkpoint: str, name: str, mode: str = "append") -> DataFrame:
    """Everything the stream has now, through a memory table; for tests and small digests."""
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def digest(events: DataFrame, keys: list[str], at: str, late: str = "1 hour") -> DataFrame:
    """Each different key once, as it first arrives; repeats within the watermark are dropped."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(events: DataFrame, at: str, by: str, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts of each kind in tumbling windows. Not one of the studied operators: a Spark feature."""
    counted = events.withWatermark(at, late).groupBy(F.window(at, width), by).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), by, "n")


def upsert_batches(stream: DataFrame, path: str, keys: list[str], order: str, checkpoint: str) -> None:
    """Every batch's newest row of each key, appended with its batch number; ``latest_of`` reads the store."""

    def put(batch: DataFrame, number: int) -> None:
        newest = batch.groupBy(*keys).agg(F.max_by(F.struct(*batch.columns), order).alias("r")).select("r.*")
        newest.withColumn("batch", F.lit(number).cast("long")).write.mode("append").parquet(path)

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest_of(spark: SparkSession, path: str, keys: list[str], order: str) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), F.struct(order, "batch")).alias("r")).select("r.*")
