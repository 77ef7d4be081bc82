"""Readers and writers of the stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object a line; lines that are none come back in ``_corrupt_record`` if the schema has it."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of whole text or Markdown files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, line): numbered within each whole file, since order is data."""
    return read_texts(spark, path).select("path", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_partitioned(df: DataFrame, path: str, by: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(by).parquet(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def write_report(df: DataFrame, path: str, title: str) -> None:
    """A Markdown table of ``df``, one line a row, in part files."""
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]), F.lit(" |"))
    head = df.sparkSession.createDataFrame([(0, f"# {title}"), (1, "| " + " | ".join(df.columns) + " |"), (2, "|" + " --- |" * len(df.columns))], "n int, value string")
    head.select("value").union(df.select(line.alias("value"))).write.mode("overwrite").text(path)


def append_absent_jsonl(rows: DataFrame, path: str, schema: str, key: str) -> None:
    """Append the rows whose key the store at ``path`` lacks; a store that is not there yet is begun."""
    spark = rows.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place):
        rows = rows.join(read_jsonl(spark, path, schema).select(key).distinct(), key, "left_anti").select(rows.columns)
    write_jsonl(rows, path)


def write_version(df: DataFrame, path: str, version: int) -> None:
    """Write a whole store as a new version beside the old ones; readers see it once it is complete."""
    df.write.parquet(f"{path}/version={version}")


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a store."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [str(x.getPath().getName()) for x in fs.listStatus(fs_path)]
    done = [n for n in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return spark.read.parquet(f"{path}/version={max(int(n.split('=')[1]) for n in done)}")
