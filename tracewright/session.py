"""Session settings used by tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(master: str = "local[8]", memory: str = "8g", partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(master)
        .appName("tracewright")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
