"""The evidence graph as it stands in the star-schema tables: who appears, claims, anchors, links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = "2024-01-01"


class Graph:
    """Named relations over one data folder; each is a plan, read when it is used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def appearances(self) -> DataFrame:
        """(node, ep): the distinct episodes (days) in which a user appears."""
        return self.table("events").select(F.col("user_id").alias("node"), (F.datediff(F.to_date("ts"), F.lit(EPOCH)) + 1).cast("long").alias("ep")).distinct()

    @property
    def claims(self) -> DataFrame:
        """(claim, person, ep, text, substantiated): orders; an episode is a year."""
        o = self.table("orders")
        return o.select(F.col("o_orderkey").alias("claim"), F.col("o_custkey").alias("person"), F.year("o_orderdate").cast("long").alias("ep"), F.concat_ws(" ", "o_orderstatus", "o_orderpriority").alias("text"), (F.col("o_orderstatus") != "P").alias("substantiated"), F.col("o_totalprice").alias("price"))

    @property
    def anchors(self) -> DataFrame:
        """(artifact, claim, part, supplier): line items; each is an artifact that anchors its order."""
        li = self.table("lineitem")
        return li.select(F.concat_ws(".", "l_orderkey", "l_linenumber").alias("artifact"), F.col("l_orderkey").alias("claim"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.year("l_shipdate").cast("long").alias("ep"), "l_returnflag", "l_shipdate")


#: The same relations for DuckDB, as the start of a WITH list.
SQL = """
appearances AS (SELECT DISTINCT user_id AS node, datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS ep FROM events),
claims AS (SELECT o_orderkey AS claim, o_custkey AS person, year(o_orderdate) AS ep, concat_ws(' ', o_orderstatus, o_orderpriority) AS text, o_orderstatus <> 'P' AS substantiated, o_totalprice AS price FROM orders),
anchors AS (SELECT concat_ws('.', l_orderkey, l_linenumber) AS artifact, l_orderkey AS claim, l_partkey AS part, l_suppkey AS supplier, year(l_shipdate) AS ep, l_returnflag, l_shipdate FROM lineitem)
"""
