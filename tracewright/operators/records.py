"""Keyed stores: upserts, scoped deletes, ledgers, calendars, chains of revisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both by key; a new value wins unless it is null, so nulls never erase."""
    rest = [c for c in old.columns if c not in keys]
    n = new.select(*keys, *[F.col(c).alias(f"__{c}") for c in rest])
    return old.join(n, list(keys), "full_outer").select(*keys, *[F.coalesce(f"__{c}", c).alias(c) for c in rest])


def upsert_edges(old: DataFrame, new: DataFrame) -> DataFrame:
    """Edges are a set: writing one twice changes nothing."""
    return old.unionByName(new).distinct()


def append_absent(old: DataFrame, new: DataFrame, key: Column) -> DataFrame:
    """``old`` and the rows of ``new`` whose key it lacks; of equal new keys the first in column order stays."""
    fresh = new.withColumn("__k", key).join(old.select(key.alias("__k")).distinct(), "__k", "left_anti")
    first = Window.partitionBy("__k").orderBy(*new.columns)
    fresh = fresh.withColumn("__r", F.row_number().over(first)).where("__r = 1").drop("__k", "__r")
    return old.unionByName(fresh)


def latest(rows: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The newest row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def before_cutoff(events: DataFrame, cutoffs: DataFrame, key: str, at: str, allowed: Sequence = ()) -> DataFrame:
    """Events not after their key's cutoff; keys without one, and allowed keys, keep all."""
    joined = events.join(cutoffs.select(key, F.col("cutoff")), key, "left")
    return joined.where(F.col("cutoff").isNull() | (F.col(at) <= F.col("cutoff")) | F.col(key).isin(list(allowed))).select(events.columns)


def last_n(rows: DataFrame, by: str, n: int, *order: Column) -> DataFrame:
    w = Window.partitionBy(by).orderBy(*order)
    return rows.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def fingerprint(rows: DataFrame, at: Column, size: Column) -> DataFrame:
    """First 24 hex digits of the digest over newest time, total size and count."""
    got = rows.agg(F.max(at).cast("string").alias("newest"), F.sum(size).alias("total"), F.count("*").alias("n"))
    return got.select("newest", "total", "n", F.substring(F.sha2(F.concat_ws("|", "newest", F.col("total").cast("string"), F.col("n").cast("string")), 256), 1, 24).alias("digest"))
