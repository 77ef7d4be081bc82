"""Rows, evidence and details of entities, as an index of all of them would show them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The order in which kinds are looked up.
KINDS = ("node", "claim", "family", "artifact", "meme")


def entity_rows(entities: DataFrame, links: DataFrame, most: int = 10) -> DataFrame:
    """(kind, id, title, subtitle, n_related, ids): each entity with how many others it is linked to, and the first ``most`` of them in order.

    ``links`` are (id, other), each counted once. Only so many are kept of a busy entity's links.
    """
    own = links.repartition("id").distinct()  # dealt once; what follows is by id too
    place = F.row_number().over(Window.partitionBy("id").orderBy("other"))
    held = own.withColumn("r", place).groupBy("id").agg(F.count("*").alias("n_related"), F.array_sort(F.collect_list(F.when(F.col("r") <= most, F.col("other")))).alias("ids"))
    out = entities.join(held, "id", "left")
    kind = links.schema["other"].dataType.simpleString()
    return out.select("kind", "id", "title", "subtitle", F.coalesce("n_related", F.lit(0)).alias("n_related"), F.coalesce("ids", F.array().cast(f"array<{kind}>")).alias("ids"))


def looked_up(entities: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, kind, ep, title) of wanted ids: of several kinds the first of KINDS, of several episodes the first."""
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(KINDS)], F.lit(len(KINDS)))
    found = entities.join(wanted.select("id").distinct(), "id", "left_semi")
    best = found.groupBy("id").agg(F.min_by(F.struct("kind", "ep", "title"), F.struct(rank, "ep", "title")).alias("x"))
    return best.select("id", "x.*")


def node_evidence(forward: DataFrame, backward: DataFrame, claims: DataFrame) -> DataFrame:
    """(node, claim, seconds, text, place): claims that a node names or that name it, if they exist, by time, those without one last."""
    links = forward.select("node", "claim").union(backward.select("node", "claim")).distinct()
    order = Window.partitionBy("node").orderBy(F.asc_nulls_last("seconds"), "claim")
    return links.join(claims.select("claim", "seconds", "text"), "claim").withColumn("place", F.row_number().over(order)).select("node", "claim", "seconds", "text", "place")


def primary_evidence(evidence: DataFrame, names: DataFrame) -> DataFrame:
    """(node, claim, why): a claim that has the node's name, else one with a word of it (three letters or more), else a timed one, else the first."""
    words = F.filter(F.split(F.lower("name"), r"\s+"), lambda w: F.length(w) >= 3)
    text = F.lower(F.coalesce("text", F.lit("")))
    why = F.when(F.contains(text, F.lower("name")), "name").when(F.exists(words, lambda w: F.contains(text, w)), "word").when(F.col("seconds").isNotNull(), "timed").otherwise("first")
    rank = F.when(F.col("why") == "name", 0).when(F.col("why") == "word", 1).when(F.col("why") == "timed", 2).otherwise(3)
    both = evidence.join(names.select("node", "name"), "node").withColumn("why", why).withColumn("rank", rank)
    best = both.groupBy("node").agg(F.min_by(F.struct("claim", "why"), F.struct("rank", "place")).alias("x"))
    return best.select("node", "x.claim", "x.why")


def details(evidence: DataFrame, names: DataFrame, related: DataFrame) -> DataFrame:
    """(node, name, n_evidence, primary, first_seconds, n_related) of every node: its evidence, the best piece of it, and what it is related to."""
    sums = evidence.groupBy("node").agg(F.count("*").alias("n_evidence"), F.min("seconds").alias("first_seconds"))
    best = primary_evidence(evidence, names).select("node", F.col("claim").alias("primary"))
    linked = related.select("node", "other").distinct().groupBy("node").agg(F.count("*").alias("n_related"))
    out = names.select("node", "name").join(sums, "node", "left").join(best, "node", "left").join(linked, "node", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("node", "name", zero("n_evidence"), "primary", "first_seconds", zero("n_related"))


def related_ids(lists: list[Column]) -> Column:
    """Identifiers of several lists together, each once, blanks left out."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.filter(F.concat(*[F.coalesce(x, none) for x in lists]), lambda x: F.trim(F.coalesce(x, F.lit(""))) != ""))


def snippet_and_time(kind: Column, claim_text: Column, claim_time: Column, item_text: Column, item_time: Column) -> Column:
    """(text, time) to show of an entity: a claim's own, else those of an artifact."""
    own = kind == "claim"
    return F.struct(F.when(own, F.coalesce(claim_text, item_text)).otherwise(F.coalesce(item_text, claim_text)).alias("text"), F.when(own, F.coalesce(claim_time, item_time)).otherwise(F.coalesce(item_time, claim_time)).alias("time"))
