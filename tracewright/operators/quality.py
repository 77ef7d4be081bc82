"""Scores and audits of claims, anchors and nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compliance(claims: DataFrame, anchors: DataFrame, linked: DataFrame, by: str = "ep") -> DataFrame:
    """(by, total, no_anchor, no_node, score): score = 100 (total - no_anchor - no_node) / total."""
    flagged = claims.select(by, "claim").join(anchors.select("claim", F.lit(1).alias("a")).distinct(), "claim", "left").join(linked.select("claim", F.lit(1).alias("n")).distinct(), "claim", "left")
    sums = flagged.groupBy(by).agg(F.count("*").alias("total"), F.count_if(F.col("a").isNull()).alias("no_anchor"), F.count_if(F.col("n").isNull()).alias("no_node"))
    return sums.withColumn("score", F.round(F.when(F.col("total") == 0, 0.0).otherwise(100.0 * (F.col("total") - F.col("no_anchor") - F.col("no_node")) / F.col("total")), 4))


def density(anchors: DataFrame, by: str = "ep") -> DataFrame:
    """Anchors for each distinct claim; anchors count every time."""
    return anchors.groupBy(by).agg(F.count("*").alias("n_edges"), F.count_distinct("claim").alias("n_claims"), F.round(F.count("*") / F.count_distinct("claim"), 6).alias("density"))


def nested_documents(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One nested document for each customer: its claims, each with arrays of anchors and nodes."""
    sub = lineitem.groupBy(F.col("l_orderkey").alias("ref")).agg(
        F.array_sort(F.collect_list(F.concat_ws(".", "l_orderkey", "l_linenumber"))).alias("anchored_artifacts"),
        F.array_sort(F.collect_set(F.concat(F.lit("N-"), F.col("l_suppkey")))).alias("related_nodes"),
    )
    claim = orders.select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("ref"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("claim_timestamp"), F.col("o_orderpriority").alias("label")).join(sub, "ref", "left")
    empty = F.array().cast("array<string>")
    fields = ["ref", "label", "claim_timestamp", F.coalesce("anchored_artifacts", empty).alias("anchored_artifacts"), F.coalesce("related_nodes", empty).alias("related_nodes")]
    return claim.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("claims"))


def _mean(items: Column, value) -> Column:
    total = F.aggregate(F.transform(items, value), F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(items) > 0, total / F.size(items)).otherwise(F.lit(0.0))


def document_scores(docs: DataFrame) -> DataFrame:
    """Coverage, grounding, cross references and their weighted score and letter for each document."""
    c = F.col("claims")
    cov = _mean(c, lambda x: F.when(F.size(x["anchored_artifacts"]) > 0, 1.0).otherwise(0.0))
    ground = F.least(_mean(c, lambda x: F.size(x["anchored_artifacts"]).cast("double")) / 2, F.lit(1.0))
    cross = F.least(_mean(c, lambda x: F.size(x["related_nodes"]).cast("double")) / 3, F.lit(1.0))
    timed = _mean(c, lambda x: F.when(x["claim_timestamp"].isNotNull(), 1.0).otherwise(0.0))
    out = docs.select("doc", F.size(c).cast("long").alias("n_claims"), cov.alias("coverage"), ground.alias("grounding"), cross.alias("crossref"), timed.alias("timed"))
    overall = 0.3 * F.col("coverage") + 0.3 * F.col("grounding") + 0.2 * F.col("crossref") + 0.2 * F.col("timed")
    out = out.withColumn("overall", F.round(overall, 6))
    return out.select("doc", "n_claims", *[F.round(x, 6).alias(x) for x in ("coverage", "grounding", "crossref", "timed")], "overall", letter(F.col("overall")).alias("letter"))


def episode_score(ac: Column, cg: Column, crd: Column, ts: Column, nc: Column) -> Column:
    """Five components weighted .25 .25 .20 .15 .15, in percent to one decimal."""
    return F.bround(100 * (0.25 * ac + 0.25 * cg + 0.20 * crd + 0.15 * ts + 0.15 * nc), 1)


def letter(score: Column) -> Column:
    return F.when(score >= 0.9, "A").when(score >= 0.8, "B").when(score >= 0.6, "C").when(score >= 0.4, "D").otherwise("F")


def reference_integrity(docs: DataFrame, artifacts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc, ref, kind, target): references inside documents to artifacts and nodes that do not exist."""
    each = docs.select("doc", F.explode("claims").alias("c"))
    a = each.select("doc", F.col("c.ref").alias("ref"), F.lit("anchored_artifacts").alias("kind"), F.explode("c.anchored_artifacts").alias("target"))
    n = each.select("doc", F.col("c.ref").alias("ref"), F.lit("related_nodes").alias("kind"), F.explode("c.related_nodes").alias("target"))
    gone = a.join(artifacts.select(F.col(artifacts.columns[0]).alias("target")), "target", "left_anti").select("doc", "ref", "kind", "target")
    return gone.union(n.join(nodes.select(F.col(nodes.columns[0]).alias("target")), "target", "left_anti").select("doc", "ref", "kind", "target"))


def admission(claims: DataFrame, anchored: DataFrame) -> DataFrame:
    """(claim, admit, reason): placeholder labels go, anchored claims come in, others only if substantiated."""
    flagged = claims.join(anchored.select("claim", F.lit(True).alias("anchored")).distinct(), "claim", "left")
    blank = F.col("text").isNull() | (F.trim("text") == "") | F.col("text").rlike("(?i)^(tbd|placeholder|n/a)")
    reason = F.when(blank, "placeholder").when(F.col("anchored"), "anchored").when(F.coalesce("substantiated", F.lit(True)), "substantiated").otherwise("unsubstantiated")
    return flagged.select("claim", reason.alias("reason")).withColumn("admit", F.col("reason").isin("anchored", "substantiated"))
