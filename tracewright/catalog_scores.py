"""Scores of nested documents and the report over all episodes; a document is a customer, an episode a year."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.catalog import register
from tracewright.operators import patterns, scores
from tracewright.plans.bindings import Graph
from tracewright.plans.casebook import LINES, order_lines
from tracewright.plans.materialize import shared_dir


def _docs(g):
    """Nested documents: claims with anchors and nodes, families with sub-items, nodes with their links."""
    o = g.table("orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("k"), "o_orderstatus")
    li = order_lines(g).withColumnRenamed("l_orderkey", "k").join(o, "k")
    listed = lambda c: F.collect_set(c)
    sub = li.groupBy("doc", "k").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("ref"), F.when(F.col("l_returnflag") != "N", F.date_format("l_shipdate", "yyyy-MM-dd")).alias("video_timestamp"))).alias("sub_items"), listed("l_suppkey").alias("related_nodes"))
    each = o.join(sub, ["doc", "k"], "left")
    anchored = F.when(F.col("sub_items").isNull(), F.array().cast("array<struct<ref:int,video_timestamp:string>>")).otherwise(F.col("sub_items").cast("array<struct<ref:int,video_timestamp:string>>"))
    empty = F.array().cast("array<long>")
    claim = F.struct(F.transform(anchored, lambda x: x["ref"]).alias("anchored_artifacts"), F.coalesce(F.col("related_nodes").cast("array<long>"), empty).alias("related_nodes"), F.when(F.col("o_orderstatus") == "F", "t").alias("claim_timestamp"), F.when(F.col("o_orderstatus") == "P", "said").alias("transcript_snippet"))
    docs = each.groupBy("doc").agg(F.collect_list(claim).alias("claims"), F.collect_list(F.struct(anchored.alias("sub_items"))).alias("artifacts"))
    nodes = li.groupBy("doc", "l_suppkey").agg(F.collect_set("k").cast("array<long>").alias("related_claims"), F.collect_set("l_partkey").cast("array<long>").alias("related_nodes")).groupBy("doc").agg(F.collect_list(F.struct("related_nodes", "related_claims")).alias("nodes"))
    return docs.join(nodes, "doc", "left")


_SCORES = f"{LINES}, o AS (SELECT o_custkey AS doc, o_orderkey AS k, o_orderstatus FROM orders), li AS (SELECT o.doc, o.k, l.* FROM lines l JOIN o ON o.k = l_orderkey), c AS (SELECT o.doc, o.k, o_orderstatus, count(l_orderkey) AS a, count(DISTINCT l_suppkey) AS n, count(*) FILTER (l_returnflag <> 'N') AS timed FROM o LEFT JOIN li USING (doc, k) GROUP BY 1, 2, 3, o_orderstatus), nd AS (SELECT doc, l_suppkey, count(DISTINCT k) + count(DISTINCT l_partkey) AS links FROM li GROUP BY 1, 2), ns AS (SELECT doc, count(*) AS m, avg(links) AS avg_links FROM nd GROUP BY 1), x AS (SELECT doc, count(*) AS n_claims, sum(a)::BIGINT AS n_artifacts, count(*) FILTER (a > 0) / count(*)::DOUBLE AS ac, least(avg(a) / 2, 1.0) AS cg, least(avg(n) / 3, 1.0) AS crd, (count(*) FILTER (o_orderstatus IN ('F', 'P')) + 0.5::DOUBLE * sum(timed)) / (count(*) + 0.5::DOUBLE * sum(a)) AS ts FROM c GROUP BY 1), y AS (SELECT x.*, coalesce(m, 0) AS n_nodes, coalesce(least(avg_links / 4, 1.0), 0) AS nc FROM x LEFT JOIN ns USING (doc))"


def _letter(c):
    return f"CASE WHEN {c} >= 0.9 THEN 'A' WHEN {c} >= 0.8 THEN 'B' WHEN {c} >= 0.6 THEN 'C' WHEN {c} >= 0.4 THEN 'D' ELSE 'F' END"


_ALL = f"WITH {_SCORES}, s AS (SELECT doc, n_claims, n_artifacts, n_nodes, round_even(ac, 3) AS artifact_coverage, round_even(cg, 3) AS claim_grounding, round_even(crd, 3) AS cross_ref_density, round_even(ts, 3) AS timestamp_completeness, round_even(nc, 3) AS node_connectivity, round_even(100 * (0.0 + 0.25::DOUBLE * ac + 0.25::DOUBLE * cg + 0.2::DOUBLE * crd + 0.15::DOUBLE * ts + 0.15::DOUBLE * nc), 1) AS overall_score, {' || '.join(_letter(c) for c in ('ac', 'cg', 'crd', 'ts', 'nc'))} AS grades FROM y)"


@register(f"{_ALL} SELECT * FROM s")
def episode_scores(spark, d):
    """The five components and the weighted score of every nested document."""
    return scores.episode_scores(_docs(Graph(spark, d)))


@register(f"{_ALL} SELECT count(*) AS n, round(avg(overall_score), 6) AS average FROM s")
def score_store(spark, d):
    """Scores written as JSON, read back and averaged."""
    import uuid

    at = f"{shared_dir(spark)}/scores-{uuid.uuid4().hex}"
    scores.episode_scores(_docs(Graph(spark, d))).write.json(at)
    return spark.read.schema("doc long, overall_score double").json(at).agg(F.count("*").alias("n"), F.round(F.avg("overall_score"), 6).alias("average"))


_NODE = f"{LINES}, r AS (SELECT year(l_shipdate) AS ep, 'N-' || l_suppkey AS ref, 'Supplier ' || l_suppkey || ' of ' || year(l_shipdate) AS name, count(DISTINCT l_orderkey) AS claim_count, count(*) AS evidence_count FROM lines GROUP BY 1, 2, 3), n AS (SELECT *, CASE evidence_count % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' END AS pressure FROM r)"
_STATS = f"{_NODE}, st AS (SELECT ref, arg_max(name, ep) AS name, sum(claim_count)::BIGINT AS claim_count, sum(evidence_count)::BIGINT AS evidence_count, count(*) AS episode_count, string_agg(ep, ',' ORDER BY ep) AS episodes, CASE max(CASE pressure WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END) WHEN 3 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS pressure FROM n GROUP BY 1)"


def _nodes(g):
    r = order_lines(g).groupBy(F.year("l_shipdate").alias("ep"), F.concat(F.lit("N-"), F.col("l_suppkey").cast("string")).alias("ref")).agg(F.count_distinct("l_orderkey").alias("claim_count"), F.count("*").alias("evidence_count"))
    k = F.col("evidence_count") % 4
    name = F.concat(F.lit("Supplier "), F.substring("ref", 3, 20), F.lit(" of "), F.col("ep").cast("string"))
    return r.withColumn("name", name).withColumn("pressure", F.when(k == 0, "high").when(k == 1, "medium").when(k == 2, "low"))


@register(f"WITH {_STATS} SELECT * FROM st")
def node_statistics(spark, d):
    return scores.node_stats(_nodes(Graph(spark, d))).withColumn("episodes", F.array_join("episodes", ","))


@register(f"WITH {_STATS} SELECT ref, claim_count * episode_count AS weight FROM st WHERE episode_count >= 2 ORDER BY weight DESC, ref LIMIT 20")
def convergence_ranking(spark, d):
    got = scores.convergence(scores.node_stats(_nodes(Graph(spark, d))))
    return patterns.top(got.select("ref", "weight"), 20, F.desc("weight"), F.col("ref"))


_RANK = "CASE level WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END"


@register(f"WITH {LINES}, n AS (SELECT 'N-' || l_suppkey AS ref, year(l_shipdate) AS ep, l_linenumber AS seq, coalesce(CASE count(*) % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' WHEN 3 THEN 'odd' END, 'low') AS level FROM lines GROUP BY 1, 2, 3), e AS (SELECT ref, ep, arg_max(level, seq) AS level, max({_RANK}) AS r FROM n GROUP BY 1, 2) SELECT ref, string_agg(ep || ':' || level, ',' ORDER BY ep) AS levels, CASE max(r) WHEN 3 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS max_pressure FROM e GROUP BY 1 HAVING count(*) > 1 OR max(r) = 3")
def pressure_levels(spark, d):
    """Suppliers under pressure in the years they ship in; each line number is a row of its own, so a year has several levels."""
    k = F.col("n") % 5
    rows = order_lines(Graph(spark, d)).groupBy(F.concat(F.lit("N-"), F.col("l_suppkey").cast("string")).alias("ref"), F.year("l_shipdate").alias("ep"), F.col("l_linenumber").alias("seq")).agg(F.count("*").alias("n"))
    got = scores.pressure_map(rows.withColumn("pressure", F.when(k == 0, "high").when(k == 1, "medium").when(k == 2, "low").when(k == 3, "odd")))
    entry = F.transform(F.map_entries("levels"), lambda x: F.concat_ws(":", x["key"].cast("string"), x["value"]))
    return got.select("ref", F.array_join(entry, ",").alias("levels"), "max_pressure")


@register("WITH m AS (SELECT year(o_orderdate) AS ep, 'M-' || o_custkey AS ref, 'term of ' || min(o_orderkey) AS term, count(*) AS n FROM orders GROUP BY 1, 2) SELECT ref, arg_min(term, ep) AS term, sum(n)::BIGINT AS n_occurrences, string_agg(repeat(ep || ',', n), '' ORDER BY ep) AS episodes FROM m GROUP BY 1")
def meme_occurrences(spark, d):
    o = Graph(spark, d).table("orders").groupBy(F.year("o_orderdate").alias("ep"), F.concat(F.lit("M-"), F.col("o_custkey").cast("string")).alias("ref"))
    rows = o.agg(F.concat(F.lit("term of "), F.min("o_orderkey").cast("string")).alias("term"), F.lit("phrase").alias("type"), F.collect_list(F.col("o_orderkey").cast("string")).alias("occurrences"))
    got = scores.memes(rows)
    return got.select("ref", "term", F.size("occurrences").cast("long").alias("n_occurrences"), F.array_join(F.transform("episodes", lambda x: F.concat(x.cast("string"), F.lit(","))), "").alias("episodes"))


@register("WITH p(pattern) AS (VALUES ('tion'), ('the '), ('zzq')), s AS (SELECT conv_id AS ep, turn, text, pattern, strpos(text, pattern) - 1 AS i FROM conversations, p WHERE strpos(text, pattern) > 0), r AS (SELECT *, row_number() OVER (PARTITION BY pattern, ep, substr(trim(text), 1, 60) ORDER BY turn) AS r FROM s) SELECT pattern, ep, trim(substr(text, greatest(i - 40, 0) + 1, i + 4 + 40 - greatest(i - 40, 0))) AS context FROM r WHERE r = 1")
def rhetorical_fingerprints(spark, d):
    t = Graph(spark, d).table("conversations").select(F.col("conv_id").alias("ep"), F.col("turn").alias("at"), "text")
    return scores.fingerprints(t, [("tion", "tion"), ("the ", "the "), ("zzq", "zzq")])
