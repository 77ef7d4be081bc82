"""Upserts, ledgers, calendars, audits and registries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.catalog import register
from tracewright.functions import text as tx
from tracewright.operators import patterns, records, resolve
from tracewright.plans.bindings import Graph


@register("SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey, coalesce(n.c_name, o.c_name) AS c_name, coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment FROM customer o FULL JOIN (SELECT s_suppkey * 20 AS c_custkey, s_name AS c_name, NULL::VARCHAR AS c_mktsegment FROM supplier) n USING (c_custkey)")
def upsert_nodes(spark, d):
    g = Graph(spark, d)
    new = g.table("supplier").select((F.col("s_suppkey") * 20).alias("c_custkey"), F.col("s_name").alias("c_name"), F.lit(None).cast("string").alias("c_mktsegment"))
    return records.upsert(g.table("customer").select("c_custkey", "c_name", "c_mktsegment"), new, ["c_custkey"])


@register("SELECT o_custkey AS src, o_orderkey AS dst FROM orders UNION SELECT user_id, event_id FROM events")
def upsert_edges(spark, d):
    g = Graph(spark, d)
    return records.upsert_edges(g.table("orders").select(F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst")), g.table("events").select(F.col("user_id").alias("src"), F.col("event_id").alias("dst")))


@register("SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1")
def reset_preserving(spark, d):
    return Graph(spark, d).table("events").where("event_type <> 'view'").groupBy("event_type").agg(F.count("*").alias("n"))


@register("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type LIKE 'P%')")
def subgraph_clear(spark, d):
    g = Graph(spark, d)
    gone = g.table("part").where(F.startswith("p_type", F.lit("P"))).select(F.col("p_partkey").alias("l_partkey"))
    return patterns.without_any(g.table("lineitem"), (gone, "l_partkey")).select("l_orderkey", "l_linenumber")


@register("SELECT event_type, event_id FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS r FROM events) WHERE r <= 5")
def opportunities_by_type(spark, d):
    return patterns.top_per(Graph(spark, d).table("events"), "event_type", 5, F.col("ts"), F.col("event_id")).select("event_type", "event_id")


@register("SELECT event_id, event_type FROM events WHERE value > 10 ORDER BY ts, event_id LIMIT 15")
def ledger_deadlines(spark, d):
    return patterns.top(Graph(spark, d).table("events").where("value > 10"), 15, F.col("ts"), F.col("event_id")).select("event_id", "event_type")


@register("SELECT event_id, event_type FROM events WHERE strftime(ts, '%Y-%m-%d') BETWEEN '2024-01-05' AND '2024-01-12' AND event_type IN ('signup', 'purchase')")
def calendar_range(spark, d):
    e = Graph(spark, d).table("events")
    return e.where(F.date_format("ts", "yyyy-MM-dd").between("2024-01-05", "2024-01-12") & F.col("event_type").isin("signup", "purchase")).select("event_id", "event_type")


@register("SELECT c_name AS name, 'old' AS side FROM customer UNION ALL SELECT s_name, 'new' FROM supplier WHERE lower(s_name) NOT IN (SELECT lower(c_name) FROM customer)")
def ledger_merge(spark, d):
    g = Graph(spark, d)
    old = g.table("customer").select(F.col("c_name").alias("name"), F.lit("old").alias("side"))
    return records.append_absent(old, g.table("supplier").select(F.col("s_name").alias("name"), F.lit("new").alias("side")), F.lower("name"))


@register("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def registry_latest(spark, d):
    return records.latest(Graph(spark, d).table("events"), ["user_id", "event_type"], F.desc("ts"), F.desc("event_id")).select("user_id", "event_type", "event_id")


@register("WITH c AS (SELECT user_id, min(ts) AS cutoff FROM events WHERE event_type = 'error' GROUP BY 1) SELECT event_id FROM events LEFT JOIN c USING (user_id) WHERE cutoff IS NULL OR ts <= cutoff OR user_id = 7")
def cutoff_filter(spark, d):
    e = Graph(spark, d).table("events")
    cut = e.where("event_type = 'error'").groupBy("user_id").agg(F.min("ts").alias("cutoff"))
    return records.before_cutoff(e, cut, "user_id", "ts", [7]).select("event_id")


@register("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 10")
def rolling_history(spark, d):
    return records.last_n(Graph(spark, d).table("events"), "user_id", 10, F.desc("ts"), F.desc("event_id")).select("user_id", "event_id")


@register("SELECT count(*) AS n, sum(n_chars)::BIGINT AS total, max(doc_id)::VARCHAR AS newest, substr(sha256(max(doc_id)::VARCHAR || '|' || sum(n_chars)::VARCHAR || '|' || count(*)::VARCHAR), 1, 24) AS digest FROM documents")
def fingerprint(spark, d):
    return records.fingerprint(Graph(spark, d).table("documents"), F.col("doc_id"), F.col("n_chars"))


@register("SELECT c.conv_id, c.turn FROM conversations c WHERE role = 'user' AND NOT EXISTS (SELECT 1 FROM conversations r WHERE r.conv_id = c.conv_id AND r.turn = c.turn + 1 AND r.role = 'assistant')")
def unreplied(spark, d):
    t = Graph(spark, d).table("conversations")
    replied = t.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"))
    return t.where("role = 'user'").join(replied, ["conv_id", "turn"], "left_anti").select("conv_id", "turn")


@register("SELECT 'unlabelled' AS gap, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'label_without_document', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def review_gaps(spark, d):
    g = Graph(spark, d)
    docs, labels = g.table("documents").select("doc_id"), g.table("labels").select("doc_id")
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("gap"), "n")
    return count(docs.join(labels, "doc_id", "left_anti"), "unlabelled").union(count(labels.join(docs, "doc_id", "left_anti"), "label_without_document"))


@register("SELECT count(*) AS total, count(*) FILTER (quality = 1) AS approved, count(*) FILTER (quality = 0) AS flagged, count(*) FILTER (toxic = 1) AS toxic FROM labels")
def review_counts(spark, d):
    return Graph(spark, d).table("labels").agg(F.count("*").alias("total"), F.count_if(F.col("quality") == 1).alias("approved"), F.count_if(F.col("quality") == 0).alias("flagged"), F.count_if(F.col("toxic") == 1).alias("toxic"))


@register("SELECT event_type AS category, count(*) AS n, count(DISTINCT user_id) AS n_items FROM events GROUP BY 1")
def annotation_stats(spark, d):
    return Graph(spark, d).table("events").groupBy(F.col("event_type").alias("category")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_items"))


@register("SELECT l_partkey AS id, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def collision_audit(spark, d):
    li = Graph(spark, d).table("lineitem")
    return li.groupBy(F.col("l_partkey").alias("id")).agg(F.count_distinct("l_suppkey").alias("n")).where("n > 1")


@register("SELECT p_name AS name, count(DISTINCT p_brand) AS n_labels, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS labels FROM part GROUP BY 1")
def name_audit(spark, d):
    return Graph(spark, d).table("part").groupBy(F.col("p_name").alias("name")).agg(F.count_distinct("p_brand").alias("n_labels"), patterns.joined_list("p_brand").alias("labels"))


_UNION = "u AS (SELECT 1 AS kind, c_name AS name, 'person' AS label, c_custkey AS id FROM customer UNION ALL SELECT 2, s_name, 'organization', s_suppkey FROM supplier UNION ALL SELECT 3, p_name, 'topic', p_partkey FROM part)"


def _entities(spark, d):
    g = Graph(spark, d)
    side = lambda t, k, name, label, key: g.table(t).select(F.lit(k).alias("kind"), F.col(name).alias("name"), F.lit(label).alias("label"), F.col(key).alias("id"))
    return side("customer", 1, "c_name", "person", "c_custkey").union(side("supplier", 2, "s_name", "organization", "s_suppkey")).union(side("part", 3, "p_name", "topic", "p_partkey"))


@register(f"WITH {_UNION} SELECT name, label, id FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY kind, id) AS r FROM u) WHERE r = 1")
def entity_lookup(spark, d):
    return resolve.keep_first(_entities(spark, d), ["name"], F.col("kind"), F.col("id")).select("name", "label", "id")


@register(f"WITH {_UNION} SELECT label, id, CASE WHEN length(name) > 12 THEN substr(name, 1, 11) || '…' ELSE name END AS title FROM u")
def hub_rows(spark, d):
    return _entities(spark, d).select("label", "id", tx.truncated(F.col("name"), 12).alias("title"))


@register("SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 3 WHEN 'BUILDING' THEN 2 WHEN 'AUTOMOBILE' THEN 1 ELSE 0 END AS rank FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE')")
def confidence_threshold(spark, d):
    level = F.when(F.col("c_mktsegment") == "MACHINERY", "High").when(F.col("c_mktsegment") == "BUILDING", "medium").when(F.col("c_mktsegment") == "AUTOMOBILE", "LOW").otherwise("none")
    return Graph(spark, d).table("customer").select("c_custkey", tx.confidence_rank(level).alias("rank")).where("rank >= 1")


@register("SELECT p_partkey, CASE WHEN p_type LIKE '%STEEL%' OR p_type LIKE '%BRASS%' THEN 'organization' WHEN p_size >= 25 THEN 'place' ELSE 'topic' END AS bucket FROM part")
def bucket_classify(spark, d):
    kind = F.when(F.contains("p_type", F.lit("STEEL")) | F.contains("p_type", F.lit("BRASS")), "organization").when(F.col("p_size") >= 25, "place").otherwise("topic")
    return Graph(spark, d).table("part").select("p_partkey", kind.alias("bucket"))
