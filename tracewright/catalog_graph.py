"""Graph pattern, quality and resolution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.catalog import register
from tracewright.functions.text import normal_name
from tracewright.operators import patterns, quality, resolve
from tracewright.plans.bindings import SQL, Graph
from tracewright.plans.materialize import stored
from tracewright.plans.pairs import block_pairs


def q(text: str) -> str:
    return f"WITH {SQL}, {text}" if not text.lstrip().upper().startswith("SELECT") else f"WITH {SQL} {text}"


@register(q("SELECT a.node AS a, b.node AS b, count(DISTINCT a.ep) AS together, string_agg(DISTINCT a.ep, ',' ORDER BY a.ep) AS episodes FROM appearances a JOIN appearances b ON a.ep = b.ep AND a.node < b.node GROUP BY 1, 2 HAVING count(DISTINCT a.ep) >= 2"))
def cooccurrence_pairs(spark, d):
    return patterns.cooccurrence(Graph(spark, d).appearances, 2)


@register(q("SELECT a.node, count(DISTINCT a.ep) AS together FROM appearances a JOIN appearances b ON a.ep = b.ep WHERE b.node = 7 AND a.node <> 7 GROUP BY 1"))
def ego_connections(spark, d):
    return patterns.ego_connections(Graph(spark, d).appearances, 7)


@register(q("SELECT part, count(DISTINCT claim) AS n_claims, min(claim) AS first_claim, max(claim) AS last_claim FROM anchors GROUP BY 1 HAVING count(DISTINCT claim) >= 2"))
def claim_clustering(spark, d):
    return patterns.clusters(Graph(spark, d).anchors, "claim", "part", 2)


@register(q("ev AS (SELECT DISTINCT person AS node, ep, 'claim' AS kind, CAST(claim AS VARCHAR) AS item FROM claims UNION SELECT person, c.ep, 'artifact', artifact FROM claims c JOIN anchors USING (claim)), eps AS (SELECT DISTINCT node, ep FROM ev) SELECT eps.node, eps.ep, count(DISTINCT item) FILTER (kind = 'artifact') AS artifacts, count(DISTINCT item) FILTER (kind = 'claim') AS claims FROM eps JOIN ev ON ev.node = eps.node AND ev.ep <= eps.ep GROUP BY 1, 2"))
def evidence_accumulation(spark, d):
    g = Graph(spark, d)
    claims = g.claims.select(F.col("person").alias("node"), "ep", F.lit("claim").alias("kind"), F.col("claim").cast("string").alias("item"))
    artifacts = g.claims.select("claim", "person", "ep").join(g.anchors.select("claim", "artifact"), "claim")
    artifacts = artifacts.select(F.col("person").alias("node"), "ep", F.lit("artifact").alias("kind"), F.col("artifact").alias("item"))
    return patterns.evidence_accumulation(claims.union(artifacts))


@register("SELECT a.p_brand, a.p_partkey AS id1, b.p_partkey AS id2, round(1 - levenshtein(a.p_name, b.p_name) / greatest(length(a.p_name), length(b.p_name))::DOUBLE, 6) AS sim FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_partkey < b.p_partkey WHERE 1 - levenshtein(a.p_name, b.p_name) / greatest(length(a.p_name), length(b.p_name))::DOUBLE > 0.3 AND 1 - levenshtein(a.p_name, b.p_name) / greatest(length(a.p_name), length(b.p_name))::DOUBLE < 0.9")
def contradiction_pairs(spark, d):
    return patterns.contradictions(Graph(spark, d).table("part"), "p_brand", "p_partkey", "p_name")


@register("WITH e AS (SELECT DISTINCT 's' || l_suppkey AS src, 'p' || l_partkey AS dst FROM lineitem), ends AS (SELECT src AS node, src, dst FROM e UNION ALL SELECT dst, src, dst FROM e), nodes AS (SELECT 's' || s_suppkey AS node FROM supplier UNION ALL SELECT 'p' || p_partkey FROM part) SELECT node, count(src) AS degree FROM nodes LEFT JOIN ends USING (node) GROUP BY 1")
def degree_centrality(spark, d):
    g = Graph(spark, d)
    edges = g.table("lineitem").select(F.concat(F.lit("s"), "l_suppkey").alias("src"), F.lit("SUPPLIES").alias("rel"), F.concat(F.lit("p"), "l_partkey").alias("dst")).distinct()
    nodes = g.table("supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("node")).union(g.table("part").select(F.concat(F.lit("p"), "p_partkey").alias("node")))
    return patterns.degree_centrality(nodes, edges)


@register(q("deg AS (SELECT supplier AS node, count(DISTINCT part) AS degree FROM anchors GROUP BY 1) SELECT node, degree FROM deg ORDER BY degree DESC, node LIMIT 20"))
def top_degree(spark, d):
    links = Graph(spark, d).anchors.groupBy(F.col("supplier").alias("node")).agg(F.count_distinct("part").alias("degree"))
    return patterns.top(links, 20, F.desc("degree"), F.col("node"))


@register("SELECT datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS ep, count(*) AS n_events, count(DISTINCT user_id) AS n_users, count(DISTINCT event_type) AS n_types FROM events GROUP BY 1")
def episode_summary(spark, d):
    e = Graph(spark, d).table("events").withColumn("ep", (F.datediff(F.to_date("ts"), F.lit("2024-01-01")) + 1).cast("long"))
    return e.groupBy("ep").agg(F.count("*").alias("n_events"), F.count_distinct("user_id").alias("n_users"), F.count_distinct("event_type").alias("n_types"))


@register(q("linked AS (SELECT DISTINCT o_orderkey AS claim FROM orders JOIN customer ON o_custkey = c_custkey), f AS (SELECT ep, claim IN (SELECT claim FROM anchors) AS a, claim IN (SELECT claim FROM linked) AS n FROM claims) SELECT ep, count(*) AS total, count(*) FILTER (NOT a) AS no_anchor, count(*) FILTER (NOT n) AS no_node, round(100.0 * (count(*) - count(*) FILTER (NOT a) - count(*) FILTER (NOT n)) / count(*)::DOUBLE, 4) AS score FROM f GROUP BY 1"))
def protocol_compliance(spark, d):
    g = Graph(spark, d)
    linked = g.claims.join(g.table("customer").select(F.col("c_custkey").alias("person")), "person", "left_semi")
    return quality.compliance(g.claims, g.anchors, linked)


@register(q("SELECT ep, count(*) AS n_edges, count(DISTINCT claim) AS n_claims, round(count(*) / count(DISTINCT claim)::DOUBLE, 6) AS density FROM anchors GROUP BY 1"))
def evidence_density(spark, d):
    return quality.density(Graph(spark, d).anchors)


@register(q("s AS (SELECT ep, row_number() OVER (PARTITION BY node ORDER BY ep) AS n FROM appearances) SELECT ep, count(*) FILTER (n = 1) AS new, count(*) FILTER (n > 1) AS reused, round(100.0 * avg((n > 1)::INT), 4) AS rate FROM s GROUP BY 1"))
def node_reuse_rate(spark, d):
    return patterns.reuse_rate(Graph(spark, d).appearances)


@register(q("SELECT node, count(DISTINCT ep) AS n_episodes, max(ep) AS last_ep FROM appearances WHERE ep < 15 GROUP BY 1 HAVING count(DISTINCT ep) >= 2"))
def recurring_before_episode(spark, d):
    return patterns.recurring_before(Graph(spark, d).appearances, 15)


@register(q("SELECT node, count(DISTINCT ep) AS n_episodes, string_agg(DISTINCT ep, ',' ORDER BY ep) AS episodes FROM appearances GROUP BY 1"))
def node_reuse_stats(spark, d):
    a = Graph(spark, d).appearances
    return a.groupBy("node").agg(F.count_distinct("ep").alias("n_episodes"), patterns.joined_list("ep").alias("episodes"))


@register("SELECT label, n FROM (SELECT 'claim' AS label, count(*) AS n FROM orders UNION ALL SELECT 'artifact', count(*) FROM lineitem UNION ALL SELECT 'person', count(*) FROM customer UNION ALL SELECT 'organization', count(*) FROM supplier UNION ALL SELECT 'topic', count(*) FROM part UNION ALL SELECT 'place', count(*) FROM nation)")
def graph_label_counts(spark, d):
    g, out = Graph(spark, d), None
    for label, name in (("claim", "orders"), ("artifact", "lineitem"), ("person", "customer"), ("organization", "supplier"), ("topic", "part"), ("place", "nation")):
        part = g.table(name).agg(F.count("*").alias("n")).select(F.lit(label).alias("label"), "n")
        out = part if out is None else out.union(part)
    return out


@register("SELECT 'ANCHORS' AS rel, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) UNION ALL SELECT 'INVOLVES', count(*) FROM (SELECT DISTINCT o_orderkey, o_custkey FROM orders) UNION ALL SELECT 'MENTIONS', count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) UNION ALL SELECT 'SUPPLIES', count(*) FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)")
def graph_rel_counts(spark, d):
    g, out = Graph(spark, d), None
    for rel, name, keys in (("ANCHORS", "lineitem", ("l_orderkey", "l_linenumber")), ("INVOLVES", "orders", ("o_orderkey", "o_custkey")), ("MENTIONS", "lineitem", ("l_orderkey", "l_partkey")), ("SUPPLIES", "lineitem", ("l_suppkey", "l_partkey"))):
        part = g.table(name).select(*keys).distinct().agg(F.count("*").alias("n")).select(F.lit(rel).alias("rel"), "n")
        out = part if out is None else out.union(part)
    return out


@register("SELECT o_orderstatus AS label, min('C-' || o_orderkey) AS first_id, max('C-' || o_orderkey) AS last_id, count(*) AS n FROM orders GROUP BY 1")
def graph_id_ranges(spark, d):
    o = Graph(spark, d).table("orders").withColumn("id", F.concat(F.lit("C-"), "o_orderkey"))
    return o.groupBy(F.col("o_orderstatus").alias("label")).agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count("*").alias("n"))


@register(q("SELECT ep, min('C-' || claim) AS first_claim, max('C-' || claim) AS last_claim, count(DISTINCT claim) AS n FROM claims GROUP BY 1"))
def id_ranges_by_episode(spark, d):
    c = Graph(spark, d).claims.withColumn("id", F.concat(F.lit("C-"), "claim"))
    return c.groupBy("ep").agg(F.min("id").alias("first_claim"), F.max("id").alias("last_claim"), F.count_distinct("claim").alias("n"))


@register("SELECT count(DISTINCT o_orderkey) AS n_claims, count(DISTINCT o_custkey) AS n_people, sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END)::BIGINT AS n_open, count(DISTINCT year(o_orderdate)) AS n_episodes FROM orders")
def overall_statistics(spark, d):
    c = Graph(spark, d).claims
    return c.agg(F.count_distinct("claim").alias("n_claims"), F.count_distinct("person").alias("n_people"), F.count_if(~F.col("substantiated")).alias("n_open"), F.count_distinct("ep").alias("n_episodes"))


_PRESSURE = q("a AS (SELECT part AS node, count(DISTINCT artifact) AS n_artifacts, count(DISTINCT claim) AS n_claims, count(DISTINCT ep) AS n_episodes FROM anchors GROUP BY 1), p AS (SELECT p_partkey AS node, coalesce(n_artifacts, 0) AS n_artifacts, coalesce(n_claims, 0) AS n_claims, coalesce(n_episodes, 0) AS n_episodes FROM part LEFT JOIN a ON node = p_partkey) SELECT *, n_artifacts + 2 * n_claims + n_episodes AS pressure FROM p")


def _pressure(spark, d):
    g = Graph(spark, d)
    links = g.anchors.withColumnRenamed("part", "node")
    return patterns.pressure(g.table("part").select(F.col("p_partkey").alias("node")), links, links, links)


@register(_PRESSURE)
def targets_pressure(spark, d):
    return _pressure(spark, d)


@register(f"SELECT * FROM ({_PRESSURE}) ORDER BY pressure DESC, node LIMIT 10")
def investigative_pressure(spark, d):
    return patterns.top(_pressure(spark, d), 10, F.desc("pressure"), F.col("node"))


@register(q("SELECT claim, ep FROM claims WHERE substantiated AND claim NOT IN (SELECT claim FROM anchors)"))
def validate_claims_without_anchor(spark, d):
    g = Graph(spark, d)
    return patterns.without_any(g.claims.where("coalesce(substantiated, true)"), (g.anchors, "claim")).select("claim", "ep")


@register(q("SELECT claim FROM claims WHERE NOT substantiated AND person NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND claim NOT IN (SELECT claim FROM anchors WHERE l_returnflag = 'R')"))
def validate_unsubstantiated_unlinked(spark, d):
    g = Graph(spark, d)
    people = g.table("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("person"))
    return patterns.without_any(g.claims.where("not substantiated"), (people, "person"), (g.anchors.where("l_returnflag = 'R'"), "claim")).select("claim")


@register("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45) AND p_size > 40")
def validate_artifacts_isolated(spark, d):
    g = Graph(spark, d)
    used = g.table("lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return patterns.without_any(g.table("part").where("p_size > 40"), (used, "p_partkey")).select("p_partkey")


@register("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%') AND c_custkey NOT IN (SELECT user_id FROM events) AND c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def validate_nodes_no_evidence(spark, d):
    g = Graph(spark, d)
    o = g.table("orders").where("o_orderpriority like '1%'").select(F.col("o_custkey").alias("c_custkey"))
    e = g.table("events").select(F.col("user_id").alias("c_custkey"))
    s = g.table("supplier").select(F.col("s_suppkey").alias("c_custkey"))
    return patterns.without_any(g.table("customer"), (o, "c_custkey"), (e, "c_custkey"), (s, "c_custkey")).select("c_custkey")


@register(q("v AS (SELECT 'claims_without_anchor' AS kind, 'CRITICAL' AS severity, count(*) AS n FROM claims WHERE substantiated AND claim NOT IN (SELECT claim FROM anchors) UNION ALL SELECT 'topics_without_claims', 'WARN', count(*) FROM part WHERE p_partkey NOT IN (SELECT part FROM anchors)) SELECT * FROM v"))
def validation_report(spark, d):
    g = Graph(spark, d)
    a = patterns.without_any(g.claims.where("substantiated"), (g.anchors, "claim")).agg(F.count("*").alias("n"))
    b = patterns.without_any(g.table("part").withColumnRenamed("p_partkey", "part"), (g.anchors, "part")).agg(F.count("*").alias("n"))
    kind = lambda x, k, s: x.select(F.lit(k).alias("kind"), F.lit(s).alias("severity"), "n")
    return kind(a, "claims_without_anchor", "CRITICAL").union(kind(b, "topics_without_claims", "WARN"))


@register("SELECT coalesce(max(o_orderkey), 0) + 1 AS next_claim, (SELECT coalesce(max(c_custkey), 0) + 1 FROM customer) AS next_person FROM orders")
def next_ids(spark, d):
    g = Graph(spark, d)
    c = g.table("orders").select(F.concat(F.lit("C-"), "o_orderkey").alias("id")).agg(resolve.next_ids(None, "id", "C-", 1).alias("next_claim"))
    p = g.table("customer").select(F.concat(F.lit("N-"), "c_custkey").alias("id")).agg(resolve.next_ids(None, "id", "N-", 1).alias("next_person"))
    return c.withColumn("one", F.lit(1)).join(p.withColumn("one", F.lit(1)), "one").drop("one")


@register("SELECT g AS ep FROM range(1, 31) t(g) WHERE g NOT IN (SELECT day(ts) FROM events WHERE user_id = 7)")
def missing_episodes(spark, d):
    e = Graph(spark, d).table("events").where("user_id = 7").select(F.dayofmonth("ts").alias("ep"))
    return patterns.missing_members(e, "ep", 30).select(F.col("ep").cast("long").alias("ep"))


@register("SELECT DISTINCT l_partkey AS ref FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <> 3)")
def dangling_refs(spark, d):
    g = Graph(spark, d)
    refs = g.table("lineitem").select(F.col("l_partkey").alias("ref")).distinct()
    return resolve.dangling(refs, "ref", g.table("part").where("p_size <> 3"), "p_partkey")


@register("SELECT c_custkey, c_name FROM customer WHERE contains(c_name, '00012') OR contains(c_mktsegment, 'MACH')")
def person_search(spark, d):
    return Graph(spark, d).table("customer").where(F.contains("c_name", F.lit("00012")) | F.contains("c_mktsegment", F.lit("MACH"))).select("c_custkey", "c_name")


@register(q("c AS (SELECT person, count(DISTINCT claim) AS n_claims, count(DISTINCT ep) AS n_episodes FROM claims GROUP BY 1), a AS (SELECT person, count(DISTINCT artifact) AS n_artifacts FROM claims JOIN anchors USING (claim) GROUP BY 1) SELECT c_custkey AS person, c_name AS name, coalesce(n_claims, 0) AS n_claims, coalesce(n_episodes, 0) AS n_episodes, coalesce(n_artifacts, 0) AS n_artifacts FROM customer LEFT JOIN c ON c.person = c_custkey LEFT JOIN a ON a.person = c_custkey"))
def person_summary(spark, d):
    g = Graph(spark, d)
    c = g.claims.groupBy("person").agg(F.count_distinct("claim").alias("n_claims"), F.count_distinct("ep").alias("n_episodes"))
    a = g.claims.join(g.anchors.select("claim", "artifact"), "claim").groupBy("person").agg(F.count_distinct("artifact").alias("n_artifacts"))
    people = g.table("customer").select(F.col("c_custkey").alias("person"), F.col("c_name").alias("name"))
    return people.join(c, "person", "left").join(a, "person", "left").fillna(0, ["n_claims", "n_episodes", "n_artifacts"])


@register(q("SELECT c.claim, c.ep, string_agg(a.artifact, ',' ORDER BY a.artifact) AS artifacts FROM claims c LEFT JOIN anchors a USING (claim) WHERE c.person = 11 GROUP BY 1, 2"))
def claims_about(spark, d):
    g = Graph(spark, d)
    c = g.claims.where("person = 11").join(g.anchors.select("claim", "artifact"), "claim", "left").groupBy("claim", "ep").agg(F.array_join(F.array_sort(F.collect_list("artifact")), ",").alias("artifacts"))
    return c.withColumn("artifacts", F.nullif("artifacts", F.lit("")))


@register(q("SELECT artifact, a.ep FROM claims c JOIN anchors a USING (claim) WHERE c.person = 11"))
def artifacts_about(spark, d):
    g = Graph(spark, d)
    return g.claims.where("person = 11").select("claim").join(g.anchors, "claim").select("artifact", "ep")


@register(q("SELECT claim, text FROM claims WHERE lower(text) LIKE '%urgent%' ORDER BY claim LIMIT 20"))
def claim_search(spark, d):
    return patterns.top(Graph(spark, d).claims.where(F.contains(F.lower("text"), F.lit("urgent"))).select("claim", "text"), 20, F.col("claim"))


@register("SELECT o_orderkey AS claim, strftime(o_orderdate, '%Y-%m-%d') AS at FROM orders WHERE o_custkey = 11")
def timeline(spark, d):
    return Graph(spark, d).table("orders").where("o_custkey = 11").select(F.col("o_orderkey").alias("claim"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("at"))


_NAMES = "n AS (SELECT trim(lower(p_name)) AS name, min(p_partkey) AS id, count(*) AS members FROM part GROUP BY 1)"


@register("WITH n AS (SELECT p_brand, lower(p_name) AS name, min(p_partkey) AS id FROM part GROUP BY 1, 2) SELECT least(a.id, b.id) AS a, greatest(a.id, b.id) AS b, CAST(levenshtein(a.name, b.name) AS INT) AS distance FROM n a JOIN n b ON a.p_brand = b.p_brand AND a.name < b.name AND abs(length(a.name) - length(b.name)) <= 3 AND levenshtein(a.name, b.name) BETWEEN 1 AND 3")
def fuzzy_duplicates(spark, d):
    """Near names within a label, the brand."""
    return resolve.fuzzy_pairs(Graph(spark, d).table("part"), "p_partkey", "p_name", 3, "p_brand")


@register("WITH n AS (SELECT p_brand, p_name AS name, min(p_partkey) AS id FROM part GROUP BY 1, 2) SELECT least(a.id, b.id) AS a, greatest(a.id, b.id) AS b, CAST(levenshtein(a.name, b.name) AS INT) AS distance FROM n a JOIN n b ON a.name < b.name AND a.p_brand = b.p_brand AND levenshtein(a.name, b.name) BETWEEN 1 AND 3")
def raw_name_duplicates(spark, d):
    """As ``fuzzy_duplicates``, on names as they are written."""
    p = Graph(spark, d).table("part").select("p_brand", "p_partkey", "p_name")
    kinds = p.groupBy("p_brand", F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))
    near = resolve.near_names(kinds.select("p_brand", "name"), kinds.select("p_brand", F.col("name").alias("other")), 3, ("p_brand",)).where("name < other")
    near = near.join(kinds.withColumnRenamed("id", "ia"), ["p_brand", "name"]).join(kinds.withColumnsRenamed({"id": "ib", "name": "other"}), ["p_brand", "other"])
    return near.select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b"), "distance")


@register("WITH n AS (SELECT p_partkey AS id, p_name AS name FROM part WHERE p_size = 7), e AS (SELECT p_partkey AS other_id, p_name AS other FROM part WHERE p_size <> 7 UNION ALL SELECT -c_custkey, c_name FROM customer) SELECT id, other_id, CAST(levenshtein(name, other) AS INT) AS distance FROM n, e WHERE abs(length(name) - length(other)) <= 3 AND levenshtein(name, other) <= 3")
def new_against_existing(spark, d):
    """Names of one episode (a size) against those of all others, whatever their label."""
    g = Graph(spark, d)
    p = g.table("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), "p_size")
    other = g.table("customer").select((-F.col("c_custkey")).alias("id"), F.col("c_name").alias("name"))
    return resolve.new_against_existing(p.where("p_size = 7").select("id", "name"), p.select("id", "name").union(other))


@register(f"WITH {_NAMES} SELECT name, id, members FROM n")
def name_classes(spark, d):
    return resolve.name_classes(Graph(spark, d).table("part"), "p_partkey", "p_name")


@register("WITH q AS (SELECT DISTINCT substr(p_name, 2) AS query FROM part), k AS (SELECT min(p_partkey) AS id, lower(p_name) AS name FROM part GROUP BY 2 UNION ALL SELECT p_partkey, lower('the ' || p_name) FROM part WHERE p_size = 1), m AS (SELECT query, id, CAST(levenshtein(lower(query), name) AS INT) AS distance, row_number() OVER (PARTITION BY query ORDER BY levenshtein(lower(query), name), id) AS r FROM q, k WHERE abs(length(query) - length(name)) <= 3 AND levenshtein(lower(query), name) <= 3) SELECT query, id, distance FROM m WHERE r = 1")
def suggest_node(spark, d):
    """Names that lost their first letter, against all names and their aliases ('the ..' of the smallest parts)."""
    p = Graph(spark, d).table("part")
    alias = p.where("p_size = 1").select(F.col("p_partkey").alias("id"), F.concat(F.lit("the "), "p_name").alias("name"))
    return resolve.nearest_name(p.select(F.substring("p_name", 2, 10**6)), resolve.name_classes(p, "p_partkey", "p_name").select("id", "name").union(alias), "id", "name")


@register("WITH s AS (SELECT p_name, min(p_partkey) AS component FROM part GROUP BY 1) SELECT p_partkey AS node, component FROM part JOIN s USING (p_name) WHERE p_partkey IN (SELECT p_partkey FROM part JOIN (SELECT p_name FROM part GROUP BY 1 HAVING count(*) > 1) USING (p_name))")
def auto_merge_components(spark, d):
    p = Graph(spark, d).table("part")
    first = p.groupBy("p_name").agg(F.min("p_partkey").alias("b"))
    return resolve.merge_map(p.join(first, "p_name").where("p_partkey <> b").select(F.col("p_partkey").alias("a"), "b"))


@register("WITH s AS (SELECT p_name, min(p_partkey) AS m FROM part GROUP BY 1) SELECT DISTINCT l_orderkey AS claim, m AS part FROM lineitem JOIN part ON l_partkey = p_partkey JOIN s USING (p_name)")
def merge_nodes_remap(spark, d):
    g = Graph(spark, d)
    edges = g.table("lineitem").select(F.col("l_orderkey").alias("claim"), F.col("l_partkey").alias("part"))
    return resolve.remapped(edges, stored(auto_merge_components(spark, d), "merge-map"), "part")


@register("WITH f AS (SELECT p_name, min(p_partkey) AS o FROM part GROUP BY 1), i AS (SELECT p_name, 999 + row_number() OVER (ORDER BY o) AS new_id FROM f) SELECT p_partkey, new_id FROM part JOIN i USING (p_name)")
def assign_ids(spark, d):
    return resolve.assign_ids(Graph(spark, d).table("part"), normal_name(F.col("p_name")), F.col("p_partkey"), 1000).select("p_partkey", F.col("new_id").cast("long").alias("new_id"))


@register("WITH u AS (SELECT DISTINCT year(o_orderdate) AS ep, 1000 + o_custkey AS claim FROM orders), r AS (SELECT ep, claim, row_number() OVER (ORDER BY ep, claim) - 1 AS i FROM u) SELECT ep, claim, i + greatest(1000, max(claim - i) OVER (ORDER BY i)) AS fixed FROM r")
def collision_repair_claims(spark, d):
    """Claim numbers used again in later years."""
    o = Graph(spark, d).table("orders").select(F.year("o_orderdate").cast("long").alias("ep"), (F.col("o_custkey") + 1000).alias("claim"))
    return resolve.claim_repair(o, "ep", "claim")


@register("WITH u AS (SELECT DISTINCT year(l_shipdate) AS ep, 1000 + l_partkey AS family FROM lineitem), m AS (SELECT *, ep > min(ep) OVER (PARTITION BY family) AS again FROM u), k AS (SELECT *, sum(again::INT) OVER (ORDER BY ep, family) AS given FROM m) SELECT ep, family, CAST(CASE WHEN again THEN given + max(CASE WHEN NOT again THEN family - given END) OVER (ORDER BY ep, family) ELSE family END AS BIGINT) AS fixed FROM k")
def collision_repair(spark, d):
    """Family numbers used again in later years."""
    li = Graph(spark, d).table("lineitem").select(F.year("l_shipdate").cast("long").alias("ep"), (F.col("l_partkey") + 1000).alias("family"))
    return resolve.family_repair(li, "ep", "family")


@register(q("SELECT claim, CASE WHEN text IS NULL OR trim(text) = '' THEN 'placeholder' WHEN claim IN (SELECT claim FROM anchors) THEN 'anchored' WHEN substantiated THEN 'substantiated' ELSE 'unsubstantiated' END AS reason, claim IN (SELECT claim FROM anchors) OR substantiated AS admit FROM claims"))
def claim_admission(spark, d):
    g = Graph(spark, d)
    return quality.admission(g.claims, g.anchors)


_EDGES = "f AS (SELECT DISTINCT l_suppkey AS node, l_orderkey AS claim FROM lineitem), b AS (SELECT DISTINCT l_suppkey AS node, l_orderkey AS claim FROM lineitem WHERE l_linenumber <> 2), c AS (SELECT o_orderkey AS claim FROM orders WHERE o_orderstatus <> 'P')"
_ISSUES = f"WITH {_EDGES}, i AS (SELECT node, claim, 'node_claim_missing' AS issue FROM f WHERE claim NOT IN (SELECT claim FROM c) UNION SELECT node, claim, 'node_claim_subject_mismatch' FROM f WHERE claim IN (SELECT claim FROM c) AND claim IN (SELECT claim FROM b) AND NOT EXISTS (SELECT 1 FROM b WHERE b.node = f.node AND b.claim = f.claim) UNION SELECT node, claim, 'claim_node_backlink_missing' FROM b WHERE NOT EXISTS (SELECT 1 FROM f WHERE b.node = f.node AND b.claim = f.claim))"


def _edge_sides(spark, d):
    g = Graph(spark, d)
    li = g.table("lineitem").select(F.col("l_suppkey").alias("node"), F.col("l_orderkey").alias("claim"), "l_linenumber")
    return li.select("node", "claim").distinct(), li.where("l_linenumber <> 2").select("node", "claim").distinct(), g.table("orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("claim"))


@register(f"{_ISSUES} SELECT * FROM i")
def node_claim_screen(spark, d):
    return resolve.edge_screen(*_edge_sides(spark, d))


@register(f"{_ISSUES} SELECT node, claim FROM f WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.node = f.node AND i.claim = f.claim AND issue <> 'claim_node_backlink_missing') UNION SELECT node, claim FROM b")
def node_claim_sanitise(spark, d):
    return resolve.edge_sanitise(*_edge_sides(spark, d))


@register(f"{_ISSUES} SELECT issue, count(*) AS n FROM i GROUP BY 1")
def issue_counts(spark, d):
    return node_claim_screen(spark, d).groupBy("issue").agg(F.count("*").alias("n"))


_DOCS = "c AS (SELECT o_custkey AS doc, o_orderkey AS ref, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS na, (SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_orderkey = o_orderkey) AS nn FROM orders), s AS (SELECT doc, count(*) AS n_claims, avg((na > 0)::INT) AS coverage, least(avg(na) / 2, 1.0) AS grounding, least(avg(nn) / 3, 1.0) AS crossref, 1.0 AS timed FROM c GROUP BY 1), o AS (SELECT *, round(0.3 * coverage + 0.3 * grounding + 0.2 * crossref + 0.2 * timed, 6) AS overall FROM s)"


@register(f"WITH {_DOCS} SELECT doc, n_claims, round(coverage, 6) AS coverage, round(grounding, 6) AS grounding, round(crossref, 6) AS crossref, timed::DOUBLE AS timed, overall, CASE WHEN overall >= 0.9 THEN 'A' WHEN overall >= 0.8 THEN 'B' WHEN overall >= 0.6 THEN 'C' WHEN overall >= 0.4 THEN 'D' ELSE 'F' END AS letter FROM o")
def document_scores(spark, d):
    g = Graph(spark, d)
    return quality.document_scores(quality.nested_documents(g.table("orders"), g.table("lineitem")))


@register("SELECT o_custkey AS doc, o_orderkey AS ref, 'related_nodes' AS kind, 'N-' || l_suppkey AS target FROM (SELECT DISTINCT o_custkey, o_orderkey, l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey) WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) UNION ALL SELECT o_custkey, o_orderkey, 'anchored_artifacts', concat_ws('.', l_orderkey, l_linenumber) FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber = 7")
def ref_integrity(spark, d):
    g = Graph(spark, d)
    docs = quality.nested_documents(g.table("orders"), g.table("lineitem"))
    artifacts = g.table("lineitem").where("l_linenumber <> 7").select(F.concat_ws(".", "l_orderkey", "l_linenumber").alias("id"))
    nodes = g.table("supplier").where("s_acctbal > 0").select(F.concat(F.lit("N-"), "s_suppkey").alias("id"))
    return quality.reference_integrity(docs, artifacts, nodes)


# Analyst queries.


@register(q("SELECT c.claim, count(a.artifact) AS n FROM claims c LEFT JOIN anchors a USING (claim) GROUP BY 1 HAVING count(a.artifact) <= 1"))
def weak_claims(spark, d):
    g = Graph(spark, d)
    return g.claims.select("claim").join(g.anchors.select("claim", "artifact"), "claim", "left").groupBy("claim").agg(F.count("artifact").alias("n")).where("n <= 1")


@register(q("SELECT a.claim AS claim1, b.claim AS claim2, a.person FROM claims a JOIN claims b ON a.person = b.person AND a.ep < b.ep"))
def cross_episode_pairs(spark, d):
    c = Graph(spark, d).claims.select("person", "claim", "ep")
    met = block_pairs(c, "person", "claim", F.col("a.ep") != F.col("b.ep"))
    first, second = F.when(F.col("a.ep") < F.col("b.ep"), F.col("a.claim")).otherwise(F.col("b.claim")), F.when(F.col("a.ep") < F.col("b.ep"), F.col("b.claim")).otherwise(F.col("a.claim"))
    return met.select(first.alias("claim1"), second.alias("claim2"), "person")


@register(q("SELECT claim, round(count(*) * avg(CASE l_returnflag WHEN 'R' THEN 3 WHEN 'A' THEN 2 ELSE 1 END), 2) AS strength FROM anchors GROUP BY 1 ORDER BY strength DESC, claim LIMIT 20"))
def evidence_strength(spark, d):
    rank = F.when(F.col("l_returnflag") == "R", 3).when(F.col("l_returnflag") == "A", 2).otherwise(1)
    got = Graph(spark, d).anchors.groupBy("claim").agg(F.round(F.count("*") * F.avg(rank), 2).alias("strength"))
    return patterns.top(got, 20, F.desc("strength"), F.col("claim"))


@register(q("SELECT part, count(DISTINCT claim) AS n, count(DISTINCT ep) AS eps FROM anchors GROUP BY 1 HAVING count(DISTINCT ep) > 1"))
def artifact_reuse(spark, d):
    return Graph(spark, d).anchors.groupBy("part").agg(F.count_distinct("claim").alias("n"), F.count_distinct("ep").alias("eps")).where("eps > 1")


@register(q("f AS (SELECT ep, count(*) AS bad FROM claims WHERE claim NOT IN (SELECT claim FROM anchors) GROUP BY 1) SELECT ep, round(bad / (SELECT count(*) FROM claims)::DOUBLE, 8) AS rate FROM f"))
def error_rate(spark, d):
    g = Graph(spark, d)
    bad = patterns.without_any(g.claims, (g.anchors, "claim")).groupBy("ep").agg(F.count("*").alias("bad")).withColumn("one", F.lit(1))
    return bad.join(g.claims.agg(F.count("*").alias("total")).withColumn("one", F.lit(1)), "one").select("ep", F.round(F.col("bad") / F.col("total"), 8).alias("rate"))


@register(q("SELECT a.artifact, string_agg(DISTINCT c.person, ',' ORDER BY c.person) AS people, count(DISTINCT c.claim) AS n_claims FROM anchors a JOIN claims c USING (claim) WHERE a.l_returnflag = 'R' GROUP BY 1"))
def evidence_trail(spark, d):
    g = Graph(spark, d)
    both = g.anchors.where("l_returnflag = 'R'").select("artifact", "claim").join(g.claims.select("claim", "person"), "claim")
    return both.groupBy("artifact").agg(patterns.joined_list("person").alias("people"), F.count_distinct("claim").alias("n_claims"))


@register("SELECT o_orderpriority, year(o_orderdate) AS ep, count(*) AS n, grouping_id(o_orderpriority, year(o_orderdate)) AS level FROM orders GROUP BY CUBE (o_orderpriority, year(o_orderdate))")
def claim_cube(spark, d):
    """Not one of the studied operators: Spark's own CUBE over the same binding."""
    o = Graph(spark, d).table("orders").withColumn("ep", F.year("o_orderdate").cast("long"))
    return o.cube("o_orderpriority", "ep").agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("level"))
