"""Entity rows, evidence and details, and the analyst's queries over the graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.catalog import register
from tracewright.operators import hub, patterns
from tracewright.plans.bindings import SQL, Graph
from tracewright.plans.pairs import block_pairs


def q(text: str) -> str:
    return f"WITH {SQL}, {text}"


_E = "e AS (SELECT 'node' AS kind, 'N-' || s_suppkey AS id, s_name AS title, NULL::VARCHAR AS subtitle, 1992 AS ep FROM supplier UNION ALL SELECT 'claim', 'C-' || claim, text, 'ep ' || ep, ep FROM claims UNION ALL SELECT DISTINCT 'family', 'A-' || claim, 'Family ' || claim, NULL, 1992 FROM anchors UNION ALL SELECT 'artifact', 'A-' || artifact, any_value(l_returnflag) FILTER (FALSE), NULL, 1992 FROM anchors GROUP BY artifact UNION ALL SELECT 'meme', 'M-' || p_partkey, p_name, p_type, 1992 FROM part)"
_L = "l AS (SELECT 'N-' || supplier AS id, 'C-' || claim AS other FROM anchors UNION SELECT 'C-' || claim, 'N-' || supplier FROM anchors UNION SELECT 'A-' || claim, 'A-' || artifact FROM anchors UNION SELECT 'A-' || artifact, 'C-' || claim FROM anchors UNION SELECT 'M-' || part, 'N-' || supplier FROM anchors)"


def _named(prefix, c):
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def _entities(g):
    a, none = g.anchors, F.lit(None).cast("string")
    row = lambda df, kind, i, title, sub, ep=None: df.select(F.lit(kind).alias("kind"), i.alias("id"), title.cast("string").alias("title"), sub.alias("subtitle"), (F.lit(1992) if ep is None else ep).cast("long").alias("ep"))
    out = row(g.table("supplier"), "node", _named("N-", "s_suppkey"), F.col("s_name"), none)
    out = out.union(row(g.claims, "claim", _named("C-", "claim"), F.col("text"), _named("ep ", "ep"), F.col("ep")))
    out = out.union(row(a.select("claim").distinct(), "family", _named("A-", "claim"), _named("Family ", "claim"), none))
    out = out.union(row(a.select("artifact").distinct(), "artifact", _named("A-", "artifact"), none, none))
    return out.union(row(g.table("part"), "meme", _named("M-", "p_partkey"), F.col("p_name"), F.col("p_type")))


def _links(g):
    a = g.anchors
    two = lambda x, y: a.select(x.alias("id"), y.alias("other"))
    n, c, f, art, m = (_named(p, x) for p, x in (("N-", "supplier"), ("C-", "claim"), ("A-", "claim"), ("A-", "artifact"), ("M-", "part")))
    return two(n, c).union(two(c, n)).union(two(f, art)).union(two(art, c)).union(two(m, n))


@register(q(f"{_E}, {_L}, r AS (SELECT id, other, row_number() OVER (PARTITION BY id ORDER BY other) AS r FROM l), x AS (SELECT id, count(*) AS n, string_agg(other, ',' ORDER BY other) FILTER (r <= 10) AS ids FROM r GROUP BY 1) SELECT kind, e.id, title, subtitle, coalesce(n, 0) AS n_related, coalesce(ids, '') AS ids FROM e LEFT JOIN x ON x.id = e.id"))
def entity_index(spark, d):
    """Nodes, claims, families, artifacts and memes, each with its links counted and the first ten of them."""
    g = Graph(spark, d)
    return hub.entity_rows(_entities(g), _links(g)).withColumn("ids", F.array_join("ids", ","))


@register(q(f"{_E}, k AS (SELECT regexp_replace(id, '^M-', 'N-') AS id, kind, title, ep, CASE kind WHEN 'node' THEN 0 WHEN 'claim' THEN 1 WHEN 'family' THEN 2 WHEN 'artifact' THEN 3 ELSE 4 END AS rank FROM e), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rank, ep, title NULLS FIRST) AS r FROM k) SELECT id, kind, ep, title FROM r WHERE r = 1"))
def polymorphic_lookup(spark, d):
    """Every identifier once: a meme's hides behind a node's of the same name."""
    e = _entities(Graph(spark, d)).withColumn("id", F.regexp_replace("id", "^M-", "N-"))
    return hub.looked_up(e, e)


_EV = "c AS (SELECT claim, CASE WHEN claim % 3 > 0 THEN claim % 900 END AS seconds, text || CASE WHEN claim % 7 = 0 THEN ' of supplier ' ELSE '' END AS text FROM claims), f AS (SELECT DISTINCT supplier AS node, claim FROM anchors), b AS (SELECT DISTINCT part % 10 + 1 AS node, claim FROM anchors), ev AS (SELECT node, claim, seconds, text, row_number() OVER (PARTITION BY node ORDER BY seconds NULLS LAST, claim) AS place FROM (SELECT * FROM f UNION SELECT * FROM b) JOIN c USING (claim)), names AS (SELECT s_suppkey AS node, s_name AS name FROM supplier)"


def _evidence(g):
    c = g.claims.select("claim", F.when(F.col("claim") % 3 > 0, F.col("claim") % 900).alias("seconds"), F.concat("text", F.when(F.col("claim") % 7 == 0, " of supplier ").otherwise("")).alias("text"))
    f = g.anchors.select(F.col("supplier").cast("long").alias("node"), "claim").distinct()
    b = g.anchors.select((F.col("part") % 10 + 1).cast("long").alias("node"), "claim").distinct()
    names = g.table("supplier").select(F.col("s_suppkey").alias("node"), F.col("s_name").alias("name"))
    return hub.node_evidence(f, b, c), names


@register(q(f"{_EV} SELECT node, claim, seconds, place FROM ev"))
def node_evidence(spark, d):
    """Claims of each node from either side of the link, by time."""
    return _evidence(Graph(spark, d))[0].select("node", "claim", "seconds", "place")


_BEST = "w AS (SELECT ev.*, name, CASE WHEN contains(lower(text), lower(name)) THEN 0 WHEN len(list_filter(regexp_split_to_array(lower(name), '\\s+'), lambda x: length(x) >= 3 AND contains(lower(text), x))) > 0 THEN 1 WHEN seconds IS NOT NULL THEN 2 ELSE 3 END AS rank FROM ev JOIN names USING (node)), best AS (SELECT node, arg_min(claim, rank * 100000000 + place) AS claim, min(rank) AS rank FROM w GROUP BY 1)"


@register(q(f"{_EV}, {_BEST} SELECT node, claim, CASE rank WHEN 0 THEN 'name' WHEN 1 THEN 'word' WHEN 2 THEN 'timed' ELSE 'first' END AS why FROM best"))
def primary_evidence(spark, d):
    return hub.primary_evidence(*_evidence(Graph(spark, d)))


@register(q(f"{_EV}, {_BEST}, rel AS (SELECT supplier AS node, count(DISTINCT part) AS n FROM anchors GROUP BY 1) SELECT n.node, n.name, coalesce(x.n, 0) AS n_evidence, best.claim AS primary, first AS first_seconds, coalesce(rel.n, 0) AS n_related FROM names n LEFT JOIN (SELECT node, count(*) AS n, min(seconds) AS first FROM ev GROUP BY 1) x USING (node) LEFT JOIN best USING (node) LEFT JOIN rel USING (node)").replace("AS primary", 'AS "primary"'))
def entity_details(spark, d):
    g = Graph(spark, d)
    related = g.anchors.select(F.col("supplier").cast("long").alias("node"), F.col("part").alias("other"))
    return hub.details(*_evidence(g), related)


@register("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE o_orderpriority END AS text, CASE WHEN o_orderkey % 3 = 0 THEN 'late' ELSE 'early' END AS time, ['a', o_orderstatus, 'b'] AS related FROM orders")
def snippets_by_kind(spark, d):
    """Text and time by kind of entity, and identifiers of several lists together."""
    o, k = Graph(spark, d).table("orders"), F.col("o_orderkey")
    kind = F.when(k % 2 == 0, "claim").otherwise("artifact")
    late = k % 3 == 0
    claim_time = F.when((kind == "claim") & ~late, "early").when(late & (kind == "artifact"), "late").when(late, F.lit(None).cast("string"))
    item_time = F.when((kind == "artifact") & ~late, "early").when(late & (kind == "claim"), "late")
    x = hub.snippet_and_time(kind, F.col("o_orderstatus"), claim_time, F.col("o_orderpriority"), item_time)
    related = hub.related_ids([F.array(F.lit("a"), F.col("o_orderstatus")), F.lit(None).cast("array<string>"), F.array(F.lit("b"), F.lit("a"), F.lit(" "))])
    return o.select("o_orderkey", x["text"].alias("text"), x["time"].alias("time"), related.alias("related"))


# ---- analyst queries


@register("SELECT p_partkey, CASE WHEN p_type LIKE 'PROMO%' THEN 3 WHEN p_type LIKE 'STANDARD%' THEN 2 ELSE 1 END + CASE WHEN n >= 10 THEN 3 WHEN n >= 5 THEN 2 ELSE 1 END AS score FROM (SELECT p_partkey, p_type, count(DISTINCT l_suppkey) AS n FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1, 2)")
def verification_score(spark, d):
    """Three points at most for the source and for consistency, by the number of aliases."""
    g = Graph(spark, d)
    n = g.table("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count_distinct("l_suppkey").alias("n"))
    source = F.when(F.col("p_type").startswith("PROMO"), 3).when(F.col("p_type").startswith("STANDARD"), 2).otherwise(1)
    count = F.coalesce("n", F.lit(0))
    return g.table("part").join(n, "p_partkey", "left").select("p_partkey", (source + F.when(count >= 10, 3).when(count >= 5, 2).otherwise(1)).alias("score"))


@register(q("p AS (SELECT DISTINCT person, ep FROM claims), a AS (SELECT person, count(DISTINCT artifact) AS n FROM claims JOIN anchors USING (claim) GROUP BY 1) SELECT p.person, p.ep, coalesce(max(a.n), 0) AS artifacts, count(DISTINCT c.claim) AS claims FROM p LEFT JOIN a USING (person) LEFT JOIN claims c ON c.person = p.person AND c.ep <= p.ep AND c.claim IN (SELECT claim FROM anchors) GROUP BY 1, 2"))
def accumulation_gated(spark, d):
    """All artifacts of a person, and the claims up to each episode that have any: only the second count is bounded in time."""
    from pyspark.sql import Window

    g = Graph(spark, d)
    c = g.claims.select("claim", "person", "ep")
    anchored = g.anchors.select("claim").distinct().withColumn("has", F.lit(1))
    arts = c.join(g.anchors.select("claim", "artifact"), "claim").groupBy("person").agg(F.count_distinct("artifact").alias("artifacts"))
    by_ep = c.join(anchored, "claim", "left").groupBy("person", "ep").agg(F.count("has").alias("n"))
    upto = Window.partitionBy("person").orderBy("ep").rowsBetween(Window.unboundedPreceding, 0)
    return by_ep.withColumn("claims", F.sum("n").over(upto)).join(arts, "person", "left").select("person", "ep", F.coalesce("artifacts", F.lit(0)).alias("artifacts"), "claims")


@register(q("k AS (SELECT * FROM claims WHERE text LIKE '%URGENT%') SELECT a.person, a.claim AS claim1, b.claim AS claim2 FROM k a JOIN k b ON a.person = b.person AND a.claim < b.claim AND a.text <> b.text"))
def unequal_claims(spark, d):
    """Pairs of claims on one person that both hold a keyword and differ."""
    c = Graph(spark, d).claims.where("text like '%URGENT%'").select("person", "claim", "text")
    return block_pairs(c, "person", "claim", F.col("a.text") != F.col("b.text")).select("person", F.col("a.claim").alias("claim1"), F.col("b.claim").alias("claim2"))


@register(q("u AS (SELECT ep, count(*) AS n, string_agg(claim, ',' ORDER BY claim) AS claims FROM claims WHERE claim NOT IN (SELECT claim FROM anchors) GROUP BY 1), v AS (SELECT ep, string_agg(DISTINCT supplier, ',' ORDER BY supplier) AS names FROM anchors WHERE supplier % 4 = 0 GROUP BY 1), eps AS (SELECT DISTINCT ep FROM claims) SELECT eps.ep, coalesce(claims, '') AS unanchored, coalesce(names, '') AS unverified FROM eps LEFT JOIN u USING (ep) LEFT JOIN v USING (ep)"))
def review_checklist(spark, d):
    """Unanchored claims and unverified names of each episode."""
    g = Graph(spark, d)
    listed = lambda df, c: df.groupBy("ep").agg(F.array_join(F.array_sort(F.collect_set(c)), ",").alias(c))
    u = listed(g.claims.join(g.anchors.select("claim"), "claim", "left_anti").select("ep", F.col("claim").alias("unanchored")), "unanchored")
    v = listed(g.anchors.where("supplier % 4 = 0").select("ep", F.col("supplier").alias("unverified")), "unverified")
    out = g.claims.select("ep").distinct().join(u, "ep", "left").join(v, "ep", "left")
    return out.select("ep", F.coalesce("unanchored", F.lit("")).alias("unanchored"), F.coalesce("unverified", F.lit("")).alias("unverified"))


@register("SELECT event_type, user_id % 5 AS field, event_id % 3 AS reason, count(*) AS n FROM events GROUP BY 1, 2, 3 ORDER BY n DESC, event_type, field, reason LIMIT 10")
def error_frequency(spark, d):
    e = Graph(spark, d).table("events").groupBy("event_type", (F.col("user_id") % 5).alias("field"), (F.col("event_id") % 3).alias("reason")).agg(F.count("*").alias("n"))
    return patterns.top(e, 10, F.desc("n"), F.col("event_type"), F.col("field"), F.col("reason"))


@register(q("SELECT ep, count(*) FILTER (substantiated) AS ready, count(*) AS n, CASE WHEN count(*) FILTER (NOT substantiated) = 0 THEN 'published' WHEN count(*) FILTER (substantiated) = 0 THEN 'draft' ELSE 'review' END AS status FROM claims GROUP BY 1"))
def publication_status(spark, d):
    c = Graph(spark, d).claims.groupBy("ep").agg(F.count_if("substantiated").alias("ready"), F.count("*").alias("n"))
    return c.withColumn("status", F.when(F.col("ready") == F.col("n"), "published").when(F.col("ready") == 0, "draft").otherwise("review"))


@register("SELECT o_custkey AS doc, o_orderkey AS version, lag(o_orderkey) OVER w AS supersedes, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place, first_value(o_orderkey) OVER w AS origin FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def version_chain(spark, d):
    """Versions of a document, newest first, what each supersedes, and the first of the chain."""
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    back = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    o = Graph(spark, d).table("orders")
    return o.select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("version"), F.lag("o_orderkey").over(w).alias("supersedes"), F.row_number().over(back).alias("place"), F.first("o_orderkey").over(w).alias("origin"))


@register(q("SELECT DISTINCT artifact, a.claim, person FROM anchors a JOIN claims USING (claim) ORDER BY artifact, person LIMIT 100"))
def edge_sample(spark, d):
    """A hundred edges with what is at their ends."""
    g = Graph(spark, d)
    return patterns.top(g.anchors.select("artifact", "claim").distinct().join(g.claims.select("claim", "person"), "claim").select("artifact", "claim", "person"), 100, F.col("artifact"), F.col("person"))


@register(q("SELECT DISTINCT c.ep, c.claim AS family, artifact FROM claims c JOIN anchors a USING (claim)"))
def two_hops(spark, d):
    """Episode to family to artifact."""
    g = Graph(spark, d)
    families = g.claims.select("ep", F.col("claim").alias("family"))
    return families.join(g.anchors.select(F.col("claim").alias("family"), "artifact").distinct(), "family").select("ep", "family", "artifact")


@register(q("n AS (SELECT DISTINCT claim, supplier AS node FROM anchors), a AS (SELECT DISTINCT claim, artifact FROM anchors) SELECT c.claim, artifact, node FROM claims c LEFT JOIN a USING (claim) LEFT JOIN n USING (claim)"))
def claim_fan_out(spark, d):
    """Each claim with every pair of an anchor and a node of it."""
    g = Graph(spark, d)
    c = g.claims.select("claim")
    return c.join(g.anchors.select("claim", "artifact").distinct(), "claim", "left").join(g.anchors.select("claim", F.col("supplier").alias("node")).distinct(), "claim", "left")


@register(q("SELECT c.ep, count(DISTINCT c.claim) AS n, min(c.claim) AS first, max(c.claim) AS last FROM claims c WHERE claim IN (SELECT claim FROM anchors) GROUP BY 1"))
def families_per_episode(spark, d):
    g = Graph(spark, d)
    return g.claims.join(g.anchors.select("claim"), "claim", "left_semi").groupBy("ep").agg(F.count_distinct("claim").alias("n"), F.min("claim").alias("first"), F.max("claim").alias("last"))


@register("SELECT p_partkey, ['the ' || p_brand, p_type] AS aliases, p_size > 40 AS unverified, n AS history FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = p_partkey WHERE p_size > 40 OR n > 20")
def alias_listing(spark, d):
    """Aliases of names, those not verified, and how often each was checked."""
    g = Graph(spark, d)
    n = g.table("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("history"))
    out = g.table("part").join(n, "p_partkey", "left").where("p_size > 40 or history > 20")
    return out.select("p_partkey", F.array(F.concat(F.lit("the "), "p_brand"), "p_type").alias("aliases"), (F.col("p_size") > 40).alias("unverified"), "history")


@register(q("linked AS (SELECT claim FROM anchors WHERE supplier % 2 = 0 UNION SELECT claim FROM anchors WHERE part % 3 = 0) SELECT claim FROM claims WHERE claim NOT IN (SELECT claim FROM linked) ORDER BY claim"))
def claims_without_nodes(spark, d):
    """Claims that neither name a node nor are named by one."""
    g = Graph(spark, d)
    a = g.anchors
    return patterns.without_any(g.claims.select("claim"), (a.where("supplier % 2 = 0"), "claim"), (a.where("part % 3 = 0"), "claim"))


@register("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 7) AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1)")
def artifacts_without_relations(spark, d):
    """Artifacts outside both relations."""
    g = Graph(spark, d)
    li = g.table("lineitem").withColumnRenamed("l_partkey", "p_partkey")
    return patterns.without_any(g.table("part").select("p_partkey"), (li.where("l_linenumber = 7"), "p_partkey"), (li.where("l_returnflag = 'R' and l_linenumber = 1"), "p_partkey"))


_SIM = "1 - levenshtein(a.p_name, b.p_name) / greatest(length(a.p_name), length(b.p_name))::DOUBLE"


@register(f"SELECT a.p_partkey AS id1, b.p_partkey AS id2, round({_SIM}, 6) AS sim FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_partkey < b.p_partkey WHERE a.p_brand = (SELECT min(p_brand) FROM part) AND contains(a.p_name, 'a') AND contains(b.p_name, 'a') AND {_SIM} > 0.3 AND {_SIM} < 0.9 ORDER BY sim DESC, id1, id2 LIMIT 10")
def contradictions_of_one(spark, d):
    """The ten most alike of one key, a keyword in both texts."""
    p = Graph(spark, d).table("part")
    one = p.agg(F.min("p_brand").alias("p_brand"))
    got = patterns.contradictions(p.join(F.broadcast(one), "p_brand").where(F.contains("p_name", F.lit("a"))), "p_brand", "p_partkey", "p_name", first=10)
    return patterns.top(got.select("id1", "id2", "sim"), 10, F.desc("sim"), F.col("id1"), F.col("id2"))


@register(q("SELECT part, count(DISTINCT claim) AS n, md5(string_agg(DISTINCT claim || ':' || 1, ',' ORDER BY claim || ':' || 1)) AS digest FROM anchors GROUP BY 1 HAVING count(DISTINCT claim) >= 3"))
def claim_clusters(spark, d):
    """Targets of three claims or more, with the list of their claims as structs."""
    a = Graph(spark, d).anchors.select("part", F.col("claim").cast("string").alias("claim"), F.lit(1).alias("ep")).distinct()
    made = a.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("claim", "ep"))).alias("claims")).where(F.size("claims") >= 3)
    text = F.array_join(F.array_sort(F.transform("claims", lambda x: F.concat_ws(":", x["claim"], x["ep"].cast("string")))), ",")
    return made.select("part", F.size("claims").cast("long").alias("n"), F.md5(text.cast("binary")).alias("digest"))


@register("SELECT (SELECT count(*) FROM customer) AS people, (SELECT count(*) FROM supplier) AS organizations, (SELECT count(*) FROM part) AS topics, (SELECT count(*) FROM nation) AS places, (SELECT count(*) FROM orders) AS claims, (SELECT count(*) FROM lineitem) AS artifacts, (SELECT count(DISTINCT year(o_orderdate)) FROM orders) AS episodes, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)) AS links")
def graph_statistics(spark, d):
    """Eight counts of the graph in one row; an empty label counts 0."""
    g = Graph(spark, d)
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("k"), "n")
    rows = None
    for t, name in (("customer", "people"), ("supplier", "organizations"), ("part", "topics"), ("nation", "places"), ("orders", "claims"), ("lineitem", "artifacts")):
        rows = count(g.table(t), name) if rows is None else rows.union(count(g.table(t), name))
    rows = rows.union(count(g.table("orders").select(F.year("o_orderdate")).distinct(), "episodes")).union(count(g.table("lineitem").select("l_orderkey", "l_suppkey").distinct(), "links"))
    names = ["people", "organizations", "topics", "places", "claims", "artifacts", "episodes", "links"]
    return rows.agg(*[F.sum(F.when(F.col("k") == n, F.col("n"))).alias(n) for n in names])
