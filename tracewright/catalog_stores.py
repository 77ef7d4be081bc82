"""Queries of the mutable stores, bound to the star-schema tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.catalog import register
from tracewright.operators import stores, transcript
from tracewright.plans.bindings import Graph
from tracewright.plans.materialize import shared_dir
from tracewright.sources.keyed_log import KeyedLog


def _t(spark, d, name):
    return Graph(spark, d).table(name)


@register("SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN n.name ELSE coalesce(n.name, o.name) END AS name, CASE WHEN o.k IS NULL THEN n.kind ELSE o.kind END AS kind, CASE WHEN o.k IS NULL THEN 'now' ELSE 'then' END AS created_at, CASE WHEN o.k IS NOT NULL AND n.k IS NOT NULL THEN 'now' END AS updated_at FROM (SELECT c_custkey AS k, c_name AS name, 'old' AS kind FROM customer) o FULL JOIN (SELECT s_suppkey * 30 AS k, s_name AS name, 'new' AS kind FROM supplier) n ON o.k = n.k")
def merge_on_create(spark, d):
    """Rows created and matched by key; the kind is set on creation alone."""
    none = F.lit(None).cast("string")
    old = _t(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.lit("old").alias("kind"), F.lit("then").alias("created_at"), none.alias("updated_at"))
    new = _t(spark, d, "supplier").select((F.col("s_suppkey") * 30).alias("k"), F.col("s_name").alias("name"), F.lit("new").alias("kind"))
    return stores.merged(old, new, ["k"], F.lit("now"), ["kind"])


_GRAPH = "n AS (SELECT 'c' || c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'NameCorrection' ELSE 'Person' END AS label FROM customer), e AS (SELECT DISTINCT 'c' || o_custkey AS src, 'c' || (o_custkey + o_orderkey % 6) AS dst FROM orders)"


@register(f"WITH {_GRAPH} SELECT id AS src, NULL AS dst FROM n WHERE label = 'NameCorrection' UNION ALL SELECT src, dst FROM e WHERE src IN (SELECT id FROM n WHERE label = 'NameCorrection') AND dst IN (SELECT id FROM n WHERE label = 'NameCorrection')")
def graph_reset(spark, d):
    """What is left of a graph emptied but for its corrections: nodes, then edges."""
    c, o = F.col("c_custkey"), _t(spark, d, "orders")
    nodes = _t(spark, d, "customer").select(F.concat(F.lit("c"), c.cast("string")).alias("id"), F.when(c % 3 == 0, "NameCorrection").otherwise("Person").alias("label"))
    edges = o.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("src"), F.concat(F.lit("c"), (F.col("o_custkey") + F.col("o_orderkey") % 6).cast("string")).alias("dst")).distinct()
    left, kept = stores.reset(nodes, edges, ["NameCorrection"])
    return left.select(F.col("id").alias("src"), F.lit(None).cast("string").alias("dst")).union(kept)


@register("WITH src AS (SELECT 's' || o_custkey AS id FROM orders GROUP BY 1), gone AS (SELECT id FROM src WHERE id LIKE 's1%'), ch AS (SELECT 's' || o_custkey AS source, 'k' || o_orderkey AS chunk FROM orders), em AS (SELECT DISTINCT 's' || o_custkey AS source, 'i' || o_orderkey % 200 AS item FROM orders), tg AS (SELECT DISTINCT 'k' || l_orderkey AS chunk, 't' || l_partkey AS tag FROM lineitem WHERE l_linenumber = 1), gch AS (SELECT chunk FROM ch WHERE source IN (SELECT id FROM gone)) SELECT 'source' AS kind, id FROM gone UNION ALL SELECT 'chunk', chunk FROM gch UNION ALL SELECT 'item', item FROM (SELECT DISTINCT item FROM em) WHERE item NOT IN (SELECT item FROM em WHERE source NOT IN (SELECT id FROM gone)) UNION ALL SELECT 'tag', tag FROM (SELECT DISTINCT tag FROM tg) WHERE tag NOT IN (SELECT tag FROM tg WHERE chunk NOT IN (SELECT chunk FROM gch))")
def cascading_clear(spark, d):
    o = _t(spark, d, "orders")
    s, k = F.concat(F.lit("s"), F.col("o_custkey").cast("string")), F.concat(F.lit("k"), F.col("o_orderkey").cast("string"))
    em = o.select(s.alias("source"), F.concat(F.lit("i"), (F.col("o_orderkey") % 200).cast("string")).alias("item")).distinct()
    tg = _t(spark, d, "lineitem").where("l_linenumber = 1").select(F.concat(F.lit("k"), F.col("l_orderkey").cast("string")).alias("chunk"), F.concat(F.lit("t"), F.col("l_partkey").cast("string")).alias("tag")).distinct()
    return stores.cleared(o.select(s.alias("id")).distinct(), o.select(s.alias("source"), k.alias("chunk")), em, tg, "s1")


_M = "nodes AS (SELECT c_custkey AS id, c_name AS name, [c_mktsegment] AS aliases FROM customer), m AS (SELECT c_custkey AS id, c_custkey - c_custkey % 4 AS into FROM customer WHERE c_custkey % 4 IN (1, 2) AND c_custkey - c_custkey % 4 IN (SELECT c_custkey FROM customer))"


@register(f"WITH {_M}, more AS (SELECT into, flatten(list([name] || aliases ORDER BY id)) AS more FROM nodes JOIN m USING (id) GROUP BY 1), u AS (SELECT n.id, name, list_concat(aliases, coalesce(more, [])) AS a FROM nodes n LEFT JOIN more ON into = n.id WHERE n.id NOT IN (SELECT id FROM m)) SELECT id, name, array_to_string(list_filter(a, lambda x, i: list_position(a, x) = i AND x <> name), ',') AS aliases FROM u".replace("into,", '"into",').replace("ON into", 'ON "into"').replace("AS into", 'AS "into"'))
def merged_nodes(spark, d):
    return _merge(spark, d)[0].select("id", "name", F.array_join("aliases", ",").alias("aliases"))


def _merge(spark, d):
    c, k = _t(spark, d, "customer"), F.col("c_custkey")
    nodes = c.select(k.alias("id"), F.col("c_name").alias("name"), F.array("c_mktsegment").alias("aliases"))
    m = c.where(k % 4 < 3).where(k % 4 > 0).select(k.alias("id"), (k - k % 4).alias("into")).join(c.select(k.alias("into")), "into", "left_semi").select("id", "into")
    edges = _t(spark, d, "orders").select(F.col("o_custkey").alias("src"), (F.col("o_custkey") + F.col("o_orderkey") % 3).alias("dst"))
    return stores.nodes_merged(nodes, edges, m)


@register(f"WITH {_M} SELECT DISTINCT coalesce(a.into, o_custkey) AS src, coalesce(b.into, o_custkey + o_orderkey % 3) AS dst FROM orders LEFT JOIN m a ON a.id = o_custkey LEFT JOIN m b ON b.id = o_custkey + o_orderkey % 3 WHERE coalesce(a.into, o_custkey) <> coalesce(b.into, o_custkey + o_orderkey % 3)".replace(".into", '."into"').replace("AS into", 'AS "into"'))
def merged_edges(spark, d):
    return _merge(spark, d)[1]


_V = "v AS (SELECT p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) WHEN p_partkey % 3 = 1 THEN p_name END AS verified, [p_brand || ' ' || p_partkey] AS aliases FROM part), k AS (SELECT DISTINCT p_name AS wrong FROM part WHERE p_size = 1)"


@register(f"WITH {_V}, r AS (SELECT name AS wrong, verified AS \"right\" FROM v WHERE verified IS NOT NULL AND verified <> name UNION ALL SELECT aliases[1], coalesce(verified, name) FROM v WHERE aliases[1] <> coalesce(verified, name)) SELECT wrong, min(\"right\") AS \"right\" FROM r WHERE wrong NOT IN (SELECT wrong FROM k) GROUP BY 1")
def imported_corrections(spark, d):
    p, k = _t(spark, d, "part"), F.col("p_partkey") % 3
    names = p.select(F.col("p_name").alias("name"), F.when(k == 0, F.upper("p_name")).when(k == 1, F.col("p_name")).alias("verified"), F.array(F.concat_ws(" ", "p_brand", F.col("p_partkey").cast("string"))).alias("aliases"))
    return stores.imported_corrections(names, p.where("p_size = 1").select(F.col("p_name").alias("wrong")).distinct())


@register("SELECT count(*) FILTER (c_mktsegment <> 'BUILDING') AS kept, count(*) FILTER (c_mktsegment = 'BUILDING') AS removed FROM customer")
def removed_rows(spark, d):
    c = _t(spark, d, "customer")
    return stores.removed(c, c.where("c_mktsegment = 'BUILDING'"), "c_custkey")


@register("SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 'new ' || p_name ELSE p_name END AS name, CASE p_partkey % 3 WHEN 0 THEN p_brand || ',' || p_name WHEN 1 THEN p_brand || ',said ' || p_partkey ELSE p_brand END AS aliases FROM part")
def resolved_cases(spark, d):
    """Edits rename and keep the old name, approvals add an alias, denials change nothing."""
    p, k = _t(spark, d, "part"), F.col("p_partkey") % 3
    nodes = p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.array("p_brand").alias("aliases"))
    action = F.when(k == 0, "edit").when(k == 1, "approve").otherwise("deny")
    value = F.when(k == 0, F.concat(F.lit("new "), "p_name")).otherwise(F.concat(F.lit("said "), F.col("p_partkey").cast("string")))
    return stores.resolved_cases(nodes, p.select(F.col("p_partkey").alias("id"), action.alias("action"), value.alias("value"))).withColumn("aliases", F.array_join("aliases", ","))


@register("WITH l AS (SELECT lower('User' || user_id) AS name, event_type AS action, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) SELECT name, CASE WHEN action <> 'error' THEN 'N-' || event_id END AS \"into\", action = 'error' AS denied FROM l WHERE r = 1")
def learned_names(spark, d):
    e = _t(spark, d, "events")
    log = e.select(F.col("event_id").alias("at"), F.concat(F.when(F.col("event_id") % 2 == 0, "User").otherwise("user"), F.col("user_id").cast("string")).alias("name"), F.when(F.col("event_type") == "error", "deny").otherwise("approve").alias("action"), F.concat(F.lit("N-"), F.col("event_id").cast("string")).alias("into"))
    return stores.learned(log)


@register("WITH p AS (SELECT p_partkey, p_brand, p_size, p_name || ' ' || p_partkey % 40 AS own, CASE WHEN p_partkey % 4 = 0 THEN upper(p_brand) WHEN p_partkey % 4 = 1 THEN ' ' ELSE upper(p_name) || ' ' || p_partkey % 60 END AS term FROM part), reg AS (SELECT lower(own) AS k FROM p WHERE p_size <= 25 UNION SELECT lower(p_brand) FROM p WHERE p_size <= 25), f AS (SELECT lower(trim(term)) AS k, min(p_partkey) AS pos FROM p WHERE trim(term) <> '' AND lower(trim(term)) NOT IN (SELECT k FROM reg) GROUP BY 1) SELECT 'M-' || ((SELECT max(p_partkey) + 1000 FROM part WHERE p_size <= 25) + row_number() OVER (ORDER BY f.pos)) AS id, term FROM f JOIN p ON p_partkey = pos")
def added_terms(spark, d):
    """Terms that the registry has neither as a term nor as an alias, with ids counted on; some are known, some blank, some come twice."""
    p, k = _t(spark, d, "part"), F.col("p_partkey")
    word = lambda n: F.concat_ws(" ", "p_name", (k % n).cast("string"))
    reg = p.where("p_size <= 25").select(F.concat(F.lit("M-"), (k + 1000).cast("string")).alias("id"), word(40).alias("term"), F.array("p_brand").alias("aliases"))
    term = F.when(k % 4 == 0, F.upper("p_brand")).when(k % 4 == 1, " ").otherwise(F.concat_ws(" ", F.upper("p_name"), (k % 60).cast("string")))
    return stores.added_terms(reg, p.select(k.alias("pos"), term.alias("term")))


_LOG = """
WITH p AS (SELECT p_partkey AS k, p_name AS said, p_brand AS brand, p_size AS day FROM part),
one AS (SELECT k, said, day FROM p WHERE k % 7 <> 6),
two AS (SELECT k, said, day FROM one WHERE k % 3 <> 0 UNION ALL SELECT k, upper(brand), day + 1 FROM p WHERE k % 3 = 0),
three AS (SELECT * FROM two WHERE k % 5 <> 0),
four AS (SELECT * FROM three WHERE day >= 10),
six AS (SELECT k, brand AS said, day FROM p WHERE k % 11 = 0)
"""


@register(f"{_LOG} SELECT 1 AS version, * FROM one UNION ALL SELECT 2, * FROM two UNION ALL SELECT 3, * FROM three UNION ALL SELECT 4, * FROM four UNION ALL SELECT 6, * FROM six")
def corrections_log(spark, d):
    """A keyed log as of each version: put, replaced, deleted, those past their time pruned, cleared (nothing), put again."""
    p, k = _t(spark, d, "part"), F.col("k")
    rows = p.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("said"), "p_brand", F.col("p_size").alias("day"))
    kind = dict(rows.dtypes)
    log = KeyedLog(spark, f"{shared_dir(spark)}/log-{uuid.uuid4().hex}", ["k"], f"k {kind['k']}, said string, day {kind['day']}")
    log.put(rows.where(k % 7 != 6))
    log.put(rows.where(k % 3 == 0).select("k", F.upper("p_brand").alias("said"), (F.col("day") + 1).cast(kind["day"]).alias("day")))
    log.delete(rows.where(k % 5 == 0).select("k"))
    log.delete_where("day < 10")
    log.clear()
    log.put(rows.where(k % 11 == 0).select("k", F.col("p_brand").alias("said"), "day"))
    return reduce(DataFrame.unionByName, [log.read(n).select(F.lit(n).alias("version"), "k", "said", "day") for n in range(1, 7)])


@register(f"{_LOG} SELECT * FROM four")
def compacted_log(spark, d):
    """The same store compacted twice on the way; what it holds at the end."""
    p, k = _t(spark, d, "part"), F.col("k")
    rows = p.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("said"), "p_brand", F.col("p_size").alias("day"))
    kind = dict(rows.dtypes)
    log = KeyedLog(spark, f"{shared_dir(spark)}/log-{uuid.uuid4().hex}", ["k"], f"k {kind['k']}, said string, day {kind['day']}")
    log.put(rows.where(k % 7 != 6))
    log.compact()
    log.put(rows.where(k % 3 == 0).select("k", F.upper("p_brand").alias("said"), (F.col("day") + 1).cast(kind["day"]).alias("day")))
    log.delete(rows.where(k % 5 == 0).select("k"))
    log.compact()
    log.delete_where("day < 10")
    return log.read()


@register("WITH a AS (SELECT user_id, CASE arg_max(event_type, event_id) WHEN 'purchase' THEN 'approved' WHEN 'error' THEN 'flagged' ELSE 'promoted' END AS st, count(*) FILTER (event_type = 'error') AS f FROM events WHERE event_type IN ('purchase', 'error', 'signup') GROUP BY 1) SELECT c_custkey AS id, coalesce(st, 'open') AS status, 1 + coalesce(f, 0) AS n_flags FROM customer LEFT JOIN a ON user_id = c_custkey")
def review_actions(spark, d):
    e = _t(spark, d, "events")
    kind = F.when(F.col("event_type") == "purchase", "approve").when(F.col("event_type") == "error", "flag").when(F.col("event_type") == "signup", "promote").otherwise("look")
    items = _t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("open").alias("status"), F.lit(1).alias("n_flags"))
    return stores.reviewed(items, e.select(F.col("user_id").alias("id"), F.col("event_id").alias("at"), kind.alias("action")))


@register("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 1 THEN 'moved' ELSE c_name END AS title, CASE WHEN c_custkey % 3 <> 1 THEN c_mktsegment END AS place, CASE WHEN c_custkey % 3 = 1 THEN 'x' END AS more FROM customer WHERE c_custkey % 3 <> 2 UNION ALL SELECT -1 - s_suppkey, s_name, NULL, NULL FROM supplier")
def calendar_patches(spark, d):
    """Fields set, taken away by nulls, rows deleted and added."""
    c, k = _t(spark, d, "customer"), F.col("c_custkey")
    m = lambda *x: F.create_map(*x).cast("map<string,string>")
    rows = c.select(k.alias("id"), m(F.lit("title"), F.col("c_name"), F.lit("place"), F.col("c_mktsegment")).alias("fields"))
    change = F.when(k % 3 == 1, m(F.lit("title"), F.lit("moved"), F.lit("place"), F.lit(None).cast("string"), F.lit("more"), F.lit("x"))).otherwise(F.create_map().cast("map<string,string>"))
    changes = c.where(k % 3 > 0).select(k.alias("id"), change.alias("patch")).union(_t(spark, d, "supplier").select(-1 - F.col("s_suppkey"), m(F.lit("title"), F.col("s_name"))))
    got = stores.patched(rows, changes, "id")
    return got.select("id", *[F.element_at("fields", F.lit(x)).alias(x) for x in ("title", "place", "more")])


@register("WITH e AS (SELECT lower(p_name) AS k, min(p_name) AS name, arg_min(kind, p_name || kind) AS kind FROM (SELECT p_name, CASE WHEN p_size < 20 THEN 'grant' ELSE 'other' END AS kind FROM part WHERE p_size <> 7) GROUP BY 1), l AS (SELECT min(p_partkey) AS id, upper(p_name) AS name FROM part WHERE p_partkey % 4 = 0 GROUP BY 2) SELECT coalesce('L' || l.id, e.kind || '_' || substr(sha256(e.k), 1, 8)) AS id, coalesce(l.name, e.name) AS name, coalesce(e.kind, 'old') AS kind, CASE WHEN l.id IS NULL THEN 'now' ELSE 'then' END AS added_at FROM l FULL JOIN e ON lower(l.name) = e.k")
def ledger_entries(spark, d):
    """A ledger by name in any case: known entries keep id and date, submitted ones stay out."""
    p = _t(spark, d, "part")
    ledger = p.where("p_partkey % 4 = 0").groupBy(F.upper("p_name").alias("name")).agg(F.concat(F.lit("L"), F.min("p_partkey").cast("string")).alias("id")).select("id", "name", F.lit("old").alias("kind"), F.lit("then").alias("added_at"))
    entries = p.select(F.col("p_name").alias("name"), F.when(F.col("p_size") < 20, "grant").otherwise("other").alias("kind"), F.when(F.col("p_size") == 7, "submitted").otherwise("open").alias("status"))
    return stores.ledger_upserted(ledger, entries, F.lit("now"))


@register("SELECT CASE page_id % 3 WHEN 0 THEN 'draft' WHEN 1 THEN 'published' ELSE 'scheduled' END AS state, url, 'new' AS title FROM (SELECT url, min(page_id) AS page_id FROM pages GROUP BY 1) WHERE page_id % 3 > 0 OR page_id % 6 > 0 UNION ALL SELECT 'draft', url, 'old' FROM (SELECT url, min(page_id) AS page_id FROM pages GROUP BY 1) WHERE page_id % 6 = 0")
def cache_replacement(spark, d):
    """Published and scheduled posts are replaced, drafts only added."""
    p = _t(spark, d, "pages").groupBy("url").agg(F.min("page_id").alias("k"))
    state = F.when(F.col("k") % 3 == 0, "draft").when(F.col("k") % 3 == 1, "published").otherwise("scheduled")
    fresh = p.select(state.alias("state"), "url", F.lit("new").alias("title"))
    return stores.cache_merged(p.where("k % 2 = 0").select(state.alias("state"), "url", F.lit("old").alias("title")), fresh)


@register("SELECT o_orderkey AS draft_id, CASE WHEN o_orderkey % 4 = 1 THEN 'd1' WHEN o_orderkey % 4 = 2 THEN 'd0' ELSE 'd1' END AS day, 't' AS title, CASE o_orderkey % 4 WHEN 0 THEN 'inserted' WHEN 1 THEN 'updated' WHEN 2 THEN 'deleted' ELSE 'kept' END AS outcome FROM orders")
def schedule_sync(spark, d):
    """Drafts against calendar events: inserted, updated, deleted, kept."""
    k, o = F.col("o_orderkey") % 4, _t(spark, d, "orders")
    old = o.where(k > 0).select(F.col("o_orderkey").alias("draft_id"), F.when(k == 3, "d1").otherwise("d0").alias("day"), F.lit("t").alias("title"))
    return stores.synced_schedule(old, o.select(F.col("o_orderkey").alias("draft_id"), F.when(k != 2, "d1").alias("day"), F.lit("t").alias("title")))


@register("SELECT doc_id AS doc, sha256(text) AS sha, doc_id % 3 > 0 AS changed FROM documents")
def hash_sync(spark, d):
    t = _t(spark, d, "documents").select(F.col("doc_id").alias("doc"), "text")
    k = F.col("doc") % 3
    return stores.hash_sync(t.select("doc", F.when(k == 0, F.sha2("text", 256)).when(k == 1, "stale").alias("sha")), t)


@register("SELECT p_partkey AS id, contains(lower(p_name), 'an') OR p_size = 1 AS acked FROM part")
def acknowledgements(spark, d):
    p = _t(spark, d, "part").select(F.col("p_partkey").alias("id"), F.upper("p_name").alias("title"), (F.col("p_size") == 1).alias("acked"))
    return stores.acknowledged(p, "An").select("id", "acked")


@register("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 0 WHEN doc_id % 3 = 0 THEN 1 ELSE 2 END AS tier, CASE WHEN doc_id % 2 = 0 THEN 'corrected' WHEN doc_id % 3 = 0 THEN 'inscription' ELSE 'raw' END AS name FROM documents")
def source_tiers(spark, d):
    """The first of corrected, inscription and raw that a document has."""
    t = _t(spark, d, "documents").select("doc_id")
    tier = lambda cond, name: t.where(cond).withColumn("name", F.lit(name))
    return stores.tiered([tier("doc_id % 2 = 0", "corrected"), tier("doc_id % 3 = 0", "inscription"), tier("true", "raw")], "doc_id")


_LINK = "l AS (SELECT user_id AS doc, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, event_id % 3 > 0 AS has FROM events)"


@register(f"WITH {_LINK} SELECT 'links' AS way, doc, row_number() OVER (PARTITION BY doc ORDER BY event_id) AS episode, lpad(event_id::VARCHAR, 11, 'v') AS video FROM l WHERE has UNION ALL SELECT 'lines', doc, n, lpad(event_id::VARCHAR, 11, 'v') FROM l WHERE has")
def link_lists(spark, d):
    """The n-th link, or the n-th line with a link, is episode n."""
    e, k = _t(spark, d, "events"), F.col("event_id")
    line = F.when(k % 3 > 0, F.concat(F.lit("https://youtu.be/"), F.lpad(k.cast("string"), 11, "v"))).otherwise("no link here")
    lines = e.select(F.col("user_id").alias("doc"), (k * 2).alias("line_no"), line.alias("line")).union(e.select("user_id", k * 2 + 1, F.lit("# a comment")))
    p = r"youtu\.be/([A-Za-z0-9_-]{11})"
    way = lambda after, name: stores.nth_links(lines, p, after).select(F.lit(name).alias("way"), "doc", "episode", "video")
    return way(True, "links").union(way(False, "lines"))


@register("WITH RECURSIVE t AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations), r AS (SELECT conv_id, k, n, length(text) AS len, 1 AS batch FROM t WHERE k = 1 UNION ALL SELECT t.conv_id, t.k, t.n, CASE WHEN len > 0 AND len + length(text) + 1 > 900 THEN length(text) WHEN len > 0 THEN len + 1 + length(text) ELSE length(text) END, batch + (len > 0 AND len + length(text) + 1 > 900)::INT FROM r JOIN t ON t.conv_id = r.conv_id AND t.k = r.k + 1) SELECT conv_id, batch, max(len) AS n FROM r GROUP BY 1, 2 HAVING max(len) > 0")
def text_batches(spark, d):
    """Turns joined in order to batches of at most so many characters."""
    t = _t(spark, d, "conversations")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
    got = t.groupBy("conv_id").agg(texts.alias("texts")).select("conv_id", F.posexplode(stores.greedy_batches(F.col("texts"), 900)).alias("b", "x"))
    return got.select("conv_id", (F.col("b") + 1).alias("batch"), F.length("x").alias("n"))


@register("WITH s AS (SELECT 'Ann Lee' || chr(97 + p_size % 5) AS spelling, count(*) AS n FROM part GROUP BY 1), b AS (SELECT spelling, n, row_number() OVER (ORDER BY n DESC, spelling DESC) AS r FROM s), names AS (SELECT DISTINCT 'ann Lee' || chr(97 + p_size % 5) AS name FROM part) SELECT name, (SELECT spelling FROM b WHERE lower(spelling) <> lower(name) ORDER BY r LIMIT 1) AS best FROM names WHERE (SELECT count(*) FROM b) > 1")
def majority_spellings(spark, d):
    p = _t(spark, d, "part")
    letter = F.char(F.lit(97) + F.col("p_size").cast("int") % 5)
    seen = p.select(F.concat(F.lit("Ann Lee"), letter).alias("spelling"), F.lit(1).alias("n"))
    return stores.majority_spelling(p.select(F.concat(F.lit("ann Lee"), letter).alias("name")), seen)


@register("SELECT doc_id, p[len(p) - i + 1] AS line, i FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents), range(1, 4) AS t(i) WHERE i <= len(p)")
def file_tails(spark, d):
    """The last three lines of each text, from the end."""
    from pyspark.sql import Window

    lines = transcript.numbered_lines(_t(spark, d, "documents"), "doc_id", "text")
    back = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("line_no")))
    return lines.withColumn("i", back).where("i <= 3").select("doc_id", "line", "i")


@register("WITH l AS (SELECT DISTINCT line FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '(?i)error|tion\\.$')) SELECT line FROM l ORDER BY line LIMIT 12")
def error_lines(spark, d):
    """The first twelve different lines that a pattern marks."""
    lines = transcript.numbered_lines(_t(spark, d, "documents"), "doc_id", "text").select("line").distinct()
    return lines.where(F.col("line").rlike(r"(?i)error|tion\.$")).orderBy("line").limit(12)
