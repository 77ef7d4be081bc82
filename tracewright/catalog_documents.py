"""Queries over nested JSON documents, checks and reports, and the joins of the knowledge layer."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tracewright.catalog import register
from tracewright.functions.schema import schema_errors
from tracewright.functions import text as tx
from tracewright.operators import documents, patterns
from tracewright.plans.bindings import SQL, Graph
from tracewright.plans.casebook import LINES, order_lines
from tracewright.plans.materialize import shared_dir


def _t(spark, d, name):
    return Graph(spark, d).table(name)


def q(text: str) -> str:
    return f"WITH {SQL}, {text}"


@register("SELECT CAST(o_custkey % 100 AS INT) AS ep, count(*) AS n_claims, min(o_orderkey) AS first FROM orders WHERE o_custkey % 100 % 7 > 0 GROUP BY 1")
def nested_json_documents(spark, d):
    """A JSON file for each of a hundred groups of customers, some of them broken, read back by episode."""
    at = f"{shared_dir(spark)}/docs-{uuid.uuid4().hex}"
    o = _t(spark, d, "orders")
    docs = o.groupBy((F.col("o_custkey") % 100).alias("ep")).agg(F.to_json(F.struct(F.lit("x").alias("title"), F.sort_array(F.collect_list(F.struct(F.col("o_orderkey").alias("ref")))).alias("claims"))).alias("value"))
    text = F.when(F.col("ep") % 7 == 0, F.lit("{broken")).otherwise(F.col("value"))
    name = F.format_string("episode_%05d.json", F.col("ep").cast("int"))
    docs.select(text.alias("value"), name.alias("name")).repartition("name").write.partitionBy("name").text(at)
    # The folder has the file's name here; a file in it stands for the document.
    got = documents.read_documents(spark, at + "/*", "title string, claims array<struct<ref:long>>")
    return got.select("ep", F.size("claims").cast("long").alias("n_claims"), F.array_min(F.transform("claims", lambda x: x["ref"])).alias("first"))


@register("SELECT 1 AS version, 0 AS n, 'default' AS name UNION ALL SELECT 2, count(*), 'store' FROM customer")
def stores_with_defaults(spark, d):
    """A missing store gives its default document, one that is there its rows."""
    at = f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"
    schema = "version int, n long, name string"
    default = documents.read_or_default(spark, at, schema, [(1, 0, "default")])
    _t(spark, d, "customer").agg(F.lit(2).alias("version"), F.count("*").alias("n"), F.lit("store").alias("name")).write.json(at)
    return default.union(documents.read_or_default(spark, at, schema, [(1, 0, "default")]))


@register("SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'kind: required' WHEN 1 THEN 'n: not of type integer' WHEN 2 THEN 'kind: not one of the values' WHEN 3 THEN 'id: does not match' ELSE '' END AS errors FROM events")
def schema_validation(spark, d):
    """Documents against a JSON schema: required fields, types, enums, patterns."""
    rules = {"required": ["id", "kind"], "properties": {"n": {"type": "integer"}, "kind": {"enum": ["view", "click"]}, "id": {"pattern": r"^E-\d+$"}}}
    k, i = F.col("event_id") % 5, F.col("event_id").cast("string")
    text = F.concat(F.lit('{"id": "'), F.when(k == 3, "x").otherwise(F.concat(F.lit("E-"), i)), F.lit('", "n": '), F.when(k == 1, '"many"').otherwise(i), F.when(k == 0, "").otherwise(F.concat(F.lit(', "kind": "'), F.when(k == 2, "odd").otherwise("view"), F.lit('"'))), F.lit("}"))
    return _t(spark, d, "events").select("event_id", F.array_join(documents.schema_errors(text, rules), "; ").alias("errors"))


@register("WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n, max(l_partkey) AS p FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n) - 1 AS i, count(*) OVER (PARTITION BY k) AS m FROM l), e AS (SELECT k, i, 0 AS s, 'schema[lines/' || i || ']: n is required' AS e FROM r WHERE p % 5 = 0 UNION ALL SELECT k, i, 1, 'schema[lines/' || i || '/ref]: does not match ^P-\\d+$' FROM r WHERE p % 7 = 0 UNION ALL SELECT k, i, 2, 'schema[lines/' || i || '/said/1/by]: is not of type string' FROM r WHERE p % 3 = 0 UNION ALL SELECT DISTINCT k, -1, 0, 'schema[lines]: has more than 5 items' FROM r WHERE m > 5) SELECT k, string_agg(e, '; ' ORDER BY i, s) AS errors FROM e GROUP BY 1")
def nested_schema_errors(spark, d):
    """Orders with their lines as nested documents against a schema with references, lists in lists and patterns; every error has its path."""
    lines = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).agg(F.max("l_partkey").alias("p"))
    p = F.col("p").cast("string")
    said = F.concat(F.lit('[{"by": "a"}, {"by": '), F.when(F.col("p") % 3 == 0, p).otherwise('"b"'), F.lit("}]"))
    n = F.when(F.col("p") % 5 == 0, "").otherwise(F.concat(F.lit('"n": '), F.col("n").cast("string"), F.lit(", ")))
    line = F.concat(F.lit("{"), n, F.lit('"ref": "'), F.when(F.col("p") % 7 == 0, "Q-").otherwise("P-"), p, F.lit('", "said": '), said, F.lit("}"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", line.alias("line")))), lambda x: x["line"]), ", ")
    docs = lines.groupBy("k").agg(F.concat(F.lit('{"lines": ['), listed, F.lit("]}")).alias("body"))
    rules = {
        "type": "object", "required": ["lines"], "properties": {"lines": {"type": "array", "maxItems": 5, "items": {"$ref": "#/definitions/line"}}},
        "definitions": {"line": {"required": ["n"], "properties": {"n": {"type": "integer"}, "ref": {"pattern": r"^P-\d+$"}, "said": {"items": {"type": "object", "properties": {"by": {"type": "string"}}}}}}},
    }
    found = docs.select("k", schema_errors(F.col("body"), rules).alias("e")).where("size(e) > 0")
    return found.select("k", F.array_join("e", "; ").alias("errors"))


@register("SELECT o_orderkey, 'C-' || o_orderkey AS id, 'C-' || o_orderkey AS ref, CASE WHEN o_orderkey % 2 = 0 THEN 'Claim' ELSE o_orderstatus END AS type, substr(repeat('long text ', 40), 1, 240) AS label FROM orders")
def document_defaults(spark, d):
    """Identifier, reference, type and context filled in; labels taken from the text."""
    o, k = _t(spark, d, "orders"), F.col("o_orderkey")
    i = F.concat(F.lit("C-"), k.cast("string"))
    doc = F.struct(F.when(k % 3 == 0, i).otherwise("").alias("id"), F.when(k % 3 > 0, i).alias("ref"), F.when(k % 2 == 0, "").otherwise(F.col("o_orderstatus")).alias("type"), F.lit(None).cast("string").alias("context"))
    full = documents.with_defaults(doc, "Claim", "https://example.org/context")
    label = documents.synced_reference(F.lit(" "), i, F.lit(""), F.repeat(F.lit("long text "), F.lit(40)))
    return o.select("o_orderkey", full["id"].alias("id"), label["ref"].alias("ref"), full["type"].alias("type"), label["label"].alias("label"))


@register("SELECT p_partkey, '[' || p_partkey || ']' AS entities, CASE p_partkey % 3 WHEN 2 THEN '[]' ELSE '[\"' || p_brand || '\"]' END AS relations FROM part")
def normalised_extractions(spark, d):
    p, k = _t(spark, d, "part"), F.col("p_partkey")
    i, b = k.cast("string"), F.col("p_brand")
    text = F.when(k % 3 == 0, F.concat(F.lit('{"entities": ['), i, F.lit('], "relations": ["'), b, F.lit('"]}'))).when(k % 3 == 1, F.concat(F.lit('{"nodes": ['), i, F.lit('], "edges": ["'), b, F.lit('"]}'))).otherwise(F.concat(F.lit('{"data": {"entities": ['), i, F.lit("]}}")))
    x = documents.normalised_extraction(text)
    return p.select("p_partkey", x["entities"].alias("entities"), x["relations"].alias("relations"))


@register("SELECT o_orderkey, '$.a.b[0]' AS path, 'NODE_' || o_custkey AS value FROM orders UNION ALL SELECT o_orderkey, '$.c', 'CLAIM_1' FROM orders WHERE o_orderkey % 2 = 0")
def unresolved_placeholders(spark, d):
    """References at any depth of a JSON text that no identifier has replaced."""
    o, k = _t(spark, d, "orders"), F.col("o_orderkey")
    text = F.concat(F.lit('{"a": {"b": ["NODE_'), F.col("o_custkey").cast("string"), F.lit('", "x NODE_1", 7], "n": null}, "c": "'), F.when(k % 2 == 0, "CLAIM_1").otherwise("C-1"), F.lit('", "d": [[{"e": "plain"}]]}'))
    return documents.placeholders(o.select("o_orderkey", text.alias("text")), "o_orderkey", "text")


@register("SELECT o_orderkey, '{\"a\": \"N-' || o_custkey || '\", \"b\": [\"N-' || o_custkey || '\", \"x NODE_1\"]}' AS text FROM orders")
def repaired_placeholders(spark, d):
    o = _t(spark, d, "orders")
    refs = F.array(F.struct(F.lit("NODE_1").alias("ref"), F.concat(F.lit("N-"), F.col("o_custkey").cast("string")).alias("id")))
    return o.select("o_orderkey", documents.repaired(F.lit('{"a": "NODE_1", "b": ["NODE_1", "x NODE_1"]}'), refs).alias("text"))


@register(f"WITH {LINES}, r AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS i, l_linenumber, l_returnflag FROM lines) SELECT l_orderkey, 'claim' AS entity, 'A-' || l_linenumber AS ref, 'claims[' || i || ']' AS path, CASE l_returnflag WHEN 'R' THEN 'low' WHEN 'A' THEN 'high' ELSE 'medium' END AS confidence, CASE WHEN l_linenumber = 1 THEN 'unsure' END AS note FROM r WHERE l_returnflag <> 'A' OR l_linenumber = 1")
def extraction_review(spark, d):
    """Items of low or medium confidence, or with a note, and where they stand."""
    level = F.when(F.col("l_returnflag") == "R", "low").when(F.col("l_returnflag") == "A", "high").otherwise("medium")
    item = F.struct("l_linenumber", F.concat(F.lit("A-"), F.col("l_linenumber").cast("string")).alias("ref"), level.alias("confidence"), F.when(F.col("l_linenumber") == 1, " unsure ").otherwise(" ").alias("note"))
    docs = order_lines(Graph(spark, d)).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("claims"))
    return documents.review_items(docs, "l_orderkey", {"claims": "claim"})


@register(f"WITH {LINES}, r AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS i, l_linenumber, l_shipdate FROM lines) SELECT l_orderkey, CAST(i AS INT) AS place, CASE l_linenumber % 3 WHEN 0 THEN 'idea' WHEN 1 THEN 'dream' ELSE 'theme' END AS kind, substr(strftime(l_shipdate, '%Y-%m-%d') || ' note', 1, 12) AS text FROM r WHERE l_linenumber <> 5")
def extracted_notes(spark, d):
    """Notes with their kinds clamped, texts cut, blank ones dropped."""
    k = F.col("l_linenumber") % 3
    item = F.struct("l_linenumber", F.when(k == 0, " Idea").when(k == 1, "dream").otherwise("odd").alias("kind"), F.when(F.col("l_linenumber") == 5, "  ").otherwise(F.concat(F.lit(" "), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" note and more"))).alias("text"))
    docs = order_lines(Graph(spark, d)).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("notes"))
    return documents.clamped_items(docs, "l_orderkey", "notes", ["idea", "dream"], "theme", 12).withColumnRenamed("at", "place")


@register("SELECT lang, count(*) AS n, sum(length(text))::BIGINT AS size, md5(string_agg(doc_id || ' ' || sha256(text) || ' ' || length(text), ',' ORDER BY doc_id || ' ' || sha256(text) || ' ' || length(text))) AS digest FROM documents GROUP BY 1")
def bundle_manifest(spark, d):
    files = _t(spark, d, "documents").select("lang", F.col("doc_id").cast("string").alias("path"), F.sha2("text", 256).alias("sha"), F.length("text").cast("long").alias("size"))
    return documents.manifest(files, "lang").select("lang", "n", "size", F.md5(F.array_join("files", ",").cast("binary")).alias("digest"))


@register("WITH e AS (SELECT user_id, 'BEGIN:VEVENT' || chr(13) || chr(10) || 'UID:e' || event_id || chr(13) || chr(10) || 'DTSTART:' || strftime(ts, '%Y%m%dT%H%M%SZ') || chr(13) || chr(10) || 'SUMMARY:' || event_type || '\\, and' || chr(13) || chr(10) || 'END:VEVENT' AS line, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp, 'e' || event_id AS uid FROM events) SELECT user_id, md5('BEGIN:VCALENDAR' || chr(13) || chr(10) || 'VERSION:2.0' || chr(13) || chr(10) || string_agg(line, chr(13) || chr(10) ORDER BY stamp, uid) || chr(13) || chr(10) || 'END:VCALENDAR' || chr(13) || chr(10)) AS digest FROM e GROUP BY 1")
def calendar_feeds(spark, d):
    """A calendar file for each user."""
    e = _t(spark, d, "events").select("user_id", F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("uid"), F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'").alias("stamp"), tx.ical_escape(F.concat("event_type", F.lit(", and"))).alias("summary"))
    return documents.calendar_feed(e, "user_id").select("user_id", F.md5(F.col("feed").cast("binary")).alias("digest"))


@register(q("a AS (SELECT supplier, count(*) AS n FROM anchors GROUP BY 1 ORDER BY n DESC, supplier LIMIT 5), b AS (SELECT ep, count(*) AS n FROM claims GROUP BY 1), r AS (SELECT 0 AS section, row_number() OVER (ORDER BY n DESC, supplier) + 2 AS place, '| ' || supplier || ' | ' || n || ' |' AS line FROM a UNION ALL SELECT 1, row_number() OVER (ORDER BY ep) + 2, '| ' || ep || ' | ' || n || ' |' FROM b UNION ALL VALUES (0, 0, '## Convergence'), (0, 1, '| supplier | n |'), (0, 2, '| --- | --- |'), (1, 0, '## Episodes'), (1, 1, '| ep | n |'), (1, 2, '| --- | --- |')) SELECT CAST(section AS INT) AS section, CAST(place AS INT) AS place, line FROM r"))
def analysis_report(spark, d):
    """A Markdown report of two sections."""
    g = Graph(spark, d)
    busy = g.anchors.groupBy("supplier").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "supplier").limit(5)
    return documents.report([("Convergence", busy, [F.desc("n"), F.col("supplier")]), ("Episodes", g.claims.groupBy("ep").agg(F.count("*").alias("n")), [F.col("ep")])])


@register(q("x AS (SELECT 'claims without anchors' AS check_name, 'CRITICAL' AS severity, claim::VARCHAR AS item FROM claims WHERE claim NOT IN (SELECT claim FROM anchors) UNION ALL SELECT 'parts never used', 'WARN', p_partkey::VARCHAR FROM part WHERE p_partkey NOT IN (SELECT part FROM anchors) UNION ALL SELECT 'customers without claims', 'WARN', c_custkey::VARCHAR FROM customer WHERE c_custkey NOT IN (SELECT person FROM claims) UNION ALL SELECT 'claims of no customer', 'CRITICAL', claim::VARCHAR FROM claims WHERE person NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'anchors of no claim', 'CRITICAL', artifact FROM anchors WHERE claim NOT IN (SELECT claim FROM claims)), r AS (SELECT *, row_number() OVER (PARTITION BY check_name ORDER BY item) AS r FROM x) SELECT check_name, severity, count(*) AS n, string_agg(item, ',' ORDER BY item) FILTER (r <= 8) AS sample FROM r GROUP BY 1, 2"))
def validation_runner(spark, d):
    """Five checks with their severity, how many rows break each, and eight of them."""
    g = Graph(spark, d)
    c, a = g.claims, g.anchors
    row = lambda name, level, df, item: df.select(F.lit(name).alias("check_name"), F.lit(level).alias("severity"), F.col(item).cast("string").alias("item"))
    anti = documents.lacking
    found = row("claims without anchors", "CRITICAL", anti(c, a.select("claim"), "claim"), "claim")
    found = found.union(row("parts never used", "WARN", anti(g.table("part"), a.select(F.col("part").alias("p_partkey")), "p_partkey"), "p_partkey"))
    found = found.union(row("customers without claims", "WARN", anti(g.table("customer"), c.select(F.col("person").alias("c_custkey")), "c_custkey"), "c_custkey"))
    found = found.union(row("claims of no customer", "CRITICAL", anti(c, g.table("customer").select(F.col("c_custkey").alias("person")), "person"), "claim"))
    found = found.union(row("anchors of no claim", "CRITICAL", anti(a, c.select("claim"), "claim"), "artifact"))
    return documents.checked(found, 8)


@register("SELECT event_type, count(*) FILTER (value > 50) AS high, count(*) FILTER (value BETWEEN 20 AND 50) AS medium, count(*) FILTER (value < 20) AS low FROM events GROUP BY 1")
def issues_by_severity(spark, d):
    v = F.col("value")
    return _t(spark, d, "events").groupBy("event_type").agg(F.count_if(v > 50).alias("high"), F.count_if(v.between(20, 50)).alias("medium"), F.count_if(v < 20).alias("low"))


@register("SELECT 'category' AS what, event_type AS name, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'top', name, n FROM (SELECT user_id::VARCHAR AS name, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, name LIMIT 5) UNION ALL SELECT 'distinct', 'items', count(DISTINCT user_id) FROM events")
def annotation_summary(spark, d):
    """Annotations by category, the five busiest items, and how many items have any."""
    e = _t(spark, d, "events")
    kind = e.groupBy("event_type").agg(F.count("*").alias("n")).select(F.lit("category").alias("what"), F.col("event_type").alias("name"), "n")
    busy = e.groupBy(F.col("user_id").cast("string").alias("name")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name").limit(5)
    return kind.union(busy.select(F.lit("top"), "name", "n")).union(e.agg(F.count_distinct("user_id")).select(F.lit("distinct"), F.lit("items"), "*"))


@register("SELECT user_id AS item, count(*) AS n, md5(string_agg(event_type || ':' || event_id, ',' ORDER BY event_id)) AS digest FROM events GROUP BY 1")
def annotations_by_item(spark, d):
    notes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda x: F.concat_ws(":", x["event_type"], x["event_id"].cast("string"))), ",")
    return _t(spark, d, "events").groupBy(F.col("user_id").alias("item")).agg(F.count("*").alias("n"), F.md5(notes.cast("binary")).alias("digest"))


@register("SELECT gap, count(*) AS n FROM (SELECT 'document without label' AS gap, doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'label without document', doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) UNION ALL SELECT 'document without vector', doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id % 1000 FROM labels) UNION ALL SELECT 'order without line', o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT 'line without order', l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) GROUP BY 1")
def five_gaps(spark, d):
    """What each of five pairs of sets lacks."""
    g = Graph(spark, d)
    docs, labels = g.table("documents").select(F.col("doc_id").alias("k")), g.table("labels").select(F.col("doc_id").alias("k"))
    orders, lines = g.table("orders").select(F.col("o_orderkey").alias("k")), g.table("lineitem").select(F.col("l_orderkey").alias("k"))
    gaps = [("document without label", docs, labels), ("label without document", labels, docs), ("document without vector", docs, labels.select((F.col("k") % 1000).alias("k"))), ("order without line", orders, lines), ("line without order", lines, orders)]
    return documents.gap_counts(gaps, "k")


@register("SELECT source, min(nullif(CASE WHEN doc_id % 4 = 0 THEN '' ELSE lpad(doc_id::VARCHAR, 8, '0') END, '')) AS earliest, sum(len(string_split(text, chr(10))))::BIGINT AS items, count(*) AS claims FROM documents GROUP BY 1")
def source_counts(spark, d):
    """The earliest date of each source that is not blank, and its items and claims."""
    t = _t(spark, d, "documents")
    date = F.nullif(F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.lpad(F.col("doc_id").cast("string"), 8, "0")), F.lit(""))
    return t.groupBy("source").agg(F.min(date).alias("earliest"), F.sum(F.size(F.split("text", "\n"))).cast("long").alias("items"), F.count("*").alias("claims"))


# ---- joins of the knowledge layer


@register("SELECT url, CASE WHEN page_id % 3 = 0 THEN 'registry ' || page_id ELSE 'own ' || page_id END AS title FROM pages")
def link_overrides(spark, d):
    """A link's registry entry wins over its own."""
    p = _t(spark, d, "pages")
    name = lambda x: F.concat(F.lit(x), F.col("page_id").cast("string"))
    reg = p.where("page_id % 3 = 0").select("page_id", name("registry ").alias("reg"))
    return p.select("page_id", "url", name("own ").alias("own")).join(reg, "page_id", "left").select("url", F.coalesce("reg", "own").alias("title"))


@register("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY (contains(lower(text), 'tion')::INT + contains(lower(text), 'heit')::INT) DESC, doc_id DESC) AS r FROM documents WHERE contains(lower(text), 'tion') OR contains(lower(text), 'heit')) WHERE r <= 15")
def source_chunks(spark, d):
    """Chunks of each source that hold any keyword, the best fifteen."""
    low = F.lower("text")
    hits = sum((F.contains(low, F.lit(k)).cast("int") for k in ("tion", "heit")), F.lit(0))
    t = _t(spark, d, "documents").select("source", "doc_id", hits.alias("hits")).where("hits > 0")
    return patterns.top_per(t, "source", 15, F.desc("hits"), F.desc("doc_id")).select("source", "doc_id")


@register("WITH c AS (SELECT lower(p_name) AS k, max(p_size) AS age FROM part WHERE p_partkey % 2 = 0 GROUP BY 1), a AS (SELECT lower(p_brand) AS k, max(p_size) AS age FROM part WHERE p_partkey % 2 = 0 GROUP BY 1), u AS (SELECT k, max(age) AS age FROM (SELECT * FROM c UNION ALL SELECT * FROM a) GROUP BY 1) SELECT p_partkey, CASE WHEN age IS NULL THEN 'miss' WHEN age > 40 THEN 'expired' ELSE 'hit' END AS cache FROM part LEFT JOIN u ON k = lower(p_name)")
def verification_cache(spark, d):
    """Names looked up among verified names and aliases; entries over an age have expired."""
    p = _t(spark, d, "part")
    known = p.where("p_partkey % 2 = 0").select(F.explode(F.array(F.lower("p_name"), F.lower("p_brand"))).alias("k"), "p_size").groupBy("k").agg(F.max("p_size").alias("age"))
    out = p.withColumn("k", F.lower("p_name")).join(known, "k", "left")
    return out.select("p_partkey", F.when(F.col("age").isNull(), "miss").when(F.col("age") > 40, "expired").otherwise("hit").alias("cache"))


@register(q("t AS (SELECT DISTINCT artifact, supplier AS node FROM anchors WHERE supplier IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0)), s AS (SELECT DISTINCT claim, artifact FROM claims JOIN anchors USING (claim) WHERE text LIKE '%HIGH%') SELECT 'INVOLVES' AS rel, artifact AS src, node::VARCHAR AS dst FROM t UNION ALL SELECT 'SUPPORTED_BY', claim::VARCHAR, artifact FROM s"))
def conditional_edges(spark, d):
    """Edges to nodes of a label, and support edges of claims with a sensitive tag alone."""
    g = Graph(spark, d)
    nodes = g.table("supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("supplier"))
    involves = g.anchors.join(nodes, "supplier", "left_semi").select(F.lit("INVOLVES").alias("rel"), F.col("artifact").alias("src"), F.col("supplier").cast("string").alias("dst")).distinct()
    tagged = g.claims.where("text like '%HIGH%'").select("claim").join(g.anchors, "claim").select(F.lit("SUPPORTED_BY"), F.col("claim").cast("string"), "artifact").distinct()
    return involves.union(tagged)


@register("SELECT DISTINCT source, doc_id, tag FROM documents JOIN (SELECT DISTINCT source, lang AS tag FROM documents) USING (source)")
def source_tags(spark, d):
    """Every tag of a source on each of its chunks."""
    t = _t(spark, d, "documents")
    return t.select("source", "doc_id").join(t.select("source", F.col("lang").alias("tag")).distinct(), "source")


@register("WITH u AS (SELECT lower(s_name) AS name, 'organization' AS label, min(s_suppkey) AS id FROM supplier GROUP BY 1 UNION ALL SELECT lower(c_name), 'person', min(c_custkey) FROM customer GROUP BY 1 UNION ALL SELECT lower(p_name), 'topic', min(p_partkey) FROM part GROUP BY 1), r AS (SELECT DISTINCT 'Supplier#' || lpad((l_suppkey)::VARCHAR, 9, '0') AS a, p_name AS b, upper(coalesce(nullif(CASE WHEN l_linenumber % 2 = 0 THEN 'sells' ELSE '' END, ''), 'relates_to')) AS rel FROM lineitem JOIN part ON p_partkey = l_partkey) SELECT x.label AS src_label, x.id AS src, rel, y.label AS dst_label, y.id AS dst FROM r JOIN u x ON x.name = lower(a) JOIN u y ON y.name = lower(b)")
def relations_by_name(spark, d):
    """Relations between names, whatever labels bear them; a blank type is RELATES_TO."""
    g = Graph(spark, d)
    side = lambda t, name, label, i: g.table(t).groupBy(F.lower(name).alias("name")).agg(F.min(i).alias("id")).select("name", F.lit(label).alias("label"), "id")
    u = side("supplier", "s_name", "organization", "s_suppkey").union(side("customer", "c_name", "person", "c_custkey")).union(side("part", "p_name", "topic", "p_partkey"))
    kind = F.upper(F.coalesce(F.nullif(F.when(F.col("l_linenumber") % 2 == 0, "sells").otherwise(""), F.lit("")), F.lit("relates_to")))
    r = g.table("lineitem").join(g.table("part").select(F.col("p_partkey").alias("l_partkey"), F.lower("p_name").alias("b")), "l_partkey")
    r = r.select(F.lower(F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))).alias("a"), "b", kind.alias("rel")).distinct()
    src, dst = u.select(F.col("name").alias("a"), F.col("label").alias("src_label"), F.col("id").alias("src")), u.select(F.col("name").alias("b"), F.col("label").alias("dst_label"), F.col("id").alias("dst"))
    return r.join(src, "a").join(dst, "b").select("src_label", "src", "rel", "dst_label", "dst")


@register("SELECT DISTINCT 'ep' || (doc_id % 50) AS stem, a.doc_id AS raw, b.doc_id AS fixed FROM documents a JOIN (SELECT doc_id, doc_id % 50 AS k FROM documents WHERE doc_id % 100 >= 50) b ON b.k = a.doc_id % 50 WHERE a.doc_id % 100 < 50 AND a.doc_id // 100 = b.doc_id // 100".replace("(doc_id % 50)", "(a.doc_id % 50)"))
def paired_files(spark, d):
    """Raw and corrected files of one name."""
    k = F.col("doc_id")
    t = _t(spark, d, "documents").select("doc_id", F.concat(F.lit("x/ep"), (k % 50).cast("string"), F.lit(".txt")).alias("path"), F.floor(k / 100).alias("run"))
    stem = F.regexp_extract("path", r"([^/]+)\.txt$", 1)
    raw, fixed = t.where(k % 100 < 50).select("run", stem.alias("stem"), k.alias("raw")), t.where(k % 100 >= 50).select("run", stem.alias("stem"), k.alias("fixed"))
    return raw.join(fixed, ["run", "stem"]).select("stem", "raw", "fixed").distinct()


@register("SELECT canonical, string_agg(DISTINCT variant, ', ' ORDER BY variant) AS variants FROM (SELECT p_brand AS canonical, p_name AS variant FROM part) GROUP BY 1")
def glossary(spark, d):
    """Canonical terms and their variants, a line for each."""
    return _t(spark, d, "part").groupBy(F.col("p_brand").alias("canonical")).agg(patterns.joined_list("p_name", ", ").alias("variants"))


@register("SELECT user_id AS section, md5(string_agg('- ' || event_type || ' ' || event_id, chr(10) ORDER BY event_id)) AS digest, count(*) FILTER (ts < TIMESTAMP '2024-01-15') AS pruned FROM events GROUP BY 1")
def digest_sections(spark, d):
    """Sections of a digest, each a list in order, and how many jobs of each have outlived their time."""
    line = F.concat_ws(" ", F.lit("-"), "event_type", F.col("event_id").cast("string"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", line.alias("line")))), lambda x: x["line"]), "\n")
    return _t(spark, d, "events").groupBy(F.col("user_id").alias("section")).agg(F.md5(body.cast("binary")).alias("digest"), F.count_if(F.col("ts") < F.lit("2024-01-15").cast("timestamp")).alias("pruned"))


@register("SELECT kind, count(*) AS n, string_agg(url, ',' ORDER BY url) FILTER (r <= 3) AS first FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY url, page_id) AS r FROM (SELECT url, page_id, CASE page_id % 4 WHEN 0 THEN 'video' WHEN 1 THEN 'article' ELSE 'other' END AS kind FROM pages)) GROUP BY 1")
def links_by_type(spark, d):
    """A store of links grouped by their type, types outside the allowed ones as other."""
    k = F.col("page_id") % 4
    given = F.when(k == 0, "Video").when(k == 1, "article").when(k == 2, "odd")
    kind = F.when(F.lower(given).isin("video", "article"), F.lower(given)).otherwise("other")
    p = _t(spark, d, "pages").select("url", "page_id", kind.alias("kind"))
    top = patterns.top_per(p, "kind", 3, F.col("url"), F.col("page_id")).groupBy("kind").agg(F.array_join(F.array_sort(F.collect_list("url")), ",").alias("first"))
    return p.groupBy("kind").agg(F.count("*").alias("n")).join(top, "kind")
