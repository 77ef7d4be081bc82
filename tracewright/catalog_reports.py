"""Queries of the reports, bound to the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.catalog import register
from tracewright.operators import reports
from tracewright.plans.bindings import Graph


def _t(spark, d, name):
    return Graph(spark, d).table(name)


_PERSON = """
p AS (SELECT c_custkey AS person, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN [c_mktsegment, 'C' || c_custkey] ELSE [] END AS aliases, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment || ' customer' END AS description FROM customer),
e AS (SELECT o_custkey AS person, string_agg(DISTINCT year(o_orderdate)::VARCHAR, ', ' ORDER BY year(o_orderdate)::VARCHAR) AS eps FROM orders GROUP BY 1),
li AS (SELECT l_orderkey AS k, l_linenumber AS n, max(l_partkey) AS part, max(l_suppkey) AS supp, max(l_returnflag) AS flag, max(year(l_shipdate)) AS ep FROM lineitem GROUP BY 1, 2),
c AS (SELECT o_custkey AS person, o_orderkey AS pos, year(o_orderdate) AS ep, o_orderpriority AS label, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 60 || ':00' END AS time, o_orderstatus AS text, (SELECT string_agg('A-' || n, ', ' ORDER BY n) FROM li WHERE k = o_orderkey) AS anchors FROM orders),
a AS (SELECT o_custkey AS person, k * 10 + n AS pos, 'A-' || k || '.' || n AS artifact, ep, part AS text, CASE flag WHEN 'A' THEN 'high' WHEN 'R' THEN 'low' END AS confidence FROM li JOIN orders ON o_orderkey = k),
s AS (SELECT DISTINCT person, supp AS other, ep FROM (SELECT o_custkey AS person, supp, ep FROM li JOIN orders ON o_orderkey = k)),
g AS (SELECT person, other, count(*) AS n, string_agg(ep::VARCHAR, ', ' ORDER BY ep) AS eps FROM s GROUP BY 1, 2),
x AS (SELECT *, row_number() OVER (PARTITION BY person ORDER BY n DESC, other) AS pos FROM g),
x10 AS (SELECT * FROM x WHERE pos <= 10),
l AS (
  SELECT person, 0 AS section, 0 AS a, 0 AS b, '# ' || name AS line FROM p UNION ALL SELECT person, 0, 0, 1, '**ID:** ' || person FROM p
  UNION ALL SELECT person, 0, 0, 2, '**Aliases:** ' || array_to_string(aliases, ', ') FROM p WHERE len(aliases) > 0 UNION ALL SELECT person, 0, 0, 3, description FROM p WHERE description IS NOT NULL
  UNION ALL SELECT person, 0, 0, 4, '**Episodes:** ' || coalesce(eps, '') FROM p LEFT JOIN e USING (person)
  UNION ALL SELECT person, 0, 0, 5, '**Evidence:** ' || (SELECT count(*) FROM a WHERE a.person = p.person) || ' artifacts, ' || (SELECT count(*) FROM c WHERE c.person = p.person) || ' claims' FROM p
  UNION ALL SELECT person, 1, 0, 0, '## Claims (' || count(*) || ')' FROM c GROUP BY 1 UNION ALL SELECT person, 1, pos, 1, '### C-' || pos || ': ' || label FROM c
  UNION ALL SELECT person, 1, pos, 2, '**Episode ' || ep || '**' || coalesce(' (Timestamp: ' || time || ')', '') FROM c UNION ALL SELECT person, 1, pos, 3, text FROM c
  UNION ALL SELECT person, 1, pos, 4, '**Anchored Artifacts:** ' || anchors FROM c WHERE anchors IS NOT NULL
  UNION ALL SELECT person, 2, 0, 0, '## Evidence (' || count(*) || ')' FROM a GROUP BY 1 UNION ALL SELECT person, 2, pos, 1, '- **' || artifact || '** (Episode ' || ep || '): ' || text || coalesce(' [Confidence: ' || confidence || ']', '') FROM a
  UNION ALL SELECT person, 3, 0, 0, '## Connections' FROM x10 GROUP BY 1 UNION ALL SELECT person, 3, pos, 1, '- **Supplier ' || other || '** (' || other || '): ' || n || ' episodes [' || eps || ']' FROM x10
  UNION ALL SELECT person, 4, 0, 0, '## Timeline' FROM c GROUP BY 1 UNION ALL SELECT person, 4, pos, 1, '- **Episode ' || ep || coalesce(' (' || time || ')', '') || '**: ' || label || ' [C-' || pos || ']' FROM c
)
"""


@register(f"WITH {_PERSON} SELECT person, CAST(section AS INT) AS section, CAST(a AS BIGINT) AS a, CAST(b AS INT) AS b, line FROM l")
def person_reports(spark, d):
    """A file for every customer: orders are claims, line items evidence, suppliers connections."""
    k = F.col("c_custkey")
    o = _t(spark, d, "orders")
    li = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).agg(F.max("l_partkey").alias("part"), F.max("l_suppkey").alias("supp"), F.max("l_returnflag").alias("flag"), F.max(F.year("l_shipdate")).alias("ep"))
    eps = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_set(F.year("o_orderdate"))).alias("episodes"))
    none = F.array().cast("array<string>")
    people = _t(spark, d, "customer").join(eps, "c_custkey", "left").select(k.alias("person"), F.col("c_name").alias("name"), F.when(k % 3 == 0, F.array(F.col("c_mktsegment"), F.concat(F.lit("C"), k.cast("string")))).otherwise(none).alias("aliases"), F.when(k % 2 == 0, F.concat(F.col("c_mktsegment"), F.lit(" customer"))).alias("description"), F.coalesce("episodes", F.array().cast("array<int>")).alias("episodes"))
    anchors = li.groupBy("k").agg(F.transform(F.array_sort(F.collect_list("n")), lambda x: F.concat(F.lit("A-"), x.cast("string"))).alias("anchors"))
    key = F.col("o_orderkey")
    claims = o.join(anchors, key == F.col("k"), "left").select(F.col("o_custkey").alias("person"), key.alias("at"), F.concat(F.lit("C-"), key.cast("string")).alias("claim"), F.col("o_orderpriority").alias("label"), F.year("o_orderdate").alias("ep"), F.when(key % 2 == 0, F.concat((key % 60).cast("string"), F.lit(":00"))).alias("time"), F.col("o_orderstatus").alias("text"), F.coalesce("anchors", none).alias("anchors"))
    owned = li.join(o.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("person")), "k")
    level = F.when(F.col("flag") == "A", "high").when(F.col("flag") == "R", "low")
    artifacts = owned.select("person", (F.col("k") * 10 + F.col("n")).alias("at"), F.concat(F.lit("A-"), F.col("k").cast("string"), F.lit("."), F.col("n").cast("string")).alias("artifact"), "ep", F.col("part").cast("string").alias("text"), level.alias("confidence"))
    near = owned.select("person", F.col("supp").alias("other"), "ep").distinct().groupBy("person", "other").agg(F.array_sort(F.collect_list("ep")).alias("episodes"))
    return reports.person_reports(people, claims, artifacts, near.withColumn("name", F.concat(F.lit("Supplier "), F.col("other").cast("string"))))


@register("WITH f AS (SELECT year(l_shipdate) AS ep, l_suppkey * 7 AS number FROM lineitem WHERE l_linenumber = 1), c AS (SELECT DISTINCT year(o_orderdate) AS ep, CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE o_orderkey END AS number FROM orders), u AS (SELECT 'artifact' AS what, * FROM (SELECT DISTINCT * FROM f) UNION ALL SELECT 'claim', * FROM c), n AS (SELECT what || ' collision' AS kind, number::VARCHAR AS item, string_agg(ep::VARCHAR, ',' ORDER BY ep) AS episodes FROM u GROUP BY what, number HAVING count(*) > 1), s AS (SELECT DISTINCT year(o_orderdate) AS ep, c_name AS name, upper(c_name) AS verified FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_custkey % 4 = 0), w AS (SELECT 'spelling' AS kind, name || ' -> ' || verified AS item, string_agg(ep::VARCHAR, ',' ORDER BY ep) AS episodes FROM s GROUP BY name, verified HAVING name <> verified) SELECT *, (SELECT count(*) = 0 FROM n) AS in_order FROM (SELECT * FROM n UNION ALL SELECT * FROM w)")
def draft_verification(spark, d):
    """Numbers that several episodes define, and names whose verified spelling differs."""
    o, c = _t(spark, d, "orders"), _t(spark, d, "customer")
    families = _t(spark, d, "lineitem").where("l_linenumber = 1").select(F.year("l_shipdate").alias("ep"), (F.col("l_suppkey") * 7).alias("number"))
    claims = o.select(F.year("o_orderdate").alias("ep"), F.when(F.col("o_orderkey") % 50 == 0, 1).otherwise(F.col("o_orderkey")).alias("number"))
    names = o.join(c, F.col("c_custkey") == F.col("o_custkey")).select(F.year("o_orderdate").alias("ep"), F.col("c_name").alias("name"))
    spellings = c.select(F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 4 == 0, F.upper("c_name")).otherwise(F.col("c_name")).alias("verified")).distinct()
    issues, in_order = reports.draft_verification(families, claims, names, spellings)
    return issues.withColumn("in_order", F.lit(in_order))


@register("WITH prep AS (SELECT CAST(ts AS DATE) AS day, event_id AS pos, event_type AS line FROM events WHERE user_id % 5 = 0 AND day(ts) % 3 > 0), t AS (SELECT o_orderkey AS pos, DATE '2024-01-01' + CAST(o_orderkey % 40 AS INT) AS day, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS status, o_orderstatus AS description FROM orders WHERE o_orderkey % 4 > 0 AND o_orderkey % 40 < 35), b AS (SELECT coalesce(p.day, q.day) AS day, p.day IS NOT NULL AS prepared, q.day IS NOT NULL AS busy FROM (SELECT DISTINCT day FROM prep) p FULL JOIN (SELECT DISTINCT day FROM t) q ON p.day = q.day), l AS (SELECT day, 0 AS section, pos AS a, 0 AS b, line FROM prep UNION ALL SELECT day, 1, 0, 0, '---' FROM b WHERE prepared AND busy UNION ALL SELECT day, 1, 0, 1, '## To-dos' FROM b WHERE prepared AND busy UNION ALL SELECT day, 0, 0, 0, '# Daily Brief — ' || strftime(day, '%Y-%m-%d') FROM b WHERE NOT prepared UNION ALL SELECT day, 2, pos, 0, '- [' || upper(coalesce(status, 'pending')) || '] ' || description FROM t) SELECT day, CAST(section AS INT) AS section, CAST(a AS BIGINT) AS a, CAST(b AS INT) AS b, line FROM l")
def daily_briefs(spark, d):
    """Prepared lines of two days in three, and the tasks of most days below them."""
    e, o = _t(spark, d, "events"), _t(spark, d, "orders")
    k = F.col("o_orderkey")
    prep = e.where((F.col("user_id") % 5 == 0) & (F.dayofmonth("ts") % 3 > 0)).select(F.to_date("ts").alias("day"), F.col("event_id").alias("at"), F.col("event_type").alias("line"))
    tasks = o.where((k % 4 > 0) & (k % 40 < 35)).select(F.date_add(F.lit("2024-01-01").cast("date"), (k % 40).cast("int")).alias("day"), k.alias("at"), F.when(k % 3 > 0, F.col("o_orderpriority")).alias("status"), F.col("o_orderstatus").alias("description"))
    return reports.daily_brief(prep, tasks)


@register("SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN url || '/2' ELSE '' END AS drafts, CASE page_id % 4 WHEN 0 THEN 1 ELSE 0 END AS n_published, CASE page_id % 4 WHEN 1 THEN TRUE ELSE FALSE END AS refreshing FROM pages")
def cached_posts(spark, d):
    """Caches of the old form, of the new one, without the publication, and broken ones."""
    p, k, url = _t(spark, d, "pages"), F.col("page_id") % 4, F.col("url")
    post = lambda tail: F.to_json(F.struct(F.concat(url, F.lit(tail)).alias("url"), F.lit("a title").alias("title")))
    old = F.concat(F.lit('{"drafts": ['), post(""), F.lit('], "published": ['), post("/1"), F.lit("]}"))
    new = F.concat(F.lit('{"other": {"drafts": []}, "main": {"drafts": ['), post("/2"), F.lit('], "refreshing": true}}'))
    raw = F.when(k == 0, old).when(k == 1, new).when(k == 2, '{"other": {"drafts": [{"url": "u"}]}}').otherwise('{"drafts": [')
    x = reports.cached_publication(raw, "main", "main")
    return p.select("page_id", x.alias("x")).select("page_id", F.array_join("x.drafts.url", ",").alias("drafts"), F.size("x.published").alias("n_published"), "x.refreshing")
