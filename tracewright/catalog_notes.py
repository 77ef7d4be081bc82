"""Queries over the small functions: names, flags, dates, tags, outlines, addresses, stores on disk.

Each builds texts from the tables and reads them back by the function; the SQL says what went in.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tracewright.catalog import register
from tracewright.functions import media, nested, notes, predicates
from tracewright.operators import overrides
from tracewright.plans.bindings import Graph
from tracewright.plans.materialize import shared_dir
from tracewright.sources import formats


def _t(spark, d, name):
    return Graph(spark, d).table(name)


def _place(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@register("SELECT c_custkey, length(t) < 4 OR len(regexp_split_to_array(t, '\\s+')) = 1 OR regexp_matches(t, '[^\\p{L}\\s.''’-]') AS doubtful FROM (SELECT c_custkey, trim(CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN 'Ann ' || c_mktsegment WHEN 2 THEN substr(c_name, 1, 3) ELSE 'O''Neil-Béa ' || c_mktsegment END) AS t FROM customer)")
def doubtful_names(spark, d):
    k = F.col("c_custkey") % 4
    name = F.when(k == 0, F.col("c_name")).when(k == 1, F.concat(F.lit("Ann "), "c_mktsegment")).when(k == 2, F.substring("c_name", 1, 3)).otherwise(F.concat(F.lit("O'Neil-Béa "), "c_mktsegment"))
    return _t(spark, d, "customer").select("c_custkey", predicates.doubtful_name(name).alias("doubtful"))


@register("WITH p AS (SELECT p_partkey, p_name AS a, lead(p_name) OVER (ORDER BY p_partkey) AS b FROM part), w AS (SELECT *, list_distinct(regexp_split_to_array(lower(trim(a)), '\\s+')) AS x, list_distinct(regexp_split_to_array(lower(trim(b)), '\\s+')) AS y FROM p WHERE b IS NOT NULL) SELECT p_partkey, lower(a) = lower(b) OR len(list_intersect(x, y)) >= 2 OR (len(list_intersect(x, y)) = 1 AND len(x) <= 2 AND len(y) <= 2) AS similar FROM w")
def similar_names(spark, d):
    p = _t(spark, d, "part").select("p_partkey", F.col("p_name").alias("a"))
    b = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("a").alias("b"))
    return p.join(b, "p_partkey").select("p_partkey", predicates.similar_names(F.col("a"), F.col("b")).alias("similar"))


@register("SELECT event_id, CASE event_id % 6 WHEN 0 THEN TRUE WHEN 1 THEN TRUE WHEN 2 THEN FALSE WHEN 3 THEN FALSE WHEN 4 THEN TRUE ELSE FALSE END AS flag FROM events")
def truthy_flags(spark, d):
    raw = F.element_at(F.array(*[F.lit(x) for x in (" Yes", "1", "0", "maybe", "TRUE ")], F.lit(None).cast("string")), (F.col("event_id") % 6 + 1).cast("int"))
    return _t(spark, d, "events").select("event_id", predicates.truthy(raw).alias("flag"))


@register("SELECT event_id FROM events WHERE datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 IN (1, 2, 3, 7)")
def episode_filter(spark, d):
    e = _t(spark, d, "events").withColumn("ep", F.datediff(F.to_date("ts"), F.lit("2024-01-01")) + 1)
    return predicates.in_episodes(e, "3-1, 7, x", "ep").select("event_id")


@register("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'Person' WHEN 1 THEN 'Organization' WHEN 2 THEN 'Place' WHEN 3 THEN 'InvestigationTarget' ELSE CASE WHEN p_partkey >= 1000 THEN 'InvestigationTarget' ELSE 'Person' END END AS label FROM part")
def node_labels(spark, d):
    declared = F.element_at(F.array(*[F.lit(x) for x in ("person", "Institution", " Place", "Investigation Target", "??")]), (F.col("p_partkey") % 5 + 1).cast("int"))
    return _t(spark, d, "part").select("p_partkey", predicates.node_label(declared, F.col("p_partkey")).alias("label"))


@register("SELECT doc_id, len(regexp_extract_all(text, 'the')) - len(regexp_extract_all(text, 'the(?i:a|er)')) AS n_guarded, len(regexp_extract_all(text, 'the(?:[\\s\\pP\\pS]|$)')) AS n_bounded FROM documents")
def literal_guards(spark, d):
    n = lambda p: F.regexp_count("text", F.lit(p)).cast("long")
    return _t(spark, d, "documents").select("doc_id", n(overrides.literal_pattern("the", ("a", "er"))).alias("n_guarded"), n(overrides.literal_pattern("the", (), True)).alias("n_bounded"))


@register(r"SELECT doc_id, len(x) AS n, list_sum(list_transform(x, lambda y: length(y)))::BIGINT AS total, md5(array_to_string(x, '|')) AS digest FROM (SELECT doc_id, regexp_extract_all(text, '(?s)(.{1,60}(?:\n|\z)|.{1,60})') AS x FROM documents)")
def long_text_pieces(spark, d):
    x = notes.split_long(F.col("text"), 60)
    total = F.aggregate(x, F.lit(0).cast("long"), lambda a, y: a + F.length(y))
    return _t(spark, d, "documents").select("doc_id", F.size(x).cast("long").alias("n"), total.alias("total"), F.md5(F.array_join(x, "|").cast("binary")).alias("digest"))


@register("WITH i AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN 'A-' || l_orderkey WHEN 1 THEN 'A-' || l_orderkey || '.' || l_linenumber ELSE 'odd ' || l_orderkey END AS id FROM lineitem) SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY CASE WHEN l_linenumber % 3 = 2 THEN 1000000000 ELSE l_orderkey END, CASE l_linenumber % 3 WHEN 0 THEN -1 WHEN 1 THEN l_linenumber ELSE 1000000000 END, l_linenumber, id, l_orderkey) - 1 AS place FROM i")
def id_order(spark, d):
    """Identifiers in the order of their numbers, those of another form last."""
    from tracewright.plans.ranks import global_rank

    k = F.col("l_linenumber") % 3
    key = F.col("l_orderkey").cast("string")
    ids = F.when(k == 0, F.concat(F.lit("A-"), key)).when(k == 1, F.concat(F.lit("A-"), key, F.lit("."), F.col("l_linenumber").cast("string"))).otherwise(F.concat(F.lit("odd "), key))
    rows = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", predicates.id_sort_key(ids, F.col("l_linenumber")).alias("key"))
    return global_rank(rows, "key", "l_orderkey", "l_linenumber", name="place").select("l_orderkey", "l_linenumber", "place")


@register("SELECT o_orderkey, replace(replace(t, 'low', 'high'), 'high', 'HIGH') AS text, (contains(t, 'low')::INT + contains(replace(t, 'low', 'high'), 'high')::INT) AS applied FROM (SELECT o_orderkey, lower(o_orderpriority) AS t FROM orders)")
def queued_rules(spark, d):
    """Each document's own rules in order of priority: the second sees what the first wrote."""
    o = _t(spark, d, "orders").select("o_orderkey", F.lower("o_orderpriority").alias("text"))
    rules = o.select("o_orderkey", F.explode(F.array(F.struct(F.lit(2).alias("priority"), F.lit("high").alias("find"), F.lit("HIGH").alias("put")), F.struct(F.lit(1).alias("priority"), F.lit("low").alias("find"), F.lit("high").alias("put")))).alias("r")).select("o_orderkey", "r.*")
    return overrides.apply_by_document(o, rules, "o_orderkey", "text")


_FILL = r"(?i)\b(uh|um|erm|er|ah|hmm|hm|like)\b"


@register(f"SELECT conv_id, turn, len(regexp_extract_all(t, '{_FILL}')) AS n, trim(regexp_replace(regexp_replace(t, '{_FILL},?', '', 'g'), '\\s+', ' ', 'g')) AS clean FROM (SELECT conv_id, turn, 'um, ' || a || ' so Uh  ' || a || ' like end' AS t FROM (SELECT conv_id, turn, regexp_replace(text, '[^ -~]', '', 'g') AS a FROM conversations))")
def filler_words(spark, d):
    a = F.regexp_replace("text", "[^ -~]", "")  # DuckDB knows word ends of ASCII only
    text = F.concat(F.lit("um, "), a, F.lit(" so Uh  "), a, F.lit(" like end"))
    return _t(spark, d, "conversations").select("conv_id", "turn", notes.filler_count(text).cast("long").alias("n"), notes.without_fillers(text).alias("clean"))


@register("SELECT event_id, event_id AS k, event_type AS name FROM events")
def recovered_objects(spark, d):
    said = F.concat(F.lit('<think>{"k": 0}</think>Here: ```json\n{“k”: '), F.col("event_id").cast("string"), F.lit(', "name": "'), "event_type", F.lit('"}\n``` bye'))
    return _t(spark, d, "events").select("event_id", nested.recovered_json(said, "k long, name string").alias("x")).select("event_id", "x.k", "x.name")


_OUTLINE = "o AS (SELECT conv_id AS doc_id, CAST(turn AS INT) AS line_no, CAST(CASE WHEN turn = 0 THEN 0 ELSE turn % 3 END AS INT) AS depth, CASE turn % 4 WHEN 1 THEN 'TODO' WHEN 3 THEN 'DONE' END AS marker, 'see ' || role || ' and more #' || role AS text FROM conversations)"


def _outline(spark, d):
    t, turn = _t(spark, d, "conversations"), F.col("turn")
    depth = F.when(turn == 0, 0).otherwise((turn % 3).cast("int"))
    marker = F.when(turn % 4 == 1, "TODO ").when(turn % 4 == 3, "DONE ").otherwise("")
    line = F.concat(F.repeat(F.lit("\t"), depth), F.lit("- "), marker, F.lit("see [["), "role", F.lit("]] and more #"), "role")
    return t.select(F.col("conv_id").alias("doc_id"), turn.cast("int").alias("line_no"), line.alias("line"))


@register(f"WITH {_OUTLINE} SELECT doc_id, line_no, depth, marker, text, (SELECT min(b.line_no) FROM o b WHERE b.doc_id = o.doc_id AND b.line_no > o.line_no AND b.depth <= o.depth) AS end_no FROM o")
def outline_blocks(spark, d):
    """Depth, marker and cleaned text of outline lines, and where the children of each end."""
    blocks = notes.subtree_ends(notes.outline(_outline(spark, d)))
    return blocks.select("doc_id", "line_no", "depth", "marker", notes.clean_block(F.col("text")).alias("text"), "end_no")


@register("SELECT conv_id AS doc_id, CAST(turn AS INT) AS line_no, role AS tags, role AS pages, role AS both FROM conversations")
def outline_tags(spark, d):
    x = F.col("line")
    joined = lambda c: F.array_join(c, ",")
    return _outline(spark, d).select("doc_id", "line_no", joined(notes.tags(x)).alias("tags"), joined(notes.page_refs(x)).alias("pages"), joined(notes.tags_and_pages(x)).alias("both"))


@register("SELECT page_id, url, 'https://www.youtube.com/watch?v=' || v || CASE WHEN page_id % 3 > 0 THEN '&t=' || page_id % 3 || 's' ELSE '' END AS watch, 'https://www.youtube.com/embed/' || v || CASE WHEN page_id % 3 > 0 THEN '?start=' || page_id % 3 || '&autoplay=0' ELSE '?autoplay=0' END AS embed FROM (SELECT page_id, rtrim(url, ').,;:!?]') AS url, lpad(page_id::VARCHAR, 11, '_') AS v FROM pages)")
def media_links(spark, d):
    """The first address of a text, and the addresses of a video at a time, from its identifier in another address."""
    p = _t(spark, d, "pages")
    said = F.concat(F.lit("see ("), "url", F.lit("). or https://other.example/x"))
    video = notes.video_id(F.concat(F.lit("https://youtu.be/"), F.lpad(F.col("page_id").cast("string"), 11, "_"), F.lit("?x")))
    t = F.col("page_id") % 3
    return p.select("page_id", notes.first_url(said).alias("url"), media.watch_url(video, t).alias("watch"), media.embed_url(video, t).alias("embed"))


@register("SELECT o_orderkey, CASE o_orderkey % 6 WHEN 5 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS deadline, CASE o_orderkey % 6 WHEN 5 THEN 'no date in this' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS kept FROM orders")
def deadlines(spark, d):
    """Dates written in five ways; what holds none stays as it is."""
    at = lambda f: F.date_format("o_orderdate", f)
    k = F.col("o_orderkey") % 6
    said = F.when(k == 0, F.concat(F.lit("due "), at("yyyy-MM-dd"), F.lit(" soon"))).when(k == 1, F.concat(F.lit("on "), at("M/d/yyyy"))).when(k == 2, F.concat(F.lit("Deadline: "), at("d MMMM yyyy"))).when(k == 3, F.concat(F.lit("until "), at("MMMM d, yyyy"))).when(k == 4, F.concat(F.lit("x "), at("MMM d, yyyy"))).otherwise("no date in this")
    found = notes.deadline(said)
    return _t(spark, d, "orders").select("o_orderkey", found.alias("deadline"), F.coalesce(found, said).alias("kept"))


@register("SELECT event_id, strftime(ts, '%Y%m%dT%H%M00Z') AS stamp, CASE WHEN extract(hour FROM ts) < 20 THEN CAST(floor((20 * 3600 - (extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60 + floor(extract(second FROM ts)))) / 60) AS BIGINT) END AS minutes, datediff('day', CAST(ts AS DATE), DATE '2024-02-01') > 14 AS expired FROM events")
def event_times(spark, d):
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm'Z'")
    return _t(spark, d, "events").select("event_id", notes.ical_stamp(at).alias("stamp"), notes.minutes_until(F.lit("20:00"), F.date_trunc("second", "ts")).alias("minutes"), notes.expired(F.to_date("ts"), F.lit("2024-02-01").cast("date"), 14).alias("expired"))


@register("SELECT conv_id, turn, turn * 400 AS seconds, turn * 400 AS strict, printf(CASE WHEN turn * 400 >= 3600 THEN '%02d:%02d:%02d' ELSE '%02d:%02d' END, CASE WHEN turn * 400 >= 3600 THEN turn * 400 // 3600 ELSE turn * 400 % 3600 // 60 END, CASE WHEN turn * 400 >= 3600 THEN turn * 400 % 3600 // 60 ELSE turn * 400 % 60 END, turn * 400 % 60) AS clock, trim(regexp_replace(text, '\\n.*', '', 's')) AS body FROM conversations")
def cue_lines(spark, d):
    """Lines with a cue: its seconds, the clock again, and what follows."""
    clock = media.padded_clock(F.col("turn") * 400)
    first = F.regexp_replace("text", r"(?s)\n.*", "")
    t = _t(spark, d, "conversations").select("conv_id", "turn", clock.alias("clock"), F.concat(F.lit("["), clock, F.lit("] "), first).alias("line"))
    return t.select("conv_id", "turn", media.cue_seconds(F.col("line")).alias("seconds"), media.strict_seconds(F.col("clock")).alias("strict"), "clock", media.line_body(F.col("line")).alias("body"))


@register("SELECT o_orderkey, [o_clerk, o_orderpriority] AS listed FROM (SELECT o_orderkey, 'c' || o_custkey AS o_clerk, o_orderpriority FROM orders)")
def scalar_or_list(spark, d):
    """A list as JSON text, or a lone value, always as a list."""
    clerk, other = F.concat(F.lit("c"), F.col("o_custkey").cast("string")), F.col("o_orderpriority")
    raw = F.to_json(F.array(clerk, other))
    return _t(spark, d, "orders").select("o_orderkey", F.concat(F.slice(nested.as_list(raw), 1, 1), nested.as_list(F.concat(F.lit(" "), other))).alias("listed"))


@register("SELECT p_partkey, p_name AS title, p_brand AS brand, p_type AS kind, NULL::VARCHAR AS gone FROM part")
def front_matter_maps(spark, d):
    """Front matter as a map, merged with new values; a null takes its key away."""
    text = F.concat(F.lit("---\ntitle: "), "p_name", F.lit("\nbrand:  "), "p_brand", F.lit(" \ngone: yes\n---\nbody: no"))
    new = F.create_map(F.lit("kind"), F.col("p_type"), F.lit("gone"), F.lit(None).cast("string"))
    m = nested.merged_metadata(nested.front_matter(text), new)
    at = lambda k: F.element_at(m, F.lit(k)).alias(k)
    return _t(spark, d, "part").select("p_partkey", at("title"), at("brand"), at("kind"), at("gone"))


@register("SELECT event_id, user_id, event_type FROM events UNION ALL SELECT -c_custkey, c_custkey, c_name FROM customer")
def jsonl_round_trip(spark, d):
    """Rows appended to a JSON-lines store and read back."""
    at = _place(spark, "jsonl")
    formats.write_jsonl(_t(spark, d, "events").select("event_id", "user_id", "event_type"), at)
    formats.write_jsonl(_t(spark, d, "customer").select((-F.col("c_custkey")).alias("event_id"), F.col("c_custkey").alias("user_id"), F.col("c_name").alias("event_type")), at)
    return formats.read_jsonl(spark, at, "event_id long, user_id long, event_type string")


@register("SELECT p_partkey, p_name, p_size FROM part")
def csv_round_trip(spark, d):
    at = _place(spark, "csv")
    _t(spark, d, "part").select("p_partkey", "p_name", "p_size").write.option("header", True).csv(at)
    return formats.read_csv(spark, at, "p_partkey long, p_name string, p_size " + dict(_t(spark, d, "part").dtypes)["p_size"])


@register("SELECT doc_id, 'c' || doc_id || '-' || n_chars AS file_key, doc_id AS first, n_chars AS last, 'replace' AS op, 'h-a-' || doc_id || '__3' AS dom FROM documents")
def hunk_keys(spark, d):
    i, n = F.col("doc_id").cast("string"), F.col("n_chars").cast("string")
    key = F.concat(F.lit("ep__c"), i, F.lit("-"), n, F.lit("__replace__x"))
    x = media.hunk_key(key)
    return _t(spark, d, "documents").select("doc_id", F.concat(F.lit("c"), i, F.lit("-"), n).alias("file_key"), x["first"].cast("long").alias("first"), x["last"].cast(dict(_t(spark, d, "documents").dtypes)["n_chars"]).alias("last"), x["op"].alias("op"), media.dom_id(F.concat(F.lit("a "), i), F.lit(3)).alias("dom"))


@register("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') ELSE strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%d') END AS day FROM orders")
def note_dates(spark, d):
    """A journal's date is its name, else a property, else the day of its change."""
    o = _t(spark, d, "orders")
    k, at = F.col("o_orderkey") % 3, F.col("o_orderdate").cast("date")
    day = lambda n, f: F.date_format(F.date_add(at, n), f)
    kind, stem = F.when(k == 0, "journal").otherwise("page"), F.when(k == 0, day(0, "yyyy_MM_dd")).otherwise("Some page")
    props = F.when(k == 1, F.create_map(F.lit("title"), F.lit("x"), F.lit("created"), F.concat(day(1, "yyyy-MM-dd"), F.lit("T12:00:00")))).otherwise(F.create_map(F.lit("title"), F.lit("x")))
    return o.select("o_orderkey", media.note_date(kind, stem, props, F.date_add(at, 2)).alias("day"))


@register("SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'book' WHEN 1 THEN 'transcript' WHEN 2 THEN 'notes' WHEN 3 THEN 'report' ELSE 'document' END AS kind FROM pages")
def source_types(spark, d):
    path = F.element_at(F.array(*[F.lit(x) for x in ("a/book/x.md", "A/Transcripts/x.md", "b/notes/y.md", "b/Report_1.md", "c/z.md")]), (F.col("page_id") % 5 + 1).cast("int"))
    return _t(spark, d, "pages").select("page_id", media.source_type(path).alias("kind"))


@register("SELECT event_id, event_type AS name, 'user ' || user_id AS rest, [event_type, 'x'] AS suffixes, event_id % 4 <> 3 AS bypass FROM events")
def chat_commands(spark, d):
    """Command and rest of a message, a list of suffixes, and which characters a guard lets pass."""
    e = _t(spark, d, "events")
    x = media.command(F.concat(F.lit(" /"), F.upper("event_type"), F.lit("@bot  user "), F.col("user_id").cast("string")))
    char = F.element_at(F.array(*[F.lit(c) for c in (" z", "$", "’", "a")]), (F.col("event_id") % 4 + 1).cast("int"))
    return e.select("event_id", x["name"].alias("name"), x["rest"].alias("rest"), media.suffix_list(F.concat_ws(",", "event_type", F.lit(" , x "), F.lit(""))).alias("suffixes"), media.bypasses_guard(char).alias("bypass"))


@register("SELECT conv_id % 50 AS k, count(*) AS n_lines, sum(length(text))::BIGINT AS n_chars FROM conversations GROUP BY 1")
def text_files(spark, d):
    """Turns written as lines of text files, and the files read whole with their path."""
    at = _place(spark, "texts")
    t = _t(spark, d, "conversations").select((F.col("conv_id") % 50).alias("k"), F.replace("text", F.lit("\n"), F.lit(" ")).alias("value"))
    t.repartition("k").write.partitionBy("k").text(at)
    got = formats.read_texts(spark, at + "/*")
    lines = F.size(F.split("text", "\n")) - 1  # every line is ended
    return got.select(F.regexp_extract("path", "k=([^/]*)/", 1).cast("long").alias("k"), lines.cast("long").alias("n"), (F.length("text") - lines).cast("long").alias("c")).groupBy("k").agg(F.sum("n").alias("n_lines"), F.sum("c").alias("n_chars"))
