"""Timed-text, correction, scanning, chunking and retrieval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.catalog import register
from tracewright.functions import predicates
from tracewright.functions import text as tx
from tracewright.operators import patterns, transcript
from tracewright.plans.bindings import Graph

#: Literal corrections, in order, and regular expressions, in order.
FIXES = [("the ", "THE "), ("THE ti", "the-ti"), ("and", "&")]
RULES = [(r"[ ]+", " "), (r"([a-z])\1\1+", "<run>"), (r"\.\.+", ".")]
PATTERNS = [("caps_bang", "[A-Z]{3,}!!"), ("number", "[0-9]+"), ("mail", "[a-z0-9.]+@[a-z0-9.]+"), ("table", " \\| "), ("quote", "\"[^\"]*\"")]
STOP = ["the", "and", "of", "that", "was", "for"]


def _docs(spark, d):
    return Graph(spark, d).table("documents")


def _turns(spark, d):
    return Graph(spark, d).table("conversations")


_REPLACED = "replace(replace(replace(text, 'the ', 'THE '), 'THE ti', 'the-ti'), 'and', '&')"


@register(f"SELECT doc_id, md5({_REPLACED}) AS digest, length({_REPLACED}) AS n FROM documents")
def dictionary_fold(spark, d):
    t = tx.fold_replace(F.col("text"), FIXES)
    return _docs(spark, d).select("doc_id", F.md5(t.cast("binary")).alias("digest"), F.length(t).cast("long").alias("n"))


@register("SELECT doc_id, length(regexp_replace(regexp_replace(text, '[ ]+', ' ', 'g'), '\\.\\.+', '.', 'g')) AS n FROM documents")
def regex_rule_pass(spark, d):
    return _docs(spark, d).select("doc_id", F.length(tx.fold_regex(F.col("text"), [RULES[0], RULES[2]])).cast("long").alias("n"))


@register("SELECT doc_id, CAST((length(text) - length(replace(text, 'tion', ''))) / 4 AS BIGINT) AS n FROM documents WHERE contains(text, 'tion')")
def override_occurrences(spark, d):
    return _docs(spark, d).where(F.contains("text", F.lit("tion"))).select("doc_id", tx.occurrences(F.col("text"), "tion").alias("n"))


@register("WITH s AS (SELECT doc_id, text, string_split(text, 'tion') AS p FROM documents) SELECT doc_id, md5(CASE WHEN len(p) > 3 THEN array_to_string(p[1:3], 'tion') || '<3>' || array_to_string(p[4:], 'tion') ELSE text END) AS digest FROM s")
def nth_replace(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(tx.nth_replace(F.col("text"), "tion", "<3>", 2).cast("binary")).alias("digest"))


_HITS = " UNION ALL ".join(f"SELECT doc_id, '{n}' AS pattern, len(regexp_extract_all(text, '{p}')) AS n FROM documents" for n, p in PATTERNS)


@register(f"SELECT doc_id, pattern, n FROM ({_HITS}) WHERE n > 0")
def suspicious_scan(spark, d):
    return transcript.pattern_hits(_docs(spark, d), "doc_id", "text", PATTERNS)


@register(f"SELECT pattern, count(*) AS n_docs, sum(n)::BIGINT AS hits FROM ({_HITS}) WHERE n > 0 GROUP BY 1")
def relation_hits(spark, d):
    return suspicious_scan(spark, d).groupBy("pattern").agg(F.count("*").alias("n_docs"), F.sum("n").alias("hits"))


@register("SELECT doc_id FROM documents WHERE regexp_matches(text, '[A-Z]{3,}!!') OR regexp_matches(text, '[a-z0-9.]+@[a-z0-9.]+')")
def forbidden_scan(spark, d):
    return _docs(spark, d).where(F.col("text").rlike(PATTERNS[0][1]) | F.col("text").rlike(PATTERNS[2][1])).select("doc_id")


@register("SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) GROUP BY 1 HAVING count(*) >= 3")
def word_frequency(spark, d):
    return transcript.word_frequency(_docs(spark, d), "text", 3)


@register("SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) GROUP BY 1 ORDER BY n DESC, word LIMIT 50")
def top_words(spark, d):
    return patterns.top(transcript.word_frequency(_docs(spark, d), "text"), 50, F.desc("n"), F.col("word"))


@register("WITH w AS (SELECT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS word FROM documents), c AS (SELECT word, count(*) AS n, length(regexp_replace(word, '[^A-Z]', '', 'g')) / length(word)::DOUBLE AS r FROM w WHERE length(word) >= 4 GROUP BY 1) SELECT word, n, round(abs(r - 0.5) * 2, 6) AS score FROM c WHERE NOT r BETWEEN 0.25 AND 0.75 AND abs(r - 0.5) * 2 > 0.7 ORDER BY score DESC, n DESC, word LIMIT 100")
def mixed_case(spark, d):
    """The hundred words of the most one-sided letter case."""
    w = _docs(spark, d).select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{4,}"), 0)).alias("word"))
    c = w.groupBy("word").agg(F.count("*").alias("n")).withColumn("score", F.round(predicates.case_anomaly(F.col("word")), 6))
    return patterns.top(c.where("score > 0.7"), 100, F.desc("score"), F.desc("n"), F.col("word"))


_SEGS = "l AS (SELECT doc_id, unnest(range(1, len(p) + 1)) - 1 AS line_no, unnest(p) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)), m AS (SELECT *, sum((length(line) < 40)::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS seg FROM l)"


@register(f"WITH {_SEGS} SELECT doc_id, CAST(seg AS BIGINT) AS seg, CAST(min(line_no) AS INT) AS first, count(*) AS n_lines, md5(string_agg(line, ' ' ORDER BY line_no)) AS digest FROM m GROUP BY 1, 2")
def segment_transcript(spark, d):
    lines = transcript.numbered_lines(_docs(spark, d), "doc_id", "text")
    got = transcript.segments(lines, "doc_id", "line_no", "line", F.length("line") < 40)
    return got.select("doc_id", "seg", "first", "n_lines", F.md5(F.col("body").cast("binary")).alias("digest"))


@register("WITH m AS (SELECT conv_id, turn, role, (role IS DISTINCT FROM lag(role) OVER w OR row_number() OVER w = 1)::INT AS c FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), i AS (SELECT *, sum(c) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS island FROM m) SELECT conv_id, CAST(island AS BIGINT) AS island, any_value(role) AS role, min(turn) AS first, max(turn) AS last, count(*) AS n FROM i GROUP BY 1, 2")
def ts_islands(spark, d):
    return transcript.islands(_turns(spark, d), "conv_id", "turn", "role")


_OFF = "o AS (SELECT conv_id, turn, coalesce(sum(length(text) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lo, length(text) AS n FROM conversations)"


@register(f"WITH {_OFF} SELECT conv_id, turn, lo, lo + n AS hi FROM o")
def flow_offsets(spark, d):
    return transcript.offsets(_turns(spark, d), "conv_id", "turn", "text").select("conv_id", "turn", "lo", "hi")


@register("WITH s AS (SELECT doc_id, text, unnest(range(0, greatest(length(text) - 600, 1), 3000)) AS lo FROM documents) SELECT doc_id, CAST(lo AS INT) AS lo, length(substr(text, lo + 1, 3600)) AS n FROM s")
def flow_chunks(spark, d):
    got = transcript.sliding_chunks(_docs(spark, d), "doc_id", "text")
    return got.select("doc_id", "lo", F.length("chunk").cast("long").alias("n"))


@register("SELECT conv_id, turn, substr(lag(text) OVER w, 1, 40) AS prev_text, substr(lead(text) OVER w, 1, 40) AS next_text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def prev_next(spark, d):
    return transcript.neighbours(_turns(spark, d), "conv_id", "turn", "text", 40).select("conv_id", "turn", "prev_text", "next_text")


@register("SELECT e.event_id, (SELECT p.event_id FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts < e.ts ORDER BY p.ts DESC, p.event_id DESC LIMIT 1) AS caption FROM events e WHERE e.event_type = 'error'")
def caption_asof(spark, d):
    e = Graph(spark, d).table("events")
    captions = e.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("caption"))
    got = transcript.asof_backward(e.where("event_type = 'error'").select("event_id", "user_id", "ts"), captions, "user_id", "ts", "caption")
    return got.select("event_id", "caption")


_SPANS = f"{_OFF}, s AS (SELECT conv_id, turn, lo, lo + n AS hi FROM o), b AS (SELECT conv_id, unnest(range(0, max(hi), 500)) AS b_lo FROM s GROUP BY conv_id)"


def _spans(spark, d):
    s = flow_offsets(spark, d)
    b = s.groupBy("conv_id").agg(F.max("hi").alias("m")).where("m > 0").select("conv_id", F.explode(F.expr("sequence(0L, m - 1, 500L)")).alias("lo"))
    return s, b.withColumn("hi", F.col("lo") + 500)


@register(f"WITH {_SPANS} SELECT b.conv_id, b_lo AS lo, min(turn) AS first_turn, max(turn) AS last_turn, count(*) AS n FROM b JOIN s ON s.conv_id = b.conv_id AND s.lo < b_lo + 500 AND s.hi > b_lo GROUP BY 1, 2")
def span_overlap(spark, d):
    s, b = _spans(spark, d)
    got = transcript.overlapping(b, s.withColumnRenamed("turn", "of"), "conv_id").join(s.select("conv_id", "turn", F.col("lo").alias("seg_lo"), F.col("hi").alias("seg_hi")), ["conv_id", "seg_lo", "seg_hi"])
    return got.groupBy("conv_id", "lo").agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.count("*").alias("n"))


@register(f"WITH {_OFF}, s AS (SELECT conv_id, lo - (lo % 700) AS lo, lo + n AS hi FROM o) SELECT conv_id, lo, hi FROM s WHERE NOT EXISTS (SELECT 1 FROM s t WHERE t.conv_id = s.conv_id AND t.lo <= s.lo AND t.hi >= s.hi AND t.hi - t.lo > s.hi - s.lo)")
def span_containment(spark, d):
    s = flow_offsets(spark, d).select("conv_id", (F.col("lo") - F.col("lo") % 700).alias("lo"), "hi")
    return transcript.outermost(s, "conv_id")


_FIXED = "fixed AS (SELECT conv_id, turn, replace(text, 'tion', 'cion') AS text FROM conversations WHERE role <> 'system' UNION ALL SELECT conv_id, max(turn) + 1, 'end' FROM conversations GROUP BY 1)"


@register(f"WITH {_FIXED} SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.turn, b.turn) AS turn, CASE WHEN b.turn IS NULL THEN 'delete' WHEN a.turn IS NULL THEN 'insert' WHEN a.text <> b.text THEN 'replace' ELSE 'same' END AS op FROM conversations a FULL JOIN fixed b ON a.conv_id = b.conv_id AND a.turn = b.turn")
def transcript_align_hunks(spark, d):
    t = _turns(spark, d).select("conv_id", "turn", "role", "text")
    fixed = t.where("role <> 'system'").select("conv_id", "turn", F.replace("text", F.lit("tion"), F.lit("cion")).alias("text"))
    fixed = fixed.union(t.groupBy("conv_id").agg((F.max("turn") + 1).alias("turn"), F.lit("end").alias("text")))
    return transcript.aligned_hunks(t, fixed, ["conv_id", "turn"], "text").select("conv_id", "turn", "op")


@register("SELECT conv_id, turn, printf('%d:%02d', (turn * 30) // 60, (turn * 30) % 60) AS label, turn * 30 AS seconds FROM conversations")
def clock_labels(spark, d):
    label = tx.clock_text(F.col("turn") * 30)
    t = _turns(spark, d).select("conv_id", "turn", label.alias("label"))
    return t.withColumn("seconds", tx.clock_seconds(F.col("label")).cast("long"))


@register("WITH k AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[a-zA-Z]{3,}'), lambda x: lower(x)), lambda x: NOT list_contains(['the', 'and', 'of', 'that', 'was', 'for'], x))[1:10] AS k FROM documents) SELECT doc_id, array_to_string(k, ' ') AS keywords FROM k")
def keyword_extract(spark, d):
    return _docs(spark, d).select("doc_id", F.array_join(tx.keywords(F.col("text"), STOP), " ").alias("keywords"))


@register("SELECT doc_id, (contains(lower(text), 'stion')::INT + contains(lower(text), 'which')::INT + contains(lower(text), 'tiing')::INT) AS hits FROM documents WHERE contains(lower(text), 'stion') OR contains(lower(text), 'which') OR contains(lower(text), 'tiing') ORDER BY hits DESC, doc_id LIMIT 15")
def keyword_retrieve(spark, d):
    low = F.lower("text")
    hits = sum((F.contains(low, F.lit(k)).cast("int") for k in ("stion", "which", "tiing")), F.lit(0))
    return patterns.top(_docs(spark, d).select("doc_id", hits.alias("hits")).where("hits > 0"), 15, F.desc("hits"), F.col("doc_id"))


@register("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS r FROM documents) WHERE r <= 8")
def newest_chunks(spark, d):
    return patterns.top_per(_docs(spark, d).select("source", "doc_id"), "source", 8, F.desc("doc_id")).select("source", "doc_id")


@register(f"WITH {_SEGS.split(', m AS')[0]}, h AS (SELECT doc_id, line_no, line, last_value(CASE WHEN length(line) < 60 THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS heading FROM l) SELECT doc_id, heading, count(*) AS n FROM h WHERE length(line) > 20 GROUP BY 1, 2")
def md_chunks(spark, d):
    lines = transcript.numbered_lines(_docs(spark, d), "doc_id", "text")
    got = transcript.heading_chunks(lines, "doc_id", "line_no", "line", F.when(F.length("line") < 60, F.col("line")))
    return got.where(F.length("line") > 20).groupBy("doc_id", "heading").agg(F.count("*").alias("n"))


_PATCHES = "p AS (SELECT doc_id, 1 AS lo, 2 AS hi, CASE WHEN lang = 'en' THEN 'patched ' || doc_id END AS put FROM documents WHERE lang IN ('en', 'fr'))"


@register(f"WITH {_SEGS.split(', m AS')[0]}, {_PATCHES}, f AS (SELECT l.doc_id, line_no, CASE WHEN line_no = lo THEN put ELSE CASE WHEN lo IS NULL OR line_no < lo OR line_no > hi THEN line END END AS line FROM l LEFT JOIN p USING (doc_id)) SELECT doc_id, count(*) AS n, md5(string_agg(line, chr(10) ORDER BY line_no)) AS digest FROM f WHERE line IS NOT NULL GROUP BY 1")
def line_patches(spark, d):
    docs = _docs(spark, d)
    patches = docs.where("lang in ('en', 'fr')").select("doc_id", F.lit(1).alias("lo"), F.lit(2).alias("hi"), F.when(F.col("lang") == "en", F.concat(F.lit("patched "), F.col("doc_id").cast("string"))).alias("put"))
    got = transcript.line_patches(transcript.numbered_lines(docs, "doc_id", "text"), patches, "doc_id")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"])
    return got.groupBy("doc_id").agg(F.count("*").alias("n"), F.md5(F.array_join(ordered, "\n").cast("binary")).alias("digest"))


@register("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_walk(spark, d):
    return Graph(spark, d).table("events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@register("SELECT doc_id, sha256(text) AS sha, substr(sha256(source || '/' || doc_id), 1, 16) AS file_id FROM documents")
def content_hashes(spark, d):
    return _docs(spark, d).select("doc_id", F.sha2("text", 256).alias("sha"), F.substring(F.sha2(F.concat_ws("/", "source", F.col("doc_id").cast("string")), 256), 1, 16).alias("file_id"))


@register("SELECT doc_id, CASE WHEN length(trim(text)) > 40 THEN substr(trim(text), 1, 39) || '…' WHEN length(trim(text)) > 0 THEN trim(text) END AS label FROM documents")
def truncated_labels(spark, d):
    return _docs(spark, d).select("doc_id", tx.truncated(F.col("text"), 40).alias("label"))


@register("SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS dtstart, replace(replace(replace(replace(event_type || ', ' || props, chr(92), chr(92) || chr(92)), ';', chr(92) || ';'), ',', chr(92) || ','), chr(10), chr(92) || 'n') AS summary FROM events")
def ical_lines(spark, d):
    e = Graph(spark, d).table("events")
    return e.select("event_id", F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'").alias("dtstart"), tx.ical_escape(F.concat_ws(", ", "event_type", "props")).alias("summary"))


@register("SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<a ')) AS n_links FROM pages")
def html_titles(spark, d):
    p = Graph(spark, d).table("pages")
    return p.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_count("html", F.lit("<a ")).cast("long").alias("n_links"))


@register("WITH f AS (SELECT conv_id, turn, text, trim(regexp_replace(regexp_replace(text, '(?i)\\b(th|of|and)\\b', '', 'g'), 'tion', 'cion', 'g')) AS fixed FROM conversations), s AS (SELECT *, CASE WHEN length(text) = 0 AND length(fixed) = 0 THEN 1.0 WHEN length(text) = 0 OR length(fixed) = 0 THEN 0.0 ELSE 1 - levenshtein(text, fixed) / greatest(length(text), length(fixed))::DOUBLE END AS sim, len(regexp_extract_all(text, '(?i)\\b(th|of|and)\\b')) > len(regexp_extract_all(fixed, '(?i)\\b(th|of|and)\\b')) AS gone FROM f) SELECT conv_id, turn, round(sim, 6) AS sim, CASE WHEN sim >= 0.92 AND (gone OR abs(length(fixed) - length(text)) <= greatest(8, length(text) // 50)) THEN 'high' WHEN sim >= 0.75 OR (gone AND sim >= 0.65) THEN 'medium' ELSE 'low' END AS tier, CAST(least(100, floor(sim * 70 + CASE WHEN gone AND sim > 0.7 THEN 20 ELSE 0 END + CASE WHEN CASE WHEN length(text) > 0 THEN length(fixed) / length(text)::DOUBLE ELSE 1 END > 0.85 THEN 10 ELSE 0 END)) AS INT) AS score FROM s")
def edit_tiers(spark, d):
    """Tier and score of each turn and its edit; similarity is by edit distance, fillers are given as a pattern."""
    fillers = r"(?i)\b(th|of|and)\b"
    t = _turns(spark, d).select("conv_id", "turn", "text", F.trim(F.regexp_replace(F.regexp_replace("text", fillers, ""), "tion", "cion")).alias("fixed"))
    # Dealt anew, since a small file is one task, however long its texts take.
    t = t.repartition("conv_id", "turn").withColumn("distance", transcript.edit_distance(F.col("text"), F.col("fixed")))
    return t.select("conv_id", "turn", *transcript.edit_confidence(F.col("text"), F.col("fixed"), fillers, F.col("distance")))
