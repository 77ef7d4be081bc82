"""Queries of transcript repair: transcripts are conversations with a cue before every turn."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.catalog import register
from tracewright.functions import media
from tracewright.operators import repair, workflow
from tracewright.plans.bindings import Graph


def _turns(spark, d):
    return Graph(spark, d).table("conversations").withColumn("text", F.replace("text", F.lit("\n"), F.lit(" ")))


def _lines(spark, d):
    """Raw and fixed lines: a cue every other turn, the fixed text shorter, longer or gone by turn."""
    t, k = _turns(spark, d), F.col("turn") % 4
    cue = F.concat(F.lit("["), media.padded_clock(F.floor(F.col("turn") / 2) * 30), F.lit("] "))
    raw = t.select(F.col("conv_id").alias("doc"), F.col("turn").alias("line_no"), F.concat(cue, "text").alias("line"))
    fixed = F.when(k == 1, F.substring("text", 1, 20)).when(k == 2, F.concat("text", F.lit(" and much more of it"))).otherwise(F.col("text"))
    late = F.concat(F.lit("["), media.padded_clock(F.floor(F.col("turn") / 2) * 30 + F.when(k == 3, 7).otherwise(0)), F.lit("] "))
    fixed = t.select(F.col("conv_id").alias("doc"), F.col("turn").alias("line_no"), F.concat(late, fixed).alias("line"))
    return raw, fixed


_T = "t AS (SELECT conv_id AS doc, turn, turn % 4 AS k, replace(text, chr(10), ' ') AS text, turn // 2 * 30 AS sec FROM conversations), f AS (SELECT doc, turn, sec + CASE WHEN k = 3 THEN 7 ELSE 0 END AS sec, CASE k WHEN 1 THEN substr(text, 1, 20) WHEN 2 THEN text || ' and much more of it' ELSE text END AS text FROM t)"
_D = f"{_T}, a AS (SELECT doc, sec, string_agg(text, ' ' ORDER BY turn) AS body, min(turn) AS raw_first FROM t GROUP BY 1, 2), b AS (SELECT doc, sec, string_agg(text, ' ' ORDER BY turn) AS body, min(turn) AS fixed_first FROM f GROUP BY 1, 2), x AS (SELECT coalesce(a.doc, b.doc) AS doc, coalesce(a.sec, b.sec) AS seconds, CASE WHEN b.doc IS NULL THEN 'only_raw' WHEN a.doc IS NULL THEN 'only_fixed' ELSE 'both' END AS side, length(a.body) - length(b.body) AS delta, raw_first, fixed_first FROM a FULL JOIN b ON a.doc = b.doc AND a.sec = b.sec)"


@register(f"WITH {_D} SELECT doc, seconds, side, delta, raw_first, fixed_first FROM x")
def time_deltas(spark, d):
    """Times that both transcripts have, or only one, and how much longer the raw text is."""
    raw, fixed = _lines(spark, d)
    return repair.time_deltas(repair.cue_rows(raw), repair.cue_rows(fixed))


@register(f"WITH {_D}, r AS (SELECT doc, seconds, delta, row_number() OVER (PARTITION BY doc ORDER BY abs(delta) DESC, seconds) AS rank FROM x WHERE side = 'both' AND abs(delta) >= 20) SELECT doc, seconds, delta, rank FROM r WHERE rank <= 3")
def large_deltas(spark, d):
    raw, fixed = _lines(spark, d)
    return repair.large_deltas(repair.time_deltas(repair.cue_rows(raw), repair.cue_rows(fixed)), 20, 3).select("doc", "seconds", "delta", "rank")


@register(f"WITH {_T} SELECT t.doc, t.turn AS line_no, CASE t.k WHEN 2 THEN 'raw body kept' WHEN 3 THEN 'cues differ' END AS note, length(CASE t.k WHEN 2 THEN t.text ELSE f.text END) + 8 AS n FROM t JOIN f USING (doc, turn)")
def zipped_lines(spark, d):
    """Fixed lines next to raw ones of the same number; where the fixed one is much longer the raw one is taken."""
    raw, fixed = _lines(spark, d)
    return repair.zipped(raw, fixed).select("doc", "line_no", "note", F.length("line").alias("n"))


@register("WITH h AS (SELECT l_orderkey AS ep, l_linenumber % 3 AS first, l_linenumber % 3 + 1 AS last, CASE l_quantity::INT % 3 WHEN 0 THEN 'delete' ELSE 'replace' END AS op, CASE l_quantity::INT % 3 WHEN 1 THEN 'x' ELSE '(empty)' END AS text, l_partkey FROM lineitem) SELECT ep, first, last, op, count(*) AS n FROM h WHERE NOT (op = 'delete' AND EXISTS (SELECT 1 FROM h r WHERE r.ep = h.ep AND r.first = h.first AND r.last = h.last AND r.op = 'replace' AND r.text = 'x')) GROUP BY 1, 2, 3, 4")
def superseded_hunks(spark, d):
    q = F.col("l_quantity").cast("int") % 3
    k = (F.col("l_linenumber") % 3).cast("int")
    h = Graph(spark, d).table("lineitem").select(F.col("l_orderkey").alias("ep"), k.alias("first"), (k + 1).alias("last"), F.when(q == 0, "delete").otherwise("replace").alias("op"), F.when(q == 1, "x").otherwise("(empty)").alias("text"))
    return repair.without_superseded(h).groupBy("ep", "first", "last", "op").agg(F.count("*").alias("n"))


@register("WITH h AS (SELECT DISTINCT l_orderkey AS ep, l_linenumber AS first, l_linenumber + l_partkey % 3 AS last FROM lineitem) SELECT ep, first, last, row_number() OVER (PARTITION BY ep ORDER BY first DESC, last DESC) AS place FROM h")
def bottom_up_hunks(spark, d):
    h = Graph(spark, d).table("lineitem").select(F.col("l_orderkey").alias("ep"), F.col("l_linenumber").alias("first"), (F.col("l_linenumber") + F.col("l_partkey") % 3).alias("last"), F.lit("replace").alias("op")).distinct()
    return repair.bottom_up(h).select("ep", "first", "last", "place")


@register("WITH t AS (SELECT conv_id AS doc, turn, replace(text, chr(10), ' ') || ' <' || turn || '>' AS text FROM conversations), c AS (SELECT *, (length(text) - length(replace(text, 'tion', ''))) // 4 AS many FROM t) SELECT doc, turn, md5(CASE WHEN many = 1 THEN replace(replace(text, 'tion', 'TION'), '<' || turn || '>', '(end)') ELSE replace(text, '<' || turn || '>', '(end)') END) AS digest, 'applied,' || CASE many WHEN 0 THEN 'skipped_not_found' WHEN 1 THEN 'applied' ELSE 'skipped_ambiguous' END || ',skipped_not_found' AS statuses FROM c")
def excerpt_fixes(spark, d):
    """Findings of each text: one that stands there once, one that may stand there often, one that does not, one of too low a severity."""
    t = _turns(spark, d)
    mark = F.concat(F.lit("<"), F.col("turn").cast("string"), F.lit(">"))
    texts = t.select(F.struct("conv_id", "turn").alias("doc"), F.concat("text", F.lit(" "), mark).alias("text"))
    row = lambda seq, level, ex, fix: F.struct(F.lit(seq).cast("long").alias("seq"), F.lit(level).alias("severity"), ex.alias("excerpt"), F.lit(fix).alias("fix"))
    said = F.array(row(1, "high", F.concat(mark, F.lit(" ")), "(end)"), row(2, "high", F.lit("tion"), "TION"), row(3, "medium", F.lit("no such text at all"), "x"), row(4, "low", mark, "y"))
    found = t.select(F.struct("conv_id", "turn").alias("doc"), F.explode(said).alias("x")).select("doc", "x.*")
    status = lambda seq: F.element_at(F.filter("report", lambda x: x["seq"] == seq), 1)["status"]
    got = repair.excerpt_fixes(texts, found, "medium")
    return got.select(F.col("doc.conv_id").alias("doc"), "doc.turn", F.md5(F.col("text").cast("binary")).alias("digest"), F.concat_ws(",", status(1), status(2), status(3)).alias("statuses"))


_SPAN = "s AS (SELECT conv_id AS doc, turn AS seq, coalesce(sum(length(text) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lo, length(text) AS n, text, '[' || turn || ']' AS label, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prev, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM conversations), r AS (SELECT doc, unnest(range(0, max(lo + n) + 600, 300)) AS lo FROM s GROUP BY 1)"


@register(f"WITH {_SPAN}, m AS (SELECT r.doc, r.lo, arg_min(label, seq) AS a, arg_max(label, seq) AS b, min(seq) AS f, max(seq) AS l, arg_min(coalesce(prev, ''), seq) AS prev, arg_max(coalesce(next, ''), seq) AS next FROM r JOIN s ON s.doc = r.doc AND s.lo < r.lo + 450 AND s.lo + n > r.lo GROUP BY 1, 2) SELECT r.doc, CAST(r.lo AS BIGINT) AS lo, CASE WHEN f IS NULL THEN '[?]' WHEN f = l THEN a ELSE a || '–' || b END AS label, f * 30 AS seconds, substr(coalesce(prev, ''), 1, 50) AS prev_text, substr(coalesce(next, ''), 1, 50) AS next_text FROM r LEFT JOIN m ON m.doc = r.doc AND m.lo = r.lo")
def range_labels(spark, d):
    """Labels of the first and last turn that each range of the joined text meets, and the turns around them."""
    from tracewright.operators import transcript

    t = Graph(spark, d).table("conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("seq"), "text")
    s = transcript.offsets(t, "doc", "seq", "text").withColumns({"label": F.concat(F.lit("["), F.col("seq").cast("string"), F.lit("]")), "seconds": F.col("seq") * 30})
    top = s.groupBy("doc").agg(F.max("hi").alias("m")).select("doc", F.explode(F.expr("sequence(0L, m + 599L, 300L)")).alias("lo")).withColumn("hi", F.col("lo") + 450)
    return repair.range_labels(top, s, "doc", 50).drop("hi")


@register("WITH t AS (SELECT conv_id AS doc, string_agg('[' || printf('%02d:%02d', turn, 0) || '] ' || replace(text, chr(10), ' '), chr(10) ORDER BY turn) AS text FROM conversations GROUP BY 1), p AS (SELECT doc, text, pat, string_split(text, pat) AS parts FROM t, (VALUES ('tion'), ('ing')) AS v(pat)), o AS (SELECT doc, text, pat, k, (list_sum(list_transform(parts[1:k], lambda x: length(x))) + (k - 1) * length(pat))::INT AS start FROM (SELECT *, unnest(range(1, len(parts))) AS k FROM p)), r AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY CASE pat WHEN 'tion' THEN 0 ELSE 1 END, start) AS r FROM o) SELECT doc, pat AS id, start, substr(text, greatest(start - 100, 0) + 1, start + length(pat) + 120 - greatest(start - 100, 0)) AS excerpt, list_extract(regexp_extract_all(substr(text, 1, start), '\\[\\d{1,2}:\\d{2}\\]'), -1) AS caption_label FROM r WHERE r <= 150")
def pattern_scan(spark, d):
    """Matches of patterns with their excerpt and the caption before them."""
    t = _turns(spark, d)
    line = F.concat(F.format_string("[%02d:%02d] ", F.col("turn").cast("int"), F.lit(0)), "text")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))), lambda x: x["line"]), "\n")
    texts = t.groupBy(F.col("conv_id").alias("doc")).agg(joined.alias("text"))
    got = repair.scan(texts, [("tion", "tion", "check the ending"), ("ing", "ing", "check")])
    return got.select("doc", "id", "start", "excerpt", "caption_label")


@register("SELECT doc_id, md5(replace(replace(text, 'tionth', 'TH'), 'the', 'THE')) AS digest, list_filter([CASE WHEN contains(text, 'tionth') THEN 'tionth → TH' END, CASE WHEN contains(replace(text, 'tionth', 'TH'), 'the') THEN 'the → THE' END], lambda x: x IS NOT NULL) AS applied FROM documents")
def name_corrections(spark, d):
    """Corrections from a confidence up, the longest first; the low one and the senseless one are left out."""
    rules = [("the", "THE", "medium"), ("tionth", "TH", "high"), ("and", "&", "low"), ("ha", "z" * 120, "high")]
    x = repair.corrected(F.col("text"), rules)
    return Graph(spark, d).table("documents").select("doc_id", x.alias("x")).select("doc_id", F.md5(F.col("x.text").cast("binary")).alias("digest"), "x.applied")


_S = repair.SPACE
_PLACES = f"""
l AS (SELECT doc_id AS doc, unnest(range(0, len(p))) AS line_no, unnest(p) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)),
c AS (SELECT doc, line_no, line, regexp_extract_all(line, '{_S}+|' || replace('{_S}', '[', '[^') || '+') AS p FROM l),
w AS (SELECT doc, line_no, line, p, unnest(range(1, len(p) - 1)) AS i FROM c WHERE len(p) > 2),
m AS (SELECT doc, line_no, line, CAST(CASE WHEN i = 1 THEN 0 ELSE list_sum(list_transform(p[1 : i - 1], lambda x: length(x))) END AS INT) AS start, length(p[i]) AS n FROM w WHERE regexp_full_match(p[i], '{_S}+') AND i > 1 AND regexp_matches(p[i - 1], '[A-Za-z]$') AND regexp_full_match(p[i + 1], '[A-Za-z]{{1,3}}')),
o AS (SELECT doc, line_no, start, regexp_replace(substr(line, greatest(start - 30, 0) + 1, start + n + 30 - greatest(start - 30, 0)), '^{_S}+|{_S}+$', '', 'g') AS context FROM m)
"""


def _places(spark, d):
    from tracewright.operators import transcript

    docs = Graph(spark, d).table("documents").withColumnRenamed("doc_id", "doc")
    return repair.split_places(transcript.numbered_lines(docs, "doc", "text").select("doc", "line_no", "line"))


@register(f"WITH {_PLACES} SELECT doc, CAST(line_no AS INT) AS line_no, start, context FROM o")
def split_places(spark, d):
    """Where a word may have been split, in every line of every document, with what stands around."""
    return _places(spark, d)


@register(f"WITH {_PLACES}, f AS (SELECT DISTINCT unnest(regexp_extract_all(context, '[A-Za-z]{{1,3}}{_S}+[A-Za-z]{{1,3}}')) AS f FROM o), p AS (SELECT DISTINCT regexp_split_to_array(f, '{_S}+') AS p FROM f) SELECT p[1] || ' ' || p[2] AS wrong, upper(p[1][1]) || lower(p[1][2:]) || upper(p[2][1]) || lower(p[2][2:]) AS \"right\" FROM p")
def generated_corrections(spark, d):
    """Corrections from all places where a word may have been split."""
    return repair.generated_corrections(_places(spark, d))


@register("WITH c AS (SELECT DISTINCT l_suppkey AS k FROM lineitem) SELECT 'AB' || repeat('x', k % 5 + 1) AS w, count(*) AS n FROM c GROUP BY 1")
def correction_counts(spark, d):
    """Whole-word occurrences of generated words: a dry run."""
    k = F.col("l_suppkey")
    texts = Graph(spark, d).table("lineitem").select(k).distinct().select(F.concat(F.lit("see AB"), F.repeat(F.lit("x"), (k % 5 + 1).cast("int")), F.lit(", ABC.")).alias("text"))
    words = texts.select(F.regexp_extract("text", "AB(x+)", 0).alias("wrong")).distinct()
    return repair.whole_word_counts(texts, words).select(F.col("wrong").alias("w"), "n")


@register("SELECT o_orderkey, 'B' || o_orderkey || ' ab B' || o_orderkey || ' Xa' AS text, 3 AS n FROM orders")
def whole_word_fold(spark, d):
    o, k = Graph(spark, d).table("orders"), F.col("o_orderkey").cast("string")
    rules = F.array(F.struct(F.lit("a").alias("wrong"), F.concat(F.lit("B"), k).alias("right")), F.struct(F.lit("X").alias("wrong"), F.lit("Xa").alias("right")))
    return o.select("o_orderkey", repair.whole_words_replaced(F.lit("a ab a X"), rules).alias("x")).select("o_orderkey", "x.text", "x.n")


@register("WITH l AS (SELECT doc_id AS doc, unnest(range(0, len(p))) AS line_no, unnest(p) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)), f AS (SELECT doc, min(line_no) AS first FROM l WHERE contains(line, 'th') GROUP BY 1) SELECT f.doc, CAST(first AS INT) AS first, md5(string_agg(line, chr(10) ORDER BY line_no)) AS digest FROM f JOIN l ON l.doc = f.doc AND line_no BETWEEN first - 1 AND first + 1 GROUP BY 1, 2")
def anchor_windows(spark, d):
    """The first line that holds a text, with the lines around it."""
    from tracewright.operators import transcript

    docs = Graph(spark, d).table("documents")
    lines = transcript.numbered_lines(docs, "doc_id", "text").withColumnRenamed("doc_id", "doc")
    anchors = docs.select(F.col("doc_id").alias("doc"), F.lit("th").alias("anchor"))
    return repair.line_window(lines, anchors, 1).select("doc", "first", F.md5(F.col("text").cast("binary")).alias("digest"))


@register("WITH s AS (SELECT doc_id, text, unnest(range(0, greatest(length(text) - 600, 1), 3000)) AS lo FROM documents), c AS (SELECT doc_id, lo, length(text) AS n, substr(text, lo + 1, 3600) AS chunk FROM s) SELECT doc_id, lo + strpos(chunk, 'tion') - 1 AS at, least(lo + strpos(chunk, 'tion') + 3, n) AS until FROM c WHERE strpos(chunk, 'tion') > 0")
def excerpt_ranges(spark, d):
    """Where an excerpt of a chunk stands in the whole text."""
    from tracewright.operators import transcript

    docs = Graph(spark, d).table("documents")
    chunks = transcript.sliding_chunks(docs, "doc_id", "text").join(docs.select("doc_id", F.length("text").alias("n")), "doc_id")
    x = repair.excerpt_range(F.col("lo"), F.col("chunk"), F.lit(" tion "), F.col("n"))
    return chunks.select("doc_id", x.alias("x")).where("x is not null").select("doc_id", F.col("x.lo").cast("long").alias("at"), F.col("x.hi").cast("long").alias("until"))


@register("WITH t AS (SELECT conv_id, max(turn) + 1 AS n FROM conversations GROUP BY 1) SELECT conv_id AS ep, 'ec-20240101-' || lpad(row_number() OVER (ORDER BY conv_id)::VARCHAR, 3, '0') AS id, n AS next FROM t")
def next_numbers(spark, d):
    """The next number of each item, and log identifiers counted up over the day."""
    from tracewright.plans.ranks import global_rank

    t = Graph(spark, d).table("conversations").groupBy(F.col("conv_id").alias("ep")).agg((F.max("turn") + 1).alias("next"))
    return global_rank(t, "ep", name="n").select("ep", F.concat(F.lit("ec-20240101-"), F.lpad((F.col("n") + 1).cast("string"), 3, "0")).alias("id"), "next")


_SHORT = "CASE WHEN regexp_full_match(x, 'th[a-z]*') THEN substr(x, 1, greatest(4, length(x) - 5)) WHEN x = 'and' THEN 'also' ELSE x END"


@register(f"WITH t AS (SELECT doc_id AS doc, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]+') AS p FROM documents) SELECT doc, md5(array_to_string(list_transform(p, lambda x: {_SHORT}), '')) AS digest, coalesce(least(5, list_max(list_transform(p, lambda x: CASE WHEN regexp_full_match(x, 'th[a-z]*') THEN greatest(length(x) - 4, 0) WHEN x = 'and' THEN 1 ELSE 0 END))), 0)::INT AS passes FROM t")
def correction_workflow(spark, d):
    """Corrections to their fixed point: each pass takes a letter off the words in th- of over four, which gives rise to the next pass's corrections; five passes at most."""
    docs = Graph(spark, d).table("documents").select(F.col("doc_id").alias("doc"), "text")
    first = docs.select(F.lit("and").alias("wrong"), F.lit("also").alias("right")).limit(1)
    long = F.col("word").rlike("^th[a-z]*$") & (F.length("word") > 4)
    shorter = lambda words: words.where(long).select(F.col("word").alias("wrong"), F.expr("left(word, length(word) - 1)").alias("right"))
    got = workflow.until_stable(docs, first, shorter)
    return got.select("doc", F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("digest"), "passes")
