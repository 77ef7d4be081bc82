"""Repair of timed text: cue lines and their differences, excerpts and hunks, scans, and name corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.media import CUE, cue_seconds, line_body
from tracewright.functions.text import bound, confidence_rank, match_places, prefix_sums
from tracewright.operators.overrides import sane_correction


def cue_rows(lines: DataFrame) -> DataFrame:
    """(doc, line_no, seconds, body) of the lines that begin with a cue."""
    return lines.where(F.col("line").rlike(CUE)).select("doc", "line_no", cue_seconds(F.col("line")).alias("seconds"), F.regexp_extract("line", CUE, 4).alias("body"))


def by_second(rows: DataFrame) -> DataFrame:
    """(doc, seconds, body, first, last): the bodies of one time joined by a space in line order, and their first and last line."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "body"))), lambda x: x["body"]), " ")
    return rows.groupBy("doc", "seconds").agg(joined.alias("body"), F.min("line_no").alias("first"), F.max("line_no").alias("last"))


def time_deltas(raw: DataFrame, fixed: DataFrame) -> DataFrame:
    """(doc, seconds, side, delta, raw_first, fixed_first): every time of either text; delta is the raw length less the fixed one where both have it."""
    a = by_second(raw).select("doc", "seconds", F.col("body").alias("a"), F.col("first").alias("raw_first"))
    b = by_second(fixed).select("doc", "seconds", F.col("body").alias("b"), F.col("first").alias("fixed_first"))
    side = F.when(F.col("b").isNull(), "only_raw").when(F.col("a").isNull(), "only_fixed").otherwise("both")
    return a.join(b, ["doc", "seconds"], "full_outer").select("doc", "seconds", side.alias("side"), (F.length("a") - F.length("b")).alias("delta"), "raw_first", "fixed_first")


def large_deltas(deltas: DataFrame, least: int = 60, most: int = 40) -> DataFrame:
    """The ``most`` greatest differences of ``least`` characters or more of each document, ties by time."""
    big = deltas.where((F.col("side") == "both") & (F.abs("delta") >= least))
    order = Window.partitionBy("doc").orderBy(F.desc(F.abs("delta")), "seconds")
    return big.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def zipped(raw: DataFrame, fixed: DataFrame, margin: int = 8) -> DataFrame:
    """(doc, line_no, line, note): fixed lines, with the raw body where the fixed one is longer by more than ``margin``.

    Lines meet by number, in documents that have as many lines in both; else all stay and say so.
    Lines without a cue in either stay; those with different cues stay and say so.
    """
    sizes = raw.groupBy("doc").agg(F.count("*").alias("n_raw")).join(fixed.groupBy("doc").agg(F.count("*").alias("n_fixed")), "doc")
    same = sizes.select("doc", (F.col("n_raw") == F.col("n_fixed")).alias("same"))
    met = fixed.join(same, "doc", "left").join(raw.select("doc", "line_no", F.col("line").alias("raw")), ["doc", "line_no"], "left")
    cue = lambda c: F.regexp_extract(c, r"^\[([0-9:]+)\]", 1)
    timed = F.coalesce(F.col("same"), F.lit(False)) & F.coalesce(F.col("raw").rlike(CUE), F.lit(False)) & F.col("line").rlike(CUE)
    body = lambda c: F.regexp_extract(c, CUE, 4)
    longer = F.length(body("line")) - F.length(body("raw")) > margin
    note = F.when(~F.coalesce(F.col("same"), F.lit(False)), "line counts differ").when(timed & (cue("raw") != cue("line")), "cues differ").when(timed & longer, "raw body kept")
    line = F.when(timed & (cue("raw") == cue("line")) & longer, F.concat(F.lit("["), cue("raw"), F.lit("] "), body("raw"))).otherwise(F.col("line"))
    return met.select("doc", "line_no", line.alias("line"), note.alias("note"))


def without_superseded(hunks: DataFrame) -> DataFrame:
    """Hunks (ep, first, last, op, text) without deletions of a span that a replacement with text has too."""
    put = hunks.where("op = 'replace' and trim(coalesce(text, '')) not in ('', '(empty)')").select("ep", "first", "last").distinct()
    kept = hunks.where("op = 'delete'").join(put, ["ep", "first", "last"], "left_anti")
    return hunks.where("op <> 'delete'").unionByName(kept.select(hunks.columns))


def bottom_up(hunks: DataFrame) -> DataFrame:
    """Hunks with ``place``, their order of application in each episode: from the last line up."""
    return hunks.withColumn("place", F.row_number().over(Window.partitionBy("ep").orderBy(F.desc("first"), F.desc("last"), "op")))


def _count(text: Column, find: Column) -> Column:
    return ((F.length(text) - F.length(F.replace(text, find, F.lit("")))) / F.length(find)).cast("int")


def excerpt_fixes(texts: DataFrame, findings: DataFrame, floor: str | None = None) -> DataFrame:
    """(doc, text, report): fixes (doc, seq, severity, excerpt, fix) written where the excerpt stands once, the longest excerpt first.

    The report names each candidate: applied, skipped_not_found or skipped_ambiguous. Blank
    excerpts and fixes, fixes that change nothing and severities under ``floor`` are no candidates.
    """
    ex, fix = F.trim("excerpt"), F.trim("fix")
    good = findings.select("doc", "seq", "severity", ex.alias("ex"), fix.alias("fix")).where("ex <> '' and fix <> '' and ex <> fix")
    if floor:
        good = good.where(confidence_rank(F.col("severity")) >= confidence_rank(F.lit(floor)))
    queue = good.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct((-F.length("ex")).alias("n"), "seq", "ex", "fix"))).alias("queue"))

    def step(a, x):
        n = _count(a["text"], x["ex"])
        status = F.when(n == 1, "applied").when(n == 0, "skipped_not_found").otherwise("skipped_ambiguous")
        return F.struct(F.when(n == 1, F.replace(a["text"], x["ex"], x["fix"])).otherwise(a["text"]).alias("text"), F.array_append(a["report"], F.struct(x["seq"].alias("seq"), status.alias("status"))).alias("report"))

    begin = F.struct(F.col("text").alias("text"), F.array().cast("array<struct<seq:bigint,status:string>>").alias("report"))
    return texts.join(queue, "doc").select("doc", F.aggregate("queue", begin, step).alias("x")).select("doc", "x.text", "x.report")


def excerpt_range(chunk_start: Column, chunk: Column, excerpt: Column, length: Column) -> Column:
    """(lo, hi) of an excerpt of a chunk within the whole text of ``length``; null where the chunk lacks it."""
    needle = F.trim(F.coalesce(excerpt, F.lit("")))
    at = F.instr(chunk, needle)
    lo = chunk_start + at - 1
    return F.when((needle != "") & (at > 0), F.struct(lo.alias("lo"), F.least(lo + F.length(needle), length).alias("hi")))


def range_labels(ranges: DataFrame, spans: DataFrame, by: str, keep: int = 1200) -> DataFrame:
    """``ranges`` (by, lo, hi, ..) plus label, seconds, prev_text and next_text of the spans (by, seq, lo, hi, label, seconds, text) they meet.

    Half-open spans meet where s.lo < hi and s.hi > lo. Every range and span is cut into cells of
    equal width, and they meet by cell, so a long document is many keys. A range that meets none
    has the label '[?]'.
    """
    width = 4096
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(lo / width), F.floor(F.greatest(hi - 1, lo) / width)))
    near = Window.partitionBy(by).orderBy("seq")
    s = spans.withColumns({"prev": F.substring(F.lag("text").over(near), 1, keep), "next": F.substring(F.lead("text").over(near), 1, keep)})
    s = s.select(by, "seq", F.col("lo").alias("s_lo"), F.col("hi").alias("s_hi"), "label", "seconds", "prev", "next", cells(F.col("lo"), F.col("hi")).alias("cell"))
    keyed = ranges.withColumn("__r", F.struct(by, "lo", "hi"))
    met = keyed.select("__r", by, "lo", "hi").distinct().withColumn("cell", cells(F.col("lo"), F.col("hi"))).join(s, [by, "cell"]).where("s_lo < hi and s_hi > lo")
    first, last = F.min_by(F.struct("seq", "label", "seconds", "prev"), "seq"), F.max_by(F.struct("seq", "label", "next"), "seq")
    found = met.groupBy("__r").agg(first.alias("f"), last.alias("l"))
    label = F.when(F.col("f.seq") == F.col("l.seq"), F.col("f.label")).otherwise(F.concat("f.label", F.lit("–"), "l.label"))
    out = keyed.join(found, "__r", "left")
    none = F.lit("")
    return out.select(*ranges.columns, F.coalesce(label, F.lit("[?]")).alias("label"), F.col("f.seconds").alias("seconds"), F.coalesce("f.prev", none).alias("prev_text"), F.coalesce("l.next", none).alias("next_text"))


def scan(texts: DataFrame, patterns: list[tuple[str, str, str]], most: int = 150) -> DataFrame:
    """(doc, id, hint, match, start, end, excerpt, caption_seconds, caption_label): matches of (id, expression, hint) patterns.

    The caption is the last [M:SS] or [H:MM:SS] strictly before the match. The first ``most``
    findings of a text, by pattern and place, are given.
    """
    def named(n, name, p, hint):
        told = lambda m: F.struct(F.lit(n).alias("n"), F.lit(name).alias("id"), F.lit(hint).alias("hint"), m["start"].alias("start"), m["match"].alias("match"))
        return F.transform(F.slice(match_places(F.col("text"), p), 1, most), told)

    hits = F.flatten(F.array(*[named(n, *pattern) for n, pattern in enumerate(patterns)]))
    cue = r"\[\d{1,2}:\d{2}(?::\d{2})?\]"
    each = texts.select("doc", "text", F.posexplode(F.slice(hits, 1, most)).alias("pos", "h")).select("doc", "text", "h.*")
    before = F.substr("text", F.lit(1), F.col("start"))
    # A cue that begins before the match may end within it.
    whole = F.regexp_extract_all(F.concat(before, F.regexp_extract(F.substr("text", F.col("start") + 1, F.lit(9)), r"^[^\[]*", 0)), F.lit(cue), F.lit(0))
    label = F.when(F.size(whole) > 0, F.element_at(whole, -1))
    seconds = cue_seconds(F.concat(label, F.lit(" ")))
    lo, end = F.greatest(F.col("start") - 100, F.lit(0)), F.col("start") + F.length("match")
    return each.select("doc", "id", "hint", "match", "start", end.alias("end"), F.substr("text", lo + 1, end + 120 - lo).alias("excerpt"), seconds.alias("caption_seconds"), label.alias("caption_label"))


def corrected(text: Column, corrections: list[tuple[str, str, str]], threshold: str = "medium") -> Column:
    """(text, applied): corrections (wrong, right, confidence) at or above a confidence, sane ones only, the longest wrong text first.

    ``applied`` lists 'wrong → right' of those that the text held when their turn came.
    """
    rank = {"high": 3, "medium": 2, "low": 1}
    chosen = sorted((c for c in corrections if c[0] and c[1] and rank.get(c[2], 0) >= rank[threshold]), key=lambda c: (-len(c[0]), c[0]))
    rules = F.array(*[F.struct(F.lit(w).alias("wrong"), F.lit(r).alias("right")) for w, r, _ in chosen]) if chosen else F.array().cast("array<struct<wrong:string,right:string>>")
    rules = F.filter(rules, lambda r: sane_correction(r["wrong"], r["right"]))
    begin = F.struct(text.alias("text"), F.array().cast("array<string>").alias("applied"))
    step = lambda a, r: F.when(F.contains(a["text"], r["wrong"]), F.struct(F.replace(a["text"], r["wrong"], r["right"]).alias("text"), F.array_append(a["applied"], F.concat_ws(" → ", r["wrong"], r["right"])).alias("applied"))).otherwise(a)
    return F.aggregate(rules, begin, step)


# White space; what a place where a word may be split looks like, how much around it is looked at, and the parts that are joined.
SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_SPACES = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_SPACE = rf"[[^!-~]&&{SPACE}]"  # the same characters; most others are told by one comparison
#: A line up to the end of the next such place, or what is left of it, so the last piece of a line is never a place.
UP_TO_SPLIT = rf"(?s).*?[A-Za-z]{_SPACE}++(?=[A-Za-z]{{1,3}}+{_SPACE})|.+"
PARTS = rf"[A-Za-z]{{1,3}}+{_SPACE}++[A-Za-z]{{1,3}}+"
AROUND = 30


def split_places(lines: DataFrame) -> DataFrame:
    """(doc, line_no, start, context): where white space after a letter is followed by a word of one to three letters and white space.

    ``lines`` has (doc, line_no, line). The context is the line 30 characters to either side, trimmed.
    """
    def placed(pieces):
        pieces = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))
        return F.arrays_zip(prefix_sums(F.transform(pieces, lambda x: F.length(x))).alias("end"), pieces.alias("piece"))

    pieces = F.regexp_extract_all("line", F.lit(UP_TO_SPLIT), F.lit(0))
    each = lines.select("doc", "line_no", "line", F.inline(bound(pieces, placed)).alias("end", "piece"))
    start = F.col("end") - F.length("piece") + F.length(F.rtrim("piece", F.lit(_SPACES)))
    each = each.select("doc", "line_no", "line", start.cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    lo = F.greatest(F.col("start") - AROUND, F.lit(0))
    context = F.btrim(F.substr("line", lo + 1, F.col("end") + AROUND - lo), F.lit(_SPACES))
    return each.select("doc", "line_no", "start", context.alias("context"))


def generated_corrections(places: DataFrame) -> DataFrame:
    """(wrong, right): every two runs of one to three letters with white space between in a context, joined, each part with one capital.

    The first run may be the end of a longer word, as in the studied rule. Words that would differ
    in letter case alone give no correction there, so none is made of capitals.
    """
    found = places.select(F.explode(F.regexp_extract_all("context", F.lit(PARTS), F.lit(0))).alias("found")).distinct()
    # An expression is compiled once where a split compiles its own for every row; what is right follows from what is wrong.
    wrong = found.select(F.regexp_replace("found", f"{_SPACE}++", " ").alias("wrong")).distinct()
    first, second = (F.substring_index("wrong", " ", n) for n in (1, -1))
    return wrong.select("wrong", F.concat(F.initcap(first), F.initcap(second)).alias("right"))


def whole_word_counts(texts: DataFrame, corrections: DataFrame, text: str = "text") -> DataFrame:
    """(wrong, n): how often each wrong word (letters alone) stands in the texts as a whole word; a dry run of applying it."""
    words = texts.select(F.explode(F.regexp_extract_all(text, F.lit("[A-Za-z]+"), F.lit(0))).alias("wrong")).groupBy("wrong").agg(F.count("*").alias("n"))
    return corrections.select("wrong").join(words, "wrong", "left").select("wrong", F.coalesce("n", F.lit(0)).alias("n"))


def whole_words_replaced(text: Column, rules: Column) -> Column:
    """(text, n): whole words replaced by rules (wrong, right), one after the other, and how many in all."""
    begin = F.struct(text.alias("text"), F.lit(0).alias("n"))

    def step(a, r):
        pattern = F.concat(F.lit(r"\b\Q"), r["wrong"], F.lit(r"\E\b"))
        return F.struct(F.regexp_replace(a["text"], pattern, r["right"]).alias("text"), (a["n"] + F.regexp_count(a["text"], pattern)).alias("n"))

    return F.aggregate(rules, begin, step)


def line_window(lines: DataFrame, anchors: DataFrame, around: int = 2) -> DataFrame:
    """(doc, anchor, first, text): the first line that holds an anchor, and the lines up to ``around`` before and after it."""
    found = lines.join(anchors, "doc").where(F.contains("line", F.col("anchor"))).groupBy("doc", "anchor").agg(F.min("line_no").alias("first"))
    wanted = found.withColumn("line_no", F.explode(F.sequence(F.col("first") - around, F.col("first") + around)))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"])
    return wanted.join(lines, ["doc", "line_no"]).groupBy("doc", "anchor", "first").agg(F.array_join(parts, "\n").alias("text"))


def caption_segments(lines: DataFrame) -> DataFrame:
    """(doc, seg, label, seconds, text): a cue's line and those after it, joined; what comes before the first cue has no label and second 0; empty segments go."""
    w = Window.partitionBy("doc").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    cue = F.col("line").rlike(CUE)
    label = F.when(cue, F.regexp_extract("line", r"^\[[0-9:]+\]", 0))
    marked = lines.withColumns({"seg": F.sum(cue.cast("int")).over(w), "label": label, "seconds": F.when(cue, cue_seconds(F.col("line"))), "body": line_body(F.col("line"))})
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "body"))), lambda x: x["body"]), " ")
    made = marked.groupBy("doc", "seg").agg(F.max("label").alias("label"), F.coalesce(F.max("seconds"), F.lit(0)).alias("seconds"), F.trim(joined).alias("text"))
    return made.where("text <> ''")
