"""Timed text: segments, islands, offsets, alignment, captions, corrections, scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.text import bound


def segments(lines: DataFrame, doc: str, order: str, text: str, cue: Column) -> DataFrame:
    """Lines after a cue join it; (doc, seg, first, n_lines, body). Lines before the first cue are segment 0."""
    run = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumn("seg", F.sum(cue.cast("int")).over(run))
    parts = F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text])
    return marked.groupBy(doc, "seg").agg(F.min(order).alias("first"), F.count("*").alias("n_lines"), F.array_join(parts, " ").alias("body"))


def islands(rows: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """Runs of consecutive rows with one value: (by, island, value, first, last, n)."""
    w = Window.partitionBy(by).orderBy(order)
    change = (~F.col(value).eqNullSafe(F.lag(value).over(w))) | (F.row_number().over(w) == 1)
    marked = rows.withColumn("__c", change.cast("int")).withColumn("island", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(by, "island").agg(F.first(value).alias(value), F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))


def offsets(rows: DataFrame, by: str, order: str, text: str, gap: int = 2) -> DataFrame:
    """(.., lo, hi): half-open character spans of the texts joined by a separator of ``gap`` characters."""
    before = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    lo = F.coalesce(F.sum(F.length(text) + gap).over(before), F.lit(0))
    return rows.withColumn("lo", lo).withColumn("hi", F.col("lo") + F.length(text))


def sliding_chunks(texts: DataFrame, id_col: str, text: str, size: int = 3600, overlap: int = 600) -> DataFrame:
    """(id, lo, chunk): overlapping windows that stop at the end of the text."""
    n = F.length(text)
    starts = F.sequence(F.lit(0), F.greatest(n - overlap - 1, F.lit(0)), F.lit(size - overlap))
    out = texts.select(id_col, text, F.explode(starts).alias("lo"))
    return out.select(id_col, "lo", F.substr(F.col(text), F.col("lo") + 1, F.lit(size)).alias("chunk"))


def neighbours(rows: DataFrame, by: str, order: str, text: str, most: int = 1200) -> DataFrame:
    w = Window.partitionBy(by).orderBy(order)
    return rows.withColumn("prev_text", F.substring(F.lag(text).over(w), 1, most)).withColumn("next_text", F.substring(F.lead(text).over(w), 1, most))


def asof_backward(left: DataFrame, right: DataFrame, by: str, at: str, value: str) -> DataFrame:
    """``left`` with the last ``value`` of ``right`` strictly before it: a union and one window, no range join."""
    l = left.select(by, F.col(at).alias("at"), F.lit(1).alias("side"), F.lit(None).cast(right.schema[value].dataType).alias(value), F.struct(*left.columns).alias("row"))
    r = right.select(by, F.col(at).alias("at"), F.lit(2).alias("side"), value, F.lit(None).cast(l.schema["row"].dataType).alias("row"))
    w = Window.partitionBy(by).orderBy("at", "side").rowsBetween(Window.unboundedPreceding, -1)
    out = l.union(r).withColumn("found", F.last(value, ignorenulls=True).over(w)).where("side = 1")
    return out.select("row.*", F.col("found").alias(value))


def overlapping(spans: DataFrame, segs: DataFrame, by: str, width: int = 4096) -> DataFrame:
    """Pairs of half-open spans that overlap: s.lo < b.hi and s.hi > b.lo.

    Both are cut into cells of equal width and meet by cell, so a long document is many keys; a
    pair is taken in the first cell that both reach.
    """
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.greatest(F.col(hi) - 1, F.col(lo)) / width)))
    s = segs.select(by, F.col("lo").alias("seg_lo"), F.col("hi").alias("seg_hi")).withColumn("__cell", cells("seg_lo", "seg_hi"))
    met = spans.withColumn("__cell", cells("lo", "hi")).join(s, [by, "__cell"]).where("seg_lo < hi and seg_hi > lo")
    first = F.floor(F.greatest("lo", "seg_lo") / width)
    return met.where(F.col("__cell") == first).drop("__cell")


def outermost(spans: DataFrame, by: str) -> DataFrame:
    """Spans that lie in no wider one; equal spans stay. One window: the reach of earlier, wider spans."""
    kinds = spans.select(by, "lo", "hi").distinct()
    order = Window.partitionBy(by).orderBy("lo", F.desc("hi")).rowsBetween(Window.unboundedPreceding, -1)
    kept = kinds.withColumn("reach", F.max("hi").over(order)).where("reach is null or reach < hi").drop("reach")
    return spans.join(kept, [by, "lo", "hi"], "left_semi")


def aligned_hunks(raw: DataFrame, fixed: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Full outer alignment on the keys: replace, delete, insert or same."""
    a, b = raw.select(*keys, F.col(text).alias("raw")), fixed.select(*keys, F.col(text).alias("fixed"))
    kind = F.when(F.col("fixed").isNull(), "delete").when(F.col("raw").isNull(), "insert").when(F.col("raw") != F.col("fixed"), "replace").otherwise("same")
    return a.join(b, list(keys), "full_outer").withColumn("op", kind)


def pattern_hits(texts: DataFrame, id_col: str, text: str, patterns: Sequence[tuple[str, str]]) -> DataFrame:
    """(id, pattern, n): matches of each named pattern in each text; patterns are few, so they stand in the plan."""
    each = F.array(*[F.struct(F.lit(name).alias("pattern"), F.regexp_count(F.col(text), F.lit(p)).cast("long").alias("n")) for name, p in patterns])
    return texts.select(id_col, F.explode(each).alias("x")).select(id_col, "x.pattern", "x.n").where("n > 0")


def word_frequency(texts: DataFrame, text: str, least: int = 1) -> DataFrame:
    words = texts.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), 0)).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def heading_chunks(lines: DataFrame, doc: str, order: str, text: str, heading: Column) -> DataFrame:
    """Each line with the last heading at or before it in its document."""
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("heading", F.last(heading, ignorenulls=True).over(w))


def numbered_lines(texts: DataFrame, id_col: str, text: str) -> DataFrame:
    return texts.select(id_col, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def line_patches(lines: DataFrame, patches: DataFrame, doc: str) -> DataFrame:
    """Lines with the ranges of ``patches`` (doc, lo, hi, put) replaced by one line each; null deletes."""
    hit = lines.join(patches, doc, "left").where("lo is null or line_no between lo and hi")
    new = hit.where("lo is not null and line_no = lo and put is not null").select(doc, "line_no", F.col("put").alias("line"))
    inside = hit.where("lo is not null").select(doc, "line_no")
    return lines.join(inside, [doc, "line_no"], "left_anti").select(doc, "line_no", "line").union(new)


#: Distances at which the comparison of two texts stops, one after the other; what is farther apart is compared wholly.
NEAR = (32, 128, 512)


def edit_distance(a: Column, b: Column) -> Column:
    """The edit distance of two texts, in time of their length times the distance: a band of each width is tried, the narrow ones first."""
    def within(widths):
        if not widths:
            return F.levenshtein(a, b)
        return bound(F.levenshtein(a, b, widths[0]), lambda d: F.when(d >= 0, d).otherwise(within(widths[1:])))

    return within(NEAR)


def edit_confidence(raw: Column, fixed: Column, fillers: str, distance: Column | None = None) -> list[Column]:
    """sim (1 - edit distance / longer length), tier (high, medium or low) and score (0 to 100) of an edit.

    Fixed values: .92 with fillers removed or a change of length of at most 8 characters or a
    fiftieth; .75, or .65 with fillers removed; 70 points for likeness, 20 for fillers, 10 for length.
    All three use the distance several times: give it as a column of the rows, and it is computed once.
    """
    distance = edit_distance(raw, fixed) if distance is None else distance
    n, m = F.length(raw), F.length(fixed)
    sim = F.when((n == 0) & (m == 0), 1.0).when((n == 0) | (m == 0), 0.0).otherwise(1 - distance / F.greatest(n, m))
    gone = F.regexp_count(raw, F.lit(fillers)) > F.regexp_count(fixed, F.lit(fillers))
    tier = F.when((sim >= 0.92) & (gone | (F.abs(m - n) <= F.greatest(F.lit(8), F.floor(n / 50)))), "high").when((sim >= 0.75) | (gone & (sim >= 0.65)), "medium").otherwise("low")
    ratio = F.when(n > 0, m / n).otherwise(1.0)
    score = F.floor(sim * 70 + F.when(gone & (sim > 0.7), 20).otherwise(0) + F.when(ratio > 0.85, 10).otherwise(0))
    return [F.round(sim, 6).alias("sim"), tier.alias("tier"), F.least(F.lit(100), score).cast("int").alias("score")]
