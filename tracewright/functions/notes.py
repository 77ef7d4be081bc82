"""Dates, clocks, tags, links and outline blocks of notes and transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The filler words that are counted.
FILLERS = r"(?i)\b(uh|um|erm|er|ah|hmm|hm|like)\b"


# The forms of a date in a text in the order they are looked for, and the formats they are read by.
DEADLINES = [
    r"(\d{4}-\d{2}-\d{2})",
    r"(\d{1,2}/\d{1,2}/\d{1,4})",
    r"(?i)(?:due|deadline|by)\s*[:\s]*(\d{0,2}\s+\w+\s+\d{4})",
    r"(?i)(\w+\s+\d{1,2},?\s+\d{4})",
]
DATE_FORMATS = ["M/d/yyyy", "d/M/yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy"]


def deadline(text: Column) -> Column:
    """The date of a text as yyyy-MM-dd: the first form of DEADLINES that it holds and that a format reads; null without one."""

    found = F.array(*[F.trim(F.regexp_replace(F.regexp_extract(text, p, 1), r"\s+", " ")) for p in DEADLINES])

    def read(x: Column) -> Column:
        dates = [F.date_format(F.try_to_date(F.when(F.length(F.regexp_extract(x, r"(\d+)$", 1)) == 4, x), f), "yyyy-MM-dd") for f in DATE_FORMATS]
        return F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}"), x).otherwise(F.coalesce(*dates))

    return F.get(F.filter(F.transform(found, read), lambda x: x.isNotNull()), F.lit(0))


def ical_stamp(iso: Column) -> Column:
    """yyyyMMddTHHmmssZ of an ISO time; missing minutes or seconds are zeros; null without a time part."""
    s = F.regexp_replace(F.trim(iso), "Z$", "")
    time = F.rpad(F.regexp_replace(F.substring_index(F.substring_index(s, "T", -1), ".", 1), ":", ""), 6, "0")
    return F.when(F.contains(s, F.lit("T")), F.concat(F.regexp_replace(F.substring_index(s, "T", 1), "-", ""), F.lit("T"), time, F.lit("Z")))


def minutes_until(clock: Column, now: Column) -> Column:
    """Whole minutes from ``now`` to HH:MM of its day; null once it has passed or if it is no clock."""
    at = F.try_to_timestamp(F.concat_ws(" ", F.date_format(now, "yyyy-MM-dd"), clock), F.lit("yyyy-MM-dd HH:mm"))
    left = F.floor((F.unix_timestamp(at) - F.unix_timestamp(now)) / 60)
    return F.when(F.unix_timestamp(at) > F.unix_timestamp(now), left)


def expired(seen: Column, today: Column, days: int) -> Column:
    return F.datediff(today, seen) > days


# The addresses that hold a video's identifier.
VIDEO = r"(?:youtube\.com/watch\?v=|youtu\.be/)([A-Za-z0-9_-]{11})"


def video_id(url: Column) -> Column:
    found = F.regexp_extract(url, VIDEO, 1)
    return F.nullif(found, F.lit(""))


def first_url(text: Column) -> Column:
    """The first http address, without trailing punctuation."""
    return F.nullif(F.regexp_replace(F.regexp_extract(text, r"(https?://\S+)", 1), r"[).,;:!?\]]+$", ""), F.lit(""))


# A tag, plain or in double brackets, and a page reference.
TAG, PAGE = r"#(?:\[\[)?([^\s\]#]+)\]?\]?", r"\[\[([^\]]+)\]\]"


def tags(text: Column) -> Column:
    """#tag and #[[tag]], each once, sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TAG), 1), lambda x: F.trim(x))))


def tags_and_pages(text: Column) -> Column:
    """Tags and page references of a text, each once, sorted."""
    return F.array_sort(F.array_union(tags(text), page_refs(text)))


def page_refs(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(PAGE), 1), lambda x: F.trim(x))


def clean_block(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, PAGE, "$1"))


def filler_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(FILLERS))


def without_fillers(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, FILLERS + ",?", ""), r"\s+", " "))


def outline(lines: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, line_no, depth, marker, text): blocks by leading tabs; blank ones are dropped."""
    depth = F.length("line") - F.length(F.regexp_replace("line", r"^\t+", ""))
    body = F.trim(F.regexp_replace("line", r"^\t*[- ]*", ""))
    marker = F.nullif(F.regexp_extract(body, "^(TODO|DONE|LATER|DOING) ", 1), F.lit(""))
    out = lines.select(doc, "line_no", depth.alias("depth"), marker.alias("marker"), F.trim(F.regexp_replace(body, "^(TODO|DONE|LATER|DOING) ", "")).alias("text"))
    return out.where("text <> ''")


def subtree_ends(blocks: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``blocks`` plus ``end_no``: the first later line at the block's depth or above, null at the end.

    One window for each depth that occurs finds the next line of that depth or less, so no range
    join is made; the depths are read from the data.
    """
    depths = sorted(r[0] for r in blocks.select("depth").distinct().collect())
    after = Window.partitionBy(doc).orderBy(F.desc("line_no")).rowsBetween(Window.unboundedPreceding, -1)
    end = F.lit(None).cast("int")
    for k in depths:
        end = F.when(F.col("depth") == k, F.min(F.when(F.col("depth") <= k, F.col("line_no"))).over(after)).otherwise(end)
    return blocks.withColumn("end_no", end)


def split_long(text: Column, most: int = 7000) -> Column:
    """Pieces of at most ``most`` characters, cut at the last newline that allows it; their join is the text."""
    step = rf"(?s)(.{{1,{most}}}(?:\n|\z)|.{{1,{most}}})"
    return F.regexp_extract_all(text, F.lit(step), 1)


def first_heading(text: Column, fallback: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(F.regexp_extract(text, r"(?m)^#\s+(.+)$", 1)), F.lit("")), fallback)


def file_id(path: Column, digits: int = 16) -> Column:
    return F.substring(F.sha2(F.regexp_replace(path, r"\\", "/"), 256), 1, digits)


# The form of a list item that names an opportunity, and the types that its hint may name, in order.
OPPORTUNITY = r"^-\s*\[?([^\]]+)\]?\s*(.+?)(?:\s|$)"
OPPORTUNITIES = ["grant", "fellowship", "rfp", "partnership"]


def opportunities(lines: DataFrame, line: str) -> DataFrame:
    """Lines '- [type] name — ..' with kind, name (up to the dash, else the first word) and deadline; other lines are dropped."""
    pattern = OPPORTUNITY
    t = F.trim(F.col(line))
    hint, rest = F.lower(F.regexp_extract(t, pattern, 1)), F.trim(F.regexp_extract(t, pattern, 2))
    kind = F.coalesce(*[F.when(F.contains(hint, F.lit(k)), F.lit(k)) for k in OPPORTUNITIES], F.lit("other"))
    name = F.when(F.contains(rest, F.lit("—")), F.trim(F.substring_index(rest, "—", 1))).otherwise(F.substring(rest, 1, 80))
    return lines.where(t.rlike(pattern)).withColumns({"kind": kind, "name": name, "deadline": F.coalesce(deadline(rest), deadline(t))})
