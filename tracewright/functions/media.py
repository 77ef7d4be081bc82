"""Addresses, clocks and identifiers of timed media, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A cue at the start of a line, and the addresses of a video.
CUE = r"^\[(\d{1,2}):(\d{2})(?::(\d{2}))?\]\s*(.*)$"
WATCH, EMBED = "https://www.youtube.com/watch?v=", "https://www.youtube.com/embed/"


def strict_seconds(text: Column) -> Column:
    """Seconds of a whole MM:SS or H:MM:SS; null for any other text."""
    parts = F.split(text, ":")
    n = lambda i: F.element_at(parts, i).cast("long")
    good = F.when(text.rlike(r"^\d+:\d+:\d+$"), n(1) * 3600 + n(2) * 60 + n(3))
    return good.when(text.rlike(r"^\d+:\d+$"), n(1) * 60 + n(2))


def cue_seconds(line: Column) -> Column:
    """Seconds of a line's leading cue, two groups or three; null without one."""
    g = lambda i: F.regexp_extract(line, CUE, i)
    long = g(3) != ""
    value = F.when(long, g(1).cast("long") * 3600 + g(2).cast("long") * 60 + g(3).cast("long")).otherwise(g(1).cast("long") * 60 + g(2).cast("long"))
    return F.when(line.rlike(CUE), value)


def line_body(line: Column) -> Column:
    """What follows a line's cue; the whole line, trimmed, without one."""
    return F.trim(F.when(line.rlike(CUE), F.regexp_extract(line, CUE, 4)).otherwise(line))


def padded_clock(seconds: Column) -> Column:
    """MM:SS, or HH:MM:SS from one hour."""
    h, m, s = (F.floor(x).cast("int") for x in (seconds / 3600, seconds % 3600 / 60, seconds % 60))
    return F.when(h > 0, F.format_string("%02d:%02d:%02d", h, m, s)).otherwise(F.format_string("%02d:%02d", m, s))


def watch_url(video: Column, seconds: Column) -> Column:
    t = F.greatest(F.coalesce(seconds, F.lit(0)), F.lit(0)).cast("string")
    return F.when(F.coalesce(seconds, F.lit(0)) > 0, F.concat(F.lit(WATCH), video, F.lit("&t="), t, F.lit("s"))).otherwise(F.concat(F.lit(WATCH), video))


def embed_url(video: Column, seconds: Column) -> Column:
    start = F.concat(F.lit(EMBED), video, F.lit("?start="), seconds.cast("string"), F.lit("&autoplay=0"))
    return F.when(F.coalesce(seconds, F.lit(0)) > 0, start).otherwise(F.concat(F.lit(EMBED), video, F.lit("?autoplay=0")))


def dom_id(label: Column, index: Column) -> Column:
    return F.concat(F.lit("h-"), F.regexp_replace(F.concat_ws("__", label, index.cast("string")), "[^A-Za-z0-9_-]", "-"))


def hunk_key(key: Column) -> Column:
    """(first, last, op) of a key with __c1-2__op__; null where it has none."""
    pattern = r"__c(\d+)-(\d+)__([a-z]+)__"
    g = lambda i: F.regexp_extract(key, pattern, i)
    return F.when(key.rlike(pattern), F.struct(g(1).cast("int").alias("first"), g(2).cast("int").alias("last"), g(3).alias("op")))


def note_date(kind: Column, stem: Column, properties: Column, changed: Column) -> Column:
    """Date of a note: a journal's name, else the first dated property, else the day it was changed."""
    # The properties that may hold a date, in order.
    keys = ["created_at", "created", "date", "updated_at", "updated"]
    day = r"(\d{4})[-_](\d{2})[-_](\d{2})"
    by_name = F.when((kind == "journal") & stem.rlike("^" + day), F.regexp_replace(F.regexp_extract(stem, "^" + day, 0), "_", "-"))
    dated = [F.nullif(F.regexp_extract(F.element_at(properties, F.lit(k)), r"\d{4}-\d{2}-\d{2}", 0), F.lit("")) for k in keys]
    return F.coalesce(by_name, *dated, F.date_format(changed, "yyyy-MM-dd"))


def source_type(path: Column) -> Column:
    """Kind of a knowledge file by its path."""
    p = F.lower(path)
    has = lambda x: F.contains(p, F.lit(x))
    return F.when(has("/book/"), "book").when(has("/transcripts/"), "transcript").when(has("/notes/"), "notes").when(has("report"), "report").otherwise("document")


def command(text: Column) -> Column:
    """(name, rest) of a chat command: the first word without slash and without the bot's name, lower-cased."""
    first = F.substring_index(F.trim(text), " ", 1)
    rest = F.trim(F.regexp_replace(F.trim(text), r"^\S+", ""))
    return F.struct(F.lower(F.regexp_replace(F.substring_index(first, "@", 1), "^/", "")).alias("name"), rest.alias("rest"))


def suffix_list(raw: Column) -> Column:
    """Suffixes of a comma list: trimmed, blank ones dropped, each of at most 64 characters, the first eight."""
    parts = F.transform(F.split(F.coalesce(raw, F.lit("")), ","), lambda x: F.substring(F.trim(x), 1, 64))
    return F.slice(F.filter(parts, lambda x: x != ""), 1, 8)


def bypasses_guard(char: Column) -> Column:
    """White space, ASCII punctuation and symbols, or any Unicode punctuation."""
    return F.coalesce(char.rlike(r"^[\s\p{P}$+<=>^`|~]"), F.lit(False))
