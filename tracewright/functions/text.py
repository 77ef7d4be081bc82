"""Text as Column functions: names, lists, clocks, patterns, folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_name(name: Column) -> Column:
    """Lower case, runs of white space as one space, trimmed; null stays null."""
    return F.trim(F.regexp_replace(F.lower(name), r"\s+", " "))


#: Characters whose upper case is several characters, and the one that stands for each by itself: its title case, or it stays.
_SEVERAL = "".join(c for c in map(chr, range(0x10000)) if len(c.upper()) > 1)
_ALONE = "".join("ẞ" if c == "ß" else c.title() if len(c.title()) == 1 else c for c in _SEVERAL)


def upper_each(text: Column) -> Column:
    """Upper case character by character, so that a text keeps its length: of ß comes ẞ and not SS."""
    one = lambda c: F.when(F.instr(F.lit(_SEVERAL), c) > 0, F.translate(c, _SEVERAL, _ALONE)).otherwise(F.upper(c))
    return F.array_join(F.transform(F.split(text, ""), one), "")


def id_list(text: Column) -> Column:
    """Identifiers of a comma list: trimmed, ``same_as:`` taken off, only well-formed ones kept."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.regexp_replace(F.trim(x), "^same_as:", ""))
    return F.filter(parts, lambda x: x.rlike(r"^[A-Z]+-\d+(\.\d+)?$"))


def clock_seconds(text: Column) -> Column:
    """Seconds of the first H:MM:SS, else M:SS, in a text; null without one."""
    three, two = r"(\d+):(\d\d):(\d\d)", r"(\d+):(\d\d)"
    part = lambda p, i: F.regexp_extract(text, p, i).cast("int")
    long = part(three, 1) * 3600 + part(three, 2) * 60 + part(three, 3)
    return F.when(text.rlike(three), long).when(text.rlike(two), part(two, 1) * 60 + part(two, 2))


def clock_text(seconds: Column) -> Column:
    """M:SS, or H:MM:SS from one hour."""
    h, m, s = F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), seconds % 60
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.when(h > 0, F.concat(h.cast("string"), F.lit(":"), two(m), F.lit(":"), two(s))).otherwise(F.concat(m.cast("string"), F.lit(":"), two(s)))


def fold_replace(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements one after the other: a later rule sees what an earlier one wrote."""
    for find, put in rules:
        text = F.replace(text, F.lit(find), F.lit(put))
    return text


def fold_regex(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    for pattern, put in rules:
        text = F.regexp_replace(text, pattern, put)
    return text


def occurrences(text: Column, find: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(find), F.lit("")))) / len(find)).cast("long")


def nth_replace(text: Column, find: str, put: str, n: int) -> Column:
    """The n-th occurrence (from 0; -1: all) of a literal replaced; fewer leave the text as it is."""
    if n < 0:
        return F.replace(text, F.lit(find), F.lit(put))
    parts = F.split(text, r"\Q" + find + r"\E", -1)
    cut = F.concat(F.array_join(F.slice(parts, 1, n + 1), find), F.lit(put), F.array_join(F.slice(parts, n + 2, 1 << 30), find))
    return F.when(occurrences(text, find) > n, cut).otherwise(text)


def keywords(text: Column, stop: Sequence[str], n: int = 10) -> Column:
    """The first ``n`` words of three or more ASCII letters that are no stop words, lower-cased."""
    words = F.transform(F.regexp_extract_all(text, F.lit("[a-zA-Z]{3,}"), 0), lambda x: F.lower(x))
    return F.slice(F.filter(words, lambda x: ~x.isin(list(stop))), 1, n)


def truncated(text: Column, n: int) -> Column:
    """Trimmed, null if blank, cut to ``n`` characters with an ellipsis."""
    t = F.trim(text)
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n - 1), F.lit("…"))).when(F.length(t) > 0, t)


def ical_escape(text: Column) -> Column:
    """Backslash, semicolon, comma and newline escaped for a calendar file."""
    for find, put in (("\\", "\\\\"), (";", "\\;"), (",", "\\,"), ("\n", "\\n")):
        text = F.replace(text, F.lit(find), F.lit(put))
    return text


def confidence_rank(value: Column) -> Column:
    """high 3, medium 2, low 1, else 0; case does not matter."""
    v = F.lower(F.trim(value))
    return F.when(v == "high", 3).when(v.isin("medium", "med"), 2).when(v == "low", 1).otherwise(0)


#: Widths of the passes of ``prefix_sums``; they reach over two thousand million numbers.
_PASSES = [1 << k for k in range(31)]


def prefix_sums(numbers: Column) -> Column:
    """The sum of the numbers up to each, itself included.

    Each pass adds what stands 1, 2, 4 .. places before, so n numbers take log n passes and no list
    is copied for each number.
    """
    def one(a, d):
        return F.zip_with(a, F.concat(F.array_repeat(F.lit(0).cast("long"), d), F.slice(a, F.lit(1), F.size(a) - d)), lambda x, y: x + y)

    passes = lambda n: F.filter(F.array(*map(F.lit, _PASSES)), lambda d: d < n)
    return bound(numbers.cast("array<bigint>"), lambda a: F.aggregate(bound(F.size(a), passes), a, one))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def match_places(text: Column, pattern: Column | str) -> Column:
    """(start, match) of every match from the left, 0-based; the text is split and searched once, in time linear in the matches but for a logarithm."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    lengths = lambda c: F.transform(c, lambda x: F.length(x))

    def placed(p):
        gaps = F.slice(p["parts"], F.lit(1), F.size(p["found"]))
        ends = prefix_sums(F.zip_with(lengths(gaps), lengths(p["found"]), lambda x, y: x + y))
        return F.zip_with(ends, p["found"], lambda e, m: F.struct((e - F.length(m)).cast("int").alias("start"), m.alias("match")))

    return bound(F.struct(F.split(text, pattern, -1).alias("parts"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("found")), placed)
