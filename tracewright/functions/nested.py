"""Nested and JSON values as Column functions: recovery, defaults, checks, merges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def recovered_json(text: Column, schema: str) -> Column:
    """The first object in a text as a struct: reasoning tags and code fences go, curly quotes become straight; null if none parses."""
    plain = F.regexp_replace(F.regexp_replace(text, "(?is)<think>.*?</think>", ""), "```(?:json)?", "")
    return F.from_json(F.nullif(F.regexp_extract(F.translate(plain, "“”‘’", "\"\"''"), r"(?s)(\{.*\})", 1), F.lit("")), schema)


def as_list(value: Column) -> Column:
    """A scalar as a list of one, JSON list text as its items; blank gives an empty list."""
    listed = F.from_json(value, "array<string>")
    empty = F.array().cast("array<string>")
    return F.when(F.trim(F.coalesce(value, F.lit(""))) == "", empty).when(F.trim(value).startswith("["), F.coalesce(listed, empty)).otherwise(F.array(F.trim(value)))


def merged_metadata(old: Column, new: Column) -> Column:
    """Maps merged; a null in ``new`` takes its key away."""
    kept = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k))
    return F.map_filter(F.map_concat(kept, new), lambda _, v: v.isNotNull())


def front_matter(text: Column) -> Column:
    """key: value lines between the leading --- lines, as a map of trimmed strings."""
    body = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---", 1)
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"^\w[\w -]*:"))
    return F.map_from_entries(F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)), F.trim(F.regexp_replace(x, "^[^:]*:", "")))))


def rule_errors(checks: dict[str, Column]) -> Column:
    """Names of the checks that do not hold (null counts as not), in the order given."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]), lambda x: x.isNotNull())


def without_thinking(text: Column, rounds: int = 12) -> Column:
    """A text without <think> .. </think> parts, the innermost first, until none is left or after so many rounds; a tag left alone goes too."""
    inner = r"(?is)<think>(?:(?!</?think>).)*</think>"
    pared = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), text, lambda t, _: F.regexp_replace(t, inner, ""))
    return F.trim(F.regexp_replace(pared, r"(?i)</?think>", ""))


def inserted_after(text: Column, marker: str, line: Column) -> Column:
    """A text with a line after the first line that is the marker; at its end if it has none."""
    at = F.concat(F.lit("\n"), text, F.lit("\n"))
    mark = F.lit(f"\n{marker}\n")
    place = F.instr(at, mark)
    cut = place + F.length(mark) - 1
    put = F.concat(F.substr(at, F.lit(2), cut - 1), line, F.lit("\n"), F.substr(at, cut + 1))
    return F.when(place > 0, F.regexp_replace(put, r"\n\z", "")).otherwise(F.concat_ws("\n", text, line))


#: Common character references; the ampersand comes last, so that it makes no other.
REFERENCES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def plain_title(html: Column, references: tuple[tuple[str, str], ...] = REFERENCES) -> Column:
    """Text of a piece of HTML: tags gone, the given character references read, white space as one space."""
    out = F.regexp_replace(html, r"(?s)<[^>]*>", " ")
    for ref, char in references:
        out = F.replace(out, F.lit(ref), F.lit(char))
    return F.trim(F.regexp_replace(out, r"\s+", " "))
