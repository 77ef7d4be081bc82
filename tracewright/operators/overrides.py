"""Queued text overrides: guarded literal edits, edits at an offset, limited counts, sanity of corrections."""

from __future__ import annotations

import re

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def literal_pattern(find: str, not_followed_by: tuple[str, ...] = (), boundary_after: bool = False) -> str:
    """A Java pattern for a literal that no given suffix follows (in any case), and, if asked, that ends at white space, punctuation or the end."""
    guard = "".join(rf"(?!(?i:{re.escape(s)}))" for s in not_followed_by)
    return rf"\Q{find}\E{guard}" + (r"(?=[\s\p{P}\p{S}]|\z)" if boundary_after else "")


def replace_limited(text: Column, pattern: str, put: str, most: int | None = None) -> tuple[Column, Column]:
    """(text, count): matches of ``pattern`` replaced from the left, at most ``most`` of them."""
    found = F.regexp_count(text, F.lit(pattern))
    plain = put.replace("\\", "\\\\").replace("$", "\\$")
    if most is None:
        return F.regexp_replace(text, pattern, plain), found
    parts = F.split(text, pattern, most + 1)
    cut = F.array_join(parts, put)
    return F.when(found > 0, cut).otherwise(text), F.least(found, F.lit(most))


def replace_at(text: Column, offset: Column, find: Column, put: Column) -> Column:
    """``find`` replaced if it stands at the 0-based ``offset``; otherwise the text as it is."""
    there = (offset >= 0) & (F.length(find) > 0) & (F.substr(text, offset + 1, F.length(find)) == find)
    return F.when(there, F.overlay(text, put, offset + 1, F.length(find))).otherwise(text)


def sane_correction(wrong: Column, right: Column) -> Column:
    """False for a correction far longer than what it corrects, or that stutters a three-word phrase four times.

    Fixed values: over 100 characters and five times the wrong text; from nine words on, a phrase of
    eight characters or more met four times.
    """
    w, r = F.trim(F.coalesce(wrong, F.lit(""))), F.trim(F.coalesce(right, F.lit("")))
    words = F.split(F.lower(r), r"\s+")
    triples = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 2, F.lit(1))), lambda i: F.array_join(F.slice(words, i, F.lit(3)), " "))
    low = F.lower(r)
    stutter = F.exists(triples, lambda t: (F.length(t) >= 8) & ((F.length(low) - F.length(F.replace(low, t, F.lit("")))) / F.length(t) >= 4))
    return ~((F.length(r) > F.greatest(F.lit(100), F.length(w) * 5)) | ((F.size(words) >= 9) & stutter))


def apply_by_document(docs: DataFrame, rules: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text, applied): each document's own literal rules (id, priority, find, put) folded in order of priority."""
    queue = rules.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("priority", "find", "put"))).alias("rules"))
    both = docs.select(id_col, text).join(queue, id_col, "left").withColumn("rules", F.coalesce("rules", F.array().cast(queue.schema["rules"].dataType)))
    start = F.struct(F.col(text).alias("text"), F.lit(0).alias("applied"))
    step = lambda a, r: F.struct(F.replace(a["text"], r["find"], r["put"]).alias("text"), (a["applied"] + F.contains(a["text"], r["find"]).cast("int")).alias("applied"))
    return both.select(id_col, F.aggregate("rules", start, step).alias("x")).select(id_col, F.col("x.text").alias(text), "x.applied")


def load_rules(spark, path: str, most: int = 10_000) -> list[tuple[str, str]]:
    """(pattern, replacement) rules of a JSON store (seq, pattern, repl), in order; those that are no expression are dropped.

    Rules stand in the plan, so a store of more than ``most`` is an error.
    """
    rows = spark.read.schema("seq int, pattern string, repl string").json(path).orderBy("seq").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rules")
    good = []
    for r in rows:
        try:
            spark._jvm.java.util.regex.Pattern.compile(r.pattern)
        except IllegalArgumentException:
            continue
        good.append((r.pattern, r.repl or ""))
    return good


def counted_rules(text: Column, rules: list[tuple[str, str]]) -> tuple[Column, list[Column]]:
    """(text, counts): rules applied in order, and how often each matched what it was given."""
    counts = []
    for pattern, put in rules:
        counts.append(F.regexp_count(text, F.lit(pattern)))
        text = F.regexp_replace(text, pattern, put)
    return text, counts
