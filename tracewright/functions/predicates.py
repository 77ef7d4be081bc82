"""Screens and classifications of names, labels, flags and identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.text import bound


def truthy(value: Column) -> Column:
    return F.coalesce(F.lower(F.trim(value.cast("string"))).isin("1", "true", "yes", "y", "on"), F.lit(False))


def missing_as_true(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(True))


def name_or_alias_contains(name: Column, aliases: Column, part: str) -> Column:
    """Case-sensitive: the name or any alias holds ``part``."""
    return F.coalesce(F.contains(name, F.lit(part)), F.lit(False)) | F.coalesce(F.exists(aliases, lambda a: F.contains(a, F.lit(part))), F.lit(False))


def doubtful_name(name: Column) -> Column:
    """Under four characters, a single word, or characters that names rarely have."""
    t = F.trim(F.coalesce(name, F.lit("")))
    return (F.length(t) < 4) | (F.size(F.split(t, r"\s+")) == 1) | t.rlike(r"[^\p{L}\s.'’-]")


def similar_names(a: Column, b: Column) -> Column:
    """Equal in any case; two common words; or one, if neither has over two."""
    x, y = F.array_distinct(F.split(F.lower(F.trim(a)), r"\s+")), F.array_distinct(F.split(F.lower(F.trim(b)), r"\s+"))
    both = F.size(F.array_intersect(x, y))
    return (F.lower(a) == F.lower(b)) | (both >= 2) | ((both == 1) & (F.size(x) <= 2) & (F.size(y) <= 2))


def node_label(declared: Column, number: Column) -> Column:
    """A declared type by its usual names; otherwise by number: a legacy target from 1000, a person below."""
    t = F.regexp_replace(F.lower(F.trim(declared)), " ", "")
    default = F.when(number >= 1000, "InvestigationTarget").otherwise("Person")
    return F.when(t == "person", "Person").when(t == "topic", "Topic").when(t.isin("organization", "institution"), "Organization").when(t == "place", "Place").when(t.isin("investigationtarget", "target"), "InvestigationTarget").otherwise(default)


def risk_decision(text: Column) -> Column:
    """escalate before revise before approve, by the first of these words that the text holds; else revise."""
    t = F.lower(F.coalesce(text, F.lit("")))
    return F.when(F.contains(t, F.lit("escalate")), "escalate").when(F.contains(t, F.lit("revise")), "revise").when(F.contains(t, F.lit("approve")), "approve").otherwise("revise")


def case_anomaly(word: Column) -> Column:
    """0 where a quarter to three quarters of a word's letters are capitals; the further from a half, the nearer to 1."""
    def anomaly(n):
        ratio = n["upper"] / F.nullif(n["upper"] + n["lower"], F.lit(0))
        return F.when((F.length(word) < 2) | ratio.isNull() | ratio.between(0.25, 0.75), 0.0).otherwise(F.abs(ratio - 0.5) * 2)

    return bound(F.struct(F.regexp_count(word, F.lit(r"\p{Lu}")).alias("upper"), F.regexp_count(word, F.lit(r"\p{Ll}")).alias("lower")), anomaly)


def id_sort_key(identifier: Column, episode: Column) -> Column:
    """Struct to order by: number, part (none first), episode, text; identifiers of another form come last."""
    pattern = r"^[A-Za-z]+-(\d+)(?:\.(\d+))?$"
    number = F.nullif(F.regexp_extract(identifier, pattern, 1), F.lit("")).cast("long")
    part = F.nullif(F.regexp_extract(identifier, pattern, 2), F.lit("")).cast("long")
    last = F.lit(10**9).cast("long")
    return F.struct(F.coalesce(number, last).alias("number"), F.when(number.isNull(), last).otherwise(F.coalesce(part, F.lit(-1))).alias("part"), F.coalesce(episode, F.lit(0)).alias("episode"), identifier.alias("text"))


def episodes_of(spec: Column) -> Column:
    """Numbers of a list such as '1-3,5', each once and sorted; parts that are neither are left out; null if none is left (all)."""
    parts = F.transform(F.split(F.coalesce(spec, F.lit("")), ","), lambda x: F.regexp_replace(x, r"\s", ""))
    span = r"^(\d+)-(\d+)$"
    num = lambda x, p, i: F.regexp_extract(x, p, i).cast("int")
    listed = F.transform(F.filter(parts, lambda x: x.rlike(r"^\d+(-\d+)?$")), lambda x: F.when(x.rlike(span), F.sequence(F.least(num(x, span, 1), num(x, span, 2)), F.greatest(num(x, span, 1), num(x, span, 2)))).otherwise(F.array(num(x, r"^(\d+)$", 1))))
    found = F.array_sort(F.array_distinct(F.flatten(listed)))
    return F.when(F.size(found) > 0, found)


def in_episodes(rows: DataFrame, spec: str | None, column: str = "ep") -> DataFrame:
    """Rows of the episodes of a specification; an empty or invalid one keeps all."""
    wanted = episodes_of(F.lit(spec).cast("string"))
    return rows.where(F.coalesce(F.array_contains(wanted, F.col(column).cast("int")), wanted.isNull()))


# Labels that say nothing of a claim.
PLACEHOLDERS = [r"(?i)^claim\s*[-#]?\d*$", r"(?i)^c-\d+$", r"(?i)^(tbd|todo|n/?a|none|unknown)\.?$", r"(?i)^placeholder", r"^[\W_]+$"]


def placeholder_label(label: Column) -> Column:
    """Null, blank, or of a form of PLACEHOLDERS."""
    t = F.trim(F.coalesce(label, F.lit("")))
    out = t == ""
    for p in PLACEHOLDERS:
        out = out | t.rlike(p)
    return out


def risk_flags(text: Column, words: list[str]) -> Column:
    """Those of the words that a text holds in any case, in the given order."""
    t = F.lower(F.coalesce(text, F.lit("")))
    return F.filter(F.array(*[F.when(F.contains(t, F.lit(w)), F.lit(w)) for w in words]), lambda x: x.isNotNull())


def type_class(declared: Column) -> Column:
    """organization, place, topic or person of a declared type; legacy targets are topics, anything else a person."""
    t = F.regexp_replace(F.lower(F.trim(F.coalesce(declared, F.lit("")))), " ", "")
    return F.when(t.isin("institution", "organization"), "organization").when(t == "place", "place").when(t.isin("topic", "investigationtarget", "target"), "topic").otherwise("person")
