"""Identifiers of documents: assignment in order, reuse by name, reference maps, rewriting, highest numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.plans.ranks import running

# The prefix of each counter, and where it starts.
COUNTERS = {"family": ("A", 1000), "claim": ("C", 1000), "matter": ("LM", 1000), "person": ("N", 1), "target": ("N", 1000)}


def bumped(start: dict[str, int], registry: DataFrame) -> dict[str, int]:
    """Counters moved past the numbers that the registry's node ids have.

    A number belongs to the ``counter`` (person or target) that the registry names, where it has that
    column and value; else those from 1000 are targets.
    """
    n = F.regexp_extract("id", r"^N-(\d+)$", 1).cast("long")
    by_number = F.when(n < 1000, "person").otherwise("target")
    counter = F.coalesce("counter", by_number) if "counter" in registry.columns else by_number
    tops = registry.select(n.alias("n"), counter.alias("counter")).agg(*[F.max(F.when(F.col("counter") == c, F.col("n"))).alias(c) for c in ("person", "target")])
    top = tops.first()
    return {k: max(v, (top[k] or 0) + 1) if k in ("person", "target") else v for k, v in start.items()}


def assigned(items: DataFrame, registry: DataFrame | None = None, start: dict[str, int] | None = None, reuse: bool = True) -> DataFrame:
    """``items`` (ep, pos, counter, ref, bucket, name, ..) plus ``new_id``, counted up by counter in the order of (ep, pos).

    With ``reuse`` a node's name that came before in its bucket, or stands in the registry
    (bucket, name, id, and counter if ids do not tell it by number), keeps its id; names are compared
    as they are, blank ones never. Counters begin at ``start``, past the registry.
    """
    begin = {k: v for k, (_, v) in COUNTERS.items()} | (start or {})
    node = F.col("counter").isin("person", "target") & (F.coalesce("name", F.lit("")) != "") & F.lit(reuse)
    rows = items.withColumn("__k", F.when(node, F.struct("bucket", "name")))
    if registry is not None:
        begin = bumped(begin, registry)
        known = registry.groupBy(F.struct("bucket", "name").alias("__k")).agg(F.max("id").alias("__id"))
        rows = rows.join(known, "__k", "left")
    else:
        rows = rows.withColumn("__id", F.lit(None).cast("string"))
    first = rows.where("__k is not null and __id is null").groupBy("__k").agg(F.min(F.struct("ep", "pos")).alias("__first"))
    rows = rows.join(first, "__k", "left").withColumn("__new", F.col("__id").isNull() & (F.col("__k").isNull() | (F.struct("ep", "pos") == F.col("__first"))))
    counts = {f"__n_{c}": ("sum", (F.col("__new") & (F.col("counter") == c)).cast("long")) for c in COUNTERS}
    rows = running(rows, ["ep", "pos"], **counts)
    number = F.lit(None).cast("string")
    for c, (prefix, _) in COUNTERS.items():
        number = F.when(F.col("counter") == c, F.concat(F.lit(f"{prefix}-"), (F.col(f"__n_{c}") + begin[c] - 1).cast("string"))).otherwise(number)
    rows = rows.withColumn("__given", F.when(F.col("__new"), number))
    named = rows.where("__new and __k is not null").select(F.col("__k"), F.col("__given").alias("__same"))
    out = rows.join(named, "__k", "left")
    return out.select(*items.columns, F.coalesce("__id", "__given", "__same").alias("new_id"))


def mapped_lists(docs: DataFrame, keys: list[str], column: str, mapping: DataFrame, on: list[str]) -> DataFrame:
    """``docs`` with every reference of a list replaced by its id of ``mapping`` (.., ref, id), itself where it has none; order stays."""
    each = docs.select(*keys, F.posexplode_outer(column).alias("__at", "ref")).join(mapping.select(*on, "ref", "id"), [*on, "ref"], "left")
    lists = each.where("__at is not null").groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__at", F.coalesce("id", "ref").alias("v")))), lambda x: x["v"]).alias("__list"))
    return docs.join(lists, keys, "left").withColumn(column, F.coalesce("__list", column)).select(docs.columns)


def resolved_lists(docs: DataFrame, keys: list[str], column: str, mapping: DataFrame, known: DataFrame) -> DataFrame:
    """(keys, column): references as ids, only those that ``known`` (id) has, each once, in the order of their first place."""
    each = docs.select(*keys, F.posexplode(column).alias("__at", "ref")).join(mapping.select("ref", "id"), "ref", "left")
    each = each.select(*keys, "__at", F.coalesce("id", "ref").alias("id")).join(known.select("id").distinct(), "id", "left_semi")
    first = each.groupBy(*keys, "id").agg(F.min("__at").alias("__at"))
    return first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__at", "id"))), lambda x: x["id"]).alias(column))


def rewritten(text: Column, refs: Column) -> Column:
    """Whole words of ``refs`` (structs of ref and id) replaced, the longest reference first."""
    order = F.transform(F.array_sort(F.transform(refs, lambda r: F.struct((-F.length(r["ref"])).alias("n"), r["ref"].alias("ref"), r["id"].alias("id")))), lambda x: F.struct(x["ref"], x["id"]))
    return F.aggregate(order, text, lambda t, r: F.regexp_replace(t, F.concat(F.lit(r"\b\Q"), r["ref"], F.lit(r"\E\b")), r["id"]))


def highest(texts: DataFrame, text: str) -> DataFrame:
    """(kind, n): the greatest number of each kind of identifier in the texts; node numbers part at 1000."""
    each = texts.select(F.explode(F.regexp_extract_all(text, F.lit(r"\b(?:A|C|N|LM)-\d+"), 0)).alias("id"))
    n = F.regexp_extract("id", r"-(\d+)$", 1).cast("long")
    kind = F.when(F.col("id").startswith("A-"), "family").when(F.col("id").startswith("C-"), "claim").when(F.col("id").startswith("LM-"), "matter").when(n < 1000, "person").otherwise("target")
    return each.select(kind.alias("kind"), n.alias("n")).groupBy("kind").agg(F.max("n").alias("n"))


def registry_keys(nodes: DataFrame) -> DataFrame:
    """(bucket, name, id) of canonical names and aliases, normalised; of equal keys the last id in string order holds."""
    names = nodes.select("bucket", "id", F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"))
    names = names.select("bucket", "id", F.trim(F.regexp_replace(F.lower("name"), r"\s+", " ")).alias("name")).where("name <> ''")
    return names.groupBy("bucket", "name").agg(F.max("id").alias("id"))
