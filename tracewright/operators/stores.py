"""Mutable stores as DataFrames: merges, cascades, corrections, registries, reviews, calendars, ledgers, caches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merged(old: DataFrame, new: DataFrame, keys: Sequence[str], now: Column, create_only: Sequence[str] = ()) -> DataFrame:
    """``old`` with ``new`` by key: a created row takes all values and created_at, a matched one all but ``create_only`` and updated_at."""
    rest = [c for c in old.columns if c not in (*keys, "created_at", "updated_at")]
    n = new.select(*keys, *[F.col(c).alias(f"__{c}") for c in rest], F.lit(True).alias("__new"))
    both = old.withColumn("__old", F.lit(True)).join(n, list(keys), "full_outer")
    value = lambda c: F.when(F.col("__old").isNull(), F.col(f"__{c}")).when(F.lit(c in create_only), F.col(c)).otherwise(F.coalesce(f"__{c}", c)).alias(c)
    created = F.when(F.col("__old").isNull(), now).otherwise(F.col("created_at"))
    updated = F.when(F.col("__old") & F.col("__new"), now).otherwise(F.col("updated_at"))
    return both.select(*keys, *[value(c) for c in rest], created.alias("created_at"), updated.alias("updated_at"))


def reset(nodes: DataFrame, edges: DataFrame, keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Nodes of the labels in ``keep``, and the edges between them: the graph emptied of all else."""
    left = nodes.where(F.col("label").isin(*keep))
    ids = left.select("id").distinct()
    kept = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    return left, kept.select(edges.columns)


def cleared(sources: DataFrame, contains: DataFrame, emerges: DataFrame, tagged: DataFrame, prefix: str) -> DataFrame:
    """(kind, id) of what goes with the sources of a prefix: they, their chunks, what emerges from them alone, and tags that no other chunk has."""
    gone = sources.where(F.startswith("id", F.lit(prefix))).select("id")
    chunks = contains.join(gone.withColumnRenamed("id", "source"), "source", "left_semi").select(F.col("chunk").alias("id")).distinct()
    from_gone = emerges.join(gone.withColumnRenamed("id", "source"), "source", "left_semi").select("item").distinct()
    from_kept = emerges.join(gone.withColumnRenamed("id", "source"), "source", "left_anti").select("item").distinct()
    items = from_gone.join(from_kept, "item", "left_anti").select(F.col("item").alias("id"))
    used = tagged.join(chunks.withColumnRenamed("id", "chunk"), "chunk", "left_anti").select("tag").distinct()
    tags = tagged.select("tag").distinct().join(used, "tag", "left_anti").select(F.col("tag").alias("id"))
    named = lambda df, kind: df.select(F.lit(kind).alias("kind"), "id")
    return named(gone, "source").union(named(chunks, "chunk")).union(named(items, "item")).union(named(tags, "tag"))


def nodes_merged(nodes: DataFrame, edges: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) after ``mapping`` (id, into): merged nodes go, their names become aliases of what they went into, edges move; repeated edges and those of a node to itself go.

    ``nodes`` have (id, name, aliases); an alias that the node has, or its own name, is not added.
    """
    m = mapping.where("id <> into")
    more = nodes.join(m, "id").groupBy("into").agg(F.flatten(F.array_sort(F.collect_list(F.struct("id", F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))).alias("names"))))["names"]).alias("more"))
    left = nodes.join(m.select("id"), "id", "left_anti").join(more.withColumnRenamed("into", "id"), "id", "left")
    none = F.array().cast("array<string>")
    names = F.array_remove(F.array_distinct(F.concat(F.coalesce("aliases", none), F.coalesce("more", none))), F.col("name"))
    moved = edges
    for side in ("src", "dst"):
        moved = moved.join(m.select(F.col("id").alias(side), "into"), side, "left").withColumn(side, F.coalesce("into", side)).drop("into")
    return left.select("id", "name", names.alias("aliases")), moved.where("src <> dst").select(edges.columns).distinct()


def imported_corrections(names: DataFrame, known: DataFrame) -> DataFrame:
    """(wrong, right) from verified names (name, verified, aliases): the name where its verified spelling differs, and every alias; those of ``known`` (wrong) stay as they are."""
    own = names.where("verified is not null and verified <> name").select(F.col("name").alias("wrong"), F.col("verified").alias("right"))
    other = names.select(F.explode("aliases").alias("wrong"), F.coalesce("verified", "name").alias("right")).where("wrong <> right")
    return own.union(other).join(known.select("wrong"), "wrong", "left_anti").groupBy("wrong").agg(F.min("right").alias("right")).select("wrong", "right")


def removed(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """(kept, removed): how many rows stay and go when the keys of ``gone`` are deleted."""
    marked = rows.join(gone.select(key).distinct().withColumn("__gone", F.lit(1)), key, "left")
    return marked.agg(F.count_if(F.col("__gone").isNull()).alias("kept"), F.count_if(F.col("__gone").isNotNull()).alias("removed"))


def resolved_cases(nodes: DataFrame, decisions: DataFrame) -> DataFrame:
    """``nodes`` (id, name, aliases) after decisions (id, action, value): approve adds the value as an alias, edit renames and keeps the old name as one, deny changes nothing.

    Edits hold over approvals; of several the least value in string order.
    """
    d = decisions.groupBy("id").agg(F.min(F.when(F.col("action") == "edit", F.col("value"))).alias("rename"), F.array_sort(F.collect_set(F.when(F.col("action") == "approve", F.col("value")))).alias("more"))
    both = nodes.join(d, "id", "left")
    none = F.array().cast("array<string>")
    name = F.coalesce("rename", "name")
    old = F.when(F.col("rename") != F.col("name"), F.array("name")).otherwise(none)
    names = F.array_except(F.array_distinct(F.concat(F.coalesce("aliases", none), F.coalesce("more", none), F.coalesce(old, none))), F.array(name))
    return both.select("id", name.alias("name"), names.alias("aliases"))


def learned(log: DataFrame) -> DataFrame:
    """(name, into, denied) from a log (at, name, action, into): what was decided last about each name in any letter case."""
    w = Window.partitionBy(F.lower("name")).orderBy(F.desc("at"))
    last = log.withColumn("r", F.row_number().over(w)).where("r = 1")
    return last.select(F.lower("name").alias("name"), F.when(F.col("action") != "deny", F.col("into")).alias("into"), (F.col("action") == "deny").alias("denied"))


def added_terms(registry: DataFrame, terms: DataFrame, prefix: str = "M-", first: int = 1000) -> DataFrame:
    """Terms (pos, term) that no entry (id, term, aliases) has as its term or an alias in any case, each once, with ids counted on."""
    from tracewright.plans.ranks import global_rank

    there = registry.select(F.explode(F.concat(F.array("term"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("k")).select(F.lower("k").alias("k")).distinct()
    fresh = terms.withColumn("k", F.lower(F.trim("term"))).where("k <> ''").join(there, "k", "left_anti").groupBy("k").agg(F.min(F.struct("pos", "term")).alias("x"))
    top = registry.agg(F.max(F.regexp_extract("id", r"-(\d+)$", 1).cast("long"))).first()[0]
    start = first if top is None else top + 1
    ranked = global_rank(fresh.select(F.col("x.pos").alias("pos"), F.col("x.term").alias("term")), "pos", "term", name="n")
    return ranked.select(F.concat(F.lit(prefix), (F.col("n") + start).cast("string")).alias("id"), "term")


def reviewed(items: DataFrame, actions: DataFrame) -> DataFrame:
    """``items`` (id, status, n_flags) after actions (id, at, action): flags count up, and the last of approve, flag, promote is the status."""
    named = F.when(F.col("action") == "approve", "approved").when(F.col("action") == "flag", "flagged").when(F.col("action") == "promote", "promoted")
    done = actions.withColumn("to", named).where("to is not null").groupBy("id").agg(F.max_by("to", "at").alias("to"), F.count_if(F.col("action") == "flag").alias("flags"))
    return items.join(done, "id", "left").select("id", F.coalesce("to", "status").alias("status"), (F.col("n_flags") + F.coalesce("flags", F.lit(0))).alias("n_flags"))


def patched(rows: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``rows`` after changes of map columns (key, patch): a value sets its field, a null takes it away; unknown keys are added, an empty patch deletes the row."""
    both = rows.join(changes, key, "full_outer")
    none = F.create_map().cast("map<string,string>")
    old, patch = F.coalesce("fields", none), F.coalesce("patch", none)
    kept = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(patch), k))
    out = F.map_filter(F.map_concat(kept, patch), lambda _, v: v.isNotNull())
    return both.where("patch is null or size(patch) > 0").select(key, out.alias("fields"))


def ledger_upserted(ledger: DataFrame, entries: DataFrame, now: Column) -> DataFrame:
    """``ledger`` (id, name, kind, added_at) after entries (name, kind, status): by name in any case; a known entry keeps its id and added_at, submitted ones are not added, of equal names the first in order comes in."""
    e = entries.withColumn("k", F.lower(F.trim("name"))).where("k <> '' and coalesce(status, '') <> 'submitted'")
    e = e.groupBy("k").agg(F.min(F.struct("name", "kind")).alias("x")).select("k", "x.*")
    both = ledger.withColumn("k", F.lower(F.trim("name"))).alias("l").join(e.alias("e"), "k", "full_outer")
    made = F.concat_ws("_", "e.kind", F.substring(F.sha2("k", 256), 1, 8))
    return both.select(F.coalesce("l.id", made).alias("id"), F.coalesce("l.name", "e.name").alias("name"), F.coalesce("e.kind", "l.kind").alias("kind"), F.coalesce("l.added_at", now).alias("added_at"))


def cache_merged(cache: DataFrame, fresh: DataFrame) -> DataFrame:
    """``cache`` (state, url, title) after a fetch: published and scheduled posts are those of ``fresh``, drafts are added by url and stay."""
    drafts = cache.where("state = 'draft'")
    new = fresh.where("state = 'draft'").join(drafts.select("url"), "url", "left_anti").select(cache.columns).dropDuplicates(["url"])
    return fresh.where("state <> 'draft'").select(cache.columns).union(drafts).union(new)


def synced_schedule(events: DataFrame, drafts: DataFrame) -> DataFrame:
    """(draft_id, day, title, outcome): drafts with a day as calendar events, those there updated, those without a day deleted."""
    both = events.select("draft_id", F.col("day").alias("old_day"), F.col("title").alias("old_title")).join(drafts, "draft_id", "full_outer")
    outcome = F.when(F.col("title").isNull(), "kept").when(F.col("day").isNull() & F.col("old_day").isNotNull(), "deleted").when(F.col("old_day").isNull(), "inserted").when((F.col("old_day") != F.col("day")) | (F.col("old_title") != F.col("title")), "updated").otherwise("kept")
    return both.where("day is not null or old_day is not null").select("draft_id", F.coalesce("day", "old_day").alias("day"), F.coalesce("title", "old_title").alias("title"), outcome.alias("outcome"))


def hash_sync(metas: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc, sha, changed): the digest of each document's text, and whether the stored one (doc, sha) differs or is missing."""
    now = texts.select("doc", F.sha2("text", 256).alias("now"))
    return metas.join(now, "doc").select("doc", F.col("now").alias("sha"), (~F.col("sha").eqNullSafe(F.col("now"))).alias("changed"))


def acknowledged(state: DataFrame, part: str) -> DataFrame:
    """``state`` (id, title, acked) with those whose title holds ``part`` in any case acknowledged."""
    return state.withColumn("acked", F.col("acked") | F.contains(F.lower("title"), F.lit(part.lower())))


def tiered(tiers: Sequence[DataFrame], key: str) -> DataFrame:
    """The rows of each key in the first of the tiers that has it; ``tier`` counts them from 0."""
    out = None
    for n, rows in enumerate(tiers):
        each = rows.withColumn("tier", F.lit(n))
        out = each if out is None else out.unionByName(each)
    best = out.groupBy(key).agg(F.min("tier").alias("tier"))
    return out.join(best, [key, "tier"], "left_semi")


def nth_links(lines: DataFrame, pattern: str, numbered_after: bool = True) -> DataFrame:
    """(doc, episode, video): the n-th line with a link is episode n; or, before the filter, the n-th line that is no comment."""
    kept = lines.where((F.trim("line") != "") & ~F.trim(F.col("line")).startswith("#"))
    video = F.nullif(F.regexp_extract("line", pattern, 1), F.lit(""))
    order = Window.partitionBy("doc").orderBy("line_no")
    rows = kept.withColumn("video", video)
    rows = rows.where("video is not null") if numbered_after else rows
    return rows.withColumn("episode", F.row_number().over(order)).where("video is not null").select("doc", "episode", "video")


def greedy_batches(texts: Column, most: int) -> Column:
    """Texts in order joined to batches by newlines: a batch ends before the text that would take it past ``most`` characters."""
    begin = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"))

    def step(a, t):
        over = (F.length(a["now"]) > 0) & (F.length(a["now"]) + F.length(t) + 1 > most)
        joined = F.when(F.length(a["now"]) > 0, F.concat(a["now"], F.lit("\n"), t)).otherwise(t)
        return F.struct(F.when(over, F.array_append(a["done"], a["now"])).otherwise(a["done"]).alias("done"), F.when(over, t).otherwise(joined).alias("now"))

    return F.aggregate(texts, begin, step, lambda a: F.when(F.length(a["now"]) > 0, F.array_append(a["done"], a["now"])).otherwise(a["done"]))


def majority_spelling(names: DataFrame, seen: DataFrame) -> DataFrame:
    """(name, best): the spelling met most often with the same first word and another last word, in any case; ties by spelling.

    ``seen`` has (spelling, n): spellings of two words or more and six characters or more count.
    """
    first = lambda c: F.lower(F.split(F.trim(c), r"\s+")[0])
    last = lambda c: F.lower(F.element_at(F.split(F.trim(c), r"\s+"), -1))
    s = seen.where((F.length("spelling") >= 6) & (F.size(F.split(F.trim("spelling"), r"\s+")) >= 2)).groupBy("spelling").agg(F.sum("n").alias("n"))
    s = s.select("spelling", "n", first(F.col("spelling")).alias("first"), last(F.col("spelling")).alias("last"))
    # Spellings of one last word are one row for each first word: a busy first word pairs names with kinds, not with rows.
    best = s.groupBy("first", "last").agg(F.max(F.struct("n", F.col("spelling"))).alias("x"))
    kinds = names.where(F.size(F.split(F.trim("name"), r"\s+")) >= 2).select("name", first(F.col("name")).alias("first"), last(F.col("name")).alias("own")).distinct()
    top = best.withColumn("r", F.row_number().over(Window.partitionBy("first").orderBy(F.desc("x.n"), F.desc("x.spelling")))).where("r <= 2")  # the best, and the next where the best is the name's own
    met = kinds.join(top, "first").where("last <> own")
    return met.groupBy("name").agg(F.max_by("x.spelling", F.struct("x.n", "x.spelling")).alias("best"))
