"""Reports as sorted lines: a person's file, the verification of drafts, the daily brief; and cached posts read in either form.

A report is rows of text with their place, (.., section, a, b, line), never one long value, so it
is as large as it has to be; ordered by its place it is the text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _lines(rows: DataFrame, by: list[str], section: int, a: Column, b: int, line: Column) -> DataFrame:
    return rows.select(*by, F.lit(section).alias("section"), a.cast("long").alias("a"), F.lit(b).alias("b"), line.alias("line"))


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _listed(values: Column, sep: str = ", ") -> Column:
    return F.array_join(F.transform(values, lambda x: x.cast("string")), sep)


def person_reports(people: DataFrame, claims: DataFrame, artifacts: DataFrame, connections: DataFrame, most: int = 10) -> DataFrame:
    """(person, section, a, b, line): the head, claims, evidence, ``most`` connections and timeline of every person; sections of nothing are left out.

    ``people`` has (person, name, aliases, description, episodes); claims (person, at, claim, label,
    ep, time, text, anchors), artifacts (person, at, artifact, ep, text, confidence) and connections
    (person, other, name, episodes) are in the order of their place or, connections, of the episodes
    shared. Null or empty parts leave no trace.
    """
    by, none = ["person"], F.lit(0)
    counted = lambda rows, name: rows.groupBy("person").agg(F.count("*").alias(name))
    p = people.join(counted(claims, "n_claims"), "person", "left").join(counted(artifacts, "n_artifacts"), "person", "left").fillna(0, ["n_claims", "n_artifacts"])
    given = lambda c: F.coalesce(c, F.lit("")) != ""
    rank = F.row_number().over(Window.partitionBy("person").orderBy(F.desc(F.size("episodes")), "other"))
    near = connections.withColumn("at", rank).where(F.col("at") <= most)
    heads = lambda rows, section, title: _lines(rows.groupBy("person").agg(F.count("*").alias("n")), by, section, none, 0, title)
    when = F.when(given(F.col("time")), _text(" (", F.col("time"), ")")).otherwise("")
    parts = [
        _lines(p, by, 0, none, 0, _text("# ", F.col("name"))), _lines(p, by, 0, none, 1, _text("**ID:** ", F.col("person"))),
        _lines(p.where("size(aliases) > 0"), by, 0, none, 2, _text("**Aliases:** ", _listed(F.col("aliases")))),
        _lines(p.where(given(F.col("description"))), by, 0, none, 3, F.col("description")),
        _lines(p, by, 0, none, 4, _text("**Episodes:** ", _listed(F.col("episodes")))),
        _lines(p, by, 0, none, 5, _text("**Evidence:** ", F.col("n_artifacts"), " artifacts, ", F.col("n_claims"), " claims")),
        heads(claims, 1, _text("## Claims (", F.col("n"), ")")),
        _lines(claims, by, 1, F.col("at"), 1, _text("### ", F.col("claim"), ": ", F.col("label"))),
        _lines(claims, by, 1, F.col("at"), 2, _text("**Episode ", F.col("ep"), "**", F.when(given(F.col("time")), _text(" (Timestamp: ", F.col("time"), ")")).otherwise(""))),
        _lines(claims, by, 1, F.col("at"), 3, F.col("text")),
        _lines(claims.where("size(anchors) > 0"), by, 1, F.col("at"), 4, _text("**Anchored Artifacts:** ", _listed(F.col("anchors")))),
        heads(artifacts, 2, _text("## Evidence (", F.col("n"), ")")),
        _lines(artifacts, by, 2, F.col("at"), 1, _text("- **", F.col("artifact"), "** (Episode ", F.col("ep"), "): ", F.col("text"), F.when(given(F.col("confidence")), _text(" [Confidence: ", F.col("confidence"), "]")).otherwise(""))),
        heads(near, 3, F.lit("## Connections")),
        _lines(near, by, 3, F.col("at"), 1, _text("- **", F.col("name"), "** (", F.col("other"), "): ", F.size("episodes"), " episodes [", _listed(F.col("episodes")), "]")),
        heads(claims, 4, F.lit("## Timeline")),
        _lines(claims, by, 4, F.col("at"), 1, _text("- **Episode ", F.col("ep"), when, "**: ", F.col("label"), " [", F.col("claim"), "]")),
    ]
    return reduce(DataFrame.unionByName, parts)


def numbering(used: DataFrame, what: str) -> DataFrame:
    """(kind, item, episodes): the numbers of (ep, number) that more than one episode defines, ascending episodes joined by commas."""
    found = used.select("ep", "number").distinct().groupBy("number").agg(F.array_sort(F.collect_list("ep")).alias("eps")).where(F.size("eps") > 1)
    return found.select(F.lit(f"{what} collision").alias("kind"), F.col("number").cast("string").alias("item"), _listed(F.col("eps"), ",").alias("episodes"))


def draft_verification(families: DataFrame, claims: DataFrame, names: DataFrame, spellings: DataFrame) -> tuple[DataFrame, bool]:
    """Issues (kind, item, episodes) of drafts, and whether the numbering is in order.

    Families and claims (ep, number) collide where several episodes define one; a name (ep, name)
    whose known spelling (name, verified) differs is to be checked, in any of its episodes. Names
    without a known spelling are no issue.
    """
    numbers = numbering(families, "artifact").unionByName(numbering(claims, "claim"))
    wrong = names.distinct().join(spellings.where("verified <> name"), "name")
    spelled = wrong.groupBy("name", "verified").agg(F.array_sort(F.collect_set("ep")).alias("eps"))
    spelled = spelled.select(F.lit("spelling").alias("kind"), F.concat_ws(" -> ", "name", "verified").alias("item"), _listed(F.col("eps"), ",").alias("episodes"))
    return numbers.unionByName(spelled), numbers.limit(1).count() == 0


def daily_brief(prep: DataFrame, tasks: DataFrame, title: str = "Daily Brief") -> DataFrame:
    """(day, section, a, b, line): each day's prepared lines (day, at, line) with its tasks (day, at, status, description) below.

    A day without prepared lines has a title instead; one without tasks says so there, and nothing
    below prepared lines. A task without a status is pending.
    """
    task = _text("- [", F.upper(F.coalesce("status", F.lit("pending"))), "] ", F.coalesce("description", F.lit("")))
    days = prep.select("day", F.lit(True).alias("prepared")).distinct().join(tasks.select("day", F.lit(True).alias("busy")).distinct(), "day", "full_outer")
    by, none = ["day"], F.lit(0)
    both = days.where("prepared and busy")
    parts = [
        _lines(prep, by, 0, F.col("at"), 0, F.col("line")),
        _lines(both, by, 1, none, 0, F.lit("---")), _lines(both, by, 1, none, 1, F.lit("## To-dos")),
        _lines(days.where("prepared is null"), by, 0, none, 0, _text(f"# {title} — ", F.col("day"))),
        _lines(tasks, by, 2, F.col("at"), 0, task),
    ]
    return reduce(DataFrame.unionByName, parts)


POST = "array<struct<url:string,title:string,date:string>>"
PUBLICATION = f"struct<drafts:{POST},scheduled:{POST},published:{POST},updated_at:string,refreshing:boolean>"


def cached_publication(raw: Column, publication: Column | str, legacy: str) -> Column:
    """One publication of a cache (JSON text), with defaults for what it lacks.

    A cache of the old form has drafts and published at its top; it is that of the publication
    ``legacy``. Text that is no JSON, and an unknown publication, give empty lists.
    """
    publication = F.lit(publication) if isinstance(publication, str) else publication
    old = F.get_json_object(raw, "$.drafts").isNotNull() & F.get_json_object(raw, "$.published").isNotNull()
    mine = F.when(old, F.when(publication == legacy, F.from_json(raw, PUBLICATION))).otherwise(F.element_at(F.from_json(raw, f"map<string,{PUBLICATION}>"), publication))
    none = F.array().cast(POST)
    lists = [F.coalesce(mine[c], none).alias(c) for c in ("drafts", "scheduled", "published")]
    return F.struct(*lists, mine["updated_at"].alias("updated_at"), F.coalesce(mine["refreshing"], F.lit(False)).alias("refreshing"))
