"""Scores of nested episode documents, and what nodes, memes and phrases come to over all episodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.operators.quality import letter

# The weight of each component, and the ranks of pressure.
WEIGHTS = {"artifact_coverage": 0.25, "claim_grounding": 0.25, "cross_ref_density": 0.20, "timestamp_completeness": 0.15, "node_connectivity": 0.15}
PRESSURE = {"high": 3, "medium": 2, "low": 1}


def _total(items: Column, value) -> Column:
    return F.aggregate(F.transform(items, lambda x: value(x).cast("double")), F.lit(0.0), lambda a, x: a + x)


def _share(total: Column, n: Column) -> Column:
    return F.when(n > 0, total / n).otherwise(0.0)


def half_even(value: Column, digits: int) -> Column:
    """A double rounded to so many digits: it is scaled as a double and the nearest whole number taken, the even one of two."""
    return F.rint(value * 10.0**digits) / 10.0**digits


def _given(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) != ""


def episode_scores(docs: DataFrame, id_col: str = "doc") -> DataFrame:
    """Counts, the five components, their weighted score in percent and a letter for each, of every document.

    Documents have claims (anchored_artifacts, related_nodes, claim_timestamp, transcript_snippet),
    artifacts (sub_items with video_timestamp) and nodes (related_nodes, related_claims). Two
    artifacts a claim, three nodes a claim and four connections a node are full marks; a sub-item
    weighs half a claim. Components of nothing are 0.
    """
    none = lambda c, like: F.coalesce(F.col(c), F.array().cast(docs.schema[c].dataType))  # noqa: E731, ARG005
    claims, arts, nodes = none("claims", None), none("artifacts", None), none("nodes", None)
    n, m, k = F.size(claims), F.size(nodes), _total(arts, lambda a: F.size(a["sub_items"]))
    weight = n + 0.5 * k
    timed = _total(claims, lambda c: (_given(c["claim_timestamp"]) | _given(c["transcript_snippet"])).cast("int")) + 0.5 * _total(arts, lambda a: F.size(F.filter(a["sub_items"], lambda s: _given(s["video_timestamp"]))))
    parts = {
        "artifact_coverage": _share(_total(claims, lambda c: (F.size(c["anchored_artifacts"]) > 0).cast("int")), n),
        "claim_grounding": F.least(_share(_total(claims, lambda c: F.size(c["anchored_artifacts"])), n) / 2, F.lit(1.0)),
        "cross_ref_density": F.least(_share(_total(claims, lambda c: F.size(c["related_nodes"])), n) / 3, F.lit(1.0)),
        "timestamp_completeness": _share(timed, weight),
        "node_connectivity": F.least(_share(_total(nodes, lambda x: F.size(x["related_nodes"]) + F.size(x["related_claims"])), m) / 4, F.lit(1.0)),
    }
    out = docs.select(id_col, n.cast("long").alias("n_claims"), k.cast("long").alias("n_artifacts"), m.cast("long").alias("n_nodes"), *[v.alias(c) for c, v in parts.items()])
    overall = half_even(100 * sum((w * F.col(c) for c, w in WEIGHTS.items()), F.lit(0.0)), 1)
    grades = F.concat(*[letter(F.col(c)) for c in WEIGHTS])
    return out.withColumn("overall_score", overall).withColumn("grades", grades).withColumns({c: half_even(F.col(c), 3) for c in WEIGHTS})


def pressure_rank(level: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in PRESSURE.items() for x in p]), level), F.lit(0))


def node_stats(nodes: DataFrame) -> DataFrame:
    """(ref, name, claim_count, evidence_count, episode_count, episodes, pressure) over all episodes.

    Counts add up, the name is that of the last episode, the pressure the highest met (of equal
    ranks the last one's). A node without a level is low.
    """
    level = F.coalesce("pressure", F.lit("low"))
    rows = nodes.where(F.coalesce("ref", F.lit("")) != "").withColumn("level", level)
    return rows.groupBy("ref").agg(
        F.max_by("name", "ep").alias("name"),
        F.sum("claim_count").alias("claim_count"),
        F.sum("evidence_count").alias("evidence_count"),
        F.count("*").alias("episode_count"),
        F.array_sort(F.collect_list("ep")).alias("episodes"),
        F.max_by("level", F.struct(pressure_rank(F.col("level")), "ep")).alias("pressure"),
    )


def convergence(stats: DataFrame, least: int = 2) -> DataFrame:
    """Nodes of ``least`` or more episodes with their weight: claims times episodes."""
    return stats.where(F.col("episode_count") >= least).withColumn("weight", F.col("claim_count") * F.col("episode_count"))


def pressure_map(nodes: DataFrame) -> DataFrame:
    """(ref, levels, max_pressure): the level of each episode, of nodes in several episodes or under high pressure once.

    Of several levels in one episode the last stands, by ``seq`` where the nodes have it; the
    pressure is the highest met in any row, low if none has a known level.
    """
    level = F.coalesce("pressure", F.lit("low"))
    order = F.col("seq") if "seq" in nodes.columns else F.lit(0)
    rows = nodes.where(F.coalesce("ref", F.lit("")) != "").select("ref", "ep", level.alias("level"), order.alias("seq"))
    last = rows.groupBy("ref", "ep").agg(F.max_by("level", F.struct("seq", "level")).alias("level"), F.max(pressure_rank(F.col("level"))).alias("rank"))
    top = F.max("rank")
    named = F.coalesce(*[F.when(top == r, k) for k, r in PRESSURE.items()], F.lit("low"))
    made = last.groupBy("ref").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("ep", "level")))).alias("levels"), named.alias("max_pressure"))
    return made.where((F.size("levels") > 1) | (F.col("max_pressure") == "high"))


def memes(rows: DataFrame) -> DataFrame:
    """(ref, term, type, occurrences, episodes) from (ep, ref, term, type, occurrences): the first episode names it, each occurrence lists its episode."""
    named = rows.where(F.coalesce("ref", F.lit("")) != "").groupBy("ref").agg(F.min_by(F.struct("term", "type"), "ep").alias("x"))
    each = rows.select("ref", "ep", F.posexplode("occurrences").alias("at", "text"))
    said = each.groupBy("ref").agg(F.array_sort(F.collect_list(F.struct("ep", "at", "text"))).alias("o"))
    return named.join(said, "ref", "left").select("ref", "x.term", "x.type", F.coalesce(F.col("o.text"), F.array().cast("array<string>")).alias("occurrences"), F.coalesce(F.col("o.ep"), F.array().cast(rows.select(F.array("ep")).schema[0].dataType)).alias("episodes"))


def fingerprints(snippets: DataFrame, patterns: list[tuple[str, str]], around: int = 40, same: int = 60) -> DataFrame:
    """(pattern, ep, context): the first match of each pattern in each snippet (ep, at, text), with ``around`` characters on either side.

    Of snippets of an episode that begin alike, in their first ``same`` characters, the first one
    stays. Patterns are (name, Java expression), few enough to stand in the plan.
    """
    text = F.col("text")
    hits = F.array(*[F.struct(F.lit(n).alias("pattern"), F.regexp_instr(text, F.lit(p)).alias("at"), F.length(F.regexp_extract(text, p, 0)).alias("len")) for n, p in patterns])
    found = snippets.where(_given(text)).select("ep", F.col("at").alias("order"), "text", F.explode(hits).alias("h")).where("h.at > 0")
    lo = F.greatest(F.col("h.at") - 1 - around, F.lit(0))
    context = F.trim(F.substr("text", lo + 1, F.col("h.at") - 1 + F.col("h.len") + around - lo))
    found = found.select(F.col("h.pattern").alias("pattern"), "ep", "order", F.substring(F.trim("text"), 1, same).alias("key"), context.alias("context"))
    first = Window.partitionBy("pattern", "ep", "key").orderBy("order")
    return found.withColumn("r", F.row_number().over(first)).where("r = 1").select("pattern", "ep", "context")
