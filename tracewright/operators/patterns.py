"""Graph patterns: co-occurrence, clusters, contradictions, centrality, pressure, accumulation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.plans.materialize import small_or_not, stored
from tracewright.plans.pairs import block_pairs, named_pairs, pair_tasks


def joined_list(values: Column, sep: str = ",") -> Column:
    """Distinct values of a group, sorted, as one string."""
    return F.array_join(F.array_sort(F.transform(F.collect_set(values), lambda x: x)), sep)


#: Rows of a block where nodes are compared by their bits beyond a broadcast, blocks at least, 64-episode words of a node's bits at most, and bits told by one table.
LISTED_ROWS, LISTED_BLOCKS, WORDS, TOLD = 8192, 16, 64, 8


def _told(words: list[Column], labels: list[str]) -> Column:
    """The labels of the set bits, in their order, joined by commas: looked up TOLD bits at a time in tables that are made once."""
    mark = next(c for c in map(chr, range(1, 1 << 16)) if not any(c in x for x in labels))
    parts = []
    for at in range(0, len(labels), TOLD):
        of = labels[at : at + TOLD]
        table = F.split(F.lit(mark.join("".join(f",{x}" for i, x in enumerate(of) if k >> i & 1) for k in range(1 << len(of)))), rf"\Q{mark}\E")
        parts.append(table[F.shiftrightunsigned(words[at // 64], at % 64).bitwiseAND((1 << len(of)) - 1).cast("int")])
    return F.substring(F.concat(*parts), 2, (1 << 31) - 1)


def _by_lists(often: DataFrame, nodes: int, episodes: DataFrame, least: int) -> DataFrame:
    """(a, b, together, episodes) of nodes with ``least`` common episodes, found by the bits of their lists.

    Bits of checked size are broadcast and read by as many tasks as the pairs take, so nothing but
    the result is written; beyond that size blocks of nodes meet.
    """
    ranked = stored(episodes.select("ep", (F.row_number().over(Window.orderBy("ep")) - 1).alias("r")), "episode-ranks")  # a row for each episode
    labels = [r[0] for r in ranked.orderBy("r").select(F.col("ep").cast("string")).collect()]  # under 64 * WORDS
    words = [f"w{i}" for i in range(len(labels) // 64 + 1)]
    bits = [F.coalesce(F.bit_or(F.when(F.floor(F.col("r") / 64) == i, F.expr("shiftleft(1L, cast(r % 64 as int))"))), F.lit(0).cast("long")).alias(w) for i, w in enumerate(words)]
    rows = stored(often.join(F.broadcast(ranked), "ep").groupBy("node").agg(*bits), "episode-bits")
    both = [F.col(f"a.{w}").bitwiseAND(F.col(f"b.{w}")) for w in words]
    together = sum(map(F.bit_count, both), F.lit(0))
    if (small := small_or_not(rows)) is not rows:
        dealt = rows.repartition(pair_tasks(rows.sparkSession, float(nodes) ** 2), "node").alias("a")
        met = dealt.join(small.alias("b"), (F.col("a.node") < F.col("b.node")) & (together >= least))
    else:
        met = block_pairs(rows.withColumn("all", F.lit(0)), "all", "node", together >= least, max(1, min(LISTED_ROWS, nodes // LISTED_BLOCKS)))
    return met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), together.cast("long").alias("together"), _told(both, labels).alias("episodes"))


def cooccurrence(appearances: DataFrame, least: int = 2) -> DataFrame:
    """Pairs of nodes that appear in ``least`` or more episodes together; (a, b, together, episodes).

    ``appearances`` are distinct; nodes of too few episodes are left out first. Where episodes hold
    few of the nodes, pairs meet by episode, in blocks, and are counted; the episodes of those that
    remain are the intersection of both lists. Where they hold so many that pairs met by episode
    outnumber the pairs of nodes, the lists of two nodes are compared as bits, and no pair is moved
    or written but as a result.
    """
    own = appearances.where("node is not null").groupBy("node").agg(F.array_sort(F.collect_list("ep")).alias("eps")).where(F.size("eps") >= least)
    own = stored(own, "episodes-of-nodes")
    often = own.select("node", F.explode("eps").alias("ep"))
    held = stored(often.groupBy("ep").count(), "episodes-held")
    met, episodes = held.agg(F.coalesce(F.sum(F.col("count").cast("double") ** 2), F.lit(0.0)), F.count("*")).first()
    if met > float(nodes := own.count()) ** 2 and episodes < 64 * WORDS:
        return _by_lists(often, nodes, held, least)
    met = block_pairs(often, "ep", "node").select("a.node", F.col("b.node").alias("other")).toDF("a", "b")
    pairs = met.groupBy("a", "b").agg(F.count("*").alias("together")).where(F.col("together") >= least)
    both = pairs.join(own.select(F.col("node").alias("a"), F.col("eps").alias("eps_a")), "a").join(own.select(F.col("node").alias("b"), F.col("eps").alias("eps_b")), "b")
    return both.select("a", "b", "together", F.array_join(F.array_intersect("eps_a", "eps_b"), ",").alias("episodes"))


def ego_connections(appearances: DataFrame, node) -> DataFrame:
    """Nodes that share an episode with ``node``, and in how many."""
    mine = appearances.where(F.col("node") == node).select("ep")
    return appearances.where(F.col("node") != node).join(mine, "ep").groupBy("node").agg(F.count_distinct("ep").alias("together"))


def clusters(links: DataFrame, claim: str, target: str, least: int = 2) -> DataFrame:
    """Targets with ``least`` or more claims."""
    return links.groupBy(target).agg(F.count_distinct(claim).alias("n_claims"), F.min(claim).alias("first_claim"), F.max(claim).alias("last_claim")).where(F.col("n_claims") >= least)


def evidence_accumulation(evidence: DataFrame) -> DataFrame:
    """(node, ep, artifacts, claims): distinct items of each kind of a node in its episodes up to each episode.

    ``evidence`` has (node, ep, kind, item), kind artifact or claim. Only an item's first episode
    is counted, so the running sums need no range join.
    """
    first = evidence.groupBy("node", "kind", "item").agg(F.min("ep").alias("ep"))
    new = first.groupBy("node", "ep").agg(*[F.count_if(F.col("kind") == k).alias(f"new_{k}") for k in ("artifact", "claim")])
    by_ep = evidence.select("node", "ep").distinct().join(new, ["node", "ep"], "left")
    upto = Window.partitionBy("node").orderBy("ep").rowsBetween(Window.unboundedPreceding, 0)
    return by_ep.select("node", "ep", *[F.coalesce(F.sum(f"new_{k}").over(upto), F.lit(0)).alias(f"{k}s") for k in ("artifact", "claim")])


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / length of the longer text; null if both are empty."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer > 0, 1 - F.levenshtein(a, b) / longer)


def contradictions(items: DataFrame, key: str, id_col: str, text_col: str, low: float = 0.3, high: float = 0.9, first: int | None = None) -> DataFrame:
    """Pairs of items under one key whose texts are alike but not the same: low < similarity < high.

    With ``first`` a pair of texts is named by its ``first`` pairs of items in the order of ids, or a
    few more: enough for those that are first of all. No such pair has an item beyond the ``first``
    of its text, since with each item before it its partner makes an earlier pair.

    Equal texts of a key are one text, compared once; lengths bound the similarity before any
    distance is taken; the texts of a busy key meet in blocks. Pairs of texts are then named by lists
    of items, so no pair of items is moved.
    """
    known = items.where(F.col(text_col).isNotNull()).select(key, F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shorter, longer = F.least(F.length("a.text"), F.length("b.text")), F.greatest(F.length("a.text"), F.length("b.text"))
    near = block_pairs(known.select(key, "text").distinct(), key, "text", (longer > 0) & (shorter > low * longer))
    near = near.withColumn("sim", similarity(F.col("a.text"), F.col("b.text"))).where((F.col("sim") > low) & (F.col("sim") < high))
    near = near.select(key, F.col("a.text").alias("ta"), F.col("b.text").alias("tb"), F.round("sim", 6).alias("sim"))
    if first:
        known = known.withColumn("rank", F.row_number().over(Window.partitionBy(key, "text").orderBy("id"))).where(F.col("rank") <= first).drop("rank")
    side = lambda t, i: known.select(key, F.col("text").alias(t), F.col("id").alias(i))
    named = named_pairs(near, side("ta", "ia"), side("tb", "ib"), [key, "ta"], [key, "tb"])
    return named.select(key, F.least("ia", "ib").alias("id1"), F.greatest("ia", "ib").alias("id2"), "sim")


def degree_centrality(nodes: DataFrame, edges: DataFrame, id_col: str = "node") -> DataFrame:
    """Distinct relations at each node, in either direction; nodes without any have 0."""
    ends = edges.select(F.col("src").alias(id_col), F.struct("src", "rel", "dst").alias("e")).union(edges.select(F.col("dst").alias(id_col), F.struct("src", "rel", "dst").alias("e")))
    return nodes.join(ends.groupBy(id_col).agg(F.count_distinct("e").alias("degree")), id_col, "left").select(id_col, F.coalesce("degree", F.lit(0)).alias("degree"))


def pressure(nodes: DataFrame, artifacts: DataFrame, claims: DataFrame, episodes: DataFrame, id_col: str = "node") -> DataFrame:
    """artifacts + 2 * claims + episodes of each node, counted apart so that joins do not multiply."""
    out = nodes
    for name, links, item in (("n_artifacts", artifacts, "artifact"), ("n_claims", claims, "claim"), ("n_episodes", episodes, "ep")):
        out = out.join(links.groupBy(id_col).agg(F.count_distinct(item).alias(name)), id_col, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out.select(id_col, "n_artifacts", "n_claims", "n_episodes", (F.col("n_artifacts") + 2 * F.col("n_claims") + F.col("n_episodes")).alias("pressure"))


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_per(df: DataFrame, by: str, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of each group in the given order."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= n)


def without_any(df: DataFrame, *others: tuple[DataFrame, str]) -> DataFrame:
    """Rows of ``df`` whose key is in none of the other relations."""
    for other, key in others:
        df = df.join(other.select(key).distinct(), key, "left_anti")
    return df


def reuse_rate(appearances: DataFrame) -> DataFrame:
    """(ep, new, reused, rate): nodes of an episode that an earlier one had."""
    seen = appearances.withColumn("n", F.row_number().over(Window.partitionBy("node").orderBy("ep")))
    return seen.groupBy("ep").agg(F.count_if(F.col("n") == 1).alias("new"), F.count_if(F.col("n") > 1).alias("reused"), F.round(100 * F.avg((F.col("n") > 1).cast("double")), 4).alias("rate"))


def recurring_before(appearances: DataFrame, ep: int, least: int = 2) -> DataFrame:
    """Nodes in ``least`` or more episodes before ``ep``."""
    past = appearances.where(F.col("ep") < ep).groupBy("node")
    return past.agg(F.count_distinct("ep").alias("n_episodes"), F.max("ep").alias("last_ep")).where(F.col("n_episodes") >= least)


def missing_members(present: DataFrame, column: str, last: int | None = None) -> DataFrame:
    """Whole numbers from 1 to the last that ``column`` lacks."""
    span = present.agg(F.lit(last) if last else F.max(column).alias("top")).toDF("top")
    return span.select(F.explode(F.expr("sequence(1, greatest(top, 1))")).alias(column)).join(present.select(F.col(column).cast("int")).distinct(), column, "left_anti")
