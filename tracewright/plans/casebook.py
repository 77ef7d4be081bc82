"""Markdown registers made of the star-schema tables: a document for each customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.plans.bindings import Graph


def _line(section: int, a, b, step: int, *parts):
    """One line with its place in the document."""
    text = F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.struct(F.lit(section).alias("section"), a.cast("long").alias("a"), (F.lit(b) if isinstance(b, int) else b.cast("int")).alias("b"), F.lit(step).alias("step"), text.alias("line"))


def order_lines(g: Graph) -> DataFrame:
    """Line items with (l_orderkey, l_linenumber) as a key: of repeated ones the greatest values. Dealt by order, so that what follows by order moves nothing."""
    return g.table("lineitem").repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(*[F.max(c).alias(c) for c in ("l_partkey", "l_suppkey", "l_shipdate", "l_returnflag")])


#: The same for DuckDB.
LINES = "lines AS (SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey, max(l_suppkey) AS l_suppkey, max(l_shipdate) AS l_shipdate, max(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1, 2)"


def register_lines(g: Graph) -> DataFrame:
    """(doc, section, a, b, step, line): families, artifacts, claims, nodes and links of each customer's orders.

    An order is joined with the list of its lines and dealt to its customer once; all lines of text
    are made after that, so no text moves. Repeated orders are rows each, with the lines of all.
    """
    o = g.table("orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("okey"), "o_orderstatus", "o_orderpriority")
    item = F.struct(F.col("l_linenumber").cast("int").alias("ln"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), F.col("l_shipdate").alias("shipped"), F.col("l_returnflag").alias("flag"))
    held = order_lines(g).groupBy(F.col("l_orderkey").alias("okey")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    most = lambda c: F.array_max(F.transform("items", lambda x: x[c])).alias(c)
    c = o.join(held, "okey", "left").repartition("doc").select("*", most("supp"), most("part"))
    sold = Window.partitionBy("doc", "supp")
    c = c.withColumns({"alike": F.count("*").over(Window.partitionBy("doc", "okey")), "place": F.row_number().over(sold.orderBy("okey")), "top": F.max("part").over(sold)})

    key, n, s, p, t = F.col("okey"), F.col("okey") + 1000, F.col("supp"), F.col("part") + 1000, F.col("top")
    level = lambda x: F.when(x["flag"] == "R", "high").when(x["flag"] == "A", "medium").otherwise("low")
    named = F.sort_array(F.flatten(F.array_repeat(F.transform("items", lambda x: x["ln"]), F.col("alike").cast("int"))))
    anchored = F.array_join(F.transform(named, lambda x: F.concat(F.lit("A-"), n.cast("string"), F.lit("."), x.cast("string"))), ", ")
    order = F.array(
        _line(1, key, 0, 0, "**A-", n, "** Family of order ", key),
        _line(2, key, 0, 1, "**C-", n, "** Claim ", F.col("o_orderpriority")),
        _line(2, key, 0, 2, "Claim: ", F.col("o_orderstatus")),
        _line(2, key, 0, 3, "Anchored Artifacts: ", F.coalesce(anchored, F.lit(""))),
    )
    artifacts = F.flatten(F.transform("items", lambda x: F.array(
        _line(1, key, x["ln"], 1, "**A-", n, ".", x["ln"], "** Part ", x["part"]),
        _line(1, key, x["ln"], 2, "Event Timestamp: ", F.date_format(x["shipped"], "yyyy-MM-dd")),
        _line(1, key, x["ln"], 3, "Confidence: ", level(x)),
    )))
    anchors = F.array(
        _line(2, key, 0, 4, "Related Nodes: N-", s, ", same_as:N-", p, ", N-", s),
        _line(4, key, 0, 1, "**LM-", n, "** Matter ", key),
        _line(4, key, 0, 2, "Prov: C-", n, " cites_source A-", n, ".1"),
        _line(4, key, 0, 3, "TopicMention: C-", n, " N-", p),
        _line(5, key, 0, 1, "**M-", n, "** Meme ", key),
        _line(5, key, 0, 2, "MemeLink: C-", n, " invoked_by_claim M-", n),
    )
    nodes = F.array(
        _line(3, key, s, 1, "**N-", s, "** Supplier ", s),
        _line(3, key, s, 2, "*Also known as: S", s, "; Sup ", s, "*"),
        _line(3, key, s, 3, "Type: organization"),
        _line(3, key, s, 4, "Sells part ", t, " among others."),
        _line(3, key, s, 5, "OrgLink: N-", s, " parent_of N-", t + 1000),
        _line(3, key, s, 6, "OrgLink: N-", s, " invents N-", t + 1000),
        _line(3, key, s, 7, "RoleLink: N-", s, " member_of N-", t + 1000, " title: Seller"),
        _line(3, key, s, 8, "SameAs: N-", t + 1000, " N-", s),
    )
    none = F.slice(order, 1, 0)
    only = lambda lines, holds: F.when(holds, lines).otherwise(none)
    whole = F.concat(order, only(artifacts, F.col("items").isNotNull()), only(anchors, s.isNotNull()), only(nodes, s.isNotNull() & (F.col("place") == 1)))
    return c.select("doc", F.explode(whole).alias("x")).select("doc", "x.*")
