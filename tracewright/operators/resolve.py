"""Entity resolution and identifiers: names, fuzzy pairs, merges, ledgers, references."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.text import normal_name
from tracewright.plans.components import connected_components
from tracewright.plans.materialize import release, small_or_not, stored
from tracewright.plans.pairs import named_pairs
from tracewright.plans.ranks import global_rank, running

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def name_classes(names: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """(name, id, members): each different normalised name, its least id, and how many rows bear it."""
    named = names.where(F.col(name_col).isNotNull()).select(F.col(id_col).alias("id"), normal_name(F.col(name_col)).alias("name"))
    return named.groupBy("name").agg(F.min("id").alias("id"), F.count("*").alias("members"))


def near_names(left: DataFrame, right: DataFrame, most: int = 3, by: tuple[str, ...] = ()) -> DataFrame:
    """(.. by, name, other, distance) of all names and others at an edit distance of ``most`` or less.

    Of ``most`` + 1 segments of the other name one at least is untouched, so it stands in the name
    as it is, shifted by ``most`` places or less: an equality join on (length, segment, its text).
    """
    begin = lambda n, i: F.floor(n * i / (most + 1)).cast("int")
    n, i = F.col("n"), F.col("i")
    cut = right.select(*by, "other", F.length("other").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(most))).alias("i"))
    cut = cut.select(*by, "other", "n", "i", F.substr(F.col("other"), begin(n, i) + 1, begin(n, i + 1) - begin(n, i)).alias("segment"))
    size = F.length("name")
    tries = left.select(*by, "name", F.explode(F.sequence(F.greatest(size - most, F.lit(0)), size + most)).alias("n"))
    tries = tries.select(*by, "name", "n", F.explode(F.sequence(F.lit(0), F.lit(most))).alias("i"))
    tries = tries.select(*by, "name", "n", "i", F.explode(F.sequence(F.lit(-most), F.lit(most))).alias("shift"))
    tries = tries.withColumn("at", begin(n, i) + F.col("shift")).withColumn("len", begin(n, i + 1) - begin(n, i)).where((F.col("at") >= 0) & (F.col("at") + F.col("len") <= size))
    tries = tries.select(*by, "name", "n", "i", F.substr(F.col("name"), F.col("at") + 1, F.col("len")).alias("segment")).distinct()
    met = tries.join(cut, [*by, "n", "i", "segment"]).select(*by, "name", "other").distinct()
    return met.withColumn("distance", F.levenshtein("name", "other", most)).where(f"distance between 0 and {most}")


def fuzzy_pairs(names: DataFrame, id_col: str, name_col: str, most: int = 3, label: str | None = None) -> DataFrame:
    """Pairs (a, b, distance) of name classes of one label, by their least ids, at an edit distance of 1 to ``most``.

    Rows of one name are one class, so copies are not multiplied out.
    """
    by = (label,) if label else ()
    kinds = names.where(F.col(name_col).isNotNull()).select(*by, F.col(id_col).alias("id"), normal_name(F.col(name_col)).alias("name")).groupBy(*by, "name").agg(F.min("id").alias("id"))
    near = near_names(kinds.select(*by, "name"), kinds.select(*by, F.col("name").alias("other")), most, by).where("name < other")
    near = near.join(kinds.withColumnRenamed("id", "ia"), [*by, "name"]).join(kinds.withColumnsRenamed({"id": "ib", "name": "other"}), [*by, "other"])
    return near.select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b"), "distance")


def new_against_existing(new: DataFrame, existing: DataFrame, most: int = 3) -> DataFrame:
    """(id, other_id, distance): new names near existing ones of any label that are not new themselves; names as they are written.

    Both have (id, name); of equal names all ids are met, by lists of them.
    """
    old = existing.join(new.select("id"), "id", "left_anti").select(F.col("id").alias("ib"), F.col("name").alias("other"))
    near = stored(near_names(new.select("name").distinct(), old.select("other").distinct(), most), "near-names")
    met = old.join(small_or_not(near.select("other").distinct()), "other", "left_semi")
    named = named_pairs(near, new.select(F.col("id").alias("ia"), "name"), met, ["name"], ["other"])
    return named.select(F.col("ia").alias("id"), F.col("ib").alias("other_id"), "distance")


def nearest_name(queries: DataFrame, names: DataFrame, id_col: str, name_col: str, most: int = 3) -> DataFrame:
    """(query, id, distance): the exact name, else the least distance of ``most`` or less, ties by id."""
    q = queries.select(F.col(queries.columns[0]).alias("query")).distinct().withColumn("name", normal_name(F.col("query")))
    right = names.select(F.col(id_col).alias("id"), normal_name(F.col(name_col)).alias("other"))
    near = near_names(q.select("name").distinct(), right.select("other").distinct(), most).join(right, "other")
    best = near.groupBy("name").agg(F.min(F.struct("distance", "id")).alias("x"))
    return q.join(best, "name").select("query", "x.id", "x.distance")


def merge_map(pairs: DataFrame) -> DataFrame:
    """(node, component): every node of the pairs and the least node it is merged into."""
    return connected_components(pairs, "a", "b")


def remapped(edges: DataFrame, mapping: DataFrame, column: str, distinct: bool = True) -> DataFrame:
    """``edges`` with ``column`` replaced by its component, where it has one."""
    m = mapping.select(F.col("node").alias(column), "component")
    out = edges.join(m, column, "left").withColumn(column, F.coalesce("component", column)).drop("component").select(edges.columns)
    return out.distinct() if distinct else out


def assign_ids(items: DataFrame, name: Column, order: Column, start: int) -> DataFrame:
    """Sequential ids by first appearance: equal names share one; adds ``new_id``."""
    keyed = items.withColumn("__name", name)
    first = global_rank(keyed.groupBy("__name").agg(F.min(order).alias("__o")), "__o", "__name")
    return keyed.join(first.select("__name", (F.col("rank") + start).alias("new_id")), "__name").drop("__name")


def next_ids(df: DataFrame, id_col: str, prefix: str, default: int) -> Column:
    number = F.expr(f"try_cast(substr({id_col}, {len(prefix) + 1}) as bigint)")
    return F.coalesce(F.max(number), F.lit(default - 1)) + 1


def claim_repair(items: DataFrame, doc: str, claim: str, start: int = 1000) -> DataFrame:
    """(doc, claim, fixed): in the order of documents and numbers, a number below the next free one gets that one; any other moves it on.

    So each is the greater of its own number and one past the one before. Less its place in the
    order that is a running maximum.
    """
    placed = global_rank(items.select(doc, claim).distinct(), doc, claim, name="at")
    level = running(placed, ["at"], level=("max", F.col(claim) - F.col("at")))
    return level.select(doc, claim, (F.col("at") + F.greatest(F.col("level"), F.lit(start).cast("long"))).alias("fixed"))


#: Rows of a block whose numbers one task gives in order.
BLOCK = 1 << 20
_LOWEST = -(1 << 62)


def _numbered(tops: dict[int, int]):
    """The function that goes through blocks of rows in their order; ``tops`` has the greatest number used before each block."""

    def run(batches):
        block, top, given, count = None, 0, set(), 0
        for b in batches:
            fixed, hits, so_far = [], [], []
            for p, n, again in zip(*(b.column(c).to_pylist() for c in ("block", "n", "again")), strict=True):
                if p != block:
                    block, top, given, count = p, tops.get(p, _LOWEST), set(), 0
                if hit := again or n in given:
                    top += 1
                    given.add(top)
                    count += 1
                else:
                    top = max(top, n)
                fixed.append(top if hit else n)
                hits.append(hit)
                so_far.append(count)
            made = [pa.array(fixed, pa.int64()), pa.array(hits, pa.bool_()), pa.array(so_far, pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column("at"), b.column("block"), b.column("n"), *made], ["at", "block", "n", "fixed", "hit", "so_far"])

    return run


def family_repair(items: DataFrame, doc: str, family: str, block: int = BLOCK) -> DataFrame:
    """(doc, family, fixed): a number that is used already, in an earlier document or as a new number, gets the greatest used so far plus one.

    Documents come in their order, their numbers ascending. The rows are cut into blocks in that
    order; in each round every block is gone through by itself, from the greatest number and the new
    numbers that the round before gave the blocks before it. A block with ``c`` new numbers turns a
    greatest number m into max(m + c, what its own numbers come to), so a round carries a change
    through all blocks whose ``c`` it leaves alone. After each round one block more is right at
    least, and nothing is left to do when a round changes nothing: the rounds are bounded by the
    blocks, whatever the conflicts.
    """
    used = items.select(doc, family).distinct()
    first = used.groupBy(family).agg(F.min(doc).alias("first"))
    rows = global_rank(used.join(first, family).withColumn("again", F.col(doc) > F.col("first")).drop("first"), doc, family, name="at")
    rows = stored(rows.withColumn("block", F.expr(f"at div {block}")), "family-rows")
    plain = rows.select("at", "block", F.col(family).cast("long").alias("n"), "again")
    tops, given, seen, fixed = {}, None, None, None
    while True:
        now = plain
        if given is not None:
            marked = plain.join(given, "n", "left").withColumn("again", F.col("again") | F.coalesce(F.col("since") < F.col("block"), F.lit(False)))
            now = marked.select("at", "block", "n", "again")
        dealt = now.repartition("block").sortWithinPartitions("block", "at")
        before, fixed = fixed, stored(dealt.mapInArrow(_numbered(tops), "at long, block long, n long, fixed long, hit boolean, so_far long"), "family-numbers")
        own = F.max(F.when(~F.col("hit"), F.col("n") - F.col("so_far")))
        blocks = fixed.groupBy("block").agg(F.count_if("hit").alias("c"), own.alias("own"), F.bit_xor(F.xxhash64("at", "fixed")).alias("digest")).orderBy("block").collect()
        next_tops, top = {}, _LOWEST
        for r in blocks:  # a row for each block
            next_tops[r.block] = top
            top = max(top + r.c, top if r.own is None else r.own + r.c)
        state = (next_tops, [(r.block, r.c, r.digest) for r in blocks])
        if state == seen:
            return rows.join(fixed.select("at", "fixed"), "at").select(doc, family, F.col("fixed").cast(rows.schema[family].dataType).alias("fixed"))
        if before is not None:
            release(before)
        seen, tops = state, next_tops
        given = fixed.where("hit").groupBy(F.col("fixed").alias("n")).agg(F.min("block").alias("since"))


def dangling(refs: DataFrame, ref_col: str, known: DataFrame, key: str) -> DataFrame:
    """References to ids that are not known."""
    return refs.where(F.col(ref_col).isNotNull()).join(known.select(F.col(key).alias(ref_col)).distinct(), ref_col, "left_anti")


def keep_first(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__r = 1").drop("__r")


def edge_screen(forward: DataFrame, backward: DataFrame, claims: DataFrame) -> DataFrame:
    """(node, claim, issue): links that only one side declares, and links to unknown claims."""
    missing = forward.join(claims.select("claim"), "claim", "left_anti").select("node", "claim", F.lit("node_claim_missing").alias("issue"))
    known = forward.join(claims.select("claim"), "claim", "left_semi")
    listed = backward.select("claim").distinct()
    mismatch = known.join(backward, ["node", "claim"], "left_anti").join(listed, "claim", "left_semi").select("node", "claim", F.lit("node_claim_subject_mismatch").alias("issue"))
    back = backward.join(forward, ["node", "claim"], "left_anti").select("node", "claim", F.lit("claim_node_backlink_missing").alias("issue"))
    return missing.union(mismatch).union(back).distinct()


def edge_sanitise(forward: DataFrame, backward: DataFrame, claims: DataFrame) -> DataFrame:
    """(node, claim): declared links less unknown and mismatched ones, plus missing backlinks.

    Both sides are dealt by claim once, as marks of one row for each link, and a claim's links are
    judged together: a link stays if the claim's side declares it, or if that side declares none of
    the claim's links and the claim is known.
    """
    side = lambda df, of: df.select("node", "claim", F.lit(of == "back").alias("back"))
    links = side(forward, "forward").union(side(backward, "back")).repartition("claim").groupBy("node", "claim").agg(F.max("back").alias("back"))
    alone = links.withColumn("listed", F.max("back").over(Window.partitionBy("claim")) & F.col("claim").isNotNull())
    known = claims.select("claim").where("claim is not null").distinct().withColumn("known", F.lit(True))
    return alone.join(known, "claim", "left").where("back or (known and not listed)").select("node", "claim")
