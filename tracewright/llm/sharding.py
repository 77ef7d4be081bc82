"""Minimax contiguous sharding of atomic groups, in DataFrame operations only.

Groups of equal texts stand in the order of their digests. The least capacity with which a greedy
filling needs no more than the given number of shards is found by binary search, and the groups are
cut so that none passes it and all are as near an even share as that allows. The search runs on prefix sums of blocks of groups; blocks in which a cut may fall are
opened to finer blocks until the greedy path meets single groups only. So the driver sees a bounded
table in each round, and the capacity is exact.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.plans.materialize import stored

#: Blocks looked at in one round of the search, and intervals opened to them at most.
PARTS, SPANS = 8192, 32
#: Groups in a block of the running sums, on average, from which a further hex digit is taken.
BLOCK_GROUPS = 10_000


class PrefixSums:
    """Prefix sums known so far, and which of them have no unknown one just before."""

    def __init__(self, total: int):
        self.sums, self.closed, self.total = [0, total], {0: True, total: total <= 1}, total

    def add(self, spans: list[tuple[int, int]], found) -> None:
        for end in (b for _, b in spans):
            self.closed[end] = True
        for p, n in found:
            self.closed[p] = n == 1
        self.sums = sorted(self.closed)

    def greedy(self, shards: int, capacity: int, hopeful: bool) -> tuple[list[int], list[tuple[int, int]]] | None:
        """(cuts, open intervals met) of the filling, or None if it needs more shards.

        Inside an open interval the last true sum within reach is unknown: ``hopeful`` takes the
        reach itself, otherwise the last known sum is taken.
        """
        at, cuts, met = 0, [], []
        for _ in range(shards):
            reach = at + capacity
            if reach >= self.total:
                return cuts, met
            i = bisect_right(self.sums, reach) - 1
            known, after = self.sums[i], self.sums[i + 1]
            if not self.closed[after] and known < reach:
                met.append((known, after))
                known = reach if hopeful else known
            if known <= at:
                return None
            at = known
            cuts.append(at)
        return None

    def least(self, shards: int, low: int, high: int, hopeful: bool) -> int:
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if self.greedy(shards, mid, hopeful) is None else (low, mid)
        return low


def minimax_cuts(prefix: DataFrame, total: int, shards: int) -> tuple[int, list[int]]:
    """(capacity, cuts) for the groups' running sums in column ``p``: the least possible, exactly."""
    if total <= 0:
        return 0, []
    known, spans = PrefixSums(total), [(0, total)]
    while True:
        parts = max(2, PARTS // len(spans))
        inside = [(F.col("p") > a) & (F.col("p") < b) for a, b in spans]
        part = reduce(lambda rest, k: F.when(inside[k], k * parts + F.floor((F.col("p") - spans[k][0]) * parts / (spans[k][1] - spans[k][0]))).otherwise(rest), range(len(spans)), F.lit(-1))
        found = prefix.where(reduce(lambda x, y: x | y, inside)).groupBy(part.alias("part")).agg(F.max("p").alias("p"), F.count("*").alias("n"))
        known.add(spans, [(r.p, r.n) for r in found.collect()])
        low = known.least(shards, -(-total // shards), total, True)
        high = known.least(shards, low, total, False)
        (_, hoped), (cuts, met) = known.greedy(shards, low, True), known.greedy(shards, high, False)
        spans = sorted(set(hoped) | set(met))[:SPANS]
        if low == high and not met or not spans:
            return high, cuts


def even_cuts(prefix: DataFrame, total: int, shards: int, capacity: int) -> list[int]:
    """Cuts at which no shard passes ``capacity`` and each is as near an even share of what is left as the groups allow.

    Going back from the end, ``low`` has the first place of each cut from which the rest still fits.
    Every look at the running sums is an aggregate of one row.
    """
    low = [0] * shards
    reach = total
    for k in range(shards - 1, 0, -1):
        reach = prefix.where(F.col("p") >= reach - capacity).agg(F.min("p")).first()[0] if reach > capacity else 0
        low[k] = reach
    cuts, at = [], 0
    for k in range(1, shards):
        want = at + -(-(total - at) // (shards - k + 1))
        inside = prefix.where((F.col("p") > at) & (F.col("p") < total))
        near = inside.agg(F.max(F.when(F.col("p") <= want, F.col("p"))), F.min(F.when(F.col("p") > want, F.col("p")))).first()
        found = [c for c in (*near, low[k]) if c is not None and max(at + 1, low[k]) <= c <= at + capacity]
        if not found:
            break
        cuts.append(at := min(found, key=lambda c: (abs(c - want), c)))  # noqa: B023
    return cuts


def shard_groups(rows: DataFrame, shards: int) -> tuple[DataFrame, int]:
    """((key, rank, shard) of every group of ``rows``, capacity). ``rank``: rows in the groups before."""
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "shard-groups")
    total, count = groups.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    digits = 3 + (count > 16**3 * BLOCK_GROUPS)
    groups = groups.withColumn("block", F.substring("key", 1, digits))
    blocks = groups.groupBy("block").agg(F.sum("size").alias("s"), F.sum("n").alias("m"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # at most 16 ** digits rows
    blocks = blocks.select("block", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s"), F.coalesce(F.sum("m").over(before), F.lit(0)).alias("m"))
    within = Window.partitionBy("block").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    sums = groups.select("key", "block", "size", "n", F.sum("size").over(within).alias("p"), F.sum("n").over(within).alias("r"))
    sums = sums.join(F.broadcast(blocks), "block").select("key", "size", (F.col("p") + F.col("s")).alias("p"), (F.col("r") + F.col("m") - F.col("n")).alias("rank"))
    sums = stored(sums, "shard-sums")
    capacity, cuts = minimax_cuts(sums, total, shards)
    cuts = even_cuts(sums, total, shards, capacity) if cuts else cuts
    start = F.col("p") - F.col("size")
    shard = reduce(lambda x, c: x + (start >= c).cast("int"), cuts, F.lit(0))
    return stored(sums.select("key", "rank", shard.cast("int").alias("shard")), "group-shards"), capacity


def shard_rows(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, key, shard, slot, capacity) of every row.

    Size is the UTF-8 length of the text plus 1; a null text is the empty one. Equal texts share a
    shard; a group larger than an even share has its shard to itself as far as the order allows.
    Slots count from 0 in each shard, in the order of groups and ids; null ids come first, equal
    rows stand side by side. Fewer groups than shards leave shards empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("key"))
    rows = stored(rows, "shard-rows")
    groups, capacity = shard_groups(rows, shards)
    placed = rows.join(groups, "key").repartitionByRange("rank", "id").sortWithinPartitions("rank", "id")
    placed = stored(placed.withColumn("mark", F.monotonically_increasing_id()), "shard-order")
    # The mark counts rows within a partition; the rows of the partitions before are added to it.
    part = F.shiftright("mark", 33).alias("part")
    parts = placed.groupBy(part).agg(F.count("*").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"))
    first = groups.groupBy("shard").agg(F.min("rank").alias("first"))
    out = placed.withColumn("part", part).join(F.broadcast(parts), "part").join(F.broadcast(first), "shard")
    slot = F.col("off") + F.col("mark").bitwiseAND(F.lit((1 << 33) - 1)) - F.col("first")
    return out.select("id", "size", "text_crc32", "key", "shard", slot.alias("slot"), F.lit(capacity).cast("long").alias("capacity"))
