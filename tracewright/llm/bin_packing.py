"""Variable-capacity best-fit packing of documents into training sequences.

Pieces of one length are alike, so best-fit decreasing is planned on the histogram of lengths,
which has at most as many rows as the largest capacity, and every step of the plan places a run of
alike pieces into a run of alike bins. The plan is then joined to the pieces by their rank within
their length. Documents longer than the largest capacity are cut into whole capacities and a rest.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.plans.materialize import small_or_not, stored

#: Permitted sequence lengths, in tokens, and what a sequence costs beside its tokens.
CAPACITIES, OVERHEAD = (512, 1024, 2048, 4096, 8192), 16


def _filled(capacity: int, length: int, count: int, left: dict[int, int], lengths: list[int]) -> int:
    """Tokens that one new bin of ``capacity`` gets from the pieces left, largest first."""
    room = capacity - min(capacity // length, count) * length
    for size in reversed(lengths[: bisect_left(lengths, min(length, room + 1))]):
        if room < size:
            continue
        room -= min(room // size, left[size]) * size
        if room < lengths[0]:
            break
    return capacity - room


def plan(histogram: dict[int, int], capacities=CAPACITIES, overhead: int = OVERHEAD) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """(bins, capacity, [(length, pieces in each bin)]) of every kind of bin; lengths fall.

    Best-fit decreasing: a piece goes to the open bin with the least room that holds it. Where none
    does, a bin is opened of the capacity that costs least for each token that the pieces left
    would fill in it. At last each bin shrinks to the least capacity that holds what is in it.
    """
    sizes, left = sorted(capacities), dict(histogram)
    lengths = sorted(left)
    if lengths and lengths[-1] > sizes[-1] or any(n < 1 for n in lengths):
        raise ValueError("lengths are from 1 to the largest capacity")
    rooms: list[int] = []  # rooms that some bins have, ascending
    bins: dict[int, list[tuple[int, tuple]]] = {}  # by room: (how many, contents)

    def put(room: int, count: int, contents: tuple) -> None:
        if count:
            if room not in bins:
                insort(rooms, room)
            bins.setdefault(room, []).append((count, contents))

    def fill(room: int, count: int, contents: tuple, length: int, pieces: int) -> int:
        """Place pieces into bins of one kind; returns how many were placed."""
        each = room // length
        full, rest = divmod(min(pieces, count * each), each)
        put(room - each * length, full, (*contents, (length, each)))
        put(room - rest * length, 1 if rest else 0, (*contents, (length, rest)))
        put(room, count - full - bool(rest), contents)
        return full * each + rest

    for length in sorted(left, reverse=True):
        pieces = left.pop(length)
        lengths.pop()
        for room in rooms[bisect_left(rooms, length) :]:
            if not pieces:
                break
            kinds = bins.pop(room)
            rooms.remove(room)
            for k, (count, contents) in enumerate(kinds):
                if not pieces:
                    for other in kinds[k:]:
                        put(room, *other)
                    break
                pieces -= fill(room, count, contents, length, pieces)
        while pieces:
            fits = [c for c in sizes if c >= length]
            cost = lambda c: ((c + overhead) / _filled(c, length, pieces, left, lengths), -c)  # noqa: B023, E731
            capacity = min(fits, key=cost)
            each = capacity // length
            count = max(1, pieces // each)
            pieces -= fill(capacity, count, ((0, capacity),), length, pieces)
    out = []
    for kinds in bins.values():
        for count, ((_, _), *contents) in kinds:
            used = sum(n * k for n, k in contents)
            out.append((count, next(c for c in sizes if c >= used), contents))
    return sorted(out, key=lambda x: (-x[1], x[2]))


def steps(made: list[tuple[int, int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int, int]]:
    """(length, lo, hi, each, first bin, offset, capacity): ranks lo to hi of a length, ``each`` to a bin."""
    out, taken, first = [], {}, 0
    for count, capacity, contents in made:
        offset = 0
        for length, each in contents:
            lo = taken.get(length, 0)
            taken[length] = lo + count * each
            out.append((length, lo, lo + count * each, each, first, offset, capacity))
            offset += length * each
        first += count
    return out


def pack(docs: DataFrame, length: Column, id_col: str = "doc_id", capacities=CAPACITIES, overhead: int = OVERHEAD) -> DataFrame:
    """(id, piece, start, length, bin, capacity, offset) of every piece of every row.

    ``length`` is a column of token counts. Rows of null or no length take no room: one piece of
    length 0 without a bin. Ids may repeat or be null; each row is packed for itself.
    """
    most = max(capacities)
    rows = docs.select(F.col(id_col).alias("id"), F.greatest(F.coalesce(length, F.lit(0)), F.lit(0)).cast("long").alias("tokens"))
    rows = stored(rows, "pack-lengths")  # ordering reads its input twice, and the lengths cost more than the rest
    pieces = rows.select("id", "tokens", F.explode(F.expr(f"sequence(0L, greatest(tokens - 1L, 0L) div {most})")).alias("piece"))
    size = F.least(F.lit(most), F.col("tokens") - F.col("piece") * most).cast("int")
    pieces = pieces.select("id", "piece", (F.col("piece") * most).alias("start"), size.alias("length"))
    ordered = pieces.repartitionByRange("length", "id", "piece").sortWithinPartitions("length", "id", "piece")
    ordered = stored(ordered.withColumn("mark", F.monotonically_increasing_id()), "pack-order").withColumn("part", F.shiftright("mark", 33))
    counts = ordered.groupBy("part", "length").agg(F.count("*").alias("n"))
    parts = counts.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most max(capacities) + 1 rows
    firsts, total = [], 0
    for n in sorted(histogram):
        firsts.append((n, total))
        total += histogram[n]
    spark = docs.sparkSession
    firsts = F.broadcast(spark.createDataFrame(firsts, "length int, first long"))
    made = steps(plan({n: c for n, c in histogram.items() if n}, capacities, overhead))
    placed = small_or_not(spark.createDataFrame(made, "length int, lo long, hi long, each long, first_bin long, base long, capacity int"))
    rank = F.col("before") + F.col("mark").bitwiseAND(F.lit((1 << 33) - 1)) - F.col("first")
    ranked = ordered.join(F.broadcast(parts), "part").join(firsts, "length").select("id", "piece", "start", "length", rank.alias("rank"))
    out = ranked.join(placed.withColumnRenamed("length", "of"), (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")), "left")
    at = F.col("rank") - F.col("lo")
    return out.select(
        "id",
        "piece",
        "start",
        "length",
        (F.col("first_bin") + F.floor(at / F.col("each"))).cast("long").alias("bin"),
        "capacity",
        (F.col("base") + (at % F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )


def sequences(packed: DataFrame, ids: DataFrame) -> DataFrame:
    """(bin, capacity, ids) of every sequence: the ids of its pieces one after the other.

    ``ids`` has (id, ids), one row for each id; no sequence is longer than its capacity. Pieces of
    ids that ``ids`` lacks, and those without a bin, are left out.
    """
    parts = packed.where("bin is not null").join(ids.select("id", "ids"), "id").select("bin", "capacity", "offset", F.expr("slice(ids, cast(start + 1 as int), length)").alias("part"))
    made = parts.groupBy("bin", "capacity").agg(F.array_sort(F.collect_list(F.struct("offset", "part"))).alias("parts"))
    return made.select("bin", "capacity", F.flatten("parts.part").alias("ids"))
