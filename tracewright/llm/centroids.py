"""Centroid clustering: weighted deduplication and Lloyd's rounds in whole numbers.

Vectors are quantised to integers and equal ones folded to one with a multiplicity. Lloyd's rounds
run on the distinct vectors alone: every task sums its own, weighted, and a round ends as one row
for each centroid and component. All sums are exact, so neither partitions nor order change a
result. At the end the assignments of the distinct vectors are joined back to the ids.
"""

from __future__ import annotations

import hashlib
import sys
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.plans.materialize import empty_like, release, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Quantised components are held within this, far beyond any embedding, so that they fit a long.
REACH = 1 << 62
#: Numbers under this are summed as doubles or longs without a rounding error.
EXACT_DOUBLE, EXACT_LONG = 1 << 53, (1 << 63) - 1
#: Vectors that a task works on at a time.
STRIP = 1 << 14


def quantised(vectors: DataFrame, id_col: str, vec_col: str, size: int, scale: int) -> DataFrame:
    """(id, q, digest) of the vectors of exactly ``size`` components, none null or non-finite; q holds floor(scale * x)."""
    x = F.col("x")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    kept = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("x")).where((F.size(x) == size) & ~bad)
    whole = F.transform(x, lambda v: F.floor(F.greatest(F.lit(-float(REACH)), F.least(F.lit(float(REACH)), v * F.lit(float(scale))))))
    return kept.select("id", whole.alias("q")).withColumn("digest", F.unhex(F.sha2(F.array_join("q", ","), 256)))


def seeds(rows: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors of the least sha256 of ``seed:id``, in that order; vectors of equal ids in the order of their components, null ids as if empty."""
    of = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [list(r.q) for r in rows.select(of.alias("h"), "q").orderBy("h", "q").limit(k).collect()]


def nearest(q: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, the smaller number of equal ones, and the squared distance, in whole numbers however large."""
    c = np.array(centroids, object)
    reach = max(int(np.abs(q).max(initial=0)), max(abs(x) for row in centroids for x in row))
    if 16 * q.shape[1] * reach * reach < EXACT_DOUBLE:
        a, b = q.astype(np.float64), c.astype(np.float64)
        d = ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    else:
        a = q.astype(object)
        d = np.stack([((a - row) ** 2).sum(1) for row in c], axis=1)
    at = d.argmin(1)
    return at, d[np.arange(len(q)), at]


def weighted_sums(q: np.ndarray, w: np.ndarray, at: np.ndarray, k: int) -> list[list[int]]:
    """For each centroid the weighted sum of every component of its vectors, and the sum of the weights."""
    out = []
    bound = int(np.abs(q).max(initial=0)) * int(w.sum())
    for i in range(k):
        mine = at == i
        if bound < EXACT_LONG:
            total = (q[mine] * w[mine, None]).sum(0).tolist()
        else:
            total = (q[mine].astype(object) * w[mine, None].astype(object)).sum(0).tolist() if mine.any() else [0] * q.shape[1]
        out.append([*map(int, total), int(w[mine].sum())])
    return out


def _vectors(batch: pa.RecordBatch, size: int):
    for start in range(0, len(batch), STRIP):
        b = batch.slice(start, STRIP)
        yield b, b.column("q").flatten().to_numpy().reshape(-1, size)


def _round(distinct: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Every centroid that has vectors moved to the floor of their mean; one row for each number comes to the driver."""
    k, size = len(centroids), len(centroids[0])

    def run(batches):
        total = [[0] * (size + 1) for _ in range(k)]
        for batch in batches:
            for b, q in _vectors(batch, size):
                at, _ = nearest(q, centroids)
                made = weighted_sums(q, b.column("weight").to_numpy(), at, k)
                total = [[x + y for x, y in zip(s, t, strict=True)] for s, t in zip(total, made, strict=True)]
        rows = [(i, j, Decimal(v)) for i, s in enumerate(total) for j, v in enumerate(s) if v]
        cols = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.decimal128(38, 0)), strict=True)], ["c", "j", "v"])

    sums = distinct.select("q", "weight").mapInArrow(run, "c int, j int, v decimal(38,0)").groupBy("c", "j").agg(F.sum("v").alias("v")).collect()
    found = {(r.c, r.j): int(r.v) for r in sums}
    return [[found.get((i, j), 0) // n for j in range(size)] if (n := found.get((i, size), 0)) else row for i, row in enumerate(centroids)]


def digest_of(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def lloyd(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", size: int = 64, k: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    Vectors of another length, null vectors, and those with a null, infinite or NaN component have
    no row. Repeated rows count each; vectors at equal distances go to the smaller number; a centroid
    without vectors stays. With fewer than ``k`` vectors there are as many centroids, with none no
    rows. A distance or inertia too large for a long is null. Other columns are not read.
    """
    spark, kind = vectors.sparkSession, vectors.schema[id_col].dataType.simpleString()
    rows = quantised(vectors, id_col, vec_col, size, scale)
    centroids = seeds(rows, k, seed)
    if not centroids:
        return empty_like(spark, f"id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    distinct = stored(rows.groupBy("digest", "q").agg(F.count("*").alias("weight")), "distinct-vectors")
    for _ in range(rounds):
        before, centroids = centroids, _round(distinct, centroids)
        if centroids == before:  # every further round would give the same
            break

    def assign(batches):
        for batch in batches:
            for b, q in _vectors(batch, size):
                at, d = nearest(q, centroids)
                d = pa.array([x if x <= EXACT_LONG else None for x in d.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("digest"), b.column("weight"), pa.array(at, pa.int32()), d], ["digest", "weight", "cluster", "distance"])

    assigned = stored(distinct.mapInArrow(assign, "digest binary, weight long, cluster int, distance long"), "assigned-vectors")
    cost = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(19,0)") * F.col("weight")))
    costs = {r.cluster: None if r.cost is None else int(r.cost) for r in assigned.groupBy("cluster").agg(cost.alias("cost")).collect()}
    fits = lambda v: v if v is not None and v <= EXACT_LONG else None
    inertia = fits(None if None in costs.values() else sum(costs.values()))
    named = spark.createDataFrame([(i, fits(v), inertia, digest_of(centroids[i])) for i, v in costs.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    release(distinct)
    # The centroids, k rows, go to the distinct vectors first; then all of it to the ids.
    return rows.select("id", "digest").join(assigned.join(F.broadcast(named), "cluster").drop("weight"), "digest").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
