"""MinHash near-duplicates: circulant signatures, banding, exact Jaccard verification.

Two permutations of the 32-bit numbers give every coordinate of a signature: one scatters the
shingles of a document, the other is shifted round by one place for each coordinate, and the
coordinate is the least number it gives. Signatures are cut into bands; documents that agree in a
whole band meet in a bucket. Buckets are compared block by block: signatures first, and of what
they leave the full shingle sets.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.shared import row_key, within
from tracewright.plans.components import connected_components
from tracewright.plans.materialize import release, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Coordinates of a signature, and how many of them make a band. Two documents of similarity 0.85 share no band with probability (1 - 0.85^5)^32 = 7e-9.
COORDINATES, ROWS = 160, 5
#: Standard deviations of the share of equal coordinates that a pair may fall short of the least similarity before its sets are left uncompared.
MARGIN = 7
#: Rows of a block of a bucket, and shingles of a block at most where its documents are long.
BLOCK, BLOCK_SHINGLES = 256, 4 << 20
#: Numbers permuted at a time.
STRIP = 1 << 10
#: Columns of the incidence matrix that are multiplied at a time.
COLUMNS = 1 << 12


def _scattered(x: np.ndarray) -> np.ndarray:
    """The first permutation: 64-bit hashes to 32-bit numbers."""
    return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def _permuted(y: np.ndarray) -> np.ndarray:
    """The second permutation, of the 32-bit numbers."""
    y = y ^ (y >> np.uint32(16))
    y *= np.uint32(0x7FEB352D)
    y ^= y >> np.uint32(15)
    y *= np.uint32(0x846CA68B)
    return y


def signatures(sets: np.ndarray, bounds: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """A row of coordinates for each set; the sets lie one after the other in ``sets``, none of them empty."""
    low, out = _scattered(sets), np.full((len(bounds) - 1, coordinates), 0xFFFFFFFF, np.uint32)
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    for at in range(0, len(low), STRIP):
        part = _permuted(low[None, at : at + STRIP] + shifts)
        a, b = np.searchsorted(bounds, at, "right") - 1, np.searchsorted(bounds, min(at + STRIP, len(low)), "left")
        starts = np.maximum(bounds[a:b] - at, 0)
        out[a:b] = np.minimum(out[a:b], np.minimum.reduceat(part, starts, axis=1).T)
    return out


def bands(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit number for each band of each signature."""
    cut = signature.reshape(len(signature), signature.shape[1] // rows, rows).astype(np.uint64)
    out = np.zeros(cut.shape[:2], np.uint64)
    for i in range(rows):
        out = (out ^ cut[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def shingle_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct shingles of each text, sorted, one text after the other, and the bounds of the texts.

    ``A-Z`` are lower-cased and words split at ASCII white space. A text of fewer words than a
    shingle has its whole sequence as one; a text without words, or null, has none.
    """
    import xxhash

    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    coded = split.flatten().dictionary_encode()
    kinds = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in kinds), np.uint64, len(kinds))
    idx, ends = coded.indices.to_numpy(), np.concatenate(([0], np.cumsum(split.value_lengths().to_numpy())))
    if "" in kinds:  # white space at either end of a text leaves an empty piece
        real = idx != kinds.index("")
        idx, ends = idx[real], np.concatenate(([0], np.cumsum(real)))[ends]
    words, out, sizes = hashes[idx], [], []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        w = words[a:b]
        n = max(1, len(w) - shingle + 1)
        mixed = np.full(n, min(len(w), shingle), np.uint64)
        for i in range(min(len(w), shingle)):
            mixed = (mixed ^ w[i : i + n]) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
        found = np.unique(mixed) if len(w) else mixed[:0]
        out.append(found)
        sizes.append(len(found))
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def _slices(batch: pa.RecordBatch, most: int = 8 << 20):
    """Pieces of a batch of about ``most`` bytes, so that long texts stand alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // most
    for at in np.unique(group, return_index=True)[1].tolist() if len(sizes) else []:
        yield batch.slice(at, int((group == group[at]).sum()))


def _marked(docs: DataFrame, shingle: int, coordinates: int, rows: int) -> DataFrame:
    """(id, k, d, n, key, sig, bands) of every row; rows of equal sets have equal keys, and those of empty sets none."""

    def run(batches):
        for batch in batches:
            for b in _slices(batch):
                sets, bounds = shingle_sets(b.column("text").cast(pa.string()), shingle)
                sizes = np.diff(bounds)
                full = np.nonzero(sizes)[0]
                sig = signatures(sets, np.append(bounds[full], len(sets)), coordinates)
                keys, sigs, cut = ([None] * len(sizes) for _ in range(3))
                for i, s, c in zip(full.tolist(), sig.astype(np.uint8), bands(sig, rows), strict=True):
                    keys[i] = hashlib.blake2b(sets[bounds[i] : bounds[i + 1]].tobytes(), digest_size=16).digest()
                    sigs[i], cut[i] = s.tobytes(), c
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("k"), b.column("d"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary()), pa.array(cut, pa.list_(pa.int64()))], ["id", "k", "d", "n", "key", "sig", "bands"])

    src = docs.select("id", "text", F.col("__k").alias("k"), F.col("__d").alias("d"))
    return src.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, k long, d int, n long, key binary, sig binary, bands array<long>")


def _units(batches, names: list[str]):
    """Rows that are sorted by unit, given unit by unit, as one table for each; a unit may span batches."""
    held: list[pa.Table] = []
    for batch in batches:
        t = pa.Table.from_batches([batch])
        keys = np.stack([t.column(n).to_numpy() for n in names])
        if not len(t):
            continue
        cuts = np.nonzero((keys[:, 1:] != keys[:, :-1]).any(0))[0] + 1
        if held and tuple(keys[:, 0]) != tuple(held[0].column(n)[0].as_py() for n in names):
            yield pa.concat_tables(held)
            held = []
        edges = [0, *cuts.tolist(), len(t)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a:
                yield pa.concat_tables(held)
                held = []
            held.append(t.slice(a, b - a))
    if held:
        yield pa.concat_tables(held)


UNIT = ["b", "h", "lo", "hi"]


def _sides(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a unit's lower and higher block; the same where it has one."""
    own = t.column("own").to_numpy()
    return np.nonzero(own == t.column("lo")[0].as_py())[0], np.nonzero(own == t.column("hi")[0].as_py())[0]


def _hopeful(percent: int, coordinates: int):
    """The function that leaves of each unit the nodes with a pair that may be similar enough and meets in no earlier band."""
    need = percent / 100
    least = need - MARGIN * (need * (1 - need) / coordinates) ** 0.5

    def run(batches):
        for t in _units(batches, UNIT):
            left, right = _sides(t)
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(len(t), -1)
            cut = t.column("bands").combine_chunks().flatten().to_numpy().reshape(len(t), -1)[:, : t.column("b")[0].as_py()]
            n, same, keep = t.column("n").to_numpy(), left is right or np.array_equal(left, right), np.zeros(len(t), bool)
            for at, i in enumerate(left.tolist()):
                other = right[at + 1 :] if same else right
                other = other[100 * np.minimum(n[other], n[i]) >= percent * np.maximum(n[other], n[i])]
                other = other[(sig[other] == sig[i]).mean(1) >= least] if len(other) else other
                other = other[~(cut[other] == cut[i]).any(1)] if len(other) else other
                keep[other] = True
                keep[i] |= len(other) > 0
            if keep.any():
                yield from t.select([*UNIT, "own", "node"]).filter(pa.array(keep)).to_batches()

    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many numbers each two of the sets (sorted, distinct) share."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1]))
    column = np.cumsum(new) - 1
    several = np.bincount(column)[column] > 1
    column, owner = column[several], owner[several]
    column = np.cumsum(np.concatenate(([True], column[1:] != column[:-1]))) - 1 if len(column) else column
    out = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _linked(percent: int):
    """The function that gives of each unit the links (u, v) of a spanning forest: every two nodes that links join in it are joined."""

    def run(batches):
        for t in _units(batches, UNIT):
            nodes, left_right = t.column("node").to_pylist(), _sides(t)
            sets = [np.frombuffer(s, np.uint64) for s in t.column("set").to_pylist()]
            n = np.array([len(s) for s in sets], np.int64)
            common = shared_counts(sets)
            close = 100 * common >= percent * (n[:, None] + n[None, :] - common)
            across = np.zeros_like(close)
            across[np.ix_(*left_right)] = True
            u, v = np.nonzero(np.triu(close & (across | across.T), 1))
            top = list(range(len(nodes)))

            def root(x, top=top):
                while top[x] != x:
                    top[x] = x = top[top[x]]
                return x

            out = []
            for a, b in zip(u.tolist(), v.tolist(), strict=True):
                if (x := root(a)) != (y := root(b)):
                    top[y] = x
                    out.append((nodes[a], nodes[b]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["u", "v"])

    return run


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(node, set) of rows (node, text): the shingle set as little-endian 64-bit numbers."""

    def run(batches):
        for batch in batches:
            for b in _slices(batch):
                sets, bounds = shingle_sets(b.column("text").cast(pa.string()), shingle)
                rows = [sets[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(rows, pa.binary())], ["node", "set"])

    return docs.select("node", "text").mapInArrow(run, "node long, set binary")


def links(nodes: DataFrame, texts: DataFrame, percent: int, shingle: int, coordinates: int) -> DataFrame:
    """Links (u, v) that join the same nodes as all links of 100 * intersection >= percent * union would.

    A bucket is dealt into blocks, so no bucket is one task's; a unit is two blocks of a bucket.
    Every pair of nodes that meet is compared in the first band in which they agree. Only nodes left
    by the signatures have their sets made and moved, and a unit gives links by a spanning forest,
    never all its pairs.
    """
    each = nodes.select("node", "n", F.posexplode("bands").alias("b", "h"))
    most = F.greatest(F.lit(2), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_SHINGLES) / F.max("n"))))
    buckets = each.groupBy("b", "h").agg(F.count("*").alias("m"), most.alias("most")).where("m > 1")
    buckets = buckets.select("b", "h", F.ceil(F.col("m") / F.col("most")).cast("int").alias("blocks"))
    members = each.join(buckets, ["b", "h"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    members = stored(members.select("b", "h", "node", "own", "blocks"), "bucket-members")
    places = F.expr("transform(sequence(0, blocks - 1), x -> struct(least(x, own) as lo, greatest(x, own) as hi))")
    units = members.join(nodes.select("node", "n", "sig", "bands"), "node").select("b", "h", "node", "own", "n", "sig", "bands", F.explode(places).alias("p"))
    units = units.select("b", "h", "p.lo", "p.hi", "own", "node", "n", "sig", "bands").repartition(*UNIT).sortWithinPartitions(*UNIT, "node")
    near = stored(units.mapInArrow(_hopeful(percent, coordinates), "b int, h long, lo int, hi int, own int, node long"), "near-members")
    wanted = stored(near.select("node").distinct().join(nodes.select("node", "k", "d"), "node"), "near-nodes")
    keys = wanted.select(F.col("k").alias("__k"), F.col("d").alias("__d"), "node")
    rows = within(texts, keys).join(keys, ["__k", "__d"]).dropDuplicates(["node"])
    sets = stored(_sets(rows, shingle), "near-sets")
    whole = near.join(sets, "node").repartition(*UNIT).sortWithinPartitions(*UNIT, "node")
    found = stored(whole.select(*UNIT, "own", "node", "set").mapInArrow(_linked(percent), "u long, v long"), "near-links")
    release(members, near, wanted, sets)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, shingle: int = 3, coordinates: int = COORDINATES, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, component, kept) of every row.

    Two rows are linked if 100 * intersection >= percent * union of their shingle sets; the
    component is the least id reachable, and the row of that id is kept. Rows of equal sets are one
    node, so a group of copies of any size costs one. Null, empty and wordless texts have no
    shingles and are linked with nothing. A null id takes part but names no component; where a group
    has none but null ids its component is null, and it is not kept. Of repeated ids each row is
    kept whose id is its component. An empty table gives no rows; other columns are not read.
    """
    if coordinates % rows:
        raise ValueError("bands cut the coordinates evenly")
    texts = row_key(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text")
    made = stored(_marked(texts, shingle, coordinates, rows), "signatures")
    nodes = made.where("key is not null").select("key", "k", "d", "n", "sig", "bands").dropDuplicates(["key"])
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "shingle-nodes")
    found = links(nodes, texts, percent, shingle, coordinates)
    parts = stored(connected_components(found, "u", "v"), "shingle-parts")
    least = made.where("key is not null").groupBy("key").agg(F.min("id").alias("least"))
    named = nodes.select("key", "node").join(parts, "node", "left").join(least, "key").withColumn("part", F.coalesce("component", "node"))
    named = stored(named.select("key", "part", "least"), "shingle-names")
    tops = named.groupBy("part").agg(F.min("least").alias("component"))
    named = stored(named.join(tops, "part").select("key", "component"), "shingle-tops")
    release(nodes, parts)
    alone = made.where("key is null").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component"))
    joined = made.where("key is not null").select("id", "key", F.col("n").alias("n_shingles")).join(named, "key").select("id", "n_shingles", "component")
    return joined.union(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(False)))
