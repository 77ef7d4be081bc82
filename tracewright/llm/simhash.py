"""SimHash near-duplicates: deletion-variant signatures, equality join, verification.

A 64-bit fingerprint is cut into two halves. Of two fingerprints that differ in at most three bits,
one half differs in at most one, so the halves are either equal or equal once that one bit is
wildcarded. Each half is indexed whole and with each of its bits wildcarded; an equality join on
these variants finds every such pair, and the bits are then counted.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.shared import row_key
from tracewright.plans.components import connected_components
from tracewright.plans.materialize import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Hashes unpacked to bits at a time; bounds the memory a very long text takes.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of one text; 0 where it has no words.

    ``A-Z`` are lower-cased and words are split at ASCII white space. A bit is set if it is set in
    more than half of the XXH64 (seed 42) hashes of the word shingles, repeats included. Texts with
    fewer words than a shingle hash as one shingle.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    first = np.concatenate(([0], ends[: n - 1])).tolist()
    last = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        part = [digest(joined[a:b], 42) for a, b in zip(first[at : at + BLOCK], last[at : at + BLOCK], strict=True)]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, __k, __d, fp) of every row; one fp long each, beside the row key. Null texts count as empty."""

    def run(batches):
        for b in batches:
            fps = [fingerprint(t if isinstance(t, str) else None, shingle) for t in b["text"]]
            yield pd.DataFrame({"fp": np.array(fps, np.int64), "id": b["id"], "__k": b["__k"], "__d": b["__d"]})[["id", "__k", "__d", "fp"]]

    src = row_key(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text")
    kind = src.schema["id"].dataType.simpleString()
    # An id that is null would turn a pandas column of longs into floats: ids travel as text.
    out = src.withColumn("id", F.col("id").cast("string")).mapInPandas(run, "id string, __k long, __d int, fp long")
    return out.select(F.col("id").cast(kind).alias("id"), "__k", "__d", "fp")


def variants(fps: DataFrame) -> DataFrame:
    """(fp, key, j, side): each half of ``fp`` whole (j = 32) and with bit j wildcarded.

    ``side`` is the wildcarded bit, so that a join of side 0 with side 1 meets a pair once a half.
    """
    each = fps.select("fp", F.explode(F.expr("sequence(0, 65)")).alias("i"))
    each = each.select("fp", F.expr("i div 33").alias("half"), F.expr("cast(i % 33 as int)").alias("j"))
    each = each.withColumn("v", F.expr("shiftrightunsigned(fp, cast(32 * half as int)) & 4294967295L"))
    rest = F.expr("if(j = 32, v, v & ~shiftleft(1L, j))")
    key = rest.bitwiseOR(F.expr("shiftleft(cast(half * 33 + j as bigint), 32)"))
    return each.select("fp", "j", key.alias("key"), F.expr("if(j = 32, -1, cast(shiftrightunsigned(v, j) & 1 as int))").alias("side"))


def close_pairs(fps: DataFrame, most: int = 3) -> DataFrame:
    """Distinct pairs (u, v) of the distinct fingerprints ``fps`` that differ in at most ``most`` <= 3 bits.

    Every link between different fingerprints is found: no bucket is capped, and a join partition
    that holds a large bucket is split by adaptive execution. The 66 variants of a fingerprint are
    sized like the one row they are made of, so the join is told to shuffle.
    """
    if not 0 <= most <= 3:
        raise ValueError("two halves reach at most three bits")
    index = variants(fps)
    a = index.where("side <> 1").select(F.col("fp").alias("u"), "key", "j")
    b = index.where("side <> 0").select(F.col("fp").alias("v"), "key")
    near = (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= most) & ((F.col("j") < 32) | (F.col("u") < F.col("v")))
    pairs = a.join(b.hint("merge"), (a["key"] == b["key"]) & near)
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _named(marked: DataFrame, first: Column, most: int) -> DataFrame:
    """(fp, component): the least ``first`` of the rows that are reachable from the fingerprint."""
    nodes = stored(marked.groupBy("fp").agg(F.min(first).alias("least")), "fingerprint-nodes")
    parts = connected_components(close_pairs(nodes.select("fp"), most), "u", "v")
    parts = stored(parts, "fingerprint-parts").withColumnRenamed("node", "fp")
    tops = parts.join(nodes, "fp").groupBy("component").agg(F.min("least").alias("top"))
    named = nodes.join(parts.join(tops, "component").select("fp", "top"), "fp", "left")
    # Stored, so that both sides of the last join are dealt out anew and a hot fingerprint can be split.
    return stored(named.select("fp", F.coalesce("top", "least").alias("component")), "fingerprint-names")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, most: int = 3) -> DataFrame:
    """(id, fp, component): the least id reachable over links of at most ``most`` differing bits.

    Copies share a fingerprint and are folded to it before any join, so a group of copies of any
    size costs one node. Rows with a null id take part but never name a component; a group of only
    null ids has a null component. Empty tables give no rows.
    """
    marked = stored(fingerprints(docs, id_col, text_col, shingle).select("id", "fp"), "fingerprints")
    return marked.join(_named(marked, F.col("id"), most), "fp").select("id", "fp", "component")


def row_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, most: int = 3) -> DataFrame:
    """(__k, __d, first) of every row: whether it is the one of its component to keep.

    That is the row of the least (id, __k, __d), null ids last; only equal rows are first together.
    """
    marked = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    named = _named(marked, F.struct(F.col("id").isNull().alias("null"), "id", "__k", "__d"), most)
    first = (F.col("__k") == F.col("component.__k")) & (F.col("__d") == F.col("component.__d"))
    return marked.join(named, "fp").select("__k", "__d", first.alias("first"))
