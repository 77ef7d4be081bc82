"""Column helpers that several corpus operators use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.plans.materialize import small_or_not

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = r"[\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """``A-Z`` lower-cased; every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def space_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def row_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus __k and __d, which depend on the id and the text alone.

    They are two hashes, 96 bits together, so they name a row alike in every scan, whatever the
    partitions; only equal rows share them.
    """
    return docs.withColumns({"__k": F.xxhash64(F.col(id_col), F.col(text_col)), "__d": F.hash(F.col(id_col), F.col(text_col))})


#: Bits of the filter that keeps texts out of a shuffle: 16 MB in all, in rows of 4096 bytes each.
FILTER_BITS = 1 << 27


def _marked(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` (row, k, d) with ``maybe``: false only where (k, d) is surely not in ``keys`` (__k, __d).

    ``keys`` set bits of a table of fixed size, which is broadcast.
    """
    bit = lambda k: F.pmod(k, F.lit(FILTER_BITS)) + 1
    mine = bit(F.col("__k"))
    bits = keys.groupBy(F.bitmap_bucket_number(mine).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(mine)).alias("bits"))
    out = rows.withColumns({"bucket": F.bitmap_bucket_number(bit(F.col("k"))), "at": F.bitmap_bit_position(bit(F.col("k")))}).join(F.broadcast(bits), "bucket", "left")
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(F.col("at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    out = out.select("row", "k", "d", byte.alias("byte"), "at")
    return out.select("row", "k", "d", F.coalesce(F.expr("shiftright(byte, cast(at % 8 as int)) & 1 = 1"), F.lit(False)).alias("maybe"))


def _rows(docs: DataFrame, k: Column, d: Column) -> DataFrame:
    """Every row as one value beside its key, so that no name of its columns can clash."""
    return docs.select(F.struct("*").alias("row"), k.alias("k"), d.alias("d"))


def _keys(keys: DataFrame) -> DataFrame:
    return keys.select(F.col("__k").alias("k"), F.col("__d").alias("d"))


def within(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The keyed rows of ``docs`` whose (__k, __d) is in ``keys``; see ``without``."""
    keys = keys.select("__k", "__d")
    sized = small_or_not(keys)
    if sized is not keys:
        return docs.join(sized, ["__k", "__d"], "left_semi")
    marked = _marked(_rows(docs, F.col("__k"), F.col("__d")), keys).where("maybe")
    return marked.join(_keys(keys), ["k", "d"], "left_semi").select("row.*")


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose (id, text) has a key that is not in ``gone`` (__k, __d); null keys are in no table.

    A stored ``gone`` of checked size is broadcast, so texts stay where they are. Beyond that size
    a broadcast filter of fixed size lets through the rows that are surely kept, and only the others
    are joined by a shuffle. No column name of ``docs`` is reserved.
    """
    k, d = (f(docs[f"`{id_col}`"], docs[f"`{text_col}`"]) for f in (F.xxhash64, F.hash))
    gone = gone.select("__k", "__d")
    sized = small_or_not(gone)
    if sized is not gone:
        return docs.join(sized, (k == sized["__k"]) & (d == sized["__d"]), "left_anti")
    marked = _marked(_rows(docs, k, d), gone)
    there = marked.where("maybe").join(_keys(gone), ["k", "d"], "left_anti")
    return marked.where("not maybe").select("row").union(there.select("row")).select("row.*")


def one_of_each(docs: DataFrame, repeated: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row for each key of ``repeated`` (__k, __d): the least by the hash of all its columns. Other rows stay where they are."""
    k, d = (f(docs[f"`{id_col}`"], docs[f"`{text_col}`"]) for f in (F.xxhash64, F.hash))
    rows = _rows(docs, k, d).withColumn("h", F.xxhash64("row"))
    several = rows.join(small_or_not(_keys(repeated)), ["k", "d"], "left_semi")
    one = several.groupBy("k", "d").agg(F.min_by("row", F.struct("h", F.to_json("row"))).alias("row")).select("row.*")
    return without(docs, repeated, id_col, text_col).union(one)
