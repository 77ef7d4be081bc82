"""Content-addressed store of token ids.

Every document's ids are cut into chunks where a rolling hash of the last ids says so, so equal
passages give equal chunks wherever they stand. The store is three Parquet datasets under one path:

* ``parts/kind=chunk``  digest, n, payload: each different chunk once, ids as little-endian uint16
  (uint32 where the vocabulary is larger), at the place its digest gives;
* ``recipes``  pos, part, doc_id, start, n_tokens, digests, sizes, root: the documents in ascending
  id order, each with the digests of its chunks and their Merkle root;
* ``manifest``  level, node, digest: a Merkle tree of fan-out FAN over the documents' recipes.
"""

from __future__ import annotations

import hashlib
import os
import sys
import zlib
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.plans.materialize import small_or_not, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Ids the rolling hash sees, and least, expected and most ids of a chunk.
WINDOW, LEAST, USUAL, MOST = 16, 64, 256, 1024
#: Digests a task remembers.
REMEMBERED = 400_000
#: Words encoded in one call.
JOINED = 200
FAN = 1024
_POLY = 0xEDB88320


class Encoder:
    """Ids of whole texts by a tokenizer file; each different word is encoded once.

    The tokenizer must lower-case, drop white space, cut punctuation from letters and never join
    ids across a cut.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.tokenizer.get_vocab_size() if mark else 0, bool)
        for token, i in self.tokenizer.get_vocab().items() if mark else ():
            self.ends[i] = token.endswith(mark)

    def tokens(self, letters: list[str], others: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has.

        A word of letters alone ends with its only id that has the end-of-word mark, so such words
        are encoded many to a call and told apart afterwards.
        """
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        if not letters and not others:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(self.ends) and letters:
            lines = [" ".join(letters[i : i + JOINED]) for i in range(0, len(letters), JOINED)]
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in encode(lines, add_special_tokens=False)])
            stops = np.nonzero(self.ends[ids])[0]
            if len(stops) == len(letters) and stops[-1] == len(ids) - 1:
                rest, sizes = self.tokens([], others)
                return np.concatenate((ids, rest)), np.concatenate((np.diff(stops, prepend=-1), sizes))
        made = [e.ids for e in encode(letters + others, add_special_tokens=False)]
        sizes = np.fromiter(map(len, made), np.int64, len(made))
        return np.fromiter(chain.from_iterable(made), np.uint32, int(sizes.sum())), sizes

    @staticmethod
    def words(texts: pa.Array) -> pa.ListArray:
        """The words of each text with ``A-Z`` lower-cased, and a comma or stop after a letter as a word of its own.

        Texts in which special tokens may stand are split as they are.
        """
        plain = pc.replace_substring_regex(pc.ascii_lower(texts), r"([a-z])([.,])([\x20\x09-\x0D]|\z)", r"\1 \2\3")
        return pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, plain))

    def kinds(self, texts: pa.Array):
        """(number of each word, bounds of the texts, ids of the different words, begin and size of each word's)."""
        split = self.words(texts.fill_null(""))
        coded = split.flatten().dictionary_encode()
        idx, kinds = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        alone = np.fromiter(map(str.isalpha, kinds), bool, len(kinds))
        letters, others = [w for w, a in zip(kinds, alone, strict=True) if a], [w for w, a in zip(kinds, alone, strict=True) if not a]
        ids, sizes = self.tokens(letters, others)
        order = np.concatenate((np.nonzero(alone)[0], np.nonzero(~alone)[0]))
        begin, size = np.empty(len(kinds), np.int64), np.empty(len(kinds), np.int64)
        begin[order], size[order] = np.cumsum(sizes) - sizes, sizes
        return idx, np.concatenate(([0], np.cumsum(split.value_lengths().to_numpy()))), ids, begin, size

    def counts(self, texts: pa.Array) -> np.ndarray:
        """How many ids each text has, without an end."""
        idx, bounds, _, _, size = self.kinds(texts)
        return np.diff(np.concatenate(([0], np.cumsum(size[idx])))[bounds])

    def encode(self, texts: pa.Array, end: int):
        """Ids of each text in turn, with ``end`` at the end; nulls are empty."""
        idx, bounds, ids, begin, size = self.kinds(texts)
        for at in range(0, len(texts), 64):
            stops = bounds[at : min(at + 64, len(texts)) + 1]
            part = idx[stops[0] : stops[-1]]
            each = size[part]
            stop = np.concatenate(([0], np.cumsum(each)))
            found = ids[np.repeat(begin[part] - stop[:-1], each) + np.arange(stop[-1])]
            for a, b in zip(stop[stops[:-1] - stops[0]], stop[stops[1:] - stops[0]], strict=True):
                yield np.append(found[a:b], np.uint32(end))


def _mixed(ids: np.ndarray) -> np.ndarray:
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def cuts(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of one document; they depend on the ids of that document alone."""
    n, g = len(ids), _mixed(ids)
    rolled = g.copy()
    for k in range(1, min(WINDOW, n)):
        rolled[k:] += g[:-k] << np.uint64(k)
    out, last = [], 0
    for c in (np.nonzero(rolled >> np.uint64(64 - USUAL.bit_length() + 1) == 0)[0] + 1).tolist():
        while c - last > MOST:
            last += MOST
            out.append(last)
        if c - last >= LEAST:
            out.append(last := c)
    while n - last > MOST:
        last += MOST
        out.append(last)
    return out if last == n else [*out, n]


def digest_of(payload: bytes) -> bytes:
    return hashlib.blake2b(payload, digest_size=16).digest()


def merkle_root(leaves: list[bytes]) -> bytes:
    """Root of the binary tree over the leaves; an odd one is carried up."""
    while len(leaves) > 1:
        pairs = [hashlib.blake2b(b"\x01" + leaves[i] + leaves[i + 1], digest_size=16).digest() for i in range(0, len(leaves) - 1, 2)]
        leaves = pairs + leaves[len(leaves) - len(leaves) % 2 :]
    return leaves[0] if leaves else digest_of(b"")


def _encoded(docs: DataFrame, tokenizer_path: str, end: int) -> DataFrame:
    """A row for each document (its recipe) and one for each chunk new to the task (its payload)."""

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encoder, known, rows = Encoder(tokenizer_path), set(), 0
        kind = "<u4" if encoder.wide else "<u2"
        types = [pa.string(), pa.binary(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.int32(), pa.binary()]
        names = ["kind", "key", "id", "digests", "sizes", "n", "payload"]
        for b in batches:
            encoded = zip(b.column("id").to_pylist(), encoder.encode(b.column("text").cast(pa.string()), end), strict=True)
            while part := list(islice(encoded, 500)):
                out = [[] for _ in names]
                for doc_id, ids in part:
                    ends, raw = cuts(ids), ids.astype(kind).tobytes()
                    width = len(raw) // len(ids)
                    sizes, begin, digests = [], 0, []
                    for stop in ends:
                        payload = raw[begin * width : stop * width]
                        digests.append(d := digest_of(payload))
                        sizes.append(stop - begin)
                        if d not in known:
                            known.add(d)
                            for column, v in zip(out, ("chunk", d, None, None, None, stop - begin, payload), strict=True):
                                column.append(v)
                        begin = stop
                    for column, v in zip(out, ("doc", b"%d-%d" % (task, rows), doc_id, digests, sizes, len(ids), merkle_root(digests)), strict=True):
                        column.append(v)
                    rows += 1
                if len(known) > REMEMBERED:
                    known = set()
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    return docs.mapInArrow(run, "kind string, key binary, id string, digests array<binary>, sizes array<int>, n int, payload binary")


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", ends: int = 1) -> DataFrame:
    """(id, tokens) of every row: the ids of its whole text and ``ends`` more; a null text has none of its own."""

    def run(batches):
        encoder = Encoder(tokenizer_path)
        for b in batches:
            n = encoder.counts(b.column("text").cast(pa.string())) + ends
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64())], ["id", "tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, tokens long")


def write_store(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end: int = 2) -> None:
    """Encode every row's whole text, append ``end``, and write the store to ``path``.

    Null texts are empty: one end id. Rows of one id stand side by side; null ids come first. An
    empty table writes a store without rows.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    made = _encoded(docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")), tokenizer_path, end)
    # One shuffle serves both kinds of rows; copies of a chunk meet by digest and one is kept.
    once = made.repartition("key").dropDuplicates(["kind", "key"]).withColumnRenamed("kind", "of")
    once.withColumn("kind", F.col("of")).drop("of").write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/parts")
    docs_of = spark.read.schema(made.schema).parquet(f"{path}/parts").where("kind = 'doc'")
    ordered = docs_of.select(F.col("id").cast(kind).alias("doc_id"), F.col("n").cast("long").alias("n_tokens"), "digests", "sizes", F.col("payload").alias("root"), "key")
    ordered = ordered.repartitionByRange("doc_id", "root").sortWithinPartitions("doc_id", "root", "key").drop("key")
    ordered = stored(ordered.withColumn("mark", F.monotonically_increasing_id()), "recipes-in-order").withColumn("part", F.shiftright("mark", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    parts = ordered.groupBy("part").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("m"))
    parts = parts.select("part", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t"), F.coalesce(F.sum("m").over(before), F.lit(0)).alias("m"))
    within = Window.partitionBy("part").orderBy("mark").rowsBetween(Window.unboundedPreceding, 0)
    recipes = ordered.withColumn("sum", F.sum("n_tokens").over(within)).join(F.broadcast(parts), "part")
    pos = F.col("m") + F.col("mark").bitwiseAND(F.lit((1 << 33) - 1))
    recipes = recipes.select(pos.alias("pos"), "part", "doc_id", (F.col("t") + F.col("sum") - F.col("n_tokens")).alias("start"), "n_tokens", "digests", "sizes", "root")
    recipes.write.parquet(f"{path}/recipes")
    manifest(read_recipes(spark, path)).write.parquet(f"{path}/manifest")


def read_recipes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/recipes")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(digest, n, payload) of every chunk in the store."""
    schema = "key binary, id string, digests array<binary>, sizes array<int>, n int, payload binary, kind string"
    return spark.read.schema(schema).parquet(f"{path}/parts").where("kind = 'chunk'").select(F.col("key").alias("digest"), "n", "payload")


def manifest(recipes: DataFrame) -> DataFrame:
    """(level, node, digest): the Merkle tree over the documents, each by its place, id, start, length and root.

    FAN children to a node, in their order. Each level is one aggregation over lists of at most FAN
    digests; the last level is the root. A level is made only while the one below has several nodes.
    """
    level = _leaves(recipes)
    out, depth, count = None, 0, (recipes.agg(F.max("pos")).first()[0] or 0) + 1
    while count > 1 or depth == 0:
        depth, count = depth + 1, -(-count // FAN)
        level = _parents(level)
        made = level.select(F.lit(depth).alias("level"), "node", "digest")
        out = made if out is None else out.union(made)
    return out


def _leaves(recipes: DataFrame) -> DataFrame:
    leaf = F.concat_ws("|", F.hex("root"), "pos", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "start", "n_tokens")
    return recipes.select(F.col("pos").alias("node"), leaf.alias("digest"))


def _parents(level: DataFrame) -> DataFrame:
    children = F.expr("transform(array_sort(collect_list(struct(node, digest))), x -> x.digest)")
    return level.groupBy((F.floor(F.col("node") / FAN)).alias("up")).agg(F.sha2(F.array_join(children, ";"), 256).alias("digest")).withColumnRenamed("up", "node")


def intact_groups(recipes: DataFrame, tree: DataFrame) -> DataFrame:
    """(node, intact) of each group of FAN documents: whether its recipes, and every stored node above it, give the stored digests.

    The stored tree is read level by level, from the groups, whose digests are made anew from the
    recipes, up to the root; there is a row for each FAN documents. A lost, doubled, changed or
    exchanged recipe spoils its group; a changed node those below it.
    """
    tops = {r.level: r.n for r in tree.groupBy("level").agg(F.count("*").alias("n")).collect()}
    groups = _parents(_leaves(recipes)).withColumnRenamed("digest", "made")
    good = groups.join(tree.where("level = 1").select("node", "digest"), "node", "left").select("node", F.coalesce(F.col("made") == F.col("digest"), F.lit(False)).alias("intact"))
    if not tops or tops[max(tops)] != 1:
        return good.withColumn("intact", F.lit(False))
    for depth in range(2, max(tops) + 1):
        below, stored_level = tree.where(F.col("level") == depth - 1).select("node", "digest"), tree.where(F.col("level") == depth).select(F.col("node").alias("up"), F.col("digest").alias("said"))
        right = _parents(below).select(F.col("node").alias("up"), "digest").join(stored_level, "up").where("digest = said").select("up", F.lit(True).alias("right"))
        above = F.floor(F.col("node") / FAN ** (depth - 1))
        good = good.withColumn("up", above).join(right, "up", "left").select("node", (F.col("intact") & F.coalesce("right", F.lit(False))).alias("intact"))
    return good


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials modulo the CRC-32 polynomial, in its reflected bit order."""
    out, b = np.zeros(len(b), np.uint32), b.copy()
    for bit in range(31, -1, -1):
        out ^= np.where((a >> np.uint32(bit)) & np.uint32(1), b, np.uint32(0))
        b = (b >> np.uint32(1)) ^ np.where(b & np.uint32(1), np.uint32(_POLY), np.uint32(0))
    return out


def crc_before(crc: np.ndarray, after: np.ndarray) -> np.ndarray:
    """CRC-32 of chunks, moved before ``after`` further bytes: xor of all of a text's is its CRC-32."""
    out, after = crc.astype(np.uint32), after.astype(np.int64)
    power = np.array([1 << 30], np.uint32)  # x
    for _ in range(3):
        power = _times(power, power)  # x ** 8
    for bit in range(int(after.max(initial=0)).bit_length()):
        at = np.nonzero((after >> bit) & 1)[0]
        if len(at):
            out[at] = _times(np.broadcast_to(power, len(at)).copy(), out[at])
        power = _times(power, power)
    return out


def verified(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, verified) of every document, from the files alone.

    Each stored chunk is read once, its digest compared with its payload, and its CRC-32 taken over
    the ids as uint32; a document's CRC-32 is put together from those of its chunks, so payloads
    are not shuffled. ``verified``: all chunks are there and whole, the lengths agree, the
    recipe's digests have its Merkle root, and the stored manifest holds for the group of recipes
    that it stands in, so a lost or exchanged recipe shows in the FAN documents around it.
    """

    def check(batches):
        for b in batches:
            payloads, digests, ns = (b.column(c).to_pylist() for c in ("payload", "digest", "n"))
            ids = [np.frombuffer(p, "<u4" if len(p) == 4 * n else "<u2").astype("<u4") for p, n in zip(payloads, ns, strict=True)]
            good = [digest_of(p) == d and len(i) == n for p, d, i, n in zip(payloads, digests, ids, ns, strict=True)]
            arrays = [b.column("digest"), pa.array([len(i) for i in ids], pa.int32()), pa.array([zlib.crc32(i) for i in ids], pa.int64()), pa.array(good, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, ["digest", "size", "crc", "good"])

    @F.pandas_udf("long")
    def moved(crc: pd.Series, after: pd.Series) -> pd.Series:
        return pd.Series(crc_before(crc.to_numpy(), after.to_numpy()).astype(np.int64))

    @F.pandas_udf("boolean")
    def rooted(digests: pd.Series, root: pd.Series) -> pd.Series:
        return pd.Series([merkle_root([bytes(d) for d in ds]) == bytes(r) for ds, r in zip(digests, root, strict=True)])

    chunks = read_chunks(spark, path).mapInArrow(check, "digest binary, size int, crc long, good boolean")
    def placed(batches):
        """A row for each chunk of each document, with the bytes that follow it."""
        for b in batches:
            lengths = b.column("sizes").value_lengths().to_numpy()
            sizes = b.column("sizes").flatten().to_numpy().astype(np.int64)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            after = np.repeat(ends[np.cumsum(lengths)], lengths) - ends[1:]
            columns = [np.repeat(b.column("pos").to_numpy(), lengths), b.column("digests").flatten(), sizes, after * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["pos", "digest", "want", "after"])

    recipes = read_recipes(spark, path)
    uses = recipes.select("pos", "digests", "sizes").mapInArrow(placed, "pos long, digest binary, want long, after long")
    found = uses.join(chunks, "digest", "left")
    whole = F.coalesce(F.col("good") & (F.col("size") == F.col("want")), F.lit(False))
    found = found.select("pos", moved(F.coalesce("crc", F.lit(0)), F.col("after")).alias("crc"), F.coalesce("size", F.lit(0)).cast("long").alias("size"), whole.alias("whole"))
    sums = found.groupBy("pos").agg(F.bit_xor("crc").alias("ids_crc32"), F.sum("size").alias("n_read"), F.every("whole").alias("whole"))
    groups = stored(intact_groups(recipes.select("pos", "doc_id", "start", "n_tokens", "root"), spark.read.parquet(f"{path}/manifest")), "manifest-groups")
    out = recipes.select("pos", "doc_id", "start", "n_tokens", rooted("digests", "root").alias("rooted")).join(sums, "pos")
    out = out.withColumn("node", F.floor(F.col("pos") / FAN)).join(small_or_not(groups), "node", "left")
    return out.select("doc_id", "start", F.col("n_read").alias("n_tokens"), "ids_crc32", (F.col("whole") & F.col("rooted") & (F.col("n_read") == F.col("n_tokens")) & F.coalesce("intact", F.lit(False))).alias("verified"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids): every document's ids put together again from its chunks."""

    @F.pandas_udf("array<long>")
    def joined(payloads: pd.Series, sizes: pd.Series) -> pd.Series:
        whole = [(b"".join(bytes(x) for x in p), sum(s)) for p, s in zip(payloads, sizes, strict=True)]
        return pd.Series([np.frombuffer(raw, "<u4" if len(raw) == 4 * n else "<u2").astype(np.int64) for raw, n in whole])

    recipes = read_recipes(spark, path)
    uses = recipes.select("pos", F.posexplode("digests").alias("i", "digest")).join(read_chunks(spark, path), "digest")
    parts = uses.groupBy("pos").agg(F.array_sort(F.collect_list(F.struct("i", "payload", "n"))).alias("x"))
    return recipes.select("pos", "doc_id", "start").join(parts, "pos").select("doc_id", "start", joined("x.payload", "x.n").alias("ids"))
