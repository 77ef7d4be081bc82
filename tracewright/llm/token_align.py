"""Cross-tokenizer alignment: byte-owner arrays of two tokenizers over the same bytes.

Both tokenizers cover a space and the text byte by byte. The index of the token that owns a byte is
repeated over its bytes, once for each tokenizer; where the pair of owners changes a new link
begins, and where both change at once a group ends.

Neither tokenizer joins bytes across a place where a space follows a character that is no white
space, so a text is cut there into pieces, each different piece of a task is tokenised and aligned
once, and a text's result is that of its pieces in turn.
"""

from __future__ import annotations

import os
import re
import sys
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.plans.materialize import release, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: White space, and characters that some count as such: a piece never begins after one of them.
BLANKS = r"\x00-\x20\x7F-\xA0\x{1680}\x{180E}\x{2000}-\x{200F}\x{2028}-\x{202F}\x{205F}-\x{206F}\x{2581}\x{3000}\x{FEFF}"
#: A character of the private planes that marks cuts; texts that hold it are cut in Python.
CUT = "\U0010fffe"
#: Bytes of texts taken at a time, and pieces that a task remembers.
STRIP, REMEMBERED = 4 << 20, 200_000
#: Pieces encoded as one line, and lines in one call, which bounds what the library holds at a time.
JOINED, CALL = 100, 200
#: Pairs of ids with a count that are broadcast at most: the most frequent ones. The rest are joined by a shuffle.
HEAD = 1_000_000
_PYTHON_BLANKS = re.sub(r"\\x\{(\w+)\}", lambda m: f"\\u{m[1]}", BLANKS)


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte: printable ones stand for themselves, the rest follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Tokenises and aligns pieces; each different one once."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        size = self.a.get_vocab_size(with_added_tokens=True)
        tokens = [self.a.id_to_token(i) or "" for i in range(size)]
        self.bytes_a = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in tokens]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("\u2581" in p.lstrip("\u2581") for p in pieces):
            raise ValueError("a piece goes on after a space, so texts cannot be cut at spaces")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else p.replace("\u2581", " ").encode() for i, p in enumerate(pieces)]
        self.width = len(pieces)
        self.len_a, self.len_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        # A token as it is written among groups: its id and what follows it.
        self.labels = pa.array([f"{i}{end}" for n, ends in ((size, ",|"), (self.width, ",;")) for end in ends for i in range(n)])
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.good, self.counts = np.zeros(0, bool), np.zeros((0, 3), np.int64)
        self.codes, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.order = np.zeros(0, np.int32)

    def _covers(self, raw: bytes, a: list[int], b: list[int]) -> bool:
        """Whether the tokens of both give back the bytes."""
        return b"".join(map(self.bytes_a.__getitem__, a)) == raw == b"".join(map(self.bytes_b.__getitem__, b))

    def _alone(self, piece: str) -> tuple[list[int], list[int]]:
        """Both tokenizers' ids of a piece, whose first space is the one that B adds itself; none where they do not cover it."""
        a, b = self.a.encode(piece, add_special_tokens=False).ids, self.b.encode(piece[1:])
        if piece == " ":  # nothing is left for B: what it makes of a space at the end of a text
            b = self.b.encode("a ")[len(self.b.encode("a")) :]
        return (a, b) if self._covers(piece.encode(), a, b) else ([], [])

    def tokens(self, new: list[str]) -> tuple[list[int], list[np.ndarray], list[np.ndarray]]:
        """The numbers of the pieces in the order in which they were encoded, and of A and B the ids and how many each piece has.

        Pieces that end in no blank are encoded many to a call and told apart by their bytes.
        """
        blank = pc.match_substring_regex(pa.array(new), rf"[{BLANKS}]\z").to_pylist()
        plain, single = ([k for k, x in enumerate(blank) if x is want] for want in (False, True))
        lines = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        texts = ["".join([new[k] for k in line]) for line in lines]
        encode = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        ids_a = [e.ids for i in range(0, len(texts), CALL) for e in encode(texts[i : i + CALL], add_special_tokens=False)]
        ids_b = self.b.encode([t[1:] for t in texts], num_threads=1) if texts else []
        flat, order = ([], []), []
        for line, t, a, b in zip(lines, texts, ids_a, ids_b, strict=True):
            if self._covers(t.encode(), a, b):
                order += line
                flat[0].append(np.array(a, np.int64))
                flat[1].append(np.array(b, np.int64))
            else:
                single += line
        stops = np.cumsum([len(new[k].encode()) for k in order])
        ids, sizes = [], []
        for parts, widths in zip(flat, (self.len_a, self.len_b), strict=True):
            x = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            ends = np.cumsum(widths[x])
            at = np.searchsorted(ends, stops, "right")
            if len(x) and not np.array_equal(ends[at - 1], stops):
                raise ValueError("a token goes on from one piece into the next")
            ids.append(x)
            sizes.append(np.diff(at, prepend=0))
        made = [self._alone(new[k]) for k in single]
        for side in (0, 1):
            ids[side] = np.concatenate((ids[side], np.array([i for m in made for i in m[side]], np.int64)))
            sizes[side] = np.concatenate((sizes[side], np.array([len(m[side]) for m in made], np.int64)))
        return order + single, ids, sizes

    def learn(self, new: list[str]) -> None:
        """Adds pieces: their validity, counts, links (A's id times B's size plus B's id) and tokens in the order of their groups."""
        if not new:
            return
        places, (flat_a, flat_b), (size_a, size_b) = self.tokens(new)
        wide_a, wide_b = self.len_a[flat_a], self.len_b[flat_b]
        owner_a, owner_b = np.repeat(np.arange(len(flat_a)), wide_a), np.repeat(np.arange(len(flat_b)), wide_b)
        new_a, new_b = (np.diff(o, prepend=-1) != 0 for o in (owner_a, owner_b))
        starts = np.nonzero(new_a | new_b)[0]  # of links
        codes = flat_a[owner_a[starts]] * self.width + flat_b[owner_b[starts]]
        ends = np.concatenate(([0], np.cumsum(wide_a)))[np.cumsum(size_a)]  # bytes up to each piece
        group = np.cumsum(new_a & new_b) - 1  # of each byte
        group_a, group_b = group[np.nonzero(new_a)[0]], group[np.nonzero(new_b)[0]]
        last_a, last_b = (np.append(np.diff(g) != 0, True) if len(g) else np.zeros(0, bool) for g in (group_a, group_b))
        n = len(self.bytes_a)
        label = np.concatenate((flat_a + n * last_a, 2 * n + flat_b + self.width * last_b)).astype(np.int32)
        order = label[np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")]
        groups = np.diff(np.searchsorted(np.nonzero(new_a & new_b)[0], ends), prepend=0)
        self.counts = np.concatenate((self.counts, np.stack((size_a, size_b, groups), axis=1)))
        self.size = np.concatenate((self.size, np.diff(np.searchsorted(starts, ends), prepend=0)))
        self.good, self.codes, self.order = np.concatenate((self.good, size_a > 0)), np.concatenate((self.codes, codes)), np.concatenate((self.order, order))
        self.known |= zip([new[k] for k in places], range(len(self.known), len(self.known) + len(new)), strict=True)

    def align(self, texts: pa.Array):
        """(n_a, n_b, n_groups), groups, and the bounds of the links, their codes and how often each text has them."""
        if len(self.known) > REMEMBERED:
            self.clear()
        split = cut_texts(texts)
        coded = split.flatten().dictionary_encode()
        kinds = coded.dictionary.to_pylist()
        self.learn([p for p in kinds if p not in self.known])
        place = np.fromiter(map(self.known.__getitem__, kinds), np.int64, len(kinds))
        idx = place[coded.indices.to_numpy()] if len(kinds) else np.zeros(0, np.int64)
        ends = np.concatenate(([0], np.cumsum(split.value_lengths().to_numpy())))
        total = lambda x: np.diff(np.concatenate((np.zeros((1, *x.shape[1:]), np.int64), np.cumsum(x, 0)))[ends], axis=0)
        good = total((~self.good[idx]).astype(np.int64)) == 0
        counts = np.where(good[:, None], total(self.counts[idx]), 0)
        doc = np.repeat(np.arange(len(texts)), np.diff(ends))
        kept = good[doc]
        idx, doc = idx[kept], doc[kept]
        written = self.labels.take(pa.array(_gathered(self.order, self.counts[:, 0] + self.counts[:, 1], idx)))
        at = np.frombuffer(written.buffers()[1], np.int32)[np.concatenate(([0], np.cumsum(counts[:, 0] + counts[:, 1])))].tolist() if len(written) else [0] * (len(texts) + 1)
        raw = memoryview(written.buffers()[2]) if len(written) else b""
        names = [bytes(raw[a : max(a, b - 1)]).decode() for a, b in pairwise(at)]
        span = len(self.bytes_a) * self.width
        both, times = np.unique(np.repeat(doc, self.size[idx]) * span + _gathered(self.codes, self.size, idx), return_counts=True)
        return counts, names, np.searchsorted(both, np.arange(len(texts) + 1) * span), both % span, times


def _gathered(values: np.ndarray, sizes: np.ndarray, idx: np.ndarray) -> np.ndarray:
    """The lists ``idx`` one after the other, of lists that lie in ``values`` one after the other."""
    begin, size = np.cumsum(sizes) - sizes, sizes[idx]
    stop = np.cumsum(size)
    return values[np.repeat(begin[idx] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)]


def cut_texts(texts: pa.Array) -> pa.ListArray:
    """The pieces of a space and each text; none of a null or empty text."""
    texts = texts.fill_null("")
    led = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise("", texts, " "))
    marked = pc.replace_substring_regex(led, rf"([^{BLANKS}]) ", rf"\1{CUT} ")
    split = pc.split_pattern(marked, CUT)
    hidden = pc.match_substring(texts, CUT).to_numpy(zero_copy_only=False)
    if not hidden.any() and not pc.any(pc.equal(texts, "")).as_py():
        return split
    rows = [[] if t == "" else re.split(f"(?<=[^{_PYTHON_BLANKS}])(?= )", " " + t) if h else s for t, h, s in zip(texts.to_pylist(), hidden, split.to_pylist(), strict=True)]
    return pa.array(rows, pa.list_(pa.string()))


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, groups, pairs, times) of every row.

    ``groups`` lists the smallest runs of tokens that end together: ids of A, a bar, ids of B, groups
    cut by semicolons. ``pairs`` are the different linked pairs of ids (A's times the size of B's
    vocabulary plus B's), ``times`` how many links of the text hold each. A null or empty text, and
    one whose bytes either tokenizer does not give back, has no tokens.
    """

    def run(batches):
        aligner = Aligner(a_path, b_path)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(sizes) // STRIP
            for at in np.unique(group, return_index=True)[1].tolist() if len(sizes) else []:
                b = batch.slice(at, int((group == group[at]).sum()))
                counts, names, bounds, codes, times = aligner.align(b.column("text").cast(pa.string()))
                lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x)) for x in (codes, times.astype(np.int32))]
                numbers = [pa.array(counts[:, i], pa.int64()) for i in range(3)]
                yield pa.RecordBatch.from_arrays([b.column("id"), *numbers, pa.array(names, pa.string()), *lists], ["id", "n_a", "n_b", "n_groups", "groups", "pairs", "times"])

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"id {kind}, n_a long, n_b long, n_groups long, groups string, pairs array<long>, times array<int>")


def _each(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(*keep, F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(*keep, F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """(pair, count, best): how many links of all rows hold each pair of ids, and whether that is the most that its id of B has."""
    counts = stored(_each(rows).groupBy("pair").agg(F.sum("times").alias("count")), "link-counts")
    b = F.col("pair") % width
    tops = counts.groupBy(b.alias("b")).agg(F.max("count").alias("top"))
    return counts.join(tops, b == F.col("b")).select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def scored(made: DataFrame, width: int, head: int = HEAD) -> DataFrame:
    """Rows of ``aligned`` without pairs, plus n_links, n_best and count_sum.

    A pair's count is over all rows. The most frequent pairs, ``head`` at most, are broadcast, so the
    ids that nearly every text links never meet in one task; rarer ones are joined by a shuffle. A row
    without tokens has zeros, an empty table no rows.
    """
    keep = [c for c in made.columns if c not in ("pairs", "times")]
    rows = stored(made.withColumn("row", F.monotonically_increasing_id()), "aligned-texts")
    counts = stored(pair_counts(rows, width), "pair-counts")
    # Powers of two of the counts, from the greatest down, as long as the pairs are few enough to broadcast.
    power, sizes = F.floor(F.log2("count")), {}
    for r in counts.groupBy(power.alias("p")).agg(F.count("*").alias("n")).collect():
        sizes[r.p] = r.n
    least, n = None, 0
    for p in sorted(sizes, reverse=True):
        n += sizes[p]
        if n > head:
            break
        least = p
    several = bool(sizes) and least != min(sizes)
    top = counts.where(power >= least) if least is not None else counts.limit(0)
    each = _each(rows, "row").join(F.broadcast(top), "pair", "left")
    if several:
        rest = counts.join(F.broadcast(top.select("pair")), "pair", "left_anti")
        each = each.where("count is not null").select("row", "pair", "times", "count", "best").unionByName(each.where("count is null").select("row", "pair", "times").join(rest, "pair"))
    times = F.col("times").cast("long")
    sums = each.groupBy("row").agg(F.sum(times).alias("n_links"), F.sum(F.when(F.col("best"), times).otherwise(0)).alias("n_best"), F.sum(times * F.col("count")).alias("count_sum"))
    sums = stored(sums, "link-sums")
    release(counts)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.join(sums, "row", "left").select(*keep, zero("n_links"), zero("n_best"), zero("count_sum"))


def pieces_in(b_path: str) -> int:
    """The size of a piece vocabulary."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
