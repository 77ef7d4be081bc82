"""Subword-lattice language model: the marginal probability of a text over all its segmentations.

The pieces and their scores are those of an existing vocabulary file. A text is a run of words,
each written with a word mark and cut into pieces in every possible way, and one end. The forward
recursion over a word's lattice, in log space, sums all its segmentations; a text's log probability
is the sum of those of its words and of its end. The one number that a vocabulary lacks, the
probability of the end, is learned from the training texts.

``mixed_score`` is a second model, beside it: a word of the training texts is one more edge from end
to end of its lattice, weighted by its discounted count, and the lattice has what the discount leaves.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.shared import ascii_lower, row_key, space_words
from tracewright.plans.materialize import release, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARK = "▁"
#: Words that are broadcast to the documents: frequent ones, so many at most, each of at most so many characters.
FREQUENT, FREQUENT_CHARS = 200_000, 64
#: Cells laid out at a time, and characters of a word; a longer word is laid out piece by piece, with the last positions carried over.
CELLS, SPAN = 400_000, 4096

_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SLOTS = 20


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")


@dataclass
class Pieces:
    """The vocabulary that lower-cased text can use: its pieces and the 256 bytes."""

    texts: list[str]
    p: np.ndarray  # probabilities by the vocabulary's own scores: pieces, then bytes

    @property
    def marked(self) -> float:
        """Probability of the pieces that begin a word."""
        return float(self.p[: len(self.texts)][[t.startswith(MARK) for t in self.texts]].sum())

    def tables(self) -> tuple[np.ndarray, ...]:
        """Two-way hash table from the hash of a piece to its number."""
        keys = np.zeros(len(self.texts), np.uint64)
        for i, t in enumerate(self.texts):
            h = 0
            for c in t:
                h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
            keys[i] = h
        one, two = np.full(1 << _SLOTS, -1, np.int32), np.full(1 << _SLOTS, -1, np.int32)
        for i, (a, b) in enumerate(zip(self.slot(keys, 1), self.slot(keys, 2), strict=True)):
            if one[a] < 0:
                one[a] = i
            elif two[b] < 0:
                two[b] = i
            else:
                raise ValueError("the piece table needs more slots")
        return keys, one, two

    @staticmethod
    def slot(h: np.ndarray, way: int) -> np.ndarray:
        h = (h ^ (h >> np.uint64(31))) * (_MIX if way == 1 else _BASE)
        return (h >> np.uint64(64 - _SLOTS)).astype(np.int64)


def load_pieces(path: str) -> Pieces:
    """Pieces of a sentencepiece file, with their scores as probabilities.

    The scores of a byte-pair file are ranks, not log probabilities: a piece of rank r has the weight
    1 / (r + 10), and a byte that of the last piece. Upper-case pieces are left out.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts, weights = [], []
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i):
            continue
        piece, score = sp.id_to_piece(i), sp.get_score(i)
        if not any("A" <= c <= "Z" for c in piece):
            texts.append(piece)
            weights.append(1 / (10 - score))
    low = min(weights, default=1.0)
    p = np.array([*weights, *[low] * 256])
    return Pieces(texts, p / p.sum())


class Lattice:
    """The forward recursion over the lattices of many words at once."""

    def __init__(self, pieces: Pieces):
        self.n = len(pieces.texts)
        self.keys, self.one, self.two = pieces.tables()
        self.lengths = np.array(sorted({len(t) for t in pieces.texts}))
        self.slot = pieces.slot

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of the piece of each hash, or -1."""
        at = self.one[self.slot(h, 1)]
        hit = np.nonzero(at >= 0)[0]
        wrong = hit[self.keys[at[hit]] != h[hit]]
        if len(wrong):
            other = self.two[self.slot(h[wrong], 2)]
            at[wrong] = np.where((other >= 0) & (self.keys[other] == h[wrong]), other, -1)
        return at

    def by_bytes(self, codes: np.ndarray, logp: np.ndarray) -> np.ndarray:
        kinds, back = np.unique(codes, return_inverse=True)
        return np.array([sum(logp[self.n + b] for b in chr(int(c)).encode("utf-8", "surrogatepass")) for c in kinds], float)[back]

    def edges(self, sums: np.ndarray, codes: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """Score of the piece of each length that ends at each of the last ``len(codes)`` positions; -inf for none.

        ``sums`` are rolling hashes of the positions, those before the codes included.
        """
        (span, m), old = codes.shape, len(sums) - len(codes)
        out = np.full((len(self.lengths), span, m), -np.inf)
        for z, size in enumerate(self.lengths.tolist()):
            first = max(0, size - old)
            if first >= span:
                break
            power = np.uint64(pow(int(_BASE), size, 1 << 64))
            at = self.find((sums[old + first :] - sums[old + first - size : len(sums) - size] * power).ravel())
            score = np.where(at >= 0, logp[at], -np.inf)
            if size == 1:
                miss = np.nonzero(at < 0)[0]
                score[miss] = self.by_bytes(codes[first:].ravel()[miss], logp)
            out[z, first:] = score.reshape(span - first, m)
        return out

    def forward(self, codes: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """Natural log likelihood of words of one length: ``codes`` has a row for each position."""
        m, reach = codes.shape[1], int(self.lengths[-1])
        sums, ahead = np.zeros((1, m), np.uint64), np.zeros((1, m))  # of the last positions, as far as a piece reaches
        for a in range(0, len(codes), SPAN):
            part, old = codes[a : a + SPAN], len(sums)
            sums, ahead = (np.concatenate((x, np.empty(part.shape, x.dtype))) for x in (sums, ahead))
            for j in range(len(part)):
                sums[old + j] = sums[old + j - 1] * _BASE + part[j] + np.uint64(1)
            scores = self.edges(sums, part, logp)
            for j in range(len(part)):
                k = int(np.searchsorted(self.lengths, old + j, "right"))
                reached = ahead[old + j - self.lengths[:k]] + scores[:k, j]
                top = reached.max(0)
                ahead[old + j] = top + np.log(np.exp(reached - top).sum(0))
            sums, ahead = sums[-reach:], ahead[-reach:]
        return ahead[-1]

    def likelihoods(self, words: list[str], p: np.ndarray) -> np.ndarray:
        """Natural log likelihood of each word by the probabilities of the pieces."""
        out, logp, marked = np.zeros(len(words)), np.log(p), [MARK + w for w in words]
        size = np.array([len(w) for w in marked])
        order = np.argsort(size, kind="stable")
        for rows in np.split(order, np.nonzero(np.diff(size[order]))[0] + 1) if len(words) else []:
            n = int(size[rows[0]])
            step = max(1, CELLS // min(n, SPAN))
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                out[part] = self.forward(_codes([marked[i] for i in part]).reshape(len(part), n).T, logp)
        return out


def _gathered(batches, most: int = 40_000):
    """Batches joined to about ``most`` rows, so that words of one length are many."""
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += len(b)
        if rows >= most:
            yield pd.concat(held, ignore_index=True)
            held, rows = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


@dataclass
class Counts:
    """What is counted in the training texts: texts, words, and kinds of words, all, met once and met twice."""

    texts: int
    words: int
    kinds: int
    once: int
    twice: int

    @property
    def tokens(self) -> int:
        return self.words + self.texts

    @property
    def end(self) -> float:
        """Probability of the end: the share of ends in the training tokens; a half without any."""
        return self.texts / self.tokens if self.texts else 0.5

    def mixed(self, c: np.ndarray, lattice: np.ndarray, marked: float) -> np.ndarray:
        """Natural log probability of words with counts ``c``, of which the lattice has the discounted part."""
        # A word begins with a marked piece and stops where the next one or the end follows.
        piece = 1 - self.end if self.end < 1 else 0.5
        lattice = lattice + math.log(self.end + piece * marked) - math.log(piece * marked)
        if not self.kinds:
            return lattice + math.log(piece)
        d = self.once / (self.once + 2 * self.twice) if self.once and self.twice else 0.5
        known = np.log(np.maximum(c - d, 0) / self.tokens, where=c > 0, out=np.full(len(c), -np.inf))
        return np.logaddexp(known, lattice + math.log(d * self.kinds / self.tokens))


def word_scores(words: DataFrame, pieces: Pieces, counts: Counts) -> DataFrame:
    """(word, c, l, x): the count of each word, its log10 probability by the lattice, and by the mixture."""
    p = pieces.p * (1 - counts.end if counts.end < 1 else 0.5)

    def run(batches):
        lattice = Lattice(pieces)
        for b in _gathered(batches):
            found = lattice.likelihoods(b["word"].tolist(), p)
            mixed = counts.mixed(b["c"].to_numpy(), found, pieces.marked)
            yield pd.DataFrame({"word": b["word"], "c": b["c"], "l": found / math.log(10), "x": mixed / math.log(10)})

    return words.mapInPandas(run, "word string, c long, l double, x double")


def frequent_words(words: DataFrame) -> DataFrame:
    """The words of the highest levels of frequency, FREQUENT at most; a level is a sixteenth of a power of two.

    The cut is found on a histogram with a row for each level, so no task sorts or gathers the words.
    """
    short = words.where(F.length("word") <= FREQUENT_CHARS).withColumn("level", F.when(F.col("c") > 0, F.floor(F.log2("c") * 16)).otherwise(-1))
    cut, total = 1 << 20, 0
    for level, n in sorted(short.groupBy("level").count().collect(), reverse=True):
        if total + n > FREQUENT:
            break
        cut, total = level, total + n
    return short.where(F.col("level") >= cut).drop("level")


def score(docs: DataFrame, held_out, pieces_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, mixed_score) of every row.

    ``held_out`` is a boolean column, null as true; only the other rows are learned from. Tokens are
    the words of the lower-cased text and one end. ``base_score`` is the add-0.1 word unigram,
    ``score`` the lattice over the vocabulary's own scores, ``mixed_score`` the lattices with the
    training words as edges; all are log10 of the whole text. Null and empty texts are one end. With
    no training rows the end has a half. Repeated rows are scored each, and alike. Columns of
    ``docs`` other than the id and the text are not read, whatever their names.
    """
    pieces = load_pieces(pieces_path)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(True)).alias("held_out"))
    rows = row_key(rows, "id", "text").select("id", "held_out", "__k", "__d", space_words(ascii_lower(F.col("text"))).alias("w"))
    seen = rows.select("held_out", F.explode("w").alias("word")).groupBy("word").agg(F.sum((~F.col("held_out")).cast("long")).alias("c"))
    seen = stored(seen, "lattice-words")
    heads = stored(rows.select("id", "held_out", "__k", "__d"), "lattice-rows")
    ends = heads.where("not held_out").count()
    facts = seen.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    counts = Counts(ends, *facts)
    scored = stored(word_scores(seen, pieces, counts), "lattice-scores")
    tokens, kinds = counts.tokens, counts.kinds + (ends > 0)
    unigram = lambda c: F.log10((c + 0.1) / (tokens + 0.1 * (kinds + 1)))
    flat = scored.select("word", unigram(F.col("c")).alias("b"), (F.col("c") > 0).cast("long").alias("known"), "c", "l", "x")
    often = stored(frequent_words(flat), "lattice-frequent")
    sums = ["b", "known", "l", "x"]
    # One pass over the texts: what frequent words sum to in each text, and each rare word of it.
    each = rows.select("__k", "__d", F.explode("w").alias("word")).join(F.broadcast(often.withColumnRenamed("word", "often")), F.col("word") == F.col("often"), "left")
    each = each.select("__k", "__d", F.when(F.col("often").isNull(), F.col("word")).alias("word"), *sums)
    # Stored, since both uses below would otherwise read all texts.
    met = stored(each.groupBy("__k", "__d", "word").agg(*[F.sum(c).alias(c) for c in sums], F.count("*").alias("m")), "lattice-sums")
    rare = met.where("word is not null").select("__k", "__d", "word", "m").join(flat.drop("c"), "word")
    parts = met.where("word is null").drop("word").unionByName(rare.select("__k", "__d", *[(F.col(c) * F.col("m")).alias(c) for c in sums], "m"))
    found = stored(parts.groupBy("__k", "__d").agg(*[F.sum(c).alias(c) for c in (*sums, "m")]), "lattice-texts")
    release(seen, scored, often, met)
    # Equal rows share a key and were summed together.
    alike = heads.groupBy("__k", "__d").agg(F.count("*").alias("alike"))
    mean = lambda c: F.coalesce(F.col(c) / F.col("alike"), F.lit(0.0))
    out = heads.join(alike.join(found, ["__k", "__d"], "left"), ["__k", "__d"])
    return out.select(
        "id",
        "held_out",
        (F.round(mean("m")).cast("long") + 1).alias("n_tokens"),
        (F.round(mean("known")) + (1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (mean("b") + unigram(F.lit(ends))).alias("base_score"),
        (mean("l") + math.log10(counts.end)).alias("score"),
        (mean("x") + math.log10(counts.end)).alias("mixed_score"),
    )
