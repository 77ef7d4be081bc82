"""Supervised subword embeddings for text quality, trained by numpy stochastic gradient descent.

Words, word pairs and byte n-grams are hashed into one table of learned vectors; a document is the
mean of its vectors, classified by a softmax. At scoring time the table is folded with the output
layer to one number for each bucket, so a text costs one lookup for each n-gram.
"""

from __future__ import annotations

import logging
import re
import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.plans.materialize import small_or_not, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS, DIM, EPOCHS, RATE, SEED = 17, 8, 6, 0.5, 7
#: Labelled rows the model is fitted on: at most so many of each label, and so many bytes of text in all.
SAMPLE_ROWS, SAMPLE_BYTES = 1000, 12_000_000
#: Longest text that is learned from, in bytes.
SAMPLE_TEXT = 1 << 16
#: Bytes hashed at a time.
BLOCK = 1 << 19
NGRAMS = (3, 5)
_BLANK, _LAST_WORD = re.compile(rb"[\x20\x09-\x0D]"), re.compile(rb"[\x20\x09-\x0D]+(?=[^\x20\x09-\x0D])")

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64)


def features(raw: bytes, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, places) of the words of a byte string, of its pairs of words, and of its byte n-grams.

    A pair stands at its second word. A pair of equal words has one bucket, whatever the word, so that repetition itself is learned.
    """
    a = np.frombuffer(raw, np.uint8).astype(np.uint64)
    n = len(a)
    blank = (a == 32) | ((a >= 9) & (a <= 13))
    before = np.concatenate(([True], blank[:-1]))
    after = np.concatenate((blank[1:], [True]))
    start, end = np.nonzero(~blank & before)[0], np.nonzero(~blank & after)[0] + 1
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((a + np.uint64(1)) * _powers(_BASE, n))))
    word = (sums[end] - sums[start]) * _powers(_INVERSE, n + 1)[start]
    same = word[1:] == word[:-1]
    pair = np.where(same, np.uint64(12345), word[:-1] * np.uint64(31) + word[1:] * np.uint64(0x94D049BB133111EB))
    found, places = [word, pair], [start, start[1:]]
    for k in NGRAMS:
        if n >= k:
            h = np.full(n - k + 1, k, np.uint64)
            for i in range(k):
                h = h * np.uint64(0x100000001B3) + a[i : n - k + 1 + i]
            found.append(h * _BASE)
            places.append(np.arange(n - k + 1))
    return [(_bucket(h, bits), p) for h, p in zip(found, places, strict=True)]


def blocks(raw: bytes):
    """(block, start of what is new in it): ``raw`` in blocks of about BLOCK bytes that end at white space.

    A block begins with the last word of the one before, and with as many bytes as an n-gram
    reaches back, so no word, pair or n-gram is lost or met twice. A word longer than a block makes
    its block as long.
    """
    at = begin = 0
    while True:
        cut = _BLANK.search(raw, at + BLOCK)
        if cut is None:
            yield raw[begin:], at - begin
            return
        yield raw[begin : cut.start()], at - begin
        at = cut.start()
        begin = min(max((m.end() for m in _LAST_WORD.finditer(raw, begin, at)), default=0), at - max(NGRAMS) + 1)
        begin = max(begin, 0)


def new_features(block: bytes, new: int, bits: int) -> list[np.ndarray]:
    """Buckets of the words, pairs and n-grams of a block that end in what is new in it."""
    found = features(block, bits)
    if not new:
        return [h for h, _ in found]
    # A word or a pair is told by the start of its (second) word, an n-gram by its last byte.
    return [h[p + (0 if k < 2 else NGRAMS[k - 2] - 1) >= new] for k, (h, p) in enumerate(found)]


def sparse(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return np.zeros(0, np.int64), np.zeros(0)
    return np.unique(np.concatenate([h for b, new in blocks(raw) for h in new_features(b, new, bits)]), return_counts=True)


@dataclass
class Model:
    table: np.ndarray  # logit of each bucket
    bias: float

    def scores(self, texts) -> np.ndarray:
        """Probability of label 1 of each whole text; that of the bias alone where it is empty.

        Short texts are hashed together, long ones in blocks; both have the same features.
        """
        bits, out, group, size = int(np.log2(len(self.table))), [], [], 0
        for t in texts:
            raw = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
            if len(raw) > BLOCK:
                out += self._group(group, bits)
                group, size, total, count = [], 0, 0.0, 0
                for b, new in blocks(raw):
                    for h in new_features(b, new, bits):
                        total, count = total + float(self.table[h].sum(dtype=np.float64)), count + len(h)
                out.append(total / max(count, 1))
                continue
            group.append(raw)
            size += len(raw)
            if size > BLOCK:
                out += self._group(group, bits)
                group, size = [], 0
        out += self._group(group, bits)
        return 1 / (1 + np.exp(-np.clip(np.array(out, float) + self.bias, -30, 30)))

    def _group(self, raws: list[bytes], bits: int) -> list[float]:
        """Mean logit of each of some texts, hashed together with blanks between them.

        N-grams that reach over the end of a text are left out, and each text's sum is of its own
        features alone, so it scores as it would by itself.
        """
        if not raws:
            return []
        gap = b" " * max(NGRAMS)
        lengths = np.array([len(r) for r in raws])
        begin = np.concatenate(([0], np.cumsum(lengths + len(gap))[:-1]))
        end, total, count = begin + lengths, np.zeros(len(raws)), np.zeros(len(raws))
        found = features(gap.join(raws) + gap, bits)
        starts = np.append(found[0][1], end[-1])
        for k, (buckets, places) in enumerate(found):
            # The pair at a text's first word has its other word in the text before.
            lo = np.searchsorted(places, starts[np.searchsorted(starts, begin)], "right") if k == 1 else np.searchsorted(places, begin)
            hi = np.maximum(lo, np.searchsorted(places, end - (1 if k < 2 else NGRAMS[k - 2]) + 1))
            values = np.append(self.table[buckets].astype(np.float64), 0.0)
            sums = np.add.reduceat(values, np.stack((lo, hi), 1).ravel())[::2]
            total, count = total + np.where(hi > lo, sums, 0.0), count + hi - lo
        return list(np.divide(total, count, out=np.zeros(len(raws)), where=count > 0))


def fit(rows, bits: int = BITS, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Train on (buckets, counts, label) rows; with no row of either label all texts score alike."""
    rng, rows = np.random.default_rng(seed), [r for r in rows if len(r[0])]
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    out, bias, steps, done = np.zeros((2, dim), np.float32), np.zeros(2, np.float32), max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            buckets, counts, label = rows[i]
            share = (counts / counts.sum()).astype(np.float32)
            hidden = share @ vectors[buckets]
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            error = p / p.sum()
            error[label] -= 1
            step = rate * (1 - done / steps)
            back = error @ out
            out -= step * np.outer(error, hidden)
            bias -= step * 0.1 * error
            vectors[buckets] -= (step * len(buckets) ** 0.5 * share)[:, None] * back
            done += 1
    return Model((vectors @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]))


def remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % mod, F.lit(0))


def taken(sizes: list[int], rows: int, most: int) -> list[int]:
    """Which of some rows are taken in their order: ``rows`` at most, and none that would pass ``most`` bytes in all."""
    out, total = [], 0
    for i, n in enumerate(sizes):
        if len(out) < rows and total + n <= most:
            out.append(i)
            total += n
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", held_out_of: int = 5, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out.

    The sample takes each label's rows in the order of a hash of their ids and texts, at most
    ``rows`` of each; a row that would carry a label's texts past ``most_bytes`` / 2 bytes is left
    out and the next ones are tried. Rows without id, text or label, and those of texts over
    SAMPLE_TEXT bytes, are not learned from; of an id with several labels the least holds.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    known = small_or_not(stored(known.groupBy("id").agg(F.min("label").alias("label")), "labels"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col(text_col).isNotNull() & (remainder(id_col, held_out_of) != 0))
    sizes = texts.join(known, "id").select("id", "label", F.octet_length("text").alias("n"), F.xxhash64("id", "text").alias("h"))
    sizes, picked = stored(sizes, "labelled-sizes"), []
    for label in (0, 1):
        first = sizes.where((F.col("label") == label) & (F.col("n") <= SAMPLE_TEXT)).orderBy("h", "id").limit(4 * rows).collect()
        took = taken([r.n for r in first], rows, most_bytes // 2)
        picked += [(first[i].h, label) for i in took]
        logging.getLogger(__name__).info("label %d: learning from %d rows", label, len(took))
    if not picked:
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    chosen = F.broadcast(docs.sparkSession.createDataFrame(picked, "h long, label int").distinct())

    def extract(batches):
        for b in batches:
            made = [sparse(t) for t in b["text"]]
            yield pd.DataFrame({"label": b["label"], "h": b["h"], "buckets": [x.astype(np.int32) for x, _ in made], "counts": [c.astype(np.float32) for _, c in made]})

    sample = texts.withColumn("h", F.xxhash64("id", "text")).join(chosen, "h").select("text", "label", "h")
    got = sample.mapInPandas(extract, "label int, h long, buckets array<int>, counts array<float>").toArrow().combine_chunks()
    columns = [got[c].chunk(0).flatten().to_numpy() for c in ("buckets", "counts")] if got.num_rows else []
    at = np.concatenate(([0], np.cumsum(got["buckets"].combine_chunks().value_lengths().to_numpy()))) if got.num_rows else []
    hashes, labels = got["h"].to_numpy(), got["label"].to_numpy()
    first = np.unique(hashes, return_index=True)[1]  # repeated rows count once; the order is that of the hashes
    return fit([(*(c[at[i] : at[i + 1]] for c in columns), int(labels[i])) for i in first])


def score_column(model: Model, text: Column) -> Column:
    """The score of each whole text, as a column; null texts score as empty ones."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts))

    return score(text)
