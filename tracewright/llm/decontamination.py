"""Benchmark decontamination by a prefix-filtered containment join, in DataFrame operations only.

Items are cut into windows of ``window`` words (an item of fewer words is one window). For exact
containment the prefix of a window is one token: its rarest word shingle in the corpus. Documents
are joined on these prefix tokens, positional and length bounds drop what cannot hold the window,
and the words themselves are compared last, in the documents that are left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.shared import ascii_lower, row_key, within
from tracewright.plans.materialize import empty_like, release, small_or_not, stored

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, SHINGLE = 13, 5


def words_of(text: Column) -> Column:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _hashes(length: int) -> Column:
    """64-bit hash of the ``length`` words from each position of column ``w``."""
    parts = ", ".join(f"w[i + {k}]" for k in range(length))
    return F.expr(f"if(size(w) < {length}, array(), transform(sequence(0, size(w) - {length}), i -> xxhash64({parts})))")


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, wtext, len): the distinct windows of each item."""
    items = benchmark.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("w")).where("size(w) > 0")
    spans = items.withColumn("len", F.least(F.size("w"), F.lit(window)))
    spans = spans.select("item", "len", F.explode(F.expr("transform(sequence(1, size(w) - len + 1), s -> array_join(slice(w, s, len), ' '))")).alias("wtext"))
    return spans.distinct()


def window_tokens(windows: DataFrame, shingle: int) -> DataFrame:
    """(wtext, len, size, hs): each different window once, whatever the number of its items, with its shingle hashes."""
    wins = windows.select("wtext", "len").distinct().withColumn("w", F.split("wtext", " ")).withColumn("size", F.least("len", F.lit(shingle)))
    hs = reduce(lambda rest, n: F.when(F.col("size") == n, _hashes(n)).otherwise(rest), range(1, shingle), _hashes(shingle))
    return wins.select("wtext", "len", "size", hs.alias("hs"))


def _occurrences(words: DataFrame, tokens: DataFrame, sizes: list[int]) -> DataFrame:
    """(k, d, n_words, pos, h): where the benchmark's shingles stand in the documents."""
    tokens = small_or_not(tokens)
    each = [words.select("k", "d", F.size("w").alias("n_words"), F.posexplode(_hashes(n)).alias("pos", "h")) for n in sizes]
    return reduce(DataFrame.union, each).join(tokens, "h", "left_semi")


def candidates(words: DataFrame, windows: DataFrame, shingle: int) -> DataFrame:
    """(__k, __d, start, len, wtext), stored: the windows that may stand in each document, and where.

    ``words`` has (k, d, w). Every row passes the positional and the length bound.
    """
    spark = words.sparkSession
    wins = stored(window_tokens(windows, shingle), "window-tokens")
    sizes = sorted(r[0] for r in wins.select("size").distinct().collect())  # at most `shingle` values
    if not sizes:
        return empty_like(spark, "__k long, __d int, start int, len int, wtext string")
    tokens = stored(wins.select(F.explode("hs").alias("h")).distinct(), "window-shingles")
    seen = stored(_occurrences(words, tokens, sizes), "shingle-places")
    often = seen.groupBy("h").agg(F.count("*").alias("n"))
    ranked = wins.select("wtext", F.posexplode("hs").alias("off", "h")).join(often, "h", "left")
    ranked = ranked.groupBy("wtext").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "h")).alias("t"))
    prefix = wins.select("wtext", "len").join(ranked.where("t.n > 0"), "wtext").select("len", "wtext", "t.off", "t.h")
    prefix = stored(prefix, "window-prefixes")
    at = seen.join(small_or_not(prefix), "h").select(F.col("k").alias("__k"), F.col("d").alias("__d"), (F.col("pos") - F.col("off")).alias("start"), "len", "wtext", "n_words")
    found = stored(at.where("start >= 0 and start + len <= n_words").drop("n_words").distinct(), "window-candidates")
    release(wins, tokens, seen, prefix)
    return found


def verdicts(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, share: int = 20) -> DataFrame:
    """One row for each row of ``docs``: id, __k, __d, n_words, n_hit, items and contaminated.

    n_hit: words inside an occurrence of a window; items: the ids, as sorted strings, of items with
    an occurring window; contaminated: n_hit > 0 and ``share`` * n_hit >= n_words. Null and empty
    texts have no words and are clean. Items without words match nothing; the windows of an item
    with a null id mark words but name no item. Equal rows get equal verdicts. Other columns of
    ``docs`` are not read, whatever their names.

    Only texts that hold a candidate window are joined with it; the verdicts meet their rows by key.
    """
    keyed = row_key(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text")
    words = keyed.select(F.col("__k").alias("k"), F.col("__d").alias("d"), words_of(F.col("text")).alias("w"))
    windows = stored(item_windows(benchmark, item_id, item_text, window), "windows")
    found = candidates(words, windows, shingle)
    holders = stored(found.select("__k", "__d").distinct(), "window-holders")
    near = within(keyed, holders)
    near = near.select("__k", "__d", words_of(F.col("text")).alias("w")).dropDuplicates(["__k", "__d"])
    hits = found.join(near, ["__k", "__d"]).where("array_join(slice(w, start + 1, len), ' ') = wtext").select("__k", "__d", "start", "len", "wtext")
    hits = stored(hits, "window-hits")
    # Words inside any occurrence: each adds what lies past the furthest end of those before it.
    before = Window.partitionBy("__k", "__d").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.select("__k", "__d", "start", (F.col("start") + F.col("len")).alias("end")).distinct().withColumn("reach", F.max("end").over(before))
    fresh = F.greatest(F.col("end") - F.greatest("start", F.coalesce("reach", "start")), F.lit(0))
    covered = spans.groupBy("__k", "__d").agg(F.sum(fresh).cast("long").alias("n_hit"))
    named = hits.select("__k", "__d", "wtext").distinct().join(windows.where("item is not null").select("wtext", F.col("item").cast("string")), "wtext")
    named = named.groupBy("__k", "__d").agg(F.array_sort(F.collect_set("item")).alias("items"))
    marks = stored(covered.join(named, ["__k", "__d"], "left"), "window-marks")
    release(windows, found, holders, hits)
    out = keyed.select("id", "__k", "__d", F.size(words_of(F.col("text"))).cast("long").alias("n_words")).join(small_or_not(marks), ["__k", "__d"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("id", "__k", "__d", "n_words", n_hit.alias("n_hit"), items.alias("items"), ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))
