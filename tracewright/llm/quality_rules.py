"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio, in DataFrame operations only.

Word unigrams and bigrams are hashed into a fixed number of buckets, each kind into its own. Two
multinomials over the buckets are counted: one of the trusted target (documents labelled good), one
of the raw corpus (all documents). The raw counts are scaled to the size of the target before both
are smoothed, so an n-gram too rare to be expected in the target says nothing. A document's score
is the mean over its n-grams of log(target / raw); documents under a fixed threshold are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.shared import row_key, space_words
from tracewright.plans.materialize import small_or_not, stored

#: Buckets of unigrams and of bigrams. Bigrams are mostly met once; in buckets of their own they do not dilute the unigrams.
BUCKETS = (1 << 20, 1 << 18)
#: Buckets in a row of the table of ratios, which is broadcast: it has (2^20 + 2^18) / 64 rows of 64 numbers, whatever the corpus.
PACKED = 64
#: Pseudo-count of each bucket in the target and in the raw corpus as scaled to it.
SMOOTHING = 1.0
#: Mean log ratio per n-gram under which a document is rejected. Found on documents with labels that
#: were left out of the target: it lies between the bad ones' highest score and the good ones' lowest
#: on sf0.1 (-0.67, -0.16) and check_s (-0.74, -0.10); README.md has the figures.
THRESHOLD = -0.45

#: Parts in which log ratios are summed.
UNIT = 1 << 26

SYMBOLS = r"[#*$%&|<>]"


def word_hashes(text: Column) -> Column:
    return F.transform(space_words(text), lambda x: F.xxhash64(x))


def gram_places() -> Column:
    """A number for every unigram and bigram of the array of word hashes ``h``: unigrams from 0, bigrams after them."""
    return F.expr("if(size(h) = 0, cast(array() as array<int>), sequence(0, 2 * size(h) - 2))")


def bucket_at(buckets: tuple[int, int]) -> Column:
    """Bucket of the n-gram with number ``i`` of ``h``, null for none; it is made for each exploded number in compiled code, so no list of buckets is built."""
    uni, bi = buckets
    pair = "xxhash64(h[i - size(h)], h[i - size(h) + 1])"
    return F.expr(f"if(i is null, null, if(i < size(h), cast(pmod(h[i], {uni}) as int), cast({uni} + pmod({pair}, {bi}) as int)))")


#: Low bits of a window's hash that its place takes while windows are sorted as plain numbers.
PLACE_BITS = 24
_LOW = f"{(1 << PLACE_BITS) - 1}L"


def sorted_places() -> Column:
    """Windows ``t`` as sorted numbers, the leading bits of the hash over the place; none where no window is met twice."""
    return F.expr(f"if(size(array_distinct(t)) = size(t), cast(array() as array<bigint>), sort_array(transform(t, (h, i) -> (h & ~{_LOW}) | cast(i as bigint))))")


def repeated_words() -> Column:
    """Words of a text in a 3-word window that it holds twice or more, from the 64-bit hashes ``t`` of its windows and their ``sorted_places`` s.

    Where different windows share their leading bits, or the places need more bits, windows are
    sorted by their whole hash and their place instead: the count is the same, only slower.
    """
    covered = lambda places: f"transform(array({places}), p -> size(array_distinct(concat(p, transform(p, x -> x + 1), transform(p, x -> x + 2)))))[0]"
    lead, place = lambda k: f"(s[{k}] & ~{_LOW})", lambda k: f"t[cast(s[{k}] & {_LOW} as int)]"
    near = f"filter(sequence(0, size(s) - 1), k -> (k > 0 and {lead('k - 1')} = {lead('k')}) or (k < size(s) - 1 and {lead('k + 1')} = {lead('k')}))"
    shared = f"exists(sequence(1, size(s) - 1), k -> {lead('k - 1')} = {lead('k')} and {place('k - 1')} <> {place('k')})"
    same = "filter(sequence(0, size(o) - 1), k -> (k > 0 and o[k - 1].h = o[k].h) or (k < size(o) - 1 and o[k + 1].h = o[k].h))"
    whole = f"transform(array(array_sort(transform(t, (h, i) -> struct(h as h, i as i)))), o -> {covered(f'transform({same}, k -> o[k].i)')})[0]"
    return F.expr(f"if(size(s) = 0, 0, if(size(t) >= {1 << PLACE_BITS} or {shared}, {whole}, {covered(f'transform({near}, k -> s[k] & {_LOW})')}))").cast("long")


def base_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` plus the base counts and ``h``, the hashes of the words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    windows = F.expr("if(size(h) < 3, cast(array() as array<bigint>), transform(sequence(0, size(h) - 3), i -> xxhash64(h[i], h[i + 1], h[i + 2])))")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumn("w", space_words(F.col(text_col))).withColumn("h", F.transform("w", lambda x: F.xxhash64(x))).withColumn("t", windows).withColumn("s", sorted_places()).withColumn("lines", lines)
    return out.select(
        *docs.columns,
        "h",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words().alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def bucket_ratios(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, buckets: tuple[int, int], smoothing: float) -> DataFrame:
    """(block, llr): the ratios of PACKED neighbouring buckets in each row, in parts of 1 / UNIT.

    ``trusted`` holds the ids of the target documents. Every document is counted; what a bucket
    sums is combined before the shuffle. Without any target document all ratios are 0.
    """
    spark, total = docs.sparkSession, sum(buckets)
    ids = small_or_not(stored(trusted.select(F.col(trusted.columns[0]).alias("__t")).where("__t is not null").distinct(), "trusted"))
    texts = docs.select(F.col(id_col).alias("id"), word_hashes(F.col(text_col)).alias("h"))
    marked = texts.join(ids, texts["id"] == ids["__t"], "left").select("h", F.col("__t").isNotNull().cast("long").alias("target"))
    each = marked.select("h", F.explode(gram_places()).alias("i"), "target").select(bucket_at(buckets).alias("bucket"), "target")
    # Every bucket once more, so that none is missing from a row of ratios; its count is one less.
    none = spark.range(0, total, 1, 8).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("target"))
    counts = stored(each.union(none).groupBy("bucket").agg((F.count("*") - 1).alias("raw"), F.sum("target").alias("target")), "ngram-buckets")
    raw, target = counts.agg(F.sum("raw"), F.sum("target")).first()
    scale = target / raw if raw else 0.0
    # Whole numbers, so that a document's sum is the same in whatever order its n-grams come.
    ratio = F.round(F.log((F.col("target") + smoothing) / (F.col("raw") * scale + smoothing)) * UNIT).cast("int")
    packed = counts.groupBy(F.expr(f"bucket div {PACKED}").alias("block")).agg(F.array_sort(F.collect_list(F.struct("bucket", ratio.alias("llr")))).alias("x"))
    return packed.select("block", F.col("x.llr").alias("llr"))


def quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: tuple[int, int] = BUCKETS, smoothing: float = SMOOTHING, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs``: id, __k, __d, the base columns, llr_score and kept.

    Texts without words have score 0 and fail the base rule (under 50 words). Null texts count as
    empty. Rows with a null id are scored but are never trusted. Repeated rows are scored each.
    Other columns of ``docs`` are not read, whatever their names.
    """
    ratios = F.broadcast(bucket_ratios(docs, trusted, id_col, text_col, buckets, smoothing).withColumnRenamed("llr", "of"))
    rows = row_key(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text")
    base = base_counts(rows, "text")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    # One pass over the texts: the counts of a text go with each of its n-grams, and meet again before the shuffle.
    grams = base.select("__k", "__d", "id", *counts, "h", F.explode_outer(gram_places()).alias("i")).select("__k", "__d", "id", *counts, bucket_at(buckets).alias("bucket"))
    found = grams.join(ratios, F.expr(f"bucket div {PACKED}") == F.col("block"), "left")
    llr = F.col("of")[F.expr(f"bucket % {PACKED}")]
    out = found.groupBy("__k", "__d", "id").agg(*[F.max(c).alias(c) for c in counts], (F.sum(llr) / F.nullif(F.count(llr), F.lit(0)) / UNIT).alias("llr_score"), F.count("*").alias("rows"))
    # Equal rows share a key: the mean over their n-grams together is that of one, and n words have 2 n - 1 n-grams.
    out = out.withColumn("base_failed", base_failed()).withColumn("alike", F.expr("rows div greatest(2 * n_words - 1, 1)"))
    out = out.withColumn("llr_score", F.coalesce("llr_score", F.lit(0.0))).withColumn("kept", ~F.col("base_failed") & (F.col("llr_score") >= threshold))
    return out.select("id", "__k", "__d", *counts, "base_failed", "llr_score", "kept", F.explode(F.expr("sequence(1L, alike)")).alias("copy")).drop("copy")
