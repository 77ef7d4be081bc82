"""The correction workflow run to its fixed point: correct, look again, until nothing is found."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.text import bound
from tracewright.plans.materialize import release, small_or_not, stored

#: Words and what stands between them; together they are the text.
PIECES = r"[A-Za-z]+|[^A-Za-z]+"


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECES), F.lit(0))


def words_of(texts: DataFrame) -> DataFrame:
    """(doc, word): the different words of letters of each text."""
    return texts.select("doc", F.explode(F.array_distinct(pieces(F.col("text")))).alias("word")).where(F.col("word").rlike("^[A-Za-z]"))


def replaced(text: Column, rules: Column) -> Column:
    """Every word that ``rules`` (wrong, right) know replaced at once; each word is looked up once."""
    return bound(F.map_from_entries(rules), lambda known: F.array_join(F.transform(pieces(text), lambda p: F.coalesce(F.element_at(known, p), p)), ""))


def until_stable(texts: DataFrame, corrections: DataFrame, verify: Callable[[DataFrame], DataFrame] | None = None, most: int = 5) -> DataFrame:
    """(doc, text, passes): texts (doc, text) corrected, verified and corrected again, for ``most`` passes at most.

    A pass replaces every word of each text that a correction (wrong, right) names. ``verify`` turns
    words (word) that have come in since into further corrections; the first for a wrong word holds,
    of several at once the least. ``passes`` is the last pass that changed a text.

    What becomes of a word does not depend on the text it stands in, and what is written for it never
    grows together with its neighbours, which begin and end with no letter. So the passes are run
    over the different words, each a text of its own, and the texts are written once, at the end.
    Null and empty texts stay as they are.
    """
    kinds = words_of(texts).select("word").distinct()
    made = _word_passes(kinds.select(F.col("word").alias("doc"), F.col("word").alias("text")), corrections, verify, most)
    made = stored(made.where("passes > 0").select(F.col("doc").alias("word"), F.col("text").alias("right"), "passes"), "workflow-words-made")
    rules = words_of(texts).join(small_or_not(made), "word").groupBy("doc").agg(F.collect_list(F.struct("word", "right")).alias("rules"), F.max("passes").alias("passes"))
    out = texts.select("doc", "text").join(rules, "doc", "left")
    return out.select("doc", F.when(F.col("rules").isNull(), F.col("text")).otherwise(replaced(F.col("text"), F.col("rules"))).alias("text"), F.coalesce("passes", F.lit(0)).alias("passes"))


def _word_passes(texts: DataFrame, corrections: DataFrame, verify: Callable[[DataFrame], DataFrame] | None, most: int) -> DataFrame:
    """The passes over texts of a word each.

    Only what is new is joined: new corrections with the words of all texts, and all corrections
    with the words of texts that the last pass has changed. Texts and words lie in layers, one for
    each pass, so a text that a pass does not change is neither moved nor written again; which
    layer of a text is the newest is a narrow table of the texts that were changed.
    """
    layers = [stored(texts.select("doc", "text"), "workflow-texts")]
    words = [stored(words_of(layers[0]), "workflow-words")]
    known, seen, newest, number = [stored(corrections.where("wrong <> right").groupBy("wrong").agg(F.min("right").alias("right")), "workflow-corrections")], [], None, 0
    if verify is not None:
        _learn(known, seen, words[0], verify)
    fresh, changed = _union(known), None
    while number < most:
        hits = _live(_met(_layered(words), fresh), newest)
        if changed is not None:
            hits = hits.unionByName(_met(words[-1].select("doc", "word"), _union(known))).distinct()
        rules = stored(hits.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("wrong", "right"))).alias("rules")), "workflow-hits")
        if not rules.limit(1).count():
            release(rules)
            break
        number += 1
        current = _live(_layered(layers).join(small_or_not(rules), "doc"), newest)
        changed = stored(current.select("doc", replaced(F.col("text"), F.col("rules")).alias("text")), "workflow-changed")
        layers.append(changed)
        words.append(stored(words_of(changed), "workflow-words"))
        mine = rules.select("doc", F.lit(number).alias("newest"))
        newest = stored(mine if newest is None else newest.join(mine, "doc", "left_anti").union(mine), "workflow-newest")
        release(rules)
        fresh = _learn(known, seen, words[-1], verify) if verify is not None else known[0].limit(0)
    out = _live(_layered(layers), newest)
    return out.select("doc", "text", F.coalesce("newest", F.lit(0)).alias("passes") if newest is not None else F.lit(0).alias("passes"))


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def _layered(tables: list[DataFrame]) -> DataFrame:
    return _union([t.withColumn("layer", F.lit(i)) for i, t in enumerate(tables)])


def _live(rows: DataFrame, newest: DataFrame | None) -> DataFrame:
    """Rows of the newest layer of their text, without the layer."""
    if newest is None:
        return rows.drop("layer")
    return rows.join(small_or_not(newest), "doc", "left").where(F.col("layer") == F.coalesce("newest", F.lit(0))).drop("layer", *([] if "text" in rows.columns else ["newest"]))


def _met(words: DataFrame, corrections: DataFrame) -> DataFrame:
    return words.join(small_or_not(corrections.withColumnRenamed("wrong", "word")), "word").withColumnRenamed("word", "wrong")


def _learn(known: list[DataFrame], seen: list[DataFrame], words: DataFrame, verify) -> DataFrame:
    """Adds the words never seen before to ``seen`` and the corrections they give rise to to ``known``; returns these."""
    kinds = words.select("word").distinct()
    seen.append(stored(kinds if not seen else kinds.join(_union(seen), "word", "left_anti"), "workflow-new-words"))
    found = verify(seen[-1]).where("wrong <> right").groupBy("wrong").agg(F.min("right").alias("right")).join(_union(known).select("wrong"), "wrong", "left_anti")
    known.append(stored(found.select("wrong", "right"), "workflow-corrections"))
    return known[-1]
