"""A corpus pipeline: five stages, each on all that the one before it kept.

Stages take the columns of ``documents`` and any others, whatever their names; all but the last
return the columns they got. An empty table gives an empty one, and null languages, sources or
labels change nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import bin_packing, decontamination, quality_classifier, quality_rules, queries, simhash
from tracewright.llm.shared import one_of_each, without
from tracewright.plans.materialize import release, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rule_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the base rule or the n-gram log-likelihood ratio rejects.

    Null and empty texts and those of under 50 words go; of repeated rows all stay or all go.
    """
    found = quality_rules.quality(docs, queries.trusted_ids(spark, sf_dir))
    return without(docs, stored(found.where("not kept").select("__k", "__d").distinct(), "rejected"))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier predicts to be bad, those scored under GOOD.

    A null or empty text has the score of the bias alone; equal texts have equal scores. Without
    labels all score alike and all stay.
    """
    model = quality_classifier.train(docs, _table(spark, sf_dir, "labels"))
    return docs.where(quality_classifier.score_column(model, F.col("text")) >= queries.GOOD)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: that of the least id, null ids last; of equal rows one.

    Rows are told by id and text, so an id that comes with several texts loses only those that are
    duplicates; of rows that differ in other columns alone that of the least hash stays, and only
    such rows are moved. Null, empty and wordless texts are one group.
    """
    found = stored(simhash.row_groups(docs), "near-duplicates")
    kept = without(docs, stored(found.where("not first").select("__k", "__d").distinct(), "duplicates"))
    repeated = stored(found.where("first").groupBy("__k", "__d").count().where("count > 1").select("__k", "__d"), "repeated-rows")
    return one_of_each(kept, repeated) if repeated.limit(1).count() else kept


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents contaminated by the benchmark. Null and empty texts hold no item and stay."""
    found = decontamination.verdicts(docs, _table(spark, sf_dir, "benchmark")).where("contaminated")
    return without(docs, stored(found.select("__k", "__d").distinct(), "contaminated"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences: a row for each piece of a document.

    A null or empty text is one id, its end. Rows are packed each for itself, repeated ones too.
    """
    return bin_packing.pack(queries.token_counts(docs), F.col("tokens"), "id").withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rule_stage),
    ("quality_classifier", quality_classifier_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

#: The stages hash with XXH64 and train a model, which DuckDB cannot express; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn on ``documents``; what a stage returns is written and read again, and deleted once the next has been written."""
    docs, last = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        if last is not None:
            release(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
