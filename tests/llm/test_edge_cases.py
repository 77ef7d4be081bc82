"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator and stage."""

import uuid

import pytest
from pyspark.sql import functions as F

from tracewright.llm import bin_packing, decontamination, html_extraction, lattice_lm, license_scan, quality_classifier, quality_rules, queries, sharding, simhash, token_store
from tracewright.plans.materialize import shared_dir

LONG = "the quick brown fox jumps over a lazy dog " * 9000
ROWS = [
    (1, "one two three four five six", "en", 5, "x", "y"),
    (1, "one two three four five six", "en", 5, "x", "y"),
    (2, None, None, None, None, None),
    (3, "", "en", 0, "", ""),
    (None, "a text without an id", "fr", 1, "q", None),
    (4, "   \n\t ", "de", 2, "q", "z"),
    (5, LONG, "en", 9, "k", "w"),
    (6, LONG + "end", "en", 9, "k", "w"),
    (7, "é" * 3000, "fr", 9, "k", "w"),
]
SCHEMA = "doc_id long, text string, lang string, n_words long, kept string, id string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (5, 0), (6, 0), (None, 1), (3, None), (1, 1)], "doc_id long, quality int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(10, "quick brown fox jumps over a lazy dog the quick brown fox jumps"), (11, None), (12, ""), (None, "one two three"), (13, "four five")], "item_id long, text string")


def runs(spark, docs, labels, items):
    trusted = labels.where("quality = 1").select("doc_id")
    path = f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"

    def store():
        token_store.write_store(docs, path, queries.vocabulary("word_bpe_49k.json"))
        return token_store.verified(spark, path)

    return {
        "quality_rules": lambda: quality_rules.quality(docs, trusted),
        "sharding": lambda: sharding.shard_rows(docs),
        "licenses": lambda: license_scan.scan(docs),
        "html": lambda: html_extraction.main_text(docs, "text"),
        "classifier": lambda: docs.select("doc_id", quality_classifier.score_column(quality_classifier.train(docs, labels), F.col("text")).alias("score")),
        "packing": lambda: bin_packing.pack(queries.token_counts(docs), F.col("tokens"), "id"),
        "store": store,
        "simhash": lambda: simhash.near_duplicates(docs),
        "decontamination": lambda: decontamination.verdicts(docs, items),
        "lattice": lambda: lattice_lm.score(docs, quality_classifier.remainder("doc_id", 10) == 0, queries.vocabulary("piece_bpe_32k.model")),
    }


NAMES = ["quality_rules", "sharding", "licenses", "html", "classifier", "packing", "store", "simhash", "decontamination", "lattice"]


@pytest.mark.parametrize("name", NAMES)
def test_every_row_gets_a_result(spark, docs, labels, items, name):
    got = runs(spark, docs, labels, items)[name]().collect()
    want = len(ROWS) + (sum(-(-len(LONG.split()) // 8192) - 1 for _ in range(2)) + 0 if name == "packing" else 0)
    assert len(got) >= len(ROWS) if name == "packing" else len(got) == want


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, docs, labels, items, name):
    assert runs(spark, docs.limit(0), labels.limit(0), items.limit(0))[name]().collect() == []


def test_equal_rows_get_equal_results(spark, docs, labels, items):
    for name in ("quality_rules", "licenses", "simhash", "lattice"):
        got = [tuple(r) for r in runs(spark, docs, labels, items)[name]().collect() if r["id"] == 1]
        assert len(got) == 2 and got[0] == got[1], name


def test_null_and_empty_texts(spark, docs, labels, items):
    rules = {r["id"]: r for r in quality_rules.quality(docs, labels.select("doc_id")).collect()}
    assert rules[2].base_failed and rules[3].n_words == 0 and rules[2].llr_score == 0 and not rules[3].kept
    prints = {r["id"]: r for r in simhash.near_duplicates(docs).collect()}
    assert prints[2].fp == prints[3].fp == prints[4].fp == 0 and prints[4].component == 2
    lm = {r["id"]: r for r in runs(spark, docs, labels, items)["lattice"]().collect()}
    assert lm[2].n_tokens == lm[3].n_tokens == 1 and lm[2].score == lm[3].score < 0


def test_stages_keep_the_columns(spark, docs, labels, items, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    folder = f"file://{tmp_path}"
    labels.write.parquet(f"{folder}/labels.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    for source in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, source, folder)
            if name != "best_fit_packing":
                assert out.columns == source.columns, name
            out.collect()


def test_joins_beyond_the_broadcast_limits(spark, docs, labels, items, monkeypatch):
    """The shuffled way of every size-checked join gives the rows of the broadcast way."""
    from tracewright.plans import materialize

    names = ("quality_rules", "decontamination", "packing")
    found = lambda: {n: sorted(map(str, runs(spark, docs, labels, items)[n]().collect())) for n in names}
    small = found()
    monkeypatch.setattr(materialize, "BROADCAST_ROWS", -1)
    assert found() == small
