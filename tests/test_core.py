"""Operators on fixtures, queries against DuckDB, streams against their batch twins."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tracewright import catalog
from tracewright.functions import text as tx
from tracewright.operators import patterns, quality, records, resolve, transcript
from tracewright.plans.components import connected_components
from tracewright.sources import formats
from tracewright.streaming import incremental

SMALL = "/root/testdata/sf0.001"


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SMALL}/{name}'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SMALL)
    want = duck.execute(catalog.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = sorted((tuple(plain(v) for v in r) for r in got.select(*columns).collect()), key=str)
    assert rows == sorted((tuple(plain(v) for v in r) for r in want.fetchall()), key=str)


@pytest.mark.parametrize("text,seconds", [("22:04–22:17", 1324), ("23:15", 1395), ("1:05:30", 3930), ("", None), (None, None)])
def test_clock(spark, text, seconds):
    assert value(spark, tx.clock_seconds(F.lit(text).cast("string"))) == seconds


def test_episode_scores(spark):
    rows = [(1.0, 0.647, 0.824, 1.0, 0.897, 86.1), (0.571, 0.429, 1.0, 1.0, 0.391, 65.9), (1.0, 0.5, 0.8, 1.0, 0.857, 81.4), (1.0, 1.0, 1.0, 1.0, 0.288, 89.3), (1.0, 0.524, 0.476, 1.0, 0.625, 72.0), (0.667, 0.333, 0.685, 1.0, 0.578, 62.4), (1.0, 0.727, 0.818, 1.0, 0.45, 81.3)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, want double")
    for r in df.withColumn("got", quality.episode_score(*[F.col(c) for c in "abcde"])).collect():
        assert abs(r.got - r.want) <= 0.11  # the components are given to three digits


def test_edge_screen_cases(spark):
    pairs = lambda rows: spark.createDataFrame(rows, "node string, claim string")
    claims = spark.createDataFrame([("C-1",)], "claim string")
    issues = lambda f, b: {(r.node, r.claim, r.issue) for r in resolve.edge_screen(pairs(f), pairs(b), claims).collect()}
    assert issues([("N-1", "C-1")], [("N-2", "C-1")]) == {("N-1", "C-1", "node_claim_subject_mismatch"), ("N-2", "C-1", "claim_node_backlink_missing")}
    assert issues([], [("N-1", "C-1")]) == {("N-1", "C-1", "claim_node_backlink_missing")}
    assert issues([("N-1", "C-999")], []) == {("N-1", "C-999", "node_claim_missing")}
    assert issues([("N-9", "C-1")], []) == set()
    assert issues([("N-1", "C-1"), ("N-2", "C-1")], [("N-1", "C-1"), ("N-2", "C-1")]) == set()
    kept = lambda f, b: {(r.node, r.claim) for r in resolve.edge_sanitise(pairs(f), pairs(b), claims).collect()}
    assert kept([("N-1", "C-1")], [("N-2", "C-1")]) == {("N-2", "C-1")} and kept([("N-9", "C-1")], []) == {("N-9", "C-1")}


def test_text_functions(spark):
    assert value(spark, tx.nth_replace(F.lit("a-b-c-d"), "-", "+", 1)) == "a-b+c-d"
    assert value(spark, tx.nth_replace(F.lit("a-b"), "-", "+", 3)) == "a-b" and value(spark, tx.nth_replace(F.lit("a-b-c"), "-", "+", -1)) == "a+b+c"
    assert value(spark, tx.id_list(F.lit("C-1, same_as:C-2,, x, A-1000.1"))) == ["C-1", "C-2", "A-1000.1"]
    assert value(spark, tx.fold_replace(F.lit("ab"), [("a", "b"), ("bb", "c")])) == "c"
    assert value(spark, tx.normal_name(F.lit("  Ann   LEE "))) == "ann lee"
    assert value(spark, tx.truncated(F.lit("abcdef"), 4)) == "abc…" and value(spark, tx.truncated(F.lit("  "), 4)) is None


def test_components_and_spans(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(50, 51), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges, "a", "b").collect()}
    assert got == {i: 1 for i in range(1, 41)} | {50: 50, 51: 50}
    spans = spark.createDataFrame([("d", 0, 10), ("d", 2, 5), ("d", 0, 10), ("d", 0, 9), ("d", 8, 12)], "doc string, lo int, hi int")
    assert sorted((r.lo, r.hi) for r in transcript.outermost(spans, "doc").collect()) == [(0, 10), (0, 10), (8, 12)]


def test_pairs_in_blocks(spark):
    from tracewright.plans.pairs import block_pairs

    rows = [(1, i, f"t{i % 5}") for i in range(40)] + [(2, 1, "x"), (2, 1, "y"), (2, 2, "z"), (3, 9, "q")]
    got = block_pairs(spark.createDataFrame(rows, "k int, item int, t string"), "k", "item", block_rows=13).select("k", "a.item", "a.t", "b.item", "b.t").collect()
    want = [(x[0], *x[1:], *y[1:]) for x in rows for y in rows if x[0] == y[0] and x[1] < y[1]]
    assert sorted(map(tuple, got)) == sorted(want)


def test_near_names_lose_nothing(spark):
    import random

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            before, row[0] = row[0], i + 1
            for j, y in enumerate(b):
                before, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, before + (x != y))
        return row[-1]

    rng = random.Random(3)
    base = ["".join(rng.choices("abc", k=rng.randint(0, 12))) for _ in range(60)]
    left, right = base[:40], base[20:]
    frame = lambda names, c: spark.createDataFrame([(n,) for n in set(names)], f"{c} string")
    got = {(r.name, r.other, r.distance) for r in resolve.near_names(frame(left, "name"), frame(right, "other")).collect()}
    assert got == {(a, b, distance(a, b)) for a in left for b in right if distance(a, b) <= 3}


def test_collision_repairs_by_hand(spark):
    def families(docs):
        used, out = set(), []
        for doc in sorted({d for d, _ in docs}):
            for f in sorted({x for d, x in docs if d == doc}):
                new = max(used) + 1 if f in used else f
                used.add(new)
                out.append((doc, f, new))
        return out

    def claims(docs):
        free, out = 1000, []
        for doc, c in sorted(set(docs)):
            new = max(c, free)
            free = new + 1
            out.append((doc, c, new))
        return out

    # 1004 and 1006 are first given as new numbers and then met; the second chain has more than one such number.
    for docs in ([(1, 1000), (1, 1003), (2, 1000), (3, 1004), (4, 1006), (4, 1003), (5, 1001), (5, 1007)], [(1, 1000), (2, 1000), (3, 1001), (4, 1002), (5, 1003), (5, 1000)], [(1, 999)]):
        frame = spark.createDataFrame(docs, "doc int, n long")
        assert sorted(map(tuple, resolve.family_repair(frame, "doc", "n").collect())) == sorted(families(docs))
        assert sorted(map(tuple, resolve.claim_repair(frame, "doc", "n").collect())) == sorted(claims(docs))


def test_similarity_and_upsert(spark):
    assert value(spark, patterns.similarity(F.lit("abcd"), F.lit("abcx"))) == 0.75 and value(spark, patterns.similarity(F.lit(""), F.lit(""))) is None
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, None, "z"), (3, "c", None)], "k int, v string, w string")
    assert sorted(tuple(r) for r in records.upsert(old, new, ["k"]).collect()) == [(1, "a", "x"), (2, "b", "z"), (3, "c", None)]


def test_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1, "name": "x"}\nnot json\n{"id": 2}\n')
    got = formats.read_jsonl(spark, f"file://{tmp_path}/a.jsonl", "id int, name string, _corrupt_record string").collect()
    assert [r.id for r in got] == [1, None, 2] and got[1]._corrupt_record == "not json"
    (tmp_path / "t.md").write_text("# T\nline\n")
    assert [(r.line_no, r.line) for r in formats.read_lines(spark, f"file://{tmp_path}/t.md").collect()] == [(0, "# T"), (1, "line"), (2, "")]
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, k string")
    formats.write_partitioned(df, f"file://{tmp_path}/p", "k")
    assert spark.read.parquet(f"file://{tmp_path}/p").count() == 2
    formats.write_report(df, f"file://{tmp_path}/r", "Title")
    assert {r.value for r in spark.read.text(f"file://{tmp_path}/r").collect()} == {"# Title", "| n | k |", "| --- | --- |", "| 1 | a |", "| 2 | b |"}


def test_streams_equal_batches(spark, tmp_path):
    events = spark.read.parquet(f"{SMALL}/events.parquet").limit(400)
    events.repartition(4).write.parquet(f"file://{tmp_path}/in")
    stream = lambda: incremental.event_stream(spark, f"file://{tmp_path}/in")
    batch = spark.read.parquet(f"file://{tmp_path}/in")
    incremental.upsert_batches(stream(), f"file://{tmp_path}/out", ["user_id"], "event_id", f"file://{tmp_path}/c1")
    got = {(r.user_id, r.event_id) for r in incremental.latest_of(spark, f"file://{tmp_path}/out", ["user_id"], "event_id").collect()}
    assert got == {(r.user_id, r.m) for r in batch.groupBy("user_id").agg(F.max("event_id").alias("m")).collect()}
    seen = incremental.run_to_end(incremental.digest(stream(), ["event_id"], "ts", "3650 days"), f"file://{tmp_path}/c2", "digest_rows")
    assert seen.count() == batch.select("event_id").distinct().count()
