"""What the findings of round 4 named, on small tables."""

import random

import pytest

from tests.test_queue import items
from tests.test_round3 import plain_fold
from tracewright.llm import simhash
from tracewright.operators import patterns, queue
from tracewright.plans import pairs
from tracewright.plans.materialize import stored


def broadcasts(df):
    """How many sides of joins the plan broadcasts."""
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_variants_are_not_broadcast(spark):
    """variants of few fingerprints look small to the planner, and no side of their join is sent to the driver."""
    fps = stored(spark.createDataFrame([(0,), (1,), (7,), (1 << 40,), (255,)], "fp long"), "few-fingerprints")
    pairs = simhash.close_pairs(fps)
    assert broadcasts(pairs) == 0
    assert sorted(map(tuple, pairs.collect())) == [(0, 1), (0, 7), (0, 1 << 40), (1, 7), (1, 1 << 40)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_cooccurrence_by_bits(spark, monkeypatch, broadcast):
    """nodes are compared by bits that a broadcast holds, or in blocks beyond one; no list of episodes moves, and labels come from tables."""
    names = [f"e{chr(1)}|{e}\\E" for e in range(70)]
    rows = [(n, names[e]) for n in range(40) for e in range(70) if (n * 7 + e * 13) % 11 < 8] + [(50, names[3]), (51, None)]
    seen = spark.createDataFrame(rows, "node int, ep string").where("ep is not null")
    eps = {n: {e for m, e in rows if m == n and e} for n, _ in rows}
    want = {(a, b): (len(c), ",".join(sorted(c))) for a in eps for b in eps if a < b and len(c := eps[a] & eps[b]) >= 2}
    if not broadcast:
        monkeypatch.setattr(patterns, "small_or_not", lambda df: df)
    found = patterns.cooccurrence(seen, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "eps" not in plan and ("BroadcastNestedLoopJoin" in plan) == broadcast
    assert {(r.a, r.b): (r.together, r.episodes) for r in found.collect()} == want


def test_pairs_of_lists_are_written_out_in_pieces(spark):
    """A left list is cut before its pairs are made, so a task holds those of few ids at once; null ids make no pair."""
    near = spark.createDataFrame([(x, y) for x in range(11) for y in range(3)], "x int, y int")
    left = [(x, 100 * x + i) for x in range(11) for i in range(x)] + [(0, None)]
    right = [(y, 5000 + 10 * y + i) for y in range(3) for i in range(3)]
    made = pairs.named_pairs(near, spark.createDataFrame(left, "x int, ia int"), spark.createDataFrame(right, "y int, ib int"), ["x"], ["y"])
    got = sorted(map(tuple, made.collect()))
    assert got == sorted((x, y, ia, ib) for x, ia in left for y, ib in right if ia is not None)
    steps = [x for x in made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines() if "Generate" in x]
    assert len(steps) == 3 and "slice" in steps[-1] and "*(" not in steps[-1]


@pytest.mark.parametrize("most", [0, 4 << 20])
def test_items_for_all_are_read_beside_the_files(spark, monkeypatch, most):
    """items for all episodes that do the same are one action with its turns, and their list moves with no text; beyond its size they meet by grams, alike."""
    rng = random.Random(most)
    word = lambda lo, hi: "".join(rng.choices("abc", k=rng.randint(lo, hi)))
    kinds = [(word(1, 5), word(1, 4)) for _ in range(6)]
    rows = [{"k": k, "episode": str(rng.randint(1, 6)), "find": f, "replace": r, "priority": rng.randint(0, 2), "apply_all": rng.random() < 0.8} for k in range(30) for f, r in [rng.choice(kinds)]]
    files = {(ep, "inscription"): word(20, 60) for ep in range(1, 6)}
    frame = spark.createDataFrame([(e, t, x) for (e, t), x in files.items()], "ep int, tier string, text string")
    monkeypatch.setattr(queue, "BESIDE_BYTES", most)
    sizes = []
    monkeypatch.setattr(queue, "queued", lambda *x, f=queue.queued, **y: (sizes.append(x[0].count()), f(*x, **y))[1])
    found = queue.apply_queue(items(spark, *[{c: v for c, v in r.items() if c != "k"} | {"apply_all": "y" if r["apply_all"] else None} for r in rows]), frame)
    assert sizes[0] == len({(r["find"], r["replace"], r["apply_all"] or r["episode"]) for r in rows}) < len(rows)
    assert {(r.ep, r.tier): (r.text, r.replacements) for r in found.collect()} == plain_fold(rows, files)


def test_counts_alone_carry_no_labels(spark):
    """where episodes are not asked for, no label is looked up, and no list of them moves with the nodes."""
    seen = spark.createDataFrame([(n, e) for n in range(40) for e in range(20) if (n + e) % 7], "node long, ep long")
    found = patterns.cooccurrence(seen, 3).select("a", "b", "together")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" in plan and "eps" not in plan and "substring" not in plan
    assert found.count() == 40 * 39 // 2
