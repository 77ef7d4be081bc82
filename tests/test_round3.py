"""Override queue at scale, repairs of reused numbers in blocks, pressure of several levels in one episode."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tests.test_queue import items
from tracewright.functions.text import match_places, prefix_sums
from tracewright.operators import queue, repair, resolve, scores
from tracewright.streaming import reminders


def families(docs):
    used, top, out = set(), 0, []
    for doc, f in sorted(set(docs)):
        new = top + 1 if f in used else f
        top = max(top, new)
        used.add(new)
        out.append((doc, f, new))
    return out


def test_prefix_sums_and_places(spark):
    for n in (0, 1, 2, 3, 100, 1025):
        numbers = list(range(n))
        got = spark.createDataFrame([(numbers,)], "a array<int>").select(prefix_sums(F.col("a"))).first()[0]
        assert got == [sum(numbers[: k + 1]) for k in range(n)]
    for text, p in (("", "a"), ("banana", "an"), ("aXbXXc", "X"), ("é\U0001f600an", "an"), ("aaa", "a+?")):
        got = spark.createDataFrame([(text,)], "t string").select(match_places(F.col("t"), p)).first()[0]
        assert [(m.start, m.match) for m in got] == [(m.start(), m.group()) for m in re.finditer(p, text)]


def test_places_and_scan_take_linear_time(spark):
    """A megabyte with 20,000 matches."""
    text = ("x" * 47 + "Ann") * 20_000
    frame = spark.createDataFrame([(1, "inscription", text)], "ep int, tier string, text string")
    start = time.time()
    got = frame.select(F.size(match_places(F.col("text"), "Ann")).alias("n"), F.element_at(match_places(F.col("text"), "Ann"), -1)["start"].alias("last")).first()
    assert (got.n, got.last) == (20_000, 999_997)
    assert len(repair.scan(frame.select(F.col("ep").alias("doc"), "text"), [("a", "Ann", "")]).collect()) == 150
    done = queue.apply_queue(items(spark, {"find": "Ann", "replace": "Eve"}), frame).first()
    assert done.replacements == 20_000 and done.text == text.replace("Ann", "Eve")
    assert time.time() - start < 60


def plain_fold(rows, files):
    out = {}
    for (ep, tier), text in files.items():
        now, n = text, 0
        for r in sorted(rows, key=lambda r: (r["priority"], r["k"])):
            if r["apply_all"] or r["episode"] == str(ep):
                n += now.count(r["find"])
                now = now.replace(r["find"], r["replace"])
        if now != text:
            out[ep, tier] = (now, n)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_items_for_all_episodes_meet_texts_by_grams(spark, seed):
    """Replacements that make, break and join what later items look for; short literals; empty replacements in one run of four."""
    rng = random.Random(seed)
    word = lambda lo, hi: "".join(rng.choices("abcde", k=rng.randint(lo, hi)))
    rows = [{"k": k, "episode": str(rng.randint(1, 6)), "find": word(1, 5), "replace": word(0 if seed == 0 else 1, 4), "priority": rng.randint(0, 2), "apply_all": rng.random() < 0.7} for k in range(14)]
    files = {(ep, "inscription"): word(20, 60) for ep in range(1, 6)}
    frame = spark.createDataFrame([(e, t, x) for (e, t), x in files.items()], "ep int, tier string, text string")
    made = items(spark, *[{c: v for c, v in r.items() if c != "k"} | {"apply_all": "y" if r["apply_all"] else None} for r in rows])
    got = {(r.ep, r.tier): (r.text, r.replacements) for r in queue.apply_queue(made, frame).collect()}
    assert got == plain_fold(rows, files)
    counts = {r.id: r.match_count for r in queue.verified(made, frame).collect()}
    assert counts == {f"i{k}": sum(x.count(r["find"]) for (ep, _), x in files.items() if r["apply_all"] or r["episode"] == str(ep)) for k, r in enumerate(rows)}


def test_texts_are_never_shuffled_by_tier(spark):
    frame = spark.createDataFrame([(1, "inscription", "some text")], "ep int, tier string, text string")
    made = items(spark, {"find": "text", "apply_all": "y"}, {"find": "x.*", "match_mode": "regex", "apply_all": "y"})
    plan = queue.verified(made, frame)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(tier#\d+, \d+\)", plan)


@pytest.mark.parametrize("block", [7, 50, 1 << 20])
def test_family_repair_in_blocks(spark, block):
    rng = random.Random(block)
    docs = [(rng.randint(1, 12), rng.randint(1000, 1060)) for _ in range(220)] + [(13, 5000), (14, 5000), (15, 5001), (15, 5003), (16, 5002), (17, 5000), (18, 5004)]
    frame = spark.createDataFrame(docs, "doc int, n long")
    assert sorted(map(tuple, resolve.family_repair(frame, "doc", "n", block).collect())) == sorted(families(docs))


def test_ten_thousand_conflicts(spark):
    """Each number of the second document on is met after it was given as a new one."""
    docs = [(1, n) for n in range(1000, 1100)] + [(d, 1000 + n) for d in range(2, 103) for n in range(100 * (d - 2), 100 * (d - 1))]
    want = families(docs)
    assert sum(f != new for _, f, new in want) >= 10_000
    start = time.time()
    got = resolve.family_repair(spark.createDataFrame(docs, "doc int, n long"), "doc", "n", 4000)
    assert sorted(map(tuple, got.collect())) == sorted(want) and time.time() - start < 60


def test_pressure_of_several_levels_in_one_episode(spark):
    rows = [("N-1", 1, "high", 1), ("N-1", 1, "low", 2), ("N-1", 2, "high", 1), ("N-2", 1, "odd", 1), ("N-2", 2, None, 1), ("N-3", 1, "low", 1), ("N-3", 1, "high", 0), ("N-4", 1, "medium", 1)]
    got = {r.ref: (r.levels, r.max_pressure) for r in scores.pressure_map(spark.createDataFrame(rows, "ref string, ep int, pressure string, seq int")).collect()}
    assert got == {"N-1": ({1: "low", 2: "high"}, "high"), "N-2": ({1: "odd", 2: "low"}, "low"), "N-3": ({1: "low"}, "high")}


def test_reminders_by_hand():
    """Windows, a meeting known late, an acknowledgement for the last reminder sent, and none for another day."""
    m = reminders.MINUTE
    at = lambda *a: reminders.due(*a)
    one = {("a", 100 * m): 0}
    assert at(one, [], 84 * m) == [("a", 100 * m, 15, 84 * m)] and at(one, [], 94 * m) == [("a", 100 * m, 5, 94 * m)]
    assert at(one, [90 * m], 94 * m) == [] and at(one, [83 * m], 94 * m) == [("a", 100 * m, 5, 94 * m)] and at(one, [95 * m], 94 * m) != []
    assert reminders.sending(85 * m + 1, 100 * m, reminders.FIRST) == 86 * m and reminders.sending(86 * m + 1, 100 * m, reminders.FIRST) is None
    two = {("a", 100 * m): 0, ("b", 104 * m): 0}
    assert at(two, [89 * m], 94 * m) == [("a", 100 * m, 5, 94 * m)] and at(two, [89 * m], 98 * m) == []
    days = {("a", 100 * m): 0, ("a", 1540 * m): 0}
    assert at(days, [90 * m], 1534 * m) == [("a", 1540 * m, 5, 1534 * m)]


def test_reminders_of_a_table(spark):
    rng, m = random.Random(8), reminders.MINUTE
    rows = [(rng.randint(1, 3), "meeting", rng.randint(0, 600) * m // 4, f"t{rng.randint(0, 2)}", rng.randint(0, 200) * m) for _ in range(150)] + [(rng.randint(1, 3), "ack", rng.randint(0, 200) * m + 7, None, None) for _ in range(40)]
    frame = spark.createDataFrame(rows, "channel long, kind string, us long, title string, starts_us long").select("channel", "kind", F.timestamp_micros("us").alias("at"), "title", F.timestamp_micros("starts_us").alias("starts"))
    want = []
    for c in (1, 2, 3):
        known = {}
        for x in rows:
            if x[0] == c and x[1] == "meeting":
                known[x[3], x[4]] = min(x[2], known.get((x[3], x[4]), x[2]))
        acks = [x[2] for x in rows if x[0] == c and x[1] == "ack"]
        want += [(c, *r) for now in range(-20, 260) for r in reminders.due(known, acks, now * m)]
    assert sorted(map(tuple, reminders.reminders_of(frame).collect())) == sorted(want)


def test_keyed_log(spark, tmp_path):
    """Every version of a store with null keys, repeated rows, deletions, a clearing and two compactions against a dict."""
    from tracewright.sources.keyed_log import KeyedLog

    log, now, seen = KeyedLog(spark, f"file://{tmp_path}/log", ["a", "b"], "a int, b string, n int"), {}, {}
    frame = lambda rows: spark.createDataFrame(rows, "a int, b string, n int")
    read = lambda v=None: {(r.a, r.b): r.n for r in log.read(v).collect()}
    assert read() == {} and log.version() == 0
    rng = random.Random(2)
    for step in range(9):
        if step == 5:
            version, now = log.clear(), {}
        elif step == 6:
            version = log.delete_where("n < 0")
        elif step % 3 == 2:
            gone = [k for k in now if rng.random() < 0.5] + [(99, "x")]
            version = log.delete(spark.createDataFrame(gone, "a int, b string"))
            now = {k: v for k, v in now.items() if k not in gone}
        else:
            rows = [(rng.choice([1, 2, 3, None]), rng.choice(["x", "y", None]), rng.randint(0, 9)) for _ in range(5)]
            version = log.put(frame(rows))
            best = {}
            for a, b, n in rows:
                best[a, b] = max(n, best.get((a, b), n))
            now = now | best
        seen[version] = dict(now)
        assert all(read(v) == want for v, want in seen.items()) and read() == now
        if step in (3, 7):
            at = log.compact()
            seen = {v: w for v, w in seen.items() if v >= at}
            assert read() == now
            with pytest.raises(ValueError):
                log.read(at - 1)


def test_workflow_equals_full_recomputation(spark):
    from tracewright.operators import workflow

    rng = random.Random(6)
    letters = lambda n: "".join(rng.choices("abcd", k=n))
    texts = [(i, " ".join(letters(rng.randint(1, 3)) for _ in range(rng.randint(0, 12))) + rng.choice(["", "!", "\n"])) for i in range(60)] + [(60, None), (61, ""), (62, "-- 12 é")]
    given = {letters(2): letters(2) for _ in range(5)}
    learn = lambda w: w[:-1] + "a" if len(w) == 3 and w.endswith("d") else w[:2] if len(w) == 3 and w.endswith("a") else w

    def plain(most):
        now, passes, known = dict(texts), {i: 0 for i, _ in texts}, {k: v for k, v in given.items() if k != v}
        words = lambda: {w for t in now.values() for w in re.findall("[A-Za-z]+", t or "")}
        for n in range(1, most + 1):
            for w in words():
                if w not in known and learn(w) != w:
                    known[w] = learn(w)
            after = {i: t and re.sub("[A-Za-z]+", lambda m: known.get(m.group(), m.group()), t) for i, t in now.items()}
            passes |= {i: n for i in now if after[i] != now[i]}
            if after == now:
                break
            now = after
        return sorted((i, str(now[i]), passes[i]) for i in now)

    rule = F.when((F.length("word") == 3) & F.col("word").endswith("d"), F.concat(F.expr("left(word, 2)"), F.lit("a"))).when((F.length("word") == 3) & F.col("word").endswith("a"), F.expr("left(word, 2)")).otherwise(F.col("word"))
    for most in (1, 3, 8):
        got = workflow.until_stable(spark.createDataFrame(texts, "doc int, text string"), spark.createDataFrame(list(given.items()), "wrong string, right string"), lambda words: words.select(F.col("word").alias("wrong"), rule.alias("right")), most)
        rows = sorted((r.doc, str(r.text), r.passes) for r in got.collect())
        assert rows == plain(most)
    assert max(p for *_, p in rows) >= 3


SCHEMA = {
    "type": "object", "required": ["id", "claims"], "additionalProperties": False,
    "properties": {
        "id": {"type": "string", "pattern": r"^E-\d+$", "minLength": 3, "maxLength": 6}, "n": {"type": ["integer", "null"], "minimum": 0, "maximum": 9},
        "kind": {"enum": ["a", "b", 3, None, True]},
        "claims": {"type": "array", "minItems": 1, "maxItems": 3, "items": {"$ref": "#/definitions/claim"}},
    },
    "definitions": {"claim": {"type": "object", "required": ["ref"], "properties": {"ref": {"type": "string", "pattern": "^C-"}, "nodes": {"items": {"type": "string", "pattern": "^N-"}}, "at": {"type": "number"}}}},
}
BODIES = [
    None, "no json", "[]", "3", "{}", '{"id": "E-1", "claims": [{"ref": "C-1"}]}', '{"id": "E-1", "claims": [{"ref": "C-1", "nodes": ["N-1", "x", 4, {"a": 1}], "at": 1.5}, {"nodes": []}, 7]}',
    '{"id": "e", "n": -1, "kind": "c", "claims": [], "more": 1, "also": null}', '{"id": 12, "n": 10.5, "kind": 3, "claims": {"ref": 1}}', '{"id": "E-12345", "n": null, "kind": null, "claims": [1, 2, 3, 4]}',
    '{"id": "E-1", "n": 5.0, "kind": true, "claims": [{"ref": null, "nodes": null, "at": "x"}]}', '{"id": "E-9", "n": 1e300, "claims": [' + ",".join(['{"ref": "x"}'] * 60) + "]}",
]


def plain_errors(value, schema, path, root):
    import json

    if "$ref" in schema:
        schema = root["definitions"][schema["$ref"].split("/")[-1]]
    kinds = {"object": dict, "array": list, "string": str, "boolean": bool}
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    fits = lambda t: value is None if t == "null" else number and (t == "number" or value == int(value)) if t in ("number", "integer") else isinstance(value, kinds[t])
    out, at = [], "/".join(map(str, path)) or "(root)"
    add = lambda bad, what: out.append(f"schema[{at}]: {what}") if bad else None
    if "type" in schema:
        names = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        add(not any(map(fits, names)), f"is not of type {', '.join(names)}")
    if "enum" in schema:
        add(not any(type(x) is type(value) and x == value for x in schema["enum"]), f"is not one of {', '.join(map(json.dumps, schema['enum']))}")
    if isinstance(value, str):
        add("pattern" in schema and not re.search(schema.get("pattern", ""), value), f"does not match {schema.get('pattern')}")
        add(len(value) < schema.get("minLength", 0), f"is shorter than {schema.get('minLength')}")
        add(len(value) > schema.get("maxLength", 10**9), f"is longer than {schema.get('maxLength')}")
    if number:
        add(value < schema.get("minimum", value), f"is less than {schema.get('minimum')}")
        add(value > schema.get("maximum", value), f"is greater than {schema.get('maximum')}")
    if isinstance(value, dict):
        for name in schema.get("required", []):
            add(name not in value, f"{name} is required")
        odd = sorted(set(value) - set(schema.get("properties", {})))
        add(schema.get("additionalProperties") is False and odd, f"has unknown properties {', '.join(odd)}")
    if isinstance(value, list):
        add(len(value) < schema.get("minItems", 0), f"has fewer than {schema.get('minItems')} items")
        add(len(value) > schema.get("maxItems", 10**9), f"has more than {schema.get('maxItems')} items")
    for name, sub in schema.get("properties", {}).items() if isinstance(value, dict) else []:
        out += plain_errors(value[name], sub, [*path, name], root) if name in value else []
    for i, x in enumerate(value) if isinstance(value, list) and "items" in schema else []:
        out += plain_errors(x, schema["items"], [*path, i], root)
    return out


def test_schema_errors_name_their_path(spark):
    import json

    from tracewright.functions.schema import schema_errors

    got = spark.createDataFrame(list(enumerate(BODIES)), "k int, body string").select("k", schema_errors(F.col("body"), SCHEMA).alias("e")).orderBy("k").collect()
    for row, body in zip(got, BODIES, strict=True):
        try:
            want = plain_errors(json.loads(body), SCHEMA, [], SCHEMA)[:50]
        except (TypeError, ValueError):
            want = ["schema[(root)]: is not JSON"]
        assert row.e == want, body
    for bad in ({"oneOf": []}, {"$ref": "#"}, {"items": {"$ref": "other.json"}}):
        with pytest.raises(ValueError):
            schema_errors(F.lit("{}"), bad)


def test_reports_leave_out_what_is_missing(spark):
    from tracewright.operators import reports

    prep = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "day int, at int, line string")
    tasks = spark.createDataFrame([(1, 1, None, "x"), (3, 2, "done", None)], "day int, at int, status string, description string")
    text = {}
    for r in reports.daily_brief(prep, tasks).orderBy("day", "section", "a", "b").collect():
        text.setdefault(r.day, []).append(r.line)
    assert text == {1: ["a", "---", "## To-dos", "- [PENDING] x"], 2: ["b"], 3: ["# Daily Brief — 3", "- [DONE] "]}
    people = spark.createDataFrame([("p", "Ann", None, "", [1, 2])], "person string, name string, aliases array<string>, description string, episodes array<int>")
    claims = spark.createDataFrame([], "person string, at int, claim string, label string, ep int, time string, text string, anchors array<string>")
    arts = spark.createDataFrame([("p", 1, "A-1", 2, "seen", None)], "person string, at int, artifact string, ep int, text string, confidence string")
    near = spark.createDataFrame([("p", f"N-{i}", f"n{i}", list(range(i % 3 + 1))) for i in range(12)], "person string, other string, name string, episodes array<int>")
    lines = [r.line for r in reports.person_reports(people, claims, arts, near).orderBy("section", "a", "b").collect()]
    assert lines[:6] == ["# Ann", "**ID:** p", "**Episodes:** 1, 2", "**Evidence:** 1 artifacts, 0 claims", "## Evidence (1)", "- **A-1** (Episode 2): seen"]
    assert lines[6] == "## Connections" and len(lines) == 17 and lines[7] == "- **n11** (N-11): 3 episodes [0, 1, 2]"
    raw = [None, "x", "{}", '{"drafts": [], "published": [{"url": "u"}]}', '{"main": {"drafts": null, "refreshing": true}}', '{"main": 3}']
    got = [r.x for r in spark.createDataFrame([(i, t) for i, t in enumerate(raw)], "k int, t string").select("k", reports.cached_publication(F.col("t"), "main", "main").alias("x")).orderBy("k").collect()]
    assert [(len(x.drafts), len(x.published), x.refreshing) for x in got] == [(0, 0, False)] * 3 + [(0, 1, False), (0, 0, True), (0, 0, False)]
