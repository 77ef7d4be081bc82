"""Scores, documents, stores, identifiers and repair on small invented fixtures: blanks, ties, limits, unknown forms."""

from pyspark.sql import functions as F

from tracewright.functions import media, notes
from tracewright.operators import documents, hub, identifiers, register, repair, scores, stores


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_scores_of_empty_and_full_documents(spark):
    schema = "doc int, claims array<struct<anchored_artifacts:array<int>,related_nodes:array<int>,claim_timestamp:string,transcript_snippet:string>>, artifacts array<struct<sub_items:array<struct<ref:int,video_timestamp:string>>>>, nodes array<struct<related_nodes:array<int>,related_claims:array<int>>>"
    rows = [(1, [], [], []), (2, None, None, None), (3, [([1, 2], [1, 2, 3], "t", None), ([], [], "", "said")], [([(1, "t"), (2, None)],)], [([1, 2], [3, 4])])]
    got = {r.doc: r for r in scores.episode_scores(spark.createDataFrame(rows, schema)).collect()}
    assert got[1].overall_score == got[2].overall_score == 0 and got[1].grades == "FFFFF"
    r = got[3]
    assert (r.n_claims, r.n_artifacts, r.n_nodes) == (2, 2, 1)
    assert (r.artifact_coverage, r.claim_grounding, r.cross_ref_density, r.timestamp_completeness, r.node_connectivity) == (0.5, 0.5, 0.5, 0.833, 1.0)
    assert r.overall_score == 62.5 and r.grades == "DDDBA"


def test_pressure_and_memes(spark):
    rows = [(1, "N-1", "a", 1, 1, "medium"), (2, "N-1", "b", 2, 0, None), (3, "N-1", "c", 0, 0, "medium"), (1, "N-2", "x", 1, 1, "high"), (1, "N-3", "y", 1, 1, "odd"), (1, "", "z", 1, 1, "high")]
    nodes = spark.createDataFrame(rows, "ep int, ref string, name string, claim_count int, evidence_count int, pressure string")
    got = {r.ref: (r.name, r.claim_count, r.episodes, r.pressure) for r in scores.node_stats(nodes).collect()}
    assert got["N-1"] == ("c", 3, [1, 2, 3], "medium") and got["N-2"][3] == "high" and set(got) == {"N-1", "N-2", "N-3"}
    assert {r.ref for r in scores.pressure_map(nodes).collect()} == {"N-1", "N-2"}
    said = spark.createDataFrame([(2, "M-1", "late", "t", ["x"]), (1, "M-1", "early", "t", ["a", "b"]), (3, "M-2", "none", "t", [])], "ep int, ref string, term string, type string, occurrences array<string>")
    assert {r.ref: (r.term, r.occurrences, r.episodes) for r in scores.memes(said).collect()} == {"M-1": ("early", ["a", "b", "x"], [1, 1, 2]), "M-2": ("none", [], [])}


def test_json_documents(spark):
    rules = {"required": ["a"], "properties": {"a": {"type": "array"}, "b": {"type": "boolean"}, "c": {"type": "object"}}}
    errors = lambda t: one(spark, documents.schema_errors(F.lit(t), rules))
    assert errors('{"a": [1], "b": true, "c": {}}') == [] and errors("[") == ["not an object"]
    assert errors('{"b": 1, "c": "x"}') == ["a: required", "b: not of type boolean", "c: not of type object"]
    docs = spark.createDataFrame([(1, '{"a": [["x", {"b": "y"}], 3], "c": {}, "d": null}'), (2, "[]"), (3, '"z"')], "id int, t string")
    assert sorted((r.id, r.path, r.value) for r in documents.strings(docs, "id", "t").collect()) == [(1, "$.a[0][0]", "x"), (1, "$.a[0][1].b", "y"), (1, "$.a[1]", "3"), (3, "$", '"z"')]
    lines = [r.line for r in documents.report([("One", spark.createDataFrame([(2, None), (1, "x")], "n int, s string"), [F.col("n")])]).orderBy("section", "place").collect()]
    assert lines == ["## One", "| n | s |", "| --- | --- |", "| 1 | x |", "| 2 |  |"]


def test_batches_links_and_spellings(spark):
    batches = lambda texts, most: one(spark, stores.greedy_batches(F.array(*map(F.lit, texts)), most))
    assert batches(["aa", "bb", "cccccc", "d"], 5) == ["aa\nbb", "cccccc", "d"] and batches(["", ""], 5) == []
    lines = spark.createDataFrame([("d", 1, "# no"), ("d", 2, "see youtu.be/aaaaaaaaaaa"), ("d", 3, "nothing"), ("d", 4, "youtu.be/bbbbbbbbbbb")], "doc string, line_no int, line string")
    p = r"youtu\.be/([A-Za-z0-9_-]{11})"
    nth = lambda after: [(r.episode, r.video[0]) for r in stores.nth_links(lines, p, after).orderBy("episode").collect()]
    assert nth(True) == [(1, "a"), (2, "b")] and nth(False) == [(1, "a"), (3, "b")]
    seen = spark.createDataFrame([("Ty Bowyer", 2), ("ty Boyer", 9), ("Ty Bower", 3), ("Ty", 50), ("Al Bowyer", 8)], "spelling string, n int")
    got = stores.majority_spelling(spark.createDataFrame([("Ty Boyer",), ("Ty Bower",), ("Solo",)], "name string"), seen).collect()
    assert {r.name: r.best for r in got} == {"Ty Boyer": "Ty Bower", "Ty Bower": "ty Boyer"}


def test_identifiers(spark):
    items = spark.createDataFrame([(2, 1, "person", "a", "person", "ann"), (1, 2, "person", "b", "person", "bob"), (1, 1, "target", "c", "topic", "mill"), (2, 2, "target", "d", "place", "mill"), (3, 1, "person", "e", "person", "bob"), (3, 2, "claim", "f", None, None), (3, 3, "person", "g", "person", "")], "ep int, pos int, counter string, ref string, bucket string, name string")
    registry = spark.createDataFrame([("person", "ann", "N-7"), ("topic", "fen", "N-1004")], "bucket string, name string, id string")
    assert {r.ref: r.new_id for r in identifiers.assigned(items, registry).collect()} == {"a": "N-7", "b": "N-8", "c": "N-1005", "d": "N-1006", "e": "N-8", "f": "C-1000", "g": "N-9"}
    refs = F.array(*[F.struct(F.lit(r).alias("ref"), F.lit(i).alias("id")) for r, i in (("A_1", "x"), ("A_1.2", "y"), ("A_10", "z"))])
    assert one(spark, identifiers.rewritten(F.lit("A_1.2 A_10 A_1, A_100"), refs)) == "y z x, A_100"


def test_register_details(spark):
    assert one(spark, register.aliases(F.lit("*Also known as: Ann; ; A. L.*"))) == ["Ann", "A. L."] and one(spark, register.aliases(F.lit("Also"))) is None
    numbers = [one(spark, register.episode_number(F.lit(p), F.lit(t))) for p, t in (("x/episode_007.md", ""), ("x.md", "In Episode 12 we"), ("x.md", "none"))]
    assert numbers == [7, 12, 0]


def test_evidence_choice(spark):
    names = spark.createDataFrame([("n", "Ada Miller")], "node string, name string")
    rows = [("n", 1, None, "first"), ("n", 2, 30, "timed"), ("n", 3, 40, "the miller"), ("n", 4, 50, "ADA MILLER said")]
    for k, want in ((4, (4, "name")), (3, (3, "word")), (2, (2, "timed")), (1, (1, "first"))):
        claims = spark.createDataFrame([(c, s, t) for _, c, s, t in rows[:k]], "claim int, seconds int, text string")
        links = spark.createDataFrame([(n, c) for n, c, _, _ in rows], "node string, claim int")
        best = hub.primary_evidence(hub.node_evidence(links, links.limit(0), claims), names).first()
        assert (best.claim, best.why) == want


def test_repair(spark):
    lines = lambda rows: spark.createDataFrame(rows, "doc string, line_no int, line string")
    raw = lines([("a", 0, "[00:05] short"), ("a", 1, "no cue"), ("a", 2, "[1:00:00] x"), ("b", 0, "[00:01] one")])
    fixed = lines([("a", 0, "[00:05] short and a great deal more"), ("a", 1, "[00:09] cue"), ("a", 2, "[1:00:01] x"), ("b", 0, "[00:01] one"), ("b", 1, "[00:02] two")])
    got = {(r.doc, r.line_no): (r.line, r.note) for r in repair.zipped(raw, fixed).collect()}
    assert got["a", 0] == ("[00:05] short", "raw body kept") and got["a", 1] == ("[00:09] cue", None) and got["a", 2][1] == "cues differ" and got["b", 1] == ("[00:02] two", "line counts differ")
    texts = spark.createDataFrame([("d", "[00:07] a cat [00:09] cat")], "doc string, text string")
    found = repair.scan(texts, [("c", "cat", "an animal"), ("t", r"\[00:09\]", "a cue")]).orderBy("start").collect()
    assert [(r.id, r.start, r.caption_seconds) for r in found] == [("c", 10, 7), ("t", 14, 7), ("c", 22, 9)]
    x = one(spark, repair.corrected(F.lit("Jon met Jonny"), [("Jon", "John", "high"), ("Jonny", "Johnny", "medium"), ("met", "saw", "low")]))
    assert x.text == "John met Johnny" and x.applied == ["Jonny → Johnny", "Jon → John"]


def test_media(spark):
    assert [one(spark, media.strict_seconds(F.lit(t))) for t in ("1:02:03", "02:03", "x 1:2", "")] == [3723, 123, None, None]
    assert one(spark, media.hunk_key(F.lit("none"))) is None
    assert [one(spark, media.bypasses_guard(F.lit(c))) for c in (" ", "$", "”", "é", "")] == [True, True, True, False, False]
    rows = spark.createDataFrame([("- [Grant] Big one — by March 3, 2024 — why",), (" - [RFP]Sea due 2024-05-06",), ("text",), ("-",)], "line string")
    assert [(r.kind, r.name, r.deadline) for r in notes.opportunities(rows, "line").collect()] == [("grant", "Big", "2024-03-03"), ("rfp", "Sea", "2024-05-06")]
