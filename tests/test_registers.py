"""Register text, chunks, overrides and nested values on invented fixtures."""

from pyspark.sql import functions as F

from tracewright.functions import nested
from tracewright.operators import overrides, register, transcript

TEXT = """Intro
**A-1000** Letters
**A-1000.1** A letter of the miller
Event Timestamp: 1901
Confidence: high
**C-1000** The mill was sold
Claim: The mill changed hands.
Anchored Artifacts:
Related Nodes: N-1, same_as:N-1000, N-1
**N-1** Ada Miller
OrgLink: N-1001 parent_of N-1002
RoleLink: N-1 holds_role N-1001 title: Miller
SameAs: N-7 N-3
SameAs: N-3 N-3
Prov: C-1000 invents A-1000.1"""


def lines(spark):
    return transcript.numbered_lines(spark.createDataFrame([(1, TEXT)], "doc_id long, text string"), "doc_id", "text")


def test_register_sections(spark):
    got = {r.id: r for r in register.entities(lines(spark)).collect()}
    assert {i: r.kind for i, r in got.items()} == {"A-1000": "family", "A-1000.1": "artifact", "C-1000": "claim", "N-1": "person"}
    assert got["A-1000.1"].fields["confidence"] == "high" and "anchored artifacts" not in got["C-1000"].fields
    refs = register.references(register.entities(lines(spark)), "Related Nodes").orderBy("pos").collect()
    assert [r.ref for r in refs] == ["N-1", "N-1000"]


def test_register_links(spark):
    got = sorted((r.src, r.rel, r.dst, r.note) for r in register.links(lines(spark)).collect())
    assert got == [("N-1", "holds_role", "N-1001", "Miller"), ("N-1001", "parent_of", "N-1002", None), ("N-3", "same_as", "N-7", None)]


def test_markdown_chunks(spark):
    text = "x\n# One\n" + "a" * 30 + "\n## Two\n" + "b" * 30 + "\n# Three\n" + "c" * 30 + "\nmore"
    rows = register.markdown_chunks(transcript.numbered_lines(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id", "text")).orderBy("chunk").collect()
    assert [(r.header, r.subheader, r.text[0], r.text[-4:]) for r in rows] == [("One", "", "a", "aaaa"), ("One", "Two", "b", "bbbb"), ("Three", "", "c", "more")]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_overrides(spark):
    t = F.lit("Ann Anna, Ann. Annex Ann")
    text, n = overrides.replace_limited(t, overrides.literal_pattern("Ann", ("ex",), True), "Eve")
    assert one(spark, text) == "Eve Anna, Eve. Annex Eve" and one(spark, n) == 3
    text, n = overrides.replace_limited(t, overrides.literal_pattern("Ann"), "$1", 2)
    assert one(spark, text) == "$1 $1a, Ann. Annex Ann" and one(spark, n) == 2
    at = lambda k: one(spark, overrides.replace_at(F.lit("abcabc"), F.lit(k), F.lit("abc"), F.lit("X")))
    assert (at(3), at(1), at(9)) == ("abcX", "abcabc", "abcabc")
    sane = lambda a, b: one(spark, overrides.sane_correction(F.lit(a), F.lit(b)))
    assert sane("Jon", "John") and not sane("Jon", "x" * 101) and not sane("a b c d e f g h i j k l", "the long road " * 4)
    docs = spark.createDataFrame([(1, "a b"), (2, "a")], "doc_id long, text string")
    rules = spark.createDataFrame([(1, 2, "b", "c"), (1, 1, "a", "b"), (1, 3, "zz", "y")], "doc_id long, priority int, find string, put string")
    assert sorted(tuple(r) for r in overrides.apply_by_document(docs, rules).collect()) == [(1, "c c", 2), (2, "a", 0)]


def test_nested_values(spark):
    assert one(spark, nested.recovered_json(F.lit("<think>{x}</think>ok ```json\n{“k”: 3}\n``` end"), "k int")).k == 3
    assert one(spark, nested.recovered_json(F.lit("none"), "k int")) is None
    assert one(spark, nested.as_list(F.lit('["a", "b"]'))) == ["a", "b"] and one(spark, nested.as_list(F.lit(" a "))) == ["a"] and one(spark, nested.as_list(F.lit(None).cast("string"))) == []
    old, new = F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("b"), F.lit(None).cast("string"), F.lit("c"), F.lit("3"))
    assert one(spark, nested.merged_metadata(old, new)) == {"a": "1", "c": "3"}
    assert one(spark, nested.front_matter(F.lit("---\ntitle: A: b\ntag: x\n---\nbody"))) == {"title": "A: b", "tag": "x"}
    assert one(spark, nested.rule_errors({"positive": F.lit(1) > 0, "short": F.lit("abc") == F.lit("x"), "given": F.lit(None).cast("boolean")})) == ["short", "given"]
