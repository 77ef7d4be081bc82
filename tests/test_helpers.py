"""Predicates, dates, tags and outlines."""

import datetime

import pytest
from pyspark.sql import functions as F

from tracewright.functions import notes, predicates
from tracewright.operators import transcript


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def s(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize("text,want", [("due 2024-05-06", "2024-05-06"), ("by 3/4/2024", "2024-03-04"), ("deadline: 3 March 2024", "2024-03-03"), ("March 3, 2024", "2024-03-03"), ("Mar 3, 2024", "2024-03-03"), ("Mar 3 2024", None), ("on 25/12/2024", "2024-12-25"), ("1/2/24", None), ("5 May 2023", None), ("due 2/3/4 or by 7 June 2025", "2025-06-07"), ("soon", None), (None, None)])
def test_deadlines(spark, text, want):
    assert one(spark, notes.deadline(s(text))) == want


@pytest.mark.parametrize("spec,want", [("1-3,5", [1, 2, 3, 5]), ("7-5, 6", [5, 6, 7]), ("x", None), ("", None), (None, None)])
def test_episode_specs(spark, spec, want):
    assert one(spark, predicates.episodes_of(s(spec))) == want
    rows = spark.createDataFrame([(i,) for i in range(1, 9)], "ep long")
    assert [r.ep for r in predicates.in_episodes(rows, spec).orderBy("ep").collect()] == (want or list(range(1, 9)))


def test_names(spark):
    assert one(spark, predicates.doubtful_name(s("Ann"))) and one(spark, predicates.doubtful_name(s("Ann L33"))) and not one(spark, predicates.doubtful_name(s("Ann Lee")))
    assert one(spark, predicates.similar_names(s("Ann Lee"), s("ANN Smith"))) and not one(spark, predicates.similar_names(s("Ann B Lee"), s("Ann C Smith")))
    assert one(spark, predicates.node_label(s("Institution"), F.lit(5))) == "Organization" and one(spark, predicates.node_label(s(None), F.lit(1000))) == "InvestigationTarget" and one(spark, predicates.node_label(s("?"), F.lit(9))) == "Person"
    assert [one(spark, predicates.truthy(s(v))) for v in ("Yes", "0", None)] == [True, False, False]
    assert one(spark, predicates.case_anomaly(s("aBBBBBBBBB"))) > 0.7 and one(spark, predicates.case_anomaly(s("word"))) == 1 and one(spark, predicates.case_anomaly(s("WOrd"))) == 0
    assert one(spark, predicates.risk_decision(s("Approve, or ESCALATE"))) == "escalate"
    assert one(spark, predicates.name_or_alias_contains(s(None), F.array(s("Annie")), "nni"))


def test_id_order(spark):
    rows = spark.createDataFrame([("N-1000", 1), ("A-1000.1", 1), ("N-11", 2), ("zz", 1), ("A-1000", 1)], "id string, ep int")
    assert [r.id for r in rows.orderBy(predicates.id_sort_key(F.col("id"), F.col("ep"))).collect()] == ["N-11", "A-1000", "N-1000", "A-1000.1", "zz"]


def test_notes(spark):
    now = F.lit(datetime.datetime(2024, 1, 1, 10, 0, 30))
    assert one(spark, notes.minutes_until(s("10:16"), now)) == 15 and one(spark, notes.minutes_until(s("09:00"), now)) is None and one(spark, notes.minutes_until(s("x"), now)) is None
    assert one(spark, notes.ical_stamp(s("2024-01-02T03:04Z"))) == "20240102T030400Z" and one(spark, notes.ical_stamp(s("2024-01-02"))) is None
    assert one(spark, notes.video_id(s("https://youtu.be/abcdefghijk?t=1"))) == "abcdefghijk" and one(spark, notes.first_url(s("see (https://a.b/c)."))) == "https://a.b/c"
    assert one(spark, notes.tags(s("#b #[[a]] #b #x[y"))) == ["a", "b", "x[y"] and one(spark, notes.page_refs(s("[[x y]] [[z]]"))) == ["x y", "z"] and one(spark, notes.clean_block(s(" [[x]] y"))) == "x y"
    assert one(spark, notes.filler_count(s("Um, I like er this"))) == 3 and one(spark, notes.without_fillers(s("Um, I er go"))) == "I go"
    assert one(spark, notes.first_heading(s("x\n# T \n"), s("f"))) == "T" and one(spark, notes.first_heading(s("x"), s("f"))) == "f"
    parts = one(spark, notes.split_long(s("aaa\nbbb\nccccccccc"), 8))
    assert "".join(parts) == "aaa\nbbb\nccccccccc" and max(map(len, parts)) <= 9


def test_outline(spark):
    lines = transcript.numbered_lines(spark.createDataFrame([(1, "- a\n\t- TODO b\n\t\t- c\n\t- d\n\n- e")], "doc_id long, text string"), "doc_id", "text")
    got = notes.subtree_ends(notes.outline(lines)).orderBy("line_no").collect()
    assert [(r.text, r.depth, r.marker, r.end_no) for r in got] == [("a", 0, None, 5), ("b", 1, "TODO", 3), ("c", 2, None, 3), ("d", 1, None, 5), ("e", 0, None, None)]
