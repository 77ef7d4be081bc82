
import pytest

from tracewright.llm import html_extraction, license_scan

def test_near_duplicate_stage_keeps_one_row_of_each_group(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from tracewright.llm import simhash

    a, b, c, d = (" ".join(f"{x}{k}" for k in range(400)) for x in "abcd")
    near = next(t for t in (c + f" end{k}" for k in range(200)) if (simhash.fingerprint(t) ^ simhash.fingerprint(c)).bit_count() <= 3)
    rows = [(1, a), (None, a), (None, b), (2, a), (2, d), (None, c), (None, near), (None, b)]
    kept = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(t[:2] for _, t in kept) == ["a0", "b0", "c0", "d0"]
    assert {(r.doc_id, r.text) for r in kept} >= {(1, a), (None, b), (2, d)}


def test_near_duplicate_stage_with_ids_of_several_texts(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    a, b = (" ".join(f"{x}{k}" for k in range(300)) for x in "ab")
    rows = [(3, b), (5, a), (5, b), (9, a), (7, None), (None, ""), (8, "  ")]
    kept = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(3, b), (5, a), (7, None)], key=str)


def test_filter_keeps_rows_whole_beyond_the_broadcast_limit(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tracewright.llm import shared
    from tracewright.plans import materialize

    rows = [(i if i % 7 else None, f"text {i % 40}" if i % 11 else None) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keys = shared.row_key(docs).where(F.coalesce(F.col("doc_id"), F.lit(0)) % 3 == 1).select("__k", "__d").distinct().cache()
    want = sorted((r for r in rows if (r[0] or 0) % 3 != 1), key=str)
    for bits in (1 << 27, 1 << 4):  # a filter that parts the rows, and one that lets all through to the join
        for limit in (1_000_000, -1):
            monkeypatch.setattr(shared, "FILTER_BITS", bits)
            monkeypatch.setattr(materialize, "BROADCAST_ROWS", limit)
            assert sorted(map(tuple, shared.without(docs, keys).collect()), key=str) == want
            assert shared.within(shared.row_key(docs), keys).count() == len(rows) - len(want)


def test_broadcasts_are_checked_by_bytes(spark, monkeypatch):
    from tracewright.plans import materialize

    table = spark.createDataFrame([(i, "x" * 1000, [i] * 9) for i in range(20)], "i long, s string, a array<long>")
    assert materialize.small_or_not(table) is not table
    monkeypatch.setattr(materialize, "BROADCAST_BYTES", 20_000)
    assert materialize.small_or_not(table) is table and materialize.small_or_not(table.select("i")) is not table


@pytest.mark.parametrize("width,lead", [(79, ""), (75, " * "), (30, "# "), (1, "")])
def test_license_notices_in_lines_of_any_width(spark, width, lead):
    import textwrap

    def notice(names):
        said = " ".join(next(s for n, s in license_scan.SENTENCES if n == name) + "." for name in names)
        return "\n".join(lead + line for line in textwrap.wrap(said, width, break_long_words=False, break_on_hyphens=False))

    want = {k: (name, ids) for k, (name, ids) in enumerate(license_scan.RULES) if len(ids) > 1}
    rows = [(k, notice(ids)) for k, (_, ids) in want.items()]
    got = {r["id"]: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (name, ids) in want.items():
        assert (got[k].sentence_ids, got[k].licenses, got[k].unmatched) == (",".join(ids), name, "")


@pytest.mark.parametrize(
    "page,want",
    [
        ('<article><p>One</p><svg class="i"/><p>Two</p><p>Three</p></article>', "One Two Three"),
        ('<article><p>One</p><svg class="i"/><p>Two</p><svg><path/>x</svg><p>Three</p></article>', "One Two Three"),
        ("<article><p>One</p><svg><p>Two</p><p>Three</p></article>", "One Two Three"),
        ("<article><p>One two three</p> I <3 all the rest", "One two three I <3 all the rest"),
        ("<article><p>One two three</p> rest <a href=", "One two three rest"),
        ("<article><p title=it's>One two</p><p>It's three</p></article>", "One two It's three"),
        ("<article><p title='a > b'>One</p><p title=\"c > d\">Two</p></article>", "One Two"),
    ],
)
def test_html_pages_that_are_not_well_formed(page, want):
    assert html_extraction.extract(page, html_extraction.learn(html_extraction.LABELLED_PAGES)) == want
