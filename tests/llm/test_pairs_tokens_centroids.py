"""MinHash near-duplicates, token alignment and centroid clustering against plain versions."""

import hashlib
import math
import random
import re
import time
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tracewright.llm import centroids, html_extraction, minhash, shared, token_align, token_store
from tracewright.llm.queries import QUERIES, vocabulary
from tracewright.plans import materialize

A, B = (vocabulary(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [None, "", " ", "\n\t ", "one", "one two", "Two words", "two WORDS", "a  b", "a b ", " a", "a\n b", "a \nb", "a  b", "　 x", "x▁y", "<|endoftext|> <s></s>", "it's  I'll 123,45!", "é́ café 中文\U0001f600", "\x00 \x01", "a\U0010fffe b c", "tab\there \r\n  there", "​ x  y", "x" * 3000]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()


def plain_groups(rows):
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                top[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return sorted((str(k), len(s), str(least.get(root(i))), k is not None and least.get(root(i)) == k) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True)))


def near_copies(seed=5):
    """Groups of one base text with more or fewer words changed, so that similarities lie on both sides of the threshold."""
    rng, out = random.Random(seed), []
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice((5, 9, 40, 90, 300)))]
        for _ in range(12):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(w) // 20))):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            out.append(" ".join(w))
    return out


def test_minhash_components_equal_all_pairs(spark):
    rows = [(None if i % 17 == 5 else i // 2 if i % 13 == 0 else i, t) for i, t in enumerate(near_copies() + [t.upper() for t in near_copies()[:20]] + ODD + ODD[:6])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"__k": F.lit(1), "bands": F.lit("x"), "node": F.lit(2)}).repartition(5)
    got = minhash.near_duplicates(docs)
    assert sorted((str(r.id), r.n_shingles, str(r.component), r.kept) for r in got.collect()) == plain_groups(rows)


def test_minhash_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(1)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.choice((1, 3, 4, 5))):
            w[rng.randrange(120)] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((str(r.id), r.n_shingles, str(r.component), r.kept) for r in got.collect()) == plain_groups(rows)


def test_circulant_coordinates(spark):
    """Every coordinate is the least of the shifted permutation, in strips too, and equal shares estimate the similarity."""
    rng = np.random.default_rng(3)
    whole = np.unique(rng.integers(0, 1 << 63, 6000, dtype=np.uint64))
    sets = [whole[:5000], whole[1000:], whole[:1], whole[7:2050]]
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    got = minhash.signatures(np.concatenate(sets), bounds)
    for s, row in zip(sets, got, strict=True):
        low = minhash._scattered(s)
        assert [int(minhash._permuted(low + np.uint32(k)).min()) for k in range(160)] == row.tolist()
    assert abs((got[0] == got[1]).mean() - len(np.intersect1d(sets[0], sets[1])) / 6000) < 0.12


def test_shared_counts(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 90, n, dtype=np.uint64)) for n in (0, 1, 30, 60, 80)]
    assert minhash.shared_counts(sets).tolist() == [[len(np.intersect1d(a, b)) if a is not b else int(np.isin(a, np.concatenate([s for s in sets if s is not a])).sum()) for b in sets] for a in sets]


def test_minhash_of_nothing(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    got = minhash.near_duplicates(spark.createDataFrame([("b", None), ("a", " ")], "doc_id string, text string")).collect()
    assert sorted(map(tuple, got)) == [("a", 0, "a", True), ("b", 0, "b", True)]


def plain_alignment(texts):
    """Token bytes laid side by side, a byte at a time."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = token_align.byte_letters()
    rows, links = [], []
    for text in texts:
        ids_a, ids_b, raw = [], [], (" " + (text or "")).encode()
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []
        spans = lambda parts: [(sum(map(len, parts[:k])), sum(map(len, parts[: k + 1]))) for k in range(len(parts))]
        sa, sb = spans(bytes_a), spans(bytes_b)
        found = Counter((ids_a[i], ids_b[j]) for i, (p, q) in enumerate(sa) for j, (s, t) in enumerate(sb) if p < t and s < q)
        groups, last = [], 0
        for cut in sorted({q for _, q in sa} & {q for _, q in sb}):
            pick = lambda ids, at, lo=last, hi=cut: ",".join(str(i) for i, (p, q) in zip(ids, at, strict=True) if lo <= p and q <= hi)
            groups.append(f"{pick(ids_a, sa)}|{pick(ids_b, sb)}")
            last = cut
        rows.append((len(ids_a), len(ids_b), len(groups), ";".join(groups)))
        links.append(found)
    total = sum(links, Counter())
    best = Counter()
    for (_, j), n in total.items():
        best[j] = max(best[j], n)
    return [(*r, sum(f.values()), sum(n for (i, j), n in f.items() if total[i, j] == best[j]), sum(n * total[p] for p, n in f.items())) for r, f in zip(rows, links, strict=True)]


@pytest.mark.parametrize("head", [token_align.HEAD, 5])
def test_alignment_equals_bytes_laid_side_by_side(spark, head):
    texts = ODD + [r.text[:900] if r.text else r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(40).collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("pairs", F.lit(1)).repartition(3)
    made = token_align.aligned(docs, A, B)
    got = token_align.scored(made, token_align.pieces_in(B), head).orderBy("id").collect()
    assert [(r.n_a, r.n_b, r.n_groups, r.groups, r.n_links, r.n_best, r.count_sum) for r in got] == plain_alignment(texts)


def test_alignment_forgets_pieces(monkeypatch):
    """A task that remembers few pieces gives the same."""
    texts = pa.array(["one two three", "two three four five", None, "one one one"])
    monkeypatch.setattr(token_align, "REMEMBERED", 1)
    aligner = token_align.Aligner(A, B)
    once = [aligner.align(texts) for _ in range(2)]
    assert once[0][1] == once[1][1] and once[0][3].tolist() == once[1][3].tolist() and once[0][1][2] == ""


def test_alignment_query(spark):
    got = QUERIES["op12_token_alignment"](spark, SMALL).orderBy("doc_id").collect()
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    short = [i for i, r in enumerate(rows) if r.text and len(r.text) < 1500][:25]
    want = plain_alignment([rows[i].text for i in short])
    assert [(got[i].n_a, got[i].n_b, got[i].n_groups, got[i].groups_sha256) for i in short] == [(a, b, n, hashlib.sha256(g.encode()).hexdigest() if a else "") for a, b, n, g, *_ in want]
    assert all(r.n_best <= r.n_links for r in got) and token_align.aligned(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0


def plain_lloyd(rows, size=3, k=4, rounds=5, scale=16):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [q for _, q in order[:k]]
    cost = lambda q, c: sum((x - y) ** 2 for x, y in zip(q, c, strict=True))
    near = lambda q: min(range(len(cents)), key=lambda c: (cost(q, cents[c]), c))
    for _ in range(rounds):
        at = [near(q) for _, q in kept]
        cents = [[sum(x) // len(mine) for x in zip(*mine, strict=True)] if (mine := [q for (_, q), a in zip(kept, at, strict=True) if a == c]) else cents[c] for c in range(len(cents))]
    at = [near(q) for _, q in kept]
    total = Counter()
    for (_, q), a in zip(kept, at, strict=True):
        total[a] += cost(q, cents[a])
    fits = lambda v: v if v < 1 << 63 else None
    return sorted(map(str, ((i, a, fits(cost(q, cents[a])), fits(total[a]), fits(sum(total.values())), centroids.digest_of(cents[a])) for (i, q), a in zip(kept, at, strict=True))))


def test_lloyd_equals_plain(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-3, 3) for _ in range(3)]) for i in range(60)] + [(100 + i, [1.5, -2.25, 0.0]) for i in range(50)]
    rows += [(7, [0.5, 0.5, 0.5]), (None, [0.1, 0.2, 0.3]), (300, None), (301, [1.0, 2.0]), (302, [1.0, None, 2.0]), (303, [1.0, float("nan"), 2.0]), (304, [float("inf"), 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"q": F.lit(1), "digest": F.lit(2), "cluster": F.lit("x")})
    for parts in (1, 7):
        got = centroids.lloyd(frame.repartition(parts), size=3, k=4, rounds=5, scale=16)
        assert sorted(str(tuple(r)) for r in got.collect()) == plain_lloyd(rows)


def test_lloyd_of_few_large_and_no_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([(1, [1e9, 2.0, -1e9]), (2, [3e12, 0.0, 1.0]), (3, [1e9, 2.5, -1e9]), (4, [1.0, 1.0, 1.0]), (5, [2.0, 1.0, 1.0]), (6, [2e9, 2.0, -1e9])], [(1, [1.0, 2.0, 3.0])] * 3):
        got = centroids.lloyd(spark.createDataFrame(rows, schema), size=3, k=4, rounds=5, scale=16)
        assert sorted(str(tuple(r)) for r in got.collect()) == plain_lloyd(rows)
    assert centroids.lloyd(spark.createDataFrame([], schema)).collect() == []
    assert centroids.lloyd(spark.createDataFrame([(1, [1.0])], schema)).columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


CLASHES = ["__bucket", "__bits", "__at", "__byte", "__k", "__d", "__maybe", "row", "k", "d", "bits", "bucket", "at", "maybe"]


@pytest.mark.parametrize("rows,size", [(10**6, 1 << 26), (0, 0)])
def test_no_column_name_is_reserved(spark, monkeypatch, rows, size):
    """Under the limit of a broadcast and beyond it, with columns of every name that is used inside."""
    monkeypatch.setattr(materialize, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(materialize, "BROADCAST_BYTES", size)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)] + [(None, "no id"), (41, None), (7, "text 7")], "doc_id long, text string")
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHES})
    gone = shared.row_key(spark.createDataFrame([(7, "text 7"), (8, "text 9"), (None, "no id"), (9, "text 9")], "doc_id long, text string")).select("__k", "__d")
    got = shared.without(docs, gone)
    assert got.columns == docs.columns and sorted(str(r.doc_id) for r in got.collect()) == sorted(str(i) for i in [*range(40), 41] if i not in (7, 9))
    keyed = shared.row_key(docs.select("doc_id", "text", "bits", "row", "at"))
    assert sorted(str(r.doc_id) for r in shared.within(keyed, gone).collect()) == ["7", "7", "9", "None"]


def test_pipeline_keeps_one_of_rows_that_differ_in_other_columns(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    text = "one two three four five six seven eight"
    rows = [(1, text, "en", 1), (1, text, "de", 2), (1, text, "de", 2), (2, text, "en", 3), (3, "quite another text of some words that nobody copies", "fr", 4), (3, "a third one which is unlike the others in every word", "fr", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, __k int")
    runs = [sorted((r.doc_id, r.lang, r["__k"]) for r in pipeline.near_duplicate_stage(spark, docs.repartition(n), SMALL).collect()) for n in (1, 5)]
    assert runs[0] == runs[1] and [r[0] for r in runs[0]] == [1, 3, 3] and runs[0][0] in [(1, "en", 1), (1, "de", 2)]


@pytest.mark.parametrize("page", ["<b>" * 140_000 + "x" + "</i>" * 140_000, "<svg>" * 200_000, "<p><td>" + "<b>" * 100_000 + "<hr>" * 100_000, "<article>" + "<p>some words of the text</p>" * 50 + "</article>" + "<nav class='menu'><a>x</a> y</nav>" * 28_000, "<div>" * 80_000 + "x" + "</div>" * 80_000], ids=["unclosed", "raw", "scopes", "boilerplate", "deep"])
def test_pages_of_a_megabyte_take_seconds(page):
    weights = html_extraction.learn(html_extraction.LABELLED_PAGES)
    start = time.time()
    found = html_extraction.extract(page, weights)
    assert time.time() - start < 15 and found == ("some words of the text " * 50).strip() * ("article" in page) + "x" * page.endswith(("</i>", "</div>"))


def test_damaged_stores_are_seen(spark, monkeypatch):
    """A lost recipe, two exchanged recipes, a changed start and a flipped payload byte; groups of four documents."""
    monkeypatch.setattr(token_store, "FAN", 4)
    texts = [(i, f"document {i} has some words of its own {i * 7919} " * 40) for i in range(40)]
    path = f"{materialize.shared_dir(spark)}/damaged-{uuid.uuid4().hex}"
    token_store.write_store(spark.createDataFrame(texts, "doc_id long, text string"), path, vocabulary("word_bpe_49k.json"))
    recipes, chunks, tree = (spark.read.parquet(f"{path}/{n}").cache() for n in ("recipes", "parts", "manifest"))
    assert [r.level for r in tree.where("level > 1").select("level").distinct().orderBy("level").collect()] == [2, 3]

    def bad(recipes=recipes, chunks=chunks, tree=tree):
        at = f"{materialize.shared_dir(spark)}/damaged-{uuid.uuid4().hex}"
        recipes.write.parquet(f"{at}/recipes")
        chunks.write.partitionBy("kind").parquet(f"{at}/parts")
        tree.write.parquet(f"{at}/manifest")
        return {r.doc_id for r in token_store.verified(spark, at).collect() if not r.verified}

    assert bad() == set()
    assert bad(recipes=recipes.where("doc_id <> 6")) == {4, 5, 7}
    swapped = recipes.withColumn("pos", F.when(F.col("pos") == 9, 22).when(F.col("pos") == 22, 9).otherwise(F.col("pos")).cast("long"))
    assert bad(recipes=swapped) == {*range(8, 12), *range(20, 24)}
    assert bad(recipes=recipes.withColumn("start", F.when(F.col("doc_id") == 30, 5).otherwise(F.col("start")).cast("long"))) == {*range(28, 32)}
    one = recipes.where("doc_id = 17").select(F.col("digests")[0]).first()[0]
    flipped = F.when((F.col("kind") == "chunk") & (F.col("key") == F.lit(one)), F.unhex(F.concat(F.lit("FFFF"), F.substring(F.hex("payload"), 5, 1 << 20)))).otherwise(F.col("payload"))
    assert bad(chunks=chunks.withColumn("payload", flipped)) == {17}
    changed = F.when((F.col("level") == 2) & (F.col("node") == 1), F.lit("0")).otherwise(F.col("digest"))
    assert bad(tree=tree.withColumn("digest", changed)) >= {*range(16, 32)}
    assert len(bad(tree=tree.where("level < 3"))) == 40


def test_quality_scores_do_not_depend_on_partitions(spark):
    from tracewright.llm import quality_rules

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    trusted = docs.where("doc_id % 3 = 0").select("doc_id")
    runs = [sorted((r["id"], r.llr_score, r.kept) for r in quality_rules.quality(docs.repartition(n), trusted).collect()) for n in (1, 7)]
    assert runs[0] == runs[1]
