"""Every operator against a brute-force version, an exact round trip or held-out accuracy."""

import hashlib
import math
import random
import re
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracewright.llm import bin_packing, decontamination, html_extraction, lattice_lm, license_scan, quality_classifier, quality_rules, queries, sharding, simhash, token_store
from tracewright.plans.materialize import shared_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def test_quality_base_columns(spark, texts):
    for r in queries.op1_quality_rules(spark, SF).collect():
        w, lines = words(texts[r.doc_id]), [x for x in texts[r.doc_id].split("\n") if words(x)]
        tri, inside = Counter(zip(w, w[1:], w[2:])), set()
        for i, t in enumerate(zip(w, w[1:], w[2:])):
            inside |= {i, i + 1, i + 2} if tri[t] > 1 else set()
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(inside))
        assert (r.n_symbols, r.n_dup_lines) == (len(re.findall(r"[#*$%&|<>]", texts[r.doc_id])), len(lines) - len(set(lines)))
        assert r.base_failed == (len(w) < 50 or 100 * len(inside) > 50 * len(w)) and not (r.kept and r.base_failed)


def spark_hash(spark, *values):
    return spark.range(1).select(F.xxhash64(*[F.lit(v).cast("long") for v in values])).first()[0]


def test_quality_ratio_by_brute_force(spark):
    import xxhash

    rows = [(1, "good words here"), (2, "bad bad words"), (3, "good words again"), (4, None), (3, "good words again")]
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    uni, bi, pairs = 1 << 9, 1 << 8, {}

    def grams(text):
        h = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in (text or "").split()]
        for p in zip(h, h[1:]):
            pairs[p] = pairs[p] if p in pairs else spark_hash(spark, *p)
        return [x % uni for x in h] + [uni + pairs[p] % bi for p in zip(h, h[1:])]

    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t))
        target.update(grams(t) if i in (1, 3) else [])
    share = sum(target.values()) / sum(raw.values())
    llr = lambda b: math.log((target[b] + 1) / (raw[b] * share + 1))
    got = quality_rules.quality(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1,), (3,)], "doc_id long"), buckets=(uni, bi)).collect()
    assert sorted(r["id"] for r in got) == [1, 2, 3, 3, 4]
    for r in got:
        g = grams(dict(rows)[r["id"]])
        assert r.llr_score == pytest.approx(sum(llr(x) for x in g) / len(g) if g else 0, rel=1e-6)


def test_repeated_windows_with_equal_leading_bits(spark, monkeypatch):
    near = (5 << 40) + 1
    for windows, want in (([5 << 40, near, 5 << 40], 5), ([5 << 40, near, (5 << 40) + 2], 0), ([7, 7, 7], 5), ([], 0)):
        for bits in (24, 1):  # places of one bit: the way of texts too long for the places
            monkeypatch.setattr(quality_rules, "PLACE_BITS", bits)
            table = spark.createDataFrame([(windows,)], "t array<long>").withColumn("s", quality_rules.sorted_places())
            assert table.select(quality_rules.repeated_words().alias("n")).first().n == want


def test_quality_rules_reject_labelled_junk_and_keep_good(spark):
    """Good documents left out of the target, by folds, and bad ones: what the ratio decides of those that pass the base rule."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    out = quality_classifier.remainder("doc_id", 5) == 0
    got = quality_rules.quality(spark.read.parquet(f"{sf}/documents.parquet"), labels.where((F.col("quality") == 1) & ~out))
    got = got.withColumnRenamed("id", "doc_id").join(labels, "doc_id").where("not base_failed")
    found = dict(got.select("quality", (F.col("quality") == 1).alias("good"), out.alias("out"), "kept").where("out or not good").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect())
    assert found[0] <= 0.01 and found[1] >= 0.99


def test_sharding_is_minimax(spark, docs, texts):
    got = sharding.shard_rows(docs, 8).collect()
    size = Counter()
    for t in texts.values():
        size[hashlib.sha256(t.encode()).hexdigest()] += len(t.encode()) + 1

    def shards(capacity):
        n, fill = 1, 0
        for k in sorted(size):
            if size[k] > capacity:
                return 99
            n, fill = (n + 1, size[k]) if fill + size[k] > capacity else (n, fill + size[k])
        return n

    low, high = 1, sum(size.values())
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if shards(mid) <= 8 else (mid + 1, high)
    assert got[0].capacity == low
    fill, slots, of = Counter(), {}, {}
    for r in got:
        fill[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
        assert of.setdefault(r.key, r.shard) == r.shard and r.text_crc32 == zlib.crc32(texts[r["id"]].encode())
    assert max(fill.values()) <= low and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert min(fill[k] for k in range(8)) >= sum(size.values()) / 8 - 2 * max(size.values())


def test_even_cuts_keep_the_capacity(spark):
    rng = random.Random(8)
    for _ in range(8):
        sizes = [rng.choice([1, 2, 3, 30]) for _ in range(rng.randint(1, 25))]
        sums = np.cumsum(sizes).tolist()
        prefix, shards = spark.createDataFrame([(x,) for x in sums], "p long").cache(), rng.randint(2, 5)
        capacity, greedy = sharding.minimax_cuts(prefix, sums[-1], shards)
        cuts = [0, *sharding.even_cuts(prefix, sums[-1], shards, capacity), sums[-1]]
        parts = np.diff(cuts)
        assert len(parts) <= shards and parts.max() <= capacity and parts.min() > 0 and set(cuts[1:]) <= set(sums)
        if len(greedy) == shards - 1 and max(sizes) <= 3:
            assert parts.min() >= np.diff([0, *greedy, sums[-1]]).min() - 3


def test_license_sentences_and_rules(spark):
    mit = " ".join(s + "." for n, s in license_scan.SENTENCES if n in ("MITPerm", "MITNotice", "MITAsIs", "MITLiab"))
    gpl = [s for n, s in license_scan.SENTENCES if n in ("GPLFree", "GPLHope", "GPLSee", "GPLCopy")]
    wrapped = "\n".join(re.sub(r"(.{60,90}?) ", r"\1\n", s, count=1) + "." for s in gpl)
    rows = [(1, "Intro\n" + mit), (2, wrapped), (3, "Licensed under CC BY-NC 4.0.\nAll rights reserved."), (4, "see the gnu general public license for more details."), (5, "no license")]
    got = {r["id"]: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].licenses == "MIT" and got[1].n_sentences == 4 and got[2].licenses == "GPL-3.0-or-later"
    assert got[3].licenses == "CC-BY-NC-4.0,All-Rights-Reserved" and (got[4].licenses, got[4].unmatched) == ("", "GPLSee") and got[5].sentence_ids == ""


def test_html_extraction():
    w, p = html_extraction.learn(html_extraction.LABELLED_PAGES), "Some words of the story that go on and on."
    page = f'<html><head><title>t</title><script>"</p>"</script></head><body class="menu-open"><nav><a href=x>Menu</a></nav><article><h1>T</h1><p>{p}</p><div class="ad">Buy now</div><ul><li>A &amp; B</li></ul><aside>Side</aside><p>x<b>y</b>\n z</p></article><section class="comments"><article><p>{p}</p></article></section><footer><p>Foot</p></footer>'
    assert html_extraction.extract(page, w) == f"T {p} A & B xy z"
    assert html_extraction.extract(None, w) == html_extraction.extract("", w) == "" and html_extraction.extract(p, w) == p
    assert html_extraction.best_region([-1, 2, -1, 3, -9, 4]) == (1, 4) and html_extraction.best_region([-1]) == (0, 0)


_S = "The river rose in spring and the village moved its market to the hill where the old road ends."
_P = "".join(f"<p>{_S} {_S}</p>" for _ in range(3))
_BAR = "".join(f"<a href=/>{x}</a> " for x in ("Home", "News", "Mail"))
LAYOUTS = {
    "names never seen": f'<div class="qx1">{_BAR}</div><div class="zz">{_P}</div><div class="qq"><ul><li>{_BAR.replace(" <", "</li><li><")}</li></ul></div>',
    "comments longer than the text": f'<article>{_P}</article><div id="disqus_thread" class="comments"><div class="comment"><p>{_S * 12}</p></div><div class="comment"><p>{_S * 3}</p></div></div>',
    "advert and sidebar amid the text": f'<main><p>{_S} {_S}</p><div class="advertisement">{_S}</div><p>{_S} {_S}</p><aside class="sidebar">{_S}</aside><p>{_S} {_S}</p></main>',
    "form": f"<form><label>Your name</label><input><select><option>One</option></select><button>Send</button></form><article>{_P}</article><footer><p>{_S}</p></footer>",
    "notice and header": f'<div class="cookie-banner">{_S}<button>Ok</button></div><header><h1>Site</h1><nav><ul><li><a>A b</a></li></ul></nav></header><article>{_P}</article>',
    "fallback content": f"<article><p>{_S} {_S}</p><video src=x>No video here.</video><p>{_S} {_S}</p><object>No object</object><p>{_S} {_S}</p></article>",
    "layout by a table": f'<nav><a>x y</a></nav><table><tr><td class="side"><a>l</a><a>m</a></td><td>{_P}</td></tr></table>',
    "no container": f'<h3>Menu</h3><ul><li><a>l</a></li><li><a>m</a></li></ul>{_P}<div class="ad">{_S}</div>',
    "markup not closed": f"<nav><ul><li><a href=x>Menu<li><a href=y>More</ul></nav><article>{_P.replace('</p>', '')}</article><footer>Foot",
    "quote not closed": f'<article>{_P}<p>{_S} <a href="x>{_S}</a></p></article>',
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_html_layouts(name):
    got = html_extraction.extract(f"<html><head><title>t</title></head><body>{LAYOUTS[name]}</body></html>", html_extraction.learn(html_extraction.LABELLED_PAGES))
    assert got == " ".join([_S] * (8 if name == "quote not closed" else 6))


def test_html_labelled_pages_come_back():
    weights = html_extraction.learn(html_extraction.LABELLED_PAGES)
    for page in html_extraction.LABELLED_PAGES:
        found = html_extraction.runs(page)
        parts = [r.text if r.main and not r.tag else "" if r.tag.lstrip("/") in html_extraction.INLINE and r.tag else " " for r in found]
        assert html_extraction.extract(page, weights) == " ".join("".join(parts).split())


def test_html_the_scan_decides(spark):
    """Without the scan, every word that no element known as boilerplate holds, pages come out otherwise."""
    weights = html_extraction.learn(html_extraction.LABELLED_PAGES)
    for r in spark.read.parquet(f"{SF}/pages.parquet").limit(20).collect():
        words = " ".join(x.text for x in html_extraction.runs(r.html) if not x.tag)
        assert len(html_extraction.extract(r.html, weights).split()) < len(words.split())
    assert html_extraction.extract("<nav><ul><li><a>Only a menu</a></li></ul></nav><footer>Foot</footer>", weights) == ""


def test_html_pages_in_full(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op4_html_extraction(spark, SF).collect():
        inner = re.search("<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        want = " ".join(html.unescape(re.sub("</?b>", "", re.sub("</?(p|br|h1)>", " ", inner))).split())
        assert r.text == want and r.n_chars == len(want)


def test_classifier_on_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op5_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)


def test_grouped_scores_equal_single_ones():
    model = quality_classifier.Model(np.random.default_rng(0).normal(size=1 << 17).astype(np.float32), 0.3)
    texts = ["", "a", "to to", "ab", "The cat sat", "  ", None, "É to é to to", "abcde fghij\nk"]
    assert np.allclose(model.scores(texts), [model.scores([t])[0] for t in texts])


@pytest.mark.parametrize("block", [1, 7, 40])
def test_long_texts_have_the_features_of_short_ones(monkeypatch, block):
    rng = random.Random(block)
    texts = [" ".join("".join(rng.choices("abé.", k=rng.randint(1, 9))) for _ in range(rng.randint(1, 60))) for _ in range(20)] + ["  a\t\n b ", "word" * 50, " ", "x y\n"]
    model = quality_classifier.Model(np.random.default_rng(1).normal(size=1 << 17).astype(np.float32), 0.1)
    counts, scores = [quality_classifier.sparse(t) for t in texts], model.scores(texts)
    monkeypatch.setattr(quality_classifier, "BLOCK", block)
    for t, (buckets, n) in zip(texts, counts):
        again = quality_classifier.sparse(t)
        assert again[0].tolist() == buckets.tolist() and again[1].tolist() == n.tolist()
    assert np.allclose(model.scores(texts), scores, rtol=1e-12)


def test_classifier_is_fitted_as_by_hand():
    """The same gradient descent, one number at a time."""
    rows = [(np.array([1, 4]), np.array([2.0, 1.0]), 1), (np.array([0, 4, 7]), np.array([1.0, 1.0, 3.0]), 0), (np.array([2]), np.array([5.0]), 1)]
    bits, dim, epochs, rate, seed = 3, 2, 3, 0.5, 11
    got = quality_classifier.fit(rows, bits, dim, epochs, rate, seed)
    rng = np.random.default_rng(seed)
    v = [[float(x) for x in line] for line in rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)]
    out, bias, done = [[0.0] * dim, [0.0] * dim], [0.0, 0.0], 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            buckets, counts, label = rows[i]
            share = [c / sum(counts) for c in counts]
            hidden = [sum(s * v[b][d] for s, b in zip(share, buckets)) for d in range(dim)]
            z = [sum(o * h for o, h in zip(out[k], hidden)) + bias[k] for k in (0, 1)]
            p = [math.exp(x - max(z)) for x in z]
            error = [x / sum(p) - (k == label) for k, x in enumerate(p)]
            step = rate * (1 - done / (epochs * len(rows)))
            back = [sum(error[k] * out[k][d] for k in (0, 1)) for d in range(dim)]
            for k in (0, 1):
                bias[k] -= step * 0.1 * error[k]
                for d in range(dim):
                    out[k][d] -= step * error[k] * hidden[d]
            for s, b in zip(share, buckets):
                for d in range(dim):
                    v[b][d] -= step * len(buckets) ** 0.5 * s * back[d]
            done += 1
    want = [sum(line[d] * (out[1][d] - out[0][d]) for d in range(dim)) for line in v]
    assert np.allclose(got.table, want, atol=1e-5) and got.bias == pytest.approx(bias[1] - bias[0], abs=1e-6)


def test_classifier_goes_on_past_long_labelled_texts(spark):
    assert quality_classifier.taken([5, 90, 5, 5], 9, 20) == [0, 2, 3] and quality_classifier.taken([5, 5, 5], 2, 99) == [0, 1]
    good, bad = [f"calm words of prose number {i}" for i in range(40)], [f"### $$$ {i} ###" for i in range(40)]
    rows = [(i, t) for i, t in enumerate([*good, *bad, "### " * 400_000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 40 or i == 80)) for i, _ in rows], "doc_id long, quality int")
    scores = quality_classifier.train(docs, labels).scores([good[3], bad[3]])
    assert scores[0] > 0.5 > scores[1]


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms[rooms.index(min(fits))] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def test_packing_plan_is_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(40):
        lengths = [rng.randint(1, 64) for _ in range(rng.randint(1, 120))]
        made = bin_packing.plan(dict(Counter(lengths)), [64], 0)
        rooms = sorted(64 - sum(a * b for a, b in c) for n, _, c in made for _ in range(n))
        assert rooms == plain_best_fit(lengths, 64)


def least_cost(lengths, capacities, overhead):
    """The least cost of any packing of a few pieces, found by trying every one."""
    best = [math.inf]

    def place(k, fills):
        cost = sum(next(c for c in capacities if c >= f) + overhead for f in fills)
        if cost >= best[0]:
            return
        if k == len(lengths):
            best[0] = cost
            return
        for i, f in enumerate(fills):
            if f + lengths[k] <= capacities[-1]:
                place(k + 1, [*fills[:i], f + lengths[k], *fills[i + 1 :]])
        place(k + 1, [*fills, lengths[k]])

    place(0, [])
    return best[0]


def test_packing_over_several_capacities_is_near_the_best():
    rng, cost, best, one_size = random.Random(4), 0, 0, 0
    for _ in range(120):
        capacities, overhead = [16, 32, 64], rng.choice([0, 4])
        lengths = sorted((rng.randint(1, 64) for _ in range(rng.randint(1, 8))), reverse=True)
        made = bin_packing.plan(dict(Counter(lengths)), capacities, overhead)
        placed = sorted(n for bins, _, content in made for n, each in content for _ in range(bins * each))
        assert placed == sorted(lengths)
        for _, capacity, content in made:
            used = sum(n * each for n, each in content)
            assert capacity == next(c for c in capacities if c >= used)
        mine, least = sum(bins * (c + overhead) for bins, c, _ in made), least_cost(lengths, capacities, overhead)
        assert mine <= 1.5 * least
        cost, best = cost + mine, best + least
        one_size += sum(bins * (64 + overhead) for bins, _, _ in bin_packing.plan(dict(Counter(lengths)), [64], overhead))
    assert cost <= 1.06 * best and cost < one_size


def test_packing_opens_the_bin_of_least_cost():
    assert bin_packing.plan({10: 1}, [16, 64], 2) == [(1, 16, [(10, 1)])]
    assert bin_packing.plan({32: 2, 1: 1}, [16, 64], 2) == [(1, 64, [(32, 2)]), (1, 16, [(1, 1)])]
    # Six pieces of 10: 64 holds all of them, five bins of 16 would cost more.
    assert bin_packing.plan({10: 6}, [16, 64], 2) == [(1, 64, [(10, 6)])]
    # Opened as 64, shrunk to what is in it.
    assert bin_packing.plan({10: 3}, [16, 32, 64], 0) == [(1, 32, [(10, 3)])]


def test_packing_places_every_token(spark, docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in texts.items()}
    packed = bin_packing.pack(queries.token_counts(docs), F.col("tokens"), "id", capacities=(64, 128, 256)).cache()
    spans, total = {}, Counter()
    for r in packed.collect():
        spans.setdefault(r.bin, []).append((r.offset, r.offset + r.length, r.capacity))
        total[r["id"]] += r.length
    for s in spans.values():
        s.sort()
        assert s[0][0] == 0 and all(a[1] == b[0] for a, b in zip(s, s[1:])) and s[-1][1] <= s[0][2]
        assert s[0][2] == min(c for c in (64, 128, 256) if c >= s[-1][1])
    assert total == {i: len(x) for i, x in want.items()}
    ids = spark.createDataFrame(list(want.items()), "id long, ids array<long>")
    made = {r.bin: r.ids for r in bin_packing.sequences(packed, ids).collect()}
    for r in packed.collect():
        assert made[r.bin][r.offset : r.offset + r.length] == want[r["id"]][r.start : r.start + r.length]


def test_token_store_round_trip(spark, docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    path = f"{shared_dir(spark)}/round-trip-{uuid.uuid4().hex}"
    token_store.write_store(docs, path, queries.vocabulary("word_bpe_49k.json"))
    found = {r.doc_id: r for r in token_store.verified(spark, path).collect()}
    whole = {r.doc_id: r.ids for r in token_store.read_ids(spark, path).collect()}
    at = 0
    for i in sorted(texts):
        ids = np.array([*tokenizer.encode(texts[i], add_special_tokens=False).ids, 2], "<u4")
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32, found[i].verified) == (at, len(ids), zlib.crc32(ids.tobytes()), True)
        assert whole[i] == ids.tolist()
        at += len(ids)
    chunks = token_store.read_chunks(spark, path)
    assert chunks.count() == chunks.select("digest").distinct().count()
    kept, tree = {r.digest for r in token_store.manifest(token_store.read_recipes(spark, path)).collect()}, spark.read.parquet(f"{path}/manifest")
    assert {r.digest for r in tree.collect()} == kept


def test_chunks_of_a_shared_passage_are_shared():
    rng = np.random.default_rng(3)
    passage, a, b = (rng.integers(0, 40_000, n).astype(np.uint32) for n in (5000, 700, 300))
    chunks = lambda ids: {ids[x:y].tobytes() for x, y in zip([0, *token_store.cuts(ids)[:-1]], token_store.cuts(ids))}
    one, two = chunks(np.concatenate((a, passage))), chunks(np.concatenate((b, passage)))
    assert len(one & two) >= 0.6 * len(one)


@pytest.mark.parametrize("text", ["Word, word. WORD?", "it's <|endoftext|> x", "a.b,c d.. e,", "É, é. ñ.", "x y z", "１２ ①", "can't. won't,", "a\x0bb\x0cc  d\n\n", "x, y, z, a. b.", "a ,b", "ab., c"])
def test_encoder_equals_the_library(text):
    from tokenizers import Tokenizer

    path = queries.vocabulary("word_bpe_49k.json")
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    got = list(token_store.Encoder(path).encode(pa.array([text, None, "other text"]), 2))
    assert got[0].tolist() == [*want, 2] and got[1].tolist() == [2]


def test_simhash_by_brute_force(spark, texts):
    import xxhash

    def plain(text):
        w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text))
        s = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = {i: plain(t) for i, t in texts.items()}
    parent = {i: i for i in prints}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(prints)
    for i in ids:
        for j in ids:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 3:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    for r in queries.op8_simhash_near_dedup(spark, SF).collect():
        assert int(r.fingerprint, 16) == prints[r.doc_id] and r.component_id == find(r.doc_id)


def test_close_pairs_lose_nothing(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(20)]
    prints = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 3))) for b in base for _ in range(15)}
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    got = {(r.u, r.v) for r in simhash.close_pairs(spark.createDataFrame([(signed(p),) for p in prints], "fp long")).collect()}
    assert got == {tuple(sorted((signed(a), signed(b)))) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3}


def test_decontamination_by_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(12)]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 90)))) for i in range(60)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([0, 1, 2, 3, 5, 13, 14, 30])))) for i in range(25)] + [(99, docs[1][1]), (98, docs[2][1][3:])]
    got = {r["id"]: r for r in decontamination.verdicts(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for i, text in docs:
        w, hit, names = text.split(), set(), set()
        for item, t in items:
            v = t.split()
            n = min(13, len(v))
            for s in range(len(v) - n + 1) if v else ():
                for k in range(len(w) - n + 1):
                    if w[k : k + n] == v[s : s + n]:
                        hit |= set(range(k, k + n))
                        names.add(str(item))
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == (len(w), len(hit), sorted(names))
        assert got[i].contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))


def plain_marginal(word, number, p):
    """Probability of a marked word, summed over its segmentations one by one."""
    if not word:
        return 1.0
    total = 0.0
    for k in range(1, len(word) + 1):
        if word[:k] in number:
            total += p[number[word[:k]]] * plain_marginal(word[k:], number, p)
        elif k == 1:
            total += math.prod(p[len(number) + b] for b in word[0].encode()) * plain_marginal(word[1:], number, p)
    return total


def test_lattice_sums_all_segmentations(monkeypatch):
    pieces = lattice_lm.load_pieces(queries.vocabulary("piece_bpe_32k.model"))
    number, p = {t: i for i, t in enumerate(pieces.texts)}, pieces.p
    sample = ["the", "thonlynt", "été", "a", "日x😀", "#!!", "unbelievably"]
    want = [math.log(plain_marginal(lattice_lm.MARK + w, number, p)) for w in sample]
    assert np.allclose(lattice_lm.Lattice(pieces).likelihoods(sample, p), want)
    for span in (1, 3, 5):  # words longer than what is laid out at a time
        monkeypatch.setattr(lattice_lm, "SPAN", span)
        assert np.allclose(lattice_lm.Lattice(pieces).likelihoods(sample, p), want)


def test_lm_score_of_whole_texts_by_brute_force(spark):
    """``score`` is the sum over all segmentations of the whole text, ``mixed_score`` with the training words as edges."""
    path = queries.vocabulary("piece_bpe_32k.model")
    rows = [(1, "The cat the CAT"), (2, "a dog sat"), (3, "the bird été"), (4, None), (5, ""), (6, "the dog x😀")]
    held = F.col("doc_id").isin(3, 6)
    got = {r["id"]: r for r in lattice_lm.score(spark.createDataFrame(rows, "doc_id long, text string"), held, path).collect()}
    pieces = lattice_lm.load_pieces(path)
    number = {t: i for i, t in enumerate(pieces.texts)}
    c = Counter("the cat the cat a dog sat".split())
    tokens, end = 7 + 4, 4 / 11
    p, once, twice = pieces.p * (1 - end), 3, 2
    d = once / (once + 2 * twice)
    first = (1 - end) * sum(pieces.p[i] for t, i in number.items() if t.startswith(lattice_lm.MARK))
    for i, text in rows:
        w = (text or "").lower().split()
        by_lattice = [plain_marginal(lattice_lm.MARK + x, number, p) for x in w]
        assert got[i].score == pytest.approx(sum(map(math.log10, by_lattice)) + math.log10(end))
        mixed = [max(c[x] - d, 0) / tokens + d * len(c) / tokens * y * (end + first) / first for x, y in zip(w, by_lattice)]
        assert got[i].mixed_score == pytest.approx(sum(map(math.log10, mixed)) + math.log10(end))


def test_lm_base_and_score(spark, texts):
    got = {r.doc_id: r for r in queries.op10_lm_scoring(spark, SF).collect()}
    lower = lambda t: words(re.sub("[A-Z]", lambda m: m.group().lower(), t))
    train = {i for i in texts if zlib.crc32(str(i).encode()) % 10}
    c = Counter(w for i in train for w in lower(texts[i]))
    n, v, ends = sum(c.values()) + len(train), len(c) + 1, len(train)
    for i, t in texts.items():
        w = lower(t)
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w) + math.log10((ends + 0.1) / (n + 0.1 * (v + 1)))
        assert got[i].base_score == pytest.approx(base, rel=1e-9) and got[i].n_tokens == len(w) + 1 and got[i].train_tokens == n
        assert got[i].n_known == sum(c[x] > 0 for x in w) + 1 and got[i].held_out == (i not in train) and got[i].score < 0


def test_lm_rare_words_come_by_the_shuffled_join(spark, docs, monkeypatch):
    path, held = queries.vocabulary("piece_bpe_32k.model"), quality_classifier.remainder("doc_id", 10) == 0
    few = docs.limit(60).cache()
    found = lambda: {r.id: (r.n_known, round(r.base_score, 6), round(r.score, 6), round(r.mixed_score, 6)) for r in lattice_lm.score(few, held, path).collect()}
    whole = found()
    monkeypatch.setattr(lattice_lm, "FREQUENT", 40)
    assert found() == whole


def test_pipeline_by_brute_force(spark, texts):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {i for i in texts}
    rules = {r["id"]: r.kept for r in quality_rules.quality(docs, queries.trusted_ids(spark, SF)).collect()}
    kept = {i for i in kept if rules[i]}
    left = docs.where(F.col("doc_id").isin(list(kept)))
    model = quality_classifier.train(left, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {i for i in kept if model.scores([texts[i]])[0] >= 0.3}
    prints = {i: simhash.fingerprint(texts[i]) & (2**64 - 1) for i in kept}
    near, groups = {i: {j for j in kept if (prints[i] ^ prints[j]).bit_count() <= 3} for i in kept}, {}
    for i in sorted(kept):
        if i not in groups:
            todo = [i]
            while todo:
                k = todo.pop()
                if k not in groups:
                    groups[k] = i
                    todo += near[k]
    kept = {i for i in kept if groups[i] == i}
    flagged = {r.doc_id for r in queries.op9_decontamination(spark, SF).where("contaminated").collect()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == kept - flagged
